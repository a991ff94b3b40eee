"""Language identification: presence kernels of blended character n-grams, Nystroem landmarks, ridge regression."""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters are folded to so many symbols: blank, the commonest letters of the sample, and the rest spread over what is left.
SYMBOLS = 64
ORDERS = (1, 2, 3)
_SIZE = sum(SYMBOLS**n for n in ORDERS)
#: Bounds of the labelled sample, for each language: rows fitted on, and landmarks among them.
SAMPLE, LANDMARKS = 400, 32
RIDGE = 1e-3
UNKNOWN = "und"
#: Texts whose n-gram flags are held at a time.
_BATCH = 256
_letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def folded(text: str) -> np.ndarray:
    """Code points of the lower-cased text; what isn't a letter is a blank, and blanks in a row are one."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).copy()
    points[~_letters[points]] = 0
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 0) | (points[:-1] != 0)
    return np.concatenate([[0], points[keep], [0]]).astype(np.uint32)


def alphabet(texts: list[str]) -> np.ndarray:
    """The letters that get a symbol of their own: as many as fit, by frequency, ties by code point."""
    seen = Counter()
    for text in texts:
        points, n = np.unique(folded(text), return_counts=True)
        seen.update(dict(zip(points.tolist(), n.tolist(), strict=True)))
    seen.pop(0, None)
    return np.array(sorted(seen, key=lambda c: (-seen[c], c))[: SYMBOLS - 8], np.uint32)


def symbol_table(letters: np.ndarray) -> np.ndarray:
    table = (np.arange(0x110000, dtype=np.uint32) % 7 + SYMBOLS - 7).astype(np.uint8)
    table[0] = 0
    table[letters] = np.arange(1, len(letters) + 1)
    return table


def presence(text: str, table: np.ndarray, flags: np.ndarray) -> None:
    """Sets in `flags` the n-grams of all orders that the text holds."""
    s = table[folded(text)].astype(np.uint32)
    flags[:] = False
    base = 0
    for n in ORDERS:
        if len(s) >= n:
            grams = s[: len(s) - n + 1]
            for k in range(1, n):
                grams = grams * SYMBOLS + s[k : len(s) - n + 1 + k]
            flags[base + grams] = True
        base += SYMBOLS**n


class Model:
    """Kernel ridge regression, one against the rest, on Nystroem features of normalised presence kernels."""

    def __init__(self, letters: np.ndarray, languages: list[str], grams: np.ndarray, marks: np.ndarray, sizes: np.ndarray, weights: np.ndarray):
        self.letters, self.languages, self.grams, self.marks, self.sizes, self.weights = letters, languages, grams, marks, sizes, weights
        self.table = None

    def kernel(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Shared n-grams with each landmark over the root of both sizes, as one product of matrices."""
        return (rows @ self.marks) / np.sqrt(np.maximum(sizes, 1)[:, None] * self.sizes[None, :])

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if self.table is None:
            self.table = symbol_table(self.letters)
        flags = np.zeros(_SIZE, bool)
        rows, sizes = np.zeros((len(texts), len(self.grams)), np.float32), np.zeros(len(texts), np.float32)
        known = np.zeros(len(texts), bool)
        for i, text in enumerate(texts):
            if text and self.languages and any(map(str.isalpha, text)):
                presence(text, self.table, flags)
                rows[i], sizes[i], known[i] = flags[self.grams], np.count_nonzero(flags), True
        if not known.any():
            return [(UNKNOWN, 0.0)] * len(texts)
        scores = self.kernel(rows, sizes) @ self.weights
        best = scores.argmax(1)
        return [(self.languages[b], float(np.clip(scores[i, b], 0, 1))) if known[i] else (UNKNOWN, 0.0) for i, b in enumerate(best)]


def fit(texts: list[str], labels: list[str]) -> Model:
    """On the rows given; landmarks are the first LANDMARKS rows of each label."""
    if not texts:
        return Model(np.zeros(0, np.uint32), [], np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros(0, np.float32), np.zeros((0, 0), np.float32))
    letters, languages = alphabet(texts), sorted(set(labels))
    table, flags = symbol_table(letters), np.zeros(_SIZE, bool)
    taken: Counter = Counter()
    marked = []
    for i, label in enumerate(labels):
        if taken[label] < LANDMARKS:
            taken[label] += 1
            marked.append(i)
    used = np.zeros(_SIZE, bool)
    for i in marked:
        presence(texts[i], table, flags)
        used |= flags
    grams = np.flatnonzero(used)

    def rows_of(some: list[int]) -> tuple[np.ndarray, np.ndarray]:
        rows, sizes = np.zeros((len(some), len(grams)), np.float32), np.zeros(len(some), np.float32)
        for k, i in enumerate(some):
            presence(texts[i], table, flags)
            rows[k], sizes[k] = flags[grams], np.count_nonzero(flags)
        return rows, sizes

    marks, sizes = rows_of(marked)
    model = Model(letters, languages, grams, np.ascontiguousarray(marks.T), sizes, np.zeros((len(marked), len(languages)), np.float32))
    values, vectors = np.linalg.eigh(model.kernel(marks, sizes).astype(float))
    root = (vectors / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
    # of the rows only their kernels with the landmarks are held, some at a time
    features = np.concatenate([model.kernel(*rows_of(range(at, min(at + _BATCH, len(texts))))).astype(float) for at in range(0, len(texts), _BATCH)]) @ root
    target = np.array([[label == one for one in languages] for label in labels], float)
    share = np.array([1 / (len(languages) * labels.count(label)) for label in labels])[:, None]
    inner = features.T @ (features * share) + RIDGE * np.eye(len(marked))
    model.weights = (root @ np.linalg.solve(inner, features.T @ (target * share))).astype(np.float32)
    return model


def learn(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model from rows of `training` with a label and a text. Each label gives about SAMPLE rows, picked by a hash of
    doc_id and text against the label's count; one task fits on them, so the driver holds the model only. Rows with a null
    label, a null text or one without letters teach nothing; without any other there is a model that knows no language."""
    rows = docs.where(training & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return fit([], [])
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, SAMPLE / n)))])
    draw = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))
    sample = rows.where(draw < F.element_at(share, F.col("lang"))).select("text", F.col("lang").cast("string").alias("lang"), draw.alias("draw"))
    fitted = sample.repartition(1).mapInArrow(_fit_batches, "model binary").first()
    return pickle.loads(fitted["model"]) if fitted else fit([], [])


def _fit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted(((d, y, t) for b in batches for t, y, d in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True)))
    yield pa.record_batch([pa.array([pickle.dumps(fit([t for _, _, t in rows], [y for _, y, _ in rows]))], pa.binary())], ["model"])


_OUT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document row the language predicted from the whole text, and its regression value cut to 0 .. 1.

    `und` with score 0 for null, empty or letterless text, or if the model saw no label. Rows are judged one by one;
    other columns are ignored. Columns: doc_id, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few MB whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                part = batch.slice(at, _BATCH)
                found = shared.value.predict(part.column(1).to_pylist())
                yield pa.record_batch([part.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], schema=_OUT)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")

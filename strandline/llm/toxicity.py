"""Toxicity: a linear-chain conditional random field over words, its marginals summed up per document."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import WORD_BYTES, row_key, slices

#: Bounds of the labelled sample: about so many rows of each label.
SAMPLE_TOXIC, SAMPLE_CLEAN = 1000, 2000
#: A word or word start counts as toxic where chance explains its share of toxic settings with a probability under exp(-EVIDENCE).
EVIDENCE = 14.0
STARTS = (4, 5, 6, 7, 8)
#: Least rate in toxic text over the rate in clean text.
LIFT = 8.0
DIMENSIONS, SEGMENT, STEPS = 1 << 18, 64, 60
#: Documents tagged together, and words among them with their padding.
GROUP, CELLS = 192, 400_000


def text_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES).split()


def features(word: bytes) -> list[int]:
    parts = [b"w" + word, b"e" + word[-3:], *(b"s%d" % n + word[:n] for n in (3, *STARTS))]
    return [zlib.crc32(p) % DIMENSIONS for p in parts] + [0]


class Field:
    """States: clean and toxic. A word's toxic state weighs the sum of its features; transitions weigh four numbers."""

    def __init__(self) -> None:
        self.weights = np.zeros(DIMENSIONS)
        self.steps = np.array([0.0, -4.0, -1.0, 0.0])  # clean-clean, clean-toxic, toxic-clean, toxic-toxic
        self.level = np.array([0.0, 1.0, 0.0])  # intercept, logit of the largest marginal, log of the expected count

    def marginals(self, e: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Chance of the toxic state; e: words by documents, documents padded at the end. The messages of both
        directions are kept as ratios of the two states."""
        cc, ct, tc, tt = np.exp(self.steps)
        odds = np.exp(np.clip(e, -30, 30))
        ahead, back = np.empty_like(odds), np.empty_like(odds)
        r = np.full(odds.shape[1], ct / cc)
        for t in range(len(odds)):
            r = odds[t] * ((ct + tt * r) / (cc + tc * r) if t else r)
            ahead[t] = r
        b, last = np.ones(odds.shape[1]), lengths - 1
        for t in range(len(odds) - 1, -1, -1):
            if t < len(odds) - 1:
                x = odds[t + 1] * b
                b = np.where(t >= last, 1.0, (tc + tt * x) / (cc + ct * x))
            back[t] = b
        both = ahead * back
        return both / (1 + both)

    def pair_marginals(self, e: np.ndarray, lengths: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected counts of the four transitions."""
        cc, ct, tc, tt = np.exp(self.steps)
        odds = np.exp(np.clip(e, -30, 30))
        r = np.full(odds.shape[1], ct / cc)
        x = np.ones(odds.shape[1])
        ahead, out = np.empty_like(odds), np.zeros(4)
        for t in range(len(odds)):
            r = odds[t] * ((ct + tt * r) / (cc + tc * r) if t else r)
            ahead[t] = r
        b, last = np.ones(odds.shape[1]), lengths - 1
        for t in range(len(odds) - 2, -1, -1):
            x = odds[t + 1] * np.where(t + 1 >= last, 1.0, b)
            four = np.stack([np.full(len(x), cc), ct * x, ahead[t] * tc, ahead[t] * tt * x])
            out += ((four / four.sum(0)) * (t < last)).sum(1)
            b = (tc + tt * x) / (cc + ct * x)
        return out

    def fit(self, texts: list[str | None], toxic: list[int]) -> "Field":
        """Token labels come from the documents': in a toxic one, words that are, or start, as in toxic documents far
        beyond chance are toxic; all others are clean. Then penalised likelihood by Adam, over segments of SEGMENT words."""
        n_toxic = sum(toxic)
        if not 0 < n_toxic < len(toxic):
            self.level = np.array([4.0 if n_toxic else -4.0, 0.0, 0.0])
            return self
        types: dict[bytes, int] = {}
        tokens = [np.array([types.setdefault(w, len(types)) for w in text_words(text)], np.int32) for text in texts]
        seen = [self._settings([t for t, y in zip(tokens, toxic, strict=True) if y == side], len(types)) for side in (0, 1)]
        is_marked = self._marked(list(types), *seen)
        of_type = np.array([features(w) for w in types], np.int32).reshape(len(types), -1)
        pieces = [(part, y) for t, y in zip(tokens, toxic, strict=True) for part in np.split(t, range(SEGMENT, len(t), SEGMENT)) if len(part)]
        lengths = np.array([len(p) for p, _ in pieces])
        token, label = np.zeros((SEGMENT, len(pieces)), np.int32), np.zeros((SEGMENT, len(pieces)), np.float32)
        for k, (part, y) in enumerate(pieces):
            token[: len(part), k], label[: len(part), k] = part, is_marked[part] if y else 0
        real = np.arange(SEGMENT)[:, None] < lengths[None, :]
        inside = real[1:]
        pairs = label[:-1] * 2 + label[1:]
        seen_pairs = np.array([((pairs == v) & inside).sum() for v in (0, 1, 2, 3)], float)
        gold = np.bincount(token[real], label[real], len(types))
        total = np.concatenate([self.weights, self.steps])
        first, second = np.zeros_like(total), np.zeros_like(total)
        for step in range(1, STEPS + 1):
            e = self.weights[of_type].sum(1)[token]
            p = self.marginals(e, lengths)
            wrong = np.bincount(token[real], p[real], len(types)) - gold
            g = np.bincount(of_type.ravel(), np.repeat(wrong, of_type.shape[1]), DIMENSIONS) + 0.1 * self.weights
            g = np.concatenate([g, self.pair_marginals(e, lengths, p) - seen_pairs + 0.1 * self.steps])
            first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
            total = total - 0.25 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
            self.weights, self.steps = total[:DIMENSIONS].copy(), total[DIMENSIONS:].copy()
        by_type = self.weights[of_type].sum(1)
        self._fit_level([by_type[t] for t in tokens], np.array(toxic, float))
        return self

    @staticmethod
    def _settings(tokens: list[np.ndarray], n: int) -> np.ndarray:
        """For each word, the number of different pairs of neighbours it stands between; copies of a text count once."""
        triples = [np.zeros((0, 3), np.int64)]
        for t in tokens:
            round_it = np.concatenate([[-1], t, [-1]])
            triples.append(np.column_stack([round_it[:-2], t, round_it[2:]]))
        flat = np.concatenate(triples)
        mixed = (flat[:, 0] * 1_000_003 + flat[:, 1]) * 1_000_033 + flat[:, 2]
        return np.bincount(flat[np.unique(mixed, return_index=True)[1], 1], minlength=n)

    @staticmethod
    def _marked(words: list[bytes], clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        """Of each word, whether it, or a start of it, stands in toxic documents in more settings than chance explains."""
        n_clean, n_toxic = max(int(clean.sum()), 1), int(toxic.sum())
        prior, out = n_toxic / (n_toxic + n_clean), np.zeros(len(words), bool)
        for n in (None, *STARTS):
            starts: dict[bytes, int] = {}
            key = np.array([starts.setdefault(w[:n], len(starts)) for w in words], np.int64)
            a, b = (np.bincount(key, side, len(starts)) for side in (toxic, clean))
            q = np.clip(a / np.maximum(a + b, 1), 1e-12, 1 - 1e-12)
            spread = q * np.log(q / prior) + (1 - q) * np.log((1 - q) / (1 - prior))
            out |= ((a >= 3) & (a * n_clean > LIFT * b * n_toxic) & ((a + b) * spread > EVIDENCE))[key]
        return out

    def _fit_level(self, emissions: list[np.ndarray], toxic: np.ndarray) -> None:
        """Logistic regression of the document label on the marginals, by Newton steps."""
        x = np.array([summary(p) for p in self.tag(emissions)])
        x = np.column_stack([np.ones(len(x)), x])
        beta = np.zeros(3)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            h = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3)
            beta = beta + np.linalg.solve(h, x.T @ (toxic - p) - 0.05 * beta)
        self.level = beta

    def tag(self, emissions: list[np.ndarray]) -> list[np.ndarray]:
        """Marginals of every word of every document; documents of like length go together, GROUP and CELLS at most, so
        that memory follows the longest text alone."""
        out: list[np.ndarray] = [np.zeros(0)] * len(emissions)
        order = sorted((i for i in range(len(emissions)) if len(emissions[i])), key=lambda i: len(emissions[i]))
        while order:
            longest = len(emissions[order[-1]])
            many = max(1, min(GROUP, CELLS // longest))
            order, group = order[:-many], order[-many:]
            lengths = np.array([len(emissions[i]) for i in group])
            e = np.full((lengths.max(), len(group)), -30.0)
            for k, i in enumerate(group):
                e[: lengths[k], k] = emissions[i]
            p = self.marginals(e, lengths)
            for k, i in enumerate(group):
                out[i] = p[: lengths[k], k]
        return out

    def score(self, marginals: np.ndarray) -> float:
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, float(self.level @ np.array([1.0, *summary(marginals)])))))))


class Emissions(dict):
    """Word to weight; forgets all when it grows large."""

    def __init__(self, weights: np.ndarray) -> None:
        super().__init__()
        self.weights = weights

    def of(self, text: str | None) -> np.ndarray:
        words = text_words(text)
        return np.fromiter(map(self.__getitem__, words), float, len(words))

    def __missing__(self, word: bytes) -> float:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = float(self.weights[features(word)].sum())
        return value


def summary(p: np.ndarray) -> tuple[float, float]:
    """Logit of the largest marginal, and log of the expected number of toxic words among those with a chance of a tenth."""
    most = float(p.max()) if len(p) else 0.0
    most = min(max(most, 1e-5), 1 - 1e-5)
    return math.log(most / (1 - most)), math.log1p(float(p[p > 0.1].sum()) if len(p) else 0.0)


def learn(docs: DataFrame, labels: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Field:
    """A field fitted on a sample of the labelled rows for which `training` (on doc_id) holds. Ids are drawn from the
    labels by a hash against each label's count, so the sample and its broadcast stay within the documented bounds."""
    known = labels.where(training & F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(label).alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {1: min(1.0, SAMPLE_TOXIC / counts.get(1, 1)), 0: min(1.0, SAMPLE_CLEAN / counts.get(0, 1))}
    draw = F.xxhash64("doc_id", F.lit(9)).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))
    sample = known.where(draw < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(sample), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("text", "toxic")).alias("_row")).select("doc_id", "_row.*")  # of an id given twice, one text
    fitted = rows.select("doc_id", "text", "toxic").repartition(1).mapInArrow(_fit_batches, "weights binary, steps array<double>, level array<double>").first()
    field = Field()
    if fitted is None:  # no labelled rows, no task
        return field.fit([], [])
    field.weights = np.frombuffer(fitted["weights"], float).copy()
    field.steps, field.level = np.array(fitted["steps"]), np.array(fitted["level"])
    return field


def _fit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task fits on the bounded sample, so that the driver holds the model only."""
    rows = sorted(((i, t, y) for b in batches for i, t, y in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True)), key=lambda r: r[0])
    field = Field().fit([t for _, t, _ in rows], [y for _, _, y in rows])
    yield pa.record_batch([pa.array([field.weights.tobytes()], pa.binary()), pa.array([field.steps.tolist()]), pa.array([field.level.tolist()])], ["weights", "steps", "level"])


_SPAN = "array<struct<start:long,end:long,chance:double>>"
_OUT = pa.schema([("doc_id", pa.int64()), ("_key", pa.int64()), ("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("chance", pa.float64())])))])


def _spans(text: str, marginals: np.ndarray) -> list[dict]:
    """Code-point offsets of the words that are likelier toxic than not; neighbours are one span with the larger chance."""
    bad = set(np.flatnonzero(marginals > 0.5).tolist())
    if not bad:
        return []
    raw = text.encode("utf-8", "replace")
    points = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])  # code points before each byte
    out, last = [], -2
    for i, m in enumerate(re.finditer(rb"[^ \t-\r]+", raw.translate(WORD_BYTES))):
        if i in bad:
            start, end = (int(points[x]) for x in m.span())
            if i == last + 1:
                out[-1] = {"start": out[-1]["start"], "end": end, "chance": max(out[-1]["chance"], float(marginals[i]))}
            else:
                out.append({"start": start, "end": end, "chance": float(marginals[i])})
            last = i
    return out


def score_toxicity(docs: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document row: the chance that it is toxic, from the marginals over its whole text, and the offending spans.

    Null or empty text has no words and the score of a document without toxic words. Rows are scored one by one, so
    ties and repeated rows need no care; a long text takes memory in proportion to its words; other columns are ignored.
    Columns: doc_id, _key (row_key of doc_id and text), score, spans (code-point start and end, chance)."""
    shared = docs.sparkSession.sparkContext.broadcast(field)  # 2 MB whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, emissions = shared.value, Emissions(shared.value.weights)
        for batch in batches:
            for part in slices(batch, 1):
                texts = part.column(1).to_pylist()
                found = model.tag([emissions.of(t) for t in texts])
                spans = [_spans(t or "", p) for t, p in zip(texts, found, strict=True)]
                yield pa.record_batch([part.column(0), part.column(2), pa.array([model.score(p) for p in found], pa.float64()), pa.array(spans, _OUT.field(3).type)], schema=_OUT)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.withColumn("_key", row_key("doc_id", "text")).mapInArrow(run, f"doc_id long, _key long, score double, spans {_SPAN}")


def keep_clean(docs: DataFrame, field: Field, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows scored below the threshold, with all their columns; the texts are scored where they are read."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    schema, at = docs.schema, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, emissions = shared.value, Emissions(shared.value.weights)
        for batch in batches:
            for part in slices(batch, at):
                found = model.tag([emissions.of(x.as_py()) for x in part.column(at)])
                yield part.filter(pa.array([model.score(p) < threshold for p in found], pa.bool_()))

    return docs.mapInArrow(run, schema)

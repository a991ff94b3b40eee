"""Near-duplicate documents by SetSketch registers: banded, estimated jointly by likelihood, then verified."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandline.llm.common import components, cut, release, row_key

SHINGLE = 5
REGISTERS, BAND, BANDS = 128, 4, 32
#: Base and rate of the registers: floor(1 - log_BASE(h)) for the least of n exponential variates h of rate RATE stays
#: within two bytes. Unrelated sets agree in a register with a chance of 5e-4, in a band with 6e-14, so that the
#: candidates grow with the near duplicates and not with the square of the documents (at a base of 1.1: 5e-6).
BASE, RATE = 1.001, 20.0
#: Of 100 in the union, so many in the intersection.
PERCENT = 75
#: Standard errors by which a pair's estimate may fall short before it is given up unverified.
ERRORS = 4.0

_rng = np.random.default_rng(20240601)
_MULTIPLY = (_rng.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_ADD = _rng.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)[:, None]
_PLACE = (_rng.integers(0, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).tolist()


class WordHashes(dict):
    """Word to 64-bit hash; forgets all when it grows large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(text: str | None, known: WordHashes) -> np.ndarray:
    """Hashes of the words in order: A-Z lower-cased, split at ASCII white space."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of `size` words."""
    n = len(hashes) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(size if n > 0 else 0):
        out += hashes[k : k + n] * np.uint64(_PLACE[k])
    return mixed(out)


def shingle_set(text: str | None, known: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words; of fewer words, of the whole sequence."""
    hashes = word_hashes(text, known)
    return np.unique(runs(hashes, min(size, len(hashes)))) if len(hashes) else hashes


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch: for each register, the truncated logarithm of the least variate. Register-wise maxima merge sketches."""
    low = np.full(REGISTERS, (1 << 32) - 1, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 2048):
        np.minimum(low, (x[None, at : at + 2048] * _MULTIPLY + _ADD).min(axis=1), out=low)
    least = -np.log1p(-(low + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(least) / np.log(BASE)), 0, 65535).astype(np.uint16)


_SKETCH = pa.schema([("doc_id", pa.int64()), ("_key", pa.int64()), ("n", pa.int64()), ("same", pa.binary()), ("registers", pa.binary())])


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for batch in batches:
        n, same, sketches = [], [], []
        for text in batch.column(1):  # doc_id, text, _key
            shingles = shingle_set(text.as_py(), known)
            n.append(len(shingles))
            same.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
            sketches.append(registers(shingles).tobytes())
        yield pa.record_batch([batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(same, pa.binary()), pa.array(sketches, pa.binary())], schema=_SKETCH)


def _log_p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def jaccard(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of pairs of sketches (rows of registers) of sets of known sizes."""
    more, less = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    equal = a.shape[1] - more - less
    u, v = (n_a / (n_a + n_b))[:, None], (n_b / (n_a + n_b))[:, None]
    grid = np.linspace(0, 1, 201)[None, :] * np.minimum(u / v, v / u)
    up, down = _log_p(np.maximum(u - v * grid, 0)), _log_p(np.maximum(v - u * grid, 0))
    tiny = 1e-12
    chance = more * np.log(up + tiny) + less * np.log(down + tiny) + equal * np.log(np.maximum(1 - up - down, 0) + tiny)
    return np.take_along_axis(grid, chance.argmax(1)[:, None], 1)[:, 0]


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _likely_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    floor = PERCENT / 100 - ERRORS * (0.25 * PERCENT / 100 / REGISTERS) ** 0.5
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for k in (2, 3))
        n_a, n_b = (batch.column(k).to_numpy().astype(float) for k in (4, 5))
        estimate = jaccard(a, b, n_a, n_b)
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(estimate)], ["a", "b", "estimate"]).filter(pa.array(estimate >= floor))


def _token_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            x = shingle_set(text.as_py(), known)
            yield pa.record_batch([pa.array(x.view(np.int64)), pa.array(np.full(len(x), i))], ["token", "id"])


def prefixes(tokens: DataFrame, sets: DataFrame) -> DataFrame:
    """Of tokens (token, id), in the order of their counts, the first of each set: one more than may be missing from the
    smallest intersection that links. Tokens that one set alone holds come first and meet nothing, so only the others are
    placed behind them. `sets` has id and the size n."""
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    of = Window.partitionBy("id")
    shared = tokens.join(counts, "token").withColumns({"_r": F.row_number().over(of.orderBy("holders", "token")), "_m": F.count(F.lit(1)).over(of)})
    placed = shared.join(sets, "id").withColumn("place", F.col("n") - F.col("_m") + F.col("_r") - 1)
    return placed.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * PERCENT / 100)).drop("_r", "_m", "holders")


def _linked_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, last = WordHashes(), (None, None)
    for batch in batches:
        keep = []
        for a, left, right in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
            if a != last[0] or a is None:
                last = (a, shingle_set(left.as_py(), known))
            x, y = last[1], shingle_set(right.as_py(), known)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield pa.record_batch([batch.column(0), batch.column(1)], schema=_PAIR).filter(pa.array(keep, pa.bool_()))


def bands(registers: Column) -> Column:
    """One key for each band of BAND registers."""
    return F.array(*[F.xxhash64(F.lit(i), F.substring(registers, i * BAND * 2 + 1, BAND * 2)) for i in range(BANDS)])


def _near(a: str, b: str) -> Column:
    return F.col(a) * 100 >= F.col(b) * PERCENT


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document row: size of its set of 5-word shingles, the smallest doc_id of its component, and whether it is that.

    Equal sets form a class. Sketches of classes meet in bands, where each is compared with the member that meets
    most others in its bands; of a class's comparisons the likeliest by the registers is verified on the full sets. Classes of bands that still hold several components are joined exactly: sets linked share one of their
    PERCENT-prefixes of rarest shingles, at places that leave room for the intersection.

    Texts without words (null, empty) have no shingles and stand alone. A null doc_id joins its class; a component
    without any id is null. Repeated rows and rows that share an id are members like others. Other columns are ignored.
    Columns: doc_id, n_shingles, component_id, kept, _key (row_key of doc_id and text)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("_key", row_key("doc_id", "text"))
    sketches = cut(rows.mapInArrow(_sketch_batches, "doc_id long, _key long, n long, same binary, registers binary"))
    classes = sketches.where("n > 0").groupBy("same").agg(
        F.min("doc_id").alias("least_id"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key")).alias("rep"),
        F.first("n").alias("n"), F.first("registers").alias("registers"),
    )
    classes = cut(classes.withColumn("id", F.monotonically_increasing_id()))
    keyed = classes.select("id", "n", F.explode(bands(F.col("registers"))).alias("band"))
    shared = keyed.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = cut(keyed.join(shared, "band"))
    met = members.groupBy("id").agg(F.sum("size").alias("met"))
    centres = members.join(met, "id").groupBy("band").agg(F.max(F.struct("met", -F.col("id"), "id")).alias("c")).select("band", F.col("c.id").alias("centre"))
    wanted = classes.join(members.select("id").distinct(), "id", "left_semi").select("id", F.col("rep._key").alias("_key"), F.col("rep.doc_id").alias("_id"))
    texts = rows.join(cut(wanted).hint("merge"), "_key").where(F.col("doc_id").eqNullSafe(F.col("_id")))
    # written, so that the joins below have plain shuffles on either side and a centre with many members is split
    texts = cut(texts.select("id", "text").dropDuplicates(["id"]))
    side = classes.select("id", "n", "registers")

    def likely(pairs: DataFrame) -> DataFrame:
        for s in "ab":
            pairs = pairs.join(side.select(F.col("id").alias(s), F.col("registers").alias(f"r{s}"), F.col("n").alias(f"n{s}")), s)
        pairs = pairs.where(_near("na", "nb") & _near("nb", "na")).select("a", "b", "ra", "rb", "na", "nb")
        return pairs.mapInArrow(_likely_batches, "a long, b long, estimate double")

    def verified(pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b), those that are links."""
        for s in "ba":
            pairs = pairs.join(texts.select(F.col("id").alias(s), F.col("text").alias(f"t{s}")), s)
        return cut(pairs.select("a", "b", "ta", "tb").mapInArrow(_linked_batches, "a long, b long"))

    def labelled(frame: DataFrame, roots: DataFrame, node: str, name: str) -> DataFrame:
        label = roots.select(F.col("node").alias(node), F.col("root").alias("_root"))
        return frame.join(label, node, "left").withColumn(name, F.coalesce("_root", node)).drop("_root")

    starred = members.join(centres, "band").where("centre <> id").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    links = verified(likely(starred).groupBy("b").agg(F.max_by("a", "estimate").alias("a")).select("a", "b"))
    roots = components(links)
    placed = labelled(members, roots, "id", "comp")
    several = placed.groupBy("band").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least <> most")
    rest = cut(placed.join(several.select("band"), "band").select("id", "n", "comp").distinct())
    open_texts = texts.join(rest.select("id"), "id", "left_semi")
    placed = prefixes(open_texts.mapInArrow(_token_batches, "token long, id long"), rest)
    x, y = (placed.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("id", "place", "n", "comp")]).alias(s) for s in "ab")
    room = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) * (100 + PERCENT) >= (F.col("n_a") + F.col("n_b")) * PERCENT
    meet = (F.col("a.token") == F.col("b.token")) & (F.col("id_a") < F.col("id_b")) & (F.col("comp_a") != F.col("comp_b")) & room
    more = verified(x.join(y, meet).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct())
    if not more.isEmpty():  # these join components
        between = labelled(labelled(more, roots, "a", "ra"), roots, "b", "rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        up = components(between).select(F.col("node").alias("root"), F.col("root").alias("_up"))
        alone = between.select(F.col("a").alias("node")).union(between.select("b")).distinct().join(roots, "node", "left_anti").select("node", F.col("node").alias("root"))
        roots = cut(roots.union(alone).join(up, "root", "left").select("node", F.coalesce("_up", "root").alias("root")))
    release(texts, members, rest)
    named = classes.select("same", "id", "least_id").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component"))
    out = sketches.select("doc_id", "_key", "n", "same").join(named.join(least, "root").select("same", "component"), "same", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "_key")

"""Target-distribution importance resampling: bucket histograms of word runs, log gains, and a draw with random keys."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from strandline.llm.common import NOT_WORD, cut, slices
from strandline.llm.sharding import numbered

#: Characters after which a long text is split at the next boundary between words.
PIECE = 1_000_000
#: Runs whose bucket a task remembers.
REMEMBERED = 400_000
_GAP = re.compile(NOT_WORD)


def _pieces(text: str, size: int) -> Iterator[str]:
    """The text in parts of about `size` characters, parted between words."""
    start = 0
    while len(text) - start > size:
        gap = _GAP.search(text, start + size)
        if not gap:
            break
        yield text[start : gap.end()]
        start = gap.end()
    yield text[start:]


class _Buckets(dict):
    """Bucket of each run; forgets all when it holds too many."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, run: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        bucket = self[run] = zlib.crc32(run.encode()) % self.buckets
        return bucket


def features(text: str | None, splitter: pre_tokenizers.Split, buckets: _Buckets, longest: int, piece: int = PIECE) -> tuple[int, np.ndarray]:
    """(words, buckets of all runs of 1 to `longest` words). A run is the stretch from the first word's start offset to the
    last one's end offset; where more than a blank lies between words, the words are joined anew."""
    n_words, out, carried = 0, [], []
    for part in _pieces((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"), piece):
        split = splitter.pre_tokenize_str(part)
        n_words += len(split)
        out += [buckets[word] for word, _ in split]
        if longest > 1:
            before, split = len(carried), carried + [(word, part, span) for word, span in split]
            for k in range(2, longest + 1):
                for i in range(max(0, before - k + 1), len(split) - k + 1):
                    (_, source, (a, _)), (_, last, (_, b)) = split[i], split[i + k - 1]
                    plain = source is last and all(split[j + 1][2][0] - split[j][2][1] == 1 for j in range(i, i + k - 1)) and source.count(" ", a, b) == k - 1
                    out.append(buckets[source[a:b] if plain else " ".join(x[0] for x in split[i : i + k])])
            carried = split[len(split) - longest + 1 :] if len(split) >= longest else split
    return n_words, np.array(out, np.int64)


def packed(rows: DataFrame, buckets: int, longest: int) -> DataFrame:
    """(doc_id, text) to (doc_id, n_words, n_features, packed): the buckets of all runs as two or four bytes each."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32
    schema = rows.select("doc_id").withColumns({"n_words": F.lit(0).cast("long"), "n_features": F.lit(0).cast("long"), "packed": F.lit(b"")}).schema

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = pre_tokenizers.Split(Regex("[^" + NOT_WORD[1:-2] + "]+"), behavior="removed", invert=True)
        known = _Buckets(buckets)
        for whole in batches:
            for batch in slices(whole, 1):
                found = [features(x.as_py(), splitter, known, longest) for x in batch.column(1)]
                yield pa.record_batch([
                    batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([len(f) for _, f in found], pa.int64()),
                    pa.array([f.astype(kind).tobytes() for _, f in found], pa.binary())], ["doc_id", "n_words", "n_features", "packed"])

    return rows.select("doc_id", "text").mapInArrow(pack, schema)


def histogram(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) over all packed rows. A task adds up its own counts first, so `buckets` rows leave it at most."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    return rows.select("packed").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> list[int]:
    """floor(1000 * ln(share in target / share in source)) of every bucket, both smoothed by one; `buckets` numbers."""
    spark = source.sparkSession
    both = spark.range(buckets).withColumnRenamed("id", "bucket")
    for name, counts in (("s", source), ("t", target)):
        both = both.join(counts.withColumnRenamed("n", name), "bucket", "left").fillna(0, [name])
    both = cut(both)
    totals = both.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    times = lambda n, total: (F.col(n) + 1).cast("double") * (total + buckets)
    value = F.floor(1000 * F.log(times("t", totals["s"]) / times("s", totals["t"]))).cast("long")
    return [r["gain"] for r in both.select("bucket", value.alias("gain")).orderBy("bucket").collect()]  # as many as the parameter says


def weighed(rows: DataFrame, gain: list[int]) -> DataFrame:
    """Packed rows with `weight`, the floored mean of their runs' gains; 0 without runs."""
    kind, table = np.uint16 if len(gain) <= 1 << 16 else np.uint32, np.array(gain, np.int64)
    schema = rows.drop("packed").withColumn("weight", F.lit(0).cast("long")).schema

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy()
            ends = np.concatenate([[0], np.cumsum(n)])
            sums = np.concatenate([[0], np.cumsum(table[np.frombuffer(b"".join(batch.column(3).to_pylist()), kind)])])
            weight = (sums[ends[1:]] - sums[ends[:-1]]) // np.maximum(n, 1)
            yield pa.record_batch([*batch.columns[:3], pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(weigh, schema)


def random_key(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate, fixed by seed and doc_id (null as empty text)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, *, percent: int = 10, least_words: int = 20, buckets: int = 10_000, longest: int = 1,
             seed: int = 2024, doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """Every document row with its weight towards the target's distribution; the `percent` of those of `least_words` or
    more with the highest weight plus random key have a rank (from 1, ties to the smaller doc_id, null first).

    Null and empty texts have no words: weight 0, no rank; long texts are read whole, in pieces; equal rows get equal
    scores and ranks of their own; other columns are ignored. An empty target counts nothing, so that all buckets are
    taken as equally likely; no documents give no rows.
    Columns: doc_id, n_features, weight, score, rank."""
    rows = cut(packed(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), buckets, longest))
    wanted = packed(target.select(F.lit(0).alias("doc_id"), F.col(target_text).alias("text")), buckets, longest)
    gain = gains(histogram(rows, buckets), histogram(wanted, buckets), buckets)
    scored = weighed(rows, gain).withColumn("score", F.col("weight") + random_key(F.col("doc_id"), seed))
    drawn = rows.where(F.col("n_words") >= least_words).count() * percent // 100
    scored = scored.withColumns({"_short": F.col("n_words") < least_words, "_down": -F.col("score")})
    placed = numbered(scored, ["_short", "_down", "doc_id", "n_features"], "_place")
    rank = F.when(F.col("_place") < drawn, F.col("_place") + 1).cast("long")
    return placed.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))

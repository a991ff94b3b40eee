"""What the operators share: lineage cuts, row keys, word columns and connected components."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of digits, letters and everything beyond ASCII, after lower-casing A-Z.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same for bytes.translate: other ASCII bytes become blanks.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


#: Spark removes the shuffle files of an execution that ends with this set.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """The rows as written to the shared checkpoint folder: computed once, safe against lost executors. The shuffle files
    that led to them are removed, as nothing reads them again."""
    spark, context = df.sparkSession, df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", "")
        if not folder and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp())
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # the setting holds for plans made from here on
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of any store that Spark writes to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def release(*frames: DataFrame) -> None:
    """Remove the files of frames that cut() returned, once everything that reads them is written itself."""
    for df in frames:
        name = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if name.isDefined():
            remove(df.sparkSession, name.get())


def cut_bare(df: DataFrame) -> DataFrame:
    """cut() for loops: without the size that Spark estimates of a plan that was cut. A join multiplies the sizes of both sides,
    so where each round joins what the rounds before have cut, the number doubled its digits with every join, in the driver."""
    spark, rdd = df.sparkSession, cut(df)._jdf.queryExecution().logical().rdd()
    schema = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(df.schema.json())
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rdd, schema, False), spark)


def row_key(*columns: Column) -> Column:
    """Equal for equal rows, never null."""
    return F.xxhash64(*columns)


def words(text: Column) -> Column:
    """Array of the words of NOT_WORD's complement; empty for null."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NOT_WORD)
    return F.filter(parts, lambda w: w != "")


def components(links: DataFrame) -> DataFrame:
    """(a, b) links to (node, root): the smallest node reachable. Each round hooks every node to the smallest of its
    neighbourhood, follows the hooks to their ends and contracts the links, so at least half of the nodes go."""
    live = cut_bare(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    roots = None
    while not live.isEmpty():
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = cut_bare(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")))
        while True:
            further = hook.select(F.col("node").alias("root"), F.col("root").alias("_next"))
            jumped = cut_bare(hook.join(further, "root").select("node", F.col("_next").alias("root"), (F.col("root") != F.col("_next")).alias("_moved")))
            hook = jumped.select("node", "root")
            if jumped.where("_moved").isEmpty():
                break
        a, b = (hook.select(F.col("node").alias(x), F.col("root").alias(f"_{x}")) for x in "ab")
        live = cut_bare(live.join(a, "a").join(b, "b").where("_a <> _b").select(F.greatest("_a", "_b").alias("a"), F.least("_a", "_b").alias("b")).distinct())
        if roots is None:
            roots = hook
        else:
            up = hook.select(F.col("node").alias("root"), F.col("root").alias("_up"))
            roots = cut_bare(roots.join(up, "root", "left").select("node", F.coalesce("_up", "root").alias("root")))
    return roots if roots is not None else links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)


def slices(batch: pa.RecordBatch, column: int, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about `size` bytes of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64) // size
    cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)

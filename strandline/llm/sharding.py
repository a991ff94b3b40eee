"""Reproducible shuffle into shards: a Feistel permutation of global row numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandline.llm.common import cut

ROUNDS = 6


def _sides(n: int) -> tuple[int, int]:
    """A grid of a x b >= n cells, less than one row of cells too large."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _round(value: Column, key: Column) -> Column:
    """A number from 0 to 2**32 - 1."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", key.cast("string"), value.cast("string"))), 1, 8), 16, 10).cast("long")


def permuted(position: Column, n: int, seed: int, rounds: int = ROUNDS) -> Column:
    """One pass of the Feistel network over 0 .. a * b - 1; alternate rounds add to the row and to the column of the grid."""
    a, b = _sides(n)
    keys = F.array(*[F.lit(seed * 1000 + i) for i in range(rounds)])

    def step(s: Column, key: Column) -> Column:
        row, column = s["row"], s["column"]
        even = key % 2 == 0
        return F.struct(
            F.when(even, (row + _round(column, key)) % a).otherwise(row).alias("row"),
            F.when(even, column).otherwise((column + _round(row, key)) % b).alias("column"),
        )

    start = F.struct(F.floor(position / F.lit(b)).cast("long").alias("row"), (position % b).alias("column"))
    return F.aggregate(keys, start, step, lambda s: s["row"] * b + s["column"])


def feistel(df: DataFrame, position: str, n: int, seed: int, out: str) -> DataFrame:
    """Column `out`: the permuted place of `position` among 0 .. n - 1. Places beyond n walk on along their cycle; less
    than one grid row of cells lies beyond, so few do, and the loop ends when none is left."""
    df = df.withColumn(out, permuted(F.col(position), n, seed))
    while df.where(F.col(out) >= n).limit(1).count():
        df = df.withColumn(out, F.when(F.col(out) >= n, permuted(F.col(out), n, seed)).otherwise(F.col(out)))
    return df


def numbered(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Column `out`: the row's number from 0 in the order of all of `order`. A range shuffle and one sum per partition;
    no task sees more than its range. Rows equal in `order` are interchangeable."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = cut(ranged.withColumn("_at", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return ranged.join(offsets, "_part").withColumn(out, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_at", "_before")


def shard(docs: DataFrame, shards: int = 40, seed: int = 7, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row gets the shard and slot of its permuted row number p: shard p mod `shards`, slot p div `shards`, so
    shard sizes are at most one row apart and slots have no gaps.

    Rows are numbered by doc_id (null first), checksum and size. Null text: 16 bytes, checksum 0. Equal rows each get
    a place of their own. No rows: no rows. Other columns are ignored.
    Columns: doc_id, size, text_crc32, row_number, place, shard, slot."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    rows = numbered(rows, ["doc_id", "text_crc32", "size"], "row_number")
    total = rows.count()
    placed = feistel(rows, "row_number", total, seed, "place")
    return placed.select(
        "doc_id", "size", "text_crc32", "row_number", "place",
        (F.col("place") % shards).cast("int").alias("shard"), F.floor(F.col("place") / F.lit(shards)).cast("long").alias("slot"),
    )

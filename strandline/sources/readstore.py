"""Reads stored by place, so that a query on regions only opens what lies near them.

A store has one folder per (reach, chromosome, tile) and rows in order of start
within a file. Nearly all reads are shorter than the first reach and lie in
tiles of a megabase; the few that span more have tiles of their own size, so
they do not widen the search for the others. A region needs the tiles from its
start less the reach to its end; within their files the statistics of start and
end let row groups be skipped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: longest span of each reach; the last has no bound but that of a chromosome
REACHES = (1 << 16, 1 << 28)
#: bits of a tile of the first reach; those of the second are eight wider
TILE_BITS = 20
_WIDER = 8
_BLOCK = 16 << 20


def _bits(reach: int, tile_bits: int) -> int:
    return tile_bits + _WIDER * reach


def store_reads(reads: DataFrame, path: str, *, tile_bits: int = TILE_BITS) -> None:
    """Write reads (chrom, start, end, ...) into a new store; ``tile_bits`` is part of the store's name for its readers."""
    span = F.col("end") - F.col("start")
    too_long = F.raise_error(F.concat(F.lit("read of more bases than any chromosome has: "), span.cast("string"))).cast("int")
    reach = F.when(span <= REACHES[0], 0).when(span <= REACHES[1], 1).otherwise(too_long)
    bits = f"CASE reach WHEN 0 THEN {_bits(0, tile_bits)} ELSE {_bits(1, tile_bits)} END"
    rows = reads.withColumn("reach", reach).withColumn("tile", F.expr(f"shiftright(start, {bits})"))
    order = ["chrom", "reach", "tile", "start"]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("reach", "chrom", "tile").option(
        "parquet.block.size", _BLOCK).parquet(f"{path}/bits={tile_bits}")


def stored_reads(spark: SparkSession, path: str, *, tile_bits: int = TILE_BITS) -> DataFrame:
    """All reads of a store with their place columns."""
    return spark.read.parquet(f"{path}/bits={tile_bits}")


def _tiles(reach: int, start: Column, end: Column, tile_bits: int) -> tuple[Column, Column]:
    width = F.lit(1 << _bits(reach, tile_bits))
    return F.floor((start - REACHES[reach]) / width), F.floor(end / width)


def region_reads(spark: SparkSession, path: str, chrom: str, start: int, end: int, *, tile_bits: int = TILE_BITS) -> DataFrame:
    """Reads that touch one region or end right before it."""
    rows = stored_reads(spark, path, tile_bits=tile_bits)
    near = []
    for reach in range(len(REACHES)):
        low, high = _tiles(reach, F.lit(start), F.lit(end), tile_bits)
        near.append((F.col("reach") == reach) & F.col("tile").between(low, high))
    place = (F.col("chrom") == chrom) & reduce(lambda a, b: a | b, near)
    return rows.where(place & (F.col("start") < end) & (F.col("end") >= start)).drop("reach", "tile")


def nearby_reads(spark: SparkSession, path: str, regions: DataFrame, *, tile_bits: int = TILE_BITS) -> DataFrame:
    """Reads of all tiles that any of the regions needs; joins and counts with the regions then read no others.

    The tiles are listed before the scan is planned: one row per tile of the
    genome at most, some thousands at the default width.
    """
    every = None
    for reach in range(len(REACHES)):
        low, high = _tiles(reach, F.col("start"), F.col("end"), tile_bits)
        rows = regions.where("chrom IS NOT NULL AND end >= start").select(
            F.lit(reach).alias("reach"), "chrom", F.explode(F.sequence(low, high)).alias("tile")).distinct()
        every = rows if every is None else every.unionByName(rows)
    wanted: dict[tuple, list] = {}
    for row in every.collect():
        wanted.setdefault((row["reach"], row["chrom"]), []).append(row["tile"])
    rows = stored_reads(spark, path, tile_bits=tile_bits)
    tests = [(F.col("reach") == reach) & (F.col("chrom") == chrom) & F.col("tile").isin(tiles)
             for (reach, chrom), tiles in sorted(wanted.items())]
    if not tests:
        return rows.where(F.lit(False)).drop("reach", "tile")
    return rows.where(reduce(lambda a, b: a | b, tests)).drop("reach", "tile")

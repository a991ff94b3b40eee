"""Sequence of regions from a stored genome."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions.sequence import reverse_complement

TILE = 10_000


def tiled(sequences: DataFrame, size: int = TILE) -> DataFrame:
    """(chrom, tile, piece) from whole sequences, ``size`` letters a piece."""
    count = F.ceil(F.length("sequence") / F.lit(size)).cast("int")
    tiles = sequences.where(F.length("sequence") > 0).withColumn("tile", F.explode(F.sequence(F.lit(0), count - 1)))
    return tiles.select("chrom", F.col("tile").cast("long").alias("tile"),
                        F.substr("sequence", F.col("tile") * size + 1, F.lit(size)).alias("piece"))


def store_genome(sequences: DataFrame, table: str, path: str, *, size: int = TILE, buckets: int = 64) -> DataFrame:
    """Write a genome once as a table bucketed by (chromosome, tile) and read it back.

    Fetching joins on the same columns, so only the regions move: they are
    dealt to the buckets, the genome stays where it lies.
    """
    tiled(sequences, size).write.bucketBy(buckets, "chrom", "tile").sortBy("chrom", "tile").option(
        "path", path).saveAsTable(table)
    return sequences.sparkSession.table(table)


def fetch(regions: DataFrame, tiles: DataFrame, size: int = TILE, *, zero_based: bool = True) -> DataFrame:
    """The ``end - start`` letters of every region, reverse complemented on ``-``.

    ``start`` counts from 0, or from 1 with ``zero_based=False``. A region takes
    only its own letters from each tile before they are gathered, so the row
    that gathers them is as long as the region.
    """
    begin = F.col("start") if zero_based else F.col("start") - 1
    stop = begin + F.col("end") - F.col("start")
    wanted = regions.where("end > start").select(
        "id", "chrom", "start", "end", "strand", begin.alias("_begin"), stop.alias("_stop"),
        F.explode(F.sequence(F.floor(begin / size), F.floor((stop - 1) / size))).alias("tile"))
    low = F.col("tile") * size
    from_ = F.greatest(F.col("_begin") - low, F.lit(0))
    upto = F.least(F.col("_stop") - low, F.lit(size))
    parts = wanted.join(tiles, ["chrom", "tile"]).select(
        "id", "chrom", "start", "end", "strand", "tile", F.substr("piece", from_ + 1, upto - from_).alias("piece"))
    cells = F.array_sort(F.collect_list(F.struct("tile", "piece")))
    text = parts.groupBy("id", "chrom", "start", "end", "strand").agg(
        F.array_join(F.transform(cells, lambda c: c["piece"]), "").alias("sequence"))
    return text.where(F.length("sequence") > 0).withColumn(
        "sequence", F.when(F.col("strand") == "-", reverse_complement("sequence")).otherwise(F.col("sequence")))


def fasta_lines(fetched: DataFrame, genome: str, *, use_id: bool = False) -> DataFrame:
    """Header and sequence line of every region."""
    place = F.concat_ws("|", F.lit(genome.lower()), "chrom", F.col("start").cast("string"),
                        F.col("end").cast("string"), "strand")
    head = F.concat(F.lit(">"), F.col("id") if use_id else place)
    return fetched.select("id", F.posexplode(F.array(head, F.col("sequence"))).alias("line_no", "line"))

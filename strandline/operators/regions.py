"""Generators of region sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import loci


def chrom_tiles(chrom_sizes: DataFrame, bin_size: int) -> DataFrame:
    """Tiles ``bin_n`` from base 1 on; an end reaches ``bin_size`` past its start."""
    starts = F.sequence(F.lit(1).cast("long"), F.greatest(F.lit(1), F.col("length") - 1), F.lit(bin_size).cast("long"))
    tiles = chrom_sizes.where("length > 1").select("chrom", F.posexplode(starts).alias("_i", "start"))
    return tiles.select(
        "chrom", F.concat(F.lit("bin_"), (F.col("_i") + 1).cast("string")).alias("id"),
        "start", (F.col("start") + bin_size).alias("end"), F.lit(".").alias("strand"))


def _kind(starts: DataFrame, kind: str, start: Column, end: Column) -> DataFrame:
    return starts.select("id", "chrom", F.lit(kind).alias("kind"), start.cast("long").alias("start"),
                         end.cast("long").alias("end"), "strand")


def _by_strand(plus: Column, minus: Column) -> Column:
    return F.when(F.col("strand") == "+", plus).otherwise(minus)


def gene_regions(starts: DataFrame) -> DataFrame:
    """TSS windows of 5 kb, 1 kb and 300 bases and the gene body from +300 to +3000."""
    tss, tts = F.col("tss"), F.col("tts")
    parts = [_kind(starts, f"tss_{w}", tss - w, tss + w) for w in (5000, 1000, 300)]
    parts.append(_kind(starts, "body", _by_strand(tss + 300, tts - 3000), _by_strand(tts + 3000, tss - 300)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def meta_regions(starts: DataFrame, flank: int = 3000) -> DataFrame:
    """Upstream flank, transcript and downstream flank of every gene."""
    tss, tts = F.col("tss"), F.col("tts")
    return (
        _kind(starts, "tss", _by_strand(tss - flank, tss), _by_strand(tss, tss + flank))
        .unionByName(_kind(starts, "txn", _by_strand(tss, tts), _by_strand(tts, tss)))
        .unionByName(_kind(starts, "ttr", _by_strand(tts, tts - flank), _by_strand(tts + flank, tts)))
    )


def widened(regions: DataFrame, window: int) -> DataFrame:
    """Regions with ``window`` on both sides."""
    return loci.flank(regions, window, window)


def plot_region(starts: DataFrame, kind: str) -> DataFrame:
    """Region to draw for a gene: ``TSS`` +-5 kb or ``TXN`` with half its length, to whole kb, around."""
    tss, tts = F.col("tss"), F.col("tts")
    if kind == "TSS":
        low, high = tss - 5000, tss + 5000
    elif kind == "TXN":
        offset = F.round(F.abs(tts - tss) * 0.5, -3).cast("long")
        low, high = _by_strand(tss - offset, tts - offset), _by_strand(tts + offset, tss + offset)
    else:
        raise ValueError(f"unknown kind {kind!r}")
    text = F.concat("chrom", F.lit(":"), "strand", F.lit(":"), low.cast("string"), F.lit("-"), high.cast("string"))
    return starts.select("id", text.alias("region"))

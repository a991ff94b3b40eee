"""Set operations and filters on tables of loci, files and samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions import loci
from strandline.operators import ordering


def on_chromosomes(regions: DataFrame, allowed: DataFrame, *, keep: bool = True) -> DataFrame:
    """Regions on the allowed chromosomes, or (``keep=False``) the excluded ones."""
    return regions.join(allowed.select("chrom"), "chrom", "left_semi" if keep else "left_anti")


def chrom_consensus(file_chroms: DataFrame) -> DataFrame:
    """Chromosomes present in every file."""
    n_files = file_chroms.agg(F.count_distinct("file_key")).scalar()
    return file_chroms.groupBy("chrom").agg(F.count_distinct("file_key").alias("_n")).where(
        F.col("_n") == n_files).select("chrom")


def require_unique(df: DataFrame, column: str = "id") -> DataFrame:
    """The same rows; the query fails on a repeated name."""
    repeated = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    worst = repeated.agg(F.min(column)).scalar()
    message = F.concat(F.lit("name used more than once: "), worst.cast("string"))
    return df.where(F.when(worst.isNull(), True).otherwise(F.raise_error(message).cast("boolean")))


def union_loci(*frames: DataFrame) -> DataFrame:
    """Union with one row per four-column locus, the lowest id first."""
    merged = reduce(lambda a, b: a.unionByName(b), [f.select(*loci.LOCUS_KEY, "id") for f in frames])
    return merged.groupBy(*loci.LOCUS_KEY).agg(F.min("id").alias("id"))


def remove_loci(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b.select(*loci.LOCUS_KEY), loci.LOCUS_KEY, "left_anti")


def set_operations(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of both with where they occur: ``both``, ``first`` or ``second``."""
    cols = a.columns
    tagged = a.withColumn("_a", F.lit(1)).unionByName(b.select(*cols).withColumn("_a", F.lit(2)))
    seen = tagged.groupBy(*cols).agg(F.bit_or("_a").alias("_a"))
    return seen.select(*cols, F.when(F.col("_a") == 3, "both").when(F.col("_a") == 1, "first")
                       .otherwise("second").alias("found_in"))


def uniquify(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """First row per key in source order."""
    return ordering.keep_first(df, key, order)


def signal_samples(samples: DataFrame, *, prefix: str | None = None) -> DataFrame:
    """Samples with a background and peaks, without inputs, optionally of one cell type."""
    name = F.upper("name")
    out = samples.where(
        (F.col("background") != "") & (F.col("background") != "NONE")
        & (F.col("enriched_macs") != "") & (F.col("enriched_macs") != "NONE")
        & ~name.contains("WCE") & ~name.contains("INPUT"))
    return out if prefix is None else out.where(F.col("name").startswith(prefix))


def background_pairs(samples: DataFrame) -> DataFrame:
    """Each sample with the file of its background row, if that row exists."""
    other = samples.select(F.col("name").alias("background"), F.col("file_path").alias("background_path"))
    return samples.join(other, "background", "left").select(
        "name", "file_path", "background", "background_path")


def sorted_sources(table: DataFrame, lookup: DataFrame) -> DataFrame:
    """Names with their source from the lookup table, sorted by source."""
    return table.join(lookup, "name", "left").orderBy("source", "name")


def explode_list(df: DataFrame, column: str, separator: str, name: str) -> DataFrame:
    """One row per non-empty item of a separated list."""
    items = df.withColumn(name, F.explode(F.split(F.col(column), separator))).withColumn(name, F.trim(name))
    return items.where(F.col(name) != "")


def category_counts(df: DataFrame, column: str, separator: str = ";") -> DataFrame:
    return explode_list(df, column, separator, "category").groupBy("category").agg(
        F.count(F.lit(1)).alias("n"))


def merged_names(*columns: str):
    """Distinct names of several comma lists, in order, joined again."""
    arrays = [F.split(F.coalesce(F.col(c), F.lit("")), ",") for c in columns]
    return F.array_join(F.array_remove(F.array_distinct(F.concat(*arrays)), ""), ",")

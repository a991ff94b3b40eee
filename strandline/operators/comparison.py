"""Two-condition and many-sample comparisons of region signal."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions.signal import change_class, clipped_log2_fold
from strandline.operators import ordering
from strandline.operators.collections import explode_list, merged_names


def delta_table(region_map: DataFrame, first: str, second: str, median1, median2) -> DataFrame:
    """log2 change of ``second`` over ``first`` after scaling by medians, highest change first."""
    lit = lambda v: F.lit(float(v)) if isinstance(v, (int, float)) else v
    m1, m2 = lit(median1), lit(median2)
    out = region_map.withColumns(
        {"log2_change": clipped_log2_fold(second, first, m2, m1),
         "scaled1": F.greatest(F.col(first), F.lit(1.0)) / m1,
         "scaled2": F.greatest(F.col(second), F.lit(1.0)) / m2,
         "is_super": F.lit(1)})
    order = [F.desc("log2_change"), F.asc("chrom"), F.asc("start"), F.asc("end"), F.asc("id")]
    return ordering.row_numbers(out, [], order, "rank")


def gained_lost(table: DataFrame, cutoff: float = 1.0, names: tuple[str, str] = ("LOST", "GAINED")) -> DataFrame:
    """Regions with their status; the stitch suffix leaves the id."""
    return table.withColumns(
        {"id": F.regexp_replace("id", "_lociStitched", ""),
         "status": change_class("log2_change", cutoff, names[1], names[0])})


def status_genes(table: DataFrame) -> DataFrame:
    """One row per gene and region from the three gene lists."""
    lists = table.withColumn("genes", merged_names("overlap_genes", "proximal_genes", "closest_gene"))
    return explode_list(lists, "genes", ",", "gene").drop("genes")


def region_clusters(matrix: DataFrame, samples: list[str], k: int = 10, seed: int = 1) -> DataFrame:
    """Regions grouped by the shape of their profile.

    Rows are centred and scaled to length 1, where squared distance is
    2 * (1 - r), and split by bisecting k-means. Flat rows and rows with NULL
    have no shape: their cluster is NULL.
    """
    n = len(samples)
    mean = reduce(lambda a, b: a + b, [F.col(s) for s in samples]) / n
    norm = F.sqrt(reduce(lambda a, b: a + b, [(F.col(s) - F.col("_mean")) ** 2 for s in samples]))
    profiles = matrix.withColumn("_mean", mean).withColumn("_norm", norm)
    cells = F.array(*[((F.col(s) - F.col("_mean")) / F.col("_norm")).cast("double") for s in samples])
    rows = profiles.where("_norm > 0").withColumn("_features", array_to_vector(cells)).persist()
    shapeless = profiles.where("_norm IS NULL OR NOT _norm > 0").withColumn("cluster", F.lit(None).cast("int")).drop("_mean", "_norm")
    if rows.isEmpty():
        rows.unpersist()
        return shapeless
    model = BisectingKMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster").fit(rows)
    rows.unpersist()
    out = model.transform(rows).drop("_features", "_mean", "_norm")
    return out.withColumn("cluster", F.col("cluster") + 1).unionByName(shapeless)


def cluster_exemplars(clustered: DataFrame, samples: list[str]) -> DataFrame:
    """Median profile of every cluster."""
    long = clustered.select("cluster", *samples).unpivot(["cluster"], samples, "sample", "value")
    medians = ordering.median(long, ["cluster", "sample"], "value", "median")
    return medians.groupBy("cluster").agg(*[
        F.max(F.when(F.col("sample") == s, F.col("median"))).alias(s) for s in samples])

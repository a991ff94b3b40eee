"""Region maps, long and wide matrices, normalisation of signal columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions import loci
from strandline.functions.signal import subtract_background
from strandline.operators import ordering
from strandline.operators.overlaps import overlap_join


def widen(df: DataFrame, keys: list[str], column: str, value: str, names: list, *, prefix: str = "",
          agg=F.max, fill=None) -> DataFrame:
    """Long to wide for a known list of column names, one shuffle on the keys."""
    cells = [agg(F.when(F.col(column) == n, F.col(value))).alias(f"{prefix}{n}") for n in names]
    wide = df.groupBy(*keys).agg(*cells)
    return wide if fill is None else wide.fillna(fill, subset=[f"{prefix}{n}" for n in names])


def lengthen(df: DataFrame, keys: list[str], columns: list[str], name: str = "sample",
             value: str = "value") -> DataFrame:
    return df.unpivot(keys, columns, name, value)


def region_map(stitched: DataFrame, densities: DataFrame, samples: dict, *, sample_col: str = "file_key",
               drop_chroms: list[str] = ("chrY",), apart: bool = False) -> DataFrame:
    """Stitched loci with one signal column per sample.

    ``densities`` holds the mapped regions (sample, id, locus, density); a locus
    gets round(density, 4) * span of every mapped region it touches. Where the
    mapped regions are the loci themselves and none touches another (``apart``),
    that is its own, found by id.
    """
    kept = stitched.where(~F.col("chrom").isin(list(drop_chroms)))
    key = ["id", *loci.LOCUS_KEY]
    signal = F.round("density", 4) * (F.col("end") - F.col("start"))
    # one row per mapped region, whatever the number of samples
    mapped = densities.groupBy(*key).agg(*[
        F.sum(F.when(F.col(sample_col) == k, signal)).alias(name) for k, name in samples.items()])
    if not apart:
        pairs = overlap_join(kept.select(*key), mapped)
        mapped = pairs.groupBy(*key).agg(*[F.sum("b_" + name).alias(name) for name in samples.values()])
    return kept.join(mapped, key, "left").fillna(0.0, subset=list(samples.values()))


def collapse_replicates(matrix: DataFrame, pairs: list[tuple[str, str | None]], name: str = "signal") -> DataFrame:
    """Mean over replicates of treatment minus its own control, each at least 0.

    Controls are paired with treatments by name.
    """
    parts = [subtract_background(t, c) if c else F.greatest(F.lit(0.0), F.col(t)) for t, c in pairs]
    total = reduce(lambda a, b: a + b, parts)
    return matrix.withColumn(name, total / len(parts))


def median_normalised(matrix: DataFrame, pairs: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Background-subtracted signal per sample over the median of its unclipped differences."""
    def raw(t, c):
        return F.col(t) - F.col(c) if c else F.col(t)
    long = matrix.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("sample"), raw(t, c).alias("value")) for name, (t, c) in pairs.items()
    ])).alias("_v")).select("_v.*")
    medians = ordering.median(long, ["sample"], "value", "median")
    row = medians.groupBy().agg(*[
        F.max(F.when(F.col("sample") == name, F.col("median"))).alias(name) for name in pairs])
    used = [c for pair in pairs.values() for c in pair if c]
    kept = [c for c in matrix.columns if c not in used]
    return matrix.select(*kept, *[
        (F.greatest(F.lit(0.0), raw(t, c)) / F.nullif(row.select(name).scalar(), F.lit(0.0))).alias(name)
        for name, (t, c) in pairs.items()])


def heatmap_order(matrix: DataFrame, columns: list[str], background: dict[str, str] | None = None, *,
                  key: str = "id") -> DataFrame:
    """Rows ordered by the mean of the reference columns after background subtraction."""
    if background:
        matrix = matrix.withColumns({c: subtract_background(c, b) for c, b in background.items()})
    mean = reduce(lambda a, b: a + b, [F.col(c) for c in columns]) / len(columns)
    return ordering.row_numbers(matrix.withColumn("mean_signal", mean), [],
                                [F.desc("mean_signal"), F.asc(key)], "row_order")


def colour_limits(matrix: DataFrame, columns: list[str], low: float = 0.6, high: float = 0.95) -> DataFrame:
    """Quantiles over all cells, used as the ends of the colour scale."""
    cells = matrix.select(F.explode(F.array(*columns)).alias("cell"))
    return ordering.quantiles(cells, [], "cell", {"low": low, "high": high})

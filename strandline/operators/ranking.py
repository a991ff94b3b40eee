"""Tangent cutoff, super and stretch flags, ranks of a region map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.signal import magnitude
from strandline.operators import ordering

def tangent_cutoff(df: DataFrame, value: str, name: str = "cutoff") -> DataFrame:
    """One row: the value where a line of slope (max-min)/n touches the sorted curve from below.

    The touching point minimises ``v_i - slope * i`` over positions i; among
    equal values only the last position can win, so distinct values suffice.
    """
    clipped = df.select(F.greatest(F.col(value).cast("double"), F.lit(0.0)).alias("v")).where("v is not null")
    curve = ordering.tallies(clipped, [], "v")
    edge = clipped.agg(((F.max("v") - F.min("v")) / F.count(F.lit(1))).alias("slope")).scalar()
    below = F.col("v") - edge * F.col("_upto")
    return curve.agg(F.min_by("v", F.struct(below.alias("_b"), F.col("_upto"))).alias(name))


def _reversed_map_order() -> list[Column]:
    span = F.col("end") - F.col("start")
    return [span.asc(), F.desc("chrom"), F.desc("start"), F.desc("end"), F.desc("id")]


def rank_by(df: DataFrame, value: str, name: str) -> DataFrame:
    """1 for the highest value; among ties later rows of the length-ordered map rank better."""
    return ordering.row_numbers(df, [], [F.desc(value), *_reversed_map_order()], name)


def flag_above(df: DataFrame, value: str, name: str) -> DataFrame:
    """1 where the value is strictly above the tangent cutoff."""
    cut = tangent_cutoff(df, value).scalar()
    return df.withColumn(name, (F.greatest(F.col(value), F.lit(0)) > cut).cast("int"))


def super_table(region_map: DataFrame, signal: str = "signal") -> DataFrame:
    flagged = flag_above(region_map, signal, "is_super")
    return rank_by(flagged, signal, "enhancer_rank")


def stretch_table(region_map: DataFrame, size: str = "constituent_size") -> DataFrame:
    flagged = flag_above(region_map, size, "is_stretch")
    return rank_by(flagged, size, "enhancer_rank")


def super_stretch_table(region_map: DataFrame, signal: str = "signal", size: str = "constituent_size") -> DataFrame:
    """Regions above both cutoffs, ranked by the length of the vector of both values."""
    flagged = flag_above(flag_above(region_map, signal, "_super"), size, "_stretch")
    top = region_map.agg(F.max(size).alias("size"), F.max(signal).alias("signal"))
    x = F.abs(F.col(size)) / top.select("size").scalar()
    y = F.col(signal) / top.select("signal").scalar()
    both = flagged.withColumns(
        {"magnitude": magnitude(x, y),
         "is_super_stretch": ((F.col("_super") == 1) & (F.col("_stretch") == 1)).cast("int")})
    return rank_by(both.drop("_super", "_stretch"), "magnitude", "enhancer_rank")


def adjacent_difference(df: DataFrame, group: list[str], order: str, value: str, name: str) -> DataFrame:
    return df.withColumn(name, F.col(value) - F.lag(value).over(Window.partitionBy(*group).orderBy(order)))

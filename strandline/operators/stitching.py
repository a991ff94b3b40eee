"""Merging of neighbouring loci and what is measured on the merged spans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import loci
from strandline.operators import ordering
from strandline.operators.overlaps import overlap_filter, overlap_join
from strandline.session import checkpointed

ORDER = ["start", "end", "strand", "id"]


def dedupe_loci(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """One row per (chrom, start, end, strand); the lowest id stays."""
    return df.groupBy(*by, *loci.LOCUS_KEY).agg(F.min("id").alias("id"))


def by_start(df: DataFrame, group: list[str], extra: list = ()) -> DataFrame:
    """Loci that start at the same place as one row: reach, num_loci, the first of them and ``extra`` aggregates.

    They always end up in the same merged span, so nothing else is needed to
    find and describe the spans.
    """
    first = F.min_by(F.struct("id", "strand"), F.struct(*ORDER)).alias("_first")
    return ordering.tiled(df, group, "start").groupBy("_tile", *group, "start").agg(
        F.max("end").alias("_reach"), F.count(F.lit(1)).alias("num_loci"), first, *extra)


def islands(starts: DataFrame, group: list[str], window) -> DataFrame:
    """Add ``island``, the start of the merged span, to rows of :func:`by_start`.

    A span goes on while the next start lies within ``window`` (a number or a
    column that is the same for all of a group) of its end so far. A tile knows
    its own spans; what reaches into it and the span open at its begin come
    from one row per earlier tile.
    """
    gap = F.lit(window) if isinstance(window, int) else window
    along = Window.partitionBy("_tile").orderBy("start")
    before = F.max("_reach").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col("start") > before + gap), F.col("start"))
    local = starts.withColumns({"_opens": opens, "_gap": gap})
    tiles = local.groupBy("_tile").agg(F.max("_reach").alias("_most"), F.max("_opens").alias("_last"), F.max("_gap").alias("_g"))
    earlier = ordering.earlier_tiles(tiles, group)
    tiles = tiles.withColumn("_into", F.max("_most").over(earlier))
    # the last of a tile's own spans really opens there unless an earlier tile reaches it
    real = F.when(F.col("_into").isNull() | (F.col("_last") > F.col("_into") + F.col("_g")), F.col("_last"))
    tiles = tiles.withColumn("_real", real).select("_tile", "_into", F.max("_real").over(earlier).alias("_open"))
    joined = local.join(tiles, "_tile")
    kept = F.when(F.col("_into").isNull() | (F.col("_opens") > F.col("_into") + F.col("_gap")), F.col("_opens"))
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    return joined.withColumn("_opens", kept).withColumn(
        "island", F.coalesce(F.max("_opens").over(upto), F.col("_open"))).drop("_opens", "_gap", "_into", "_open", "_tile")


def stitch(df: DataFrame, window: int = 1, by: list[str] = (), mode: str = "both", extra: dict | None = None) -> DataFrame:
    """Merged loci (…, chrom, start, end, strand, id, num_loci).

    The id is ``<n>_<lowest member>_lociStitched``. Mode ``both`` ignores
    strands and gives merged spans the strand ``.``. ``extra`` maps further
    columns to expressions that are summed over the members.
    """
    extra = extra or {}
    group = [*by, "chrom"] + (["strand"] if mode == "sense" else [])
    members = dedupe_loci(df, by)
    if mode == "sense":
        wrong = F.raise_error(F.lit("stitching by strand needs + or -")).cast("string")
        members = members.withColumn("strand", F.when(F.col("strand") != ".", F.col("strand")).otherwise(wrong))
    starts = by_start(members, group, [F.sum(expr).alias(name) for name, expr in extra.items()])
    merged = islands(starts, group, window).groupBy(*group, "island").agg(
        F.min("start").alias("start"), F.max("_reach").alias("end"), F.sum("num_loci").alias("num_loci"),
        F.min_by("_first", "start").alias("_first"), *[F.sum(name).alias(name) for name in extra])
    strand = F.col("strand") if mode == "sense" else F.when(
        F.col("num_loci") == 1, F.col("_first.strand")).otherwise(".")
    name = F.concat_ws("_", F.col("num_loci").cast("string"), F.col("_first.id"), F.lit("lociStitched"))
    return merged.select(*by, "chrom", "start", "end", strand.alias("strand"), name.alias("id"), "num_loci", *extra)


def constituent_size(stitched: DataFrame, originals: DataFrame, name: str = "constituent_size") -> DataFrame:
    """Add the summed length of the original loci that touch each stitched locus."""
    pairs = overlap_join(stitched.select(*loci.LOCUS_KEY, "id"), dedupe_loci(originals))
    sums = pairs.groupBy("id", *loci.LOCUS_KEY).agg(
        F.sum(loci.length("b_start", "b_end")).alias(name))
    return stitched.join(sums, ["id", *loci.LOCUS_KEY], "left").fillna(0, subset=[name])


def unstitch_multi_tss(stitched: DataFrame, originals: DataFrame, tss: DataFrame, *,
                       window: int = 50, max_names: int = 2) -> DataFrame:
    """Put the original loci back where a stitched one touches TSS of more than ``max_names`` genes.

    ``tss`` holds chrom, tss, strand and name. Originals get ``num_loci`` 1.
    """
    windows = tss.select("chrom", "name", "strand", *[
        c.alias(n) for n, c in loci.tss_window(window, window).items()])
    key = ["id", *loci.LOCUS_KEY]
    crowded = (
        overlap_join(stitched.select(*key), windows)
        .groupBy(*key).agg(F.count_distinct("b_name").alias("names"))
        .where(F.col("names") > max_names).select(*key)
    )
    kept = stitched.join(crowded, key, "left_anti")
    single = dedupe_loci(originals).withColumn("num_loci", F.lit(1).cast("long"))
    restored = overlap_join(crowded, single).select(
        *[F.col("b_" + c).alias(c) for c in kept.columns]).distinct()
    return ordering.keep_first(kept.unionByName(restored), loci.LOCUS_KEY, ["id"])


def stitch_sweep(df: DataFrame, maximum: int = 15000, step: int = 500) -> DataFrame:
    """Statistics of stitching at every window 0, step, .. maximum, from one pass over the spans merged at window 0.

    The gap in front of a span says up to which window it opens a region. A
    region at one window reaches to the gap that opens the next one there, and
    its constituents are a difference of running lengths, so a window only ever
    looks at the spans that open its regions.
    """
    base = stitch(df, 0).select("chrom", "start", "end")
    spans = ordering.scan(base, ["chrom"], "start", {"_before": ("sum", loci.length()), "_until": ("max", F.col("end"))},
                          inclusive=False).withColumn("_before", F.coalesce("_before", F.lit(0)))
    last = maximum // step
    gap = F.col("start") - F.col("_until")
    opens = F.when(gap > 0, F.ceil(gap / step)).when(gap.isNull(), last + 1).otherwise(0)
    opening = spans.withColumn("_opens", F.least(opens, F.lit(last + 1)).cast("int")).where("_opens > 0").select(
        "chrom", "start", "_before", "_until", F.explode(F.sequence(F.lit(0), F.col("_opens") - 1)).alias("_k"))
    ends = base.groupBy("chrom").agg(F.max("end").alias("_end"), F.sum(loci.length()).alias("_all"))
    regions = ordering.scan(opening, ["_k", "chrom"], "start", following="_next", of=["_until", "_before"]).join(ends, "chrom")
    regions = regions.select(
        (F.col("_k") * step).alias("step"),
        (F.coalesce("_next._before", "_all") - F.col("_before")).alias("constit"),
        (F.coalesce("_next._until", "_end") - F.col("start") + 1).alias("region"))
    regions = checkpointed(regions.withColumn("fraction", F.col("constit") / F.col("region")))
    means = regions.groupBy("step").agg(
        F.count(F.lit(1)).alias("num_regions"), F.sum("constit").alias("total_constit"),
        F.sum("region").alias("total_region"),
        *[F.round(F.avg(c), 2).alias("mean_" + c) for c in ("constit", "region", "fraction")])
    for c in ("constit", "region", "fraction"):
        middle = ordering.median(regions, ["step"], c, "median_" + c)
        means = means.join(
            middle.withColumn("median_" + c, F.round("median_" + c, 2)), "step")
    return means.select(
        "step", "num_regions", "total_constit", "total_region", "mean_constit", "median_constit",
        "mean_region", "median_region", F.col("mean_fraction").alias("mean_stitch_fraction"),
        F.col("median_fraction").alias("median_stitch_fraction"))


def fraction_drop(sweep: DataFrame) -> DataFrame:
    """Change of the constituent fraction from one step to the next (one row per step)."""
    order = Window.orderBy("step")  # a few dozen rows: one per step
    ratio = F.col("mean_constit") / F.col("mean_region")
    return sweep.withColumn("ratio", ratio).withColumn("drop", F.col("ratio") - F.lag("ratio").over(order))


def best_step(sweep: DataFrame) -> DataFrame:
    """The step with the steepest smoothed drop: centred mean over five steps, first on ties."""
    order = Window.orderBy("step").rowsBetween(-2, 2)
    smooth = fraction_drop(sweep).where(F.col("drop").isNotNull()).withColumn(
        "smooth", F.avg("drop").over(order))
    return smooth.agg(F.min_by("step", F.struct("smooth", "step")).alias("best_step"))


def merged_with_sources(a: DataFrame, b: DataFrame, window: int = 1) -> DataFrame:
    """Stitched union of two collections; spans that touch both are named ``CONSERVED_n``."""
    both = a.select(*loci.LOCUS_KEY, "id").unionByName(b.select(*loci.LOCUS_KEY, "id"))
    merged = stitch(both, window)
    key = loci.LOCUS_KEY
    for name, side in (("in_a", a), ("in_b", b)):
        touched = overlap_filter(merged.select(*key), side.select(*key), "sense")
        merged = merged.join(touched.withColumn(name, F.lit(1)), key, "left").fillna(0, subset=[name])
    numbered = ordering.row_numbers(
        merged, ["in_a", "in_b"], [F.col(c) for c in ("chrom", "start", "end", "strand")], "_n")
    name = F.when((F.col("in_a") == 1) & (F.col("in_b") == 1),
                  F.concat(F.lit("CONSERVED_"), F.col("_n").cast("string")))
    return numbered.withColumn("id", F.coalesce(name, F.expr("substr(id, 3)"))).drop("_n")


def consensus_regions(df: DataFrame, analysis: str, window: int = 1) -> DataFrame:
    """Union of all samples, stitched, longest first, named ``merged_<analysis>_<n>``."""
    merged = stitch(df, window).withColumn("size", loci.length())
    order = [F.desc("size"), F.asc("chrom"), F.asc("start"), F.asc("end"), F.asc("strand")]
    numbered = ordering.row_numbers(merged, [], order, "rank")
    return numbered.withColumn(
        "id", F.concat(F.lit(f"merged_{analysis}_"), F.col("rank").cast("string")))

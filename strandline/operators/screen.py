"""Guide screens: cutting guides from reads, counting, folds, construct ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions.sequence import anchored_slice
from strandline.functions.signal import log2_ratio
from strandline.operators import ordering

# fixed values: anchor before the guide, offset from the anchor's start, guide length
ANCHOR, OFFSET, LENGTH = "CACCG", 5, 20


def extract_guides(records: DataFrame, anchor: str = ANCHOR, offset: int = OFFSET, length: int = LENGTH) -> DataFrame:
    """Records holding the anchor, with the guide cut from ``seq`` and, if there, from ``qual``."""
    cut = {"guide": anchored_slice("seq", anchor, offset, length)}
    if "qual" in records.columns:
        cut["guide_qual"] = anchored_slice("seq", anchor, offset, length, "qual")
    return records.withColumns(cut).where(F.col("guide").isNotNull())


def extraction_stats(records: DataFrame, anchor: str = ANCHOR) -> DataFrame:
    found = F.sum(F.when(F.instr("seq", anchor) > 0, 1).otherwise(0))
    total = F.count(F.lit(1))
    return records.agg(total.alias("records"), found.alias("found"), (found / total).alias("fraction"))


def guide_counts(guides: DataFrame, by: list[str] = ("sample",)) -> DataFrame:
    return guides.groupBy(*by, "guide").agg(F.count(F.lit(1)).alias("count"))


def fold_table(test: DataFrame, control: DataFrame, annotation: DataFrame, test_mmr, control_mmr,
               epsilon: float = 1.0) -> DataFrame:
    """log2 ratio of test over control per guide, joined on the guide; unknown guides get gene ''.

    ``*_mmr`` are the mapped reads in millions (numbers or scalar columns).
    """
    lit = lambda v: F.lit(v) if isinstance(v, (int, float)) else v
    pairs = test.select("guide", F.col("count").alias("_t")).join(
        control.select("guide", F.col("count").alias("_c")), "guide")
    named = pairs.join(annotation.select("guide", "gene"), "guide", "left").fillna("", subset=["gene"])
    shown = lambda c, m: F.round(F.col(c) / lit(m) + epsilon, 4)
    return named.select(
        "guide", "gene", log2_ratio("_t", "_c", lit(test_mmr), lit(control_mmr), epsilon).alias("log2_ratio"),
        shown("_t", test_mmr).alias("test"), shown("_c", control_mmr).alias("control"))


def several_guides_only(folds: DataFrame) -> DataFrame:
    """Without genes that only one guide targets."""
    genes = folds.groupBy("gene").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("gene")
    return folds.join(genes, "gene", "left_semi")


def construct_ranks(folds: DataFrame) -> DataFrame:
    """Constructs of genes with several guides, ranked by falling ratio; every weight is 1."""
    kept = several_guides_only(folds).select("guide", "gene", "log2_ratio")
    ranked = ordering.row_numbers(kept, [], [F.desc("log2_ratio"), F.asc("guide")], "construct_rank")
    return ranked.withColumn("hairpin_weight", F.lit(1))

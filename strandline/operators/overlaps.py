"""Interval joins.

Every locus is keyed by the fixed-width windows it touches, with four window
widths a factor 64 apart: a locus is spread over windows of the width that
suits its length (65 keys at most up to 2^33 times the finest width), and over
one or two windows of each coarser width, so that short and long loci meet.
Joined pairs keep the window of the later start at the coarser of both widths,
which makes each pair appear once without a distinct.

The joins are plain equi-joins on (chromosome, window) with a further test, so
Spark's adaptive skew join splits a hot window. Joins that only ask whether a
partner exists first reduce the partners to what a window needs to know, which
is bounded by the width of the window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import loci

LEVELS = 4
STEP = 6  # bits between two widths
_KEY_LEVEL = "CAST(pmod(_key, 4) AS int)"  # of a key; the rest of its bits is the window


# expressions are SQL text here: a single parse instead of one call per operator


def _level(start: str, end: str, shift: int) -> str:
    cases = " ".join(f"WHEN `{end}` - `{start}` < {1 << (shift + STEP * (k + 1))} THEN {k}" for k in range(LEVELS - 1))
    return f"CASE {cases} ELSE {LEVELS - 1} END"


def _window_keys(start: str, end: str, level: int, shift: int) -> str:
    """Keys of the windows of one width, ``window * LEVELS + level``."""
    bits = shift + STEP * level
    first, last = (f"shiftright(`{c}`, {bits}) * {LEVELS} + {level}" for c in (start, end))
    return f"sequence({first}, {last}, {LEVELS}L)"


def level_mask(df: DataFrame, start: str, end: str, shift: int) -> Column:
    """Scalar with one bit per width that loci of ``df`` use."""
    return df.agg(F.expr(f"bit_or(shiftleft(1, {_level(start, end, shift)}))").alias("mask")).scalar()


def _keyed(df: DataFrame, start: str, end: str, shift: int, level: str,
           mask: Column | None) -> DataFrame:
    """One row per window key. Coarser widths are limited to those set in ``mask``."""
    df = df.withColumn(level, F.expr(_level(start, end, shift)))
    if mask is not None:
        df = df.withColumn("_mask", mask)
    parts = []
    for k in range(LEVELS):
        coarser = f"(`{level}` < {k}" + (f" AND (_mask & {1 << k}) != 0)" if mask is not None else ")")
        parts.append(f"CASE WHEN `{level}` = {k} OR {coarser} THEN {_window_keys(start, end, k, shift)} "
                     "ELSE CAST(array() AS array<bigint>) END")
    return df.withColumn("_key", F.expr(f"explode(concat({', '.join(parts)}))")).drop("_mask")


def _first_meeting(a0: str, b0: str, a_level: str, b_level: str, shift: int) -> Column:
    """The key is the one window in which a pair is counted."""
    level = f"greatest(`{a_level}`, `{b_level}`)"
    window = f"shiftright(greatest(`{a0}`, `{b0}`), {shift} + {level} * {STEP})"
    return F.expr(f"_key = {window} * {LEVELS} + {level}")


def renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in df.columns})


def _last(half_open: bool):
    return (lambda c: F.col(c) - 1) if half_open else F.col


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str, test: Column) -> DataFrame:
    """Equi-join on ``keys``, which both sides have, with a further test over the columns of both."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    for k in keys:
        test = test & (F.col(k) == F.col(f"_r_{k}"))
    return left.join(other, test, how)


def overlap_join(a: DataFrame, b: DataFrame, mode: str = "both", relation: str = "overlap", *,
                 half_open: bool = False, shift: int = 9, by: list[str] = ()) -> DataFrame:
    """Pairs of loci: columns of ``a`` as they are, those of ``b`` prefixed ``b_``.

    ``relation``: ``overlap``, ``contains`` (a holds b) or ``contained`` (b
    holds a). ``half_open`` treats the ends as exclusive. ``by`` names further
    columns that must agree. ``b`` should be the smaller side; ``2**shift`` is
    the finest window width.
    """
    right = renamed(b, "b_").withColumn("_b_end", _last(half_open)("b_end"))
    left = a.withColumn("_end", _last(half_open)("end"))
    if half_open:  # an empty span touches nothing
        left, right = left.where("_end >= start"), right.where("_b_end >= b_start")
    left = _keyed(left, "start", "_end", shift, "_lvl", level_mask(right, "b_start", "_b_end", shift))
    right = _keyed(right, "b_start", "_b_end", shift, "_b_lvl", None)
    keys = ["chrom", *by, "_key"]
    right = right.withColumns({k: F.col("b_" + k) for k in keys if k != "_key"})
    if relation == "overlap":
        test = F.expr("start <= _b_end AND b_start <= _end")
    elif relation == "contains":
        test = F.expr("start <= b_start AND _b_end <= _end")
    elif relation == "contained":
        test = F.expr("b_start <= start AND _end <= _b_end")
    else:
        raise ValueError(f"unknown relation {relation!r}")
    if mode != "both":
        test = test & loci.strand_matches("", "b_", mode)
    test = test & _first_meeting("start", "b_start", "_lvl", "_b_lvl", shift)
    return _joined(left, right, keys, "inner", test).select(*a.columns, *["b_" + c for c in b.columns])


# --- existence ----------------------------------------------------------------------------------

# pieces of partners within one window, besides those that start within it at a place of their own
PREFIX, SUFFIX, HULL = -1, -2, -3


def window_cover(b: DataFrame, keys: list[str], shift: int) -> DataFrame:
    """What ``b`` covers of each window: (keys, _key, _b_lvl, _piece, _from, _to), for an overlap test.

    ``b`` has ``b_start`` and ``_b_end``. Of the partners that enter a window
    from the left only the longest reach counts, of those that leave it to the
    right the earliest start. A locus shorter than a window of the coarser
    widths only meets longer ones there, which enter or leave the window, so
    the hull of the short ones is enough. Only the finest windows hold spans
    of their own, one per start: ``2**shift`` at most.
    """
    rows = _keyed(b, "b_start", "_b_end", shift, "_b_lvl", None)
    bits = f"({shift} + {STEP} * {_KEY_LEVEL})"
    rows = rows.withColumn("_low", F.expr(f"shiftleft(shiftright(_key, 2), {bits})"))
    rows = rows.withColumn("_high", F.expr(f"_low + shiftleft(1L, {bits}) - 1"))
    short = F.expr(f"_b_lvl < {_KEY_LEVEL}")
    piece = F.when(short, HULL).when(F.expr("b_start <= _low"), PREFIX).when(F.expr("_b_end >= _high"), SUFFIX)
    rows = rows.select(
        *keys, "_key", F.coalesce(piece, F.expr("b_start - _low")).alias("_piece"),
        F.greatest("b_start", "_low").alias("_from"), F.least("_b_end", "_high").alias("_to"))
    return rows.groupBy(*keys, "_key", "_piece").agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"))


def _dyadic(df: DataFrame, start: str, end: str, shift: int) -> DataFrame:
    """One row per window of those that make up a span: the finest one it starts in, then of what follows the widest
    windows that fit, at most 126 of each width below the coarsest."""
    begin = f"shiftleft(shiftright(`{start}`, {shift}) + 1, {shift})"
    stop = f"shiftleft(shiftright(`{end}`, {shift}) + 1, {shift})"
    bits = [shift + STEP * k for k in range(LEVELS)]
    edges = {f"_l{k}": F.expr(f"CAST(shiftright({begin} + {(1 << n) - 1}, {n}) AS bigint)") for k, n in enumerate(bits)}
    edges |= {f"_h{k}": F.expr(f"CAST(shiftright({stop}, {n}) - 1 AS bigint)") for k, n in enumerate(bits)}

    def windows(low: str, high: str) -> str:
        return f"CASE WHEN {low} <= {high} THEN sequence({low}, {high}) ELSE CAST(array() AS array<bigint>) END"

    parts = [f"array(CAST(shiftright(`{start}`, {shift}) * {LEVELS} AS bigint))"]
    for k in range(LEVELS):
        every = windows(f"_l{k}", f"_h{k}")
        if k + 1 < LEVELS:  # the next width takes over its middle
            left = windows(f"_l{k}", f"shiftleft(_l{k + 1}, {STEP}) - 1")
            right = windows(f"shiftleft(_h{k + 1} + 1, {STEP})", f"_h{k}")
            every = f"CASE WHEN _l{k + 1} <= _h{k + 1} THEN concat({left}, {right}) ELSE {every} END"
        parts.append(f"transform({every}, w -> w * {LEVELS} + {k})")
    return df.withColumns(edges).withColumn("_key", F.expr(f"explode(concat({', '.join(parts)}))")).drop(*edges)


def window_reach(b: DataFrame, keys: list[str], shift: int) -> DataFrame:
    """How far ``b`` reaches from the starts in each window: (keys, _key, _from, _to), for a containment test.

    A span is dealt over the few windows that make it up. In a window that it
    covers every start is one it holds, so the longest reach counts; in the
    window where it starts, the longest reach of each start. That is one row
    per window and ``2**shift`` more in the finest ones.
    """
    rows = _dyadic(b, "b_start", "_b_end", shift)
    low = F.expr(f"CASE WHEN {_KEY_LEVEL} = 0 THEN shiftleft(shiftright(_key, 2), {shift}) END")
    from_ = F.when(F.col("b_start") > low, F.col("b_start"))
    return rows.select(*keys, "_key", from_.alias("_from"), "_b_end").groupBy(*keys, "_key", "_from").agg(
        F.max("_b_end").alias("_to"))


def overlap_filter(a: DataFrame, b: DataFrame, mode: str = "both", relation: str = "overlap", *,
                   keep: bool = True, half_open: bool = False, shift: int = 9, by: list[str] = ()) -> DataFrame:
    """Rows of ``a`` with (``keep``) or without any partner in ``b``: one that overlaps (``overlap``) or holds them
    (``contained``).

    No pairs are built, and ``b`` is reduced to a bounded number of rows per
    window before the join, however many partners lie there.
    """
    strands = ["strand"] if mode != "both" else []
    identity = ["chrom", "start", "end", *by, *strands]
    right = b.select("chrom", *by, *[F.col("strand").alias("b_strand") for _ in strands],
                     F.col("start").alias("b_start"), _last(half_open)("end").alias("_b_end"))
    left = a.select(*identity, _last(half_open)("end").alias("_end"))
    if half_open:  # an empty span touches nothing
        left, right = left.where("_end >= start"), right.where("_b_end >= b_start")
    right = right.where("_b_end >= b_start")
    held = ["chrom", *by, *["b_strand" for _ in strands]]
    if relation == "overlap":
        mask = level_mask(right, "b_start", "_b_end", shift)
        left = _keyed(left, "start", "_end", shift, "_lvl", mask)
        right = window_cover(right, held, shift)
        # loci shorter than a coarse window meet the short partners there in windows of a finer width
        test = F.expr(f"start <= _to AND _from <= _end AND (_piece != {HULL} OR _lvl = {_KEY_LEVEL})")
    elif relation == "contained":
        every = ", ".join(f"shiftright(start, {shift + STEP * k}) * {LEVELS} + {k}" for k in range(LEVELS))
        left = left.withColumn("_key", F.expr(f"explode(array({every}))"))
        right = window_reach(right, held, shift)
        test = F.expr("(_from IS NULL OR _from <= start) AND _end <= _to")
    else:
        raise ValueError(f"unknown relation {relation!r}")
    if mode != "both":
        test = test & loci.strand_matches("", "b_", mode)
    found = _joined(left, right, ["chrom", *by, "_key"], "left_semi", test).select(*identity).distinct()
    return a.join(found, identity, "left_semi" if keep else "left_anti")


def overlapping(a: DataFrame, b: DataFrame, mode: str = "both", **kwargs) -> DataFrame:
    return overlap_filter(a, b, mode, keep=True, **kwargs)


def not_overlapping(a: DataFrame, b: DataFrame, mode: str = "both", **kwargs) -> DataFrame:
    """Drop loci that touch a mask."""
    return overlap_filter(a, b, mode, keep=False, **kwargs)


def has_locus(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` whose four-column locus occurs in ``b``."""
    return a.join(b.select(*loci.LOCUS_KEY), loci.LOCUS_KEY, "left_semi")


def occupancy_matrix(regions: DataFrame, peaks: DataFrame, samples: list[str], *,
                     id_col: str = "id", sample_col: str = "sample") -> DataFrame:
    """Regions x samples, 1 where any peak of the sample touches the region.

    The peaks of a sample are reduced to what they cover of each window before
    they meet the regions.
    """
    keyed = regions.select(id_col, "chrom", "start", F.col("end").alias("_end"))
    marks = peaks.select("chrom", sample_col, F.col("start").alias("b_start"), F.col("end").alias("_b_end"))
    keyed = _keyed(keyed, "start", "_end", 9, "_lvl", level_mask(marks, "b_start", "_b_end", 9))
    cover = window_cover(marks, ["chrom", sample_col], 9)
    test = F.expr(f"start <= _to AND _from <= _end AND (_piece != {HULL} OR _lvl = {_KEY_LEVEL})")
    touched = _joined(keyed, cover, ["chrom", "_key"], "inner", test)
    seen = touched.groupBy(id_col).agg(
        *[F.max(F.when(F.col(sample_col) == s, 1).otherwise(0)).alias(s) for s in samples])
    return regions.join(seen, id_col, "left").fillna(0, subset=samples)


def any_of_all(groups: list[list[str]]) -> Column:
    """OR over AND groups of 0/1 columns, ``[["a", "b"], ["c"]]`` = a and b, or c."""
    ands = [reduce(lambda x, y: x & y, [F.col(c) == 1 for c in names]) for names in groups]
    return reduce(lambda x, y: x | y, ands)

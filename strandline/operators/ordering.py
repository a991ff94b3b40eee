"""Running values, ranks and order statistics over groups of any size.

A window with few partitions puts a whole group into one task. Two forms avoid
that, whatever the size of the input:

* along positions, rows are dealt into tiles of a fixed number of bases. Every
  tile computes its own running values; one row per tile carries the rest. This
  takes one shuffle.
* along any other order, rows are range-partitioned and written once; every
  chunk computes its own running value and one row per chunk carries the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.session import checkpointed

_AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min}
#: a tile spans this many bases, so a genome of 3e9 bases has some 3,000 tiles and carries
TILE_BASES = 1 << 20


def _combine(kind: str, carry: Column, own: Column) -> Column:
    if kind == "sum":
        return F.coalesce(carry + own, carry, own)
    return F.greatest(carry, own) if kind == "max" else F.least(carry, own)


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; ``right`` adds its other columns."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    test = F.lit(True)
    for k in keys:
        test = test & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, test, how).drop(*[f"_r_{k}" for k in keys])


# --- along positions ----------------------------------------------------------------------------

def tiled(df: DataFrame, group: list[str], position: str) -> DataFrame:
    """Rows dealt by ``_tile``: the group and the number of the tile. The key is one struct, so NULL groups match too."""
    number = F.floor(F.col(position) / F.lit(TILE_BASES)).alias("_at")
    return df.withColumn("_tile", F.struct(*[F.col(g) for g in group], number)).repartition("_tile")


def earlier_tiles(totals: DataFrame, group: list[str], *, reverse: bool = False) -> Window:
    """All tiles of the group before this one; one row per tile."""
    at = F.col("_tile._at")
    keys = [F.col("_tile")[g] for g in group]
    return Window.partitionBy(*keys).orderBy(at.desc() if reverse else at).rowsBetween(Window.unboundedPreceding, -1)


def scan(df: DataFrame, group: list[str], position: str, ahead: dict | None = None, back: dict | None = None,
         following: str | None = None, of: list[str] = (), inclusive: bool = True) -> DataFrame:
    """Running values along ``position``, which must be unique within a group.

    ``ahead`` maps new columns to (kind, expression), running ``sum``, ``max``
    or ``min`` up to the row; ``back`` runs from the end of the group down to
    it; ``inclusive=False`` leaves the row itself out of both. ``following``
    names a struct of the next row's position and its columns ``of``. All of
    them come from the same shuffle; a tile holds ``TILE_BASES`` positions at most.
    """
    ahead, back = ahead or {}, back or {}
    rows = tiled(df, group, position)
    frame = (Window.unboundedPreceding, 0 if inclusive else -1)
    place = F.struct(position, *of)
    up = Window.partitionBy("_tile").orderBy(position)
    down = Window.partitionBy("_tile").orderBy(F.col(position).desc())
    own = {name: _AGGREGATES[kind](expr).over(up.rowsBetween(*frame)) for name, (kind, expr) in ahead.items()}
    # a frame that reaches forward is evaluated anew for every row, so the order is turned instead
    own |= {name: _AGGREGATES[kind](expr).over(down.rowsBetween(*frame)) for name, (kind, expr) in back.items()}
    if following:
        own[following] = F.lead(place).over(up)
    totals = rows.groupBy("_tile").agg(
        *[_AGGREGATES[kind](expr).alias(f"_t_{name}") for name, (kind, expr) in {**ahead, **back}.items()],
        F.min(place).alias("_t_first"))
    before, after = (earlier_tiles(totals, group, reverse=r) for r in (False, True))
    carries = totals.select(
        "_tile",
        *[_AGGREGATES[kind](f"_t_{name}").over(before).alias(f"_c_{name}") for name, (kind, _) in ahead.items()],
        *[_AGGREGATES[kind](f"_t_{name}").over(after).alias(f"_c_{name}") for name, (kind, _) in back.items()],
        *([F.min("_t_first").over(after).alias(f"_c_{following}")] if following else []))
    merged = rows.withColumns(own).join(carries, "_tile")
    merged = merged.withColumns({name: _combine(kind, F.col(f"_c_{name}"), F.col(name))
                                 for name, (kind, _) in {**ahead, **back}.items()})
    if following:
        merged = merged.withColumn(following, F.coalesce(following, f"_c_{following}"))
    return merged.drop(*carries.columns)


def nearest_before_after(points: DataFrame, targets: DataFrame, group: list[str], point: str,
                         target: str) -> DataFrame:
    """Adds ``before`` and ``after``: the closest target position on each side of a point.

    Distinct places of points and targets form one sequence that is scanned in
    both directions; no pairs are built and equal points cost no more than one.
    """
    places = lambda df, at, is_target: df.select(*group, F.col(at).alias("_pos"), F.lit(is_target).alias("_target"))
    marks = places(points, point, False).unionByName(places(targets, target, True)).where("_pos IS NOT NULL")
    marks = marks.groupBy(*group, "_pos").agg(
        F.max("_target").alias("_target"), F.min("_target").alias("_only"))
    mark = F.when(F.col("_target"), F.col("_pos"))
    sided = scan(marks, group, "_pos", {"before": ("max", mark)}, {"after": ("min", mark)})
    sided = sided.where(~F.col("_only")).select(*group, F.col("_pos").alias(point), "before", "after")
    return null_safe_join(points, sided, [*group, point], "left")


# --- along any order ----------------------------------------------------------------------------

def range_chunks(df: DataFrame, group: list[str], order: list) -> DataFrame:
    """Rows in ordered ranges of (group, order): ``_chunk`` numbers the range, ``_at`` rises along the order.

    The ranges come from a sample, so they are fixed with a written table
    before anything is computed twice from them. Their number follows the size.
    """
    along = [*[F.col(g) for g in group], *order]
    ranged = df.repartitionByRange(*along).sortWithinPartitions(*along)
    ranged = ranged.withColumn("_at", F.monotonically_increasing_id())
    return checkpointed(ranged.withColumn("_chunk", F.shiftright("_at", 33)))


def running(df: DataFrame, group: list[str], order: list, values: dict, *, inclusive: bool = True) -> DataFrame:
    """Add running ``sum``, ``max`` or ``min`` columns along ``order`` in each group.

    ``values`` maps a new column to (kind, expression). ``order`` should be
    unique within a group. ``inclusive=False`` leaves the row itself out.
    """
    chunks = range_chunks(df, group, order)
    keys = [*group, "_chunk"]
    window = Window.partitionBy(*keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    local = chunks.withColumns(
        {name: _AGGREGATES[kind](expr).over(window) for name, (kind, expr) in values.items()})
    totals = chunks.groupBy(*keys).agg(
        *[_AGGREGATES[kind](expr).alias(f"_t_{name}") for name, (kind, expr) in values.items()])
    # one row per chunk and group: bounded by the number of chunks, not by the data
    carry_window = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carries = totals.select(
        *keys, *[_AGGREGATES[kind](f"_t_{name}").over(carry_window).alias(f"_c_{name}")
                 for name, (kind, _) in values.items()])
    merged = null_safe_join(local, carries, keys, "left")
    merged = merged.withColumns(
        {name: _combine(kind, F.col(f"_c_{name}"), F.col(name)) for name, (kind, _) in values.items()})
    return merged.drop(*[f"_c_{name}" for name in values], "_chunk", "_at")


def row_numbers(df: DataFrame, group: list[str], order: list, name: str) -> DataFrame:
    """1-based position along ``order`` (which must be unique) in each group.

    Sorted chunks number their own rows; a chunk adds the rows of the chunks
    before it and a group takes off the rows of the groups before it.
    """
    chunks = range_chunks(df, group, order)
    ends = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)  # one row per chunk
    before = chunks.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_n")).select(
        "_chunk", F.coalesce(F.sum("_n").over(ends), F.lit(0)).alias("_before"))
    local = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = chunks.join(before, "_chunk").withColumn(name, F.col("_before") + local + 1).drop("_chunk", "_at", "_before")
    if not group:
        return numbered
    first = numbered.groupBy(*group).agg(F.min(name).alias("_first"))
    return null_safe_join(numbered, first, group).withColumn(name, F.col(name) - F.col("_first") + 1).drop("_first")


def tallies(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Distinct values per group with their count ``_n`` and the rows up to them ``_upto``."""
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    return running(counts, group, [F.col(value)], {"_upto": ("sum", F.col("_n"))})


def average_rank(df: DataFrame, group: list[str], value: str, name: str, *, size: str | None = None) -> DataFrame:
    """Ascending rank with ties averaged; ``size`` also adds the rows of the group.

    Only distinct values are ordered, so any number of ties costs nothing.
    """
    ranks = tallies(df, group, value)
    ranks = ranks.withColumn(name, F.col("_upto") - F.col("_n") + (F.col("_n") + 1) / F.lit(2.0))
    keep = [*group, value, name]
    if size:
        if group:
            ranks = null_safe_join(ranks, ranks.groupBy(*group).agg(F.max("_upto").alias(size)), group)
        else:
            ranks = ranks.withColumn(size, ranks.agg(F.max("_upto")).scalar())
        keep.append(size)
    return null_safe_join(df, ranks.select(*keep), [*group, value])


def percentile(df: DataFrame, group: list[str], value: str, name: str) -> DataFrame:
    """(average rank - 1) / (n - 1) * 100, NULL for a group of one."""
    ranked = average_rank(df, group, value, "_rank", size="_size")
    scaled = (F.col("_rank") - 1) / F.nullif(F.col("_size") - 1, F.lit(0)) * 100
    return ranked.withColumn(name, scaled).drop("_rank", "_size")


def quantiles(df: DataFrame, group: list[str], value: str, probabilities: dict[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group.

    Works on distinct values and their running counts: the two order
    statistics around a quantile are found by position, never by sorting a
    group inside one task.
    """
    counts = tallies(df.where(F.col(value).isNotNull()), group, value)
    if group:
        sizes = counts.groupBy(*group).agg(F.max("_upto").alias("_size"))
        counts = null_safe_join(counts, sizes, group)
    else:
        counts = counts.withColumn("_size", counts.agg(F.max("_upto")).scalar())
    out = []
    for name, p in probabilities.items():
        place = (F.col("_size") - 1) * F.lit(p)
        low, high = F.floor(place) + 1, F.ceil(place) + 1
        at = lambda k: F.max(F.when((F.col("_upto") >= k) & (F.col("_upto") - F.col("_n") < k),
                                    F.col(value)))
        frac = F.max(place - F.floor(place))
        out.append((at(low) + (at(high) - at(low)) * frac).alias(name))
    return counts.groupBy(*group).agg(*out)


def median(df: DataFrame, group: list[str], value: str, name: str) -> DataFrame:
    return quantiles(df, group, value, {name: 0.5})


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first along ``order``; combined map-side, so hot keys stay cheap."""
    rest = [c for c in df.columns if c not in keys]
    rows = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return rows.select(*keys, "_row.*").select(*df.columns)


def top_n(df: DataFrame, n: int, order: list) -> DataFrame:
    """First ``n`` rows along ``order``; Spark keeps only n rows per task."""
    return df.orderBy(*order).limit(n)


def order_index(df: DataFrame, value: str, tie: list, *, descending: bool = False,
                nulls: str = "last", name: str = "position") -> DataFrame:
    """Position of each row when sorted by ``value``; ``nulls`` is first, last or omit."""
    col = F.col(value)
    if nulls == "omit":
        df = df.where(col.isNotNull())
    kind = ("desc" if descending else "asc") + ("_nulls_first" if nulls == "first" else "_nulls_last")
    return row_numbers(df, [], [getattr(col, kind)(), *tie], name)


def moving_average(df: DataFrame, group: list[str], order: list, value: str, n: int, name: str) -> DataFrame:
    """Centred mean of ``n`` rows along ``order``; NULL where the window is cut off.

    With even ``n`` the window reaches one row further ahead than back. Every
    row hands its value to the positions whose window it lies in.
    """
    back, ahead = (n - 1) // 2, n // 2
    numbered = row_numbers(df, group, order, "_place")
    spread = numbered.select(
        *group, F.col(value).alias("_value"),
        F.explode(F.sequence(F.col("_place") - ahead, F.col("_place") + back)).alias("_place"))
    means = spread.groupBy(*group, "_place").agg(
        F.avg("_value").alias(name), F.count(F.lit(1)).alias("_rows"))
    means = means.withColumn(name, F.when(F.col("_rows") == n, F.col(name))).drop("_rows")
    return null_safe_join(numbered, means, [*group, "_place"], "left").drop("_place")

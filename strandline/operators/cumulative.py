"""Sums below positions, without pairs of what is summed and what asks.

What a region holds of reads, segments or score lines is a difference of sums
over everything that begins or ends below a position. Events (a weight at a
position) are added up per position and dealt into tiles of a fixed number of
bases, each with one row for all tiles before it; a region is dealt to the
tiles of its positions and looked up there. The cost grows with the events and
with the regions, never with how many meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: a task holds the events of one tile at a time: at most 2**TILE_BITS positions per combination of ``by``
TILE_BITS = 13
_CARRY, _EVENT, _QUERY = 0, 1, 2


def _ranges(codes: np.ndarray) -> list[tuple[int, int]]:
    """Runs of equal values as (first, past the last)."""
    edges = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(codes)]
    return list(zip(edges, edges[1:], strict=False)) if len(codes) else []


def _codes(column: pa.Array) -> np.ndarray:
    """Small numbers for the values of a column, NULL being a value too."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)


class _Tile:
    """Running sums of one tile for every combination of ``by``."""

    def __init__(self, events: pa.Table, by: list[str], ramps: list[str], counts: list[str]):
        code = np.zeros(events.num_rows, np.int64)
        for name in by:
            own = _codes(events[name])
            code = code * (own.max() + 1 if len(own) else 1) + own
        position = events["_pos"].to_numpy()
        order = np.lexsort((position, code))
        self.position, self.sums, self.first = [], [], []  # one entry per combination
        columns = [events[w].to_numpy() for w in [*ramps, *counts]]
        moments = [events[f"_v_{w}"].to_numpy() for w in ramps]
        for low, high in _ranges(code[order]):
            rows = order[low:high]
            running = [np.concatenate(([0], np.cumsum(c[rows]))) for c in [*columns, *moments]]
            self.position.append(position[rows])
            self.sums.append(running)
            self.first.append(int(rows[0]))
        self.keys = events.select(by)

    def values(self, k: int, x: np.ndarray, n_ramps: int, n_counts: int) -> list[np.ndarray]:
        """Per ramp the sum of weight * (x - position), per count that of the weights, of all positions below ``x``."""
        at, sums = np.searchsorted(self.position[k], x, "left"), self.sums[k]
        weights = [s[at] for s in sums[:n_ramps + n_counts]]
        moments = [s[at] for s in sums[n_ramps + n_counts:]]
        return [x * w - v for w, v in zip(weights[:n_ramps], moments, strict=True)] + weights[n_ramps:]


def _looked_up(by: list[str], ramps: list[str], counts: list[str], steps: bool):
    outputs = [*ramps, *counts]

    def answers(tile: _Tile, number: int, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        points = rows["_points"]
        x = points.flatten().to_numpy(zero_copy_only=False)
        sizes = np.diff(points.offsets.to_numpy())
        begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        here = np.flatnonzero((x >> TILE_BITS) == number)
        payload = rows["_query"]
        ends = np.cumsum(sizes) - 1
        inner = np.ones(len(x), bool)
        if steps:
            inner[ends] = False
        lengths = sizes - 1 if steps else sizes
        offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32())
        for k in range(len(tile.position)):
            found, any_ = [], np.zeros(len(sizes), bool)
            for own in tile.values(k, x[here], len(ramps), len(counts)):
                full = np.zeros(len(x), np.int64)
                full[here] = own
                any_ |= np.logical_or.reduceat(full != 0, begins)
                if steps:
                    full = np.concatenate((full[1:] - full[:-1], [0]))[inner]
                found.append(pa.ListArray.from_arrays(offsets, pa.array(full)))
            keep = pa.array(np.flatnonzero(any_))
            if not len(keep):
                continue
            same = pa.array(np.full(len(keep), tile.first[k]))
            keys = [tile.keys[name].combine_chunks().take(same) for name in by]
            yield pa.RecordBatch.from_arrays([payload.take(keep), *keys, *[f.take(keep) for f in found]],
                                             names=["_query", *by, *outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, tile = None, [], None
        names = [*by, "_pos", *outputs, *[f"_v_{w}" for w in ramps]]
        for batch in batches:
            number, kind = batch["_tile"].to_numpy(), batch["_kind"].to_numpy()
            chrom = _codes(batch["chrom"])
            query = (kind == _QUERY).astype(np.int64)
            turn = (chrom[1:] != chrom[:-1]) | (number[1:] != number[:-1]) | (query[1:] != query[:-1])
            for low, high in _ranges(np.concatenate(([0], np.cumsum(turn)))):
                rows = batch.slice(low, high - low)
                at = (rows["chrom"][0].as_py(), int(number[low]))
                if at != place:
                    place, held, tile = at, [], None
                if not query[low]:
                    held.append(rows.select(names))
                elif held:
                    tile = tile or _Tile(pa.Table.from_batches(held), by, ramps, counts)
                    yield from answers(tile, at[1], rows)

    return run


def sums_at(events: DataFrame, queries: DataFrame, by: list[str], ramps: list[str], counts: list[str] = (), *,
            steps: bool = False) -> DataFrame:
    """Sums of the events below the ``points`` of each query row, per combination of ``by`` among the events.

    ``events`` holds chrom, ``by``, pos and the weights (whole numbers);
    ``queries`` chrom, ``points`` (an array of positions) and further columns.
    For a weight named in ``ramps`` the sum is of weight * (point - pos), for
    one in ``counts`` of the weight, over all events of the chromosome with
    pos < point. The result has the columns of ``queries`` without ``points``,
    ``by`` and an array per weight, or its ``steps`` from point to point.

    A query whose points lie in several tiles comes in as many rows, to be
    added up; rows of zeros only are left out.
    """
    ramps, counts, by = list(ramps), list(counts), list(by)
    weights = [*ramps, *counts]
    tile = lambda c: F.shiftright(c, TILE_BITS)
    summed = events.where("chrom IS NOT NULL AND pos IS NOT NULL").groupBy("chrom", *by, F.col("pos").cast("long").alias("_pos")).agg(
        *[F.sum(w).cast("long").alias(w) for w in weights])
    summed = summed.withColumns({f"_v_{w}": F.col(w) * F.col("_pos") for w in ramps}).withColumn("_tile", tile("_pos"))
    moments = [f"_v_{w}" for w in ramps]
    payload = [c for c in queries.columns if c != "points"]
    asked = queries.where("chrom IS NOT NULL AND size(points) > 0 AND NOT exists(points, p -> p IS NULL)").select(
        "chrom", F.struct(*payload).alias("_query"), F.col("points").cast("array<long>").alias("_points"),
        F.explode(F.array_distinct(F.transform(F.col("points").cast("array<long>"), tile))).alias("_tile"))

    # one row per tile and combination: what lies in all tiles before it
    totals = summed.groupBy("chrom", *by, "_tile").agg(*[F.sum(c).alias(c) for c in [*weights, *moments]])
    kinds = totals.select("chrom", *by).distinct()
    places = asked.select("chrom", "_tile").distinct().join(kinds, "chrom").select(
        "chrom", *by, "_tile", *[F.lit(0).cast("long").alias(c) for c in [*weights, *moments]])
    before = Window.partitionBy("chrom", *by).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    every = totals.unionByName(places).groupBy("chrom", *by, "_tile").agg(*[F.sum(c).alias(c) for c in [*weights, *moments]])
    carries = every.select("chrom", *by, "_tile", (F.shiftleft("_tile", TILE_BITS) - 1).alias("_pos"),
                           *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in [*weights, *moments]])

    blank = asked.schema["_query"].dataType, asked.schema["_points"].dataType
    nothing = [F.lit(None).cast(blank[0]).alias("_query"), F.lit(None).cast(blank[1]).alias("_points")]
    shape = ["chrom", "_tile", *by, "_pos", *weights, *moments]
    kinds_of = dict(zip(summed.columns, summed.schema.fields, strict=True))
    own = [F.lit(None).cast(kinds_of[c].dataType).alias(c) for c in shape[2:]]
    rows = carries.select(*shape, F.lit(_CARRY).alias("_kind"), *nothing).unionByName(
        summed.select(*shape, F.lit(_EVENT).alias("_kind"), *nothing)).unionByName(
        asked.select("chrom", "_tile", *own, F.lit(_QUERY).alias("_kind"), "_query", "_points"))
    rows = rows.repartition("chrom", "_tile").sortWithinPartitions("chrom", "_tile", "_kind")

    out = T.StructType([rows.schema["_query"], *[kinds_of[c] for c in by],
                        *[T.StructField(w, T.ArrayType(T.LongType())) for w in weights]])
    found = rows.mapInArrow(_looked_up(by, ramps, counts, steps), out)
    return found.select("_query.*", *by, *weights)

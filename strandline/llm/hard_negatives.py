"""Hard negatives: angles to reference directions bound every score, and only rows whose bounds overlap a window are scored."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import cut
from strandline.llm.sharding import numbered

#: Reference directions, and the rows of least hash among which they are looked for.
DIRECTIONS, LOOKED_AT = 12, 1024
#: Rows of a block and anchors of a group: what a task holds at once, at most about BYTES of vectors.
BLOCK, GROUP, BYTES = 1024, 256, 8_000_000
#: Groups whose best rows a task keeps before it hands them on.
HELD = 64
#: Radians by which stored angles may be off.
SLACK = 1e-6


def usable(rows: DataFrame, vec_id: str, label: str, vector: str, anchor: Column) -> DataFrame:
    """(vec_id, label, vector, anchor) of the rows that take part."""
    rows = rows.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("anchor")).where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    return rows.where(~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))


def whole(vector: list[float], scale: int) -> np.ndarray:
    """floor(scale * x) of the components."""
    out = np.floor(scale * np.asarray(vector, float))
    if len(out) and np.abs(out).max() >= 2.0**62:
        raise OverflowError("a component is too large for scores of 64 bits")
    return out.astype(np.int64)


def directions(rows: DataFrame, scale: int, many: int = DIRECTIONS, looked_at: int = LOOKED_AT) -> np.ndarray:
    """Unit vectors far from each other, each the farthest row from those before, among the rows of least hash. They only
    decide how tight the bounds are, never what is found."""
    sample = rows.select("vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(looked_at).collect()  # at most looked_at rows
    found = [whole(r["vector"], scale).astype(float) for r in sample]
    width = max(map(len, found), default=0)
    x = np.array([np.pad(v, (0, width - len(v))) for v in found]).reshape(len(found), width)
    x = x[np.linalg.norm(x, axis=1) > 0]
    if not len(x):
        return np.zeros((0, max(width, 1)))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    chosen, nearest = [0], x @ x[0]
    while len(chosen) < min(many, len(x)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    return x[chosen]


def angles(x: np.ndarray, norms: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Angle of each row to each direction; a right angle for zero rows."""
    width = min(x.shape[1], refs.shape[1])
    cosines = (x[:, :width].astype(float) @ refs[:, :width].T) / np.maximum(norms, 1e-300)[:, None]
    return np.arccos(np.clip(cosines, -1, 1))


def _located(refs: np.ndarray, scale: int) -> Callable:
    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, near, codes = [], [], []
            for vector in batch.column(2):
                v = whole(vector.as_py(), scale)
                a = angles(v[None, :], np.linalg.norm(v.astype(float))[None], refs)[0]
                cells.append(int(a.argmin()) if len(a) else 0)
                near.append(float(a.min()) if len(a) else 0.0)
                codes.append(v.tobytes())
            yield pa.record_batch(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(codes, pa.binary()), pa.array(cells, pa.int32()), pa.array(near, pa.float64())],
                ["vec_id", "label", "anchor", "code", "cell", "near"])

    return locate


class Rows:
    """Vectors of a block or group, with norms and angles."""

    def __init__(self, ids: list[int], labels: list[str], codes: list[bytes], refs: np.ndarray):
        vectors = [np.frombuffer(c, np.int64) for c in codes]
        width = max(map(len, vectors), default=0)
        self.x = np.zeros((len(vectors), max(width, 1)), np.int64)
        for row, v in zip(self.x, vectors, strict=True):
            row[: len(v)] = v
        self.ids, self.labels = np.array(ids, np.int64), np.array(labels, object)
        self.floats = self.x.astype(float)
        self.norms = np.linalg.norm(self.floats, axis=1)
        self.angles = angles(self.x, self.norms, refs)

    def same_label(self, other: Rows) -> np.ndarray:
        known = {label: k for k, label in enumerate({*self.labels, *other.labels})}
        mine, theirs = (np.array([known[label] for label in r.labels]) for r in (self, other))
        return mine[:, None] == theirs[None, :]

    def bounds(self, other: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each of these rows with each of the other's: by the triangle inequality on the
        sphere the angle of a pair lies between the difference and the sum of their angles to a direction."""
        shape = (len(self.ids), len(other.ids))
        least, most = np.zeros(shape), np.full(shape, np.pi)
        for a, b in zip(self.angles.T, other.angles.T, strict=True):
            np.maximum(least, np.abs(a[:, None] - b[None, :]), out=least)
            total = a[:, None] + b[None, :]
            np.minimum(most, np.minimum(total, 2 * np.pi - total), out=most)
        norms = self.norms[:, None] * other.norms[None, :]
        spare = 1 + 1e-9 * norms
        low = norms * np.cos(np.minimum(most + SLACK, np.pi)) - spare
        return np.floor(low), np.ceil(norms * np.cos(np.maximum(least - SLACK, 0)) + spare)

    def scores(self, i: int, other: Rows, which: np.ndarray) -> np.ndarray:
        """Exact inner products of row i with the rows `which` of the other."""
        width, most = min(self.x.shape[1], other.x.shape[1]), self.norms[i] * other.norms[which].max(initial=0.0)
        if most < 2.0**52:  # no partial sum of doubles is rounded below that
            return (other.floats[which, :width] @ self.floats[i, :width]).astype(np.int64)
        if most >= 2.0**62:
            raise OverflowError("a score may exceed 64 bits")
        return other.x[which, :width] @ self.x[i, :width]


def first(scores: np.ndarray, ids: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """The `many` highest scores with their ids, ties by the smaller id."""
    order = np.lexsort((ids, -scores))[:many]
    return scores[order], ids[order]


_NONE = (np.zeros(0, np.int64), np.zeros(0, np.int64))
_BLOCK = "labels array<string>, ids array<long>, codes array<binary>"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to blocks; of equal rows, which follow each other, one."""
    ids, labels, codes, size, last = [], [], [], 0, None

    def block() -> pa.RecordBatch:
        return pa.record_batch([pa.array([labels], pa.list_(pa.string())), pa.array([ids], pa.list_(pa.int64())), pa.array([codes], pa.list_(pa.binary()))], ["labels", "ids", "codes"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row == last:
                continue
            if ids and (len(ids) >= BLOCK or size + len(row[2]) > BYTES):
                yield block()
                ids, labels, codes, size = [], [], [], 0
            ids.append(row[0])
            labels.append(row[1])
            codes.append(row[2])
            size, last = size + len(row[2]), row
    if ids:
        yield block()


def _grouped(anchors: DataFrame, extra: list[str]) -> DataFrame:
    """One row a group of anchors, by number."""
    cells = ["number", "vec_id", "label", "code", *extra]
    rows = anchors.groupBy(F.floor(F.col("number") / GROUP).alias("group")).agg(F.array_sort(F.collect_list(F.struct(*cells))).alias("anchors"))
    return rows.select("group", *[F.col(f"anchors.{c}").alias(f"a_{c}") for c in cells])


def _met(blocks: DataFrame, groups: DataFrame, n_groups: int) -> DataFrame:
    """Every block with every group of the stated anchors."""
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(max(n_groups - 1, 0)).cast("long"))
    return blocks.withColumn("group", F.explode(numbers)).join(groups, "group")


class _Best:
    """Best rows so far of each anchor's windows; bounded, as groups that have waited longest are handed on."""

    def __init__(self, many: int):
        self.many, self.groups = many, {}

    def of(self, group: int) -> dict:
        return self.groups.setdefault(group, {})

    def put(self, group: int, key: tuple, scores: np.ndarray, ids: np.ndarray) -> None:
        s, i = self.of(group).get(key, _NONE)
        self.of(group)[key] = first(np.concatenate([s, scores]), np.concatenate([i, ids]), self.many)

    def out(self, keep: int) -> Iterator[pa.RecordBatch]:
        while len(self.groups) > keep:
            held = self.groups.pop(next(iter(self.groups)))
            rows = [(*key, s, i) for key, (scores, ids) in held.items() for s, i in zip(scores.tolist(), ids.tolist(), strict=True)]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["number", "place", "score", "vec_id"])


def _kth(scores: np.ndarray, many: int) -> float:
    return float(scores[many - 1]) if len(scores) >= many else -np.inf


def _searched(refs: np.ndarray, many: int, windows: Callable | None) -> Callable:
    """Joined blocks and groups to the best rows by anchor and window. Without `windows`, rows of the anchor's label."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, seen, block = _Best(many), None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["ids"] is not seen and (seen is None or row["ids"] != seen):
                    seen, block = row["ids"], Rows(row["ids"], row["labels"], row["codes"], refs)
                group = Rows(row["a_vec_id"], row["a_label"], row["a_code"], refs)
                allowed = group.same_label(block)
                if windows:
                    allowed = ~allowed
                allowed &= group.ids[:, None] != block.ids[None, :]
                if allowed.any():
                    low, high = group.bounds(block)
                    for i, number in enumerate(row["a_number"]):
                        spans = windows(row["a_scores"][i]) if windows else [(None, None)]
                        _scan(best, row["group"], number, spans, group, i, block, allowed[i], low[i], high[i], many)
            yield from best.out(HELD)
        yield from best.out(0)

    return search


def _scan(best: _Best, key: int, number: int, spans: list[tuple], group: Rows, i: int, block: Rows, allowed: np.ndarray, low: np.ndarray, high: np.ndarray, many: int) -> None:
    """Scores the rows of a block whose bounds overlap a window of anchor i above its `many` best so far."""
    held, open_rows = best.of(key), np.zeros(len(allowed), bool)
    for place, (least, most) in enumerate(spans):
        if least is not None and least > most:
            continue
        reach = _kth(held.get((number, place), _NONE)[0], many)
        if least is None:  # rows sure to score as much as the many-th lower bound leave no room for others below it
            lows = low[allowed]
            reach = max(reach, np.partition(lows, len(lows) - many)[len(lows) - many] if len(lows) >= many else -np.inf)
            open_rows |= allowed & (high >= reach)
        else:
            open_rows |= allowed & (high >= max(reach, least)) & (low <= most)
    which = np.flatnonzero(open_rows)
    if not len(which):
        return
    scores = group.scores(i, block, which)
    for place, (least, most) in enumerate(spans):
        inside = np.ones(len(which), bool) if least is None else (scores >= least) & (scores <= most)
        if inside.any():
            best.put(key, (number, place), *first(scores[inside], block.ids[which[inside]], many))


_FOUND = "number long, place int, score long, vec_id long"


def _ranked(found: DataFrame, keys: list[str], many: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= many)


def mine(rows: DataFrame, anchor: Column, *, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100, scale: int = 256,
         vec_id: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """Hard negatives of the rows for which `anchor` holds. Scores are inner products of floor(scale * x) components. An
    anchor's positives are the first rows of its label, by score and smaller vec_id; for each of them, the first rows
    of other labels that score from `least` to `most` percent of it. Null anchor conditions don't hold.

    Rows with a null vec_id, label or vector or a null or non-finite component take no part; missing components of
    shorter vectors count as 0; empty and zero vectors score 0. Equal rows count once; rows of one vec_id with other
    vectors or labels each take part, but never as a partner of their own id. Components or scores beyond 62 bits raise
    an OverflowError. Anchors without positives, and positives without negatives, have no rows; other columns are
    ignored. Every anchor meets every row, in blocks of bounded size; bounds decide which pairs are scored.
    Columns: anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    part = usable(rows, vec_id, label, vector, anchor)
    refs = directions(part, scale)
    order = ["label", "cell", "near", "vec_id", "code"]
    located = part.mapInArrow(_located(refs, scale), "vec_id long, label string, anchor boolean, code binary, cell int, near double")
    # the order keeps rows of a label and direction together, so that most of a block lies on one side of a window
    blocks = cut(located.repartitionByRange(*order).sortWithinPartitions(*order).select("vec_id", "label", "code").mapInArrow(_packed, _BLOCK))
    anchors = numbered(located.where("anchor").select(*order).distinct(), order, "number")
    anchors = cut(anchors.select("number", "vec_id", "label", "code"))
    n_groups = -(-anchors.count() // GROUP)

    found = _met(blocks, _grouped(anchors, []), n_groups).mapInArrow(_searched(refs, positives, None), _FOUND)
    held = cut(_ranked(found, ["number"], positives).select("number", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    lists = held.groupBy("number").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda p: p["positive_score"]).alias("scores"))

    def windows(scores: list[int]) -> list[tuple[int, int]]:
        return [(-(-s * least // 100), s * most // 100) for s in scores]

    asked = anchors.join(lists, "number")
    found = _met(blocks, _grouped(asked, ["scores"]), n_groups).mapInArrow(_searched(refs, negatives, windows), _FOUND)
    ranked = _ranked(found, ["number", "place"], negatives).select("number", (F.col("place") + 1).alias("place"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = ranked.join(held, ["number", "place"]).join(anchors.select("number", F.col("vec_id").alias("anchor_id")), "number")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

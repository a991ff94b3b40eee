"""Ranks, quantiles and running values keep rows with NULL values and NULL groups."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strandline.operators import ordering

ROWS = [(1, "a", 3.0), (2, "a", None), (3, "a", 1.0), (4, None, 5.0), (5, None, 5.0), (6, None, None)]
SCHEMA = "id int, g string, v double"


def by_id(df, *columns):
    return {r["id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_null_groups_and_values(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    ranks = by_id(ordering.average_rank(df, ["g"], "v", "rank", size="size"), "rank", "size")
    assert ranks == {1: (3.0, 3), 2: (1.0, 3), 3: (2.0, 3), 4: (2.5, 3), 5: (2.5, 3), 6: (1.0, 3)}
    assert by_id(ordering.percentile(df, ["g"], "v", "p"), "p")[1] == (100.0,)
    middle = {r["g"]: (r["low"], r["middle"]) for r in ordering.quantiles(df, ["g"], "v", {"low": 0.25, "middle": 0.5}).collect()}
    assert middle == {"a": (1.5, 2.0), None: (5.0, 5.0)}
    mean = by_id(ordering.moving_average(df, ["g"], [F.col("id")], "v", 2, "mean"), "mean")
    assert mean == {1: (3.0,), 2: (1.0,), 3: (None,), 4: (5.0,), 5: (5.0,), 6: (None,)}
    total = ordering.running(df, ["g"], [F.col("id")], {"total": ("sum", F.col("v"))}, inclusive=False)
    assert by_id(total, "total") == {1: (None,), 2: (3.0,), 3: (3.0,), 4: (None,), 5: (5.0,), 6: (10.0,)}
    assert by_id(ordering.row_numbers(df, ["g"], [F.desc("id")], "n"), "n") == {1: (3,), 2: (2,), 3: (1,), 4: (3,), 5: (2,), 6: (1,)}


def test_without_groups(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    ranks = by_id(ordering.average_rank(df, [], "v", "rank", size="size"), "rank", "size")
    assert ranks == {1: (4.0, 6), 2: (1.5, 6), 3: (3.0, 6), 4: (5.5, 6), 5: (5.5, 6), 6: (1.5, 6)}
    assert ordering.median(df, [], "v", "m").first()["m"] == 4.0


@pytest.mark.parametrize("tile", [4, 1 << 20])
def test_scan_of_null_groups(spark, monkeypatch, tile):
    monkeypatch.setattr(ordering, "TILE_BASES", tile)
    rows = [(g, p, p % 5) for g in ("a", None) for p in range(-9, 30, 3)]
    df = spark.createDataFrame(rows, "g string, p long, v long")
    got = ordering.scan(df, ["g"], "p", {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}, {"b": ("min", F.col("v"))}, "n", ["v"]).collect()
    assert len(got) == len(rows)
    for r in got:
        own = [x for x in rows if x[0] == r["g"]]
        up, down = [v for _, p, v in own if p <= r["p"]], [v for _, p, v in own if p >= r["p"]]
        following = min(((p, v) for _, p, v in own if p > r["p"]), default=None)
        assert (r["s"], r["m"], r["b"], r["n"] and tuple(r["n"])) == (sum(up), max(up), min(down), following)

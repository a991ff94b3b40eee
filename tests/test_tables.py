"""Expression tables and profiles with absent values."""

from __future__ import annotations

from strandline.operators import comparison, expression

LONG = "gene string, sample string, value double"


def test_absent_samples_count_as_zero(spark):
    rows = [("a", "s1", 2.0), ("a", "s2", 0.5), ("b", "s1", 9.0), ("c", "s1", 5.0), ("c", "s2", None), ("d", "s1", 3.0), ("d", "s2", 0.0)]
    assert [r["gene"] for r in expression.expressed_genes(spark.createDataFrame(rows, LONG)).collect()] == ["a"]


def test_spike_table_keeps_detected_controls(spark):
    rows = [(g, s, v) for g, v in (("SPIKE-0001_x", 2.0), ("SPIKE-0002", 0.0), ("SPIKE-0004", 4.0), ("gene", 7.0)) for s in ("s1", "s2")]
    rows.append(("SPIKE-0003", "s1", 4.0))
    controls = spark.createDataFrame([(f"SPIKE-000{i}" + "_x" * (i == 1),) for i in range(1, 5)], "gene string")
    listed = spark.createDataFrame([("SPIKE-0001", 10.0), ("SPIKE-0002", 20.0), ("SPIKE-0003", 30.0), ("SPIKE-0004_long", 40.0), ("gene", 50.0)],
                                   "control_id string, concentration double")
    got = expression.spike_table(spark.createDataFrame(rows, LONG), controls, listed)
    assert sorted(map(tuple, got.select("gene", "sample", "value", "concentration").collect())) == [
        ("SPIKE-0001_x", "s1", 2.0, 10.0), ("SPIKE-0001_x", "s2", 2.0, 10.0)]


def test_flat_profiles_have_no_cluster(spark):
    rows = [(i, float(i % 2), float(1 - i % 2), 0.0) for i in range(20)] + [(20, 1.0, 1.0, 1.0), (21, None, 1.0, 2.0)]
    matrix = spark.createDataFrame(rows, "id int, a double, b double, c double")
    found = {r["id"]: r["cluster"] for r in comparison.region_clusters(matrix, ["a", "b", "c"], 2).collect()}
    assert len(found) == 22 and found[20] is None and found[21] is None
    assert {found[i] for i in range(0, 20, 2)} != {found[i] for i in range(1, 20, 2)} and None not in {found[i] for i in range(20)}
    flat = comparison.region_clusters(matrix.where("id = 20"), ["a", "b", "c"], 2).collect()
    assert [(r["id"], r["cluster"]) for r in flat] == [(20, None)]

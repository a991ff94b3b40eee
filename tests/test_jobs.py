"""Composite jobs end to end on the smallest tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from strandline.operators import genes
from strandline.operators import regions as region_sets
from strandline.plans import jobs
from strandline.session import checkpointed
from strandline.sources.views import SAMPLES, Views

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def tables(spark):
    v = Views(spark, FOLDER)
    kept = {name: checkpointed(getattr(v, name)()) for name in ("reads", "files", "file_chroms", "annotation")}
    return v, kept["reads"], kept["files"], kept["file_chroms"], kept["annotation"]


def test_two_conditions(spark, tables):
    v, reads, files, chroms, annotation = tables
    names = {1: "one", 2: "two"}
    ranked = []
    for status, name in (("F", "one"), ("O", "two")):
        out = jobs.enhancer_ranking(v.peaks(status), reads, files, chroms, names, name, window=100)
        ranked.append(checkpointed(out["super"]))
    changes = jobs.dynamic_enhancers(*[r.withColumn("signal", F.greatest("signal", F.lit(1.0))) for r in ranked], reads, files,
                                     chroms, names, "one", "two", annotation, window=5000, super_only=False)
    table = checkpointed(changes["table"])
    assert table.count() == changes["delta"].count() > 0
    assert {r["status"] for r in table.select("status").distinct().collect()} <= {"one", "two", "CONSERVED"}
    assert table.where("rank_1 is null or rank_2 is null").count() == 0


def test_replicates_and_stretch(spark, tables):
    v, reads, files, chroms, annotation = tables
    starts = genes.start_table(annotation)
    out = jobs.replicate_ranking([v.peaks("F"), v.peaks("O")], reads, files, chroms, {1: "a", 2: "b", 3: "c"},
                                 [("a", "c"), ("b", "c")], 100, starts, 500)
    rows = out["super"].select("enhancer_rank").collect()
    assert sorted(r["enhancer_rank"] for r in rows) == list(range(1, len(rows) + 1))


def test_consensus_and_tracks(spark, tables):
    v, reads, files, chroms, annotation = tables
    # wide regions on the chromosomes with reads, so that every sample has a median above 0
    both = region_sets.widened(v.peaks("F").unionByName(v.peaks("O")).drop("signal"), 300)
    both = both.join(chroms.select("chrom").distinct(), "chrom", "left_semi")
    out = jobs.consensus_clusters(both, "x", reads, files, chroms, {1: "a", 2: "b", 3: "c"},
                                  {"a": ("a", None), "b": ("b", None), "c": ("c", None)}, k=3)
    assert out["correlation"].count() == 6
    tracks = jobs.locus_tracks(v.peaks().where("end - start > 440"), reads, files, chroms, annotation, n_bins=20)
    assert tracks["signal"].where("bin between 1 and 20").count() == tracks["signal"].count() > 0


def test_expression_and_probes(spark, tables):
    v, *_, annotation = tables
    groups = {"A": ["A_F", "A_O"], "R": ["R_F", "R_O"]}
    controls = v.table("part").where("p_type = 'ECONOMY'").select(F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("gene"))
    report = jobs.expression_report(v.expression(), groups, "^A", "^R", controls)
    assert report["differential"].where("p_value < 0 or p_value > 1").count() == 0
    assert report["replicates"].count() == 2 and report["top"].count() <= 20
    rows = v.expression_matrix().select(F.col("gene").alias("probe"), F.monotonically_increasing_id().alias("row"), *SAMPLES)
    listed = v.table("part").select(F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("probe"),
                                    F.concat(F.lit("NM_"), F.col("p_partkey").cast("string"), F.lit(".2")).alias("transcript"),
                                    F.col("p_name").alias("name"))
    best = jobs.probe_genes(rows, listed, genes.start_table(annotation), SAMPLES)
    assert best.count() == rows.count()

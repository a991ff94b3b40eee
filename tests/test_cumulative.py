"""Sums below positions against pairs by hand, with many reads and regions in one place."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import coverage
from strandline.plans import jobs

READS = "file_key int, chrom string, start long, end long, strand string, cigar string"
REGIONS = "id string, chrom string, start long, end long, strand string"
FORWARD = {"+": lambda r, q: q == "." or q == r, "-": lambda r, q: q == "." or q == {"+": "-", "-": "+"}.get(r), ".": lambda r, q: True}


def made(n_reads=300, n_regions=80, seed=4, top=40_000, long=60):
    """Places on both sides of 0 and of the tiles' edges; keys and rows repeat, some values are null."""
    rng = random.Random(seed)
    place = lambda: rng.choice([0, 8192, 16384]) + rng.randint(-300, 300) if rng.random() < 0.7 else rng.randint(-500, top)
    reads = []
    for _ in range(n_reads):
        start = place()
        reads.append((rng.choice([1, 2, 2]), rng.choice(["c1", "c1", "c2"]), start, start + rng.randint(0, long), rng.choice("+-"),
                      rng.choice(["9M", "9M", "4M9N5M"])))
    regions = []
    for i in range(n_regions):
        start = place()
        regions.append((f"r{i % (n_regions - 3)}", rng.choice(["c1", "c1", "c2"]), start, start + rng.choice([0, 1, 7, 40, 300, 20_000]),
                        rng.choice("+-.")))
    reads += [*reads[:5], (1, None, 3, 9, "+", "9M"), (1, "c1", None, 9, "+", "9M"), (2, "c1", 3, None, "-", "9M")]
    regions += [*regions[:3], ("rn", None, 1, 9, "+"), ("rs", "c1", None, 9, "+")]
    return reads, regions


def pairs(reads, regions, mode):
    for file_key, chrom, start, end, strand, cigar in reads:
        for id_, c, a, b, own in regions:
            if None not in (chrom, c, start, end, a, b) and chrom == c and a < b and start < b and end >= a and FORWARD[mode](strand, own):
                yield file_key, chrom, start, end, strand, cigar, id_, a, b, own


def grown(start, end, strand, extension):
    if not extension:
        return start, end
    return (start, end + extension) if strand == "+" else (max(0, start - extension), end)


@pytest.mark.parametrize("extension", [0, 35, 9000])
@pytest.mark.parametrize("mode", [".", "+", "-"])
def test_region_hits_by_hand(spark, mode, extension):
    reads, regions = made()
    wanted = {}
    for file_key, chrom, start, end, strand, _, id_, a, b, own in pairs(reads, regions, mode):
        low, high = grown(start, end, strand, extension)
        key = (file_key, id_, chrom, a, b, own)
        wanted[key] = wanted.get(key, 0) + max(0, min(high, b) - max(low, a))
    found = coverage.region_hits(spark.createDataFrame(reads, READS), spark.createDataFrame(regions, REGIONS), extension=extension, mode=mode)
    got = {(r.file_key, r.id, r.chrom, r.start, r.end, r.strand): r["count"] for r in found.collect()}
    assert got == {k: v for k, v in wanted.items() if v}


@pytest.mark.parametrize("extension", [0, 35])
def test_piece_counts_by_hand(spark, extension):
    reads, regions = made(seed=5)
    wanted = {}
    for file_key, chrom, start, end, strand, _, id_, a, b, own in pairs(reads, regions, "+"):
        low, high = grown(start, end, strand, extension)
        width = (b - a) // 4
        for piece in range(4 if width else 0):
            bases = min(high, a + (piece + 1) * width) - max(low, a + piece * width)
            if bases > 0:
                key = (file_key, id_, chrom, a, b, own, piece)
                wanted[key] = wanted.get(key, 0) + bases
    found = coverage.piece_counts(spark.createDataFrame(reads, READS), spark.createDataFrame(regions, REGIONS), 4, extension=extension,
                                  mode="+", by=["file_key"])
    assert {(r.file_key, r.id, r.chrom, r.start, r.end, r.strand, r.piece): r["count"] for r in found.collect()} == wanted


def test_reads_and_starts_by_hand(spark):
    reads, regions = made(seed=6)
    totals, starts = {}, {}
    for file_key, chrom, start, end, strand, cigar, id_, a, b, own in pairs(reads, regions, "."):
        if "N" not in cigar:
            cell = totals.setdefault((id_, chrom, a, b, own), [0, 0])
            cell[0] += 1
            cell[1] += strand == ("+" if own == "." else own)
            starts[id_, strand, start + 1] = starts.get((id_, strand, start + 1), 0) + 1
    reads, regions = spark.createDataFrame(reads, READS), spark.createDataFrame(regions, REGIONS)
    counted = coverage.region_read_counts(reads, regions).collect()
    assert {(r.id, r.chrom, r.start, r.end, r.strand): [r.total, r.sense] for r in counted if r.total} == totals
    assert all(r.total == r.sense + r.antisense for r in counted)
    assert {(r.id, r.strand, r.read_start): r.n for r in coverage.region_starts(reads, regions).collect()} == starts


def test_scores_and_depth_by_hand(spark):
    _, regions = made(seed=7)
    rng = random.Random(8)
    lines = [(rng.choice(["c1", "c2"]), s := rng.choice([0, 8192]) + rng.randint(-400, 400), s + rng.randint(0, 700), rng.uniform(-3, 600))
             for _ in range(200)]
    segments = [("c1", s := 50 * k - 300, s + rng.randint(0, 49), rng.randint(0, 4), rng.randint(0, 4)) for k in range(250)]
    whole = [r for r in dict.fromkeys(regions) if None not in r and r[3] > r[2]]
    frame = spark.createDataFrame(whole, REGIONS)
    means = coverage.mean_conservation(frame, spark.createDataFrame(lines, "chrom string, start long, end long, score double"))
    means = {(r.id, r.start, r.end, r.strand): r.conservation for r in means.collect()}
    depth = coverage.region_depths(frame, spark.createDataFrame(segments, "chrom string, start long, end long, plus long, minus long"), floor=2)
    depth = {(r.id, r.chrom, r.start, r.end, r.strand): (r.sense_density, r.antisense_density) for r in depth.collect()}
    for id_, chrom, a, b, own in whole:
        total = 0.0
        for c, s, e, score in lines:
            if c == chrom and s <= b and e >= a:
                total += score * (min(e, b) - a + 1 if s < a else b - s if e > b else e - s)
        assert means[id_, a, b, own] == pytest.approx(total / (b - a + 1), abs=1e-9)
        sums = [0, 0]
        for c, s, e, plus, minus in segments:
            if c == chrom and plus + minus > 2:
                bases = max(0, min(e, b - 1) - max(s, a + 1) + 1)
                sums[0] += bases * (minus if own == "-" else plus)
                sums[1] += bases * (plus if own == "-" else minus)
        assert depth[id_, chrom, a, b, own] == pytest.approx(tuple(x / (b - a + 1) for x in sums), abs=6e-5)


def test_no_pairs_are_built(spark):
    """100,000 reads on 20,000 regions of one place would be 2e9 pairs."""
    reads = spark.range(100_000).selectExpr("1 AS file_key", "'c1' AS chrom", "id % 900 AS start", "id % 900 + 60 AS end", "'+' AS strand",
                                            "'60M' AS cigar")
    regions = spark.range(20_000).selectExpr("concat('r', id) AS id", "'c1' AS chrom", "100 + id % 300 AS start", "700 + id % 300 AS end",
                                             "'+' AS strand")
    chroms = spark.createDataFrame([(1, "a", "c1", 5000)], "file_key int, cell_type string, chrom string, length long")
    files = spark.createDataFrame([(1, 100_000)], "file_key int, mapped long")
    made = {
        "counts": coverage.region_counts(reads, regions, chroms, extension=20, mode="+"),
        "reads": coverage.region_read_counts(reads, regions),
        "bins": coverage.piece_densities(reads, regions, files, chroms, n_bins=3),
        "scores": coverage.mean_conservation(regions, reads.withColumn("score", F.lit(0.5))),
    }
    for name, df in made.items():
        assert "_b_end" not in df._jdf.queryExecution().executedPlan().toString(), name
        assert df.agg(F.count(F.lit(1))).first()[0] == 20_000 * (3 if name == "bins" else 1)


def test_many_probes_of_a_name(spark):
    """20,000 probes and 20,000 genes of one name would be 4e8 pairs; the best probe of the name serves them all."""
    key = F.col("id").cast("string")
    rows = spark.range(20_000).select(F.concat(F.lit("p"), key).alias("probe"), F.col("id").alias("row"), (F.col("id") % 5_000).cast("double").alias("s"))
    listed = rows.select("probe", F.lit("XR_1.1").alias("transcript"), F.lit("x").alias("name")).unionByName(spark.createDataFrame(
        [("p3", "NM_7.1", "x"), ("p0", "NM_8.1", "y")], "probe string, transcript string, name string"))
    starts = spark.range(20_000).select(F.concat(F.lit("NM_"), key).alias("id"), F.when(F.col("id") == 8, "y").otherwise("x").alias("name"))
    out = jobs.probe_genes(rows, listed, starts, ["s"]).groupBy("name", "s").agg(F.count(F.lit(1)).alias("n")).collect()
    assert sorted(map(tuple, out)) == [("x", 4999.0, 19_999), ("y", 0.0, 1)]

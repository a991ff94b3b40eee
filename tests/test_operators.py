"""Operators against brute force, and bounds on their plans."""

from __future__ import annotations

import hashlib
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.functions import loci
from strandline.functions import reads as rd
from strandline.functions.sequence import reverse_complement
from strandline.operators import (collections, coverage, expression, genes, matrices, ordering, overlaps, ranking,
                                  screen, sequences, stitching)
from strandline.plans import jobs
from strandline.plans.queries import QUERIES
from strandline.sources.views import Views

LOCUS = "id string, chrom string, start long, end long, strand string"
FLIP = {"+": "-", "-": "+", ".": "."}


def random_loci(n, seed, lengths=(1, 30, 700, 5000, 40_000, 3_000_000), span=200_000, prefix="a"):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        start = r.randint(-500, span)
        rows.append((f"{prefix}{i}", r.choice(["c1", "c2"]), start, start + r.choice(lengths), r.choice("+-.")))
    return rows


def meets(x, y):
    return x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3]


def strands(x, y, mode):
    if mode == "both":
        return True
    other = FLIP[y[4]] if mode == "antisense" else y[4]
    return "." in (x[4], y[4]) or x[4] == other


@pytest.fixture(scope="module")
def two_sets(spark, tmp_path_factory):
    a, b = random_loci(250, 1), random_loci(180, 2, prefix="b")
    frames = []
    for name, rows in (("a", a), ("b", b)):
        path = str(tmp_path_factory.mktemp("loci") / name)
        spark.createDataFrame(rows, LOCUS).write.parquet(path)
        frames.append(spark.read.parquet(path))
    return a, b, *frames


RELATIONS = {"overlap": meets, "contained": lambda x, y: x[1] == y[1] and y[2] <= x[2] and x[3] <= y[3],
             "contains": lambda x, y: x[1] == y[1] and x[2] <= y[2] and y[3] <= x[3]}


@pytest.mark.parametrize("mode,relation", [("sense", "overlap"), ("antisense", "contained"), ("both", "contains")])
def test_overlap_join(two_sets, mode, relation):
    a, b, fa, fb = two_sets
    want = sorted((x[0], y[0]) for x in a for y in b if RELATIONS[relation](x, y) and strands(x, y, mode))
    got = overlaps.overlap_join(fa, fb, mode, relation).select("id", "b_id").collect()
    assert sorted(map(tuple, got)) == want


@pytest.mark.parametrize("relation", ["overlap", "contained"])
@pytest.mark.parametrize("mode", ["sense", "antisense", "both"])
@pytest.mark.parametrize("longest", [40, 6000, 5_000_000])
def test_overlap_filter(spark, frame, mode, relation, longest):
    """Against brute force, with partners of all lengths, some equal, empty or at the edges of windows."""
    lengths = [n for n in (0, 1, 30, 511, 512, 513, 5000, 40_000, 300_000, 3_000_000) if n <= longest]
    a = random_loci(220, 11, (0, 1, 30, 700, 5000, 40_000, 3_000_000), 300_000)
    b = random_loci(40, 12, lengths, 300_000, "b") + [("e0", "c1", 512, 1023, "+"), ("e1", "c2", 1024, 1024 + min(longest, 32768), "-")]
    a += [("x0", "c1", 1023, 1024, "."), ("x1", "c1", 512, 1023, "-"), ("x2", "c2", 1024, 1600, "+"), ("x3", None, 0, 9, "+")]
    want = {x[0] for x in a for y in b if x[1] and RELATIONS[relation](x, y) and strands(x, y, mode)}
    fa, fb = frame(a, LOCUS), frame(b, LOCUS)
    for keep, ids in ((True, want), (False, {x[0] for x in a} - want)):
        got = overlaps.overlap_filter(fa, fb, mode, relation, keep=keep).select("id").collect()
        assert sorted(r["id"] for r in got) == sorted(ids)


def test_partners_in_one_window_are_reduced(spark):
    """A million mask rows in one window become as many rows as the window has places at most."""
    mask = spark.range(1_000_000).selectExpr("'c1' AS chrom", "1024 + id % 500 AS b_start", "1024 + id % 500 + id % 7 AS _b_end")
    finest = overlaps.window_cover(mask, ["chrom"], 9).where("pmod(_key, 4) = 0")
    assert finest.count() <= 514 and finest.where("_piece >= 0").groupBy("_key").count().agg(F.max("count")).first()[0] <= 512
    assert overlaps.window_cover(mask, ["chrom"], 9).where("pmod(_key, 4) > 0").count() == 3
    assert overlaps.window_reach(mask, ["chrom"], 9).count() <= 514
    wide = spark.range(100_000).selectExpr("'c1' AS chrom", "id % 90000 AS b_start", "id % 90000 + 40000 + id % 5000 AS _b_end")
    per_window = overlaps.window_cover(wide, ["chrom"], 9).groupBy("_key").count()
    assert per_window.agg(F.max("count")).first()[0] <= 3
    shortest = overlaps.window_reach(wide, ["chrom"], 9).groupBy("_key").count().where("pmod(_key, 4) > 0")
    assert shortest.agg(F.max("count")).first()[0] == 1


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().collectLeaves().size()


def test_plans_read_their_inputs_few_times(frame):
    """No probing for hot windows: every input is read for the pairs, the widths in use and the zero rows only."""
    loci_frame = frame(random_loci(20, 1), LOCUS)
    reads = frame([(1, "c1", 0, 10, "+")], "file_key int, chrom string, start long, end long, strand string")
    chroms = frame([(1, "ct", "c1", 100)], "file_key int, cell_type string, chrom string, length long")
    starts = frame([("NM_1", "g", "c1", "+", 5000, 5100)], "id string, name string, chrom string, strand string, tss long, tts long")
    assert scans(overlaps.overlap_join(loci_frame, loci_frame)) == 2
    assert scans(overlaps.not_overlapping(loci_frame, loci_frame)) == 3
    counts = coverage.region_counts(reads, loci_frame, chroms)
    assert scans(counts) == 4 and scans(genes.gene_pairs(loci_frame, starts, loci_frame)) == 5
    assert "Exchange" in counts._jdf.queryExecution().executedPlan().toString()


def brute_stitch(rows, window):
    """Transitive closure of "within window" per chromosome."""
    unique = {}
    for row in rows:
        key = row[1:]
        unique[key] = min(unique.get(key, row[0]), row[0])
    groups = []
    for chrom in sorted({k[0] for k in unique}):
        todo = [(k, i) for k, i in unique.items() if k[0] == chrom]
        while todo:
            group = [todo.pop()]
            grown = True
            while grown:
                low, high = min(k[1] for k, _ in group), max(k[2] for k, _ in group)
                near = [m for m in todo if m[0][1] <= high + window and m[0][2] >= low - window]
                grown = bool(near)
                group += near
                todo = [m for m in todo if m not in near]
            first = min(group, key=lambda m: (m[0][1], m[0][2], m[0][3], m[1]))
            strand = group[0][0][3] if len(group) == 1 else "."
            groups.append((f"{len(group)}_{first[1]}_lociStitched", chrom, min(k[1] for k, _ in group),
                           max(k[2] for k, _ in group), strand))
    return sorted(groups)


@pytest.fixture
def narrow_tiles(monkeypatch):
    """Tiles of 256 bases, so that values are carried over many of them."""
    monkeypatch.setattr(ordering, "TILE_BASES", 256)


def test_stitch(frame, narrow_tiles):
    rows = random_loci(120, 3, lengths=(1, 40, 300, 2000)) + [("zz", "c1", 5, 9, "+"), ("aa", "c1", 5, 9, "+")]
    got = stitching.stitch(frame(rows, LOCUS), 250).select("id", "chrom", "start", "end", "strand")
    assert sorted(map(tuple, got.collect())) == brute_stitch(rows, 250)


def test_sweep(frame, narrow_tiles):
    """The gap form agrees with stitching anew at every window."""
    rows = random_loci(80, 4, lengths=(40, 300)) + random_loci(30, 5, lengths=(10, 5000), span=3000, prefix="c")
    peaks = frame(rows, LOCUS)
    swept = {r["step"]: r for r in stitching.stitch_sweep(peaks, 3000, 1000).collect()}
    assert sorted(swept) == [0, 1000, 2000, 3000]
    base = stitching.stitch(peaks, 0).select("id", "chrom", "start", "end", "strand")
    for step, row in swept.items():
        merged = stitching.stitch(base, step, extra={"constit": loci.length()}).collect()
        region, constit = ([r["end"] - r["start"] + 1 for r in merged], [r["constit"] for r in merged])
        assert (row["num_regions"], row["total_constit"], row["total_region"]) == (len(merged), sum(constit), sum(region))
        assert row["median_region"] == pytest.approx(np.median(region), abs=0.01)
        assert row["median_stitch_fraction"] == pytest.approx(np.median(np.array(constit) / region), abs=0.006)


def test_order_statistics(frame):
    r = random.Random(5)
    rows = [(i, i % 2, float(r.choice([0, 0, 0, 1, 2, 3.5, 9]))) for i in range(300)]
    df = frame(rows, "id long, g long, v double")
    by = {g: [v for _, h, v in rows if h == g] for g in (0, 1)}

    def rank(v, values):
        return sum(x < v for x in values) + (sum(x == v for x in values) + 1) / 2

    got = ordering.percentile(df, ["g"], "v", "p").collect()
    for row in got:
        values = by[row["g"]]
        assert row["p"] == pytest.approx((rank(row["v"], values) - 1) / (len(values) - 1) * 100)
    for row in ordering.quantiles(df, ["g"], "v", {"a": 0.37, "m": 0.5}).collect():
        assert row["a"] == pytest.approx(np.quantile(by[row["g"]], 0.37))
        assert row["m"] == pytest.approx(np.median(by[row["g"]]))
    order = [F.col("v"), F.col("id")]
    numbered = ordering.row_numbers(df, [], order, "n").collect()
    assert [x["id"] for x in sorted(numbered, key=lambda x: x["n"])] == [
        i for i, _, v in sorted(rows, key=lambda t: (t[2], t[0]))]
    values = [v for _, _, v in sorted(rows, key=lambda t: (t[2], t[0]))]
    smooth = ordering.moving_average(df, [], order, "v", 5, "s")
    smooth = [x["s"] for x in sorted(smooth.collect(), key=lambda x: (x["v"], x["id"]))]
    assert smooth[:2] == [None, None] and smooth[2] == pytest.approx(np.mean(values[:5]))
    assert smooth[150] == pytest.approx(np.mean(values[148:153]))


def test_tangent_cutoff(frame):
    r = random.Random(6)
    for n in (1, 40):
        values = [round(r.paretovariate(1.0), 2) - 1.2 for _ in range(n)]
        vector = sorted(max(v, 0.0) for v in values)
        slope = (vector[-1] - vector[0]) / n
        best = min(range(n), key=lambda i: (vector[i] - slope * (i + 1), i))
        df = frame([(v,) for v in values], "v double")
        assert ranking.tangent_cutoff(df, "v").first()[0] == vector[best]
    # the chosen point has the fewest points on or below its tangent
    below = [sum(v <= vector[i] + slope * (j - i) + 1e-9 for j, v in enumerate(vector)) for i in range(n)]
    assert below[best] == min(below)


def test_region_counts(frame):
    r = random.Random(7)
    reads = [(1, "ct", "c1" if i % 3 else "c2", s := r.randint(0, 900), s + r.randint(1, 60), r.choice("+-")) for i in range(300)]
    regions = [(f"r{i}", "c1", s := r.randint(0, 800), s + r.randint(0, 200), r.choice("+-.")) for i in range(40)]
    f_reads = frame(reads, "file_key int, cell_type string, chrom string, start long, end long, strand string")
    f_regions = frame(regions, LOCUS)
    chroms = frame([(1, "ct", "c1", 2000), (1, "ct", "c2", 2000)], "file_key int, cell_type string, chrom string, length long")
    want = {}
    for g in regions:
        total = 0
        for _, _, chrom, s, e, strand in reads:
            if chrom == "c1" and s < g[3] and e >= g[2]:
                a, b = (s, e + 25) if strand == "+" else (max(0, s - 25), e)
                total += max(0, min(b, g[3]) - max(a, g[2]))
        want[g[0]] = total
    got = coverage.region_counts(f_reads, f_regions, chroms, extension=25).collect()
    assert {r["id"]: r["count"] for r in got} == want
    empty = [g[0] for g in regions if g[2] == g[3]]
    files = frame([(1, 300)], "file_key int, mapped long")
    dens = coverage.region_densities(coverage.region_counts(f_reads, f_regions, chroms), files)
    assert {r["id"] for r in dens.where("density is null").collect()} == set(empty)


def test_depth_segments(frame, narrow_tiles):
    rows = [("c1", 5, 9, "+"), ("c1", 8, 12, "-"), ("c1", 20, 20, "+"), ("c1", 5, 9, "+")]
    df = frame(rows, "chrom string, start long, end long, strand string")
    want = [(5, 7, 2, 0), (8, 9, 2, 1), (10, 12, 0, 1), (20, 20, 1, 0)]
    got = coverage.depth_segments(df).orderBy("start").select("start", "end", "plus", "minus").collect()
    assert [tuple(r) for r in got] == want


def test_short_regions_have_no_bins(frame):
    reads = frame([(1, "c1", 0, 10, "+")], "file_key int, chrom string, start long, end long, strand string")
    regions = frame([("short", "c1", 1, 3, "+"), ("long", "c1", 0, 19, "-")], LOCUS)
    files = frame([(1, 1_000_000)], "file_key int, mapped long")
    chroms = frame([(1, "ct", "c1", 100)], "file_key int, cell_type string, chrom string, length long")
    out = coverage.piece_densities(reads, regions, files, chroms, n_bins=4)
    arrays = {r["id"]: r["densities"] for r in coverage.density_arrays(out).collect()}
    assert arrays["short"] == [None] * 4
    # pieces of floor(19 / 4) bases, density over floor(20 / 4), reversed on minus
    assert arrays["long"] == [0.0, round(2 / 5, 4), round(4 / 5, 4), round(4 / 5, 4)]


def test_nearest_gene(frame, monkeypatch):
    monkeypatch.setattr(ordering, "TILE_BASES", 100_000)
    r = random.Random(8)
    regions = [(f"r{i}", "c1", s := r.randint(0, 3_000_000), s + r.randint(1, 5000), ".") for i in range(60)]
    notes = [(f"NM_{i}", f"g{i % 30}", "c1", r.choice("+-"), t := r.randint(0, 3_000_000) // 50 * 50, t + 400, i) for i in range(50)]
    f_regions = frame(regions, LOCUS)
    annotation = frame(notes, "id string, name string, chrom string, strand string, tx_start long, tx_end long, row long")
    starts = genes.start_table(annotation)
    pairs = genes.gene_pairs(f_regions, starts, genes.transcripts(annotation), 10_000)
    tss = {n[0]: n[5] if n[3] == "-" else n[4] for n in notes}
    want = {}
    for rid, _, s, e, _ in regions:
        found = []
        for n in notes:
            t = tss[n[0]]
            kind = 0 if n[4] <= e and s <= n[5] else 1 if s - 10_000 <= t <= e + 10_000 else 2 if s - 10**6 <= t <= e + 10**6 else None
            if kind is not None:
                found.append((abs((s + e) // 2 - t), kind, n[0], n[1]))
        if found:
            want[rid] = min(found)[3]
    got = genes.nearest_gene(f_regions, starts, pairs).collect()
    assert {r["id"]: r["closest_gene"] for r in got} == want


@pytest.mark.parametrize("reach", [1_000_000, 3000])
def test_nearest_gene_of_few_pairs(frame, monkeypatch, reach):
    """Repeated ids, equal TSS, transcripts longer than the reach, and regions with equal ids: the closest of all pairs."""
    monkeypatch.setattr(ordering, "TILE_BASES", 5000)
    r = random.Random(11)
    regions = [(f"r{i}" if i % 9 else f"r{i // 27}", r.choice(["c1", "c2"]), s := r.randint(0, 20_000) // 20 * 20,
                s + r.choice([0, 1, 40, 2000]), ".") for i in range(300)]
    regions += [(None, "c1", 100, 200, "."), ("r_null", None, 100, 200, "."), ("r_open", "c1", None, 200, "."), regions[3]]
    notes = [(f"NM_{i if i % 6 else i // 12}", f"g{i}", r.choice(["c1", "c2"]), r.choice("+-"), t := r.randint(0, 20_000) // 400 * 400,
              t + r.choice([0, 20, 400, 1000, 9000]), i) for i in range(120)]
    notes += [("NM_open", "go", "c1", "+", None, 900, 900), (None, "gn", "c1", "-", 300, 340, 901)]
    f_regions = frame(regions, LOCUS)
    annotation = frame(notes, "id string, name string, chrom string, strand string, tx_start long, tx_end long, row long")
    starts, places = genes.start_table(annotation), genes.transcripts(annotation)
    every = genes.gene_pairs(f_regions, starts, places, 700)
    few = genes.gene_pairs(f_regions, starts, places, 700, closest=reach)
    want = {tuple(x) for x in genes.nearest_gene(f_regions, starts, every, reach).collect()}
    assert {tuple(x) for x in genes.nearest_gene(f_regions, starts, few, reach).collect()} == want
    assert len(want) > 250
    ids = lambda pairs: {tuple(x) for x in pairs.select("id", "chrom", "gene_id").collect()}
    assert ids(few) <= ids(every)


def test_nearest_gene_makes_no_row_per_pair(spark, tmp_path, monkeypatch):
    """200 regions that all touch 200 transcripts: a few pairs per region."""
    views = {"annotation": [(f"NM_{i:03d}", f"g{i}", "c1", "+", 1000 + i % 7, 4000 + i, i) for i in range(200)],
             "peaks": [(f"r{i}", "c1", 2000 + i, 2100 + i, ".") for i in range(200)]}
    schema = {"annotation": "id string, name string, chrom string, strand string, tx_start long, tx_end long, row long", "peaks": LOCUS}
    for name, rows in views.items():
        monkeypatch.setattr(Views, name, lambda self, name=name, rows=rows: spark.createDataFrame(rows, schema[name]))
    seen, nearest = [], genes.nearest_gene
    monkeypatch.setattr(genes, "nearest_gene", lambda regions, starts, pairs, *more: seen.append(pairs) or nearest(regions, starts, pairs, *more))
    got = {tuple(x) for x in QUERIES["nearest_gene"](spark, str(tmp_path)).collect()}
    assert got == {(f"r{i}", "g6", (4100 + 2 * i) // 2 - 1006) for i in range(200)}
    assert seen[0].count() <= 600


def test_greedy_windows(spark, frame):
    r = random.Random(9)
    peaks = [(f"p{i}", "c1", s := r.randint(0, 20_000), s + r.randint(10, 400), r.choice([1, 2])) for i in range(80)]
    peaks += [(f"h{i}", "c1", s := 9000 + i % 40, s + 20 + i % 3, 1) for i in range(150)] + [("wide", "c1", 0, 15_000, 2)]
    df = frame(peaks, "id string, chrom string, start long, end long, sample_rank int")
    starts = frame([("NM_1", "g", "c1", "+", 5000, 5100)], "id string, name string, chrom string, strand string, tss long, tts long")
    turn = {p[0]: hashlib.md5(f"{p[1]}:{p[2]}:{p[3]}".encode()).hexdigest() for p in peaks}
    chosen = []
    for p in sorted(peaks, key=lambda p: (p[4], turn[p[0]], p[0])):
        if p[2] <= 5300 and p[3] >= 4700:
            continue
        if all(not (p[2] <= w[2] and w[1] <= p[3]) for w in chosen):
            c = (p[2] + p[3]) // 2
            chosen.append((p[0], c - 250, c + 250))
    got = genes.greedy_windows(df, starts, window=250, tss_window=300).select("id", "start", "end").collect()
    assert sorted(map(tuple, got)) == sorted(chosen)


def student_p(t, df):
    """Two-sided p by numerical integration of the density."""
    x = np.linspace(0, abs(t), 200_001)
    c = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
    return 1 - 2 * np.trapezoid(c * (1 + x * x / df) ** (-(df + 1) / 2), x)


def test_p_values(spark):
    p = expression.two_sided_p()
    for t, df in [(0.0, 3.0), (0.4, 1.7), (2.1, 1.0), (-3.3, 7.4), (12.0, 2.5), (1.0, 60.0)]:
        assert p(np.array([t]), np.array([df]))[0] == pytest.approx(student_p(t, df), abs=1e-8)
    rows = [("g1", "A_1", 1.0), ("g1", "A_2", 2.0), ("g1", "B_1", 5.0), ("g1", "B_2", 9.0),
            ("g2", "A_1", 3.0), ("g2", "A_2", 3.0), ("g2", "B_1", 3.0), ("g2", "B_2", 3.0),
            ("g3", "A_1", 3.0), ("g3", "B_1", 4.0), ("g3", "B_2", 6.0)]
    long = spark.createDataFrame(rows, "gene string, sample string, value double")
    table = {r["gene"]: r for r in expression.differential(long, "^A", "^B").collect()}
    g1 = table["g1"]
    assert g1["t"] == pytest.approx((1.5 - 7) / math.sqrt(0.25 + 4))
    assert g1["df"] == pytest.approx(4.25 ** 2 / (0.25 ** 2 + 4 ** 2))
    assert g1["p_value"] == pytest.approx(student_p(g1["t"], g1["df"]), abs=1e-8)
    assert table["g2"]["p_value"] == 1.0 and table["g3"]["p_value"] is None
    assert g1["log2_fold_change"] == pytest.approx(math.log2(7 / 1.5))


def test_locus_functions(spark):
    df = spark.createDataFrame([("c1", -7, -2, "+", "x"), ("c1", 30, 10, "-", "y")], "chrom string, start long, end long, strand string, id string")
    rows = {r["id"]: r for r in loci.normalise(df).select(
        "*", loci.centre().alias("c"), loci.length().alias("n"), loci.text().alias("t")).collect()}
    assert rows["x"]["c"] == -5 and rows["y"]["n"] == 21 and rows["y"]["t"] == "c1(-):10-30"
    with pytest.raises(Exception, match="unknown strand"):
        loci.normalise(df.withColumn("strand", F.lit("*"))).collect()
    with pytest.raises(Exception, match="not a region"):
        df.select(F.lit("chr1:1-100").alias("t")).select(loci.parse_region("t")["chrom"]).collect()
    flanks = {r["id"]: (r["start"], r["end"]) for r in loci.flank(loci.normalise(df), 100, 5).collect()}
    assert flanks == {"x": (-107, 3), "y": (5, 130)}
    with pytest.raises(Exception, match="more than once"):
        collections.require_unique(df.unionByName(df)).collect()


def test_read_functions(spark):
    rows = [("10M", 0, 5), ("3S5M2I4D1M100N2M", 16, 5), ("5M10N5M", 0, 10), ("2M1N2M1N2M", 0, 6)]
    df = spark.createDataFrame([(c, f, 100, n) for c, f, n in rows], "cigar string, flag int, pos long, seq_len long")
    spans = {r["cigar"]: (r["end"] - r["start"], r["strand"]) for r in rd.with_span(df).collect()}
    assert spans == {"10M": (10, "+"), "3S5M2I4D1M100N2M": (112, "-"), "5M10N5M": (20, "+"), "2M1N2M1N2M": (8, "+")}
    pieces = rd.read_loci(rd.with_span(df.where("cigar in ('10M', '5M10N5M', '2M1N2M1N2M')"))).orderBy("cigar", "part")
    assert [(r["cigar"], r["start"], r["end"]) for r in pieces.collect()] == [
        ("10M", 101, 106), ("5M10N5M", 101, 106), ("5M10N5M", 116, 121)]
    seq = spark.createDataFrame([("ACGTNacg",)], "s string")
    assert seq.select(reverse_complement("s"), reverse_complement("s", reverse=False, rna=True)).first() == ("cgtNACGT", "UGCANugc")


def test_exons(spark):
    rows = [("NM_1", "c1", "-", 100, 400, 150, 350, "100,200,300,", "160,260,400,", "g"),
            ("NR_2", "c1", "+", 100, 200, 0, 0, "100,", "200,", "h")]
    df = spark.createDataFrame(rows, "id string, chrom string, strand string, tx_start long, tx_end long, cds_start long, "
                                     "cds_end long, exon_starts string, exon_ends string, name string")
    got = {r["id"]: r for r in genes.exon_arrays(df).collect()}
    pairs = lambda cells: [tuple(c) for c in cells]
    one = got["NM_1"]
    assert pairs(one["coding_exons"]) == [(150, 160), (200, 260), (300, 350)]
    assert pairs(one["introns"]) == [(160, 200), (260, 300)]
    assert pairs(one["utr3"]) == [(100, 150)] and pairs(one["utr5"]) == [(350, 400)]
    assert got["NR_2"]["is_coding"] == 0 and pairs(got["NR_2"]["coding_exons"]) == [] and pairs(got["NR_2"]["introns"]) == []


def test_screen(spark):
    folds = screen.fold_table(
        spark.createDataFrame([("a", 10), ("b", 0), ("c", 4)], "guide string, count long"),
        spark.createDataFrame([("a", 2), ("b", 6), ("c", 4)], "guide string, count long"),
        spark.createDataFrame([("a", "X"), ("b", "X")], "guide string, gene string"), 2.0, 1.0)
    rows = {r["guide"]: r for r in folds.collect()}
    assert rows["a"]["log2_ratio"] == pytest.approx(math.log2(6 / 3)) and rows["c"]["gene"] == ""
    ranks = screen.construct_ranks(folds).orderBy("construct_rank").collect()
    assert [(r["guide"], r["construct_rank"], r["hairpin_weight"]) for r in ranks] == [("a", 1, 1), ("b", 2, 1)]
    records = spark.createDataFrame([("xxCACCGABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789" * 3 + "0123"), ("CACCGab", "1234567"), ("none", "1234")],
                                    "seq string, qual string")
    got = [(r["guide"], r["guide_qual"]) for r in screen.extract_guides(records).collect()]
    assert got == [("ABCDEFGHIJKLMNOPQRST", "78901234567890123456"), ("ab", "67")]
    assert tuple(screen.extraction_stats(records, "CACCG").first()) == (3, 2, 2 / 3)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sequences(spark, tmp_path, no_broadcast):
    text = "".join(random.Random(3).choice("ACGT") for _ in range(333))
    genome = spark.createDataFrame([("c1", text), ("c2", text[::-1])], "chrom string, sequence string")
    tiles = sequences.store_genome(genome, f"genome_{tmp_path.name}", str(tmp_path / "genome"), size=50, buckets=4)
    regions = spark.createDataFrame([("a", "c1", 50, 161, "+"), ("b", "c1", 99, 100, "+"), ("c", "c1", 0, 333, "+")], LOCUS)
    fetched = sequences.fetch(regions, tiles, 50)
    plan = fetched._jdf.queryExecution().executedPlan().toString()
    genome_side = plan[plan.index("SortMergeJoin"):].split("FileScan")[0].split("\n")
    assert "Bucketed: true" in plan and not any("Exchange" in line for line in genome_side[genome_side.index(max(
        (x for x in genome_side if "Exchange" in x), key=genome_side.index)) + 1:])
    got = {r["id"]: r["sequence"] for r in fetched.collect()}
    assert got == {"a": text[50:161], "b": text[99:100], "c": text}
    one = {r["id"]: r["sequence"] for r in sequences.fetch(regions.where("id = 'a'"), tiles, 50, zero_based=False).collect()}
    assert one == {"a": text[49:160]}


def test_occupancy_logic_and_medians(spark, frame):
    regions = frame([("r1", "c1", 0, 10, "."), ("r2", "c1", 50, 60, "."), ("r3", "c2", 0, 5, ".")], LOCUS)
    peaks = frame([("c1", 5, 8, "s1"), ("c1", 55, 70, "s2"), ("c1", 9, 52, "s3")], "chrom string, start long, end long, sample string")
    out = jobs.occupancy(regions, peaks, ["s1", "s2", "s3"], [["s1", "s3"], ["s2"]])
    cells = {r["id"]: (r["s1"], r["s2"], r["s3"]) for r in out["matrix"].collect()}
    assert cells == {"r1": (1, 0, 1), "r2": (0, 1, 1), "r3": (0, 0, 0)}
    assert {r["id"] for r in out["selected"].collect()} == {"r1", "r2"}
    matrix = frame([("r1", 10.0, 4.0), ("r2", 3.0, 5.0), ("r3", 8.0, 2.0)], "id string, t double, c double")
    got = matrices.median_normalised(matrix, {"s": ("t", "c")}).collect()
    assert {r["id"]: r["s"] for r in got} == {"r1": 1.0, "r2": 0.0, "r3": 1.0}


def test_row_sample_is_stable(spark):
    df = spark.range(5000).selectExpr("concat('g', id) AS gene", "id % 3 AS v")
    runs = [sorted(map(tuple, expression.row_sample(df.repartition(n), 100).collect())) for n in (1, 200)]
    assert runs[0] == runs[1] and len(runs[0]) == 100
    want = sorted((f"g{i}", i % 3) for i in sorted(range(5000), key=lambda i: hashlib.md5(f"7:g{i}".encode()).hexdigest())[:100])
    by_gene = expression.row_sample(df, 100, by=["gene"]).collect()
    assert sorted(map(tuple, by_gene)) == want


def test_correlation_of_many_samples(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(60, 5)) * [1, 1e-3, 5, 1, 0] + [1e6, 0, 3, -2, 7]
    data[:, 3] += data[:, 2]
    rows = [[None if rng.random() < 0.1 else float(x) for x in row] for row in data]
    names = list("abcde")
    got = {(r["sample_a"], r["sample_b"]): r["r"] for r in expression.sample_correlation(
        spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(7), names).collect()}
    assert len(got) == 15
    for i, a in enumerate(names):
        for j, b in list(enumerate(names))[i:]:
            x, y = zip(*[(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None])
            if "e" in (a, b):
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-6)


def test_plan_of_a_thousand_samples(spark):
    names = [f"s{i}" for i in range(1000)]
    wide = spark.range(50).select("id", *[(F.col("id") * (i % 7) % 11).cast("double").alias(n) for i, n in enumerate(names)])
    began = time.perf_counter()
    rows = expression.sample_correlation(wide, names)
    rows._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - began < 20  # the job for the means included
    assert rows.count() == 500_500

"""Read counting on single-read files, after the assertions of the counting suite in FIXTURES.md."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from strandline.operators import coverage
from strandline.plans import jobs
from strandline.sources import readers, readstore
from strandline.streaming import append

SEQUENCE = "ATTTAAAAATTAATTTAATGCTTGGCTAAATCTTAATTACATATATAATT"


def write_sam(path, chroms, sequence=SEQUENCE):
    path.parent.mkdir(parents=True, exist_ok=True)
    head = [f"@SQ\tSN:{c}\tLN:{len(sequence)}" for c in chroms]
    body = [f"read1\t16\t{c}\t1\t255\t{len(sequence)}M\t*\t0\t0\t{sequence}\t<<<" for c in chroms]
    path.write_text("\n".join(head + body) + "\n")
    return str(path)


def load(spark, root):
    """Reads, files and file_chroms of all SAM files below a folder."""
    files = readers.number_files(readers.discover(spark, str(root)))
    keys = files.select("file_path", "file_key", "cell_type")
    paths = [r["file_path"] for r in files.select("file_path").collect()]
    name = lambda df: df.withColumn("file_path", F.regexp_replace("file_path", "^file:/+", "/"))
    keys = name(keys)
    reads = name(readers.sam(spark, paths)).join(keys, "file_path")
    chroms = name(readers.header_chroms(spark, paths)).join(keys, "file_path")
    totals = reads.groupBy("file_key").agg(F.count(F.lit(1)).alias("mapped"))
    return reads, files.join(totals, "file_key"), chroms


def write_gff(path, rows):
    path.write_text("".join("\t".join(map(str, r)) + "\n" for r in rows))
    return str(path)


def region_row(chrom, name, start, stop, strand="."):
    return (chrom, name, "", start, stop, "", strand, "", name)


def count_regions(spark, tmp_path, regions_path, fmt=None, chroms=("chr1",), strand="_"):
    write_sam(tmp_path / "bam" / "single.sam", chroms)
    reads, files, file_chroms = load(spark, tmp_path / "bam")
    regions = readers.validated_regions(spark, regions_path, file_chroms, fmt=fmt, strand=strand)
    return jobs.region_counting(reads, regions, files, file_chroms, {1: "single.sam"})


def test_one_read_one_bin(spark, tmp_path):
    write_sam(tmp_path / "bam" / "single.sam", ["chr1"])
    reads, files, chroms = load(spark, tmp_path / "bam")
    tables = jobs.bin_counting(reads, files, chroms, 50)
    [row] = tables["bin_counts"].collect()
    assert (row["chrom"], row["bin_number"], row["count"], row["file_key"], row["cell_type"]) == ("chr1", 0, 50, 1, "-")
    assert files.first()["mapped"] == 1
    # a single bin has no percentile
    assert tables["summary"].first()["avg_cell_type_percentile"] is None


def test_bin_size_zero_fails(spark, tmp_path):
    write_sam(tmp_path / "bam" / "single.sam", ["chr1"])
    reads, _, chroms = load(spark, tmp_path / "bam")
    with pytest.raises(ValueError):
        coverage.bin_counts(reads, chroms, 0)


def test_two_chromosomes_and_blacklist(spark, tmp_path):
    write_sam(tmp_path / "bam" / "two.sam", ["chr1", "chr2", "chr2_random"])
    reads, files, chroms = load(spark, tmp_path / "bam")
    assert files.first()["mapped"] == 3
    got = {(r["chrom"], r["count"]) for r in coverage.bin_counts(reads, chroms, 50).collect()}
    assert got == {("chr1", 50), ("chr2", 50)}
    assert coverage.bin_counts(reads, chroms, 50, blacklist=[]).count() == 3


def test_region_count(spark, tmp_path):
    path = write_gff(tmp_path / "r.gff", [region_row("chr1", "region_f", 1, 8)])
    tables = count_regions(spark, tmp_path, path)
    row = tables["region_counts"].first()
    assert (row["id"], row["count"], row["start"], row["end"]) == ("region_f", 7, 1, 8)
    assert row["density"] == pytest.approx(1_000_000.0)
    matrix = tables["matrix"].first()
    assert (matrix["GENE_ID"], matrix["locusLine"], matrix["bin_1_single.sam"]) == ("region_f", "chr1(.):1-8", 1_000_000.0)


def test_region_strand(spark, tmp_path):
    rows = [region_row("chr1", "plus", 1, 8, "+"), region_row("chr1", "minus", 1, 8, "-")]
    path = write_gff(tmp_path / "r.gff", rows)
    write_sam(tmp_path / "bam" / "single.sam", ["chr1"])
    reads, _, chroms = load(spark, tmp_path / "bam")
    counts = coverage.region_counts(reads, readers.validated_regions(spark, path, chroms), chroms, mode="+")
    assert {r["id"]: r["count"] for r in counts.collect()} == {"plus": 0, "minus": 7}


@pytest.mark.parametrize("columns", [3, 4, 6, 9])
def test_optional_bed_columns(spark, tmp_path, columns):
    cells = ["chr1", "1", "8", "region1", "9.9", ".", "1", "8", "0"][:columns]
    path = tmp_path / "r.bed"
    path.write_text("\t".join(cells) + "\n")
    row = count_regions(spark, tmp_path, str(path))["region_counts"].first()
    assert row["count"] == 7 and row["id"] == ("region1" if columns > 3 else "")


def test_too_few_bed_columns_fail(spark, tmp_path):
    path = tmp_path / "r.bed"
    path.write_text("chr1\t1\n")
    with pytest.raises(Exception, match="fewer than 3 columns"):
        count_regions(spark, tmp_path, str(path))["region_counts"].collect()


def test_regions_that_do_not_count(spark, tmp_path):
    path = write_gff(tmp_path / "r.gff", [region_row("chr1", "far", 60, 70), region_row("chr10", "other", 1, 8)])
    assert count_regions(spark, tmp_path, path)["region_counts"].count() == 0
    empty = tmp_path / "empty.gff"
    empty.write_text("")
    assert count_regions(spark, tmp_path / "e", str(empty))["region_counts"].count() == 0


def test_long_names_and_other_extension(spark, tmp_path):
    path = write_gff(tmp_path / "r.txt", [region_row("chr1", "x" * 84, 1, 8), region_row("chr1", "y" * 64, 1, 8)])
    rows = count_regions(spark, tmp_path, path, fmt="gff")["region_counts"].collect()
    assert {r["id"] for r in rows} == {"x" * 84, "y" * 64}
    sizes = spark.createDataFrame([("chr1", 50)], "chrom string, length long")
    cut = readers.validated_regions(spark, path, sizes, fmt="gff", name_width=63)
    assert {r["id"] for r in cut.collect()} == {"x" * 63, "y" * 63}
    with pytest.raises(ValueError):
        readers.validated_regions(spark, path, spark.createDataFrame([("chr1", 5)], "chrom string, length long"))


def test_chromosome_names(spark, tmp_path):
    names = ["a" * 63, "chr1_random", "odd.name|1"]
    path = write_gff(tmp_path / "r.gff", [region_row(n, f"r{i}", 1, 8) for i, n in enumerate(names)])
    rows = count_regions(spark, tmp_path, path, chroms=names)["region_counts"].collect()
    assert len(rows) == 3
    for r in rows:
        assert r["count"] == 7 and r["density"] == pytest.approx(7 * (1 / 7) * (1 / (3 / 1e6)))
    sizes = spark.createDataFrame([("a" * 64, 50)], "chrom string, length long")
    with pytest.raises(Exception, match="too long"):
        readers.check_chromosomes(sizes, 63).collect()


def test_cell_type_is_the_folder(spark, tmp_path):
    write_sam(tmp_path / "bam" / "top.sam", ["chr1"])
    write_sam(tmp_path / "bam" / "a_long_cell_type_name" / "deep.sam", ["chr1"])
    files = readers.discover(spark, str(tmp_path / "bam"))
    assert {(r["file_name"], r["cell_type"]) for r in files.collect()} == {("top.sam", "-"), ("deep.sam", "a_long_cell_type_name")}
    files = readers.discover(spark, str(tmp_path / "bam"), width=15)
    assert {(r["file_name"], r["cell_type"]) for r in files.collect()} == {("top.sam", "-"), ("deep.sam", "a_long_cell_typ")}


READS = "file_name string, cell_type string, chrom string, start long, end long, strand string"
REGIONS = "id string, chrom string, start long, end long, strand string"


def some_reads(spark, names, seed=1):
    r = random.Random(seed)
    rows = [(name, "ct" + name[0], c, s := r.randint(0, 900), s + r.randint(1, 60), r.choice("+-"))
            for name in names for _ in range(60) for c in ("chr1", "chr2", "chr9_random")]
    return spark.createDataFrame(rows, READS)


def headers(spark, names):
    return spark.createDataFrame([(n, c, 1000) for n in names for c in ("chr1", "chr2", "chr9_random")],
                                 "file_name string, chrom string, length long")


def as_rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def keyed(df, names):
    """The keys a store gives: new files after the known ones, by name."""
    keys = df.sparkSession.createDataFrame([(n, i + 1, "ct" + n[0]) for i, n in enumerate(names)], "file_name string, file_key int, cell_type string")
    return df.drop("cell_type").join(keys, "file_name").drop("file_name")


@pytest.mark.parametrize("settings", [
    {"bin_size": 50}, {"bin_size": 70, "extension": 130, "strand": "-"}, {"bin_size": 100, "extension": 5, "blacklist": ["chr2"]},
    {"regions": True, "extension": 40}, {"regions": True, "extension": 25, "strand": "+"}, {"regions": True, "strand": "-"}])
def test_append_equals_one_run(spark, tmp_path, settings):
    """Several appends, with known and repeated files among them, count as one run over all files."""
    names = ["b.bam", "d.bam", "a.bam", "c.bam"]  # in the order of their keys
    reads, chroms, store = some_reads(spark, names), headers(spark, names), str(tmp_path / "store")
    r = random.Random(4)
    regions = spark.createDataFrame([(f"r{i}", c, s := r.randint(0, 800), s + r.randint(0, 150), r.choice("+-."))
                                     for i in range(25) for c in ("chr1", "chr2")], REGIONS)
    options = {k: v for k, v in settings.items() if k != "regions"}
    append.create_store(spark, store, **options, **({"regions": regions} if "regions" in settings else {}))
    assert append.stored_counts(spark, store, chroms).count() == 0
    assert append.append(reads.where("file_name IN ('b.bam', 'd.bam')"), store, "1").count() == 2
    assert append.append(reads.where("file_name IN ('b.bam', 'a.bam', 'c.bam')"), store, "2").count() == 2
    assert append.append(reads, store, "3").count() == 0
    assert {r["file_name"]: r["file_key"] for r in append.ledger(spark, store).collect()} == {n: i + 1 for i, n in enumerate(names)}
    all_reads, all_chroms = keyed(reads, names), keyed(chroms.withColumn("cell_type", F.lit("")), names)
    if "regions" in settings:
        want = coverage.region_counts(all_reads, regions, all_chroms, extension=options.get("extension", 0), mode=options.get("strand", "."))
    else:
        want = coverage.bin_counts(all_reads, all_chroms, **options)
    got = append.stored_counts(spark, store, chroms)
    assert as_rows(got) == as_rows(want) and got.where("count > 0").count() > 0


def test_append_counts_a_batch_once(spark, tmp_path):
    """A batch that ran again replaces itself, counts without a ledger entry don't exist, one of two copies counts."""
    names = ["x.bam", "y.bam"]
    reads, chroms, store = some_reads(spark, names), headers(spark, names), str(tmp_path / "store")
    append.create_store(spark, store, bin_size=50)
    append.append(reads, store, "7")
    once = as_rows(append.stored_counts(spark, store, chroms))
    append.append(reads, store, "7")
    assert as_rows(append.stored_counts(spark, store, chroms)) == once
    # an attempt that died before its ledger entry
    died = coverage.bin_hits(keyed(reads, names), 50).groupBy(*append.BIN_KEYS).agg(F.sum("count").alias("count"))
    died.write.parquet(f"{store}/counts/batch=8/attempt=dead")
    assert as_rows(append.stored_counts(spark, store, chroms)) == once
    other = str(tmp_path / "copies")
    append.create_store(spark, other, bin_size=50)
    copies = reads.withColumn("source", F.concat(F.lit("/a/"), "file_name")).unionByName(
        reads.withColumn("source", F.concat(F.lit("/b/"), "file_name")))
    append.append(copies, other, "1")
    assert as_rows(append.stored_counts(spark, other, chroms)) == once
    with pytest.raises(ValueError, match="bin_size or regions"):
        append.create_store(spark, str(tmp_path / "no"))


def test_derived_tables_of_a_store(spark, tmp_path):
    write_sam(tmp_path / "bam" / "a.sam", ["chr1", "chr2"], "A" * 50)
    write_sam(tmp_path / "bam" / "c.sam", ["chr1", "chr2"], "C" * 50)
    reads, files, chroms = load(spark, tmp_path / "bam")
    named = reads.drop("cell_type", "file_name").join(files.select("file_key", "file_name", "cell_type"), "file_key")
    store = str(tmp_path / "store")
    append.create_store(spark, store, bin_size=25)
    for name in ("a.sam", "c.sam"):
        append.append(named.where(F.col("file_name") == name), store, name)
    lengths = chroms.drop("file_name").join(files.select("file_key", "file_name"), "file_key")
    again = append.derived_tables(spark, store, lengths, files)
    once = jobs.bin_counting(reads, files, chroms, 25)
    for name in ("normalized_counts", "summary"):
        assert as_rows(again[name]) == as_rows(once[name])
    assert coverage.summary_violations(once["summary"], files).count() == 0


@pytest.mark.parametrize("settings", [{"bin_size": 50, "extension": 20}, {"regions": True, "extension": 20}])
def test_streaming_append(spark, tmp_path, settings):
    """Files that arrive one by one, some of them known, give the counts of one run; a restart adds nothing."""
    names = ["a.bam", "b.bam", "c.bam"]
    reads, chroms, store = some_reads(spark, names, 3), headers(spark, names), str(tmp_path / "store")
    regions = spark.createDataFrame([("r1", "chr1", 100, 300, "."), ("r2", "chr2", 0, 999, "+")], REGIONS)
    append.create_store(spark, store, **({"regions": regions} if "regions" in settings else {"bin_size": settings["bin_size"]}), extension=20)
    # b.bam is known to the store before the stream begins
    append.append(reads.where("file_name = 'b.bam'"), store, "before")
    run = 0
    for name in ("a.bam", "b.bam", "c.bam", "a.bam"):
        reads.where(F.col("file_name") == name).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        run += 1
        stream = spark.readStream.schema(READS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        append.start_append(stream, store, str(tmp_path / "ckpt")).awaitTermination()
    order = ["b.bam", "a.bam", "c.bam"]
    assert {r["file_name"]: r["file_key"] for r in append.ledger(spark, store).collect()} == {n: i + 1 for i, n in enumerate(order)}
    all_reads, all_chroms = keyed(reads, order), keyed(chroms.withColumn("cell_type", F.lit("")), order)
    if "regions" in settings:
        want = coverage.region_counts(all_reads, regions, all_chroms, extension=20)
    else:
        want = coverage.bin_counts(all_reads, all_chroms, 50, extension=20)
    assert as_rows(append.stored_counts(spark, store, chroms)) == as_rows(want)


def test_running_counts(spark, tmp_path):
    schema = "file_key int, cell_type string, chrom string, start long, end long, strand string"
    spark.createDataFrame([(1, "ct1", "chr1", i * 7, i * 7 + 20, "+") for i in range(40)], schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    memory = (append.running_counts(stream, 50).writeStream.format("memory").queryName("live").outputMode("complete")
              .option("checkpointLocation", str(tmp_path / "ckpt2")).trigger(availableNow=True).start())
    memory.awaitTermination()
    assert spark.table("live").agg(F.sum("count")).first()[0] == 40 * 20


def scanned_bytes(df):
    """Bytes of the files that the scans of a plan opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    rows, found = [plan], []
    while rows:
        node = rows.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            rows.append(node.executedPlan())
            continue
        metrics = node.metrics()
        if metrics.contains("filesSize"):
            found.append(metrics.apply("filesSize").value())
        rows += [node.children().apply(i) for i in range(node.children().size())]
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            rows.append(node.plan())
    return sum(found)


def test_read_store(spark, tmp_path):
    r = random.Random(6)
    rows = [(f"chr{r.randint(1, 3)}", s := r.randint(0, 4_000_000), s + r.randint(20, 150), r.choice("+-")) for _ in range(30_000)]
    rows += [("chr1", 100, 3_000_000, "+"), ("chr2", 70_000, 70_000 + (1 << 16), "-"), ("chr2", 5, 5 + (1 << 16) + 1, "-")]
    reads = spark.createDataFrame(rows, "chrom string, start long, end long, strand string")
    path = str(tmp_path / "store")
    readstore.store_reads(reads, path, tile_bits=16)
    every = readstore.stored_reads(spark, path, tile_bits=16)
    assert sorted(map(tuple, every.select("chrom", "start", "end", "strand").collect())) == sorted(rows)
    whole = scanned_bytes(every.select("*", F.col("start") + 1))
    for chrom, start, end in [("chr1", 1_500_000, 1_500_400), ("chr2", 70_000, 70_010), ("chr2", 65_541, 65_542), ("chr3", 0, 10), ("chr4", 0, 10)]:
        got = readstore.region_reads(spark, path, chrom, start, end, tile_bits=16)
        want = sorted(x for x in rows if x[0] == chrom and x[1] < end and x[2] >= start)
        assert sorted(map(tuple, got.select("chrom", "start", "end", "strand").collect())) == want
        assert scanned_bytes(got) < 0.05 * whole
    regions = spark.createDataFrame([("a", "chr1", 1_500_000, 1_500_400, "."), ("b", "chr3", 9_000, 9_900, "+")], REGIONS)
    near = readstore.nearby_reads(spark, path, regions, tile_bits=16)
    assert scanned_bytes(near) < 0.1 * whole
    counted = [sorted(map(tuple, coverage.region_hits(x.withColumn("file_key", F.lit(1)), regions).collect())) for x in (near, reads)]
    assert counted[0] == counted[1] and counted[0]
    assert readstore.nearby_reads(spark, path, regions.limit(0), tile_bits=16).count() == 0


def test_extension_and_strands(spark, frame):
    reads = frame([(1, "c", "chr1", 10, 20, "+"), (1, "c", "chr1", 60, 70, "-"), (1, "c", "chr1", 45, 50, "+")],
                  "file_key int, cell_type string, chrom string, start long, end long, strand string")
    chroms = frame([(1, "c", "chr1", 100)], "file_key int, cell_type string, chrom string, length long")
    bins = lambda **k: [r["count"] for r in coverage.bin_counts(reads, chroms, 50, **k).orderBy("bin_number").collect()]
    assert bins() == [15, 10]
    assert bins(strand="-") == [0, 10]
    # grown by 30: the read ending at 50 is looked at by both bins, the one at 60 only by its own
    assert bins(extension=30) == [40 + 5, 30 + 20]


def test_starts_as_text_are_sorted_as_numbers(spark):
    """Also past twelve digits; repeated starts, none on a strand, and rows of no strand or no reads."""
    big = 10**12
    rows = [("a", "+", big, 2), ("a", "+", big - 1, 1), ("a", "+", 7, 3), ("a", "-", 10, 1), ("a", "-", 9, 1), ("a", ".", 5, 1),
            ("b", "-", 3, 2), ("b", "+", 4, 0), (None, "+", 1, 1), (None, "+", 0, 1)]
    out = coverage.starts_text(spark.createDataFrame(rows, "id string, strand string, read_start long, n long"))
    assert {r["id"]: r["starts"] for r in out.collect()} == {
        "a": f"+:7,7,7,{big - 1},{big},{big};-:9,10", "b": "+:;-:3,3", None: "+:0,1;-:"}


def test_unique_reads_shuffle_no_pairs(spark):
    """Against brute force, with null names, ids of several places, empty and long regions and reads on window edges; and
    where many reads meet many regions, what is shuffled grows with the tables and not with the pairs."""
    rng = random.Random(17)
    reads_ddl = "chrom string, start long, end long, strand string, seq string, cigar string"
    region_ddl = "id string, chrom string, start long, end long, strand string"
    reads = [(rng.choice(["c1", "c2", None]), start := rng.randrange(-50, 9000), start + rng.randrange(60), rng.choice("+-"),
              rng.choice([None, *"abcdefgh"]), rng.choice(["5M", "5M", "2M9N3M"])) for _ in range(500)]
    regions = [(f"r{i // 2 if i < 20 else i}" if i % 17 else None, rng.choice(["c1", "c2", None]), start := rng.randrange(-50, 9000),
                start + rng.choice([-3, 0, 1, 40, 300, 2048, 2049, 7000]), rng.choice("+-.")) for i in range(150)]
    want = {}
    for i, chrom, start, end, strand in regions:
        for r in reads:
            if chrom and r[0] == chrom and end > start and r[1] < end and r[2] >= start and "N" not in r[5]:
                key, new = (i, r[4]), (*r[1:4], chrom, strand)
                want[key] = min(want.get(key, new), new, key=lambda x: x[:3])
    want = {(i, x[3], *x[:3], seq) for (i, seq), x in want.items() if x[4] in (".", x[2])}
    out = coverage.unique_reads(spark.createDataFrame(reads, reads_ddl), spark.createDataFrame(regions, region_ddl), "+", ["start", "end", "strand"])
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(want) and set(got) == want and 100 < len(got)

    crowd = spark.createDataFrame([("c1", k % 50, k % 50 + 30, "+", str(k), "5M") for k in range(300)], reads_ddl)
    places = spark.createDataFrame([(f"r{k}", "c1", k % 20, k % 20 + 60, "+") for k in range(300)], region_ddl)
    out = coverage.unique_reads(crowd, places, "+", ["start", "end", "strand"])
    assert out.count() == 300 * 300
    done = out._jdf.queryExecution()
    done.toRdd().count()
    plan = done.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    shuffled = [float(n) for n in re.findall(r"ShuffleQueryStage.*rowCount=([\dE+.]+)\)", plan)]
    assert shuffled and max(shuffled) <= 900

"""Text readers and writers."""

from __future__ import annotations

import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strandline.operators import sequences
from strandline.sources import readers, sinks


def put(path: Path, text: str) -> str:
    path.write_text(text)
    return str(path)


def text_of(folder) -> list[str]:
    """Lines of an output folder in the order of its part files."""
    return [line for part in sorted(Path(folder).glob("part-*")) for line in part.read_text().splitlines()]


def test_delimited_tables(spark, tmp_path):
    path = put(tmp_path / "t.txt", "h1\th2\th3\na\tb\t\t\n c\t\td \n")
    assert [list(r["cells"]) for r in readers.table(spark, path, header=True).collect()] == [["a", "b"], [" c", "", "d"]]
    with gzip.open(tmp_path / "z.txt.gz", "wt") as out:
        out.write("x,y\n")
    assert list(readers.table(spark, str(tmp_path / "z.txt.gz"), ",").first()["cells"]) == ["x", "y"]
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, n int").coalesce(1)
    sinks.write_table(df, str(tmp_path / "out"))
    assert text_of(tmp_path / "out") == ["a\t1", "b\tNA"]
    sinks.write_table(df, str(tmp_path / "one"), "")
    assert text_of(tmp_path / "one") == ["a", "b"]


def test_line_numbers_over_splits(spark, tmp_path):
    path = put(tmp_path / "long.txt", "".join(f"line {i}\n" for i in range(1, 3001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = readers.numbered_lines(spark, path)
        assert df.where(F.col("value") != F.concat(F.lit("line "), F.col("line_no").cast("string"))).count() == 0
        assert df.count() == 3000
        fq = put(tmp_path / "r.fastq", "".join(f"@r{i}\nACGT{i}\n+\nIIII{i}\n" for i in range(500)) + "\n")
        records = readers.fastq(spark, fq)
        assert records.count() == 500
        assert records.where(F.regexp_extract("name", r"(\d+)", 1) != F.regexp_extract("qual", r"(\d+)", 1)).count() == 0
        with pytest.raises(Exception, match="fewer than four lines"):
            readers.fastq(spark, put(tmp_path / "cut.fastq", "@r\nACGT\n+\nIIII\n@cut\nAC\n")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_region_files(spark, tmp_path):
    gff = put(tmp_path / "a.gff", "c1\tid1\t\t9\t3\t\t+\t\tx\nc1\t\t\t1\t5\t\t-\t\tname\nc1\t\t\t1\t6\t\t.\t\t\n")
    rows = {(r["id"], r["start"], r["end"], r["strand"]) for r in readers.gff(spark, gff).collect()}
    assert rows == {("id1", 3, 9, "+"), ("name", 1, 5, "-"), ("c1:.:1-6", 1, 6, ".")}
    bed = put(tmp_path / "b.bed", "c1\t5\t9\tp\t1\t-\nc2\t1\t2\tq\n")
    assert {(r["id"], r["strand"]) for r in readers.bed(spark, bed).collect()} == {("p", "."), ("q", ".")}
    named = readers.bound_regions(spark, bed, "S").orderBy("id").collect()
    assert [(r["chrom"], r["id"]) for r in named] == [("c1", "S_1"), ("c2", "S_2")]
    other = put(tmp_path / "b.txt", "1\t5\t9\n2\t1\t2\n")
    assert {r["chrom"] for r in readers.bound_regions(spark, other, "S").collect()} == {"chr1", "chr2"}
    mixed = put(tmp_path / "m.bed", "chr1\t1\t5\ntrack\tx\ty\nchr2\ta\tb\nchr3\t1\nchr4\t7\t9\tz\n")
    assert {(r["chrom"], r["id"]) for r in readers.bed_features(spark, [mixed]).collect()} == {("chr1", "m"), ("chr4", "m")}
    made = readers.format_bed(readers.bed(spark, bed).withColumn("strand", F.lit(None).cast("string")), [F.col("chrom")])
    assert [(r["name"], r["score"], r["strand"]) for r in made.orderBy("score").collect()] == [("p", 1, "."), ("q", 2, ".")]
    back = readers.gff_to_bed(readers.bed_to_gff(made)).select("name").collect()
    assert {r["name"] for r in back} == {"p", "q"}
    lab = put(tmp_path / "lab.txt", "chr\tstart\tend\tx\tscore\n1\t5\t9\t.\tpeak\n")
    assert tuple(readers.enriched_to_gff(spark, lab).first()) == ("chr1", "row_0", "peak", 5, 9, ".")


def test_annotation_and_lengths(spark, tmp_path):
    row = "0\tNM_1\tc1\t-\t10\t90\t0\t0\t2\t10,50,\t20,90,\t0\tGENE\n"
    df = readers.annotation(spark, put(tmp_path / "a.txt", "bin\tname\n" + row + row)).collect()
    assert [(r["id"], r["name"], r["tx_end"], r["row"]) for r in df] == [("NM_1", "GENE", 90, 2), ("NM_1", "GENE", 90, 3)]
    lengths = put(tmp_path / "l.txt", "c1\tx\thg18\ty\t500\n")
    assert tuple(readers.genome_lengths(spark, lengths).first()) == ("c1", "HG18", 500)


def test_manifest(spark, tmp_path):
    path = put(tmp_path / "m.txt", "FILE_PATH\tUNIQUE_ID\tGENOME\tNAME\n/d/\tid1\tHG18\tS1\n/d/\t\tHG18\tS2\nFILE_PATH\tx\ty\tz\n"
                                   "/d/\tid3\tMM9\tS3\tS1\tr\tp\t1,2,3\tf.gz\textra\n/d/\tid4\tMM9\n")
    rows = readers.manifest(spark, path).orderBy("name").collect()
    assert [(r["name"], r["genome"], r["background"], r["color"], r["fastq_file"]) for r in rows] == [
        ("S1", "hg18", "", "0,0,0", ""), ("S3", "mm9", "S1", "1,2,3", "f.gz")]
    cells = ["1", "", "", "CTRL", "MM1S_MYC", "x-AACC", "", "", "RUN7", "", "", "", "", "", "HG19"]
    sheet = put(tmp_path / "s.txt", "\t".join(f"h{i}" for i in range(15)) + "\n" + "\t".join(cells) + "\n")
    row = readers.manifest_from_sheet(spark, sheet, "/raw/", "/bam/").first()
    assert (row["unique_id"], row["file_path"], row["background"]) == ("RUN7_MM1S_MYC", "/bam/HG19/mm1s/", "CTRL")
    assert row["fastq_file"] == "/raw/AACC-s_1_1_sequence.txt.tar.gz"


def test_headers_logs_and_side_files(spark, tmp_path):
    sam = put(tmp_path / "x.sam", "@HD\tVN\t1.0\n@SQ\tSN:c1\tLN:77\nr\t0\tc1\t5\t9\t4M\t*\t0\t0\tACGT\tIIII\nu\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI\n")
    assert {(r["tag"], r["value"]) for r in readers.sam_header(spark, sam).collect()} == {("VN", "1.0"), ("SN:c1", "LN:77")}
    assert tuple(readers.header_chroms(spark, sam).select("chrom", "length").first()) == ("c1", 77)
    [read] = readers.sam(spark, sam).collect()
    assert (read["pos"], read["start"], read["end"], read["strand"], read["seq_len"]) == (4, 4, 8, "+", 4)
    log = put(tmp_path / "b.log", "File = 36\n# reads processed: 2500000\n# reads with at least one reported alignment: 2000000 (80.00%)\n"
                                  "# reads that failed to align: 400000 (16.00%)\n# reads with alignments suppressed due to -m: 100000 (4.00%)\n")
    row = readers.aligner_stats(spark, log).first()
    assert (row["read_length"], row["processed_millions"], row["aligned"], row["failed_share"], row["suppressed"]) == (
        "36", 2.5, 2000000, "16.00%", 100000)
    stats = put(tmp_path / "s.txt", "@x\tUniquelyMappingSequenceTags\t1234\n")
    assert readers.unique_tag_total(spark, stats).first()[0] == 1234
    assert readers.unique_tag_total(spark, log).first()[0] is None


def test_small_tables(spark, tmp_path):
    matrix = put(tmp_path / "e.txt", "gene\ts1\ts2\ng1\t1.5\tNA\n")
    assert {(r["sample"], r["value"]) for r in readers.expression(spark, matrix).collect()} == {("s1", 1.5), ("s2", None)}
    guides = put(tmp_path / "g.txt", "GENE\tID\nX\tsg1\n")
    assert tuple(readers.guide_annotation(spark, guides).first()) == ("sg1", "X")
    idx = put(tmp_path / "i.txt", "sg1\t20\t7\t0\n")
    assert readers.index_stats(spark, idx).first()["count"] == 7
    spikes = put(tmp_path / "s.txt", "n\tid\tgroup\tconc\n1\tERCC-00002\tD\t0.5\n")
    assert tuple(readers.spike_concentrations(spark, spikes).first()) == ("ERCC-00002", 0.5)
    graph = put(tmp_path / "c.bg", "c1\t1\t5\t0.25\n")
    assert tuple(readers.bedgraph(spark, graph).first()) == ("c1", 1, 5, 0.25)


@pytest.fixture
def ranked(spark):
    rows = [("2_a_lociStitched", "c1", 10, 90, ".", 2, 60, 50.0, 1, 1), ("1_b_lociStitched", "c2", 5, 15, "+", 1, 11, 3.0, 2, 0)]
    return spark.createDataFrame(rows, "id string, chrom string, start long, end long, strand string, num_loci long, "
                                       "constituent_size long, signal double, enhancer_rank long, is_super int")


def test_ranked_table_round_trip(spark, tmp_path, ranked):
    columns = ["id", "chrom", "start", "end", "num_loci", "constituent_size", "signal", "enhancer_rank", "is_super"]
    sinks.write_lines(sinks.ranked_table_lines(ranked, "X Enhancers\nCutoff 5", columns), str(tmp_path / "r"))
    lines = text_of(tmp_path / "r")
    assert lines[:2] == ["#X Enhancers", "#Cutoff 5"] and lines[2].startswith("REGION_ID\t") and lines[3].startswith("2_a")
    back = readers.ranked_regions(spark, str(tmp_path / "r"))
    assert {(r["id"], r["enhancer_rank"], r["signal"]) for r in back.collect()} == {("2_a_lociStitched", 1, 50.0), ("1_b_lociStitched", 2, 3.0)}
    assert readers.ranked_regions(spark, str(tmp_path / "r"), super_only=True).count() == 1
    assert readers.ranked_regions(spark, str(tmp_path / "r"), top=1).first()["enhancer_rank"] == 1


def test_tracks_and_change_files(spark, tmp_path, ranked):
    sinks.write_lines(sinks.bed_track_lines(ranked, "S1 Enhancers", "by S1\nx"), str(tmp_path / "t"))
    assert text_of(tmp_path / "t") == [
        'track name="S1_Enhancers" description="by S1\tx" itemRGB=On color=0,0,0', "c1\t10\t90\t2_a_lociStitched\t1",
        "c2\t5\t15\t1_b_lociStitched\t2", "", 'track name="Super_S1_Enhancers" description="Super by S1\tx" itemRGB=On color=255,0,0',
        "c1\t10\t90\t2_a_lociStitched\t1"]
    table = ranked.withColumns({
        "status": F.when(F.col("enhancer_rank") == 1, "B").otherwise("CONSERVED"), "overlap_genes": F.lit("G1,G2"),
        "proximal_genes": F.lit(""), "closest_gene": F.lit("G2"), "log2_change": F.lit(1.5), "scaled1": F.lit(1.0), "scaled2": F.lit(3.0)})
    out = sinks.change_outputs(table, ("A", "B"), 100)
    assert out["gained_window"].select("start", "end").first() == (-90, 190) and out["lost"].count() == 0
    assert set(out["gained"].first()["attribute"].split(",")) == {"G1", "G2"}
    genes = [r["value"].split("\t") for r in out["genes"].collect()]
    assert genes[0][:2] == ["GENE", "ENHANCER_ID"] and [g[0] for g in genes[1:]] == ["G1", "G2", "G1", "G2"]
    assert genes[1][4:] == ["90", "1.5", "1.0", "3.0", "B"]
    bed = [r["value"].split("\t")[0] for r in out["bed"].collect()]
    assert bed[1] == "c1" and bed[3] == "c2" and len(bed) == 5


def test_matrix_gct_cls_flatten_fasta(spark, tmp_path):
    matrix = spark.createDataFrame([("r2", "c1(.):1-8", 2.5), ("r1", "c1(.):0-9", 0.0)], "GENE_ID string, locusLine string, bin_1_f double")
    sinks.write_lines(sinks.matrix_lines(matrix), str(tmp_path / "m"))
    assert text_of(tmp_path / "m") == ["GENE_ID\tlocusLine\tbin_1_f", "r1\tc1(.):0-9\t0.0", "r2\tc1(.):1-8\t2.5"]
    means = spark.createDataFrame([("g1", 1.0, 2.0)], "gene string, A double, B double")
    assert [r["value"] for r in sinks.gct_lines(means, "A", "B").collect()] == ["#1.2", "1\t2", "NAME\tDESCRIPTION\tA\tB", "g1\t\t1.0\t2.0"]
    assert [r["value"] for r in sinks.cls_lines(means, "A", "B").collect()] == ["2\t2\t1", "#A\tB\t", "A\tB\t"]
    counts = spark.createDataFrame([(1, "chr1", 0, 5), (2, "chr2", 1, 6)], "file_key int, chrom string, bin_number int, count long")
    files = spark.createDataFrame([(1, "a.sam")], "file_key int, file_name string")
    sinks.flatten(counts, files, str(tmp_path / "f"))
    assert text_of(tmp_path / "f" / "chrom=chr1") == ["bin_number\tcount\tfile_name", "0\t5\ta.sam"]
    assert text_of(tmp_path / "f" / "chrom=chr2")[-1] == "1\t6\t*"
    tiles = sequences.tiled(spark.createDataFrame([("c1", "ACGTTT")], "chrom string, sequence string"), 4)
    regions = spark.createDataFrame([("a", "c1", 1, 5, "-")], "id string, chrom string, start long, end long, strand string")
    text = sinks.fasta_text(sequences.fetch(regions, tiles, 4), "HG18")
    assert [r["value"] for r in text.collect()] == [">hg18|c1|1|5|-", "AACG"]

"""Readers for the text layouts: delimited tables, BED, GFF, SAM, FASTQ and result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.functions import reads as rd
from strandline.operators import ordering

_WHOLE_LINE = "\u0001"  # a separator that does not occur, so a line stays one value
# fixed values of the sample manifest
MANIFEST = ["file_path", "unique_id", "genome", "name", "background", "enriched_region", "enriched_macs", "color",
            "fastq_file"]
DEFAULT_COLOR = "0,0,0"


def lines(spark: SparkSession, path: str | list[str], *, header: bool = False) -> DataFrame:
    """Lines with trailing white space removed; ``header`` skips the first line of every file.

    Compressed files are read by their extension.
    """
    raw = spark.read.csv(path, schema="value string", sep=_WHOLE_LINE, header=header, quote="", escape="",
                         enforceSchema=True)
    return raw.select("*", "_metadata.file_path").select(
        F.regexp_replace("value", r"\s+$", "").alias("value"), "file_path")


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file_path, line_no, value) with lines numbered from 1 in every file, without a shuffle of the lines.

    Lines are counted per file split first; a line's number is the lines of
    the earlier splits plus its place in its own split.
    """
    def scan():
        return spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start").withColumn(
            "_id", F.monotonically_increasing_id())

    splits = scan().groupBy("file_path", "file_block_start").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy("file_path").orderBy("file_block_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    numbered = scan().join(splits, ["file_path", "file_block_start"])
    return numbered.select("file_path", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line_no"), "value")


def table(spark: SparkSession, path: str | list[str], sep: str = "\t", *, header: bool = False) -> DataFrame:
    """Ragged delimited table: one array of strings per line, trailing empty cells dropped."""
    return lines(spark, path, header=header).select(F.split("value", f"\\Q{sep}\\E").alias("cells"), "file_path")


def _cell(i: int) -> Column:
    return F.get("cells", F.lit(i))


def _text(i: int) -> Column:
    return F.coalesce(_cell(i), F.lit(""))


def _number(i: int) -> Column:
    return _cell(i).cast("long")


def _basename() -> Column:
    return F.element_at(F.split("file_path", "/"), -1)


def bed(spark: SparkSession, path: str) -> DataFrame:
    """BED loci; the strand is always ``.``."""
    return table(spark, path).select(
        _cell(0).alias("chrom"), F.least(_number(1), _number(2)).alias("start"),
        F.greatest(_number(1), _number(2)).alias("end"), F.lit(".").alias("strand"), _text(3).alias("id"))


def format_bed(df: DataFrame, order: list) -> DataFrame:
    """Six BED columns: the score is the 1-based row index, a missing strand is ``.``."""
    numbered = ordering.row_numbers(df, [], order, "score")
    return numbered.select("chrom", "start", "end", F.col("id").alias("name"), "score",
                           F.coalesce(F.nullif("strand", F.lit("")), F.lit(".")).alias("strand"))


def bound_regions(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Enriched regions named ``<name>_<n>``; files other than BED lack the ``chr`` prefix."""
    prefix = "" if path.endswith(".bed") else "chr"
    rows = numbered_lines(spark, path).select("line_no", F.split("value", "\t").alias("cells"))
    if not prefix:
        rows = rows.where(F.size("cells") >= 3)
    else:
        rows = rows.where(_cell(1).try_cast("long").isNotNull())
    numbered = ordering.row_numbers(rows, [], [F.col("line_no")], "_n")
    return numbered.select(
        F.concat(F.lit(prefix), _cell(0)).alias("chrom"), _number(1).alias("start"), _number(2).alias("end"),
        F.lit(".").alias("strand"), F.concat(F.lit(name + "_"), F.col("_n").cast("string")).alias("id"))


def bed_features(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Features of several BED files; lines that are no ``chr`` interval are skipped, the id is the file's name."""
    rows = table(spark, paths)
    start, end = _cell(1).try_cast("long"), _cell(2).try_cast("long")
    kept = rows.where((F.size("cells") >= 3) & _cell(0).startswith("chr") & start.isNotNull() & end.isNotNull())
    return kept.select(_cell(0).alias("chrom"), start.alias("start"), end.alias("end"), F.lit(".").alias("strand"),
                       F.regexp_replace(_basename(), r"\.[^.]*$", "").alias("id"))


def gff(spark: SparkSession, path: str) -> DataFrame:
    """GFF loci; the id is column 2, else column 9, else the place."""
    place = F.concat(_text(0), F.lit(":"), _text(6), F.lit(":"), _text(3), F.lit("-"), _text(4))
    return table(spark, path).select(
        _cell(0).alias("chrom"), F.least(_number(3), _number(4)).alias("start"),
        F.greatest(_number(3), _number(4)).alias("end"), _text(6).alias("strand"),
        F.coalesce(F.nullif(_cell(1), F.lit("")), F.nullif(_cell(8), F.lit("")), place).alias("id"))


def bed_to_gff(df: DataFrame) -> DataFrame:
    blank = F.lit("")
    return df.select("chrom", F.col("name").alias("source"), blank.alias("feature"), "start", "end", blank.alias("score"),
                     "strand", blank.alias("frame"), F.col("name").alias("attribute"))


def gff_to_bed(df: DataFrame) -> DataFrame:
    return df.select("chrom", "start", "end", F.col("source").alias("name"), F.lit(0).alias("score"), "strand")


def _cut_to(text: Column, width: int | None) -> Column:
    return text if width is None else F.substring(text, 1, width)


def validated_regions(spark: SparkSession, path: str, chrom_sizes: DataFrame, *, fmt: str | None = None,
                      strand: str = "_", name_width: int | None = None) -> DataFrame:
    """Regions for counting from BED or GFF.

    Too few columns are an error, swapped coordinates are sorted, names are
    whole unless a width is given. ``strand`` overrides the file's, ``_`` keeps it.
    Regions on unknown chromosomes or past the chromosome's end are dropped.
    """
    fmt = fmt or path.rsplit(".", 1)[-1].lower()
    if fmt not in ("bed", "gff"):
        raise ValueError(f"unknown region format {fmt!r}")
    least, start, end, name, sign = (3, 1, 2, 3, 5) if fmt == "bed" else (9, 3, 4, 8, 6)
    # only the line end is removed here: empty cells at the end of a line are columns
    rows = spark.read.text(path).where("value != ''").select(F.split("value", "\t").alias("cells"))
    message = F.concat(F.lit(f"fewer than {least} columns: "), F.array_join("cells", " "))
    checked = rows.withColumn("cells", F.when(F.size("cells") >= least, F.col("cells")).otherwise(
        F.raise_error(message).cast("array<string>")))
    own = F.when(_text(sign).isin("+", "-", "."), _text(sign)).otherwise(F.lit("."))
    out = checked.select(
        _cut_to(_text(name), name_width).alias("id"), _cell(0).alias("chrom"),
        F.least(_number(start), _number(end)).alias("start"), F.greatest(_number(start), _number(end)).alias("end"),
        (own if strand == "_" else F.lit(strand)).alias("strand"))
    known = out.join(chrom_sizes.select("chrom", "length").distinct(), "chrom")
    return known.where(F.col("end") <= F.col("length")).select("id", "chrom", "start", "end", "strand")


def check_chromosomes(chrom_sizes: DataFrame, width: int) -> DataFrame:
    """The same rows; names longer than ``width`` fail."""
    long_name = F.raise_error(F.concat(F.lit("chromosome name too long: "), "chrom")).cast("string")
    return chrom_sizes.withColumn("chrom", F.when(F.length("chrom") <= width, F.col("chrom")).otherwise(long_name))


def annotation(spark: SparkSession, path: str) -> DataFrame:
    """Gene annotation in the refseq table layout, with the source row."""
    rows = numbered_lines(spark, path).where("line_no > 1").select(
        F.col("line_no").alias("row"), F.split("value", "\t").alias("cells"))
    return rows.select(
        _cell(1).alias("id"), _cell(2).alias("chrom"), _cell(3).alias("strand"), _number(4).alias("tx_start"),
        _number(5).alias("tx_end"), _number(6).alias("cds_start"), _number(7).alias("cds_end"),
        _cell(9).alias("exon_starts"), _cell(10).alias("exon_ends"), _cell(12).alias("name"), "row")


def chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path).select(_cell(0).alias("chrom"), _number(1).alias("length"))


def genome_lengths(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path).select(
        _cell(0).alias("chrom"), F.upper(_cell(2)).alias("genome"), _number(4).alias("length"))


def sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Placed reads of SAM text; pos counts from 0. A file's cell type is its folder, ``-`` at the top level."""
    rows = lines(spark, path).where(~F.col("value").startswith("@"))
    fields = rows.select(F.split("value", "\t").alias("cells"), "file_path")
    reads = fields.select(
        _cell(0).alias("qname"), _cell(1).cast("int").alias("flag"), _cell(2).alias("chrom"),
        (_number(3) - 1).alias("pos"), _cell(4).cast("int").alias("mapq"), _cell(5).alias("cigar"), _cell(9).alias("seq"),
        F.length(_cell(9)).cast("long").alias("seq_len"), _basename().alias("file_name"), "file_path")
    return rd.with_span(reads.where(F.col("chrom") != "*"))


def discover(spark: SparkSession, root: str, pattern: str = "*.sam", *, width: int | None = None) -> DataFrame:
    """Files below a folder with their cell type (the parent folder below the root, cut if a width is given)."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", pattern).load(root).select("path"))
    base = root.rstrip("/").rsplit("/", 1)[-1]
    parent = F.element_at(F.split("path", "/"), -2)
    return found.select(
        F.col("path").alias("file_path"), F.element_at(F.split("path", "/"), -1).alias("file_name"),
        _cut_to(F.when(parent == base, "-").otherwise(parent), width).alias("cell_type"))


def number_files(files: DataFrame, known: int = 0) -> DataFrame:
    """Files with keys counted on from ``known``."""
    return ordering.row_numbers(files, [], [F.col("file_path")], "_k").withColumn(
        "file_key", (F.col("_k") + known).cast("int")).drop("_k")


def sam_header(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file_path, tag, value) of three-column header lines."""
    rows = lines(spark, path).where(F.col("value").startswith("@"))
    parts = rows.select("file_path", F.split("value", "\t").alias("cells")).where(F.size("cells") >= 3)
    return parts.select("file_path", _cell(1).alias("tag"), _cell(2).alias("value"))


def header_chroms(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file_path, chrom, length) from the sequence lines of the header."""
    rows = lines(spark, path).where(F.col("value").startswith("@SQ"))
    return rows.select("file_path", F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("chrom"),
                       F.regexp_extract("value", r"\tLN:(\d+)", 1).cast("long").alias("length"))


def fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records of four lines: name, seq, plus, qual. Lines that make no whole record are an error, unless they are empty."""
    numbered = numbered_lines(spark, path)
    place = (F.col("line_no") - 1) % 4
    at = lambda i: F.max(F.when(place == i, F.col("value")))
    records = numbered.groupBy("file_path", F.floor((F.col("line_no") - 1) / 4).alias("record")).agg(
        at(0).alias("name"), at(1).alias("seq"), at(2).alias("plus"), at(3).alias("qual"), F.count(F.lit(1)).alias("_n"))
    filled = records.where((F.col("_n") == 4) | (F.concat_ws("", "name", "seq", "plus", "qual") != ""))
    broken = F.raise_error(F.concat(F.lit("the last record has fewer than four lines: "), "file_path")).cast("boolean")
    return filled.where(F.when(F.col("_n") == 4, F.lit(True)).otherwise(broken)).drop("_n").withColumn(
        "seq", F.regexp_replace("seq", r"\s+$", ""))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Sample manifest: padded to nine columns, incomplete rows dropped, colour and genome put right."""
    rows = table(spark, path, header=True).where((F.size("cells") > 3) & (_cell(0) != "FILE_PATH"))
    rows = rows.where((_text(0) != "") & (_text(1) != "") & (_text(2) != ""))
    columns = [_text(i).alias(name) for i, name in enumerate(MANIFEST)]
    return rows.select(*columns).withColumns(
        {"genome": F.lower("genome"), "color": F.when(F.col("color") == "", DEFAULT_COLOR).otherwise(F.col("color"))})


def manifest_from_sheet(spark: SparkSession, path: str, data_folder: str, bam_folder: str) -> DataFrame:
    """Manifest rows from a lab sheet: id, path, control and sequence file come from its columns."""
    rows = table(spark, path, header=True).where(_text(0) != "")
    name, genome = _text(4), _text(14)
    cell_line = F.lower(F.substring_index(name, "_", 1))
    barcode = F.element_at(F.split(_text(5), "-"), 2)
    return rows.select(
        F.concat(F.lit(bam_folder), genome, F.lit("/"), cell_line, F.lit("/")).alias("file_path"),
        F.concat(_text(8), F.lit("_"), name).alias("unique_id"), genome.alias("genome"), name.alias("name"),
        _text(3).alias("background"), F.lit("").alias("enriched_region"), F.lit("").alias("enriched_macs"),
        F.lit(DEFAULT_COLOR).alias("color"),
        F.concat(F.lit(data_folder), barcode, F.lit("-s_"), _text(0), F.lit("_1_sequence.txt.tar.gz")).alias("fastq_file"),
        name.contains("WCE").cast("int").alias("is_control"))


def ranked_regions(spark: SparkSession, path: str, *, top: int | None = None, super_only: bool = False) -> DataFrame:
    """Ranked region table: comment lines and the ``REGION_ID`` header are skipped; rank and flag are the last two columns."""
    rows = lines(spark, path).where(~F.col("value").startswith("#") & ~F.col("value").startswith("REGION_ID"))
    cells = rows.where("value <> ''").select(F.split("value", "\t").alias("cells"))
    short = F.raise_error(F.concat(F.lit("fewer than 8 columns: "), F.array_join("cells", " "))).cast("array<string>")
    cells = cells.withColumn("cells", F.when(F.size("cells") >= 8, F.col("cells")).otherwise(short))
    end = lambda i: F.element_at("cells", i)
    out = cells.select(
        _cell(0).alias("id"), _cell(1).alias("chrom"), _number(2).alias("start"), _number(3).alias("end"),
        F.lit(".").alias("strand"), _number(4).alias("num_loci"), _number(5).alias("constituent_size"),
        _cell(6).cast("double").alias("signal"), end(-2).cast("long").alias("enhancer_rank"), end(-1).cast("int").alias("is_super"))
    if super_only:
        out = out.where("is_super = 1")
    return out if top is None else ordering.top_n(out, top, [F.asc("enhancer_rank"), F.asc("id")])


def aligner_stats(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Read counts of aligner logs, one row per log."""
    logs = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file_path"))
    found = lambda pattern: F.nullif(F.regexp_extract("value", pattern, 1), F.lit(""))
    line = r"(?m)^#[^\n]*{}[^\n]*:\s*(\d+)"
    share = r"(?m)^#[^\n]*{}[^\n]*\(([^)]*)\)"
    out = logs.select(
        "file_path", found(r"(?m)^File[^=\n]*=\s*(\S+)").alias("read_length"),
        found(line.format("processed")).cast("long").alias("processed"),
        *[found(line.format(word)).cast("long").alias(name) for word, name in (
            ("reported alignment", "aligned"), ("failed", "failed"), ("suppressed", "suppressed"))],
        *[found(share.format(word)).alias(name + "_share") for word, name in (
            ("reported alignment", "aligned"), ("failed", "failed"), ("suppressed", "suppressed"))])
    return out.withColumn("processed_millions", F.round(F.col("processed") / 1e6, 2))


def bedgraph(spark: SparkSession, path: str | list[str]) -> DataFrame:
    schema = "chrom string, start long, end long, score double"
    return spark.read.csv(path, schema=schema, sep="\t")


def expression(spark: SparkSession, path: str) -> DataFrame:
    """Long expression table (gene, row, sample, value) from a matrix with a header."""
    wide = spark.read.csv(path, sep="\t", header=True, nullValue="NA")
    gene, samples = wide.columns[0], wide.columns[1:]
    rows = wide.withColumn("row", F.monotonically_increasing_id()).withColumnRenamed(gene, "gene")
    return rows.unpivot(["gene", "row"], samples, "sample", "value").withColumn("value", F.col("value").cast("double"))


def spike_concentrations(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, header=True).select(
        _cell(1).alias("control_id"), _cell(3).cast("double").alias("concentration"))


def guide_annotation(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, header=True).select(_cell(1).alias("guide"), _cell(0).alias("gene"))


def index_stats(spark: SparkSession, path: str) -> DataFrame:
    """(name, length, mapped, unmapped) as written by an index summary."""
    return table(spark, path).select(
        _cell(0).alias("name"), _number(1).alias("length"), _number(2).alias("count"), _number(3).alias("unmapped"))


def enriched_to_gff(spark: SparkSession, path: str) -> DataFrame:
    """Lab enriched-region file as GFF rows named ``row_<n>`` from 0."""
    rows = numbered_lines(spark, path).where("line_no > 1").select("line_no", F.split("value", "\t").alias("cells"))
    name = F.concat(F.lit("row_"), (F.col("line_no") - 2).cast("string"))
    return rows.select(F.concat(F.lit("chr"), _cell(0)).alias("chrom"), name.alias("id"), _text(4).alias("feature"),
                       _number(1).alias("start"), _number(2).alias("end"), F.lit(".").alias("strand"))


def unique_tag_total(spark: SparkSession, path: str) -> DataFrame:
    """One row: the unique tag count of a statistics side file, NULL when it is not listed."""
    found = F.regexp_extract("value", r"UniquelyMappingSequenceTags\s*[:=\t ]\s*(\d+)", 1)
    return lines(spark, path).agg(F.max(F.nullif(found, F.lit("")).cast("long")).alias("unique_tags"))

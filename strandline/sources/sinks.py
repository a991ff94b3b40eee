"""Writers. Ordered text is range-sorted over many part files, whose names keep the order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import loci
from strandline.operators import ordering, sequences
from strandline.operators.collections import explode_list, merged_names


def _joined(columns: list, sep: str = "\t") -> Column:
    cells = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("NA")) for c in columns]
    return F.concat_ws(sep, *cells)


def write_table(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Delimited text without a header; ``sep=''`` writes the first column, one value per line."""
    if sep == "":
        df.select(F.col(df.columns[0]).cast("string").alias("value")).write.text(path)
    else:
        df.select(_joined(df.columns, sep).alias("value")).write.text(path)


def sections(*parts: tuple[DataFrame, list]) -> DataFrame:
    """Lines of several parts (frame with ``value``, order columns), each after the one before."""
    out = [df.select(F.lit(i).alias("section"), "value", *[
        o.alias(f"_o{i:02d}_{j}") for j, o in enumerate(order)]) for i, (df, order) in enumerate(parts)]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)
    places = sorted(c for c in merged.columns if c.startswith("_o"))
    return merged.orderBy("section", *places).select("value")


def header(df: DataFrame, *texts: str) -> tuple[DataFrame, list]:
    """Fixed lines as a part for ``sections``."""
    rows = df.sparkSession.range(len(texts)).select(
        F.element_at(F.array(*[F.lit(t) for t in texts]), (F.col("id") + 1).cast("int")).alias("value"), "id")
    return rows, [F.col("id")]


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.text(path)


def matrix_lines(matrix: DataFrame) -> DataFrame:
    """Region matrix with its header; densities keep four places."""
    names = matrix.columns
    rows = matrix.withColumn("value", _joined(names))
    return sections(header(matrix, "\t".join(names)), (rows, [F.col(names[0])]))


def flatten(counts: DataFrame, files: DataFrame, path: str) -> None:
    """Counts as tab text, one folder per chromosome, with file names instead of keys."""
    named = counts.join(files.select("file_key", "file_name"), "file_key", "left").withColumn(
        "file_name", F.coalesce("file_name", F.lit("*"))).drop("file_key")
    named.write.partitionBy("chrom").csv(path, sep="\t", header=True)


def bed_track_lines(ranked: DataFrame, name: str, description: str, *, score: str = "signal", flag: str = "is_super",
                    split_super: bool = True) -> DataFrame:
    """BED track of all regions, then one of the flagged ones; the score column is the descending rank."""
    track = name.replace(" ", "_")
    text = description.replace("\n", "\t")
    rows = ranked.withColumn("value", _joined(["chrom", "start", "end", "id", "enhancer_rank"]))
    order = [F.desc(F.col("end") - F.col("start")), F.asc("chrom"), F.asc("start"), F.asc("id")]
    rows = ordering.row_numbers(rows, [], order, "_n")
    parts = [header(ranked, f'track name="{track}" description="{text}" itemRGB=On color=0,0,0'), (rows, [F.col("_n")])]
    if split_super:
        parts += [header(ranked, "", f'track name="Super_{track}" description="Super {text}" itemRGB=On color=255,0,0'),
                  (rows.where(F.col(flag) == 1), [F.col("_n")])]
    return sections(*parts)


def ranked_table_lines(ranked: DataFrame, description: str, columns: list[str]) -> DataFrame:
    """Ranked table: ``#`` description, header, rows by rank."""
    texts = ["#" + line for line in description.split("\n")]
    rows = ranked.withColumn("value", _joined(columns))
    names = ["REGION_ID" if c == "id" else c.upper() for c in columns]
    return sections(header(ranked, *texts, "\t".join(names)), (rows, [F.col("enhancer_rank")]))


def gct_lines(means: DataFrame, first: str, second: str) -> DataFrame:
    """Expression of two groups in GCT layout."""
    counted = means.agg(F.concat_ws("\t", F.count(F.lit(1)).cast("string"), F.lit("2")).alias("value")).withColumn("id", F.lit(1))
    rows = means.withColumn("value", _joined(["gene", F.lit(""), first, second]))
    return sections(header(means, "#1.2"), (counted, [F.col("id")]),
                    header(means, "\t".join(["NAME", "DESCRIPTION", first, second])), (rows, [F.col("gene")]))


def cls_lines(df: DataFrame, first: str, second: str) -> DataFrame:
    return sections(header(df, "2\t2\t1", f"#{first}\t{second}\t", f"{first}\t{second}\t"))


def change_outputs(table: DataFrame, names: tuple[str, str], window: int = 100_000) -> dict[str, DataFrame]:
    """GFF rows of gained and lost regions, plain and widened, with their genes in the last column; the BED lines of all
    three groups; the gene table, one line per gene and region."""
    first, second = names
    out = {}
    listed = F.coalesce(merged_names("overlap_genes", "proximal_genes", "closest_gene"), F.lit(""))
    table = table.withColumn("_genes", listed)
    places = [*loci.gff_columns()[:-1], F.col("_genes").alias("attribute")]
    for status, label in ((second, "gained"), (first, "lost")):
        rows = table.where(F.col("status") == status).withColumn("strand", F.lit("."))
        out[label] = rows.select(*places)
        wide = rows.withColumns({"start": F.col("start") - window, "end": F.col("end") + window})
        out[label + "_window"] = wide.select(*places)
    titles = {second: (f"{second} only", "255,0,0"), "CONSERVED": (f"{first} and {second}", "0,0,0"), first: (f"{first} only", "0,255,0")}
    parts = []
    for status, (title, color) in titles.items():
        rows = table.where(F.col("status") == status).withColumn(
            "value", _joined(["chrom", "start", "end", "id", "enhancer_rank"]))
        parts += [header(table, f'track name="{title}" description="{title} regions" itemRGB=On color={color}'),
                  (rows, [F.col("enhancer_rank")])]
    out["bed"] = sections(*parts)
    per_gene = explode_list(table, "_genes", ",", "gene").where("gene <> ''")
    columns = ["gene", "id", "chrom", "start", "end", "log2_change", "scaled1", "scaled2", "status"]
    titles = ["GENE", "ENHANCER_ID", "ENHANCER_CHROM", "ENHANCER_START", "ENHANCER_STOP", "LOG2_CHANGE", first, second, "STATUS"]
    lines = per_gene.withColumn("value", _joined(columns))
    out["genes"] = sections(header(table, "\t".join(titles)), (lines, [F.col("enhancer_rank"), F.col("gene")]))
    return out


def fasta_text(fetched: DataFrame, genome: str, *, use_id: bool = False) -> DataFrame:
    rows = sequences.fasta_lines(fetched, genome, use_id=use_id).withColumnRenamed("line", "value")
    return sections((rows, [F.col("id"), F.col("line_no")]))


def guide_fastq_text(guides: DataFrame) -> DataFrame:
    """Cut records in FASTQ layout."""
    rows = guides.select("file_path", "record", F.posexplode(F.array("name", "guide", "plus", "guide_qual")).alias("line", "value"))
    return sections((rows, [F.col("file_path"), F.col("record"), F.col("line")]))

"""Genomic tables derived from the driver's parquet tables.

Every view reads whole tables; day 0 of the coordinates is 1995-01-01.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values of the views
N_CHROMS, CHROM_LENGTH, DAY_ZERO = 22, 260_000, "1995-01-01"
SAMPLES = ["A_F", "A_O", "N_F", "N_O", "R_F", "R_O"]


def _chrom(key: str) -> str:
    return f"concat('chr', {key} % {N_CHROMS} + 1)"


def _day(column: str) -> str:
    return f"CAST(datediff({column}, '{DAY_ZERO}') AS bigint)"


class Views:
    """The derived tables over one folder of parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def alignments(self) -> DataFrame:
        """Reads as a file holds them: pos, flag, cigar."""
        rows = self.table("lineitem")
        n = "CAST(l_quantity AS bigint)"
        return rows.selectExpr(
            "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS file_key",
            "CASE WHEN l_returnflag IN ('A', 'N') THEN 'ct1' ELSE 'ct2' END AS cell_type",
            f"{_chrom('l_suppkey')} AS chrom",
            f"{_day('l_shipdate')} * 100 + l_linenumber * 10 AS pos",
            "CASE l_linestatus WHEN 'F' THEN 16 ELSE 0 END AS flag",
            f"CASE WHEN l_linenumber = 7 AND {n} > 1 THEN concat({n} div 2, 'M100N', {n} - {n} div 2, 'M') "
            f"ELSE concat({n}, 'M') END AS cigar",
            f"{n} AS seq_len", "CAST(l_partkey AS string) AS seq", f"l_linenumber = 7 AND {n} > 1 AS spliced")

    def reads(self) -> DataFrame:
        """Reads with the span stored, as counting reads them; ``cigar`` is only built where it is selected."""
        span = "pos + seq_len + CASE WHEN spliced THEN 100 ELSE 0 END AS end"
        return self.alignments().selectExpr(
            "* EXCEPT (spliced)", "pos AS start", span, "CASE flag & 16 WHEN 0 THEN '+' ELSE '-' END AS strand")

    def chrom_sizes(self) -> DataFrame:
        return self.table("customer").selectExpr(f"{_chrom('c_custkey')} AS chrom").distinct().withColumn(
            "length", F.lit(CHROM_LENGTH).cast("long"))

    def file_chroms(self) -> DataFrame:
        """One row per file and chromosome: length and mapped reads."""
        counts = self.alignments().groupBy("file_key", "cell_type", "chrom").agg(
            F.count(F.lit(1)).alias("mapped"))
        return counts.join(self.chrom_sizes(), "chrom")

    def files(self) -> DataFrame:
        return self.alignments().groupBy("file_key", "cell_type").agg(F.count(F.lit(1)).alias("mapped"))

    def regions(self) -> DataFrame:
        start = f"{_day('o_orderdate')} * 100 + o_orderkey % 100"
        return self.table("orders").selectExpr(
            "concat('r', o_orderkey) AS id", f"{_chrom('o_custkey')} AS chrom", f"{start} AS start",
            f"{start} + 50 + o_orderkey % 400 AS end",
            "CASE o_orderkey % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '.' END AS strand",
            "o_orderstatus AS status", "floor(o_totalprice) AS signal")

    def peaks(self, status: str = "F") -> DataFrame:
        return self.regions().where(F.col("status") == status).drop("status")

    def annotation(self) -> DataFrame:
        start = "((p_partkey * 7919) % 2400) * 100"
        return self.table("part").selectExpr(
            "concat('NM_', p_partkey) AS id", "p_name AS name", f"{_chrom('p_partkey')} AS chrom",
            "CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand", f"{start} AS tx_start",
            f"{start} + 200 + p_size * 50 AS tx_end", "p_partkey AS row")

    def samples(self) -> DataFrame:
        key = F.col("s_suppkey")
        text = key.cast("string")
        control = key % 5 == 0
        return self.table("supplier").select(
            F.concat(F.lit("/data/"), text, F.lit(".bam")).alias("file_path"),
            F.when(control, F.concat(F.lit("wce_"), text)).otherwise(F.concat(F.lit("S"), text)).alias("name"),
            F.when(control, "NONE").otherwise(
                F.concat(F.lit("wce_"), (F.floor(key / 5) * 5).cast("string"))).alias("background"),
            F.when(F.col("s_nationkey") % 2 == 0, F.concat(F.lit("peaks"), text)).otherwise("NONE")
            .alias("enriched_macs"))

    def expression(self) -> DataFrame:
        """Long expression table: gene, sample, value."""
        return self.table("lineitem").groupBy(
            F.concat(F.lit("g"), F.col("l_partkey").cast("string")).alias("gene"),
            F.concat_ws("_", "l_returnflag", "l_linestatus").alias("sample")).agg(
            F.sum(F.col("l_quantity").cast("long")).cast("double").alias("value"))

    def expression_matrix(self) -> DataFrame:
        sample = F.concat_ws("_", "l_returnflag", "l_linestatus")
        return self.table("lineitem").groupBy(
            F.concat(F.lit("g"), F.col("l_partkey").cast("string")).alias("gene")).agg(*[
                F.sum(F.when(sample == s, F.col("l_quantity")).otherwise(0.0)).alias(s) for s in SAMPLES])

    def guide_counts(self, flag: str) -> DataFrame:
        return self.table("lineitem").where(F.col("l_returnflag") == flag).groupBy(
            F.concat(F.lit("sg"), F.col("l_partkey").cast("string")).alias("guide")).agg(
            F.count(F.lit(1)).alias("count"))

    def guide_annotation(self) -> DataFrame:
        return self.table("part").select(
            F.concat(F.lit("sg"), F.col("p_partkey").cast("string")).alias("guide"), F.col("p_name").alias("gene"))

    def sequence_records(self) -> DataFrame:
        return self.table("documents").select(F.col("doc_id").alias("record"), F.col("text").alias("seq"))

    def score_lines(self) -> DataFrame:
        """Events as score intervals along the genome."""
        start = "floor(timestampdiff(MICROSECOND, TIMESTAMP_NTZ '2024-01-01 00:00:00', ts) / 10000000)"
        return self.table("events").selectExpr(
            f"{_chrom('user_id')} AS chrom", f"{start} AS start", f"{start} + ceil(value) AS end", "value AS score")

    def sequences(self) -> DataFrame:
        """Documents as chromosomes of letters."""
        return self.table("documents").select(
            F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("chrom"), F.col("text").alias("sequence"))

    def sequence_regions(self) -> DataFrame:
        key = F.col("doc_id")
        return self.table("documents").select(
            F.concat(F.lit("q"), key.cast("string")).alias("id"),
            F.concat(F.lit("d"), key.cast("string")).alias("chrom"), (key % 90 + 1).alias("start"),
            (key % 90 + F.floor(F.col("n_chars") / 2)).alias("end"),
            F.when(key % 2 == 0, "+").otherwise("-").alias("strand"))

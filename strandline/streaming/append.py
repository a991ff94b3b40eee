"""A store of counts that grows with new alignment files.

A store is a folder: ``settings`` and ``regions`` hold what is counted,
``files`` is the ledger of counted files and ``counts`` the partial counts of
every batch. A batch first writes its counts to a folder of its own attempt and
then one ledger entry per file that names the attempt. Counts that no ledger
entry names do not exist for a reader, so a batch that died and ran again, or
ran twice, counts once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandline.functions import loci
from strandline.operators import coverage, ordering
from strandline.plans import jobs

BIN_KEYS = ["file_key", "cell_type", "chrom", "bin_number"]
REGION_KEYS = ["file_key", "id", *loci.LOCUS_KEY]
_SETTINGS = "bin_size int, extension int, strand string, blacklist array<string>"
_LEDGER = "file_name string, file_key int, cell_type string, attempt string, batch string"
_BIN_COUNTS = "file_key int, cell_type string, chrom string, bin_number int, count long, batch string, attempt string"
_REGION_COUNTS = ("file_key int, id string, chrom string, start long, end long, strand string, count long, batch string, "
                  "attempt string")


def create_store(spark: SparkSession, store: str, *, bin_size: int | None = None, regions: DataFrame | None = None,
                 extension: int = 0, strand: str = ".", blacklist: list[str] = coverage.BIN_BLACKLIST) -> None:
    """An empty store that counts bins of ``bin_size`` or the given ``regions``; the options hold for all files.

    ``strand`` is the strand counted in bins, or the sense of the reads a region wants.
    """
    if (bin_size is None) == (regions is None):
        raise ValueError("give either bin_size or regions")
    if bin_size is not None and bin_size < 1:
        raise ValueError("bin size must be at least 1")
    spark.createDataFrame([(bin_size, extension, strand, list(blacklist))], _SETTINGS).write.parquet(f"{store}/settings")
    if regions is not None:
        regions.select("id", *loci.LOCUS_KEY).write.parquet(f"{store}/regions")
    empty = spark.createDataFrame([], _LEDGER)
    empty.drop("batch").write.parquet(f"{store}/files/batch=created")
    counts = spark.createDataFrame([], _BIN_COUNTS if regions is None else _REGION_COUNTS).drop("batch", "attempt")
    counts.write.parquet(f"{store}/counts/batch=created/attempt=none")


def ledger(spark: SparkSession, store: str) -> DataFrame:
    """One row per counted file: name, key, cell type, and the batch and attempt that counted it."""
    return spark.read.schema(_LEDGER).parquet(f"{store}/files")


def _settings(spark: SparkSession, store: str):
    return spark.read.schema(_SETTINGS).parquet(f"{store}/settings").first()


def _hits(spark: SparkSession, store: str, reads: DataFrame) -> tuple[DataFrame, list[str]]:
    has = _settings(spark, store)
    if has["bin_size"] is not None:
        return coverage.bin_hits(reads, has["bin_size"], extension=has["extension"], strand=has["strand"],
                                 blacklist=has["blacklist"]), BIN_KEYS
    regions = spark.read.parquet(f"{store}/regions")
    return coverage.region_hits(reads, regions, extension=has["extension"], mode=has["strand"]), REGION_KEYS


def append(reads: DataFrame, store: str, batch: str) -> DataFrame:
    """Count the files of ``reads`` that the ledger does not know; the ledger rows of this batch.

    ``reads`` holds file_name, cell_type, chrom, start, end, strand and,
    where one name may arrive in several copies, ``source``: only the first
    copy in order of source counts. New files get the keys after the known
    ones, by name. A batch with an id given before replaces that batch.
    """
    spark = reads.sparkSession
    known = ledger(spark, store).where(F.col("batch") != F.lit(batch))
    source = F.col("source") if "source" in reads.columns else F.lit("")
    reads = reads.withColumn("_source", source)
    names = reads.groupBy("file_name").agg(F.min("cell_type").alias("cell_type"), F.min("_source").alias("_source"))
    new = coverage.append_new_files(known, names)
    highest = F.coalesce(known.agg(F.max("file_key")).scalar(), F.lit(0))
    new = ordering.row_numbers(new, [], [F.col("file_name")], "_n").withColumn("file_key", (highest + F.col("_n")).cast("int"))
    fresh = reads.drop("file_key", "cell_type").join(new.drop("_n"), ["file_name", "_source"])
    hits, keys = _hits(spark, store, fresh)
    attempt = uuid.uuid4().hex
    counts = hits.groupBy(*keys).agg(F.sum("count").alias("count"))
    counts.write.parquet(f"{store}/counts/batch={batch}/attempt={attempt}")
    entries = new.select("file_name", "file_key", "cell_type", F.lit(attempt).alias("attempt"))
    entries.write.mode("overwrite").parquet(f"{store}/files/batch={batch}")
    return ledger(spark, store).where(F.col("batch") == F.lit(batch))


def start_append(stream: DataFrame, store: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append every micro-batch of a stream of reads; whole files arrive in one micro-batch.

    No state is kept between batches but the ledger, so a restart neither
    loses nor doubles reads, and a file whose name is known adds nothing.
    """
    def each(rows: DataFrame, batch_id: int) -> None:
        append(rows, store, f"stream-{batch_id}")

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _committed(spark: SparkSession, store: str, schema: str) -> DataFrame:
    named = ledger(spark, store).select("batch", "attempt").distinct()
    counted = spark.read.schema(schema).parquet(f"{store}/counts")
    return counted.join(named, ["batch", "attempt"], "left_semi").drop("batch", "attempt")


def stored_files(spark: SparkSession, store: str, totals: DataFrame) -> DataFrame:
    """Files of the ledger with their mapped reads; ``totals`` holds file_name and mapped."""
    return ledger(spark, store).select("file_name", "file_key", "cell_type").join(totals.select("file_name", "mapped"), "file_name")


def stored_counts(spark: SparkSession, store: str, file_chroms: DataFrame) -> DataFrame:
    """Counts of all files in the store, empty bins or regions included, as one run over them would give.

    ``file_chroms`` holds file_name, chrom and length from the headers of the files.
    """
    has = _settings(spark, store)
    chroms = file_chroms.select("file_name", "chrom", "length").join(
        ledger(spark, store).select("file_name", "file_key", "cell_type"), "file_name")
    if has["bin_size"] is not None:
        hits = _committed(spark, store, _BIN_COUNTS)
        return coverage.with_zeros(hits, coverage.empty_bins(chroms, has["bin_size"], has["blacklist"]), BIN_KEYS)
    regions = spark.read.parquet(f"{store}/regions")
    hits = _committed(spark, store, _REGION_COUNTS)
    zeros = coverage.regions_by_file(regions, chroms).select(*REGION_KEYS)
    return coverage.with_zeros(hits, zeros, REGION_KEYS)


def derived_tables(spark: SparkSession, store: str, file_chroms: DataFrame, totals: DataFrame) -> dict[str, DataFrame]:
    """Normalised bins and summary, or region densities, rebuilt from the stored counts."""
    counts, files = stored_counts(spark, store, file_chroms), stored_files(spark, store, totals)
    bin_size = _settings(spark, store)["bin_size"]
    if bin_size is None:
        return {"region_counts": coverage.region_densities(counts, files)}
    return jobs.derived_from_counts(counts, files, bin_size)


def running_counts(stream: DataFrame, bin_size: int, **options) -> DataFrame:
    """Streaming counts for update mode. State holds one row per touched bin and file."""
    return coverage.bin_hits(stream, bin_size, **options).groupBy(*BIN_KEYS).agg(F.sum("count").alias("count"))

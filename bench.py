"""Headline queries, timed. Prints one JSON line.

``value`` is the sum of the warm times (second run of each query, all rows
computed and dropped); ``cold`` holds the first runs. ``reads_per_sec`` are the
rates of the read-counting queries, the ``x50`` ones over fifty shifted copies
of the reads, which lie on disk as Parquet before any clock starts.
The tables come as one file with one row group each, which one task has to
read; they are written anew as FILES files first, as a job would find them.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

from strandline.operators import coverage
from strandline.plans.queries import QUERIES
from strandline.session import build_session
from strandline.sources.views import Views

HEADLINE = ["bin_counts", "bin_summary", "region_counts", "overlap_join", "mask_anti", "stitch", "super_table",
            "depth_segments", "diff_table", "fold_table", "guide_extract"]
COPIES = 50
FILES = 16
TABLES = ("lineitem", "orders", "part", "customer", "supplier", "events", "documents")


def copied_reads(views: Views):
    """Fifty copies of every read, each moved along by 17 bases."""
    copies = views.reads().withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    return copies.withColumns({c: F.col(c) + F.col("_copy") * 17 for c in ("start", "end")}).drop("_copy")


class Copies:
    """The copied reads on disk, written once in as many files as a job of that size would have."""

    def __init__(self, spark, folder, path):
        views = Views(spark, folder)
        columns = ["file_key", "cell_type", "chrom", "start", "end", "strand"]
        copied_reads(views).select(*columns).repartition(32).write.parquet(f"{path}/reads")
        views.file_chroms().write.parquet(f"{path}/chroms")
        self.path = path

    def reads(self, spark):
        return spark.read.parquet(f"{self.path}/reads")

    def chroms(self, spark):
        return spark.read.parquet(f"{self.path}/chroms")

    def bin_counts_x50(self, spark, folder):
        return coverage.bin_counts(self.reads(spark), self.chroms(spark), 100_000)


def timed(run, spark, folder) -> float:
    began = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    runs = {name: QUERIES[name] for name in HEADLINE}
    cold, warm = {}, {}
    with tempfile.TemporaryDirectory(prefix="strandline-bench-") as path:
        for name in TABLES:
            spark.read.parquet(f"{folder}/{name}.parquet").repartition(FILES).write.parquet(f"{path}/{name}.parquet")
        scale, folder = folder.rstrip("/").rsplit("sf", 1)[-1], path
        copies = Copies(spark, folder, path)
        runs["bin_counts_x50"] = copies.bin_counts_x50
        for name, run in runs.items():
            cold[name] = round(timed(run, spark, folder), 3)
            warm[name] = round(timed(run, spark, folder), 3)
            print(name, cold[name], warm[name], file=sys.stderr, flush=True)
        n_reads = Views(spark, folder).table("lineitem").count()
    rates = {name: round(n_reads * (COPIES if name.endswith("x50") else 1) / warm[name])
             for name in ("bin_counts", "region_counts", "bin_counts_x50")}
    print(json.dumps({
        "metric": "headline queries, warm, total", "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm,
        "cold": cold, "reads_per_sec": rates, "sf": scale, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()

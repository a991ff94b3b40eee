"""Session settings shared by the entry point, the bench and the tests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = (
        SparkSession.builder.appName("strandline")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names; a temporary one only for local runs."""
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="strandline-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Write the rows as a table in the shared checkpoint folder and read them back.

    Lineage ends there, executors may be lost afterwards, and the optimizer
    knows the true size of what follows.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/strandline-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Remove the files of tables that :func:`checkpointed` wrote, once everything that reads them is written itself."""
    for df in frames:
        spark = df.sparkSession
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            if not folder.rsplit("/", 1)[1].startswith("strandline-"):
                raise ValueError(f"not a written table: {folder}")
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

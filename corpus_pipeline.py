"""The corpus stages over `documents`, each written and read again before the next.

All stages take rows with null, empty or very long texts, null or repeated ids, equal rows, further columns of any name,
and no rows at all; what becomes of each is said at the stage. All but the last return the columns they got.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import bpe, common, decontaminate, near_dedup, substring, toxicity
from strandline.llm.queries import TOKENIZER, bpe_digest


def _decided(docs: DataFrame, keys: DataFrame, *, once: bool = False) -> DataFrame:
    """The rows of docs whose doc_id and text have a row in keys (doc_id, _key); `once`: of repeated ones a single row."""
    own = "_key" + "_" * max(map(len, docs.columns))  # no column has this name
    rows = docs.withColumn(own, common.row_key(F.col("doc_id").cast("long"), F.col("text")))
    other = keys.select(F.col("doc_id").alias(f"{own}i"), F.col("_key").alias(f"{own}k")).distinct()
    kept = rows.join(other, (F.col(own) == F.col(f"{own}k")) & F.col("doc_id").eqNullSafe(F.col(f"{own}i")), "left_semi")
    return (kept.dropDuplicates(["doc_id", own]) if once else kept).drop(own)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half; the field learns from the labelled documents that are not held out.

    Each row is judged by its own text, so equal rows and repeated ids stay or go alike. Null and empty texts have no
    toxic words and stay. Without labels nothing is learned and all rows stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    field = toxicity.learn(docs, labels, F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 != 0, F.lit(False)))
    return toxicity.keep_clean(docs, field)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, that of the smallest doc_id; of repeated rows one.

    Texts without words are nobody's duplicates and stay. Rows of one id with other texts are documents of their own;
    those whose id is their component's stay. A null id stays in a component without any id."""
    kept = near_dedup.near_duplicates(docs).where("kept")
    return _decided(docs, kept, once=True)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut; n_chars follows, and rows of which nothing is left go.

    Null, empty and short texts have no passages and stay as they are; a null id is earlier than all others."""
    out = substring.remove_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated. Null and empty texts are clean; without benchmark items all are."""
    found = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _decided(docs, found.where(~F.col("contaminated")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the text decoded from them, one row a document; null and empty texts have no ids."""
    return bpe_digest(bpe.encode_documents(docs, public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("toxicity", reject_toxic),
    ("minhash_near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_passages),
    ("bpe", tokens),
]

#: The first stage is a learned model, which SQL can't express; tests hold the stages and the whole against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet to the shared checkpoint folder and read again. What a
    stage read of the one before goes when it is written."""
    common.cut(spark.range(1))  # sets the folder where it is unset
    folder = f"{spark.sparkContext.getCheckpointDir()}/stages-{uuid.uuid4().hex}"
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if last:
            common.remove(spark, last)
        last = f"{folder}/{name}"
    return docs

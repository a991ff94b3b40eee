"""Exact duplicates: fixed-size blocks are sorted into integer names, and adjacent names are named in pairs until each
document has one."""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import cut

#: Bytes of a block. Larger blocks make fewer rows, smaller ones let long documents share more names.
BLOCK = 4096
#: Characters without meaning for equality.
BLANKS = " \t\n\x0b\f\r"


def squeezed(text: Column, blanks: str = BLANKS) -> Column:
    """The text without `blanks`, as bytes; empty for null."""
    return reduce(lambda out, c: F.replace(out, F.lit(c), F.lit("")), blanks, F.coalesce(text, F.lit(""))).cast("binary")


def _blocks(body: Column, size: int, each) -> Column:
    """`each` of the body's blocks in order; an empty body is one empty block."""
    last = F.greatest(F.ceil(F.octet_length(body) / F.lit(size)).cast("int") - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: each(F.substring(body, i * size + 1, F.lit(size))))


def _keys(block: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(2 * seed), block).alias("k1"), F.xxhash64(F.lit(2 * seed + 1), block).alias("k2"))


def named(things: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows of `columns` with their integer `name`: the partition and the place in its sorted order. Equal rows
    are merged in the tasks that read them, so common ones cost no more than others in the shuffle; the order makes a
    task that runs again give the same names."""
    return things.select(*columns).distinct().sortWithinPartitions(*columns).withColumn("name", F.monotonically_increasing_id())


def identities(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """Per document row: ref (a number of its own), doc_id, n_chars (code points), n_bytes and text_sha256 of the squeezed
    text, and name. Two rows have the same n_bytes and name if and only if their squeezed texts are equal.

    Blocks are named from their sorted bytes. Documents find the names by two 64-bit hashes of a block, which are first
    shown to differ for all distinct blocks of this corpus (else others are taken), so no two blocks share a name.
    A round then names all pairs of adjacent names; a document of n blocks has one name after log2(n) rounds."""
    bodies = docs.select(F.col(doc_id).alias("doc_id"), F.length(F.coalesce(F.col(text), F.lit(""))).alias("n_chars"), squeezed(F.col(text)).alias("body"))
    for seed in itertools.count():
        hashed = lambda b: _keys(b, seed)  # noqa: B023, E731
        rows = cut(bodies.select(
            F.monotonically_increasing_id().alias("ref"), "doc_id", "n_chars", F.octet_length("body").alias("n_bytes"),
            F.sha2("body", 256).alias("text_sha256"), _blocks(F.col("body"), block, hashed).alias("keys")))
        blocks = bodies.select(F.explode(_blocks(F.col("body"), block, lambda b: b)).alias("block"))
        names = cut(named(blocks, ["block"]).select(_keys(F.col("block"), seed).alias("key"), "name"))
        if names.groupBy("key").count().where("count > 1").isEmpty():
            break
    tokens = rows.select("ref", F.size("keys").alias("n"), F.posexplode("keys").alias("at", "key"))
    tokens = cut(tokens.join(names, "key").select("ref", "n", "at", "name"))
    done = [tokens.where("n = 1").select("ref", "name")]
    widest = rows.agg(F.max(F.size("keys"))).first()[0] or 1
    while widest > 1:
        side = lambda k: F.max(F.when(F.col("at") % 2 == k, F.col("name")))
        pairs = tokens.where("n > 1").withColumn("half", F.shiftright("at", 1)).groupBy("ref", "n", "half").agg(
            side(0).alias("a"), F.coalesce(side(1), F.lit(-1)).alias("b"))
        pairs = pairs.select("ref", F.ceil(F.col("n") / 2).cast("int").alias("n"), F.col("half").alias("at"), "a", "b")
        tokens = cut(pairs.join(named(pairs, ["a", "b"]), ["a", "b"]).select("ref", "n", "at", "name"))
        done.append(tokens.where("n = 1").select("ref", "name"))
        widest = -(-widest // 2)
    return rows.drop("keys").join(reduce(DataFrame.unionByName, done), "ref")


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """Every document row with the one that stays of those whose texts are equal but for blanks: the most code points,
    then the smallest doc_id (null last).

    Null text counts as empty, and empty texts equal each other; of rows that also agree in doc_id and length one
    stays; other columns are ignored; no rows give no rows. Texts of any length are read whole, block by block.
    Columns: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = cut(identities(docs, doc_id, text, block))
    order = F.struct((-F.col("n_chars")).alias("chars"), F.col("doc_id").isNull().alias("none"), "doc_id", "ref")
    # written, so that the join below has plain shuffles on either side and a large class is split
    classes = cut(rows.groupBy("n_bytes", "name").agg(F.count(F.lit(1)).alias("group_size"), F.min(order).alias("best")))
    return rows.join(classes, ["n_bytes", "name"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("ref") == F.col("best.ref")).alias("kept"), "text_sha256")

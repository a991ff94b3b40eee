"""Benchmark decontamination: prefix-filtered join of word windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandline.llm.common import cut, row_key, words

WINDOW, SHINGLE = 13, 3
#: NOT_WORD before lower-casing.
NOT_LETTER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _shingles(w: Column, size: int) -> Column:
    """Hashes of all runs of `size` words, in order."""
    last = F.size(w) - size
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)])))


def windows(items: DataFrame, window: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, length, window_words): every distinct run of `window` words of an item; a shorter item is one window."""
    rows = items.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    rows = rows.withColumn("length", F.least(F.size("w"), F.lit(window)))
    rows = rows.withColumn("start", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("length"))))
    return rows.select("item_id", "length", F.slice("w", F.col("start") + 1, F.col("length")).alias("window_words")).distinct()


def occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text",
                item_id: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, _key, start, length, window_words) of each place where a window stands, and the windows by item.

    Every shingle of a window must occur in a document that contains it, so the rarest alone (the prefix for full
    containment) finds all candidates; the shingle's place in the window gives the start, which must leave room for the
    whole window, and the words are then compared."""
    by_item = cut(windows(items, window, item_id, item_text))
    distinct = by_item.select("length", "window_words").distinct()
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("_key", row_key("doc_id", "text"))
    split = source.select("doc_id", "_key", words(F.col("text")).alias("w"))
    found, tokens = None, None
    for size in sorted(r[0] for r in by_item.select(F.least("length", F.lit(shingle))).distinct().collect()):  # at most `shingle` rows
        own = distinct.where(F.least("length", F.lit(shingle)) == size).select("window_words", "length", F.posexplode(_shingles(F.col("window_words"), size)).alias("offset", "token"))
        own = own.withColumn("size", F.lit(size))
        here = split.select("doc_id", "_key", F.size("w").alias("n_words"), F.posexplode(_shingles(F.col("w"), size)).alias("at", "token"))
        here = here.join(own.select("token").distinct(), "token").withColumn("size", F.lit(size))
        found, tokens = (here, own) if found is None else (found.unionByName(here), tokens.unionByName(own))
    if found is None:
        empty = split.select("doc_id", "_key", F.lit(0).alias("start"), F.lit(0).alias("length"), F.col("w").alias("window_words")).limit(0)
        return empty, by_item
    found = cut(found)
    seen = found.groupBy("size", "token").agg(F.count(F.lit(1)).alias("n"))
    ranked = tokens.join(seen, ["size", "token"], "left")
    prefix = ranked.groupBy("window_words", "length").agg(
        F.count(F.lit(1)).alias("all"), F.count("n").alias("seen"), F.min(F.struct("n", "size", "token", "offset")).alias("rarest")
    ).where(F.col("all") == F.col("seen")).select("window_words", "length", "rarest.size", "rarest.token", "rarest.offset")
    candidates = found.join(prefix, ["size", "token"]).withColumn("start", F.col("at") - F.col("offset"))
    candidates = candidates.where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
    per_doc = candidates.groupBy("doc_id", "_key").agg(F.collect_set(F.struct("start", "length", "window_words")).alias("_c"))
    held = source.join(per_doc.withColumnsRenamed({"doc_id": "_id", "_key": "_k"}), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k")))
    held = held.select("doc_id", "_key", "_c", words(F.col("text")).alias("w"))
    true = F.filter("_c", lambda c: (c["start"] < F.size("w")) & (F.slice(F.col("w"), c["start"] + 1, c["length"]) == c["window_words"]))
    places = held.select("doc_id", "_key", F.explode(true).alias("c")).select("doc_id", "_key", "c.*")
    return places, by_item


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document row: words, words inside any occurrence of a window of `items`, and the items that occur.

    Null or empty text has no words and is clean; a null doc_id is a value of its own; equal rows get equal results;
    items without words and null item_ids' ids are left out; other columns are ignored. No items: all clean.
    Columns: doc_id, n_words, n_hit, items (sorted array of strings), contaminated, _key (row_key of doc_id and text)."""
    places, by_item = occurrences(docs, items, window, shingle, doc_id, text, item_id, item_text)
    places = cut(places)
    spans = places.groupBy("doc_id", "_key", "start").agg(F.max("length").alias("length")).withColumn("end", F.col("start") + F.col("length"))
    spans = spans.withColumn("reached", F.max("end").over(Window.partitionBy("doc_id", "_key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce("reached", F.lit(0))))
    hits = spans.groupBy("doc_id", "_key").agg(F.sum(fresh).alias("n_hit"))
    named = places.select("doc_id", "_key", "window_words").distinct().join(by_item.where("item_id IS NOT NULL"), "window_words")
    named = named.select("doc_id", "_key", F.col("item_id").cast("string").alias("item")).distinct()
    named = named.groupBy("doc_id", "_key").agg(F.sort_array(F.collect_list("item")).alias("items"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t"))
    rows = rows.select("doc_id", row_key("doc_id", "_t").alias("_key"), F.size(F.filter(F.split(F.coalesce("_t", F.lit("")), NOT_LETTER), lambda w: w != "")).cast("long").alias("n_words"))
    for part in (hits, named):
        part = part.withColumnsRenamed({"doc_id": "_id", "_key": "_k"})
        rows = rows.join(part, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k")), "left").drop("_id", "_k")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"), "_key",
    )

"""One query for each operator, over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import bpe, chat, decontaminate, exact_dedup, hard_negatives, language, licences, near_dedup, neighbours, resampling, sharding, substring, toxicity

TOKENIZER = "word_bpe_49k.json"
SHARDS = 40


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _part(column: str, n: int) -> F.Column:
    return F.crc32(F.col(column).cast("string")) % n


def near_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def substring_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(_table(spark, sf_dir, "documents"))


def sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(_table(spark, sf_dir, "documents"), SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.learn(docs, F.coalesce(_part("doc_id", 4) != 2, F.lit(False)))
    held = F.coalesce(_part("doc_id", 4) == 2, F.lit(False))
    return language.identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return bpe_digest(rows)


def bpe_digest(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def neighbours_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return rows.select("query_id", "rank", "vec_id", "score")


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv_id, formatted, spans in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            turns = chat.parse(formatted)
            loss = "".join(chat.unescape(formatted[s["start"] : s["end"]]) for s in spans)
            whole = "".join(f"{role}\n{text}\n" for role, text, _, _ in turns)
            digest = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (whole, loss)]
            rows.append((conv_id, len(turns), digest[0], len(loss), digest[1], len(formatted)))
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)], names)


def chat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    out = chat.format_chats(rows.unionByName(more)).select("conv_id", "formatted", "loss_spans")
    return out.mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    field = toxicity.learn(docs, _table(spark, sf_dir, "labels"), F.coalesce(_part("doc_id", 5) != 0, F.lit(False)))
    held = F.coalesce(_part("doc_id", 5) == 0, F.lit(False))
    return toxicity.score_toxicity(docs, field).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def licences_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licences.scan_licences(_table(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m["base"])
    labels = lambda m: F.array_join(F.sort_array(F.array_distinct(F.transform(m, lambda x: x["label"]))), ",")
    starts = F.transform(base, lambda m: m["start"])
    return rows.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"),
    )


def exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def hard_negatives_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def resampling_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": near_dedup_query,
    "op2_substring_dedup": substring_query,
    "op3_sharding": sharding_query,
    "op4_language_id": language_query,
    "op5_bpe": bpe_query,
    "op6_nearest_neighbours": neighbours_query,
    "op7_chat_format": chat_query,
    "op8_decontamination": decontaminate_query,
    "op9_toxicity": toxicity_query,
    "op10_licence_scan": licences_query,
    "op11_exact_dedup": exact_dedup_query,
    "op12_hard_negatives": hard_negatives_query,
    "op13_importance_resampling": resampling_query,
}

_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPLIT = f"list_filter(regexp_split_to_array({_AZ}, '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+'), lambda x: x <> '')"
_BLANKS = f"list_filter(regexp_split_to_array({_AZ}, '[ \\t-\\r]+'), lambda x: x <> '')"

ORACLE_SQL: dict[str, str] = {
    "op1_near_dedup": f"""
        WITH RECURSIVE w AS (SELECT doc_id, {_BLANKS} AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                     ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
        r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.c = e.a),
        m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
        FROM documents d LEFT JOIN n USING (doc_id) JOIN m ON m.doc_id = d.doc_id""",
    "op7_chat_format": r"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        f AS (SELECT *, regexp_replace(text, '([\[<])(\\*)(/?INST\]|/?TURN\]|SEP\]|/?s>|<SYS>>|</SYS>>)', '\1\\\2\3', 'g') AS x FROM t)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length(x) + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 ELSE 18 + length(role) END)::BIGINT AS formatted_chars
        FROM f GROUP BY conv_id""",
    "op8_decontamination": f"""
        WITH d AS (SELECT doc_id, {_SPLIT} AS w FROM documents), b AS (SELECT item_id, {_SPLIT} AS w FROM benchmark),
        i AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2), lambda k: array_to_string(w[k:k + least(len(w), 13) - 1], ' '))) AS g FROM b WHERE len(w) > 0),
        z AS (SELECT DISTINCT n FROM i),
        q AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos, w FROM d, z WHERE len(w) >= n),
        h AS (SELECT DISTINCT doc_id, q.n, pos, g FROM q JOIN (SELECT DISTINCT n, g FROM i) i ON i.n = q.n AND array_to_string(w[pos:pos + q.n - 1], ' ') = g),
        c AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS k FROM h) GROUP BY doc_id),
        m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h JOIN i USING (n, g)) GROUP BY doc_id)
        SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
        FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)""",
    "op11_exact_dedup": r"""
        WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS x FROM documents)
        SELECT doc_id, first_value(doc_id) OVER (PARTITION BY x ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
               doc_id = first_value(doc_id) OVER (PARTITION BY x ORDER BY n DESC, doc_id) AS kept, sha256(x) AS text_sha256
        FROM t""",
    "op12_hard_negatives": """
        WITH q AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
              FROM q a JOIN q b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        n AS (SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score FROM p JOIN s USING (anchor_id)
              WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
        SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id))::INTEGER AS rank,
               negative_id, positive_score, negative_score FROM n QUALIFY rank <= 5""",
    "op13_importance_resampling": f"""
        WITH byte AS (SELECT list(c ORDER BY i) AS c FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, _: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(i))),
        w AS (SELECT doc_id, unnest({_SPLIT}) AS w FROM documents), v AS (SELECT unnest({_SPLIT}) AS w FROM benchmark),
        h AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM w UNION SELECT w FROM v)),
        k AS (SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT)),
                     lambda a, b: xor(a >> 8, byte.c[(xor(a, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM h, byte),
        s AS (SELECT bucket, count(*) AS s FROM w JOIN k USING (w) GROUP BY bucket), t AS (SELECT bucket, count(*) AS t FROM v JOIN k USING (w) GROUP BY bucket),
        g AS (SELECT k.bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
                     / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
              FROM (SELECT DISTINCT bucket FROM k) k LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
        d AS (SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS total FROM w JOIN k USING (w) JOIN g USING (bucket) GROUP BY doc_id),
        e AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce((total - ((total % n) + n) % n) // n, 0)::BIGINT AS weight,
                     ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h FROM documents LEFT JOIN d USING (doc_id)),
        f AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5)::DOUBLE / 4294967296::DOUBLE)))::BIGINT AS score FROM e),
        r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM f WHERE n_features >= 20)
        SELECT f.doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) * 10 // 100 FROM r) THEN rank END AS rank FROM f LEFT JOIN r ON r.doc_id = f.doc_id""",
}

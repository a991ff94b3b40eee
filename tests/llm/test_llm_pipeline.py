"""The corpus stages, each and all together, against plain versions of themselves."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandline.llm import queries, substring, toxicity

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
DOC = "doc_id long, text string, lang string, source string, n_chars long"
HARD = [None, "", " \n\t", "a", "a b c d e f g", "one two", "word " * 2000, "x\0y \x85 z", "A b", "a B"]


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS)


@pytest.fixture(scope="module")
def hard(spark, docs):
    """Hard texts, twice under ids of their own and once without; an id given twice, equal rows, a clashing column."""
    rows = [(i, t, None, "s", 1) for i, t in enumerate(HARD)] + [(100 + i, t, "en", None, 2) for i, t in enumerate(HARD)]
    rows += [(None, t, None, None, None) for t in HARD] + [(1, "quite another text", "en", "s", 3), (3, "a", None, "s", 1)]
    return spark.createDataFrame([(*r, "k", 0) for r in rows], DOC + ", _key string, n int")


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.select(*COLUMNS).collect()), key=repr)


def field_of(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return toxicity.learn(docs, labels, F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 != 0, F.lit(False)))


def clean_by_hand(spark, docs):
    field = field_of(spark, docs)
    emissions = toxicity.Emissions(field.weights)
    return [r for r in rows_of(docs) if field.score(field.tag([emissions.of(r[1])])[0]) < 0.5]


def unique_by_hand(rows):
    sets, up = [], list(range(len(rows)))
    for r in rows:
        w = blank_words(r[1])
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                up[root(i)] = root(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        least[root(i)].append(r[0])
    out, seen = [], set()
    for i, r in enumerate(rows):
        ids = [x for x in least[root(i)] if x is not None]
        keep = r[0] == (min(ids) if ids else None) if sets[i] else True
        if keep and r[:2] not in seen:
            seen.add(r[:2])
            out.append(r)
    return out


def uncontaminated_by_hand(spark, rows):
    windows = defaultdict(set)
    for item in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = plain_words(item["text"])
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[n].add(tuple(w[i : i + n]))
    out = []
    for r in rows:
        w, hit = plain_words(r[1]), set()
        for n, known in windows.items():
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in known:
                    hit.update(range(i, i + n))
        if not (hit and 20 * len(hit) >= len(w)):
            out.append(r)
    return out


def tokens_by_hand(rows):
    library = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    library.no_padding()
    library.no_truncation()
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        out.append((r[0], len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("which", ["docs", "hard"])
def test_toxic_rows_go(request, spark, which):
    rows = request.getfixturevalue(which)
    out = corpus_pipeline.reject_toxic(spark, rows, SF)
    assert out.columns == rows.columns and rows_of(out) == clean_by_hand(spark, rows)


@pytest.mark.parametrize("which", ["docs", "hard"])
def test_near_duplicates_go(request, spark, which):
    rows = request.getfixturevalue(which)
    out = corpus_pipeline.near_duplicates(spark, rows, SF)
    assert out.columns == rows.columns  # of rows equal in id and text any stays
    assert sorted((r[:2] for r in rows_of(out)), key=repr) == sorted((r[:2] for r in unique_by_hand(rows_of(rows))), key=repr)


@pytest.mark.parametrize("which", ["docs", "hard"])
def test_passages_go(request, spark, which):
    rows = request.getfixturevalue(which)
    out = corpus_pipeline.repeated_passages(spark, rows, SF)
    assert out.columns == rows.columns
    spans = defaultdict(set)
    for r in substring.repeated_passages(rows).collect():
        spans[r["doc_id"]].update(range(r["start"], r["end"]))
    after = defaultdict(list)
    for r in rows_of(out):
        after[r[0]].append(r)
        assert r[4] == (None if r[1] is None else len(r[1]))
    for r in rows_of(rows):
        left = [w for i, w in enumerate(blank_words(r[1])) if i not in spans[r[0]]]
        if which == "docs":
            assert [blank_words(x[1]) for x in after[r[0]]] == ([left] if left or not spans[r[0]] else [])
        elif not spans[r[0]]:
            assert r[1] in [x[1] for x in after[r[0]]]


@pytest.mark.parametrize("which", ["docs", "hard"])
def test_contaminated_rows_go(request, spark, which):
    rows = request.getfixturevalue(which)
    out = corpus_pipeline.benchmark_passages(spark, rows, SF)
    assert out.columns == rows.columns and rows_of(out) == uncontaminated_by_hand(spark, rows_of(rows))


@pytest.mark.parametrize("which", ["docs", "hard"])
def test_tokens(request, spark, which):
    rows = request.getfixturevalue(which)
    got = corpus_pipeline.tokens(spark, rows, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == tokens_by_hand(rows_of(rows))


def test_stages_of_nothing(spark, hard):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, hard.limit(0), SF)
        assert out.count() == 0, name
        assert name == "bpe" or out.columns == hard.columns


def test_all_stages(spark, docs):
    """The whole run gives the digests that the plain versions, one after the other, lead to."""
    rows = unique_by_hand(clean_by_hand(spark, docs))
    schema = docs.schema
    cut = substring.remove_repeats(spark.createDataFrame(rows, schema))
    rows = uncontaminated_by_hand(spark, rows_of(cut.withColumn("n_chars", F.length("text").cast("long"))))
    got = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == tokens_by_hand(rows) and 0 < len(got) < docs.count()

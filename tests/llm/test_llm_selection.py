"""Exact duplicates, hard negatives and importance resampling against plain versions of themselves."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import exact_dedup, hard_negatives, resampling

DOC = "doc_id long, text string, name string, ref string, key string, n string, weight string, label int"
LONG = "lorem ipsum " * 20_000
TEXTS = [None, "", " \n\t", "a", "A", "a b", "ab", "a\tb\x0b", "a b", "Ä ä ñ 日本語 x", "İ I", "x\0y \x85 z", "word " * 3000, LONG, LONG + "x", LONG.replace(" ", "  "), "q" * 9999, "q" * 10000]


@pytest.fixture(scope="module")
def hard(spark):
    """Texts under ids of their own, some ids twice with other texts, equal rows, rows without an id; clashing columns."""
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, t) for i, t in enumerate(TEXTS)] + [(3, t) for t in TEXTS[:9]] + [(None, t) for t in TEXTS] + [(7, "a\tb\x0b")]
    return spark.createDataFrame([(i, t, "n", "r", "k", None, "w", 1) for i, t in rows], DOC)


def kept_by_hand(rows):
    groups = defaultdict(list)
    for at, (doc, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc is None, doc or 0, at))
    out = []
    for squeezed, members in groups.items():
        _, none, best, first = min(members)
        digest = hashlib.sha256(squeezed.encode()).hexdigest()
        out += [(None if no_id else doc, None if none else best, len(members), at == first, digest) for _, no_id, doc, at in members]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_exact_duplicates(spark, hard, block):
    frame = hard if block == 4096 else hard.where("text IS NULL OR length(text) < 100")
    rows = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    got = [tuple(r) for r in exact_dedup.exact_duplicates(frame, block=block).collect()]
    assert sorted(got, key=repr) == kept_by_hand(rows)


def test_exact_names_of_permuted_blocks(spark):
    """Texts of the same blocks in another order or number get other names, copies the same."""
    rng = random.Random(1)
    parts = [c * 4 for c in "abc"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(400)]
    rows = exact_dedup.identities(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), block=4).collect()
    by_name = defaultdict(set)
    for r in rows:
        by_name[r["n_bytes"], r["name"]].add(texts[r["doc_id"]])
    assert all(len(x) == 1 for x in by_name.values()) and len(by_name) == len(set(texts))


def test_names_follow_the_sorted_order(spark):
    """Whatever the order of arrival, equal rows share a name, others don't, and a partition's names rise with its rows."""
    things = [bytes([k % 7, k % 5]) for k in range(200)]
    for seed in range(2):
        frame = spark.createDataFrame([(t,) for t in random.Random(seed).sample(things, 200)], "block binary").repartition(3)
        names = sorted((r["name"], bytes(r["block"])) for r in exact_dedup.named(frame, ["block"]).collect())
        assert sorted(b for _, b in names) == sorted(set(things)) and len({n for n, _ in names}) == len(names)
        parts = defaultdict(list)
        for n, b in names:
            parts[n >> 33].append(b)
        assert all(x == sorted(x) for x in parts.values())


def test_exact_duplicates_of_nothing(spark, hard):
    out = exact_dedup.exact_duplicates(hard.limit(0))
    assert out.collect() == [] and out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def mined_by_hand(rows, anchor, positives=5, negatives=5):
    part = {(i, label, tuple(math.floor(256 * x) for x in v)) for i, label, v in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, label, v in part:
        if not anchor(i):
            continue
        others = sorted((-dot(v, w), j, other == label) for j, other, w in part if j != i)
        for s, j, same in [x for x in others if x[2]][:positives]:
            fit = [x for x in others if not x[2] and 80 * -s <= 100 * -x[0] <= 100 * -s]
            out += [(i, j, k + 1, m, -s, -t) for k, (t, m, _) in enumerate(fit[:negatives])]
    return sorted(out)


def vectors(kind):
    rng = np.random.default_rng(4)
    if kind == "clusters":  # a third of all rows in one narrow cluster of several labels
        centre = rng.normal(size=(6, 16))
        which = np.where(rng.random(700) < 0.33, 0, rng.integers(1, 6, 700))
        return [(k, int(rng.integers(0, 4)), (centre[c] + rng.normal(size=16) * 0.15).tolist()) for k, c in enumerate(which)]
    if kind == "ties":
        return [(k, int(rng.integers(0, 2)), rng.integers(0, 2, 4).astype(float).tolist()) for k in range(400)]
    if kind == "large":  # beyond what doubles hold exactly
        return [(k, k % 3, (rng.normal(size=8) * 2.0**20).tolist()) for k in range(200)]
    return [(k, k % 3, rng.normal(size=5).tolist()) for k in range(300)] + [
        (10, None, [1.0]), (20, 1, None), (30, 1, [1.0, None]), (40, 1, [float("nan")]), (50, 1, [float("inf"), 1.0]), (None, 1, [2.0] * 5), (60, 2, []),
        (70, 1, [0.0] * 5), (80, 0, [9.0]), (90, 0, [3.0] * 7), (100, 1, [2.0] * 5), (100, 1, [2.0] * 5), (100, 2, [1.5] * 5), (-50, 0, [1.0] * 5)]


@pytest.mark.parametrize("kind", ["clusters", "ties", "large", "hard"])
def test_hard_negatives(spark, monkeypatch, kind):
    monkeypatch.setattr(hard_negatives, "GROUP", 7)
    rows = vectors(kind)
    frame = spark.createDataFrame([(i, label, v, "x", 0) for i, label, v in rows], "vec_id long, label int, embedding array<double>, code string, number int")
    got = sorted(tuple(r) for r in hard_negatives.mine(frame, F.col("vec_id") % 10 == 0).collect())
    assert got == mined_by_hand(rows, lambda i: i % 10 == 0)
    assert kind == "ties" or got


def test_no_hard_negatives(spark):
    rows = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine(rows, F.col("vec_id") % 2 == 0).collect() == []
    rows = spark.createDataFrame([(1, 1, [1.0]), (3, 2, [1.0])], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine(rows, F.col("vec_id") % 2 == 0).collect() == []
    with pytest.raises(OverflowError):
        hard_negatives.whole([1e300], 256)


def test_bounds_hold_the_scores():
    rng = np.random.default_rng(2)
    codes = [(rng.normal(size=6) * 10.0 ** rng.integers(0, 6)).astype(np.int64).tobytes() for _ in range(60)]
    codes += [np.zeros(6, np.int64).tobytes(), b""]
    refs = rng.normal(size=(4, 6))
    refs /= np.linalg.norm(refs, axis=1, keepdims=True)
    rows = hard_negatives.Rows(list(range(len(codes))), ["a"] * len(codes), codes, refs)
    low, high = rows.bounds(rows)
    exact = rows.x @ rows.x.T
    assert (low <= exact).all() and (exact <= high).all() and np.median(high - low) < np.median(2 * np.outer(rows.norms, rows.norms))


def test_pairs_out_of_reach_are_not_scored(monkeypatch):
    """Two opposite clusters: the rows of the other one never get an exact score."""
    rng, scored = np.random.default_rng(3), []
    x = np.concatenate([rng.normal(size=(50, 8)) * 2 + 200, rng.normal(size=(50, 8)) * 2 - 200]).astype(np.int64)
    refs = np.ones((1, 8)) / math.sqrt(8)
    rows = hard_negatives.Rows(list(range(100)), ["a", "b"] * 50, [v.tobytes() for v in x], refs)
    low, high = rows.bounds(rows)
    exact = hard_negatives.Rows.scores
    monkeypatch.setattr(hard_negatives.Rows, "scores", lambda self, i, other, which: scored.extend(which.tolist()) or exact(self, i, other, which))
    best = hard_negatives._Best(5)
    hard_negatives._scan(best, 0, 0, [(None, None)], rows, 0, rows, np.arange(100) > 0, low[0], high[0], 5)
    assert scored and max(scored) < 50


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def runs(text, longest):
    w = words_of(text)
    return [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def resampled_by_hand(rows, target, longest=1, buckets=10_000, least=20, percent=10):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = (Counter(bucket(g) for _, text in x for g in runs(text, longest)) for x in (rows, target))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    out = []
    for doc, text in rows:
        g = [gain(bucket(x)) for x in runs(text, longest)]
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(g) // len(g) if g else 0
        out.append([doc, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(text))])
    able = sorted((x for x in out if x[5] >= least), key=lambda x: (-x[3], x[0] is not None, x[0] or 0, x[1]))
    for k, x in enumerate(able[: percent * len(able) // 100]):
        x[4] = k + 1
    return sorted((tuple(x[:5]) for x in out), key=repr)


@pytest.mark.parametrize("longest", [1, 3])
@pytest.mark.parametrize("which", ["documents", "hard"])
def test_resampling(spark, hard, which, longest):
    docs = hard if which == "hard" else spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    percent = 10 if which == "documents" else 60
    want = resampled_by_hand(rows, [(0, r["text"]) for r in target.collect()], longest, percent=percent)
    got = sorted((tuple(r) for r in resampling.resample(docs, target, longest=longest, percent=percent).collect()), key=repr)
    assert got == want and any(r[4] for r in got)


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_long_texts_in_pieces(longest):
    rng = random.Random(5)
    text = "".join(rng.choice(["ab", "É", "c1 ", " ", "-", "\n", "x" * 30, "Q. "]) for _ in range(3000))
    split = resampling.pre_tokenizers.Split(resampling.Regex("[^" + resampling.NOT_WORD[1:-2] + "]+"), behavior="removed", invert=True)
    want = Counter(zlib.crc32(g.encode()) % 100 for g in runs(text, longest))
    for piece in (1, 7, 50, 10**6):
        n, found = resampling.features(text, split, resampling._Buckets(100), longest, piece)
        assert n == len(words_of(text)) and Counter(found.tolist()) == want


def test_resampling_of_nothing(spark, hard):
    target = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resample(hard.limit(0), target).collect() == []
    rows = resampling.resample(hard, target).collect()
    assert len(rows) == hard.count()

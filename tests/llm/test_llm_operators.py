"""Each operator against a plain version of itself, on the small tables and on hard rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from strandline.llm import bpe, chat, common, decontaminate, language, licences, near_dedup, neighbours, queries, sharding, substring, toxicity

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, _key string, n string, same string, w string, id long"
HARD = [None, "", " \n\t", "a", "A b C d", "a b c d e", "a b c d e f", "Ä ä ñ 日本語 ​ x", "<|endoftext|> I'LL 's İΣ", "word " * 3000, "all rights reserved. CC BY 4.0, cc-by", "x\0y \x85 z"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id")


@pytest.fixture(scope="module")
def hard(spark):
    """Hard texts, each twice under ids of its own, once under an id given before, once without an id; clashing columns."""
    rows = [(i, t) for i, t in enumerate(HARD)] + [(100 + i, t) for i, t in enumerate(HARD)] + [(3, t) for t in HARD] + [(None, t) for t in HARD]
    return spark.createDataFrame([(i, t, "en", None, 0, "k", "n", "s", "w", 5) for i, t in rows], DOC)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def letters_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def shingles(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def linked(rows):
    """component by brute force; nodes are row numbers."""
    sets, up = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                up[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        least[root(i)].append(doc)
    return sorted((doc is None, doc or 0, len(s), min((x for x in least[root(i)] if x is not None), default=None) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True)))


@pytest.mark.parametrize("which", ["docs", "hard"])
def test_near_duplicates(request, which):
    frame = request.getfixturevalue(which)
    rows = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(frame).collect())
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(got, key=key) == sorted(linked(rows), key=key)


def test_near_duplicate_chains_and_groups(spark):
    """A chain of texts each linked with the next only, a group of many near copies, and texts that share a common half."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    texts, base = [], [word() for _ in range(120)]
    for _ in range(8):
        texts.append(" ".join(base))
        base = base[9:] + [word() for _ in range(9)]
    stem = [word() for _ in range(90)]
    for k in range(60):
        copy = list(stem)
        copy[k % 90] = word()
        texts.append(" ".join(copy))
    half = [word() for _ in range(60)]
    texts += [" ".join(half + [word() for _ in range(50)]) for _ in range(40)]
    rows = list(enumerate(texts))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((False, r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == linked(rows)


def test_components_that_only_the_exact_join_ties(spark, monkeypatch):
    """Without the comparisons in bands all links are left to the join by prefixes."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    texts = []
    for _ in range(6):
        stem = [word() for _ in range(100)]
        for k in range(6):
            texts.append(" ".join(stem[:k] + [word()] + stem[k + 1 :]))
    monkeypatch.setattr(near_dedup, "_likely_batches", lambda batches: iter([b for b in batches][:0]))
    rows = list(enumerate(texts))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((False, r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == linked(rows)


def test_links_of_a_single_band(spark, monkeypatch):
    """Classes that share one band only are joined exactly too."""
    word = _random_words(7)
    texts = []
    for _ in range(4):
        stem = word(100)
        texts += [" ".join(stem[:k] + word() + stem[k + 1 :]) for k in range(3)]
    monkeypatch.setattr(near_dedup, "_likely_batches", lambda batches: iter([b for b in batches][:0]))
    monkeypatch.setattr(near_dedup, "bands", lambda registers: F.array(F.xxhash64(F.length(registers))))
    rows = list(enumerate(texts))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((False, r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == linked(rows)


def test_joint_estimate():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.75, 0.9):
        x = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
        both = int(2000 * 2 * share / (1 + share))
        a, b = x[:2000], np.concatenate([x[:both], x[2000 : 4000 - both]])
        ra, rb = near_dedup.registers(a), near_dedup.registers(b)
        assert (np.maximum(ra, rb) == near_dedup.registers(np.union1d(a, b))).all()
        got = near_dedup.jaccard(ra[None], rb[None], np.array([2000.0]), np.array([2000.0]))[0]
        assert abs(got - share) < 0.15


def test_linked_sets_meet_in_their_prefixes(spark):
    rng = np.random.default_rng(4)
    base = [set(rng.integers(0, 400, n).tolist()) for n in (1, 8, 30, 60)]
    sets = [{int(rng.integers(400, 9000)) if rng.random() < share else x for x in one} | {7} for one in base for share in (0, 0.05, 0.1, 0.15, 0.3) for _ in range(5)]
    tokens = spark.createDataFrame([(t, i) for i, one in enumerate(sets) for t in one], "token long, id long")
    sizes = spark.createDataFrame([(i, len(one)) for i, one in enumerate(sets)], "id long, n long")
    placed = near_dedup.prefixes(tokens, sizes).collect()
    heads = [{r["token"] for r in placed if r["id"] == i} for i in range(len(sets))]
    holders = {t: sum(t in one for one in sets) for one in sets for t in one}
    for i, one in enumerate(sets):
        order = sorted(one, key=lambda t: (holders[t], t))
        assert heads[i] == {t for t in order[: len(one) - -(-len(one) * 75 // 100) + 1] if holders[t] > 1}
        assert all(heads[i] & heads[k] for k in range(i) if 100 * len(one & sets[k]) >= 75 * len(one | sets[k]))


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(1, 50)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    got = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in up}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_repeated_passages(spark, docs, hard, empty):
    """Every run of 50 words or more that an earlier document holds is covered by passages; clean rows stay as they are."""
    rows = [(r["doc_id"], words_of(r["text"])) for r in docs.collect()]
    seen, need = {}, defaultdict(set)
    for doc, w in rows:
        mine = set()
        for i in range(len(w) - 49):
            run = tuple(w[i : i + 50])
            if run in seen:
                need[doc].update(range(i, i + 50))
            mine.add(run)
        for run in mine:
            seen.setdefault(run, doc)
    found = substring.repeated_passages(docs).collect()
    have = defaultdict(set)
    for r in found:
        assert r["other_id"] < r["doc_id"] and r["n_words"] >= 50 and r["identity"] >= 0.75
        have[r["doc_id"]].update(range(r["start"], r["end"]))
    assert need and all(v <= have[k] for k, v in need.items())
    left = {r["doc_id"]: r["text"] for r in substring.remove_repeats(docs).collect()}
    for r in docs.collect():
        if r["doc_id"] not in have:
            assert left[r["doc_id"]] == r["text"]
        elif r["doc_id"] in left:
            assert words_of(left[r["doc_id"]]) == [w for i, w in enumerate(words_of(r["text"])) if i not in have[r["doc_id"]]]
        else:
            assert len(have[r["doc_id"]]) == len(words_of(r["text"]))
    assert substring.remove_repeats(hard).columns == hard.columns
    kept = [r for r in substring.remove_repeats(hard).collect() if r["text"] == HARD[9]]
    assert [r["doc_id"] for r in kept] == [None]
    assert substring.remove_repeats(empty).count() == 0 and substring.repeated_passages(empty).count() == 0


def test_fuzzy_passages(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(6))
    passage = [word() for _ in range(80)]
    fuzzy = list(passage)
    for i in (7, 20, 21, 40, 55, 70):
        fuzzy[i] = word()
    del fuzzy[60]
    texts = [" ".join([word() for _ in range(30)] + p + [word() for _ in range(30)]) for p in (passage, fuzzy, [word() for _ in range(80)])]
    found = substring.repeated_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["other_id"]) for r in found] == [(1, 0)]
    assert found[0]["start"] <= 40 and found[0]["end"] >= 100 and found[0]["identity"] > 0.85


def test_chain_by_hand():
    rng = random.Random(2)
    for _ in range(200):
        parts = sorted((rng.randrange(60), rng.randrange(60), rng.randrange(5, 9)) for _ in range(rng.randrange(1, 9)))
        best = {}
        for j, (p, q, n) in enumerate(parts):
            best[j] = float(n)
            for i in range(len(parts)):
                a, b, m = parts[i]
                if i in best and a + m <= p and b + m <= q and p - a - m <= substring.GAP and q - b - m <= substring.GAP and parts[i] < parts[j]:
                    best[j] = max(best[j], n + best[i] - substring.GAP_COST * (p - a - m + q - b - m))
        got = substring.chains(parts)
        assert sorted(x for c in got for x in c) == parts
        first = got[0]
        score = sum(n for _, _, n in first) - substring.GAP_COST * sum(y[0] - x[0] - x[2] + y[1] - x[1] - x[2] for x, y in zip(first, first[1:], strict=False))
        assert score >= 0.7 * max(best.values())
        assert all(x[0] + x[2] <= y[0] and x[1] + x[2] <= y[1] for x, y in zip(first, first[1:], strict=False))


def _random_words(seed):
    rng = random.Random(seed)
    return lambda n=1: ["".join(rng.choice("abcdefghijklm") for _ in range(6)) for _ in range(n)]


def test_passage_whose_halves_others_hold(spark):
    """The seeds of either half have other first and last holders than the whole; the whole and its fuzzy copy are found."""
    word = _random_words(4)
    s1, s2 = word(30), word(30)
    fuzzy = [*s1, *s2]
    for i in (9, 19, 29, 39, 49):
        fuzzy[i] = word()[0]
    parts = {1: s1, 2: s2, 3: s1 + s2, 4: s1, 5: s2, 6: s1 + s2, 7: s1, 8: s2, 9: fuzzy}
    rows = [(i, " ".join(word(40) + p + word(40))) for i, p in parts.items()]
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["start"], r["end"]) for r in found if r["other_id"] == 3} == {(6, 40, 100), (9, 40, 100)}
    assert {r["doc_id"] for r in found} == {6, 9}


def test_recall_over_lengths_and_identities(spark):
    """Passages with every n-th word changed, each in a pair of documents of its own."""
    word, rows, cases = _random_words(5), [], []
    for length in (50, 80, 200):
        for every in (6, 7, 8, 10, 12, 25):
            for shift in range(4):
                passage = word(length)
                changed = [word()[0] if i % every == every - 1 - shift and i < length - 1 else w for i, w in enumerate(passage)]
                cases.append((length, every))
                rows += [(2 * len(cases) + k, " ".join(word(35) + p + word(35))) for k, p in enumerate((passage, changed))]
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    have = defaultdict(set)
    for r in found:
        assert r["doc_id"] == r["other_id"] + 1 and r["identity"] >= 0.75
        have[r["doc_id"] // 2 - 1].update(range(r["start"], r["end"]))
    assert [] == [(case, len(have[k])) for k, case in enumerate(cases) if len(have[k]) < 0.95 * case[0]]


def test_hot_lines_and_copies_lose_no_passage(spark, monkeypatch):
    """A line held by many, which names no pairs, between the halves of a passage whose rare seeds span too little."""
    monkeypatch.setattr(substring, "HOT", 8)
    word = _random_words(6)
    line, head, tail = word(9), word(26), word(26)
    for i in (*range(0, 20, 4), 23, *range(3, 26, 4)):
        (head if i < 24 else tail)[i] = head[i]
    passage = [*head, *line, *tail]
    rows = [(i, " ".join(word(30) + line + word(30))) for i in range(40)]
    copy = " ".join(word(90))
    rows += [(100 + i, copy) for i in range(40)]
    rows += [(200, " ".join(word(30) + passage + word(30))), (201, " ".join(word(30) + passage + word(30)))]
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["other_id"]) for r in found) == [*((100 + i, 100) for i in range(1, 40)), (201, 200)]


def test_common_footers_make_few_pairs(spark):
    """A line of 25 words at the end of 400 texts can't make a passage; each text meets its first holder and no other."""
    word = _random_words(7)
    footer = word(25)
    rows = spark.createDataFrame([(i, " ".join(word(60) + footer)) for i in range(400)], "doc_id long, text string")
    texts = substring._tagged(rows, "doc_id", "text")
    stretches = substring.stretches_of(texts)
    assert stretches.count() == 400
    pairs = substring.first_holders(stretches).union(substring.pair_holders(substring.coded_of(texts, stretches), stretches)).distinct()
    assert 399 <= pairs.count() < 2000
    assert substring.repeated_passages(rows).count() == 0


@pytest.mark.parametrize("parts", [1, 5, 31])
def test_passages_do_not_depend_on_the_partitions(spark, parts):
    """A paragraph of 400 texts, far beyond HOT a slice, names the first holder in all of them."""
    word = _random_words(8)
    common = word(70)
    rows = [(i, " ".join(word(10 + i % 30) + common + word(15))) for i in range(400)]
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
    assert sorted((r["doc_id"], r["other_id"], r["start"], r["end"]) for r in found) == [(i, 0, 10 + i % 30, 80 + i % 30) for i in range(1, 400)]


def test_long_text_with_passages(spark):
    """A text of 200,000 words, whose places need more than two bytes, holds passages at its very end."""
    rng = random.Random(9)
    words = [f"w{rng.randrange(50_000)}" for _ in range(200_000)]
    rows = [(1, " ".join(words)), (2, " ".join(["a", "b", "c", *words[199_900:], "d"])), (3, " ".join(words[65_500:65_600]))]
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted((r["doc_id"], r["start"], r["end"], r["other_id"], r["other_start"], r["other_end"]) for r in found)
    assert got == [(2, 3, 103, 1, 199_900, 200_000), (3, 0, 100, 1, 65_500, 65_600)]


def test_chains_have_the_best_score():
    """Against all predecessors, with heavy segments further away than GAP; then the passage such a segment hid."""
    rng = random.Random(3)
    for _ in range(300):
        size = lambda: rng.choice((5, 6, 8, 30, 200))
        parts = sorted({(rng.randrange(400), rng.randrange(400), size()) for _ in range(rng.randrange(1, 30))})
        best = []
        for p, q, n in parts:
            gaps = [(p - a - m, q - b - m, s) for (a, b, m), s in zip(parts, best, strict=False)]
            best.append(max([float(n)] + [n + s - substring.GAP_COST * (x + y) for x, y, s in gaps if 0 <= x <= substring.GAP and 0 <= y <= substring.GAP]))
        got = substring.chains(parts)
        first = got[0]
        score = sum(n for _, _, n in first) - substring.GAP_COST * sum(y[0] - x[0] - x[2] + y[1] - x[1] - x[2] for x, y in zip(first, first[1:], strict=False))
        assert abs(score - max(best)) < 1e-9 and sorted(x for c in got for x in c) == parts
    assert [(0, 0, 200)] in (got := substring.chains([(0, 0, 200), (300, 300, 30), (330, 331, 30)])) and [(300, 300, 30), (330, 331, 30)] in got


@pytest.mark.parametrize("which", ["docs", "hard", "empty"])
def test_sharding(request, which):
    frame = request.getfixturevalue(which)
    rows = sharding.shard(frame, 7).collect()
    assert sorted(r["row_number"] for r in rows) == sorted(r["place"] for r in rows) == list(range(frame.count()))
    assert [(r["doc_id"] is not None, r["doc_id"], r["text_crc32"], r["size"]) for r in sorted(rows, key=lambda r: r["row_number"])] == sorted(
        ((r["doc_id"] is not None, r["doc_id"], zlib.crc32((r["text"] or "").encode()), len((r["text"] or "").encode()) + 16) for r in frame.collect()),
        key=lambda x: (x[0], x[1] or 0, x[2:]))
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert not rows or max(map(len, slots.values())) - min(len(slots[k]) for k in range(7)) <= 1
    assert rows == sharding.shard(frame.repartition(3), 7).collect() or sorted(rows, key=str) == sorted(sharding.shard(frame.repartition(3), 7).collect(), key=str)


def test_feistel_is_a_permutation(spark):
    for n in (1, 2, 3, 17, 1000):
        rows = sharding.feistel(spark.range(n).withColumnRenamed("id", "p"), "p", n, 3, "q").collect()
        assert sorted(r["q"] for r in rows) == list(range(n))
        assert n < 100 or sum(r["p"] == r["q"] for r in rows) < 20


def test_language(spark, docs, hard, empty):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = queries.language_query(spark, "/root/testdata/sf0.01").alias("r").join(big.alias("d"), "doc_id").where("held_out").select("doc_id", "lang_pred", "lang", "score").collect()
    assert len(rows) > 150 and sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    model = language.learn(docs, F.lit(True))
    got = language.identify(hard, model).collect()
    assert len(got) == hard.count()
    assert all((r["lang_pred"] == "und") == (not any(map(str.isalpha, HARD[r["doc_id"]] or ""))) for r in got if r["doc_id"] is not None and r["doc_id"] < 12 and r["doc_id"] != 3)
    assert {r["lang_pred"] for r in language.identify(hard, language.learn(empty, F.lit(True))).collect()} == {"und"}
    assert language.identify(empty, model).count() == 0


def test_presence_kernel():
    texts = ["Ab cab", "abc", "zz"]
    table, flags = language.symbol_table(language.alphabet(texts)), np.zeros(language._SIZE, bool)
    sets = []
    for t in texts:
        language.presence(t, table, flags)
        sets.append(set(np.flatnonzero(flags).tolist()))
    plain = [{f" {t.lower()} "[i : i + n] for n in language.ORDERS for i in range(len(t) + 3 - n)} for t in texts]
    assert [[len(a & b) for b in sets] for a in sets] == [[len(a & b) for b in plain] for a in plain]


def test_bpe(spark, docs, hard, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries.TOKENIZER)
    real = Tokenizer.from_file(path)
    for frame, limit in ((docs, 500), (hard, 5), (hard, 0)):
        rows = sorted((r["doc_id"] or -1, r["ids"], r["decoded"]) for r in bpe.encode_documents(frame, path, limit).collect())
        want = []
        for r in frame.collect():
            ids = real.encode(r["text"] or "", add_special_tokens=False).ids
            want.append((r["doc_id"] or -1, ids, real.decode(ids, skip_special_tokens=False)))
        assert rows == sorted(want)
    assert bpe.encode_documents(empty, path, 10).count() == 0


def test_bpe_odd_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries.TOKENIZER)
    real, own = Tokenizer.from_file(path), bpe.Tokenizer(path)
    rng = random.Random(4)
    pools = ["abcdefgh '", "'stremvld ", "ÀÉñßſ ́̀", "0123٣४½²", "日本語한국", "!?.,-_…“”", " \t\n\x0b\x85\xa0   　", "ΑΒΣσς", "<|endoftext|>", "😀👍🏽‍", "İIıi", "\0\x01\x7f"]
    for _ in range(3000):
        text = "".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(30)))
        if rng.random() < 0.1:
            text = text[:5] + "<|startoftext|>" + text[5:]
        got = [i for w in own.pieces(text) for i in own.merge(w)]
        assert got == real.encode(text, add_special_tokens=False).ids, repr(text)


def test_transducer(tmp_path):
    rng = random.Random(6)
    words = {bytes(rng.choice(b"abcx") for _ in range(rng.randrange(1, 9))): [rng.randrange(99)] * rng.randrange(1, 4) for _ in range(3000)}
    bpe.compile_transducer(words, str(tmp_path / "t.npy"))
    t = bpe.Transducer(str(tmp_path / "t.npy"))
    asked = [*words, b"zzz", b"", b"abcxabcxabcx", b"ab\0", b"a" * 99]
    assert [t.ids_of(n) if n >= 0 else None for n in t.numbers(asked).tolist()] == [words.get(w) for w in asked]
    assert len(t.final) < sum(map(len, words)) / 3  # endings are shared
    bpe.compile_transducer({}, str(tmp_path / "none.npy"))
    assert bpe.Transducer(str(tmp_path / "none.npy")).numbers([b"a"]).tolist() == [-1]


def test_neighbours(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = queries.neighbours_query(spark, "/root/testdata/sf0.1").collect()
    data = sorted((r["vec_id"], r["embedding"]) for r in rows.collect())
    ids, x = np.array([i for i, _ in data]), np.array([v for _, v in data], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    by = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by[r["query_id"]].append(r)
    hit = 0
    for q in ids[ids % 50 == 0].tolist():
        s = x @ x[np.searchsorted(ids, q)]
        s[np.searchsorted(ids, q)] = -9
        best = ids[np.lexsort((ids, -s))[:5]]
        hit += len({r["vec_id"] for r in by[q]} & set(best.tolist()))
        assert [r["rank"] for r in by[q]] == [1, 2, 3, 4, 5] and all(abs(s[np.searchsorted(ids, r["vec_id"])] - r["score"]) < 1e-12 for r in by[q])
    assert hit >= 0.9 * 5 * len(by)


def test_neighbours_hard_rows(spark):
    schema = "vec_id long, embedding array<float>, node long, code string"
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 3.0], 1, "c") for i in range(40, 160)] + [(50, [1.0, 2.0, 3.0], 1, "c")]
    rows += [(200, [1.0, 2.0, 2.9], 1, "c"), (300, [-1.0, 0.0, 0.5], 1, "c"), (0, None, 1, "c"), (350, [0.0] * 3, 1, "c"), (400, [nan, 1.0, 1.0], 1, "c"), (450, [inf, 1.0, 1.0], 1, "c")]
    rows += [(500, [1.0, None, 1.0], 1, "c"), (550, [], 1, "c"), (600, [1.0, 2.0], 1, "c"), (None, [1.0, 2.0, 3.0], 1, "c")]
    by = defaultdict(list)
    for r in sorted(neighbours.nearest(spark.createDataFrame(rows, schema), F.col("vec_id") % 50 == 0).collect(), key=lambda r: (r["query_id"], r["rank"])):
        by[r["query_id"]].append(r["vec_id"])
    assert by == {50: [40, 41, 42, 43, 44], 100: [40, 41, 42, 43, 44], 150: [40, 41, 42, 43, 44], 200: [40, 41, 42, 43, 44], 300: [40, 41, 42, 43, 44]}
    for few in ([], [(0, [1.0, 1.0, 0.0], 1, "c")], [(0, [1.0, 1.0, 0.0], 1, "c"), (7, [1.0, 0.0, 0.0], 1, "c")]):
        got = neighbours.nearest(spark.createDataFrame(few, schema), F.col("vec_id") % 50 == 0).collect()
        assert [(r["query_id"], r["vec_id"]) for r in got] == ([(0, 7)] if len(few) == 2 else [])


def test_neighbours_of_a_narrow_cluster(spark, monkeypatch):
    """A third of the rows in one cluster that planes don't part, dealt into many blocks as those of a large table are."""
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    monkeypatch.setattr(neighbours, "PARTINGS", 2)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3600, 64))
    x[::3] = 3.4 * rng.normal(size=64) + x[::3]
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    nodes, member_of = neighbours.vectors_of(spark.createDataFrame(rows, "vec_id long, v array<double>"), "vec_id", "v")
    node_of = {r["vec_id"]: r["node"] for r in member_of.collect()}
    blocks = {r["node"]: set(r["ids"]) for r in neighbours.build(nodes).select("node", "ids").collect()}
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = 0
    for q in range(0, 1200, 12):
        best = np.argsort(-(x @ x[q]))[1 : neighbours.DEGREE + 1]
        hit += len({node_of[i] for i in best.tolist()} & blocks[node_of[q]])
    assert hit >= 0.9 * 100 * neighbours.DEGREE


def test_chat_round_trip():
    rng = random.Random(9)
    bits = [*chat.CONTROLS, "\\", "[", "<", "/", "INST]", "SYS>>", "s>", "a", "\n", "é"]
    for _ in range(3000):
        turns = [(rng.choice(["user", "assistant", "system", "tool", "", "[SEP]"]), "".join(rng.choice(bits) for _ in range(rng.randrange(8)))) for _ in range(rng.randrange(5))]
        formatted, _ = chat.render(turns)
        assert [t[:2] for t in chat.parse(formatted)] == turns
        assert all(chat.unescape(formatted[s:e]) == text for _, text, s, e in chat.parse(formatted))
    assert chat.render([("user", "plain")]) == ("[INST]plain[/INST]", 0)
    assert chat.parse("x") is None and chat.parse("[INST]a") is None and chat.parse("<s>a[/INST]") is None


def test_chat_frames(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string, t string"
    rows = [(1, 2, "assistant", "b", "x", "y"), (1, 1, "user", None, "x", "y"), (1, None, None, "</s>", "x", "y"), (None, 1, "user", "q", "x", "y"), (1, 1, "user", None, "x", "y")]
    got = {r["conv_id"]: r for r in chat.format_chats(spark.createDataFrame(rows, schema)).collect()}
    assert [t[:2] for t in chat.parse(got[1]["formatted"])] == [("", "</s>"), ("user", ""), ("user", ""), ("assistant", "b")]
    assert got[1]["n_escaped"] == 1 and [got[1]["formatted"][s["start"] : s["end"]] for s in got[1]["loss_spans"]] == ["b"]
    assert got[None]["formatted"] == "[INST]q[/INST]"
    assert chat.format_chats(spark.createDataFrame([], schema)).count() == 0


def test_decontamination(spark, docs, hard, empty):
    schema = "item_id long, text string, doc_id long, w string"
    mine = [(1, "a b", 1, "w"), (2, "A", 1, "w"), (3, None, 1, "w"), (4, "", 1, "w"), (5, "a b", 1, "w"), (None, "c d", 1, "w"), (6, "word " * 20, 1, "w"), (7, "日本語 zz", 1, "w")]
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    for frame, bench in ((docs, items), (hard, spark.createDataFrame(mine, schema)), (docs, spark.createDataFrame([], schema)), (empty, items)):
        windows = defaultdict(set)
        for r in bench.collect():
            w = letters_of(r["text"])
            n = min(13, len(w))
            for i in range(len(w) - n + 1 if n else 0):
                windows[tuple(w[i : i + n])].add(r["item_id"])
        sizes, want = {len(w) for w in windows}, []
        for r in frame.collect():
            w = letters_of(r["text"])
            hit, held = set(), set()
            for n in sizes:
                for i in range(len(w) - n + 1):
                    if tuple(w[i : i + n]) in windows:
                        hit.update(range(i, i + n))
                        held |= windows[tuple(w[i : i + n])]
            want.append((str(r["doc_id"]), len(w), len(hit), sorted(str(x) for x in held if x is not None), len(hit) > 0 and 20 * len(hit) >= len(w)))
        got = [(str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in decontaminate.decontaminate(frame, bench).collect()]
        assert sorted(got) == sorted(want)


def test_toxicity(spark, hard, empty):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = queries.toxicity_query(spark, sf).where("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").collect()
    assert len(rows) > 500 and sum(r["predicted"] == r["toxic"] for r in rows) >= 0.985 * len(rows)  # some labels have no words to them
    bad, good = (sorted(r["score"] for r in rows if r["toxic"] == y) for y in (1, 0))
    assert sum(b > g for b in bad for g in good) >= 0.93 * len(bad) * len(good)
    none = toxicity.learn(empty, labels, F.lit(True))
    assert {r["score"] < 0.5 for r in toxicity.score_toxicity(hard, none).collect()} == {True}
    text = "Good. Idiot! and\nscum SCUM é moron"
    field = toxicity.learn(spark.read.parquet(f"{sf}/documents.parquet"), labels, F.lit(True))
    got = toxicity.score_toxicity(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"), field).orderBy("doc_id").collect()
    assert [text[s["start"] : s["end"]] for s in got[0]["spans"]] == ["Idiot", "scum SCUM", "moron"] and got[0]["score"] > 0.5 > got[1]["score"]
    assert toxicity.keep_clean(hard, field).columns == hard.columns and toxicity.keep_clean(empty, field).count() == 0


def test_marginals_against_all_paths():
    field, rng = toxicity.Field(), np.random.default_rng(3)
    field.steps = rng.normal(size=4)
    lengths = np.array([5, 3, 1])
    e = rng.normal(size=(5, 3))
    p, pairs = field.marginals(e, lengths), np.zeros(4)
    for k, n in enumerate(lengths):
        total, on = 0.0, np.zeros(n)
        moves = np.zeros(4)
        for path in range(1 << n):
            y = [(path >> t) & 1 for t in range(n)]
            steps = [y[t - 1] * 2 + y[t] for t in range(1, n)]
            start = [0.0, field.steps[1] - field.steps[0]][y[0]]
            w = math.exp(start + sum(e[t, k] for t in range(n) if y[t]) + sum(field.steps[s] for s in steps))
            total += w
            on += w * np.array(y)
            for s in steps:
                moves[s] += w
        assert np.allclose(p[:n, k], on / total)
        pairs += moves / total
    assert np.allclose(field.pair_marginals(e, lengths, p), pairs)


def test_licences(spark, docs, hard, empty):
    phrases = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
    for frame in (docs, hard, empty):
        got = sorted((str(r["doc_id"]), r["n_words"], sorted((m["label"], m["start"]) for m in r["matches"] if m["base"])) for r in licences.scan_licences(frame).collect())
        want = []
        for r in frame.collect():
            w = letters_of(r["text"])
            places = [(label, i) for label, p in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
            want.append((str(r["doc_id"]), len(w), sorted(places)))
        assert got == sorted(want)
    lines = {"apache-2.0": "Licensed under the Apache License, Version 2.0.", "cc-by-nc": "x Licensed under CC BY-NC 4.0.", "gpl-3.0": "This work is licensed under the GNU General Public License, version 3."}
    for label, line in lines.items():
        index = licences.Index(defaultdict(lambda: 1.0, {b"the": 0.1}))
        found = index.scan(licences.file_words("so it is " + line + " and on"))
        assert label in {licences.TEMPLATES[k][0] for k, _, _ in found} and all(0 <= s <= 1 for _, _, s in found)


def test_digests(spark):
    rows = queries.chat_query(spark, SF).where("conv_id = -7").collect()
    hard = "</s>[INST] ok [/INST]"
    assert rows[0]["turns_sha256"] == hashlib.sha256(f"user\n{hard}\nassistant\n{hard}\n".encode()).hexdigest()
    assert rows[0]["loss_sha256"] == hashlib.sha256(hard.encode()).hexdigest() and rows[0]["loss_chars"] == len(hard)


def test_every_code_point_like_the_library(tmp_path):
    """A letter, a code point and a letter; the code point and a digit; alone; for all code points but surrogates."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries.TOKENIZER)
    library = Tokenizer.from_file(path)
    library.no_padding()
    library.no_truncation()
    own = bpe.Tokenizer(path)
    bpe.compile_transducer({}, str(tmp_path / "empty.npy"))
    encoder = bpe.Encoder(own, bpe.Transducer(str(tmp_path / "empty.npy")))
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    wrong = []
    for at in range(0, len(points), 20_000):
        texts = [f"a{c}b {c}1 {c}" for c in points[at : at + 20_000]]
        want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
        wrong += [t for t, x, y in zip(texts, want, encoder.encode(texts), strict=True) if x != y.tolist()]
    assert wrong == []


def test_toxic_tags_of_long_texts_in_bounded_memory():
    """One text of a million words beside short ones takes memory for its own words only; marginals are as alone."""
    import tracemalloc

    field = toxicity.Field().fit(["you vile idiot", "vile idiot you", "idiot so vile", *["a calm sunny day", "the day was calm"] * 3], [1, 1, 1, 0, 0, 0, 0, 0, 0])
    rng = np.random.default_rng(1)
    emissions = [rng.normal(size=n) for n in [5] * 300 + [1_000_000] + [40] * 200]
    tracemalloc.start()
    found = field.tag(emissions)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500e6 and [len(p) for p in found] == [len(e) for e in emissions]
    for k in (0, 299, 301, 500):
        assert np.allclose(found[k], field.tag([emissions[k]])[0])


def test_words_merged_side_by_side():
    """All words of a random mix, short and long, with repeated letters and bytes beyond ASCII, as merged one by one."""
    own, rng = bpe.Tokenizer(public_tokenizers.path(queries.TOKENIZER)), random.Random(12)
    words = ["".join(rng.choice("aeioustrnlé日<|>1") for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    words += ["a", "aaaa", "a" * 39, "a" * 40, "a" * 41, "<|endoftext|>", "the", "thethethe"]
    assert own.merge_all(words) == [own.merge(w) for w in words]


def places_by_hand(words, templates):
    """Every start at which all phrases of a template stand, the first exactly and others within SLACK of their place, and
    the rarest words, which lie in the phrases, as well."""
    out = []
    for k, (_, line, phrases) in enumerate(templates):
        line = line.split()
        slack = licences.SLACK if len(phrases) > 1 else 0
        at = [next(i for i in range(len(line)) if line[i : i + len(p.split())] == p.split()) for p in phrases]
        for start in range(-len(line), len(words)):
            stands = lambda place, p: place >= 0 and words[place : place + len(p)] == p
            if stands(start + at[0], phrases[0].split()) and all(
                    any(stands(start + a + d, p.split()) for d in range(-slack, slack + 1)) for a, p in zip(at[1:], phrases[1:], strict=True)):
                out.append((k, start))
    return sorted(out)


@pytest.mark.parametrize("k", range(len(licences.TEMPLATES)))
def test_each_licence_template(k):
    """Whole, with a word more or less outside of its phrases, cut before its end, and with a phrase broken; repeated."""
    rng, (label, line, phrases) = random.Random(k), licences.TEMPLATES[k]
    weight = {w.encode(): 1 + rng.random() for _, x, _ in licences.TEMPLATES for w in x.split()}
    index = licences.Index(weight)
    line = line.split()
    noise = lambda n: [rng.choice(["alpha", "beta", "the", "license", "software", "of"]) for _ in range(n)]
    broken = list(line)
    broken[line.index(phrases[0].split()[0])] = "other"
    for words in (noise(9) + line + noise(7), line + noise(3) + line, noise(5) + ["so", *line[1:]] + noise(4), noise(3) + line[: len(line) // 2], noise(6) + broken + noise(6), line[:1] + noise(1) + line[1:]):
        got = sorted((t, start) for t, start, _ in index.scan([w.encode() for w in words]))
        assert got == places_by_hand(words, licences.TEMPLATES)
    whole = [m for m in index.scan([w.encode() for w in noise(4) + line]) if m[:2] == (k, 4)]
    assert whole and abs(whole[0][2] - 1) < 1e-9


def test_own_licence_templates(spark):
    own = (("house", "for use inside the house only", ("inside the house",)), ("yard", "not for the yard", ("the yard",)))
    rows = spark.createDataFrame([(1, "This is FOR USE inside the house only."), (2, "Not for the yard; the yard"), (3, None)], "doc_id long, text string")
    found = {r["doc_id"]: [(m["label"], m["start"], m["base"]) for m in r["matches"]] for r in licences.scan_licences(rows, own, 1).collect()}
    assert found == {1: [("house", 2, True)], 2: [("yard", 0, False), ("yard", 2, False)], 3: []}


def test_seeds_of_a_slice_are_dealt_in_little_memory():
    """A slice of 600,000 seeds, some common: below 110 bytes a seed (153 with places and numbers of eight bytes)."""
    rng = np.random.default_rng(5)
    found = [rng.integers(0, 1 << 63, 2000, dtype=np.uint64) for _ in range(300)]
    for x in found[:40]:
        x[:10] = np.arange(10)
    places = [np.arange(2000) for _ in found]
    tracemalloc.start()
    try:
        rows = [r for b in substring._deal(found, places, np.arange(300), np.zeros(300, np.int64), 6) for r in b.to_pylist()]
        assert tracemalloc.get_traced_memory()[1] < 110 * 600_000
    finally:
        tracemalloc.stop()
    sizes = {k: sum(len(r["body"]) for r in rows if r["kind"] == k) // substring._ENTRY.itemsize for k in (substring.SEEDS, substring.FOLLOWERS)}
    assert sizes == {substring.SEEDS: 600_000 - 240, substring.FOLLOWERS: 240}  # 24 of 40 holders of each of ten seeds


def test_fewest_passages_cover_the_same_words():
    rng = random.Random(13)
    for _ in range(300):
        found = [(a := rng.randrange(300), a + rng.randrange(50, 120), 0, 0, 1.0) for _ in range(rng.randrange(0, 25))]
        kept = substring._fewest(found)
        words = lambda x: set().union(*(range(p[0], p[1]) for p in x))
        assert words(kept) == words(found) and set(kept) <= set(found)
        assert all(words([q for q in kept if q is not p]) != words(found) for p in kept)


def test_links_to_further_holders(spark):
    """Document 3 covers all that 5 shares. 4 is as close to 5, but not to 3, and others hold its seeds before: 5 is linked
    to it all the same, which ties 4 to 3."""
    word = _random_words(31)
    whole = word(120)
    apart = lambda k: [word()[0] if i % 7 == k else w for i, w in enumerate(whole)]
    third, fourth = apart(3), apart(6)
    texts = [fourth[:40], fourth[40:80], fourth[80:], third, fourth, whole]
    rows = [(i, " ".join(word(40) + p + word(40))) for i, p in enumerate(texts)]
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["other_id"], r["class_id"]) for r in found} == {(5, 3, 3), (5, 4, 3)}


def test_near_copies_make_few_pairs(spark, monkeypatch):
    """Texts of one passage with other words in three places each, and copies of one of them, all in one class: the rows
    grow with the documents, not with their square."""
    word = _random_words(31)
    passage = word(70)
    vary = lambda: [*passage[:20], *word(1), *passage[21:41], *word(1), *passage[42:60], *word(1), *passage[61:]]
    one = vary()
    rows = [(i, " ".join(word(40) + p + word(40))) for i, p in enumerate([passage, *(vary() for _ in range(60)), *[one] * 30])]
    compared, pairs = substring.compared, []
    monkeypatch.setattr(substring, "compared", lambda p, c: pairs.append(p.count()) or compared(p, c))
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in found} == set(range(1, 91)) and {r["class_id"] for r in found} == {0}
    assert sum(pairs) < 300 and len(found) < 300


def test_settled_runs():
    equal = lambda *x: substring.settled(np.array([a for a, _ in x]), np.array([b - substring.SEED for _, b in x]))
    assert equal((3, 40), (5, 22), (3, 30), (60, 77), (70, 88)) == [(3, 40), (70, 88)]
    assert equal() == []


def test_tokenizer_is_not_made_by_the_driver(spark, monkeypatch):
    """Its tables took 120 MB of the driver's memory."""
    def fail(*_):
        raise AssertionError("made by the driver")

    monkeypatch.setattr(bpe.Tokenizer, "__init__", fail)
    docs = spark.createDataFrame([(1, "a word"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: len(r["ids"]) for r in bpe.encode_documents(docs, public_tokenizers.path(queries.TOKENIZER)).collect()}
    assert got[1] >= 2 and got[2] == 0


def test_tokenizer_is_opened_once_a_task():
    """It was asked for at every stretch of text; where the bytes came by another broadcast they were compared each time."""
    import pyarrow as pa

    class Counted:
        own, times = bpe.Tokenizer(public_tokenizers.path(queries.TOKENIZER)), 0

        @property
        def value(self):
            self.times += 1
            return self.own

    shared = Counted()
    texts = ["the cat's 12 hats", None, "THE Σ Ä<|endoftext|>the ẍ\ny the cat's"]
    found = {r["word"]: r["n"] for b in bpe._count_batches(shared)(iter([pa.record_batch([pa.array(texts)], ["text"])])) for r in b.to_pylist()}
    want = defaultdict(int)
    for x in texts:
        for w in shared.own.pieces(x):
            want[w] += 1
    assert shared.times == 1 and found == want


def test_ids_of_stretches_are_kept_and_forgotten(tmp_path, monkeypatch):
    """Texts given in several calls, with and without what is kept of the calls before."""
    own, rng = bpe.Tokenizer(public_tokenizers.path(queries.TOKENIZER)), random.Random(3)
    bpe.compile_transducer({w.encode(): own.merge(w) for w in ("the", "cat", "'s")}, str(tmp_path / "t.npy"))
    letters = ["a", "Z", "'s", "the", " ", "\n", "　", "̈", "é", "Σ", "9", "!!", "İ", "\0", "\x85", *own.special]
    texts = [None, "", *("".join(rng.choices(letters, k=rng.randrange(30))) for _ in range(600))]
    want = [[i for p in own.parts(t) for w in own.pieces(p) for i in own.merge(w)] for t in texts]
    for known in (10, 1 << 20):
        monkeypatch.setattr(bpe, "KNOWN", known)
        encoder = bpe.Encoder(own, bpe.Transducer(str(tmp_path / "t.npy")))
        calls = []
        monkeypatch.setattr(own, "merge_all", lambda words, calls=calls: calls.append(len(words)) or bpe.Tokenizer.merge_all(own, words))
        assert [x.tolist() for k in range(0, len(texts), 100) for x in encoder.encode(texts[k : k + 100])] == want
        before = sum(calls)
        assert [x.tolist() for x in encoder.encode(texts[:100])] == want[:100]
        assert (sum(calls) == before) == (known > 10)


def test_seeds_of_a_bucket_are_sorted_in_little_memory():
    """A bucket of 800,000 seeds, some shared and some common: below 40 bytes a seed (73 when all were sorted at once), and
    the rows and leaders of the shared ones by hand."""
    rng = np.random.default_rng(7)
    found = [rng.integers(1 << 30, 1 << 60, 2000, dtype=np.uint64) for _ in range(400)]
    for k, x in enumerate(found):
        x[:10] = np.arange(10, dtype=np.uint64) << np.uint64(56) | np.uint64(1 << 20)  # held by all
        x[10] = (np.uint64(k // 2) << np.uint64(50)) | np.uint64(1 << 21)  # by two
    hashes = [x.copy() for x in found]
    heads, bodies = [], []
    for a in range(0, 400, 10):  # a slice of ten texts
        for b in substring._deal(hashes[a : a + 10], [np.arange(2000) + 65_000 for _ in range(10)], np.arange(a, a + 10), np.zeros(10, np.int64), 4):
            for r in b.to_pylist():
                assert (r["kind"], r["bucket"]) == (substring.SEEDS, 0)
                heads.append(r["head"])
                bodies.append(r["body"])
    tracemalloc.start()
    try:
        rows = list(substring._bucket(0, heads, bodies, 4))
        assert tracemalloc.get_traced_memory()[1] < 40 * 800_000
    finally:
        tracemalloc.stop()
    got = set()
    for r in (r for b in rows for r in b.to_pylist() if r["kind"] == substring.TEXTS):
        texts, of, place, first, _ = substring._texts([r["head"]], [r["body"]])
        got |= set(zip(texts[of, 0].tolist(), place.tolist(), first.tolist(), strict=True))
    assert got == {(k, 65_000 + j, 0) for k in range(400) for j in range(10)} | {(k, 65_010, k // 2 * 2) for k in range(400)}
    leaders = [np.frombuffer(r["body"], substring._LEADER) for b in rows for r in b.to_pylist() if r["kind"] == substring.LEADERS]
    assert len(leaders) == 1 and len(leaders[0]) == 10 and (np.diff(leaders[0]["hash"].astype(object)) > 0).all() and not leaders[0]["doc"].any()


def test_passage_that_the_first_text_repeats(spark):
    """A text with HOT entries of each seed of a passage doesn't hide the text after it, whose entries are all followers."""
    word = _random_words(41)
    passage = word(60)
    rows = [(1, " ".join(w for _ in range(20) for w in [*passage, *word(8)])), (2, " ".join(word(30) + passage + word(30)))]
    assert len(rows[0][1].split()) // 68 > substring.HOT
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert {(r["doc_id"], r["other_id"], r["class_id"]) for r in found} == {(2, 1, 1)}


def test_seeds_of_one_text_only_have_no_leaders():
    """Of seeds that a text repeats, the bucket gets HOT entries and that of a second text, if there is one."""
    own, both = np.full(40, 5, np.uint64), np.full(40, 7 << 32, np.uint64)
    found = [np.concatenate([own, both]), both[:3].copy()]
    rows = [r for b in substring._deal(found, [np.arange(80), np.arange(3)], np.array([1, 2]), np.zeros(2, np.int64), 4) for r in b.to_pylist()]
    sizes = {k: sum(len(r["body"]) for r in rows if r["kind"] == k) // substring._ENTRY.itemsize for k in (substring.SEEDS, substring.FOLLOWERS)}
    assert sizes == {substring.SEEDS: 2 * substring.HOT + 1, substring.FOLLOWERS: 24 + 26}
    dealt = [r for r in rows if r["kind"] == substring.SEEDS]
    made = [r for b in substring._bucket(0, [r["head"] for r in dealt], [r["body"] for r in dealt], 4) for r in b.to_pylist()]
    leaders = [np.frombuffer(r["body"], substring._LEADER) for r in made if r["kind"] == substring.LEADERS]
    assert [x["doc"].tolist() for x in leaders] == [[1]]


def test_components_keep_no_estimated_sizes(spark):
    """The estimated size of what the rounds have cut doubled its digits with every join of the loop, until it filled the
    driver's heap."""
    nodes = list(range(1000))
    random.Random(3).shuffle(nodes)
    links = [*zip(nodes, nodes[1:], strict=False), *((5000 + i, 4999) for i in range(50))]
    roots = common.components(spark.createDataFrame(links, "a long, b long"))
    assert sorted(map(tuple, roots.groupBy("root").count().collect())) == [(0, 1000), (4999, 51)]
    assert roots._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 1 << 64

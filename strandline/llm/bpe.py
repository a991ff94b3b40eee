"""BPE encoding with a minimal acyclic transducer of frequent words; words it lacks are merged exactly."""

from __future__ import annotations

import hashlib
import heapq
import io
import itertools
import json
import os
import pickle
import re
import sys
import tempfile
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, lru_cache
from typing import IO

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast, SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from strandline.llm.common import slices

#: Words in the transducer, and bytes of the longest.
FREQUENT, LONGEST = 1 << 16, 48
#: Stretches between blanks whose ids a task keeps.
KNOWN = 250_000
#: Symbols of a word up to which all pairs are looked at for each merge, and up to which words are merged side by side.
SHORT, SIDE_BY_SIDE = 24, 40
_NEVER = 1 << 60
_SPACE = r"\t-\r \x85\xa0  -     　"
_word = re.compile(rf"[^{_SPACE}]+")
_ASCII = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+"
_ascii_pieces, _ascii_lines = re.compile(_ASCII).findall, re.compile(_ASCII + r"|\n").findall


def _points() -> str:
    return "".join(map(chr, (*range(0xD800), *range(0xE000, sys.maxunicode + 1))))


def members(prop: str) -> str:
    """The code points of a Unicode property, as the inside of a character class. The library's tables decide, which are
    of another version than those of unicodedata and regex."""
    found = pre_tokenizers.Split(Regex(rf"\p{{{prop}}}+"), behavior="removed", invert=True).pre_tokenize_str(_points())
    out = []
    for run, _ in found:
        cut = run.find("\ue000") if run[0] < "\ud800" and "\ue000" in run else len(run)  # no surrogates in between
        out += [f"\\U{ord(x[0]):08x}-\\U{ord(x[-1]):08x}" for x in (run[:cut], run[cut:]) if x]
    return "".join(out)


def lower_cased() -> dict[int, str]:
    """Code points whose lower case in the library is another than in Python."""
    points = _points().replace("\n", "")
    lower = normalizers.Lowercase().normalize_str("\n".join(points)).split("\n")
    return {ord("Σ"): "σ"} | {ord(c): x for c, x in zip(points, lower, strict=True) if c.lower() != x}


def byte_letters() -> list[str]:
    """The public byte-level alphabet: printable Latin-1 stands for itself, other bytes for letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Tokenizer:
    """Vocabulary, merges and special strings of a BPE file with word ends."""

    def __init__(self, file: str | IO[bytes]) -> None:
        with open(file, "rb") if isinstance(file, str) else file as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocabulary.items()} | {i: t for t, i in self.special.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        v = self.vocabulary
        self.merges = {(v[a], v[b]): (rank, v[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.ranked = {p: rank << 32 | new for p, (rank, new) in self.merges.items()}
        alphabet = byte_letters()
        self.inner, self.last = [v.get(c) for c in alphabet], [v.get(c + self.end) for c in alphabet]
        letters, numbers, self.lower = members("L"), members("N"), lower_cased()
        self._pieces = rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{_SPACE}{letters}{numbers}]+"
        self._splits = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def pieces(self, text: str | None) -> list[str]:
        """Special strings and the words between them, normalised."""
        if not text:
            return []
        if text.isalpha() and text.isascii():
            return [text.lower()]
        if not any(x in text for x in self.special):
            return self._words(text)
        out, at = [], 0
        for m in self._splits.finditer(text):
            out += self._words(text[at : m.start()])
            out.append(m[0])
            at = m.end()
        return out + self._words(text[at:]) if at else self._words(text)

    def _words(self, text: str, lines: bool = False) -> list[str]:
        if text.isascii():
            return (_ascii_lines if lines else _ascii_pieces)(text.lower())
        text = unicodedata.normalize("NFC", text)
        if self._odd(text):
            text = text.translate(self.lower)  # by letter, not by word
        return (self._find_lines if lines else self._find)(text.lower())

    def pieces_of(self, parts: list[str]) -> tuple[np.ndarray, list[str]]:
        """pieces() of many parts(), as the order in which they are taken and their words, with a line end after each part.
        Parts without special strings have no blanks in them and are split as the lines of one text."""
        ascii_, other, alone = [], [], []
        if self.apart:
            for i, x in enumerate(parts):
                (ascii_ if x.isascii() else other).append(i)
        else:
            alone = list(range(len(parts)))
        out = []
        for some in (ascii_, other):
            text = "\n".join([parts[i] for i in some])
            if any(x in text for x in self.special):
                alone += [i for i in some if any(x in parts[i] for x in self.special)]
                some[:] = [i for i in some if not any(x in parts[i] for x in self.special)]
                text = "\n".join([parts[i] for i in some])
            if some:
                out += self._words(text + "\n", lines=True)
        for i in alone:
            out += [*self.pieces(parts[i]), "\n"]
        return np.array(ascii_ + other + alone, np.int64), out

    @cached_property
    def _find(self):
        return re.compile(self._pieces).findall

    @cached_property
    def _find_lines(self):
        return re.compile(self._pieces + r"|\n").findall

    @cached_property
    def _odd(self):
        return re.compile(f"[{''.join(map(chr, self.lower))}]").search

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_find", "_find_lines", "_odd", "_arrays")}

    @cached_property
    def apart(self) -> bool:
        """Whether no special string holds a blank, so that texts may be parted at blanks first."""
        return not any(re.search(f"[{_SPACE}]", x) for x in self.special)

    def parts(self, text: str | None) -> list[str]:
        """Stretches of the text that pieces() may be given one by one."""
        return _word.findall(text or "") if self.apart else [text] if text else []

    def merge(self, word: str) -> list[int]:
        """Ids of a word: always the pair of least rank next, the leftmost first."""
        if word in self.special:
            return [self.special[word]]
        raw = word.encode("utf-8", "replace")
        ids = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        ids = [i for i in ids if i is not None]
        if len(ids) <= SHORT:
            return self._merge_short(ids)
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*self.merges[p], k, p) for k, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.merges]
        heap = [(rank, k, new, p) for rank, new, k, p in heap]
        heapq.heapify(heap)
        while heap:
            _, k, new, pair = heapq.heappop(heap)
            right = after[k]
            if ids[k] != pair[0] or right >= n or ids[right] != pair[1]:
                continue
            ids[k], ids[right] = new, None
            after[k] = after[right]
            if after[k] < n:
                before[after[k]] = k
            for left in (before[k], k):
                if left >= 0 and after[left] < n:
                    p = (ids[left], ids[after[left]])
                    if p in self.merges:
                        rank, made = self.merges[p]
                        heapq.heappush(heap, (rank, left, made, p))
        return [i for i in ids if i is not None]


    @cached_property
    def _arrays(self) -> tuple[np.ndarray, ...]:
        """Sorted keys of the pairs with their ranks, the token of each rank, and the tokens of inner and last bytes."""
        keys = np.array([a * len(self.tokens) + b for a, b in self.merges], np.int64)
        ranks = np.arange(len(keys))
        order = np.argsort(keys)
        made = np.array([new for _, new in self.merges.values()], np.int64)
        return keys[order], ranks[order], made, *(np.array([-1 if x is None else x for x in y], np.int64) for y in (self.inner, self.last))

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys, ranks = self._arrays[:2]
        key = left * len(self.tokens) + right
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where((keys[at] == key) & (left >= 0) & (right >= 0), ranks[at], _NEVER)

    def merge_all(self, words: list[str]) -> list[list[int]]:
        """merge() of many words: those of like length go through their merges side by side, one merge a step."""
        out: list[list[int] | None] = [None] * len(words)
        raw = [w.encode("utf-8", "replace") for w in words]
        alike: dict[int, list[int]] = {}
        for i, w in enumerate(raw):
            if 1 < len(w) <= SIDE_BY_SIDE and self.merges and words[i] not in self.special:
                alike.setdefault(len(w), []).append(i)
            else:
                out[i] = self.merge(words[i])
        _, _, made, inner, last = self._arrays
        for length, some in alike.items():
            letters = np.frombuffer(b"".join([raw[i] for i in some]), np.uint8).reshape(len(some), length)
            ids = inner[letters]
            ids[:, -1] = last[letters[:, -1]]
            who, columns = np.array(some), np.arange(length)
            for i in who[(ids < 0).any(1)].tolist():  # a byte without a token
                out[i] = self.merge(words[i])
            who, ids = who[(ids >= 0).all(1)], ids[(ids >= 0).all(1)]
            rank = np.full(ids.shape, _NEVER)
            rank[:, :-1] = self._ranks(ids[:, :-1], ids[:, 1:])
            while len(who):
                k = rank.argmin(1)  # of equal ranks the leftmost
                rows = np.arange(len(who))
                least = rank[rows, k]
                done = least == _NEVER
                for i, row in zip(who[done].tolist(), ids[done].tolist(), strict=True):
                    out[i] = [x for x in row if x >= 0]
                who, ids, rank, k, least = (x[~done] for x in (who, ids, rank, k, least))
                rows = np.arange(len(who))
                right = np.minimum(columns + (columns > k[:, None]), length - 1)
                ids[rows, k] = made[least]
                ids, rank = np.take_along_axis(ids, right, 1), np.take_along_axis(rank, np.minimum(columns + (columns >= k[:, None]), length - 1), 1)
                ids[:, -1], rank[:, -1] = -1, _NEVER  # one symbol fewer
                rank[rows, k] = self._ranks(ids[rows, k], ids[rows, np.minimum(k + 1, length - 1)])
                some_left = np.flatnonzero(k > 0)
                rank[some_left, k[some_left] - 1] = self._ranks(ids[some_left, k[some_left] - 1], ids[some_left, k[some_left]])
        return out

    def _merge_short(self, ids: list[int]) -> list[int]:
        """The same by looking at all pairs again after each merge, which takes less time while they are few."""
        ranked, never = self.ranked.get, 1 << 62
        while len(ids) > 1:
            ranks = [ranked(p, never) for p in zip(ids, ids[1:], strict=False)]
            least = min(ranks)
            if least == never:
                break
            k = ranks.index(least)
            ids[k : k + 2] = [least & 0xFFFFFFFF]
        return ids


def compile_transducer(words: dict[bytes, list[int]], path: str) -> None:
    """Writes the minimal automaton of the words, built in sorted order: states with the same endings are one. Each arc
    carries how many words come before what it leads to; along a word they add up to its number, which finds its ids.

    File: an int64 array of lengths, arc keys (state * 256 + byte), targets, arc outputs, final flags, id offsets, ids."""
    root: dict = {"arcs": {}, "final": False}
    register: dict[tuple, int] = {}
    states: list[tuple[bool, list[tuple[int, int]], int]] = []

    def settle(node: dict) -> int:
        arcs = [(b, t) for b, t in node["arcs"].items()]
        key = (node["final"], tuple(arcs))
        if key not in register:
            register[key] = len(states)
            states.append((node["final"], arcs, node["final"] + sum(states[t][2] for _, t in arcs)))
        return register[key]

    path_nodes, last = [root], b""
    for word in [*sorted(words), None]:
        same = 0 if word is None else len(os.path.commonprefix([last, word]))
        while len(path_nodes) - 1 > same:
            done = path_nodes.pop()
            path_nodes[-1]["arcs"][last[len(path_nodes) - 1]] = settle(done)
        for b in word[same:] if word is not None else b"":
            path_nodes[-1]["arcs"][b] = None
            path_nodes.append({"arcs": {}, "final": False})
        if word is not None:
            path_nodes[-1]["final"] = True
            last = word
    start = settle(root)
    keys, targets, outputs = [], [], []
    for s, (final, arcs, _) in enumerate(states):
        n = int(final)
        for b, t in arcs:
            keys.append(s * 256 + b)
            targets.append(t)
            outputs.append(n)
            n += states[t][2]
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    ids = [words[w] for w in sorted(words)]
    parts = [
        *(np.array(x, np.int64)[order] for x in (keys, targets, outputs)), np.array([f for f, _, _ in states], np.int64),
        np.cumsum([0, *map(len, ids)]), np.array([i for x in ids for i in x], np.int64),
    ]
    np.save(path, np.concatenate([[start], [len(p) for p in parts], *parts]).astype(np.int64))


class Transducer:
    """A compiled file, memory-mapped."""

    def __init__(self, path: str) -> None:
        whole = np.asarray(np.load(path, mmap_mode="r"))  # the mapped pages, without a check at every access
        self.start, at = int(whole[0]), 7
        parts = []
        for n in whole[1:7].tolist():
            parts.append(whole[at : at + n])
            at += n
        self.keys, self.targets, self.outputs, self.final, self.offsets, self.ids = parts

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, or -1; all walk together, byte by byte."""
        out = np.full(len(words), -1, np.int64)
        if not len(self.keys):
            return out
        fit = np.array([i for i, w in enumerate(words) if 0 < len(w) <= LONGEST and 0 not in w], np.int64)
        if not len(fit):
            return out
        letters = np.array([words[i] for i in fit], dtype="S")
        width = letters.dtype.itemsize
        letters = letters.view(np.uint8).reshape(len(fit), width)
        lengths = np.fromiter((len(words[i]) for i in fit), np.int64, len(fit))
        state, number, alive = np.full(len(fit), self.start), np.zeros(len(fit), np.int64), np.arange(len(fit))
        for t in range(width):
            alive = alive[lengths[alive] > t]
            key = state[alive] * 256 + letters[alive, t]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            state[alive[~hit]] = -1
            alive, arc = alive[hit], arc[hit]
            state[alive], number[alive] = self.targets[arc], number[alive] + self.outputs[arc]
        ends = (state >= 0) & (self.final[np.maximum(state, 0)] == 1)
        out[fit[ends]] = number[ends]
        return out

    def ids_of(self, number: int) -> list[int]:
        return self.ids[self.offsets[number] : self.offsets[number + 1]].tolist()

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words of these numbers, one after the other, and how many each has."""
        start, n = self.offsets[numbers], self.offsets[numbers + 1] - self.offsets[numbers]
        return self.ids[_gathered(start, n)], n


def _gathered(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1, .. n places each, one after the other."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class Numbers(dict):
    """Each key's number, in order of first use."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


def _flattened(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The lists one after the other, and the length of each."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


class Encoder:
    """Encodes texts; what stretches between blanks became is kept for the texts to come, up to about KNOWN of them."""

    def __init__(self, tokenizer: Tokenizer, transducer: Transducer) -> None:
        self.tokenizer, self.transducer = tokenizer, transducer
        self._forget()

    def _forget(self) -> None:
        self.parts, self.table, self.sizes = Numbers(), np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and how many each has; words that the transducer lacks are merged."""
        numbers = self.transducer.numbers([w.encode("utf-8", "replace") for w in words])
        known, other = np.flatnonzero(numbers >= 0), np.flatnonzero(numbers < 0)
        merged = self.tokenizer.merge_all([words[i] for i in other.tolist()])
        n = np.zeros(len(words), np.int64)
        found, n[known] = self.transducer.gather(numbers[known])
        n[other] = [len(x) for x in merged]
        start, out = np.cumsum(n) - n, np.zeros(int(n.sum()), np.int32)
        out[_gathered(start[known], n[known])] = found
        out[_gathered(start[other], n[other])] = [i for x in merged for i in x]
        return out, n

    @staticmethod
    def _spread(table: np.ndarray, n: np.ndarray, flat: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries of a table (n of each key) for the keys `flat`, and how many each group of keys (so many keys) gets."""
        each = n[flat]
        ends = np.concatenate([[0], np.cumsum(each)])
        bounds = np.concatenate([[0], np.cumsum(groups)])
        return table[_gathered((np.cumsum(n) - n)[flat], each)], ends[bounds[1:]] - ends[bounds[:-1]]

    def _learn(self) -> None:
        """Ids of the parts that are new: distinct parts are split into words, distinct words are looked up, all together."""
        new = list(itertools.islice(self.parts, len(self.sizes), None))
        order, found = self.tokenizer.pieces_of(new)
        words = {w: k for k, w in enumerate(dict.fromkeys(["\n", *found]))}  # the line end is word 0
        flat = np.fromiter(map(words.__getitem__, found), np.int64, len(found))
        del words["\n"]
        groups = np.diff(np.flatnonzero(flat == 0), prepend=-1) - 1
        ids, n = self._spread(*self._ids(list(words)), flat[flat > 0] - 1, groups)
        back = np.argsort(order)
        ids = ids[_gathered((np.cumsum(n) - n)[back], n[back])]
        self.table, self.sizes = np.concatenate([self.table, ids]), np.concatenate([self.sizes, n[back]])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text: of its stretches between blanks, put back in place."""
        if len(self.parts) > KNOWN:
            self._forget()
        by_text = [list(map(self.parts.__getitem__, self.tokenizer.parts(t))) for t in texts]
        self._learn()
        table, n = self._spread(self.table, self.sizes, *_flattened(by_text))
        return np.split(table, np.cumsum(n)[:-1]) if len(texts) else []

    def decode(self, ids: np.ndarray) -> str:
        """As a tokenizer without a decoder does: tokens with blanks between."""
        return " ".join(map(self.tokenizer.tokens.__getitem__, ids.tolist()))


def _count_batches(tokenizer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        own = tokenizer.value  # once a task: another broadcast of the same bytes is compared byte by byte

        def flush() -> pa.RecordBatch:
            alike: dict[int, list[str]] = {}  # parts by how often they are there
            for part, n in seen.items():
                alike.setdefault(n, []).append(part)
            words: Counter = Counter()
            for n, parts in alike.items():
                for word, k in Counter(own.pieces_of(parts)[1]).items():
                    words[word] += n * k
            del words["\n"]
            seen.clear()
            return pa.record_batch([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                seen.update(own.parts(text.as_py()))
                if len(seen) > 250_000:
                    yield flush()
        yield flush()

    return run


def frequent_words(docs: DataFrame, tokenizer, limit: int = FREQUENT, text: str = "text") -> DataFrame:
    """The `limit` most frequent words of all documents, ties by the word."""
    counts = docs.select(F.col(text)).mapInArrow(_count_batches(tokenizer), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.octet_length("word") <= LONGEST).orderBy(F.desc("n"), "word").limit(limit).select("word")


def _compile_batches(tokenizer):
    """One task compiles the transducer of the bounded word list into the bytes of its file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer.value
        common = [w for b in batches for w in b.column(0).to_pylist() if w is not None and w not in own.special and "\0" not in w]
        with tempfile.TemporaryDirectory() as folder:
            made = os.path.join(folder, "lexicon.npy")
            compile_transducer({w.encode("utf-8", "replace"): own.merge(w) for w in common}, made)
            with open(made, "rb") as f:
                yield pa.record_batch([pa.array([f.read()], pa.binary())], ["file"])

    return run


@lru_cache(maxsize=2)
def _opened(pickled: bytes) -> Tokenizer:
    return pickle.loads(pickled)


class Shared:
    """A tokenizer as a broadcast of its bytes, which a worker opens once."""

    def __init__(self, pickled: Broadcast) -> None:
        self.pickled = pickled

    @property
    def value(self) -> Tokenizer:
        return _opened(self.pickled.value)


def shared_tokenizer(spark: SparkSession, path: str) -> Shared:
    """The tokenizer of a file, made by one task: its tables of code points and merges take ten times the memory of the
    bytes that the driver gets."""
    with open(path, "rb") as f:
        file = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            yield pa.record_batch([pa.array([pickle.dumps(Tokenizer(io.BytesIO(file.value)))], pa.binary())], ["made"])

    made = spark.range(1).repartition(1).mapInArrow(run, "made binary").first()["made"]
    file.unpersist()
    return Shared(spark.sparkContext.broadcast(bytes(made)))


_OUT = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.large_string())])


def encode_documents(docs: DataFrame, path: str, limit: int = FREQUENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document row its token ids, special strings in texts included, and the text decoded from them.

    Null or empty text: no ids and an empty text. Rows are encoded one by one, so repeated rows and ties need no care;
    other columns are ignored. The words counted over all documents only decide which take the fast way.
    Columns: doc_id, ids, decoded."""
    spark = docs.sparkSession
    tokenizer = shared_tokenizer(spark, path)
    words = frequent_words(docs, tokenizer, limit, text).union(spark.range(1).select(F.lit(None).cast("string")))  # one row at least
    compiled = bytes(words.repartition(1).mapInArrow(_compile_batches(tokenizer), "file binary").first()["file"])  # a few MB
    folder = os.path.join(SparkFiles.getRootDirectory(), f"made-{uuid.uuid4().hex}")  # Spark's own, which ends with it
    os.makedirs(folder)
    name = f"lexicon-{hashlib.sha256(compiled).hexdigest()[:24]}-{uuid.uuid4().hex}.npy"
    with open(os.path.join(folder, name), "wb") as f:
        f.write(compiled)
    spark.sparkContext.addFile(os.path.join(folder, name))  # every executor fetches its copy and maps it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer.value, Transducer(SparkFiles.get(name)))
        for batch in batches:
            for part in slices(batch, 1, 2_000_000):
                ids = encoder.encode(part.column(1).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
                yield pa.record_batch([part.column(0), lists, pa.array([encoder.decode(x) for x in ids], pa.large_string())], schema=_OUT)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, ids array<int>, decoded string")

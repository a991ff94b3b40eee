"""Licence scan by a positional index of rare words."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import WORD_BYTES

Template = tuple[str, str, tuple[str, ...]]
#: Label, line of words, phrases of it that must stand in full. The first three are the base phrases; the
#: last ones are the words of the public notices that projects put at the head of files or into their licence file.
TEMPLATES = (
    ("cc-by", "cc by", ("cc by",)),
    ("gpl", "general public license", ("general public license",)),
    ("reserved", "all rights reserved", ("all rights reserved",)),
    ("agpl-3.0", "gnu affero general public license version 3", ("affero general public license", "version 3")),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use", "source and binary forms")),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", ("permission is hereby granted", "free of charge")),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license", "2 0")),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a "
     "copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the "
     "license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language "
     "governing permissions and limitations under the license", ("you may not use this file except in compliance with the license", "limitations under the license")),
    ("bsd-2-clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
     "1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form "
     "must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the "
     "distribution", ("redistributions of source code must retain the above copyright notice", "materials provided with the distribution")),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
     "without specific prior written permission", ("may be used to endorse or promote products derived from this software", "without specific prior written permission")),
    ("cc0-1.0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
     ("waived all copyright and related or neighboring rights",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software "
     "foundation either version 2 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any "
     "warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
     ("gnu general public license as published by the free software foundation", "or fitness for a particular purpose")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice "
     "and this permission notice appear in all copies", ("for any purpose with or without fee is hereby granted", "this permission notice appear in all copies")),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free "
     "software foundation", ("gnu lesser general public license as published by the free software foundation",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the "
     "software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and "
     "to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be "
     "included in all copies or substantial portions of the software", ("to any person obtaining a copy of this software", "included in all copies or substantial portions of the software")),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain "
     "one at http mozilla org mpl 2 0", ("this source code form is subject to the terms of the mozilla public license", "http mozilla org mpl 2 0")),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this "
     "software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
     ("free and unencumbered software released into the public domain", "commercial or non commercial and by any means")),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of "
     "this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely",
     ("in no event will the authors be held liable for any damages", "to alter it and redistribute it freely")),
)
BASE = 3
#: Words looked up of each template, and words by which a phrase may stand off its place in the template.
RAREST, SLACK = 3, 2


def file_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES).split()


def _count_batches(vocabulary: frozenset[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = Counter(), 0
        for batch in batches:
            for text in batch.column(0):
                seen.update(vocabulary.intersection(file_words(text.as_py())))
                n += 1
        yield pa.record_batch([pa.array([*(w.decode() for w in seen), None], pa.string()), pa.array([*seen.values(), n], pa.int64())], ["word", "n"])

    return run


def idf(docs: DataFrame, vocabulary: frozenset[bytes], text: str = "text") -> dict[bytes, float]:
    """Inverse document frequency over all documents, for the words of the templates only."""
    counts = docs.select(F.col(text)).mapInArrow(_count_batches(vocabulary), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    seen = {r["word"]: r["n"] for r in counts}
    n = seen.pop(None, 0)
    return {w: math.log((1 + n) / (1 + seen.get(w.decode(), 0))) + 1e-9 for w in vocabulary}


class Index:
    """Postings of the rarest words: word -> (template, its place there)."""

    def __init__(self, weight: dict[bytes, float], templates: Sequence[Template] = TEMPLATES):
        self.weight, self.templates = weight, []
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for k, (label, line, phrases) in enumerate(templates):
            words = line.encode().split()
            spans = []
            for phrase in phrases:
                p = phrase.encode().split()
                spans.append((next(i for i in range(len(words)) if words[i : i + len(p)] == p), p))
            must = {w for _, p in spans for w in p}
            rare = sorted(must, key=lambda w: (-weight[w], w))[:RAREST]
            self.templates.append((label, words, spans, len(rare)))
            for i, w in enumerate(words):
                if w in rare:
                    self.postings.setdefault(w, []).append((k, i))

    def scan(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, start, score): each place where a template's rare words meet at one relative position, within SLACK,
        and its phrases stand in full. Score: the share of the line's IDF found within SLACK of its place."""
        places: dict[bytes, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.postings:
                places.setdefault(w, []).append(i)
        starts: dict[tuple[int, int], set[bytes]] = {}
        for w in sorted(places, key=lambda w: (-self.weight[w], w)):
            for k, at in self.postings[w]:
                slack = SLACK if len(self.templates[k][2]) > 1 else 0
                for i in places[w]:
                    for start in range(i - at - slack, i - at + slack + 1):
                        starts.setdefault((k, start), set()).add(w)
        found = []
        for (k, start), met in starts.items():
            _, line, spans, needed = self.templates[k]
            if len(met) < needed:
                continue
            slack = SLACK if len(spans) > 1 else 0
            first_at = start + spans[0][0]  # the first phrase stands exactly; others may be off by SLACK
            if first_at < 0 or words[first_at : first_at + len(spans[0][1])] != spans[0][1]:
                continue
            if all(any(start + at + d >= 0 and words[start + at + d : start + at + d + len(p)] == p for d in range(-slack, slack + 1)) for at, p in spans[1:]):
                total = sum(self.weight[w] for w in line)
                here = sum(self.weight[w] for j, w in enumerate(line) if w in words[max(0, start + j - slack) : max(0, start + j + slack + 1)])
                found.append((k, start, here / total if total else 1.0))
        return sorted(found)


_SCHEMA = "doc_id long, n_words long, matches array<struct<label:string,start:long,base:boolean,score:double>>"
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("matches", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())])))])


def _scan_batches(weight: dict[bytes, float], templates: Sequence[Template], base: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(weight, templates)
        for batch in batches:
            n_words, matches = [], []
            for text in batch.column(1):
                words = file_words(text.as_py())
                n_words.append(len(words))
                matches.append([{"label": templates[k][0], "start": start, "base": k < base, "score": score} for k, start, score in index.scan(words)])
            yield pa.record_batch([batch.column(0), pa.array(n_words, pa.int64()), pa.array(matches, _OUT.field(2).type)], schema=_OUT)

    return run


def scan_licences(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, base: int = BASE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document row: its number of words and every place of every template. Of `templates` (label, words of the text
    in lower case, phrases of it that must stand in full) the first `base` are marked as such.

    Null or empty text: no words, no matches. Rows are scanned one by one, so nulls, repeated rows and long texts need
    no care; other columns are ignored. A template line that lacks a mandatory phrase isn't a match.
    Columns: doc_id, n_words, matches (label, start word, base, score)."""
    vocabulary = frozenset(w for _, line, _ in templates for w in line.encode().split())
    weight = idf(docs, vocabulary, text)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_scan_batches(weight, templates, base), _SCHEMA)

"""License scans (operator 5): an exact set-similarity join of text blocks with license templates.

Blocks are lines, as sets of words. A block meets a template at |template and block| / |template| >= THRESHOLD. Template words are
put into one global order, by the number of documents of the whole table that hold them, rarest first. With `need` the overlap
that the threshold asks for, a block can only meet a template if
  prefix:     one of the template's first |template| - need + 1 words is in the block's first |block| - need + 1,
  length:     the block has at least `need` template words,
  position:   from their first common word on, both still have words for `need` in common.
What passes all three is counted exactly. Words that are in no template cannot overlap and are left out of a block's order. The
templates and the order of their words are bounded by the templates alone, so they are sent to all workers; texts are read twice,
once for the order, and never shuffled.

Blocks that cross line ends: hard-wrapped notices are met as windows of as many words as the template has, over the whole text. A
text must have `need` of a template's words at all before its windows are counted. Overlapping windows that meet a template and hold
words of it on two lines or more are one block, with their best containment and that window's first line.

Labels: all blocks that meet a template are found, but several licenses share most of their words. A block names a license (`named`) if
it holds the template's naming words, and no other template whose naming words it holds is met better by a block that shares a line with
it (more of its words, then a longer one).

Phrases: three fixed phrases are found wherever their words stand consecutively, over line ends too.

Defined results: null texts are empty and hold nothing; very long texts and lines are read whole; a template that several blocks
meet gives one entry each; repeated rows give equal rows; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sagaframe.session import prepare, spread

THRESHOLD = 0.8

# The phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Label, the words that name the license, and the wording of public licenses and of notices that name them.
TEMPLATES = (
    ("apache-2.0", "apache", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "compliance", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2.0", "warranties conditions", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("mit", "mit", "Released under the MIT License"),
    ("mit", "mit", "Licensed under the MIT License"),
    ("mit", "permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "sublicense", "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("isc", "permission", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("gpl-3.0", "gnu 3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "gnu 2", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl", "gnu redistribute", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("gpl", "gnu received", "You should have received a copy of the GNU General Public License along with this program."),
    ("lgpl", "lesser", "licensed under the GNU Lesser General Public License"),
    ("agpl", "affero", "licensed under the GNU Affero General Public License"),
    ("bsd", "redistribution", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", "redistributions binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("boost-1.0", "boost", "Distributed under the Boost Software License, Version 1.0."),
    ("zlib", "misrepresented", "The origin of this software must not be misrepresented; you must not claim that you wrote the original software."),
    ("unlicense", "unencumbered", "This is free and unencumbered software released into the public domain."),
    ("cc-by-nc-4.0", "nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "cc by 4", "Licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "creative attribution", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-4.0", "creative sharealike", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc-4.0", "creative noncommercial", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc0", "cc0", "dedicated to the public domain under CC0"),
    ("mpl-2.0", "mozilla", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("epl-2.0", "eclipse", "made available under the terms of the Eclipse Public License 2.0"),
)

_WORD_BYTES = bytes(
    0x0A if b == 0x0A else b + 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def normal(text: str | None) -> bytes:
    """UTF-8 with A-Z in lower case and a space for every other ASCII sign but line ends."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES)


class Templates:
    """Templates under a global order of their words."""

    def __init__(self, templates=TEMPLATES, threshold: float = THRESHOLD, frequency: dict[bytes, int] | None = None) -> None:
        sets = [(label, frozenset(normal(text).split())) for label, _, text in templates]
        self.naming = [frozenset(normal(names).split()) for _, names, _ in templates]
        self.universe = frozenset().union(*(s for _, s in sets))
        frequency = frequency or {}
        self.place = {w: i for i, w in enumerate(sorted(self.universe, key=lambda w: (frequency.get(w, 0), w)))}
        self.sets = [(label, sorted(s, key=self.place.__getitem__), ceil(threshold * len(s) - 1e-9)) for label, s in sets]
        self.by_prefix: dict[bytes, list[int]] = {}
        for t, (_, words, need) in enumerate(self.sets):
            for w in words[: len(words) - need + 1]:
                self.by_prefix.setdefault(w, []).append(t)
        self.rare = frozenset(self.by_prefix)
        self.lengths = [len(normal(text).split()) for *_, text in templates]

    def met(self, words: list[bytes]) -> list[tuple[int, float]]:
        """(template, containment) for one block."""
        block = sorted(self.universe.intersection(words), key=self.place.__getitem__)
        seen, out = set(), []
        for j, w in enumerate(block):
            for t in self.by_prefix.get(w, ()):
                if t in seen:
                    continue
                seen.add(t)  # w is their first common word: an earlier one would have been a prefix word of the template too
                _, template, need = self.sets[t]
                if len(block) < need or j > len(block) - need or 1 + min(len(template) - template.index(w) - 1, len(block) - j - 1) < need:
                    continue
                common = len(set(block).intersection(template))
                if common >= need:
                    out.append((t, common / len(template)))
        return out

    def wrapped(self, lines: list[list[bytes]]) -> list[tuple[int, int, float, int]]:
        """(first line, template, containment, last line) of the blocks that cross line ends."""
        hits = []
        at = 0
        for i, words in enumerate(lines):
            hits += [(at + k, i, w) for k, w in enumerate(words) if w in self.universe]
            at += len(words)
        held, out = {w for _, _, w in hits}, []
        for t, (_, template, need) in enumerate(self.sets):
            if len(held.intersection(template)) < need:
                continue
            inside = frozenset(template)
            own, words, length = [h for h in hits if h[2] in inside], Counter(), self.lengths[t]
            left, end, best = 0, -1, None
            for place, line, w in own:
                words[w] += 1
                while own[left][0] <= place - length:
                    words[own[left][2]] -= 1
                    if not words[own[left][2]]:
                        del words[own[left][2]]
                    left += 1
                if len(words) < need or own[left][1] == line:
                    continue
                found = (len(words) / len(template), own[left][1], line)
                if best and own[left][0] <= end:
                    best = found if found[0] > best[0] else best
                else:
                    if best:
                        out.append((best[1], t, best[0], best[2]))
                    best = found
                end = place
            if best:
                out.append((best[1], t, best[0], best[2]))
        return out


    def blocks(self, lines: list[list[bytes]]) -> list[dict]:
        """All blocks of a text that meet a template, and whether they name a license."""
        found = [(i, t, c, i) for i, line in enumerate(lines) for t, c in self.met(line)] + self.wrapped(lines)
        holds = [all(any(w in line for line in lines[i : end + 1]) for w in self.naming[t]) for i, t, _, end in found]
        rank = lambda t, c: (round(c, 9), len(self.sets[t][1]))
        # Overlaps are read off a list of the best rank on each line.
        best: dict[int, tuple] = {}
        for (i, t, c, end), ok in zip(found, holds, strict=True):
            for line in range(i, end + 1) if ok else ():
                best[line] = max(best.get(line, (0.0, 0)), rank(t, c))
        return [
            {"line": i, "label": self.sets[t][0], "containment": c, "named": ok and all(best[line] <= rank(t, c) for line in range(i, end + 1))}
            for (i, t, c, end), ok in zip(found, holds, strict=True)
        ]


def phrase_places(words: list[bytes], phrases=PHRASES) -> list[tuple[str, int]]:
    """(label, first word) of every place."""
    joined, out = b" " + b" ".join(words) + b" ", []
    for phrase, label in phrases.items():
        key = b" " + phrase.encode() + b" "
        at, word, last = joined.find(key), 0, 0
        while at >= 0:
            word += joined.count(b" ", last, at)
            last = at
            out.append((label, word))
            at = joined.find(key, at + 1)
    return out


def _frequencies(universe: frozenset[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(universe.intersection(normal(text).split()))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    return run


_BLOCKS = pa.list_(pa.struct([("line", pa.int64()), ("label", pa.string()), ("containment", pa.float64()), ("named", pa.bool_())]))
_PLACES = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))


def _scan(templates: Templates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, places, blocks = [], [], []
            for text in batch.column(1).to_pylist():
                clean = normal(text)
                words = clean.split()
                n_words.append(len(words))
                places.append([{"label": a, "word": b} for a, b in phrase_places(words)])
                found = []
                if not templates.rare.isdisjoint(words):
                    found = templates.blocks([line.split() for line in clean.split(b"\n")])
                blocks.append(found)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(places, _PLACES), pa.array(blocks, _BLOCKS)], names=["id", "n_words", "places", "blocks"])

    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """id, n_words, places (label, word) of phrases, blocks (first line, label, containment, named) that meet a template."""
    prepare(docs.sparkSession)
    rows = spread(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")))
    universe = Templates(templates, threshold).universe
    counted = rows.select("text").mapInArrow(_frequencies(universe), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    frequency = {bytes(r.word): r.n for r in counted.collect()}  # no more rows than template words
    ordered = Templates(templates, threshold, frequency)
    return rows.mapInArrow(_scan(ordered), "id long, n_words long, places array<struct<label:string,word:bigint>>, blocks array<struct<line:bigint,label:string,containment:double,named:boolean>>")

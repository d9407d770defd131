"""License scans by template markup: wording with optional and replaceable regions, compiled to token automata.

A template is mandatory wording with markup: ``[words]`` may stand or be left out (regions nest), and
``{m,n}`` is replaced by any m to n words, such as a holder's name.  All else must stand
exactly, word by word.  A word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` in the text with A-Z
lower-cased, so case, punctuation and line breaks do not matter.  All templates of a scan are
compiled to one position automaton; its subset states are made when a text first needs them, so
a text costs one table look-up a word whatever the number of templates.  Where a template is accepted,
the automaton is run backwards from there to the earliest start; templates are bounded in length, so
that is bounded too.

``PHRASES`` are templates without markup, ``TEMPLATES`` the method's own.  ``scan`` returns every match with
its label, template and first and last word.

Edge cases: a null text is empty and an empty text has no words and no match; repeated rows are
scanned each; matches may overlap, and several ends of one template (an optional tail) are matches of their
own; a very long text is scanned in pieces of a megabyte with the automaton's state carried over, so memory
beside the text itself is bounded; an empty table gives no rows; other columns are carried in one struct, whatever
their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm.common import whole_row


class Template(NamedTuple):
    label: str
    name: str
    markup: str


#: fixed values: the base phrases and their labels
PHRASES = [
    Template("mit", "phrase", "under the mit license"),
    Template("apache-2", "phrase", "apache license version 2"),
    Template("cc-by-nc", "phrase", "cc by nc"),
]

# fixed values: wording of public licenses and notices, with markup
_AS_IS = ("this software is provided by {1,12} as is and any express or implied warranties including but not limited to the "
          "implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {1,12} "
          "be liable for any direct indirect incidental special exemplary or consequential damages including but not limited "
          "to procurement of substitute goods or services loss of use data or profits or business interruption however "
          "caused and on any theory of liability whether in contract strict liability or tort including negligence or "
          "otherwise arising in any way out of the use of this software even if advised of the possibility of such damage")
_BSD = ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met [1] redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer [2] redistributions in binary form must reproduce the above copyright notice "
        "this list of conditions and the following disclaimer in the documentation and or other materials provided with the "
        "distribution ")
_GPL = ("it under the terms of the gnu {name} as published by the free software foundation either version {version} of the "
        "license or at your option any later version")
TEMPLATES = [
    Template("mit", "full text",
             "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
             "documentation files the software to deal in the software without restriction including without limitation the "
             "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
             "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
             "notice and this permission notice [including the next paragraph] shall be included in all copies or substantial "
             "portions of the software the software is provided as is without warranty of any kind express or implied "
             "including but not limited to the warranties of merchantability fitness for a particular purpose and "
             "noninfringement in no event shall {1,12} be liable for any claim damages or other liability whether in an action "
             "of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in "
             "the software"),
    Template("isc", "full text",
             "permission to use copy modify and [or] distribute this software for any purpose with or without fee is hereby "
             "granted provided that the above copyright notice and this permission notice appear in all copies the software "
             "is provided as is and {1,12} disclaims all warranties with regard to this software including all implied "
             "warranties of merchantability and fitness in no event shall {1,12} be liable for any special direct indirect or "
             "consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an "
             "action of contract negligence or other tortious action arising out of or in connection with the use or performance "
             "of this software"),
    Template("bsd-2-clause", "full text", _BSD + _AS_IS),
    Template("bsd-3-clause", "full text",
             _BSD + "[3] neither the name of {1,16} nor the names of [its] {0,4} contributors may be used to endorse or promote products "
             "derived from this software without specific prior written permission " + _AS_IS),
    Template("apache-2", "notice",
             "licensed under the apache license version 2 0 [the license you may not use this file except in compliance with the "
             "license] you may obtain a copy of the license at {0,12} unless required by applicable law or agreed to in writing software "
             "distributed under the license is distributed on an as is basis without warranties or conditions of any kind either "
             "express or implied"),
    Template("apache-2", "short notice", "licensed under [the terms of] the apache [software] license [version] 2 0"),
    Template("mit", "short notice", "licensed under [the terms of] the mit [x11] license"),
    Template("gpl-2-or-later", "notice", _GPL.format(name="general public license", version="2")),
    Template("gpl-3-or-later", "notice", _GPL.format(name="general public license", version="3")),
    Template("lgpl-3-or-later", "notice", _GPL.format(name="lesser general public license", version="3")),
    Template("agpl-3-or-later", "notice", _GPL.format(name="affero general public license", version="3")),
    Template("gpl-2", "short notice", "licensed under [the terms of] the gnu general public license [gpl] version 2"),
    Template("gpl-3", "short notice", "licensed under [the terms of] the gnu general public license [gpl] version 3"),
    Template("mpl-2", "notice", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("cc0", "notice", "has waived all copyright and related or neighboring rights to {1,12} under cc0"),
    Template("cc-by", "short notice", "licensed under [a] [the] [creative commons] cc by [license] [version] 4 0"),
    Template("cc-by", "notice", "licensed under a creative commons attribution [version] 4 0 [international] license"),
    Template("cc-by-nc", "notice", "licensed under a creative commons attribution non commercial [version] 4 0 [international] license"),
    Template("cc-by-nc", "joined notice", "licensed under a creative commons attribution noncommercial [version] 4 0 [international] license"),
    Template("cc-by-sa", "notice", "licensed under a creative commons attribution share alike [version] 4 0 [international] license"),
    Template("cc-by-sa", "joined notice", "licensed under a creative commons attribution sharealike [version] 4 0 [international] license"),
    Template("unlicense", "notice", "this is free and unencumbered software released into the public domain"),
    Template("all-rights-reserved", "notice", "all rights reserved"),
]


# ---------------------------------------------------------------- markup

class Any(NamedTuple):
    low: int
    high: int


def parse(markup: str) -> list:
    """Words, ``Any`` regions and lists (optional regions), in order."""
    out: list = []
    stack = [out]
    for token in re.findall(r"\[|\]|\{\d+,\d+\}|[^\s\[\]{}]+", markup):
        if token == "[":
            stack[-1].append([])
            stack.append(stack[-1][-1])
        elif token == "]":
            stack.pop()
        elif token[0] == "{":
            stack[-1].append(Any(*map(int, token[1:-1].split(","))))
        else:
            stack[-1].append(token.lower())
    if len(stack) != 1 or not out or not (isinstance(out[0], str) and isinstance(out[-1], str)):
        raise ValueError(f"regions must close, and a template begins and ends with mandatory words: {markup}")
    return out


def mandatory_words(markup: str) -> int:
    return sum(isinstance(x, str) for x in parse(markup))


# ---------------------------------------------------------------- automaton

class Automaton:
    """A position automaton of all templates; sets of positions are the bits of one number."""

    #: subset states kept; beyond, they are made anew
    STATES = 50_000

    def __init__(self, templates: Sequence[Template]):
        self.words: list[bytes | None] = []       # of a position; None: any word
        self.follow: list[int] = []
        self.before: list[int] = []
        self.starts = self.first = 0              # first: positions that can be a template's first
        self.ends: list[tuple[int, int]] = []     # last positions of each template
        self.longest = 0
        for k, t in enumerate(templates):
            size = len(self.words)
            last = self._add(parse(t.markup), None)
            self.ends.append((k, sum(1 << p for p in last)))
            self.longest = max(self.longest, len(self.words) - size)
        self.any = sum(1 << p for p, w in enumerate(self.words) if w is None)
        self.accepts = sum(mask for _, mask in self.ends)
        self._reset()

    def _position(self, word: bytes | None, after: set[int] | None) -> int:
        p = len(self.words)
        self.words.append(word)
        self.follow.append(0)
        self.before.append(0)
        if after is None:
            self.first |= 1 << p
        for q in after or ():
            self.follow[q] |= 1 << p
            self.before[p] |= 1 << q
        return p

    def _add(self, items: list, after: set[int] | None) -> set[int]:
        """Positions of ``items`` after the positions ``after`` (None: the start); returns those they may end with."""
        for x in items:
            if isinstance(x, list):
                after = after | self._add(x, after)
            elif isinstance(x, Any):
                ways = set(after) if x.low == 0 else set()
                for k in range(x.high):
                    after = {self._position(None, after)}
                    if k + 1 >= x.low:
                        ways |= after
                after = ways
            else:
                after = {self._position(x.encode(), after)}
        return after

    def _reset(self) -> None:
        self.sets: list[int] = []
        self.step: list = []
        self.other: list = []
        self.hit: list[int] = []
        self.number: dict[int, int] = {}
        self._state(0)

    def _state(self, positions: int) -> int:
        """The number of a subset state."""
        s = self.number.get(positions)
        if s is None:
            s = self.number[positions] = len(self.sets)
            self.sets.append(positions)
            self.step.append(None)
            self.other.append(0)
            self.hit.append(positions & self.accepts)
        return s

    def expand(self, s: int) -> None:
        """The transitions of state ``s``: by the words that its next positions read, and by any other word."""
        positions = self.sets[s]
        reach = self.first
        for p in _bits(positions):
            reach |= self.follow[p]
        wild = reach & self.any
        by_word: dict[bytes, int] = {}
        for p in _bits(reach & ~wild):
            by_word[self.words[p]] = by_word.get(self.words[p], wild) | 1 << p
        self.other[s] = self._state(wild)
        self.step[s] = {w: self._state(m) for w, m in by_word.items()}

    def start_of(self, ends: int, words: Sequence[bytes]) -> int:
        """How many of the last ``words`` the longest way to the last positions ``ends`` takes."""
        best, now = 0, ends
        for k in range(1, min(self.longest, len(words)) + 1):
            word = words[-k]
            now = sum(1 << p for p in _bits(now) if self.words[p] is None or self.words[p] == word)
            if not now:
                break
            if now & self.first:
                best = k
            prior = 0
            for p in _bits(now):
                prior |= self.before[p]
            now = prior
        return best

    def matches(self, pieces: Iterator[list[bytes]]) -> tuple[int, list[tuple[int, int, int]]]:
        """The number of words, and (template, first word, last word) of every match."""
        found, at, s, tail = [], 0, 0, []
        for words in pieces:
            if len(self.sets) > self.STATES:
                here = self.sets[s]
                self._reset()
                s = self._state(here)
            step, other, hit = self.step, self.other, self.hit
            for i, word in enumerate(words):
                row = step[s]
                if row is None:
                    self.expand(s)
                    row = step[s]
                s = row.get(word, other[s])
                if hit[s]:
                    seen = words[max(0, i + 1 - self.longest):i + 1]
                    if len(seen) < self.longest:
                        seen = tail[len(seen) - self.longest:] + seen
                    for k, mask in self.ends:
                        if hit[s] & mask:
                            size = self.start_of(hit[s] & mask, seen)
                            found.append((k, at + i + 1 - size, at + i))
            at += len(words)
            tail = (tail + words[-self.longest:])[-self.longest:]
        return at, found


def _bits(mask: int) -> Iterator[int]:
    while mask:
        low = mask & -mask
        yield low.bit_length() - 1
        mask ^= low


#: bytes to bytes: A-Z to a-z, what is no part of a word to a space
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: bytes of a text that are split at once
PIECE = 1 << 20


def pieces_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text, a megabyte at a time."""
    at = 0
    while at < len(text):
        end = at + PIECE
        piece = text[at:end].translate(_TABLE)
        if end < len(text):                          # the word at the cut goes to the next piece
            cut = piece.rfind(b" ") + 1
            while not cut and end < len(text):       # a word of more than a megabyte
                end += PIECE
                piece = text[at:end].translate(_TABLE)
                cut = piece.rfind(b" ") + 1 if end < len(text) else len(piece)
            piece = piece[:cut or len(piece)]
        at += len(piece)
        yield piece.split()


def _scan(batches: Iterator[pa.RecordBatch], templates: list[Template], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    automaton = Automaton(templates)
    for batch in batches:
        counts, found = [], []
        for text in batch.column(1):
            n, matches = automaton.matches(pieces_of(text.as_py() or b""))
            counts.append(n)
            found.append([{"template": k, "first": a, "last": z} for k, a, z in matches])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(found, schema)], names=["carried", "n_words", "found"])


_FOUND = pa.list_(pa.struct([("template", pa.int32()), ("first", pa.int64()), ("last", pa.int64())]))


def scan(docs: DataFrame, templates: Sequence[Template], carry: list[str] | None = None) -> DataFrame:
    """carried (struct of ``carry`` or all columns but text), n_words, matches of every row of ``docs``.

    ``matches``: array of struct(label, name, template (its place in ``templates``), first, last), by last word.
    """
    templates = list(templates)
    packed = docs.select(whole_row(docs, [c for c in docs.columns if c != "text"] if carry is None else carry).alias("carried"),
                         F.encode(F.col("text").cast("string"), "UTF-8").alias("bytes"))
    kind = packed.schema["carried"].dataType.simpleString()
    found = packed.mapInArrow(lambda it: _scan(it, templates, _FOUND),
                              f"carried {kind}, n_words long, found array<struct<template int, first long, last long>>")
    names = F.array(*(F.struct(F.lit(t.label).alias("label"), F.lit(t.name).alias("name")) for t in templates))
    matches = F.transform("found", lambda m: F.struct(
        names[m["template"]]["label"].alias("label"), names[m["template"]]["name"].alias("name"),
        m["template"].alias("template"), m["first"].alias("first"), m["last"].alias("last")))
    return found.select("carried", "n_words", matches.alias("matches"))


def license_report(docs: DataFrame, phrases: Sequence[Template] = tuple(PHRASES),
                   templates: Sequence[Template] = tuple(TEMPLATES)) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches of every row.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` are of the phrases, ``labels`` of both; ``score`` is the
    share of the document's words that the mandatory wording of its longest match makes up.
    """
    found = scan(docs, [*phrases, *templates], ["doc_id"])
    base = F.filter("matches", lambda m: m["template"] < len(phrases))
    sizes = F.array(*(F.lit(mandatory_words(t.markup)) for t in (*phrases, *templates)))
    label_text = lambda ms: F.array_join(F.array_sort(F.array_distinct(F.transform(ms, lambda m: m["label"]))), ",")
    longest = F.array_max(F.transform("matches", lambda m: sizes[m["template"]]))
    return found.select(
        F.col("carried.doc_id").alias("doc_id"), "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda m: m["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda m: m["first"])).alias("last_word"),
        label_text(base).alias("base_labels"), label_text(F.col("matches")).alias("labels"),
        F.coalesce(longest.cast("double") / F.nullif(F.col("n_words"), F.lit(0)), F.lit(0.0)).alias("score"), "matches")


def as_regex(markup: str) -> str:
    """The template as a regular expression over words that each follow one space, with a space at the end."""
    def of(items: list) -> str:
        return "".join(f"({of(x)})?" if isinstance(x, list) else f"( [^ ]+){{{x.low},{x.high}}}" if isinstance(x, Any)
                       else f" {x}" for x in items)
    return of(parse(markup)) + " "

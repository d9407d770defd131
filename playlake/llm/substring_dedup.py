"""Removal of repeated word windows with difference-cover anchors.

A window is ``min_words`` consecutive words of one document.  A word goes when a window that
covers it also starts earlier (smaller doc_id, or the same document at an earlier place),
judged on the input.

Anchors are hashes of short word runs taken only where the word's place modulo a period
lies in a difference cover.  For any two places i and j the cover has a shift, smaller
than the period, that brings both onto it; with anchors of ``min_words - period + 1`` words
two equal windows therefore share an aligned anchor inside them.  So:

1. each document group emits its distinct anchors, by hash range;
2. a task for each range marks anchors that several groups have;
3. each group extends around anchors that occur twice (in the group or elsewhere) to the
   whole windows that hold them, and emits the distinct ones as 96-bit hashes;
4. a task for each range decides which group has the first start of each window;
5. each group removes the words of all windows that are not the first.

Between the steps only packed hashes and bit maps are shuffled.  A group sends a hash once
however often it has it, so a passage that a third of all documents share costs one
entry a group, and no pairs of copies are formed.  The grouped text is exchanged once and
read three times (Spark reuses the exchange).

Edge cases: a null text has no words; a null doc_id ranks last, in any order among null ones (one
of them keeps a window they share); rows that share another doc_id are separate documents, ordered
by text; rows of a repeated or null doc_id are sorted once and dealt over the groups by
their rank, so no key fills a group; texts of fewer words than a window
are kept whole; an empty table gives no rows; columns named in ``carry`` are passed through under
their names; a very long text is part of one group, which holds it whole.  Words are compared by the XXH64
of their bytes, windows by 96-bit rolling hashes of those.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlake.llm.common import materialize, whole_row

#: perfect difference covers by period: fixed values
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
#: odd multipliers of the rolling hashes: fixed values
_WORD_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
#: bytes whose words are hashed at once
_SLICE = 1 << 20
#: longest window: runs of a thousand words and more can defeat rolling hashes modulo 2 ** 64
MOST_WORDS = 512

_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def cover_for(min_words: int) -> tuple[int, tuple[int, ...], int]:
    """Period, cover and anchor words: the longest period that leaves anchors of 8 words or more."""
    if not 1 <= min_words <= MOST_WORDS:
        raise ValueError(f"windows have 1 to {MOST_WORDS} words")
    periods = [p for p in COVERS if min_words - p + 1 >= 8] or [p for p in COVERS if min_words >= p]
    period = max(periods, default=1)
    return period, COVERS.get(period, (0,)), min_words - period + 1


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64, for i below n."""
    found = _powers.get(base)
    if found is None or found[0].size < n:
        size = max(n, 1 << 16)
        tables = []
        for b in (base, pow(base, -1, 1 << 64)):
            t = np.full(size, b, np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        found = _powers[base] = (tables[0], tables[1])
    return found[0][:n], found[1][:n]


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = x + np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of a group of texts, as one array of 64-bit hashes."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts], np.int64)
        # every text ends with a break, so words don't run on into the next one
        joined = b" ".join([*texts, b""])
        data = np.frombuffer(joined, np.uint8)
        breaks = _IS_BREAK[data]
        inside = np.concatenate([[False], ~breaks, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        ends_of_texts = np.cumsum(sizes + 1)
        #: first word of each text, and one more at the end
        self.first = np.concatenate([[0], np.searchsorted(self.starts, ends_of_texts)]).astype(np.int64)
        self.n = self.starts.size
        self.hashes = self._hash(joined)
        #: first word of the own text, and the end of the own text, for each word
        per_text = np.diff(self.first)
        self.text_start = np.repeat(self.first[:-1], per_text)
        self.text_end = np.repeat(self.first[1:], per_text)

    def _hash(self, joined: bytes) -> np.ndarray:
        """XXH64 of each word's bytes; a megabyte of text is split at once."""
        out = np.empty(self.n, np.uint64)
        i = 0
        while i < self.n:
            a = int(self.starts[i])
            j = max(i + 1, int(np.searchsorted(self.ends, a + _SLICE, "right")))
            out[i:j] = np.fromiter(map(xxhash.xxh64_intdigest, joined[a:int(self.ends[j - 1])].split()), np.uint64, j - i)
            i = j
        return out

    def runs(self, at: np.ndarray, length: int, which: int) -> np.ndarray:
        """Hash of the ``length`` words from each place in ``at``."""
        up, down = _power_tables(_WORD_BASES[which], self.n + 1)
        sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(_mix(self.hashes, 2 + which) * up[:self.n], out=sums[1:])
        return _mix((sums[at + length] - sums[at]) * down[at], 7)


class _Plan:
    """Window and anchor lengths, and how many hash ranges there are."""

    def __init__(self, min_words: int, ranges_log2: int):
        self.min_words, self.log2 = min_words, ranges_log2
        self.period, self.cover, self.anchor_words = cover_for(min_words)
        self.on_cover = np.zeros(self.period, bool)
        self.on_cover[list(self.cover)] = True

    def anchors(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Places on the cover with a whole anchor in their text, and its hash."""
        place = np.arange(words.n)
        at = place[self.on_cover[(place - words.text_start) % self.period]
                   & (place + self.anchor_words <= words.text_end)]
        return at, words.runs(at, self.anchor_words, 0)

    def windows(self, words: Words, marked: np.ndarray) -> np.ndarray:
        """Starts of whole windows that hold a marked anchor within a period of their start."""
        step = np.zeros(words.n + 1, np.int64)
        np.add.at(step, np.maximum(marked - self.period + 1, 0), 1)
        np.add.at(step, marked + 1, -1)
        near = np.cumsum(step[:-1]) > 0
        return np.flatnonzero(near & (np.arange(words.n) + self.min_words <= words.text_end))

    def distinct(self, words: Words, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct windows: high and low hash, first start, and for each start its window's number."""
        high = words.runs(starts, self.min_words, 0)
        low = (words.runs(starts, self.min_words, 1) >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((low, high))                  # stable: equal windows stay in text order
        new = np.ones(order.size, bool)
        new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
        number = np.empty(order.size, np.int64)
        number[order] = np.cumsum(new) - 1
        first = order[new]
        return high[first], low[first], starts[first], number

    def cuts(self, hashes: np.ndarray) -> list[tuple[int, int, int]]:
        """(range, from, to) of the ranges that the sorted hashes fall into."""
        if not hashes.size:
            return []
        of = (hashes >> np.uint64(64 - self.log2)).astype(np.int64) if self.log2 else np.zeros(hashes.size, np.int64)
        at = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [hashes.size]]).tolist()
        return [(int(of[a]), a, z) for a, z in zip(at, at[1:])]


_LAST = np.iinfo(np.int64).max


def _ordered(table: pa.Table) -> tuple[pa.Table, list[bytes], np.ndarray, np.ndarray]:
    """The group's rows in document order, their texts, doc_id (nulls: the largest value) and rank."""
    texts = [t.as_py() for t in table.column("bytes").combine_chunks()] if table.num_rows else []
    ids, ranks = table.column("doc_id").to_pylist(), table.column("rank").to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, ranks[i]))
    key = np.array([_LAST if ids[i] is None else ids[i] for i in order], np.int64)
    return table.take(order), [texts[i] for i in order], key, np.array([ranks[i] for i in order], np.int64)


_ANCHOR_ROWS = "part int, g bigint, hashes binary"
_MARK_ROWS = "g bigint, part int, bits binary"
_WINDOW_ROWS = "part int, g bigint, kind int, hashes binary, lows binary, places binary, doc_ids binary, ranks binary, heads binary"
_FIRST_ROWS = "g bigint, kind int, part int, bits binary"


def _rows(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    cols = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(fields, cols)})


def _emit_anchors(plan: _Plan):
    def emit(key: tuple, table: pa.Table) -> pa.Table:
        _, texts, _, _ = _ordered(table)
        found = np.unique(plan.anchors(Words(texts))[1])
        g = key[0].as_py()
        return _rows(_ANCHOR_ROWS, [(part, g, found[a:z].tobytes()) for part, a, z in plan.cuts(found)])
    return emit


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _mark_anchors(key: tuple, table: pa.Table) -> pa.Table:
    """For each group, which of its anchors another group has too."""
    groups = table.column("g").to_pylist()
    own = [np.frombuffer(b.as_py(), np.uint64) for b in table.column("hashes")]
    every = np.concatenate(own)
    order = np.argsort(every, kind="stable")
    same = every[order][1:] == every[order][:-1]
    shared = np.zeros(every.size, bool)
    shared[order[1:]] |= same
    shared[order[:-1]] |= same
    at = np.cumsum([0, *(x.size for x in own)]).tolist()
    part = key[0].as_py()
    return _rows(_MARK_ROWS, [(g, part, _bits(shared[a:z])) for g, a, z in zip(groups, at, at[1:])
                              if shared[a:z].any()])


def _emit_windows(plan: _Plan):
    def emit(key: tuple, table: pa.Table, marks: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _rows(_WINDOW_ROWS, [])
        _, texts, ids, ranks = _ordered(table)
        words = Words(texts)
        at, hashes = plan.anchors(words)
        found, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        twice = counts > 1
        bits = dict(zip(marks.column("part").to_pylist(), marks.column("bits").to_pylist()))
        for part, a, z in plan.cuts(found):
            if part in bits:
                twice[a:z] |= np.unpackbits(np.frombuffer(bits[part], np.uint8), count=z - a).astype(bool)
        starts = plan.windows(words, at[twice[inverse]])
        if not starts.size:
            return _rows(_WINDOW_ROWS, [])
        high, low, first, _ = plan.distinct(words, starts)
        g, ranges = key[0].as_py(), 1 << plan.log2
        rows = []
        for part, a, z in plan.cuts(high):
            places = first[a:z]
            held = np.unique(np.searchsorted(words.first, places, "right") - 1)
            rows.append((part, g, 0, high[a:z].tobytes(), low[a:z].tobytes(), places.astype(np.uint32).tobytes(),
                         ids[held].tobytes(), ranks[held].tobytes(), words.first[held].astype(np.uint32).tobytes()))
        chosen = np.zeros(words.n, bool)
        chosen[starts] = True
        # the window starts travel with the decisions to the last step
        rows.append((g % ranges, g, 1, _bits(chosen), b"", b"", b"", b"", b""))
        return _rows(_WINDOW_ROWS, rows)
    return emit


def _decide_first(key: tuple, table: pa.Table) -> pa.Table:
    """For each group, which of its windows no other document starts earlier."""
    part = key[0].as_py()
    out, groups, high, low, place, doc, rank = [], [], [], [], [], [], []
    for row in table.to_pylist():
        if row["kind"] == 1:
            out.append((row["g"], 1, part, row["hashes"]))
            continue
        groups.append(row["g"])
        high.append(np.frombuffer(row["hashes"], np.uint64))
        low.append(np.frombuffer(row["lows"], np.uint32))
        place.append(np.frombuffer(row["places"], np.uint32))
        heads = np.frombuffer(row["heads"], np.uint32)
        of = np.searchsorted(heads, place[-1], "right") - 1
        doc.append(np.frombuffer(row["doc_ids"], np.int64)[of])
        rank.append(np.frombuffer(row["ranks"], np.int64)[of])
    if groups:
        at = np.cumsum([0, *(x.size for x in high)]).tolist()
        high, low, place, doc, rank = (np.concatenate(x) for x in (high, low, place, doc, rank))
        order = np.lexsort((place, rank, doc, low, high))
        is_first = np.empty(order.size, bool)
        new = np.ones(order.size, bool)
        new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
        is_first[order] = new
        out += [(g, 0, part, _bits(is_first[a:z])) for g, a, z in zip(groups, at, at[1:])]
    return _rows(_FIRST_ROWS, out)


def _removed_words(plan: _Plan, words: Words, decided: pa.Table) -> np.ndarray:
    gone = np.zeros(words.n, bool)
    rows = decided.to_pylist()
    chosen = next((r["bits"] for r in rows if r["kind"] == 1), None)
    if chosen is None:
        return gone
    starts = np.flatnonzero(np.unpackbits(np.frombuffer(chosen, np.uint8), count=words.n))
    high, _, first, number = plan.distinct(words, starts)
    bits = {r["part"]: r["bits"] for r in rows if r["kind"] == 0}
    is_first = np.zeros(high.size, bool)
    for part, a, z in plan.cuts(high):
        is_first[a:z] = np.unpackbits(np.frombuffer(bits[part], np.uint8), count=z - a).astype(bool)
    repeats = starts[~(is_first[number] & (starts == first[number]))]
    step = np.zeros(words.n + 1, np.int64)
    step[repeats] += 1
    step[repeats + plan.min_words] -= 1              # starts are distinct, and so are the ends
    return np.cumsum(step[:-1]) > 0


def _remove(plan: _Plan):
    def remove(key: tuple, table: pa.Table, decided: pa.Table) -> pa.Table:
        table, texts, _, _ = _ordered(table)
        words = Words(texts)
        gone = _removed_words(plan, words, decided)
        total = np.concatenate([[0], np.cumsum(gone)])
        n_words, n_removed = np.diff(words.first), total[words.first[1:]] - total[words.first[:-1]]
        kept = []
        for text, a, z, n in zip(texts, words.first[:-1].tolist(), words.first[1:].tolist(), n_removed.tolist()):
            own = text.split()
            kept.append(b" ".join(compress(own, (~gone[a:z]).tolist()) if n else own))
        out = table.drop_columns(["g", "bytes", "rank"])
        out = out.append_column("n_words", pa.array(n_words, pa.int64()))
        out = out.append_column("n_removed", pa.array(n_removed, pa.int64()))
        return out.append_column("kept_text", pa.array(kept, pa.binary()).cast(pa.string()))
    return remove


def grouped_rows(docs: DataFrame, groups: int, carry: list[str] | None = None) -> DataFrame:
    """g, doc_id, bytes, rank of every row, and ``carried``; ``rank`` orders the rows of one doc_id by text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(text, "UTF-8").alias("bytes"),
                        *([whole_row(docs, carry).alias("carried")] if carry else []))

    def dealt(rows: DataFrame, *key: str) -> DataFrame:
        return rows.select(F.pmod(F.xxhash64(*key), F.lit(groups)).alias("g"), *plain.columns, "rank")

    repeated = materialize(plain.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("id")),
                           "repeated-ids")
    if not repeated.head(1):
        return dealt(plain.withColumn("rank", F.lit(0).cast("long")), "doc_id")
    same = plain["doc_id"].eqNullSafe(repeated["id"])
    # the row id splits equal texts over ranges; stored, as ranks must not change between readings
    ranked = materialize(plain.join(repeated, same, "left_semi").withColumn("row", F.monotonically_increasing_id())
                         .orderBy("doc_id", "bytes", "row").drop("row")
                         .withColumn("rank", F.monotonically_increasing_id()), "repeated-rows")
    single = plain.join(repeated, same, "left_anti").withColumn("rank", F.lit(0).cast("long"))
    return dealt(single, "doc_id").unionByName(dealt(ranked, "doc_id", "rank"))


def remove_repeated_windows(docs: DataFrame, min_words: int = 20, carry: list[str] | None = None,
                            group_chars: int = 3_000_000, range_words: int = 6_000_000) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one space) of every row, and ``carry``.

    ``carry`` names columns of ``docs`` to pass through, in a struct column ``carried``.
    """
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = max(32, -(-chars // group_chars))
    # words average under 6 characters; a range holds the anchors of about range_words of them
    plan = _Plan(min_words, max(4, int(np.ceil(np.log2(max(1, chars / 6 / range_words))))))
    grouped = grouped_rows(docs, groups, carry)
    by_group = grouped.groupBy("g")
    marks = (by_group.applyInArrow(_emit_anchors(plan), _ANCHOR_ROWS)
             .groupBy("part").applyInArrow(_mark_anchors, _MARK_ROWS))
    firsts = (by_group.cogroup(marks.groupBy("g")).applyInArrow(_emit_windows(plan), _WINDOW_ROWS)
              .groupBy("part").applyInArrow(_decide_first, _FIRST_ROWS))
    schema = T.StructType().add("doc_id", "long")
    if carry:
        schema = schema.add("carried", grouped.schema["carried"].dataType)
    schema = schema.add("n_words", "long").add("n_removed", "long").add("kept_text", "string")
    return by_group.cogroup(firsts.groupBy("g")).applyInArrow(_remove(plan), schema)

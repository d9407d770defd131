"""Language identification with bit-sliced n-gram filters.

Learning counts the letter trigrams (with word borders) of all labelled training texts, by
language, each once a text, so a text that repeats itself weighs no more.  A language's filter holds all
trigrams that make up at least ``min_part`` of its trigrams, however many other languages have them;
as parts add up to 1, a filter holds at most ``1 / min_part`` trigrams, whatever the corpus.  A second
filter holds those of them that mark the language: it has at least ``min_share`` of the
frequency that it and the language richest in the trigram have together.  So a label with the
same trigrams changes neither filter of another one, and related languages keep theirs.

The filters are Bloom filters of one size and the same hash functions, stored as slices: entry i
holds bit i of every filter as a bit mask.  A trigram's ``hashes`` entries, combined
with AND, give all languages that hold it at once.  The hits of a text's distinct trigrams are counted for each
language and corrected for false positives, whose rate is the filter's fill to the power
``hashes``: ``share = (hits / trigrams - rate) / (1 - rate)``.  The largest share of
marking trigrams decides; the score is the language's share in the first filter, to which common ones count,
over the share of the language's own trigrams that this filter holds (``mass``): rare trigrams that are left out,
most of them where the alphabet is large, lower no text's score.

Training reads text and label of training rows only; prediction reads the text only.

Edge cases: a null text, or one without any letter, is ``und`` with score 0; so is every
text where nothing was learned; null labels don't teach; ties go to the label that sorts first; very
long texts are read in slices; rows are kept one to one; an empty table gives no rows; columns
of any name are passed through in ``carried``.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlake.llm.common import materialize, unpacked, whole_row

UNKNOWN = "und"
#: characters handled at once
SLICE = 1 << 20
#: distinct trigrams a training task holds before it passes them on
HELD = 1 << 21


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> itself for letters, 0 for all others."""
    table = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    table[[not unicodedata.category(chr(c)).startswith("L") for c in range(sys.maxunicode + 1)]] = 0
    return table


def _slices(texts: list[str]) -> Iterator[list[tuple[int, str, int, int]]]:
    """Batches of (text number, part, first own character, end of own characters)."""
    held: list[tuple[int, str, int, int]] = []
    size = 0
    for i, text in enumerate(texts):
        for a in range(0, len(text), SLICE):
            z = min(len(text), a + SLICE)
            part = text[max(0, a - 1):z + 1]
            held.append((i, part, int(a > 0), int(a > 0) + z - a))
            size += z - a
            if size >= SLICE:
                yield held
                held, size = [], 0
    if held:
        yield held


def trigrams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, text numbers) of the distinct trigrams around a letter of each text, by slices.

    A text within one slice has each trigram once; of longer ones, each slice has."""
    letters = _letters()
    for parts in _slices([(t or "").lower() for t in texts]):
        joined = "\0" + "\0".join(p for _, p, _, _ in parts) + "\0"
        c = letters[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.uint64)
        sizes = np.array([len(p) for _, p, _, _ in parts])
        begins = np.cumsum(sizes + 1) - sizes             # place of each part's first character
        number = np.repeat([i for i, _, _, _ in parts], sizes + 1)
        codes = (c[:-2] << np.uint64(42)) | (c[1:-1] << np.uint64(21)) | c[2:]
        centre = c[1:-1] != 0
        for (_, p, first, end), at in zip(parts, (begins - 1).tolist()):
            if first:
                centre[at] = False
            if end < len(p):
                centre[at + end:at + len(p)] = False
        codes, number = codes[centre], number[:centre.size][centre]
        # a 64-bit hash of (text, trigram) stands for the pair
        pair = (codes ^ (number.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0x9E3779B97F4A7C15)
        first = np.unique(pair ^ (pair >> np.uint64(32)), return_index=True)[1]
        yield codes[first], number[first]


# ---------------------------------------------------------------- learning

def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def combined() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            found, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(inverse, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * found.size, pa.string()), pa.array(found.view(np.int64)), pa.array(n)],
                names=["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            by_lang.setdefault(lang, []).append(text.as_py())
        for lang, texts in by_lang.items():
            for codes, _ in trigrams(texts):
                found, n = np.unique(codes, return_counts=True)
                held.setdefault(lang, []).append((found, n))
                size += found.size
                if size >= HELD:
                    yield from combined()
                    size = 0
    yield from combined()


@dataclass(frozen=True)
class Filters:
    """Bit-sliced filters: ``slices[i, w]`` has bit i of filters 64 w to 64 w + 63.

    Filter k is that of language k; those of the marking trigrams, if any, follow in the same order.
    """

    languages: list[str]
    slices: np.ndarray
    hashes: int
    rates: np.ndarray
    #: of each language the part of its trigrams that its filter holds
    mass: np.ndarray

    def _places(self, codes: np.ndarray) -> Iterator[np.ndarray]:
        yield from _places(codes, self.slices.shape[0], self.hashes)

    def masks(self, codes: np.ndarray) -> np.ndarray:
        """For each trigram the bit masks of all languages that hold it."""
        out = None
        for at in self._places(codes):
            out = self.slices[at] if out is None else out & self.slices[at]
        return out


def _places(codes: np.ndarray, size: int, hashes: int) -> Iterator[np.ndarray]:
    x = codes * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    step = (x >> np.uint64(32)) | np.uint64(1)
    for k in range(hashes):
        yield ((x + np.uint64(k) * step) & np.uint64(size - 1)).astype(np.int64)


#: the least mass that scores are divided by: below, what a filter holds says too little of a language
LEAST_MASS = 0.05


def build_filters(grams: dict[str, np.ndarray], marking: dict[str, np.ndarray] | None = None, hashes: int = 3,
                  entries_a_gram: int = 16, mass: dict[str, float] | None = None) -> Filters:
    """``marking``: for each language those of its ``grams`` that mark it; ``mass``: the part of its trigrams they are."""
    languages = sorted(grams)
    most = max((g.size for g in grams.values()), default=0)
    size = 1 << max(10, int(np.ceil(np.log2(max(1, most * entries_a_gram)))))
    held = [grams[lang] for lang in languages] + [marking[lang] for lang in languages if marking is not None]
    slices = np.zeros((size, max(1, -(-len(held) // 64))), np.uint64)
    rates = np.zeros(len(held))
    for i, own in enumerate(held):
        bit = np.zeros(size, bool)
        for at in _places(own, size, hashes):
            bit[at] = True
        slices[bit, i // 64] |= np.uint64(1 << (i % 64))
        rates[i] = bit.mean() ** hashes
    return Filters(languages, slices, hashes, rates, np.array([max(LEAST_MASS, (mass or {}).get(k, 1.0)) for k in languages]))


def learn(rows: DataFrame, min_part: float = 1e-5, min_share: float = 0.3, **options) -> Filters:
    """Filters from ``rows`` (text, lang): counts cover all rows with both."""
    plain = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = materialize(plain.filter("lang is not null and text is not null")
                         .mapInArrow(_count, "lang string, gram bigint, n bigint")
                         .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "trigrams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    parts = counts.join(totals, "lang").withColumn("part", F.col("n") / F.col("total"))
    tops = parts.groupBy("gram").agg(F.max("part").alias("top"))
    marks = F.col("part") >= (F.col("part") + F.col("top")) * min_share
    # codes have 63 bits: the sign tells those that mark the language
    chosen = (parts.filter(F.col("part") >= min_part).join(tops, "gram")
              .groupBy("lang").agg(F.collect_list(F.when(marks, F.bitwise_not("gram")).otherwise(F.col("gram"))).alias("grams"),
                                   F.sum("part").alias("mass")))
    grams, marking, mass = {}, {}, {}
    # a language has at most 1 / min_part grams
    for r in chosen.collect():
        codes = np.array(r["grams"], np.int64)
        marking[r["lang"]] = np.sort(~codes[codes < 0]).view(np.uint64)
        grams[r["lang"]] = np.sort(np.where(codes < 0, ~codes, codes)).view(np.uint64)
        mass[r["lang"]] = min(1.0, r["mass"])
    return build_filters(grams, marking, mass=mass, **options)


# ---------------------------------------------------------------- prediction

def shares(texts: list[str | None], filters: Filters) -> tuple[np.ndarray, np.ndarray]:
    """Corrected share of each filter (texts x filters), and the number of trigrams of each text."""
    n = np.zeros(len(texts), np.int64)
    hits = np.zeros((len(texts), filters.rates.size))
    for codes, number in trigrams(texts):
        if not codes.size:
            continue
        n += np.bincount(number, minlength=len(texts))
        if not filters.languages:
            continue
        masks = filters.masks(codes)
        for i in range(filters.rates.size):
            bit = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            hits[:, i] += np.bincount(number, weights=bit, minlength=len(texts))
    observed = hits / np.maximum(n, 1)[:, None]
    return np.clip((observed - filters.rates) / np.maximum(1 - filters.rates, 1e-12), 0, 1), n


def _predict(batches: Iterator[pa.RecordBatch], filters: Filters) -> Iterator[pa.RecordBatch]:
    """Rows of carried and, unless it is carried already, text."""
    names = np.array([*filters.languages, UNKNOWN], object)
    for whole in batches:
        texts = whole.column(1) if whole.num_columns > 1 else whole.column(0).field("text")
        for a in range(0, whole.num_rows, 500):
            batch = whole.slice(a, 500)
            found, n = shares(texts.slice(a, 500).to_pylist(), filters)
            # the last filters are those of the marking trigrams
            best = found[:, -len(filters.languages):].argmax(axis=1) if filters.languages else np.zeros(batch.num_rows, np.int64)
            known = (n > 0) & bool(filters.languages)
            score = (np.minimum(found[np.arange(best.size), best] / filters.mass[best], 1) if filters.languages
                     else np.zeros(batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[np.where(known, best, len(filters.languages))], pa.string()),
                 pa.array(np.where(known, score, 0.0))], names=["carried", "lang_pred", "score"])


def predict(docs: DataFrame, filters: Filters, carry: list[str]) -> DataFrame:
    """carried (a struct of the columns ``carry``), lang_pred, score of every row of ``docs`` (text)."""
    plain = docs.select(whole_row(docs, carry).alias("carried"), F.col("text").cast("string").alias("text"))
    if "text" in carry and docs.schema["text"].dataType == T.StringType():
        plain = plain.select("carried")              # the text goes to Python once
    schema = (T.StructType().add("carried", plain.schema["carried"].dataType).add("lang_pred", "string")
              .add("score", "double"))
    return plain.mapInArrow(lambda it: _predict(it, filters), schema)


def held_out(doc_id="doc_id"):
    """True for the third of the documents that never teach."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def keep_known(docs: DataFrame, min_score: float = 0.1, **options) -> DataFrame:
    """The rows of ``docs`` whose text is in a language learned from the labelled rows.

    Rejected are texts that are ``und`` and those of which the best language explains less
    than ``min_score``.  All columns are kept as they were.
    """
    filters = learn(docs.filter(~held_out()), **options)
    found = predict(docs, filters, docs.columns)
    known = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    return unpacked(known, "carried", docs.columns)

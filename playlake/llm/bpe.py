"""Byte-level BPE encoding with a pair occurrence index, and decoding.

``encode_documents`` walks a partition in chunks of about ``chunk_chars`` characters.  The
distinct pre-tokens of a chunk are laid out as one array of byte symbols.  An index maps
every adjacent pair that has a merge rank to all its positions in that array; active ranks
leave a heap in ascending order, each merge is applied at once to all positions of its
pair, and only the lists of the pairs to the left and right of a merged position change.
A text's ids are then gathered from its pre-tokens.  No tokenizer library takes part.

Edge cases: a null text counts as empty (no ids); added tokens' strings inside a text become
their ids, as the library does by default; ids that don't end on a character boundary decode
with U+FFFD; rows are kept one to one, repeated ones too; ``doc_id`` may be null; an empty
table gives an empty table.  Only the two named columns are read.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm.pretoken import byte_symbols, split


class PairTable:
    """Vocabulary and ranked merges of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if (spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space", True)
                or not pre.get("use_regex", True) or model.get("type") != "BPE"
                or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")
                or model.get("ignore_merges") or model.get("dropout")):
            raise ValueError("a plain byte-level BPE file is needed")
        vocab = model["vocab"]
        symbols = byte_symbols()
        self.byte_ids = np.array([vocab[s] for s in symbols], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.left, self.right = left, right
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = (left << 32) | right
        # a repeated pair keeps its last rank, as a map filled in order does
        order = np.lexsort((-np.arange(keys.size), keys))
        keys = keys[order]
        last = np.r_[True, keys[1:] != keys[:-1]] if keys.size else np.zeros(0, bool)
        self.keys, self.ranks = keys[last], order[last]
        self.added = {}
        for t in spec.get("added_tokens", []):
            if t.get("lstrip") or t.get("rstrip") or t.get("single_word"):
                raise ValueError("added tokens that strip or need word borders are not handled")
            self.added[t["content"]] = t["id"]
        self.added_pattern = (regex.compile("(" + "|".join(
            regex.escape(c) for c in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None)
        back = {s: b for b, s in enumerate(symbols)}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in {**vocab, **self.added}.items():
            self.token_bytes[i] = (bytes(back[c] for c in token) if all(c in back for c in token)
                                   else token.encode())

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, -1 where there is none (symbols below 0 have none)."""
        keys = (left.astype(np.int64) << 32) | right
        if not self.keys.size:
            return np.full(keys.size, -1)
        at = np.minimum(np.searchsorted(self.keys, keys), self.keys.size - 1)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.ranks[at], -1)


@functools.lru_cache(maxsize=2)
def pair_table(path: str) -> PairTable:
    return PairTable(path)


class _Occurrences:
    """rank -> positions where its pair stands or stood, and the active ranks as a heap."""

    def __init__(self):
        self.lists: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []

    def add(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        keep = ranks >= 0
        ranks, positions = ranks[keep], positions[keep]
        if not ranks.size:
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), ranks.size]
        for a, z in zip(cuts, cuts[1:]):
            r = int(ranks[a])
            found = self.lists.get(r)
            if found is None:
                self.lists[r] = [positions[a:z]]
                heapq.heappush(self.active, r)
            else:
                found.append(positions[a:z])

    def next(self) -> tuple[int, np.ndarray] | None:
        if not self.active:
            return None
        r = heapq.heappop(self.active)
        parts = self.lists.pop(r)
        return r, (parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts)))


def merge_words(words: list[bytes], table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words joined, and where each word begins (one more entry at the end)."""
    sizes = np.array([len(w) for w in words], np.int64)
    total = int(sizes.sum()) + sizes.size + 1
    # a separator before every word and one at the end
    starts = np.cumsum(sizes + 1) - sizes
    symbol = np.full(total, -1, np.int32)
    inside = np.ones(total, bool)
    inside[starts - 1] = False
    inside[-1] = False
    symbol[inside] = table.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    link = np.int32 if total < 1 << 31 else np.int64
    after = np.arange(1, total + 1, dtype=link)
    after[-1] = total - 1
    before = np.arange(-1, total - 1, dtype=link)
    before[0] = 0

    index = _Occurrences()
    index.add(table.rank(symbol[:-1], symbol[1:]), np.arange(total - 1, dtype=link))
    while (step := index.next()) is not None:
        r, at = step
        a, b, new = int(table.left[r]), int(table.right[r]), int(table.merged[r])
        at = at[(symbol[at] == a) & (symbol[after[at]] == b)]
        if a == b and at.size > 1:
            # in a chain of equal symbols every second position merges, from the left
            follows = np.r_[False, after[at[:-1]] == at[1:]]
            head = np.maximum.accumulate(np.where(follows, 0, np.arange(at.size)))
            at = at[(np.arange(at.size) - head) % 2 == 0]
        if not at.size:
            continue
        gone = after[at]
        rest = after[gone]
        symbol[at] = new
        symbol[gone] = -2
        after[at] = rest
        before[rest] = at
        left = before[at]
        index.add(table.rank(symbol[left], symbol[at]), left)
        index.add(table.rank(symbol[at], symbol[rest]), at)
    live = symbol >= 0
    counts = np.cumsum(live)
    return symbol[live], np.r_[counts[starts - 1], counts[-1]] if sizes.size else np.zeros(1, np.int64)


class _Words(dict):
    """pre-token -> its number in this chunk."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _word_numbers(text: str, words: _Words, table: PairTable) -> np.ndarray:
    """The text's pre-tokens by number; added tokens as -1 - id."""
    if table.added_pattern is None or not any(a in text for a in table.added):
        return np.fromiter(map(words.__getitem__, split(text)), np.int64)
    parts = []
    for piece in table.added_pattern.split(text):
        if piece in table.added:
            parts.append(np.array([-1 - table.added[piece]], np.int64))
        else:
            parts.append(np.fromiter(map(words.__getitem__, split(piece)), np.int64))
    return np.concatenate(parts)


def encode_texts(texts: list[str], table: PairTable) -> list[bytes]:
    """The ids of each text, as little-endian unsigned 32-bit integers."""
    words = _Words()
    numbered = [_word_numbers(t, words, table) for t in texts]
    ids, begins = merge_words(list(words), table)
    raw, cuts = ids.astype("<u4").tobytes(), (4 * begins).tolist()
    blobs = [raw[a:z] for a, z in zip(cuts, cuts[1:])]
    out = []
    for numbers in numbered:
        if numbers.size and numbers.min() < 0:
            out.append(b"".join(blobs[n] if n >= 0 else (-1 - n).to_bytes(4, "little") for n in numbers.tolist()))
        else:
            out.append(b"".join(map(blobs.__getitem__, numbers.tolist())))
    return out


def _encode(batches: Iterator[pa.RecordBatch], path: str, chunk_chars: int) -> Iterator[pa.RecordBatch]:
    table = pair_table(path)

    def flush(doc_ids: list, texts: list[str]) -> pa.RecordBatch:
        blobs = encode_texts(texts, table)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array([len(b) // 4 for b in blobs], pa.int64()),
             pa.array(blobs, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    doc_ids: list = []
    texts: list[str] = []
    chars = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            doc_ids.append(doc_id)
            texts.append(text.as_py() or "")
            chars += len(texts[-1])
            if chars >= chunk_chars:
                yield flush(doc_ids, texts)
                doc_ids, texts, chars = [], [], 0
    if doc_ids:
        yield flush(doc_ids, texts)


def encode_documents(docs: DataFrame, tokenizer: str, chunk_chars: int = 6_000_000) -> DataFrame:
    """doc_id, n_tokens, ids (binary: little-endian unsigned 32-bit integers) of every row."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(lambda it: _encode(it, tokenizer, chunk_chars), "doc_id bigint, n_tokens bigint, ids binary")


def decode_ids(ids: bytes, table: PairTable) -> str:
    token = table.token_bytes
    return b"".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    table = pair_table(path)
    for batch in batches:
        for a in range(0, batch.num_rows, 500):
            part = batch.slice(a, 500)
            texts = [decode_ids(x.as_buffer(), table) if x.is_valid else None for x in part.column(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                             names=[*part.schema.names, "text"])


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids) with the decoded ``text``."""
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        lambda it: _decode(it, tokenizer), "doc_id bigint, n_tokens bigint, ids binary, text string")

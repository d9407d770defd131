"""Token ids of whole texts by the tokenizers library, with a cache of pre-tokens.

The byte-level BPE encodes every pre-token alone, so a text's ids are the joined ids of
its pre-tokens.  Each Python worker keeps the ids of recent pre-tokens (bounded); only
those it has not seen go through the library.  Texts that hold an added token's string,
and tokenizers with a normalizer or another pre-tokenizer, go through the library whole.
"""

from __future__ import annotations

import functools
import json
import os
import struct

import numpy as np
import pyarrow as pa

from playlake.llm.pretoken import byte_symbols, split_utf8

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: pre-tokens at which a generation of a worker's cache ends (two are held, some 180 bytes an entry, and one
#: piece may add its own), and the longest one kept (bytes)
CACHE_ENTRIES = 300_000
CACHE_BYTES = 48
#: bytes of texts that are split in one pass
TOGETHER = 1 << 20
#: packers of few ids, by their number
_PACK = [struct.Struct(f"<{n}I") for n in range(17)]


class _Ids(dict):
    """pre-token -> its ids as little-endian unsigned 32-bit integers, with the generation ``before``."""

    def __init__(self, encode, before: dict[bytes, bytes] | None = None):
        super().__init__()
        self.encode, self.before = encode, before or {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.encode(word)
        if len(word) <= CACHE_BYTES:
            self[word] = ids
        return ids

    def next(self) -> _Ids:
        """A new generation after this one; that before this one goes."""
        self.before = {}
        return _Ids(self.encode, self)


class Encoder:
    """``ids(text)``: what ``Tokenizer.encode(text, add_special_tokens=False).ids`` gives, as bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        pre = spec.get("pre_tokenizer") or {}
        self.added_bytes = [a.encode() for a in self.added]
        self.by_word = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                        and pre.get("use_regex", True) and not pre.get("add_prefix_space", True))
        self.model = self.tokenizer.model
        self.symbols = {b: s for b, s in enumerate(byte_symbols())}
        self.blank = self.symbols[0x20]
        self.cache = _Ids(self.word)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, word: bytes) -> bytes:
        """Ids of one pre-token, from the library's model: it reads the printable stand-ins of the bytes."""
        symbols = word.decode("latin-1")
        symbols = symbols.replace(" ", self.blank) if word.isascii() and symbols.isprintable() else symbols.translate(self.symbols)
        ids = [t.id for t in self.model.tokenize(symbols)]
        return _PACK[len(ids)].pack(*ids) if len(ids) < len(_PACK) else np.array(ids, "<u4").tobytes()

    def ids(self, text: str | None) -> bytes:
        """Null counts as empty."""
        return self.ids_of(pa.array([text], pa.string()))[0]

    def ids_of(self, texts: pa.Array) -> list[bytes]:
        """``ids`` of each text of an Arrow array; texts are split some ``TOGETHER`` bytes at a time."""
        if texts.null_count:
            texts = texts.fill_null("")
        if not self.by_word:
            return [self.whole(t) for t in texts.to_pylist()]
        n = len(texts)
        if not n or texts.buffers()[2] is None:
            return [b""] * n
        width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        bounds = np.frombuffer(texts.buffers()[1], width)[texts.offset:texts.offset + n + 1].astype(np.int64)
        data = memoryview(texts.buffers()[2])
        found: list[bytes] = []
        a = 0
        while a < n:
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache = self.cache.next()
            get = self.cache.__getitem__
            z = max(a + 1, int(np.searchsorted(bounds, bounds[a] + TOGETHER, "right")) - 1)
            piece = bytes(data[bounds[a]:bounds[z]])
            ids = [b"".join(map(get, words)) for words in split_utf8(piece, bounds[a + 1:z + 1] - bounds[a])]
            if any(t in piece for t in self.added_bytes):
                for k in range(a, z):
                    text = bytes(data[bounds[k]:bounds[k + 1]])
                    if any(t in text for t in self.added_bytes):
                        ids[k - a] = self.whole(text.decode())
            found += ids
            a = z
        return found


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a Python worker; its cache lives as long as the worker."""
    return Encoder(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")

"""Splitting text into the pre-tokens of the byte-level BPE vocabularies.

The pattern (fixed by the vocabulary files) is
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
``split_utf8`` finds the same cuts with array operations over the bytes of many texts: a pre-token
is a run of one class (letter, number, other) with at most one space before it; a run
of white space before a visible character gives up its last character; and a
contraction at the start of a pre-token is cut off.

Texts with code points from U+0530 on (outside U+2000-U+206F), or with white space beyond ASCII, go through the
pattern itself, so the class table stays small and the result exact.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import regex

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_COMPILED = regex.compile(PATTERN)

LETTER, NUMBER, OTHER, SPACE, UNKNOWN = 0, 1, 2, 3, 9
#: the White_Space code points below U+2070
_WHITE = {*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F}
_LIMIT = 0x2070


def _class_table() -> np.ndarray:
    table = np.full(_LIMIT + 1, UNKNOWN, np.uint8)
    for cp in [*range(0x530), *range(0x2000, _LIMIT)]:
        kind = unicodedata.category(chr(cp))
        if cp in _WHITE:
            table[cp] = SPACE
        elif kind[0] == "L":
            table[cp] = LETTER
        elif kind[0] == "N":
            table[cp] = NUMBER
        elif kind != "Cn":
            table[cp] = OTHER
    return table


_TABLE = _class_table()
_BLANK, _QUOTE = 0x20, 0x27


def _classes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each byte of UTF-8 ``data`` (all bytes of a character have its class), and positions of
    characters that need the pattern itself: those outside the table, and white space of several bytes."""
    cls = _TABLE[data]
    hard = np.zeros(0, np.int64)
    lead = np.flatnonzero(data >= 0xC0)
    if lead.size:
        first = data[lead].astype(np.int32)
        two, three, four = first < 0xE0, (first >= 0xE0) & (first < 0xF0), first >= 0xF0
        cp = np.full(lead.size, _LIMIT, np.int32)
        at = lead[two]
        cp[two] = (first[two] & 0x1F) << 6 | data[at + 1] & 0x3F
        cls[at + 1] = cls[at] = _TABLE[cp[two]]
        at = lead[three]
        cp[three] = np.minimum((first[three] & 0x0F) << 12 | (data[at + 1] & 0x3F).astype(np.int32) << 6 | data[at + 2] & 0x3F, _LIMIT)
        cls[at + 2] = cls[at + 1] = cls[at] = _TABLE[cp[three]]
        at = lead[four]
        cls[at + 3] = cls[at + 2] = cls[at + 1] = cls[at] = UNKNOWN
        hard = lead[(cls[lead] == UNKNOWN) | (cls[lead] == SPACE)]
    return cls, hard


def split_utf8(data: bytes, ends: np.ndarray) -> list[list[bytes]]:
    """Pre-tokens of the texts that stand one after another in the UTF-8 ``data``; ``ends``: where each ends."""
    n = len(data)
    if not n:
        return [[] for _ in ends]
    raw = np.frombuffer(data, np.uint8)
    cls, hard = _classes(raw)
    inner = ends[:-1][(ends[:-1] > 0) & (ends[:-1] < n)]          # where a text follows another
    # starts[i]: a pre-token begins at byte i
    starts = np.empty(n + 1, bool)
    starts[0] = starts[n] = True
    np.not_equal(cls[:-1], cls[1:], out=starts[1:-1])
    white = cls == SPACE
    after_white = white[:-1] & ~white[1:]          # i+1 is visible, i is white space
    after_white[inner - 1] = False
    starts[1:-1][after_white & (raw[:-1] == _BLANK)] = False      # the blank belongs to what follows
    # the last white-space character before a visible one is a pre-token of its own (or glued)
    starts[:-2][after_white] = True
    starts[inner] = True
    quotes = np.flatnonzero(raw == _QUOTE)
    if quotes.size:
        _contractions(data, ends, starts, quotes[starts[quotes]])
    cuts = np.flatnonzero(starts)
    at = cuts.tolist()
    begins = np.concatenate([[0], ends[:-1]])
    found = [[data[a:z] for a, z in zip(at[i:j], at[i + 1:j + 1])]
             for i, j in zip(np.searchsorted(cuts, begins).tolist(), np.searchsorted(cuts, ends).tolist())]
    for k in np.unique(np.searchsorted(ends, hard, "right")).tolist():
        found[k] = [w.encode() for w in _COMPILED.findall(data[begins[k]:ends[k]].decode())]
    return found


def split(text: str) -> list[bytes]:
    """Pre-tokens of ``text`` in UTF-8, in order; joined they give ``text``.  Empty text: []."""
    if len(text) < 40:
        return [w.encode() for w in _COMPILED.findall(text)]
    data = text.encode()
    return split_utf8(data, np.array([len(data)]))[0]


def _contractions(data: bytes, ends: np.ndarray, starts: np.ndarray, quotes: np.ndarray) -> None:
    """Cut contractions off where a quote begins a pre-token."""
    for q, stop in zip(quotes.tolist(), ends[np.searchsorted(ends, quotes, "right")].tolist()):
        if data[q + 1:min(q + 2, stop)] in (b"s", b"t", b"m", b"d"):
            end = q + 2
        elif data[q + 1:min(q + 3, stop)] in (b"re", b"ve", b"ll"):
            end = q + 3
        else:
            continue
        starts[q + 1:end] = False
        starts[end] = True                           # what follows begins anew, also inside a run of letters


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: visible Latin-1
    characters stand for themselves, the others get U+0100 on, in order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols, extra = [], 0x100
    for b in range(256):
        if b in visible:
            symbols.append(chr(b))
        else:
            symbols.append(chr(extra))
            extra += 1
    return symbols

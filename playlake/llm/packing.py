"""Sum-of-squares packing of token sequences.

Every document becomes its ids plus an end id; only documents longer than a sequence are
cut into whole-sequence pieces, the first piece being the short one.  Pieces are packed by
the sum-of-squares rule: a piece goes to the open bin (or a new one) that leaves the sum,
over residual gaps, of the squared number of open bins with that gap smallest.

Pieces are dealt by hash into groups of about ``group_pieces`` and each group is packed by
its own task.  Bins that stay emptier than ``keep_fill`` are opened again and their
pieces packed once more, dealt anew into fewer groups (``rounds`` in all), so what a
group could not fill meets the leftovers of others, without the open bins of the first time.  The state of a group is a counter per gap.

Edge cases: a null text counts as empty (one piece of the end id); rows that share a doc_id
(or have none) are dealt by a stored row id, so no key fills a group; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm.common import materialize
from playlake.llm.tokens import encoder

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, row bigint"
_PACKED = _PIECES + ", sequence_id bigint, offset bigint, filled bigint"


def _cut(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, size: int) -> Iterator[pa.RecordBatch]:
    enc = encoder(tokenizer)
    end = np.array([end_id], "<u4").tobytes()
    for batch in batches:
        docs, piece, start, length, crc, row = [], [], [], [], [], []
        for doc_id, raw, number in zip(batch.column(0).to_pylist(), enc.ids_of(batch.column(1)), batch.column(2).to_pylist()):
            ids = raw + end
            n = len(ids) // 4
            at, k, first = 0, 0, n % size or size
            while at < n:
                z = at + (first if k == 0 else size)
                docs.append(doc_id)
                piece.append(k)
                start.append(at)
                length.append(z - at)
                crc.append(zlib.crc32(ids[4 * at:4 * z]))
                row.append(number)
                at, k = z, k + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
             pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(row, pa.int64())],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "row"])


def cut_documents(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, row of every piece; ``row`` tells rows of ``docs`` apart once stored."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.monotonically_increasing_id().alias("row"))
    return plain.mapInArrow(lambda it: _cut(it, tokenizer, end_id, size), _PIECES)


def sum_of_squares(lengths: np.ndarray, size: int) -> np.ndarray:
    """The bin (numbered from 0) of each length, in the order given."""
    open_bins = np.zeros(size + 1, np.int64)             # by residual gap; full bins don't count
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    placed = np.empty(lengths.size, np.int64)
    bins, never = 0, np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        # change of the sum of squares when a bin of gap g becomes one of gap g - s
        from_gap = open_bins[s:size]
        change = 2 * (open_bins[:size - s] - from_gap) + 2
        if change.size:
            change[0] -= 1                               # a bin that becomes full leaves the count
            change[from_gap == 0] = never
            k = int(change.argmin())
            best = int(change[k])
        else:
            k, best = -1, never
        fresh = 2 * int(open_bins[size - s]) + 1 if s < size else 0
        if best <= fresh and best != never:
            gap, rest = k + s, k
            b = stacks[gap].pop()
            open_bins[gap] -= 1
        else:
            rest, b = size - s, bins
            bins += 1
        if rest:
            open_bins[rest] += 1
            stacks[rest].append(b)
        placed[i] = b
    return placed


def _pack_group(key: tuple, table: pa.Table, size: int, round_no: int) -> pa.Table:
    cols = {c: table.column(c).to_numpy(zero_copy_only=False) for c in ("piece", "start", "length", "ids_crc32")}
    docs = table.column("doc_id").to_pandas()            # may hold nulls
    length = cols["length"].astype(np.int64)
    order = np.lexsort((cols["ids_crc32"], cols["start"], docs.fillna(-1).to_numpy(np.int64), -length))
    placed = np.empty(length.size, np.int64)
    placed[order] = sum_of_squares(length[order], size)
    by_bin = np.lexsort((np.arange(length.size), placed))
    at = np.cumsum(length[by_bin]) - length[by_bin]
    first = np.r_[True, placed[by_bin][1:] != placed[by_bin][:-1]]
    offset = np.empty(length.size, np.int64)
    offset[by_bin] = at - np.maximum.accumulate(np.where(first, at, 0))
    filled = np.bincount(placed, weights=length).astype(np.int64)[placed]
    group = key[0].as_py()
    seq = (np.int64(round_no) << 56) | (np.int64(group) << 32) | placed
    for name, values in (("sequence_id", seq), ("offset", offset), ("filled", filled)):
        table = table.append_column(name, pa.array(values, pa.int64()))
    return table.select([c.split()[0] for c in _PACKED.split(", ")])


def _packer(size: int, round_no: int):
    def pack(key: tuple, table: pa.Table) -> pa.Table:
        return _pack_group(key, table, size, round_no)
    return pack


def pack_pieces(pieces: DataFrame, size: int = 2048, group_pieces: int = 40_000, keep_fill: float = 0.97,
                rounds: int = 3) -> DataFrame:
    """``pieces`` with sequence_id and offset.  ``pieces`` should be a stored table: it is read again."""
    done: list[DataFrame] = []
    todo = pieces.select(*(c.split()[0] for c in _PIECES.split(", ")))
    for r in range(rounds):
        n = todo.count()
        if r and not n:
            break
        groups = max(1, -(-n // group_pieces))
        dealt = todo.withColumn("_group", F.pmod(F.xxhash64("row", "piece", F.lit(r)), F.lit(groups)))
        packed = materialize(
            dealt.groupBy("_group").applyInArrow(_packer(size, r), _PACKED), f"packed-{r}")
        last = r == rounds - 1
        full = F.col("filled") >= int(keep_fill * size)
        done.append(packed if last else packed.filter(full))
        if last:
            break
        todo = packed.filter(~full).select(*(c.split()[0] for c in _PIECES.split(", ")))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.drop("filled", "row")


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, **options) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs``."""
    return pack_pieces(materialize(cut_documents(docs, tokenizer, size, end_id), "pieces"), size, **options)

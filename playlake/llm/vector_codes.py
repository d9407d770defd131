"""Vector code compression: k-means codebooks per part, assigned with Drake-Hamerly adaptive bounds.

A vector's components become integers floor(scale * x); the vector is cut into equal parts, and
each part position has a codebook of integer entries.  A round assigns every part to its nearest
entry (squared Euclidean distance, ties to the lower index) and moves each entry to the floored
mean of its parts; after the last round the parts are assigned once more.

The first assignment measures all entries.  Beside the code it stores, for each part, an upper
bound of the distance to its entry, the b next closest entries with lower bounds in ascending
order, and one outer lower bound for all others.  A later assignment loosens the bounds by how far
entries moved.  Where the upper bound is below all others the code stands without a distance.  Else the
distance to the own entry is measured; then, if needed, those to the tracked entries whose bounds do not
exclude them; and only where the outer bound does not hold either, all.  Bounds are floating-point
numbers rounded outwards and must hold strictly; every case they leave open, ties among them, is
decided by integer distances.  b starts at a quarter of the entries; after each round it
shrinks, for each part position, to what 99 % of the parts needed, an eighth of the entries at least.

Spark holds the state (one row a vector, in a table under the checkpoint folder after each assignment)
and adds up counts and sums per entry.  The driver and the tasks hold the codebooks only:
``entries`` times the vector's length, whatever the number of rows.

Edge cases: vectors that are null, or hold null or non-finite components, are dropped.  Vectors
that cannot be coded stay, with null code and error: those of another length than the table's (the most
common one that ``parts`` divides; ties: the shorter) and those with a scaled
component of sqrt(2^60 / length) or more (2^27 at 64 components), whose errors might not fit a
long; neither touches the codebooks.  Repeated rows count each.  The first entries
come from the smallest vec_ids (nulls last; equal ids in the order of their integers); with fewer
vectors there are fewer entries.  A label's sum that does not fit a long is null.  An empty table gives no
rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm.common import materialize

#: rows measured at once
ROWS = 2_048
#: share of the parts that the tracked entries of the next round should do for
ENOUGH = 0.99


# ---------------------------------------------------------------- bounds

def _up(x: np.ndarray) -> np.ndarray:
    """float32 numbers that are not below ``x``."""
    return np.nextafter((x * (1 + 1e-9)).astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    """float16 numbers from 0 that are not above ``x`` (where that is positive)."""
    y = np.clip(x * (1 - 1e-9), 0, 65504).astype(np.float16)
    return np.where(y > 0, np.nextafter(y, np.float16(0)), y)


def _squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Integer squared distances of the rows of ``x`` to the rows of ``entries`` (or of each to its own)."""
    return np.square(x - entries).sum(axis=-1)


def track_all(x: np.ndarray, book: np.ndarray, b: int) -> tuple[np.ndarray, ...]:
    """Code, squared distance, upper bound, the b next closest entries, their lower bounds, outer bound; all by measuring."""
    d = _squares(x[:, None, :], book[None])
    order = np.argsort(d, axis=1, kind="stable")          # stable: ties keep the lower index first
    ranked = np.take_along_axis(d, order, axis=1)
    code, near = order[:, 0], order[:, 1:b + 1]
    root = np.sqrt(ranked.astype(np.float64))
    outer = root[:, b + 1] if b + 1 < book.shape[0] else np.full(len(x), 65504.0)
    return (code.astype(np.uint8), ranked[:, 0], _up(root[:, 0]), near.astype(np.uint8),
            _down(root[:, 1:b + 1]), _down(outer))


def track_again(x: np.ndarray, book: np.ndarray, moves: np.ndarray, code: np.ndarray, upper: np.ndarray,
                near: np.ndarray, low: np.ndarray, outer: np.ndarray) -> tuple[np.ndarray, ...]:
    """The same after the entries moved by ``moves``, measuring only what the bounds leave open, and how
    many tracked entries each part needed (all plus one: measured in full).  A squared distance
    that was not needed is -1."""
    b, n = near.shape[1], len(x)
    code, near = code.astype(np.int64), near.astype(np.int64)
    up = upper.astype(np.float64) + moves[code]
    low = np.maximum(low.astype(np.float64) - moves[near], 0)
    outer = np.where(outer >= 65504, np.inf if b + 1 >= book.shape[0] else 65504.0, outer.astype(np.float64)) - moves.max()
    outer = np.maximum(outer, 0)
    least = np.minimum(low.min(axis=1, initial=np.inf), outer)
    squared, depth = np.full(n, -1, np.int64), np.zeros(n, np.uint8)
    open_ = np.flatnonzero(up >= least)
    squared[open_] = _squares(x[open_], book[code[open_]])
    up[open_] = _up(np.sqrt(squared[open_].astype(np.float64)))
    open_ = open_[up[open_] >= least[open_]]
    full = open_[up[open_] >= outer[open_]]
    some = open_[up[open_] < outer[open_]]
    if some.size:
        asked = low[some] <= up[some, None]
        depth[some] = asked.sum(axis=1)
        r, c = np.nonzero(asked)
        row = some[r]
        d = _squares(x[row], book[near[row, c]])
        low[row, c] = np.sqrt(d.astype(np.float64)) * (1 - 1e-9)
        # least (distance, entry) of a part: rows come in order, so the first of each after sorting
        order = np.lexsort((near[row, c], d, r))
        first = order[np.concatenate([[True], r[order][1:] != r[order][:-1]])]
        row, c, d = row[first], c[first], d[first]
        better = (d < squared[row]) | ((d == squared[row]) & (near[row, c] < code[row]))
        row, c, d = row[better], c[better], d[better]
        own = np.sqrt(squared[row].astype(np.float64)) * (1 - 1e-9)
        code[row], near[row, c] = near[row, c], code[row]
        low[row, c], squared[row] = own, d
        up[row] = _up(np.sqrt(d.astype(np.float64)))
    order = np.argsort(low, axis=1, kind="stable")
    near, low = np.take_along_axis(near, order, axis=1), np.take_along_axis(low, order, axis=1)
    out = [code.astype(np.uint8), squared, _up(up), near.astype(np.uint8), _down(low), _down(np.minimum(outer, 65504))]
    if full.size:
        depth[full] = b + 1
        for have, new in zip(out, track_all(x[full], book, b)):
            have[full] = new
    return (*out, depth)


# ---------------------------------------------------------------- tasks

#: what an assignment leaves beside the carried columns and the integers
STATE = "code binary, upper binary, near binary, low binary, outer binary, depth binary"


def _binary(rows: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(rows)
    width = data.shape[1] * data.itemsize
    offsets = np.arange(len(data) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


def _rows(column: pa.Array, dtype, width: int) -> np.ndarray:
    """The equally long binaries of a column as the rows of an array."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width)


def _parts(ints: np.ndarray, books: np.ndarray) -> np.ndarray:
    return ints.reshape(len(ints), books.shape[0], -1).astype(np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            yield batch.slice(a, ROWS)


def _widths(b: list[int]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(b)])


def _retrack(batch: pa.RecordBatch, books: np.ndarray, moves: np.ndarray | None, b: list[int], kept: list[int]):
    """Arrays of the state of each part position; ``b``: entries tracked now, ``kept``: stored in ``batch``."""
    parts = books.shape[0]
    x = _parts(_rows(batch.column(2), np.int32, books.shape[0] * books.shape[2]), books)
    if moves is None:
        return x, [(*track_all(x[:, p], books[p], b[p]), np.zeros(len(x), np.uint8)) for p in range(parts)]
    at = _widths(kept)
    code, upper = _rows(batch.column(3), np.uint8, parts), _rows(batch.column(4), np.float32, parts)
    near, low = _rows(batch.column(5), np.uint8, at[-1]), _rows(batch.column(6), np.float16, at[-1])
    outer = _rows(batch.column(7), np.float16, parts)
    done = []
    for p in range(parts):
        n, lo, out = near[:, at[p]:at[p + 1]], low[:, at[p]:at[p + 1]], outer[:, p]
        if b[p] < kept[p]:                               # entries no longer tracked go under the outer bound
            out = np.minimum(out, lo[:, b[p]])
            n, lo = n[:, :b[p]], lo[:, :b[p]]
        done.append(track_again(x[:, p], books[p], moves[p], code[:, p], upper[:, p], n, lo, out))
    return x, done


def _assign(batches: Iterator[pa.RecordBatch], books: np.ndarray, moves: np.ndarray | None, b: list[int],
            kept: list[int]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        done = _retrack(batch, books, moves, b, kept)[1]
        code, _, upper, near, low, outer, depth = zip(*done)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], *(_binary(np.stack(s, axis=1)) for s in (code, upper)),
             *(_binary(np.concatenate(s, axis=1)) for s in (near, low)),
             *(_binary(np.stack(s, axis=1)) for s in (outer, depth))],
            names=["vec_id", "label", "ints", "code", "upper", "near", "low", "outer", "depth"])


def _finish(batches: Iterator[pa.RecordBatch], books: np.ndarray, moves: np.ndarray | None, b: list[int],
            kept: list[int]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        x, done = _retrack(batch, books, moves, b, kept)
        error = np.zeros(len(x), np.int64)
        for p, (code, squared, *_) in enumerate(done):
            open_ = squared < 0
            squared[open_] = _squares(x[open_, p], books[p][code[open_]])
            error += squared
        codes = np.stack([s[0] for s in done], axis=1)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error)],
            names=["vec_id", "label", "code", "error"])


def _tally(batches: Iterator[pa.RecordBatch], shape: tuple[int, int, int], most: int) -> Iterator[pa.RecordBatch]:
    """Counts and sums of a task's parts per entry, and how many parts needed how many tracked entries."""
    parts, entries, width = shape
    counts, sums = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
    depths = np.zeros(parts * (most + 2), np.int64)
    for batch in _slices(batches):
        x = _rows(batch.column(0), np.int32, parts * width).reshape(-1, width)
        code = (_rows(batch.column(1), np.uint8, parts) + np.arange(parts) * entries).ravel()
        depth = (_rows(batch.column(2), np.uint8, parts) + np.arange(parts) * (most + 2)).ravel()
        counts += np.bincount(code, minlength=counts.size)
        depths += np.bincount(depth, minlength=depths.size)
        for k in range(width):                           # exact: a slice's sums stay far below 2^53
            sums[:, k] += np.bincount(code, x[:, k], minlength=counts.size).astype(np.int64)
    used = np.flatnonzero(counts)
    needed = np.flatnonzero(depths)
    cells = [(used * (width + 1), counts[used]), *((used * (width + 1) + 1 + k, sums[used, k]) for k in range(width)),
             (needed, depths[needed])]
    kind = np.concatenate([np.full(len(c), k == width + 1) for k, (c, _) in enumerate(cells)])
    yield pa.RecordBatch.from_arrays(
        [pa.array(kind), pa.array(np.concatenate([c for c, _ in cells])), pa.array(np.concatenate([v for _, v in cells]))],
        names=["is_depth", "cell", "value"])


# ---------------------------------------------------------------- rounds

def _moved(books: np.ndarray, state: DataFrame, b: list[int], adapt: bool) -> tuple[np.ndarray, list[int]]:
    """The codebooks after a round, and how many entries the next one tracks (``adapt``: by need)."""
    parts, entries, width = books.shape
    most = max(b)
    rows = (state.select("ints", "code", "depth")
            .mapInArrow(lambda it: _tally(it, (parts, entries, width), most), "is_depth boolean, cell long, value long")
            .groupBy("is_depth", "cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect())
    sums = {r["cell"]: int(r["value"]) for r in rows if not r["is_depth"]}
    depths = {r["cell"]: int(r["value"]) for r in rows if r["is_depth"]}
    new = books.copy()
    for e in range(parts * entries):
        if n := sums.get(e * (width + 1), 0):
            new[divmod(e, entries)] = [sums[e * (width + 1) + 1 + k] // n for k in range(width)]
    kept = []
    for p in range(parts):
        seen = [depths.get(p * (most + 2) + k, 0) for k in range(most + 2)]
        enough = next(k for k in range(most + 2) if sum(seen[:k + 1]) >= ENOUGH * sum(seen))
        kept.append(min(b[p], max(1, entries // 8, enough)) if adapt else b[p])
    return new, kept


def books_sha256(books: np.ndarray) -> str:
    """SHA-256 of the entries' decimal components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2,
             scale: int = 256) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error, label_error of every row kept; the codebooks by part, entry and position).

    ``vectors``: vec_id, embedding (array of numbers), label.  ``entries`` is 256 at most.
    """
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    dim = F.size("embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    limit = F.floor(F.sqrt(F.lit(float(1 << 60)) / F.greatest(dim, F.lit(1))))
    small = F.forall("embedding", lambda x: F.abs(x.cast("double") * scale) < limit - 1)
    whole = materialize(
        vectors.filter(F.col("embedding").isNotNull()).filter(finite)
        .select("vec_id", "label", dim.alias("dim"), F.when(small, scaled).cast("array<int>").alias("ints")), "codes-ints")
    lengths = (whole.filter(F.col("ints").isNotNull() & (F.col("dim") > 0) & (F.col("dim") % parts == 0))
               .groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect())
    size = lengths[0]["dim"] if lengths else 0
    fits = F.col("ints").isNotNull() & (F.col("dim") == F.lit(size)) & F.lit(size > 0)
    label = whole.schema["label"].dataType.simpleString()
    key = whole.schema["vec_id"].dataType.simpleString()
    alone = whole.filter(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    if not size:
        return _with_label_error(alone), np.zeros((parts, 0, 0), np.int64)

    first = whole.filter(fits).orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    books = np.array([r["ints"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    carried = f"vec_id {key}, label {label}"
    state = whole.filter(fits).select("vec_id", "label", "ints").mapInArrow(_packed, f"{carried}, ints binary")
    b = [min(255, len(first) - 1, max(1, len(first) // 4))] * parts
    kept, moves = b, None
    for _ in range(rounds):
        state = materialize(state.mapInArrow(_with(_assign, books, moves, b, kept), f"{carried}, ints binary, {STATE}"), "codes-state")
        old, kept = books, b
        books, b = _moved(books, state, b, adapt=moves is not None)
        moves = np.sqrt(_squares(books, old).astype(np.float64)) * (1 + 1e-9)
    done = state.mapInArrow(_with(_finish, books, moves, b, kept), f"{carried}, code string, error long")
    return _with_label_error(materialize(done.unionByName(alone), "codes")), books


def _with(task, *args):
    """``task`` with these arguments, fixed now: the caller's names change each round."""
    return lambda batches: task(batches, *args)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ints = batch.column(2)
        rows = ints.flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(len(ints), -1)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], _binary(rows)], names=["vec_id", "label", "ints"])


def _with_label_error(done: DataFrame) -> DataFrame:
    """Adds each label's summed error: one row a label joins back, split or broadcast by what it weighs."""
    sums = done.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"))
    return (done.join(sums, F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", "label", "code", "error", "label_error"))

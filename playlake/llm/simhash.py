"""SimHash near-duplicates, found exactly with vantage-point trees.

Fingerprints: bit b of a text's fingerprint is set when more than half of its word
shingles have bit b in their XXH64 (seed 42).  Texts are lower-cased A-Z only; shingles are
``shingle_words`` words joined by one space, repeats included; shorter texts are one shingle, and
texts without words have fingerprint zero.

Pairs within ``max_bits`` differing bits: distinct fingerprints are dealt to the leaves of
an upper vantage-point tree, whose vantage points and radii come from a bounded sample
(they steer only the size of the shards, never the result).  A fingerprint lives in one leaf and is
sent as a query to every leaf that the triangle inequality cannot rule out, so pairs
across a boundary are met too.  Each leaf is a task that builds a vantage-point tree over its
own fingerprints, answers its queries with it and returns a spanning forest of the links
it found, never the pairs themselves.  Forests are joined by ``connected_components``.

Edge cases: a null text has no words; repeated rows and equal texts share a fingerprint and are
one component; a null doc_id takes part but names a component only where all its ids are
null; ``keep_one`` tells components apart by their smallest fingerprint, so null and
repeated ids lose no component; an empty table gives no rows; extra columns are carried by
``keep_one`` only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm.common import materialize, unpacked, whole_row
from playlake.llm.components import connected_components

SEED = 42
#: shingles whose bits are counted at once
_CHUNK = 1 << 16


def fingerprint(text: bytes, shingle_words: int) -> int:
    words = text.lower().split()                     # bytes: A-Z and ASCII white space only
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle_words:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(sizes + 1) - 1
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:z], SEED)
                  for a, z in zip((ends - sizes).tolist(), ends[shingle_words - 1:].tolist())]
    values = np.array(hashes, ">u8")
    ones = np.zeros(64, np.int64)
    for a in range(0, values.size, _CHUNK):
        bits = np.unpackbits(values[a:a + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > values.size).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(t.as_py() or b"", shingle_words) for t in batch.column(1)]
        values = np.array(found, np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(values)],
                                         names=["doc_id", "text_hash", "fp"])


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """doc_id, text_hash, fp (the 64 bits as a signed long) of every row."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.encode(F.col("text").cast("string"), "UTF-8").alias("bytes"),
                        F.xxhash64("text").alias("text_hash"))
    return plain.mapInArrow(lambda it: _fingerprints(it, shingle_words), "doc_id bigint, text_hash bigint, fp bigint")


# ---------------------------------------------------------------- vantage-point trees

def _distance(values: np.ndarray, point: int) -> np.ndarray:
    return np.bitwise_count(values ^ np.uint64(point)).astype(np.int64)


def _vantage(values: np.ndarray) -> tuple[int, int] | None:
    """A vantage point and radius that cut ``values`` in two; None where no point does."""
    best = None
    for point in values[np.linspace(0, values.size - 1, min(8, values.size)).astype(int)].tolist():
        d = _distance(values, point)
        radius = int(np.median(d))
        near = int((d <= radius).sum())
        if near == values.size:
            radius = int(d.max()) - 1
            near = int((d <= radius).sum())
        # a wide spread of distances prunes more; halves keep the tree low
        if 0 < near < values.size:
            score = float(d.std()) * min(near, values.size - near)
            if best is None or score > best[0]:
                best = (score, point, radius)
    return best and best[1:]


class Tree:
    """Nodes of a vantage-point tree: (point, radius, near child, far child) or a leaf's values."""

    def __init__(self, values: np.ndarray, leaf: int):
        self.leaf = leaf
        self.nodes: list = []
        self.build(values)

    def build(self, values: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append(None)
        cut = _vantage(values) if values.size > self.leaf else None
        if cut is None:
            self.nodes[at] = values
            return at
        near = _distance(values, cut[0]) <= cut[1]
        self.nodes[at] = (*cut, self.build(values[near]), self.build(values[~near]))
        return at

    def visit(self, queries: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf number, indices of the queries that may have a match within ``reach`` there)."""
        todo = [(0, np.arange(queries.size))]
        while todo:
            at, own = todo.pop()
            node = self.nodes[at]
            if isinstance(node, np.ndarray):
                yield at, own
                continue
            point, radius, near, far = node
            d = _distance(queries[own], point)
            for child, goes in ((near, d - reach <= radius), (far, d + reach > radius)):
                if goes.any():
                    todo.append((child, own[goes]))


def _forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For each of ``n`` items the smallest item that links reach."""
    root = np.arange(n)
    while True:
        a, b = root[u], root[v]
        if (a == b).all():
            return root
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _route(batches: Iterator[pa.RecordBatch], tree: Tree, reach: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column(0).to_numpy().view(np.uint64)
        home = np.empty(values.size, np.int64)
        for leaf, own in tree.visit(values, 0):       # reach 0: exactly one leaf
            home[own] = leaf
        for leaf, own in tree.visit(values, reach):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(own.size, leaf, np.int32)), pa.array(values[own].view(np.int64)),
                 pa.array(home[own] == leaf)], names=["shard", "fp", "home"])


def _links(reach: int, leaf_size: int, cells: int):
    def links(key: tuple, table: pa.Table) -> pa.Table:
        values = table.column("fp").to_numpy().view(np.uint64)
        home = table.column("home").to_numpy(zero_copy_only=False)
        order = np.argsort(values)                    # distinct: each is once in a leaf
        values, home = values[order], home[order]
        own = values[home]
        root = np.arange(values.size)
        tree = Tree(own, leaf_size)
        us: list[np.ndarray] = []
        vs: list[np.ndarray] = []

        def settle() -> None:
            nonlocal root
            if us:
                u, v = np.concatenate([*us, np.arange(values.size)]), np.concatenate([*vs, root])
                root = _forest(values.size, u, v)
                us.clear()
                vs.clear()

        held = 0
        for leaf, asked in tree.visit(values, reach):
            members = tree.nodes[leaf]
            at = np.searchsorted(values, members)
            step = max(1, cells // max(1, members.size))
            for a in range(0, asked.size, step):
                q = asked[a:a + step]
                close = np.bitwise_count(values[q][:, None] ^ members[None, :]) <= reach
                i, j = np.nonzero(close)
                u, v = q[i], at[j]
                differ = u != v
                us.append(u[differ])
                vs.append(v[differ])
                held += int(differ.sum())
                if held > cells:                      # links stay bounded
                    settle()
                    held = 0
        settle()
        linked = np.flatnonzero(root != np.arange(values.size))
        return pa.table({"u": pa.array(values[linked].view(np.int64)), "v": pa.array(values[root[linked]].view(np.int64))})
    return links


def near_links(fps: DataFrame, max_bits: int = 2, shard_size: int = 8_000, sample: int = 8_192,
               leaf_size: int = 48) -> DataFrame:
    """u, v: links that join all of ``fps`` (column fp, distinct) within ``max_bits``, directly or on the way.

    A pair within the distance is connected by the returned links; not every pair is listed.
    """
    n = fps.count()
    # the sample only shapes the upper tree: the smallest hashes
    rows = fps.orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()
    values = np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))
    tree = Tree(values, max(1, int(values.size * shard_size / max(n, 1)))) if values.size else Tree(values, 1)
    routed = fps.select("fp").mapInArrow(lambda it: _route(it, tree, max_bits), "shard int, fp bigint, home boolean")
    return routed.groupBy("shard").applyInArrow(_links(max_bits, leaf_size, 1 << 20), "u bigint, v bigint")


def _with_components(docs: DataFrame, shingle_words: int, max_bits: int, **options) -> DataFrame:
    """doc_id, text_hash, fp, root, component_id of every row; ``root``, a fingerprint, identifies the component."""
    rows = materialize(fingerprints(docs, shingle_words), "fingerprints")
    classes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-classes")
    roots = connected_components(near_links(classes.select("fp"), max_bits, **options))
    joined = (classes.join(roots, classes["fp"] == roots["node"], "left")
              .select("fp", F.coalesce("root", "fp").alias("root"), "first_id"))
    ids = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = joined.join(ids, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2, **options) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id that links reach) of every row."""
    return _with_components(docs, shingle_words, max_bits, **options).drop("text_hash", "root")


def keep_one(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2, **options) -> DataFrame:
    """One row of each component of ``docs``, that with the smallest doc_id, with all its columns.

    Of rows of the component that share this doc_id (or have none, where it has no ids) the one
    with the smallest text hash stays, and of rows equal in both any one.
    """
    found = _with_components(docs, shingle_words, max_bits, **options)
    kept = materialize(found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
                       .groupBy("root").agg(F.min("component_id").alias("_id"), F.min("text_hash").alias("_hash"),
                                            F.count("*").alias("_rows")), "near-kept")
    keyed = docs.select(whole_row(docs).alias("packed"), F.col("doc_id").cast("long").alias("_id"),
                        F.xxhash64("text").alias("_hash"))
    same = keyed["_id"].eqNullSafe(kept["_id"]) & (keyed["_hash"] == kept["_hash"])
    out = keyed.join(kept.select("_id", "_hash"), same, "left_semi")
    if kept.filter("_rows > 1").head(1):             # a doc_id on several rows of its component
        out = out.dropDuplicates(["_id", "_hash"])
    return unpacked(out, "packed", docs.columns)


def to_hex(fp):
    """A signed long as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")

"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors are compared only when their labels are equal.  Equal vectors of a label are one
class.  Class vectors are scaled to length 1 and turned into the axes of their second-moment
matrix (over all vectors, summed in Spark), largest variance first; a rotation keeps
cosines.  Vectors of a label are dealt into blocks by ranges of the first coordinate, and two
blocks meet in one task (a tile) unless their first coordinates are too far apart for the
threshold.  A tile adds up the products of the leading dimensions first.  What the rest can
still add is at most the product of the suffix norms, so a pair is given up as soon as the sum and
that bound stay below the threshold.  Pairs that reach the end are decided by their cosine in
double precision from the vectors as given.

A tile returns, for each class, how many vectors it links to there and the smallest class that
links reach inside the tile: never the pairs.  Links are counted with partial sums, and
components come from ``connected_components``.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components, and
vectors with a null label, link with nothing and are components of their own; vectors of different
length never link; a null vec_id takes part but names no component; repeated rows are vectors
of their own and link with each other; an empty table gives no rows; other columns are not read.
Components may be as large or small as doubles are: vectors are scaled by a power of two first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlake.llm.common import materialize
from playlake.llm.components import connected_components
from playlake.llm.simhash import _forest

#: width of the cells of the first coordinate
CELL = 1 / 32
#: what rounding can change in a sum of products of unit vectors
SLACK = 1e-9
#: leading dimensions of the first step; later steps double
FIRST_STEP = 8


def _double(values: pa.Array) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors as rows, each times the power of two that brings its largest component to [0.5, 1): exact
    for cosines, and no square vanishes or overflows."""
    x = _double(column).reshape(len(column), -1)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Second moments of the unit vectors of a partition: dim, cell, value."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        dims = np.diff(batch.column(0).offsets.to_numpy())
        for dim in np.unique(dims).tolist():
            x = _matrix(batch.column(0).filter(pa.array(dims == dim)))
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            sums[dim] = sums.get(dim, 0) + x.T @ x
    for dim, m in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(dim * dim, dim, np.int32)), pa.array(np.arange(dim * dim, dtype=np.int32)),
             pa.array(m.ravel())], names=["dim", "cell", "value"])


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length the axes as columns, largest second moment first.

    What reaches the driver is one matrix of dim x dim numbers for each length.
    """
    sums = (vectors.select("embedding").mapInArrow(_moments, "dim int, cell int, value double")
            .groupBy("dim", "cell").agg(F.sum("value").alias("value")).collect())
    by_dim: dict[int, np.ndarray] = {}
    for dim, cell, value in sums:
        by_dim.setdefault(dim, np.zeros(dim * dim))[cell] = value
    return {dim: np.linalg.eigh(m.reshape(dim, dim))[1][:, ::-1].copy() for dim, m in by_dim.items()}


def _rotate(batches: Iterator[pa.RecordBatch], axes: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims = np.diff(batch.column(0).offsets.to_numpy())
        for dim in np.unique(dims).tolist():
            part = batch.filter(pa.array(dims == dim))
            raw = _matrix(part.column(0))
            x = (raw / np.linalg.norm(raw, axis=1, keepdims=True)) @ axes[dim]
            cells = np.floor(x[:, 0] / CELL).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[1:], pa.array(np.full(part.num_rows, dim, np.int32)), pa.array(cells),
                 pa.array([r.tobytes() for r in raw], pa.binary()), pa.array([r.tobytes() for r in x], pa.binary())],
                names=[*part.schema.names[1:], "dim", "cell", "raw", "turned"])


def close_pairs(a: np.ndarray, b: np.ndarray, raw_a: np.ndarray, raw_b: np.ndarray, threshold: float,
                same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs of rows with cosine >= threshold; with ``same`` only i < j."""
    dim = a.shape[1]
    rest_a = np.sqrt(np.maximum(np.cumsum((a * a)[:, ::-1], axis=1)[:, ::-1], 0))
    rest_b = np.sqrt(np.maximum(np.cumsum((b * b)[:, ::-1], axis=1)[:, ::-1], 0))
    at, sums = min(FIRST_STEP, dim), None
    sums = a[:, :at] @ b[:, :at].T
    bound = np.multiply.outer(rest_a[:, at], rest_b[:, at]) if at < dim else 0.0
    alive = sums + bound >= threshold - SLACK
    if same:
        alive &= np.triu(np.ones(alive.shape, bool), 1)
    # while many pairs are left whole blocks are multiplied, then single pairs
    while at < dim and alive.mean() > 0.05:
        to = min(dim, 2 * at)
        sums += a[:, at:to] @ b[:, at:to].T
        at = to
        if at < dim:
            alive &= sums + np.multiply.outer(rest_a[:, at], rest_b[:, at]) >= threshold - SLACK
    i, j = np.nonzero(alive)
    s = sums[i, j]
    while at < dim and i.size:
        to = min(dim, 2 * at)
        s = s + np.einsum("ij,ij->i", a[i, at:to], b[j, at:to])
        at = to
        left = s + (rest_a[i, at] * rest_b[j, at] if at < dim else 0.0) >= threshold - SLACK
        i, j, s = i[left], j[left], s[left]
    keep = s >= threshold - SLACK
    i, j = i[keep], j[keep]
    if i.size:
        x, y = raw_a[i], raw_b[j]
        cosine = (np.einsum("ij,ij->i", x, y)
                  / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))))
        keep = cosine >= threshold
        i, j = i[keep], j[keep]
    return i, j


def _tile(threshold: float, rows_at_once: int):
    def compare(key: tuple, table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        left = table.column("left_side").to_numpy(zero_copy_only=False)
        same = bool(table.column("same")[0].as_py())
        classes = table.column("class_id").to_numpy()
        sizes = table.column("size").to_numpy()
        order = np.lexsort((classes, ~left))          # the left block first
        turned, raw = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.float64).reshape(-1, dim)[order]
                       for c in ("turned", "raw"))
        classes, sizes = classes[order], sizes[order]
        n_left = int(left.sum())
        b0 = 0 if same else n_left
        degree, root = np.zeros(classes.size, np.int64), np.arange(classes.size)
        for a0 in range(0, n_left, rows_at_once):
            a1 = min(n_left, a0 + rows_at_once)
            start = a0 if same else b0
            for c0 in range(start, classes.size, rows_at_once):
                c1 = min(classes.size, c0 + rows_at_once)
                i, j = close_pairs(turned[a0:a1], turned[c0:c1], raw[a0:a1], raw[c0:c1], threshold,
                                   same and c0 == a0)
                i, j = i + a0, j + c0
                np.add.at(degree, i, sizes[j])
                np.add.at(degree, j, sizes[i])
                root = _forest(classes.size, np.concatenate([i, np.arange(classes.size)]), np.concatenate([j, root]))
        linked = degree > 0
        return pa.table({"class_id": pa.array(classes[linked]), "links": pa.array(degree[linked]),
                         "reached": pa.array(classes[root[linked]])})
    return compare


def link_vectors(vectors: DataFrame, threshold: float = 0.93, block_rows: int = 2_000,
                 rows_at_once: int = 1_000) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding, label)."""
    whole = materialize(vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label"),
        F.transform("embedding", lambda x: x.cast("double")).alias("embedding")), "vectors")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # not zero: a largest component above zero
    largest = F.array_max(F.transform("embedding", F.abs))
    valid = F.coalesce(F.col("label").isNotNull() & (F.size("embedding") > 0) & finite & (largest > 0), F.lit(False))
    classes = materialize(
        whole.filter(valid).groupBy("label", "embedding")
        .agg(F.count("*").alias("size"), F.min("vec_id").alias("first_id"))
        .withColumn("class_id", F.monotonically_increasing_id()), "vector-classes")

    axes = principal_axes(classes)
    turned = materialize(
        classes.select("embedding", "label", "class_id", "size").mapInArrow(
            lambda it: _rotate(it, axes),
            f"label {classes.schema['label'].dataType.simpleString()}, class_id bigint, size bigint, dim int, "
            "cell int, raw binary, turned binary"), "turned-vectors")
    # neighbouring cells are put together to ranges of about block_rows rows; a range that has
    # more (one full cell) is split into blocks by hash.  A label has at most 2 / CELL + 1 cells.
    before = Window.partitionBy("label", "dim").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (turned.groupBy("label", "dim", "cell").agg(F.count("*").alias("n"))
             .withColumn("range", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / block_rows)))
    cells = materialize(cells, "vector-cells")
    ranges = cells.groupBy("label", "dim", "range").agg(
        F.min("cell").alias("low"), F.max("cell").alias("high"),
        F.ceil(F.sum("n") / block_rows).cast("int").alias("blocks"))
    blocks = ranges.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # two blocks meet unless their first coordinates are too far apart
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    other = blocks.select("label", "dim", F.col("low").alias("low_2"), F.col("range").alias("range_2"),
                          F.col("block").alias("block_2"))
    same = (F.col("range") == F.col("range_2")) & (F.col("block") == F.col("block_2"))
    after = (F.col("range") < F.col("range_2")) | ((F.col("range") == F.col("range_2")) & (F.col("block") <= F.col("block_2")))
    tiles = (blocks.join(other, ["label", "dim"])
             .filter(after & ((F.col("low_2") - F.col("high") - 1) * CELL <= reach)).withColumn("same", same)
             .withColumn("tile", F.struct("label", "dim", "range", "block", "range_2", "block_2")))
    placed = (turned.join(cells.select("label", "dim", "cell", "range"), ["label", "dim", "cell"])
              .join(ranges.select("label", "dim", "range", "blocks"), ["label", "dim", "range"])
              .withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")))
    sides = (tiles.select("label", "dim", "same", "tile", F.explode(F.array(
                 F.struct(F.col("range"), F.col("block"), F.lit(True).alias("left_side")),
                 F.struct(F.col("range_2").alias("range"), F.col("block_2").alias("block"), F.lit(False).alias("left_side"))
             )).alias("s")).filter("s.left_side or not same")
             .select("label", "dim", F.col("s.range").alias("range"), F.col("s.block").alias("block"), "tile", "same",
                     F.col("s.left_side").alias("left_side")))
    met = placed.join(sides, ["label", "dim", "range", "block"]).select(
        "tile", "same", "left_side", "dim", "class_id", "size", "raw", "turned")
    found = materialize(met.groupBy("tile").applyInArrow(
        _tile(threshold, rows_at_once), "class_id bigint, links bigint, reached bigint"), "vector-links")

    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("class_id").alias("u"), F.col("reached").alias("v")))
    named = (classes.join(roots, classes["class_id"] == roots["node"], "left")
             .withColumn("root", F.coalesce("root", "class_id")))
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    per_class = (named.join(ids, "root").join(links, "class_id", "left")
                 .select("label", "embedding", "component_id",
                         (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    linked = whole.filter(valid).join(per_class, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = whole.filter(~valid).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                        F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

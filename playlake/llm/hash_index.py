"""Exact deduplication with an extendible-hash index, in DataFrame operations alone.

Texts are equal when they are identical after deleting white space.  The index maps the
64-bit hash of that normalised text to an entry.  Its directory is indexed by leading
hash bits: a bucket with more than ``capacity`` entries is split on its next bit, which
doubles the directory where needed.  Its depth grows with the number of entries: four bits
more than equal buckets would take.  Buckets are dealt
to owner tasks, which choose the row that stays, add up the copies and chain the entries of equal hashes by
their SHA-256.  Documents are looked up through the directory: the bucket of their hash's cell, then hash and
digest in it.  The texts themselves are compared byte by byte when copies are grouped on their way to
the owners, and a digest that stands for two texts raises an error rather than merging them.

Copies are grouped with partial aggregation, so a text that a third of all rows share
reaches the index as one entry.  Only narrow rows (hashes, ids) are joined back.  The directory has some 16 cells a
bucket; it is broadcast where Spark finds it small, and joined otherwise.

Edge cases: null text counts as empty; all empty texts are one group; a null doc_id ranks
after every other one; of rows that are equal in text length and doc_id exactly one is
kept; a very long text is normalised and hashed like any other and is held whole while it is
compared; an empty table gives an empty result; extra columns of any name are carried by
``drop_copies`` and ignored elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlake.llm.common import materialize, text_or_empty, unpacked, whole_row, without_breaks


_WINNER = "struct<doc_id: bigint, row: bigint>"


@dataclass(frozen=True)
class IndexOptions:
    capacity: int = 20_000
    #: leading bits of the directory; None: as the entries ask for
    max_depth: int | None = None


def _hashed(docs: DataFrame) -> DataFrame:
    """doc_id, norm, h, sha, n of every row."""
    norm = without_breaks(text_or_empty())
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), norm.alias("norm"),
                        F.length(text_or_empty()).alias("n"))
            .withColumn("h", F.xxhash64("norm")).withColumn("sha", F.sha2(F.encode("norm", "UTF-8"), 256)))


def _cell(depth: int) -> Column:
    return (F.shiftrightunsigned("h", 64 - depth) if depth else F.lit(0)).cast("int")


def directory_depth(hashes: DataFrame, options: IndexOptions) -> int:
    if options.max_depth is not None:
        return options.max_depth
    entries = hashes.select("h").distinct().count()
    return min(30, max(0, -(-entries // options.capacity) - 1).bit_length() + 4)


def build_directory(hashes: DataFrame, options: IndexOptions, depth: int) -> DataFrame:
    """cell (leading ``depth`` bits), bucket, depth, entries: the splits that capacity asks for.

    A prefix is a bucket when it has at most ``capacity`` entries (or no bits are left) while
    all shorter prefixes have more.
    """
    d = depth
    cells = hashes.select("h").distinct().groupBy(_cell(d).alias("cell")).agg(F.count("*").alias("n"))
    every = hashes.sparkSession.range(1 << d).select(F.col("id").cast("int").alias("cell"))
    cells = every.join(cells, "cell", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(d))))
    levels = levels.withColumn("prefix", F.floor(F.col("cell") / F.pow(F.lit(2.0), F.lit(d) - F.col("depth"))).cast("int"))
    sizes = levels.groupBy("depth", "prefix").agg(F.sum("n").alias("entries"))
    fits = sizes.filter((F.col("entries") <= options.capacity) | (F.col("depth") == d))
    found = (levels.select("cell", "depth", "prefix").join(fits, ["depth", "prefix"])
             .groupBy("cell").agg(F.min(F.struct("depth", "prefix", "entries")).alias("b")))
    # the bucket's number: its first cell
    first = (F.col("b.prefix") * F.pow(F.lit(2.0), F.lit(d) - F.col("b.depth"))).cast("int")
    return found.select("cell", first.alias("bucket"), F.col("b.depth").alias("depth"), F.col("b.entries").alias("entries"))


@dataclass(frozen=True)
class HashIndex:
    """The stored index: ``rows`` (a narrow row per document), ``directory`` (of ``depth`` bits) and ``entries``."""

    rows: DataFrame
    directory: DataFrame
    entries: DataFrame
    depth: int

    def placed(self, hashed: DataFrame) -> DataFrame:
        """``hashed`` (h) with the bucket that the directory has for it."""
        return _placed(hashed, self.directory, self.depth)


def _placed(hashed: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    return hashed.withColumn("cell", _cell(depth)).join(directory.select("cell", "bucket"), "cell").drop("cell")


def build_index(docs: DataFrame, options: IndexOptions = IndexOptions()) -> HashIndex:
    """Index ``docs`` (doc_id, text) on shared files.

    entries: bucket, h, chain (place among the entries of this hash), sha, group_size,
    keep_id, keep_row.
    """
    rows = materialize(_hashed(docs).drop("norm").withColumn("row", F.monotonically_increasing_id()), "hash-rows")
    depth = directory_depth(rows, options)
    directory = materialize(build_directory(rows, options, depth), "hash-directory")

    # byte comparison: a group is one text; a digest with two texts is an error
    texts = _hashed(docs).groupBy("h", "sha", "norm").agg(F.count("*").alias("copies"))
    texts = texts.select("h", "sha", "copies", F.lit(1).alias("texts"), F.lit(None).cast(_WINNER).alias("w"))
    # most code points, then the smallest doc_id (nulls last), then the first row
    order = F.struct("n", F.col("doc_id").isNotNull(), F.bitwise_not(F.col("doc_id")), F.bitwise_not(F.col("row")))
    winners = rows.groupBy("h", "sha").agg(F.max_by(F.struct("doc_id", "row"), order).alias("w"))
    winners = winners.select("h", "sha", F.lit(0).cast("long").alias("copies"), F.lit(0).alias("texts"), F.col("w").cast(_WINNER).alias("w"))
    # both reach the owner of the bucket, which makes the entries and chains them
    owned = _placed(texts.unionByName(winners), directory, depth).repartition("bucket")
    owned = owned.groupBy("bucket", "h", "sha").agg(F.sum("copies").alias("group_size"), F.sum("texts").alias("texts"),
                                                    F.max("w").alias("w"))
    entries = (owned.withColumn("chain", F.row_number().over(Window.partitionBy("bucket", "h").orderBy("sha")))
               .select("bucket", "h", "chain", "sha",
                       F.when(F.col("texts") > 1, F.raise_error(F.lit("one digest for two texts")).cast("long"))
                       .otherwise(F.col("group_size")).alias("group_size"),
                       F.col("w.doc_id").alias("keep_id"), F.col("w.row").alias("keep_row"))
               .sortWithinPartitions("bucket", "h", "chain"))
    return HashIndex(rows, directory, materialize(entries, "hash-entries"), depth)


def lookup(index: HashIndex, texts: DataFrame) -> DataFrame:
    """``texts`` (doc_id, text) that the index holds: doc_id, keep_id, group_size."""
    probes = index.placed(_hashed(texts).select("doc_id", "h", "sha"))
    return probes.join(index.entries, ["bucket", "h", "sha"]).select("doc_id", "keep_id", "group_size")


def exact_dedup(docs: DataFrame, options: IndexOptions = IndexOptions()) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    index = build_index(docs, options)
    return (index.placed(index.rows)
            .join(index.entries.select("bucket", "h", "sha", "group_size", "keep_id", "keep_row"), ["bucket", "h", "sha"])
            .select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def drop_copies(docs: DataFrame, options: IndexOptions = IndexOptions()) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    index = build_index(docs, options)
    kept = (index.rows.join(index.entries.select(F.col("keep_row").alias("row")), "row", "left_semi")
            .select(F.col("doc_id").alias("_id"), F.col("n").alias("_n"), F.col("sha").alias("_sha")))
    kept = materialize(kept, "hash-kept")
    norm = without_breaks(text_or_empty())
    out = docs.select(whole_row(docs).alias("packed"), F.col("doc_id").cast("long").alias("_id"),
                      F.length(text_or_empty()).alias("_n"), F.sha2(F.encode(norm, "UTF-8"), 256).alias("_sha"))
    same = out["_id"].eqNullSafe(kept["_id"]) & (out["_n"] == kept["_n"]) & (out["_sha"] == kept["_sha"])
    out = out.join(kept, same, "left_semi")
    again = index.rows.groupBy("doc_id", "n", "sha").count().filter("count > 1")
    if again.head(1):                # rows repeated with their doc_id: one of each
        out = out.dropDuplicates(["_id", "_n", "_sha"])
    return unpacked(out, "packed", docs.columns)

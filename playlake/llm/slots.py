"""Sharding by fixed virtual slots, in DataFrame operations alone.

Records are hashed into ``slots`` virtual slots once and for all.  The bytes of each slot
are added up, and a stored, versioned map gives every slot its shard.  Rebalancing (new
sizes, or another number of shards) writes the next version: in each shard the largest
slots stay as long as they fit the fair share, the others move, largest first, to the
shard with the fewest bytes.  Version 0 is slot modulo shards; version 1 has the measured sizes.
The law is ``bytes``: shard sizes are near equal.

Slot sums have a fixed number of rows (``slots`` times ``CELLS`` at most), so they may be
broadcast; the greedy placement works on one array of ``slots`` entries.

Edge cases: a null text has size 1 (no bytes, plus 1) and CRC 0; a null doc_id is hashed like a
value; rows repeated in doc_id, CRC and size are spread over slots by the copy's number among them, the first
has the slot that it would have alone; slots of equal bytes move in the order of their numbers, and
shards of equal load are filled in the order of theirs; a very long text is one record of its size; an empty
table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playlake.llm.common import materialize, shared_path, text_or_empty

SLOTS = 4096
#: sub-buckets of a slot for numbering its rows in parallel
CELLS = 16


def measured(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, vslot, cell of every row.

    A slot depends on the record alone: on its doc_id, CRC and size and, for records that are equal in these, on the
    copy's number (0: none).  Copies are numbered within stored partitions first, then over them."""
    key = ["doc_id", "text_crc32", "size"]
    raw = F.encode(text_or_empty(), "UTF-8")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "slot-sizes")
    repeated = materialize(rows.groupBy(*key).count().filter("count > 1").select(F.struct(*key).alias("k")), "slot-repeats")
    h = F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "text_crc32", "size")
    if repeated.head(1):
        same = [rows[c].eqNullSafe(repeated["k"][c]) for c in key]
        rows = rows.join(repeated, same, "left").withColumn("part", F.shiftright("row", 33))
        of_part, of_key = Window.partitionBy(*key, "part").orderBy("row"), Window.partitionBy(*key).orderBy("part")
        copies = rows.filter(F.col("k").isNotNull())
        before = (copies.groupBy(*key, "part").agg(F.count("*").alias("n"))
                  .withColumn("before", F.coalesce(F.sum("n").over(of_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
        before = before.select(*[F.col(c).alias(f"_{c}") for c in (*key, "part")], "before")
        numbered = copies.withColumn("at", F.row_number().over(of_part) - 1)
        numbered = numbered.join(before, [numbered[c].eqNullSafe(before[f"_{c}"]) for c in (*key, "part")])
        number = F.col("at") + F.col("before")
        salted = F.when(number == 0, h).otherwise(F.xxhash64(h, number))
        rows = (rows.filter(F.col("k").isNull()).select(*key, h.alias("h"))
                .unionByName(numbered.select(*key, salted.alias("h"))))
    else:
        rows = rows.select(*key, h.alias("h"))
    h = F.col("h")
    return (rows.select("doc_id", "size", "text_crc32", "h").withColumn("vslot", F.pmod(h, F.lit(slots)).cast("int"))
            .withColumn("cell", F.pmod(F.shiftright(h, 32), F.lit(CELLS)).cast("int")).drop("h"))


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 0: vslot, shard, bytes (none are known)."""
    return spark.range(slots).select(F.col("id").cast("int").alias("vslot"), F.pmod("id", F.lit(shards)).cast("int").alias("shard"),
                                     F.lit(None).cast("long").alias("bytes"))


def rebalance(slot_bytes: DataFrame, current: DataFrame, shards: int) -> DataFrame:
    """The next map (vslot, shard, bytes, moved): near equal bytes with few moves.

    ``slot_bytes``: vslot, bytes.  ``current``: vslot, shard.
    """
    sized = current.select("vslot", "shard").join(slot_bytes, "vslot", "left").select(
        "vslot", "shard", F.coalesce("bytes", F.lit(0).cast("long")).alias("bytes"))
    fair = sized.agg((F.sum("bytes") / shards).alias("fair"))
    held = Window.partitionBy("shard").orderBy(F.desc("bytes"), "vslot").rowsBetween(Window.unboundedPreceding, 0)
    marked = (sized.withColumn("held", F.sum("bytes").over(held)).crossJoin(F.broadcast(fair))
              .withColumn("stays", (F.col("held") <= F.col("fair")) & (F.col("shard") < shards)))
    loads = (marked.filter("stays").groupBy("shard").agg(F.sum("bytes").alias("load"))
             .agg(F.map_from_entries(F.collect_list(F.struct("shard", "load"))).alias("m")))
    pool = marked.filter("not stays").agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("bytes")).alias("neg"), F.col("vslot").alias("vslot")))).alias("pool"))
    start = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                        lambda i: F.coalesce(F.element_at("m", i), F.lit(0).cast("long")))

    def place(acc, slot):
        at = (F.array_position(acc["loads"], F.array_min(acc["loads"])) - 1).cast("int")
        return F.struct(
            F.transform(acc["loads"], lambda v, i: F.when(i == at, v - slot["neg"]).otherwise(v)).alias("loads"),
            F.concat(acc["to"], F.array(at)).alias("to"))

    none = F.array().cast("array<int>")
    moved = (pool.crossJoin(loads)
             .select("pool", F.aggregate("pool", F.struct(start.alias("loads"), none.alias("to")), place)["to"].alias("to"))
             .select(F.explode(F.arrays_zip("pool", "to")).alias("z"))
             .select(F.col("z.pool.vslot").alias("vslot"), F.col("z.to").alias("to")))
    return (marked.join(moved, "vslot", "left")
            .select("vslot", F.coalesce("to", "shard").alias("shard"), "bytes",
                    (F.coalesce("to", "shard") != F.col("shard")).alias("moved")))


def store_map(new: DataFrame, path: str, version: int) -> DataFrame:
    """Append version ``version`` to the map stored at ``path``; returns it as stored."""
    (new.select(F.lit(version).alias("version"), "vslot", "shard", "bytes").coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/version={version}"))
    return new.sparkSession.read.parquet(f"{path}/version={version}").select("vslot", "shard", "bytes")


def shard_documents(docs: DataFrame, shards: int = 16, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot, map_version of every row.

    ``slot`` is the row's place in its shard, gapless from 0.
    """
    spark = docs.sparkSession
    rows = materialize(measured(docs, slots), "slot-rows")
    cells = rows.groupBy("vslot", "cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    cells = materialize(cells.coalesce(1), "slot-sums")
    path = path or shared_path(spark, "slot-map")
    start = store_map(first_map(spark, shards, slots), path, 0)
    new = rebalance(cells.groupBy("vslot").agg(F.sum("bytes").alias("bytes")), start, shards)
    current = store_map(new, path, 1)
    before = Window.partitionBy("shard").orderBy("vslot", "cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (cells.join(current.select("vslot", "shard"), "vslot")
              .withColumn("base", F.coalesce(F.sum("rows").over(before), F.lit(0).cast("long")))
              .select("vslot", "cell", "shard", "base"))
    within = Window.partitionBy("vslot", "cell").orderBy("doc_id", "text_crc32", "size")
    # at most slots * CELLS rows: a fixed bound
    return (rows.withColumn("_n", F.row_number().over(within) - 1)
            .join(F.broadcast(starts), ["vslot", "cell"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("base") + F.col("_n")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "vslot", F.lit(1).alias("map_version")))

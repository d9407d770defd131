"""Streaming ingest of the raw event log into the cleaned, de-duplicated event table.

The reference reprocesses a trailing window in batch and upserts by key.  The
streaming form runs the same J1 expressions on each micro-batch and writes it into a
day-partitioned Parquet table, rewriting only the day partitions the batch touches:

1. ids, times and payload hashes are read from the log (J1); ``latest_copies`` keeps the newest copy of each
   event id in the stream's state and lets only newer ones pass, each with the day of the copy that it replaces;
2. only those have their properties parsed;
3. the touched days, those of the rows that pass and those of the copies that they replace (a copy may cross
   midnight, or have no time), are read (partition pruning), the replaced copies leave them, and exactly these
   partitions are overwritten by way of a staging table under ``spark.checkpoint.dir``; no
   other day is read.

The stream's own checkpoint holds offsets and state and makes each micro-batch replayable after a failure;
step 3 is idempotent for a replayed batch.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playlake.config import RunWindow
from playlake.operators.topk import top1_per_key
from playlake.plans.events import PAYLOAD_MD5, STG_EVENTS_COLUMNS, extract_ids, extract_properties, scan_event_log
from playlake.sources.sinks import _exists, _on_days, materialize, read_table, replace_days, scratch_scope
from playlake.streaming.latest import latest_copies

RAW_EVENT_SCHEMA = ("publish_time timestamp_ntz, subscription_name string, message_id decimal(38,9), "
                    "attributes string, data string")
DAY = "event_day"


def write_latest(batch: DataFrame, seed: DataFrame, table_path: str) -> None:
    """Rows of ``latest_copies`` into the table; the copies that they replace leave it."""
    spark = batch.sparkSession
    with scratch_scope(spark):
        batch = materialize(batch, "event-latest")
        days = [r[0] for r in batch.select(F.to_date("event_timestamp").alias(DAY))
                .unionByName(batch.filter("replaces").select(F.col("replaced_day").alias(DAY))).distinct().collect()]
        if not days:
            return
        rows = extract_properties(batch.drop("replaces", "replaced_day")).join(
            seed.select("event_name", "event_source"), on="event_name", how="left")
        merged = rows.select(*STG_EVENTS_COLUMNS, F.col("_tie").alias(PAYLOAD_MD5), F.to_date("event_timestamp").alias(DAY))
        if _exists(spark, table_path):
            stored = _on_days(read_table(spark, table_path, DAY), DAY, days)
            merged = merged.unionByName(stored.select(*merged.columns))
        # a copy whose state has expired meets an older one here, if that has the same day
        merged = top1_per_key(merged, ["event_id"], ["event_timestamp", PAYLOAD_MD5], descending=True)
        replace_days(materialize(merged, "events"), table_path, DAY, days)


def start_event_ingest(spark: SparkSession, source_path: str, table_path: str, seed: DataFrame,
                       checkpoint_location: str, window: RunWindow | None = None, available_now: bool = True,
                       keep: dt.timedelta = dt.timedelta(days=7), files_per_batch: int | None = None) -> StreamingQuery:
    """Stream ``source_path`` (Parquet files of the raw log) into ``table_path``.

    ``keep``: how long after an event's last copy the stream still knows it."""
    window = window or RunWindow(dt.date(1970, 1, 1), dt.date(9999, 12, 31), dt.datetime(9999, 12, 31))
    reader = spark.readStream.schema(RAW_EVENT_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    latest = latest_copies(extract_ids(scan_event_log(reader.parquet(source_path), window)), keep)
    writer = (latest.writeStream.outputMode("update").foreachBatch(lambda df, _id: write_latest(df, seed, table_path))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()

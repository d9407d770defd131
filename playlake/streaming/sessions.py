"""Sessions as a stream: native session windows under a watermark, in append mode.

Spark keeps the open sessions of each (key, device) in the state store, merges those that an event joins, and emits
a session once, when the watermark (the newest event time less ``late``) has passed its end.  Events that come up to
``late`` after newer ones still join their session, whatever order files arrive in; those later than
the watermark are dropped by Spark (and counted by it) and are left to the batch re-run of their day.

The break rule is ``sessionize.sessions_by_window``'s: whole minutes, as the reference counts them.  The user of an
anonymous event comes from a stored identity map (J2b), joined to the stream as it is when the query starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playlake.functions import ntz
from playlake.functions.time import micros_since_epoch
from playlake.operators.sessionize import sessions_by_window
from playlake.plans.sessions import frontend_events, stitch


def _instant(ts: Column) -> Column:
    """The wall clock as an instant, read as UTC whatever the session's time zone: watermarks need one."""
    return F.timestamp_micros(micros_since_epoch(ts))


def _wall_clock(instant: Column) -> Column:
    return ntz("1970-01-01 00:00:00") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)"))


def session_stream(events: DataFrame, imap: DataFrame, timeout_minutes: int, late: str) -> DataFrame:
    """``events``: a stream of cleaned events (J1).  session_key, device_id, session_start_ts, session_end_ts, event_count
    of each closed session."""
    ev = stitch(frontend_events(events), imap)
    ev = (ev.select(F.coalesce("stitched_user_id", "device_id").alias("session_key"), "device_id", "event_id",
                    _instant(F.col("event_timestamp")).alias("at"))
          .withWatermark("at", late))
    found = sessions_by_window(ev, ["session_key", "device_id"], "at", timeout_minutes).agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.count("event_id").alias("event_count"))
    return found.select("session_key", "device_id", _wall_clock(F.col("first")).alias("session_start_ts"),
                        _wall_clock(F.col("last")).alias("session_end_ts"), "event_count")


def start_session_stream(spark: SparkSession, source_path: str, imap: DataFrame, table_path: str, checkpoint_location: str,
                         timeout_minutes: int = 10, late: str = "1 day", files_per_batch: int | None = None,
                         available_now: bool = True) -> StreamingQuery:
    """Stream the Parquet files of cleaned events under ``source_path`` into session rows at ``table_path``."""
    schema = spark.read.parquet(source_path).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    sessions = session_stream(reader.parquet(source_path), imap, timeout_minutes, late)
    writer = (sessions.writeStream.format("parquet").outputMode("append").option("path", table_path)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()

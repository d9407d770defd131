"""Gap-based sessionization of per-actor event timelines.

Rule (the reference's): within a partition (``keys``), ordered by time, a row
starts a new session when it is the first row, when the whole minutes elapsed
since the previous row exceed ``timeout_minutes`` (so the break happens at a gap
of ``timeout + 1`` minutes), or when ``actor`` differs (NULL-safe) from the
previous row's.

``number_sessions`` computes the rule skew-safely in two levels:

1. the timeline is cut into time buckets; a window *per (keys, bucket)* finds the
   breaks and numbers the fragments inside each bucket -- a device holding a
   third of all rows is spread over as many window partitions as it has buckets;
2. one summary row per (keys, bucket) -- first/last row and fragment count --
   is aggregated (partial aggregation, no shuffle beyond the window's), and a
   window per ``keys`` *over the summaries* (bounded by the number of buckets,
   not by the number of events) decides whether a bucket's first fragment
   continues the previous bucket's last session and turns fragment numbers into
   global session numbers.  The summaries are joined back on (keys, bucket).

The result equals the single-window form (lag + running sum over the whole
partition); ``number_sessions_single_window`` is kept as the reference form and
for tests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlake.functions.time import timeline_bucket


def _breaks(ts: Column, prev_ts: Column, actor: Column, prev_actor: Column, timeout_minutes: int) -> Column:
    return (prev_ts.isNull()
            | (F.timestamp_diff("MINUTE", prev_ts, ts) > F.lit(timeout_minutes))
            | ~prev_actor.eqNullSafe(actor))


def number_sessions_single_window(df: DataFrame, keys: Sequence[str], ts: str, tie: str, actor: str,
                                  timeout_minutes: int, out: str = "session_no", place: str | None = None) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(ts, tie)
    brk = _breaks(F.col(ts), F.lag(ts).over(w), F.col(actor), F.lag(actor).over(w), timeout_minutes)
    if place:
        df = df.withColumn(place, F.row_number().over(w).cast("bigint"))
    return (df.withColumn("_brk", brk.cast("int"))
              .withColumn(out, F.sum("_brk").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
              .drop("_brk"))


def number_sessions(df: DataFrame, keys: Sequence[str], ts: str, tie: str, actor: str,
                    timeout_minutes: int, bucket_hours: int = 24, out: str = "session_no", place: str | None = None) -> DataFrame:
    """Add ``out``: 1-based session number within ``keys`` (see module doc).

    ``place``: a column to add with a BIGINT that grows along the timeline of ``keys`` (by ``ts``, ``tie``)."""
    bkeys = [*keys, "_bucket"]
    x = df.withColumn("_bucket", timeline_bucket(F.col(ts), bucket_hours))
    wl = Window.partitionBy(*bkeys).orderBy(ts, tie)
    brk = _breaks(F.col(ts), F.lag(ts).over(wl), F.col(actor), F.lag(actor).over(wl), timeout_minutes)
    x = (x.withColumn("_brk", brk.cast("int"))
          .withColumn("_frag", F.sum("_brk").over(wl.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    order = F.struct(F.col(ts), F.col(tie))
    summary = x.groupBy(*bkeys).agg(
        F.min(ts).alias("_first_ts"), F.min_by(F.col(actor), order).alias("_first_actor"),
        F.max(ts).alias("_last_ts"), F.max_by(F.col(actor), order).alias("_last_actor"),
        F.max("_frag").alias("_nfrag"))
    wb = Window.partitionBy(*keys).orderBy("_bucket")
    prev_last_ts = F.lag("_last_ts").over(wb)
    prev_last_actor = F.lag("_last_actor").over(wb)
    cont = (prev_last_ts.isNotNull()
            & (F.timestamp_diff("MINUTE", prev_last_ts, F.col("_first_ts")) <= F.lit(timeout_minutes))
            & prev_last_actor.eqNullSafe(F.col("_first_actor")))
    summary = (summary.withColumn("_cont", cont.cast("int"))
                      .withColumn("_net", F.col("_nfrag") - F.col("_cont"))
                      .withColumn("_offset", F.sum("_net").over(wb.rowsBetween(Window.unboundedPreceding, Window.currentRow))
                                  - F.col("_nfrag"))
                      .select(*bkeys, "_offset"))
    if place:
        # buckets follow one another in time; the rows of one are numbered by the window that finds its breaks
        x = x.withColumn(place, F.col("_bucket") * F.lit(1 << 32) + F.row_number().over(wl))
    joined = x.join(summary, on=bkeys, how="inner")
    return joined.withColumn(out, (F.col("_offset") + F.col("_frag")).cast("bigint")).drop(
        "_bucket", "_brk", "_frag", "_offset")


def sessions_by_window(df: DataFrame, keys: Sequence[str], ts: str, timeout_minutes: int) -> DataFrame:
    """Spark's native ``session_window`` grouping with the same break rule.

    A gap of ``timeout`` minutes 59.999999 seconds still joins the session, one
    microsecond more splits it -- the whole-minute rule.  Ignores the actor-change
    rule (only relevant when a user id equals a device id).
    """
    gap = f"{timeout_minutes} minutes 59 seconds 999999 microseconds"
    return df.groupBy(*keys, F.session_window(F.col(ts), gap).alias("sw"))

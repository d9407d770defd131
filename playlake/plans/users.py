"""J12 dim_device_users_scd: device -> user periods from the session timeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlake.config import INFINITY_DEVICE_USERS, Settings
from playlake.functions import fingerprint64, minus_micro, ntz, timeline_bucket
from playlake.operators.timeline import BUCKET, lag_across, lead_across, next_non_null_across
from playlake.operators.upsert import upsert
from playlake.sources.sinks import materialize

DIM_DEVICE_USERS_COLUMNS = ["dim_device_user_sk", "device_id", "user_id", "valid_from", "valid_to"]


def _starts(prev: Column, prev_cmp: Column, cmp: Column, collapse_null_runs: bool) -> Column:
    """Where a period starts.  ``collapse_null_runs``: rows that follow a NULL state start one only if they differ."""
    return prev_cmp.isNull() | (cmp != prev_cmp) if collapse_null_runs else prev.isNull() | (cmp != prev_cmp)


def scd2_from_timeline(timeline: DataFrame, key: str, state: str, ts: str, placeholder: str,
                       collapse_null_runs: bool = False) -> DataFrame:
    """M3: change-detection SCD2 over an event timeline.

    1. a NULL state takes the next non-NULL state later in the key's timeline;
    2. identical (key, state, ts) rows collapse;
    3. a row starts a period when the previous state is NULL or differs
       (so after a NULL state every row starts a period -- kept as in the reference,
       unless ``collapse_null_runs``);
    4. a period ends one microsecond before the next start, or never.
    """
    later = Window.partitionBy(key).orderBy(ts, state).rowsBetween(1, Window.unboundedFollowing)
    eff = F.coalesce(F.col(state), F.first(state, ignorenulls=True).over(later))
    states = timeline.select(key, ts, eff.alias("_eff")).distinct()
    cmp = F.coalesce(F.col("_eff"), F.lit(placeholder))
    w = Window.partitionBy(key).orderBy(F.col(ts), cmp)
    starts = (states.withColumn("_prev", F.lag("_eff", 1).over(w)).withColumn("_prev_cmp", F.lag(cmp, 1).over(w))
                    .filter(_starts(F.col("_prev"), F.col("_prev_cmp"), cmp, collapse_null_runs))
                    .select(key, F.col("_eff").alias(state), F.col(ts).alias("valid_from")))
    wp = Window.partitionBy(key).orderBy(F.col("valid_from"), F.coalesce(F.col(state), F.lit(placeholder)))
    return starts.withColumn("valid_to", F.lead("valid_from", 1).over(wp))


def scd2_from_timeline_bucketed(timeline: DataFrame, key: str, state: str, ts: str, placeholder: str,
                                bucket_hours: int, collapse_null_runs: bool = False) -> DataFrame:
    """M3 with the same result as ``scd2_from_timeline``, computed with the
    skew-safe cross-bucket lag/lead of ``operators.timeline``: no window ever
    holds more than one (key, time bucket) of rows, or one key's bucket summaries.

    Each cross-bucket step reads its input twice (rows and bucket summaries), so
    the two intermediate timelines are written once as tables (narrow: key, state,
    time) instead of being recomputed by every later step."""
    t = timeline.select(key, state, ts).withColumn(BUCKET, timeline_bucket(F.col(ts), bucket_hours))
    t = next_non_null_across(t, key, [ts, state], state, "_next")
    states = t.select(key, ts, BUCKET, F.coalesce(F.col(state), F.col("_next")).alias("_eff")).distinct()
    states = materialize(states, "scd2_states")
    cmp = F.coalesce(F.col("_eff"), F.lit(placeholder))
    # the state with NULL shown as the placeholder is never NULL, so its lag is NULL on first rows only
    states = lag_across(states.withColumn("_cmp", cmp), key, [ts, "_cmp"], "_cmp", "_prev_cmp")
    prev = F.when(F.col("_prev_cmp") != F.lit(placeholder), F.col("_prev_cmp"))
    starts = (states.filter(_starts(prev, F.col("_prev_cmp"), F.col("_cmp"), collapse_null_runs))
                    .select(key, F.col("_eff").alias(state), F.col(ts).alias("valid_from"), BUCKET, "_cmp"))
    starts = materialize(starts, "scd2_starts")
    ends = lead_across(starts, key, ["valid_from", "_cmp"], "valid_from", "valid_to")
    return ends.drop(BUCKET, "_cmp")


def dim_device_users_scd(sessions: DataFrame, target: DataFrame | None = None,
                         settings: Settings = Settings()) -> DataFrame:
    """The MERGE source.  Incremental runs recompute only the devices seen in
    ``sessions``: their existing period starts join the new timeline."""
    raw = (sessions.filter(F.col("device_id").isNotNull())
                   .select("device_id", "user_id", F.col("session_start_ts").alias("event_ts")))
    if target is not None:
        touched = raw.select("device_id").distinct()
        history = (target.join(touched, on="device_id", how="left_semi")
                         .select("device_id", "user_id", F.col("valid_from").alias("event_ts")))
        raw = history.unionByName(raw)
    periods = scd2_from_timeline_bucketed(raw, "device_id", "user_id", "event_ts", settings.null_user_placeholder,
                                          settings.timeline_bucket_hours, settings.collapse_null_runs)
    sk = fingerprint64(F.concat(F.col("device_id").cast("string"), F.lit("|"), F.col("valid_from").cast("string")))
    return periods.select(
        sk.alias("dim_device_user_sk"), "device_id", "user_id", "valid_from",
        F.coalesce(minus_micro(F.col("valid_to")), ntz(INFINITY_DEVICE_USERS)).alias("valid_to"))


def dim_device_users_scd_merged(sessions: DataFrame, target: DataFrame | None = None,
                                settings: Settings = Settings()) -> DataFrame:
    return upsert(target, dim_device_users_scd(sessions, target, settings), ["dim_device_user_sk"],
                  replace_on=["device_id"] if settings.replace_keys else None)

"""Facts and marts: J14 fct_sessions, J15 fct_events, J20 dim_users, J19 user_activity."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.functions import first_value_by, ntz
from playlake.operators.asof import as_of_join
from playlake.operators.joins import left_join_known
from playlake.operators.topk import top1_per_key
from playlake.operators.upsert import upsert

FCT_SESSIONS_COLUMNS = ["session_id", "user_id", "device_id", "session_start_ts", "session_end_ts",
                        "session_length_seconds", "event_count", "platform", "device_model", "app_version",
                        "os_version", "country", "city", "language", "territory", "event_ids_in_session"]
FCT_EVENTS_COLUMNS = ["event_timestamp", "event_name", "event_id", "user_id", "device_id", "event_properties",
                      "platform", "app_version", "os_version", "device_model", "country", "city", "territory",
                      "language", "session_id", "event_source"]
DIM_USERS_COLUMNS = ["user_id", "first_touch_timestamp", "last_touch_timestamp", "device_id", "platform",
                     "app_version", "os_version", "device_manufacturer", "device_model", "adid", "idfa", "idfv",
                     "country", "city", "language", "territory", "mediasource", "channel", "campaign", "adset", "ad",
                     "adtype", "mmp_install_time"]
USER_ACTIVITY_COLUMNS = ["user_id", "first_seen_at", "last_seen_at", "days_active", "total_events",
                         "days_since_first_seen", "days_since_last_seen", "platform", "app_version", "country",
                         "language"]
TRANSIENT_PREFIX = "device:"


def fct_sessions(sessions: DataFrame, users: DataFrame, devices_scd: DataFrame, devices: DataFrame,
                 target: DataFrame | None = None) -> DataFrame:
    """Sessions enriched from the user dim, the device version valid at the
    session start (half-open period) and the device dim.  With ``target``: the table
    after the MERGE; without: the MERGE source.

    A device's versions follow one another (J11 closes each at the next one's start), so the
    version is carried along the device's sessions; the plan checks that no two overlap."""
    u = users.select(F.col("user_id").alias("_u"), *[F.col(c).alias(f"_u_{c}") for c in
                                                       ("country", "city", "language", "territory")])
    scd = devices_scd.select(F.col("device_id").alias("_sd"), F.col("valid_from").alias("_vf"),
                             F.col("valid_to").alias("_vt"), F.col("app_version").alias("_s_app"),
                             F.col("os_version").alias("_s_os"))
    d = devices.select(F.col("device_id").alias("_dd"), F.col("platform").alias("_d_platform"),
                       F.col("device_model").alias("_d_model"))
    # sessions without a user match no one: they bypass the join and don't meet in one task
    j = left_join_known(sessions, u, "user_id", "_u")
    j = as_of_join(j, scd, "device_id", "session_start_ts", "_sd", "_vf", "_vt", overlapping=False)
    j = left_join_known(j, d, "device_id", "_dd")
    out = j.select("session_id", "user_id", "device_id", "session_start_ts", "session_end_ts",
                   "session_length_seconds", "event_count",
                   F.coalesce("platform", "_d_platform").alias("platform"),
                   F.coalesce("device_model", "_d_model").alias("device_model"),
                   F.coalesce("app_version", "_s_app").alias("app_version"),
                   F.coalesce("os_version", "_s_os").alias("os_version"),
                   *[F.coalesce(c, f"_u_{c}").alias(c) for c in ("country", "city", "language", "territory")],
                   "event_ids_in_session")
    return upsert(target, out, ["session_id"])


def fct_events(events: DataFrame, sessions_fact: DataFrame, target: DataFrame | None = None,
               merge: bool = True) -> DataFrame:
    """Each event with its session's attributes, found through the session's
    event-id array (exploded; sessions with an empty array contribute nothing).
    Incremental runs read only sessions starting inside the events' time span,
    whose bounds are computed first so the session scan is pruned."""
    s = sessions_fact
    if target is not None:
        lo, hi = events.agg(F.min("event_timestamp"), F.max("event_timestamp")).first()
        s = s.filter(F.col("session_start_ts").between(F.lit(lo), F.lit(hi)))
    attrs = ["session_id", "platform", "app_version", "os_version", "country", "city", "language", "territory",
             "device_model"]
    ex = s.select(*attrs, F.col("user_id").alias("_s_user"), F.col("device_id").alias("_s_device"),
                  F.explode("event_ids_in_session").alias("_eid"))
    ev = events.select("event_timestamp", "event_name", "event_id", "user_id", "device_id", "event_properties",
                       "event_source")
    j = ev.join(ex, ev["event_id"] == F.col("_eid"), "left")
    out = j.select("event_timestamp", "event_name", "event_id",
                   F.coalesce(F.nullif(F.col("user_id"), F.lit("")), F.col("_s_user")).alias("user_id"),
                   F.coalesce(F.nullif(F.col("device_id"), F.lit("")), F.col("_s_device")).alias("device_id"),
                   "event_properties", "platform", "app_version", "os_version", "device_model", "country", "city",
                   "territory", "language", "session_id", "event_source")
    out = out.select(*FCT_EVENTS_COLUMNS)
    return upsert(target, out, ["event_id"]) if merge else out


def dim_users(sessions: DataFrame, dai: DataFrame, attribution: DataFrame) -> DataFrame:
    """J20 (documented, no SQL in the reference): one row per identity -- the
    session user, or ``device:<id>`` for anonymous sessions; first/last touch;
    attributes first seen by session start; attribution from the earliest
    device-attributed install of the identity's first device and its report row."""
    ident = F.coalesce(F.col("user_id"), F.concat(F.lit(TRANSIENT_PREFIX), F.col("device_id")))
    s = sessions.withColumn("_id", ident)
    order = ("session_start_ts", "session_id")
    attrs = ["device_id", "platform", "app_version", "os_version", "device_manufacturer", "device_model", "adid",
             "idfa", "idfv", "country", "city", "language", "territory"]
    base = s.groupBy("_id").agg(
        F.min("session_start_ts").alias("first_touch_timestamp"),
        F.max("session_end_ts").alias("last_touch_timestamp"),
        *[first_value_by(c, *order).alias(c) for c in attrs])
    first_install = top1_per_key(
        dai.filter(F.col("device_id").isNotNull()).select(
            "device_id", "installtime", "attribution_unique_id", "mediasource", "campaign", "adset"),
        ["device_id"], ["installtime", "attribution_unique_id", "mediasource", "campaign", "adset"])
    report = top1_per_key(attribution.select(F.col("unique_id").alias("attribution_unique_id"), "channel", "ad",
                                             "adtype", "extraction_date", "mediasource"),
                          ["attribution_unique_id"], ["extraction_date", "mediasource", "channel", "ad", "adtype"])
    fi = first_install.withColumnRenamed("device_id", "_fi_dev")
    out = (base.join(fi, F.col("device_id") == F.col("_fi_dev"), "left")
               .join(report.select("attribution_unique_id", "channel", "ad", "adtype"), "attribution_unique_id", "left"))
    return out.select(F.col("_id").alias("user_id"), "first_touch_timestamp", "last_touch_timestamp", *attrs,
                      "mediasource", "channel", "campaign", "adset", "ad", "adtype",
                      F.col("installtime").alias("mmp_install_time")).select(*DIM_USERS_COLUMNS)


def user_activity(events: DataFrame, users: DataFrame, as_of: dt.datetime) -> DataFrame:
    """J19 (disabled in the reference): per-user activity; day counts are whole
    elapsed days.

    Aggregated per (user, event id), then (user, day), then user, so distinct ids are exact
    whether or not ids repeat, and a user with a third of all events never lands in one task.
    A repeated id counts once, on the day of its first copy; days count all copies."""
    e = events.filter(F.col("user_id").isNotNull()).withColumn("_day", F.to_date("event_timestamp"))
    ids = (e.filter(F.col("event_id").isNotNull()).groupBy("user_id", "event_id")
           .agg(F.min("_day").alias("_day")).groupBy("user_id", "_day").agg(F.count("*").alias("_n")))
    ids = ids.groupBy("user_id").agg(F.sum("_n").alias("total_events"))
    daily = e.groupBy("user_id", "_day").agg(F.min("event_timestamp").alias("_first"), F.max("event_timestamp").alias("_last"))
    ua = daily.groupBy("user_id").agg(
        F.min("_first").alias("first_seen_at"), F.max("_last").alias("last_seen_at"),
        F.count("_day").alias("days_active"))
    ua = ua.join(ids, "user_id", "left").withColumn("total_events", F.coalesce("total_events", F.lit(0).cast("long")))
    ua = (ua.withColumn("days_since_first_seen", F.timestamp_diff("DAY", F.col("first_seen_at"), F.col("last_seen_at")))
            .withColumn("days_since_last_seen", F.timestamp_diff("DAY", F.col("last_seen_at"), ntz(as_of))))
    u = users.select("user_id", "platform", "app_version", "country", "language")
    return ua.join(u, "user_id", "left").select(*USER_ACTIVITY_COLUMNS)

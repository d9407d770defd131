"""J2 stg_sessions: identity stitching and gap sessionization of frontend events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.config import ANONYMOUS_USER, Settings
from playlake.functions import first_value_by, fingerprint64, json_scalar, ordered_ids, parse
from playlake.operators.sessionize import number_sessions, number_sessions_single_window

ATTRIBUTES = ["platform", "app_version", "os_version", "device_brand", "device_manufacturer", "device_model",
              "adid", "idfa", "idfv", "af_id", "country", "city", "language", "territory"]

STG_SESSIONS_COLUMNS = [
    "session_id", "user_id", "device_id", "session_start_ts", "session_end_ts", "session_length_seconds",
    "event_count", *ATTRIBUTES, "registration_completed_ts", "date_of_birth", "event_ids_in_session",
]


def frontend_events(stg_events: DataFrame) -> DataFrame:
    """Frontend events with a device, plus the registration columns."""
    reg = F.col("event_name") == "Registration Completed"
    dob = F.to_date(json_scalar(parse(F.col("event_properties")), "$.date_of_birth"))
    return (stg_events
            .filter((F.col("event_source") == "frontend") & F.col("device_id").isNotNull())
            .select("event_timestamp", "event_id", "user_id", "device_id", *ATTRIBUTES,
                    F.when(reg, F.col("event_timestamp")).alias("registration_completed_ts"),
                    F.when(reg, dob).alias("date_of_birth")))


def identity_map(stg_events: DataFrame) -> DataFrame:
    """First user ever seen on each device (ties: smallest user id).

    An aggregation (``min_by``), so a device with a huge share of events is
    combined map-side instead of sorted in one window partition."""
    known = stg_events.filter(F.col("device_id").isNotNull() & F.col("user_id").isNotNull()
                              & (F.col("event_source") == "frontend"))
    order = F.struct("event_timestamp", "user_id")
    return known.groupBy("device_id").agg(
        F.min_by("user_id", order).alias("user_id"),
        F.min("event_timestamp").alias("event_timestamp"))


#: tasks that share the anonymous rows of one device
STITCH_SALTS = 16


def stitch(events: DataFrame, imap: DataFrame) -> DataFrame:
    """Fill a missing user from the device's first user.

    Only rows without a user need the map.  They are salted over ``STITCH_SALTS`` keys a device (the
    narrow map is repeated for each), so a hot device is spread whether or not the map is
    small enough to be broadcast; what comes out is not hashed by device, so the
    windows that follow deal it anew by device and time bucket."""
    known = events.filter(F.col("user_id").isNotNull()).withColumn("stitched_user_id", F.col("user_id"))
    salt = F.pmod(F.xxhash64("event_id"), F.lit(STITCH_SALTS)).cast("int")
    m = imap.select("device_id", F.col("user_id").alias("_first_user"),
                    F.explode(F.sequence(F.lit(0), F.lit(STITCH_SALTS - 1))).alias("_salt"))
    anonymous = (events.filter(F.col("user_id").isNull()).withColumn("_salt", salt)
                 .join(m, on=["device_id", "_salt"], how="left")
                 .withColumn("stitched_user_id", F.col("_first_user")).drop("_first_user", "_salt"))
    return known.unionByName(anonymous.select(*known.columns))


def aggregate_sessions(numbered: DataFrame) -> DataFrame:
    """J2e/J2f: one row per (key, device, session number).

    The rows' places in their timeline (by time, then event id) order them: one number for each of the
    attributes' states in the exchange, instead of a time and an id."""
    order = ("_place",)
    agg = numbered.groupBy("_key", "device_id", "session_no").agg(
        first_value_by("stitched_user_id", *order).alias("user_id"),
        F.min("event_timestamp").alias("session_start_ts"),
        F.max("event_timestamp").alias("session_end_ts"),
        F.count("event_id").alias("event_count"),
        *[first_value_by(c, *order).alias(c) for c in (*ATTRIBUTES, "registration_completed_ts", "date_of_birth")],
        ordered_ids("event_id", *order).alias("event_ids_in_session"),
    )
    sid = fingerprint64(F.concat(F.coalesce("user_id", F.lit(ANONYMOUS_USER)), F.lit("|"), F.col("device_id"),
                                 F.lit("|"), F.col("session_start_ts").cast("string")))
    return (agg.withColumn("session_id", sid)
               .withColumn("session_length_seconds",
                           F.timestamp_diff("SECOND", F.col("session_start_ts"), F.col("session_end_ts")))
               .select(*STG_SESSIONS_COLUMNS))


def stg_sessions(stg_events: DataFrame, settings: Settings = Settings(), single_window: bool = False) -> DataFrame:
    """Sessions per (stitched user or device, device); see ``operators.sessionize``."""
    ev = stitch(frontend_events(stg_events), identity_map(stg_events))
    ev = ev.withColumn("_key", F.coalesce("stitched_user_id", "device_id"))
    keys = ["_key", "device_id"]
    if single_window:
        numbered = number_sessions_single_window(ev, keys, "event_timestamp", "event_id", "stitched_user_id",
                                                 settings.session_timeout_minutes, place="_place")
    else:
        numbered = number_sessions(ev, keys, "event_timestamp", "event_id", "stitched_user_id",
                                   settings.session_timeout_minutes, settings.timeline_bucket_hours, place="_place")
    return aggregate_sessions(numbered)

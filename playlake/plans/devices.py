"""Device jobs: J3 stg_devices, J10 dim_devices (SCD1), J11 dim_devices_scd (SCD2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.config import INFINITY_DEVICE_VERSIONS
from playlake.config import Settings
from playlake.functions import first_value_by, minus_micro, ntz, timeline_bucket
from playlake.operators.timeline import BUCKET, lead_across
from playlake.operators.topk import top1_per_key
from playlake.operators.upsert import upsert

DEVICE_COMBO = ["device_id", "platform", "app_version", "os_version", "device_brand", "device_manufacturer",
                "device_model", "adid", "idfa", "idfv", "af_id"]
DIM_ATTRS = [("platform", "platform"), ("app_version", "first_app_version"), ("os_version", "first_os_version"),
             ("device_brand", "device_brand"), ("device_manufacturer", "device_manufacturer"),
             ("device_model", "device_model"), ("adid", "adid"), ("idfa", "idfa"), ("idfv", "idfv")]
DIM_DEVICES_COLUMNS = ["device_id", *[o for _, o in DIM_ATTRS], "first_touch_timestamp"]
DIM_DEVICES_SCD_COLUMNS = ["id", "device_id", "app_version", "os_version", "adid", "idfv", "idfa",
                           "valid_from", "valid_to"]


def stg_devices(sessions: DataFrame) -> DataFrame:
    """Distinct attribute combinations per device with their first session start
    (hash aggregate with map-side combine; NULLs form groups)."""
    return (sessions.filter(F.col("device_id").isNotNull())
                    .groupBy(*DEVICE_COMBO).agg(F.min("session_start_ts").alias("first_touch_timestamp")))


def _dim_devices_source(devices: DataFrame) -> DataFrame:
    # first non-NULL value per attribute by first touch (ties: smallest value)
    return (devices.filter(F.col("device_id").isNotNull()).groupBy("device_id").agg(
        *[first_value_by(src, "first_touch_timestamp", src).alias(out) for src, out in DIM_ATTRS],
        F.min("first_touch_timestamp").alias("first_touch_timestamp")).select(*DIM_DEVICES_COLUMNS))


def scd1_earliest_wins(target: DataFrame, daily: DataFrame, key: str, ts: str, cols: list[str]) -> DataFrame:
    """M2: the MERGE source for an earliest-wins SCD1 dimension.

    For keys in both: a strictly earlier daily ``ts`` wins, otherwise the
    historical row; the other side fills NULLs.  New keys are appended."""
    h = target.select(key, *[F.col(c).alias(f"_h_{c}") for c in cols + [ts]])
    both = daily.join(h, on=key, how="inner")
    earlier = F.col(ts) < F.col(f"_h_{ts}")

    def pick(c: str):
        return F.when(earlier, F.coalesce(F.col(c), F.col(f"_h_{c}"))).otherwise(F.coalesce(F.col(f"_h_{c}"), F.col(c)))

    updates = both.select(key, *[pick(c).alias(c) for c in cols + [ts]])
    new = daily.join(target.select(key), on=key, how="left_anti")
    return updates.unionByName(new)


def dim_devices(devices: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """The MERGE source (first run: the whole dimension)."""
    src = _dim_devices_source(devices)
    if target is None:
        return src
    attrs = [o for _, o in DIM_ATTRS]
    return scd1_earliest_wins(target, src, "device_id", "first_touch_timestamp", attrs).select(*DIM_DEVICES_COLUMNS)


def dim_devices_merged(devices: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """J10 applied: the dimension table after the MERGE."""
    return upsert(target, dim_devices(devices, target), ["device_id"])


def scd2_first_seen(states: DataFrame, id_col: str, key: str, ts: str, tie: list[str], infinity,
                    bucket_hours: int = Settings().timeline_bucket_hours) -> DataFrame:
    """M4: keep the first occurrence of each state id; close it at the next
    state's start minus one microsecond (per ``key``), else ``infinity``.

    Deduplication is an aggregation (a NULL id is one group, combined map-side);
    the next start comes from the cross-bucket ``lead`` (window per key and time
    bucket), so no key's versions are sorted in one task."""
    first = top1_per_key(states, [id_col], [ts, *tie]).withColumn(BUCKET, timeline_bucket(F.col(ts), bucket_hours))
    nxt = lead_across(first, key, [ts, id_col], ts, "_next")
    return (nxt.withColumn("valid_to", F.coalesce(minus_micro(F.col("_next")), ntz(infinity)))
               .drop("_next", BUCKET))


def dim_devices_scd(devices: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Version rows keyed by sha1(device|platform|app|os) (NULL if any part is NULL)."""
    src = (devices.filter(F.col("device_id").isNotNull() & F.col("app_version").isNotNull()
                          & F.col("os_version").isNotNull())
           .withColumn("id", F.sha1(F.concat("device_id", "platform", "app_version", "os_version")))
           .groupBy("id", "device_id", "app_version", "os_version", "adid", "idfv", "idfa")
           .agg(F.min("first_touch_timestamp").alias("valid_from")))
    if target is not None:
        src = target.drop("valid_to").unionByName(src)
    out = scd2_first_seen(src, "id", "device_id", "valid_from", ["device_id", "adid", "idfv", "idfa"],
                          INFINITY_DEVICE_VERSIONS)
    return out.select(*DIM_DEVICES_SCD_COLUMNS)


def dim_devices_scd_merged(devices: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return upsert(target, dim_devices_scd(devices, target), ["id"])

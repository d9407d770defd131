"""Install attribution: J4 stg_attribution, J9 int_device_attributed_installs,
J16 fct_device_attributed_installs, J17 user_attributed_installs,
J13 dim__device_user_attribution_mapping."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlake.config import INFINITY_ATTRIBUTION, INFINITY_USER_MATCH, RunWindow, Settings
from playlake.functions import fingerprint64, ntz, start_of_day, surrogate_key
from playlake.operators.asof import as_of_join, prioritized_match
from playlake.operators.cascade import Rule, cascade_join
from playlake.operators.scd import scd2_by_version_hash
from playlake.operators.topk import top1_per_key
from playlake.operators.upsert import upsert

STG_ATTRIBUTION_COLUMNS = ["installtime", "mediasource", "channel", "campaign", "adset", "ad", "adtype",
                           "appsflyerid", "advertisingid", "idfa", "idfv", "platform", "extraction_date",
                           "unique_id"]
INT_DAI_COLUMNS = ["appsflyerid", "device_id", "mediasource", "campaign", "adset", "installtime", "platform",
                   "first_touch_timestamp", "attribution_unique_id", "join_method"]
FCT_DAI_COLUMNS = ["install_time_mmp", "attribution_unique_id", "appsflyerid", "device_id", "mediasource",
                   "campaign", "adset", "platform", "join_method"]
UAI_COLUMNS = ["install_time_mmp", "attribution_unique_id", "device_id", "user_id", "mediasource", "campaign",
               "adset", "platform", "join_method"]
MAPPING_COLUMNS = ["dim_device_user_attribution_mapping_sk", "attribution_unique_id", "appsflyerid", "device_id",
                   "mediasource", "campaign", "adset", "installtime", "platform", "first_touch_timestamp",
                   "join_method", "dim_device_user_sk", "user_id", "version_hash", "valid_from", "valid_to"]
# the fields of an install report that make up its id, in this order
ID_FIELDS = ["advertisingid", "appsflyerid", "campaign", "channel", "eventtime", "idfa", "idfv", "installtime",
             "mediasource", "platform"]


def _report(report: DataFrame, window: RunWindow, mediasource: Column) -> DataFrame:
    """One install report: closed date window on extraction_date, id, earliest copy."""
    ex = F.col("extraction_date")
    rows = report.filter((ex >= start_of_day(window.start))
                         & (ex < start_of_day(window.end + dt.timedelta(days=1))))
    uid = fingerprint64(F.concat(*[F.coalesce(F.col(c), F.lit("")) for c in ID_FIELDS]))
    rows = rows.select(
        F.to_timestamp_ntz(F.col("installtime")).alias("installtime"),
        mediasource.alias("mediasource"),
        "channel", "campaign", "adset", "ad", "adtype", "appsflyerid", "advertisingid", "idfa", "idfv",
        F.lower(F.col("platform")).alias("platform"), "extraction_date", uid.alias("unique_id"))
    # earliest extraction per id; copies of one install combine map-side
    return top1_per_key(rows, ["unique_id"], ["extraction_date", "mediasource", "channel", "campaign", "adset",
                                              "ad", "adtype", "installtime"])


def stg_attribution(organic: DataFrame, paid: DataFrame, window: RunWindow) -> DataFrame:
    """Organic (media source 'organic') and paid installs, unioned."""
    o = _report(organic, window, F.lit("organic"))
    p = _report(paid, window, F.col("mediasource"))
    return o.unionByName(p).select(*STG_ATTRIBUTION_COLUMNS)


#: the rules of the device match, first to last
CASCADE = (("joined_on_appsflyerid_af_id", "appsflyerid", "af_id", None),
           ("joined_on_android_advertisingid_adid", "advertisingid", "adid", "android"),
           ("joined_on_ios_idfv_idfv", "attr_idfv", "idfv", "ios"))


def cascade_device_match(attribution: DataFrame, devices: DataFrame) -> DataFrame:
    """af_id, else android advertising id, else ios idfv; records the rule.

    Of the devices with a value the one with the earliest first touch is taken (ties: smallest id), which
    equals joining every one of them and keeping the earliest."""
    a = attribution.select("mediasource", "campaign", "adset", "installtime", "platform",
                           F.col("unique_id").alias("attribution_unique_id"), "appsflyerid", "advertisingid",
                           F.col("idfv").alias("attr_idfv"))
    rules = [Rule(name, left, right, None if platform is None else F.col("platform") == platform)
             for name, left, right, platform in CASCADE]
    m = cascade_join(a, devices, rules, take=["device_id", "first_touch_timestamp"],
                     prefer=["first_touch_timestamp", "device_id"], no_match="no_device_match",
                     deal_by=["attribution_unique_id"])
    method = F.when(F.col("device_id").isNull(), F.lit("no_device_match")).otherwise(F.col("join_method"))
    return m.select("appsflyerid", "device_id", "mediasource", "campaign", "adset", "installtime", "platform",
                    "first_touch_timestamp", "attribution_unique_id", method.alias("join_method"))


def int_device_attributed_installs(attribution: DataFrame, devices: DataFrame) -> DataFrame:
    """One row per attribution id (earliest first touch, NULL first)."""
    m = cascade_device_match(attribution, devices)
    return top1_per_key(m, ["attribution_unique_id"],
                        ["first_touch_timestamp", "device_id", "mediasource", "campaign", "adset", "installtime",
                         "platform", "appsflyerid"]).select(*INT_DAI_COLUMNS)


def fct_device_attributed_installs(dai: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Projection, upserted on the attribution id."""
    src = dai.select(F.col("installtime").alias("install_time_mmp"), *FCT_DAI_COLUMNS[1:])
    return upsert(target, src, ["attribution_unique_id"], policy="append_new_columns")


def user_attributed_installs(installs: DataFrame, device_users: DataFrame, settings: Settings = Settings(),
                             overlapping: bool | None = None) -> DataFrame:
    """The user of the device at install time (type 1), else the user whose
    period starts within the look-ahead after the install (type 2, nearest
    whole-day distance, then earliest start).  Installs with neither vanish.

    Both are carried along the device's timeline of installs and period starts, so there is no
    list of candidates (``prioritized_match``); one row an attribution id is kept at the end."""
    ahead = dt.timedelta(days=settings.user_match_lookahead_days)
    m = device_users.select(F.col("device_id").alias("_dev"), F.col("user_id").alias("_user"),
                            F.col("valid_from").alias("_vf"),
                            F.coalesce(F.col("valid_to"), ntz(INFINITY_USER_MATCH)).alias("_vt"))
    keep = [*UAI_COLUMNS[:3], *UAI_COLUMNS[4:]]
    cand = prioritized_match(installs.select(*keep), m, "device_id", "install_time_mmp", "_dev", "_vf", "_vt", ahead,
                             overlapping=overlapping, bucket_hours=settings.timeline_bucket_hours, match="_prio")
    days = F.timestamp_diff("DAY", F.col("install_time_mmp"), F.col("_vf"))
    cand = cand.withColumn("_days", F.when(F.col("_prio") == 2, days).otherwise(F.lit(0))).withColumnRenamed(
        "_user", "user_id")
    best = top1_per_key(cand.select(*UAI_COLUMNS, "_prio", "_days", "_vf"), ["attribution_unique_id"],
                        ["_prio", "_days", "_vf", "user_id"])
    return best.select(*UAI_COLUMNS)


def _mapping_source(dai: DataFrame, device_users: DataFrame, overlapping: bool | None) -> DataFrame:
    u = device_users.select(F.col("device_id").alias("_dev"), "dim_device_user_sk", "user_id",
                            F.col("valid_from").alias("_vf"), F.col("valid_to").alias("_vt"))
    j = as_of_join(dai, u, "device_id", "installtime", "_dev", "_vf", "_vt", closed=True, overlapping=overlapping)
    vh = surrogate_key("dim_device_user_sk", "mediasource", "campaign", "adset", "platform", "join_method")
    return j.select("attribution_unique_id", "appsflyerid", "device_id", "mediasource", "campaign", "adset",
                    "installtime", "platform", "first_touch_timestamp", "join_method", "dim_device_user_sk",
                    "user_id", vh.alias("version_hash"))


def attribution_mapping(dai: DataFrame, device_users: DataFrame, run_ts: dt.datetime,
                        target: DataFrame | None = None, overlapping: bool | None = None) -> DataFrame:
    """SCD2 by version hash.  First run: every row opens at ``run_ts``.
    Later runs emit new versions (new key, or changed hash) opened at ``run_ts``
    and the active versions they replace, closed at the same instant.

    ``overlapping``: whether periods of a device in ``device_users`` overlap.  A first run of J12 makes none; its merges
    may leave stale ones.  None: looked up by a job over the periods."""
    ts = ntz(run_ts)
    out = scd2_by_version_hash(target, _mapping_source(dai, device_users, overlapping), "attribution_unique_id",
                               "version_hash", ts, ntz(INFINITY_ATTRIBUTION), MAPPING_COLUMNS[0],
                               surrogate_key(F.col("attribution_unique_id"), ts))
    return out.select(*MAPPING_COLUMNS)


def attribution_mapping_merged(dai: DataFrame, device_users: DataFrame, run_ts: dt.datetime,
                               target: DataFrame | None = None, overlapping: bool | None = None) -> DataFrame:
    out = attribution_mapping(dai, device_users, run_ts, target, overlapping)
    return upsert(target, out, [MAPPING_COLUMNS[0]], policy="sync_all_columns")

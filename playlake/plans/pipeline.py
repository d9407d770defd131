"""The whole DAG as one run: staging tables, incremental dimensions and facts.

The reference's materializations become:
* view      -> a lazy DataFrame (int_*, cost staging, user_attributed_installs);
* table     -> a full-refresh Parquet table (staging models);
* incremental MERGE -> ``sinks.merge_into_table`` on the model's unique key, with its
  day partitioning, clustering and schema-change policy.
The first run (no table yet) takes each model's full-refresh branch; later runs read
the existing table (the model's ``this``) and take the incremental branch.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from playlake.config import RunWindow, Settings
from playlake.operators.quality import quality_report
from playlake.plans import ads, devices, facts, installs, users
from playlake.plans import events as J1
from playlake.plans import sessions as J2
from playlake.plans.expectations import ALL_EXPECTATIONS
from playlake.sources.sinks import (_exists, as_view, materialize, merge_into_table, read_table, scratch_scope,
                                    write_table)


@dataclass
class RawSources:
    event_log: DataFrame
    organic_installs: DataFrame
    paid_installs: DataFrame
    ad_insights: DataFrame
    google_stats: DataFrame
    google_ad_groups: DataFrame
    google_campaigns: DataFrame
    event_sources: DataFrame


@dataclass(frozen=True)
class Layout:
    keys: tuple[str, ...]
    day_of: str | None = None
    cluster_by: tuple[str, ...] = ()
    policy: str = "ignore"


# Each incremental model's unique key, day partitioning, clustering and
# schema-change policy, as configured by the reference.
LAYOUTS = {
    "fct_events": Layout(("event_id",), "event_timestamp"),
    "fct_sessions": Layout(("session_id",), "session_start_ts"),
    "fct_device_attributed_installs": Layout(("attribution_unique_id",), "install_time_mmp",
                                             ("platform", "mediasource", "campaign"), "append_new_columns"),
    "fct_user_acquisition_daily": Layout(("date", "channel", "campaign_name", "ad_group"), "date",
                                         ("channel", "campaign_name", "ad_group")),
    "dim_devices": Layout(("device_id",)),
    "dim_devices_scd": Layout(("id",)),
    "dim_device_users_scd": Layout(("dim_device_user_sk",), "valid_from", ("device_id", "user_id")),
    "dim__device_user_attribution_mapping": Layout(("dim_device_user_attribution_mapping_sk",), "valid_from",
                                                   ("dim_device_user_sk", "attribution_unique_id"),
                                                   "sync_all_columns"),
}
STAGING_CLUSTER = {"stg_sessions": ("user_id", "device_id")}


def run_pipeline(spark: SparkSession, src: RawSources, warehouse: str, window: RunWindow | None = None,
                 run_ts: dt.datetime | None = None, settings: Settings = Settings()) -> dict[str, str]:
    """Run every model once; returns model name -> table path.

    Default window: the last ``activity_refresh_days`` days; default ``run_ts``: its ``as_of``.
    ``user_attributed_installs`` becomes a temporary view over the stored tables, and the
    declared expectations are written to the table ``quality_report``.  Temporary tables are
    removed at the end.
    """
    window = window or RunWindow.resolve(days=settings.activity_refresh_days)
    with scratch_scope(spark):
        return _run(spark, src, warehouse.rstrip("/"), window, run_ts or window.as_of, settings)


def _run(spark: SparkSession, src: RawSources, wh: str, window: RunWindow, run_ts: dt.datetime,
         settings: Settings) -> dict[str, str]:
    paths: dict[str, str] = {}

    def table(name: str, df: DataFrame) -> DataFrame:
        path = f"{wh}/{name}"
        write_table(df, path, cluster_by=STAGING_CLUSTER.get(name, ()))
        paths[name] = path
        return spark.read.parquet(path)

    def target(name: str) -> DataFrame | None:
        path = f"{wh}/{name}"
        if not _exists(spark, path):
            return None
        day = LAYOUTS[name].day_of
        df = read_table(spark, path, f"{day}_day" if day else None)
        return df.drop(f"{day}_day") if day else df

    def merge(name: str, source: DataFrame, replace_on: tuple[str, ...] | None = None) -> DataFrame:
        lay = LAYOUTS[name]
        path = f"{wh}/{name}"
        merge_into_table(materialize(source, f"{name}_src"), path, lay.keys, lay.day_of, lay.cluster_by, lay.policy,
                         replace_on)
        paths[name] = path
        return target(name)

    ev = table("stg_events", J1.stg_events(src.event_log, src.event_sources, window))
    ses = table("stg_sessions", J2.stg_sessions(ev, settings))
    dev = table("stg_devices", devices.stg_devices(ses))
    att = table("stg_attribution", installs.stg_attribution(src.organic_installs, src.paid_installs, window))

    dim_devices = merge("dim_devices", devices.dim_devices(dev, target("dim_devices")))
    devices_scd = merge("dim_devices_scd", devices.dim_devices_scd(dev, target("dim_devices_scd")))
    ddu = merge("dim_device_users_scd", users.dim_device_users_scd(ses, target("dim_device_users_scd"), settings),
                ("device_id",) if settings.replace_keys else None)

    # a view with three consumers: written once at the fan-out point
    dai = materialize(installs.int_device_attributed_installs(att, dev), "int_device_attributed_installs")
    fct_dai = merge("fct_device_attributed_installs", installs.fct_device_attributed_installs(dai))
    merge("dim__device_user_attribution_mapping",
          installs.attribution_mapping(dai, ddu, run_ts, target("dim__device_user_attribution_mapping")))
    as_view(installs.user_attributed_installs(fct_dai, ddu, settings), "user_attributed_installs")

    dim_users = table("dim_users", facts.dim_users(ses, dai, att))
    fct_sessions = merge("fct_sessions", facts.fct_sessions(ses, dim_users, devices_scd, dim_devices))
    fct_events = merge("fct_events", facts.fct_events(ev, fct_sessions, target("fct_events"), merge=False))

    cost = ads.int_ad_platform(ads.stg_facebook_ads(src.ad_insights),
                               ads.stg_google_ads(src.google_stats, src.google_ad_groups, src.google_campaigns,
                                                  window.as_of, settings))
    merge("fct_user_acquisition_daily", ads.fct_user_acquisition_daily(cost, ads.int_daily_installs(att)))

    models = {"stg_events": ev, "stg_sessions": ses, "stg_attribution": att, "stg_devices": dev,
              "fct_sessions": fct_sessions, "fct_events": fct_events, "dim_users": dim_users,
              "dim_devices_scd": devices_scd, "analytics_events_table": src.event_log,
              "p_ads_AdGroup": src.google_ad_groups}
    table("quality_report", quality_report(spark, models, ALL_EXPECTATIONS))
    return paths

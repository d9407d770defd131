"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Sources are derived from the driver's ``events`` table by the fixture adapters;
every query runs over the whole table.  Array columns are rendered as
comma-joined text (``event_ids``) so results compare across engines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.config import RunWindow, Settings
from playlake.functions import ntz
from playlake.operators.asof import as_of_join
from playlake.operators.quality import quality_report
from playlake.plans.expectations import STAGING_MODELS, for_models
from playlake.operators.upsert import upsert
from playlake.plans import ads, devices, facts, installs, users
from playlake.plans import events as J1
from playlake.plans import sessions as J2
from playlake.sources import fixtures as fx
from playlake.sources.seed import event_sources
from playlake.sources.sinks import materialize, merge_into_table, read_table, scratch_path

def table_window(spark: SparkSession, sf_dir: str) -> RunWindow:
    """The whole table: from the day of its first event to the day after its last; run at that day's start."""
    first, last = fx.read_events(spark, sf_dir).agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    return RunWindow.resolve(first, last and last + dt.timedelta(days=1))


class Inputs:
    """Lazily derived sources and upstream jobs for one data part.

    ``window``: the days that the jobs process; by default all days of the table.  Parts 'p1' and 'p2'
    are the events before and from ``split`` on, some two thirds into the window.
    ``shared``: where it is a dict, all instances for one part share their stored tables."""

    shared: dict | None = None

    def __init__(self, spark: SparkSession, sf_dir: str, part: str = "", window: RunWindow | None = None) -> None:
        self.spark, self.sf_dir, self.part = spark, sf_dir, part
        self.window = window or table_window(spark, sf_dir)
        self._cache: dict[str, DataFrame] = {} if self.shared is None else self.shared.setdefault((sf_dir, part), {})

    def _memo(self, key: str, fn: Callable[[], DataFrame]) -> DataFrame:
        if key not in self._cache:
            self._cache[key] = fn()
        return self._cache[key]

    @property
    def split(self) -> dt.datetime:
        days = (self.window.end - self.window.start).days * 19 // 30
        return dt.datetime.combine(self.window.start + dt.timedelta(days=days), dt.time())

    @property
    def run_ts(self) -> dt.datetime:
        return self.split if self.part == "p1" else self.window.as_of

    def events(self) -> DataFrame:
        ev = fx.read_events(self.spark, self.sf_dir)
        split = ntz(self.split)
        if self.part == "p1":
            return ev.filter(F.col("ts") < split)
        if self.part == "p2":
            return ev.filter(F.col("ts") >= split)
        if self.part == "hot":
            # one device with over a third of the events, in bursts far shorter than a day
            return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
        return ev

    def stg_events(self) -> DataFrame:
        """Staging table (materialized, as in the reference)."""
        return self._memo("stg_events", lambda: materialize(J1.stg_events(
            fx.raw_event_log(self.events()), event_sources(self.spark), self.window), f"stg_events{self.part}"))

    def stg_sessions(self, timeout: int = 10) -> DataFrame:
        """Staging table (materialized, as in the reference)."""
        return self._memo(f"stg_sessions{timeout}", lambda: materialize(J2.stg_sessions(
            self.stg_events(), Settings(session_timeout_minutes=timeout)), f"stg_sessions{self.part}"))

    def stg_devices(self) -> DataFrame:
        return self._memo("stg_devices", lambda: materialize(devices.stg_devices(self.stg_sessions()),
                                                             f"stg_devices{self.part}"))

    def dim_devices(self) -> DataFrame:
        """Dimensions are tables in the reference, with several consumers: written once."""
        return self._memo("dim_devices", lambda: materialize(devices.dim_devices(self.stg_devices()),
                                                             f"dim_devices{self.part}"))

    def dim_devices_scd(self) -> DataFrame:
        return self._memo("dim_devices_scd", lambda: materialize(devices.dim_devices_scd(self.stg_devices()),
                                                                 f"dim_devices_scd{self.part}"))

    def dim_device_users_scd(self) -> DataFrame:
        """An incremental table in the reference with several consumers: written once."""
        return self._memo("ddu", lambda: materialize(users.dim_device_users_scd(self.stg_sessions()),
                                                     f"dim_device_users_scd{self.part}"))

    def stg_attribution(self) -> DataFrame:
        ev = self.events()
        return self._memo("stg_attribution", lambda: materialize(installs.stg_attribution(
            fx.organic_installs_report(ev), fx.paid_installs_report(ev), self.window), f"stg_attribution{self.part}"))

    def dai(self) -> DataFrame:
        """A view with three consumers: written once (fan-out point)."""
        return self._memo("dai", lambda: materialize(installs.int_device_attributed_installs(
            self.stg_attribution(), self.stg_devices()), f"dai{self.part}"))

    def fct_dai(self) -> DataFrame:
        return self._memo("fct_dai", lambda: installs.fct_device_attributed_installs(self.dai()))

    def dim_users(self) -> DataFrame:
        return self._memo("dim_users", lambda: materialize(facts.dim_users(
            self.stg_sessions(), self.dai(), self.stg_attribution()), f"dim_users{self.part}"))

    def fct_sessions(self) -> DataFrame:
        """A table in the reference, read by the event fact: written once."""
        return self._memo("fct_sessions", lambda: materialize(facts.fct_sessions(
            self.stg_sessions(), self.dim_users(), self.dim_devices_scd(), self.dim_devices()), f"fct_sessions{self.part}"))

    def fct_events(self, target: DataFrame | None = None) -> DataFrame:
        return facts.fct_events(self.stg_events(), self.fct_sessions(), target)

    def facebook(self) -> DataFrame:
        return ads.stg_facebook_ads(fx.ad_insights(self.events()))

    def google(self) -> DataFrame:
        ev = self.events()
        return ads.stg_google_ads(fx.google_ad_group_stats(ev), fx.google_ad_groups(ev), fx.google_campaigns(ev),
                                  self.window.as_of)

    def ad_platform(self) -> DataFrame:
        return ads.int_ad_platform(self.facebook(), self.google())

    def daily_installs(self) -> DataFrame:
        return ads.int_daily_installs(self.stg_attribution())




def _ids_as_text(df: DataFrame, col: str = "event_ids_in_session") -> DataFrame:
    return df.withColumn("event_ids", F.array_join(col, ",")).drop(col)


def _open_end_as_text(df: DataFrame) -> DataFrame:
    """Render ``valid_to`` as text: open periods end in year 9999, which pandas'
    nanosecond timestamps cannot hold; the library keeps the TIMESTAMP."""
    return df.withColumn("valid_to", F.col("valid_to").cast("string"))


def _parts(spark: SparkSession, sf: str) -> tuple[Inputs, Inputs]:
    first = Inputs(spark, sf, "p1")
    return first, Inputs(spark, sf, "p2", first.window)


def q_stg_events(spark, sf):
    return Inputs(spark, sf).stg_events()


def q_identity_map(spark, sf):
    return J2.identity_map(Inputs(spark, sf).stg_events())


def q_stg_sessions(spark, sf):
    return _ids_as_text(Inputs(spark, sf).stg_sessions(10))


def q_stg_sessions_t720(spark, sf):
    return _ids_as_text(Inputs(spark, sf).stg_sessions(720))


def q_stg_sessions_hot_device(spark, sf):
    """All events, with a third of them moved to one device."""
    return _ids_as_text(Inputs(spark, sf, "hot").stg_sessions(720))


def q_sessions_by_window(spark, sf):
    """The native session_window form at a 12-hour timeout: per-session counts."""
    from playlake.operators.sessionize import sessions_by_window
    i = Inputs(spark, sf)
    se = i.stg_events()
    ev = J2.stitch(J2.frontend_events(se), J2.identity_map(se))
    ev = ev.withColumn("session_key", F.coalesce("stitched_user_id", "device_id"))
    g = sessions_by_window(ev, ["session_key", "device_id"], "event_timestamp", 720)
    return g.agg(F.min("event_timestamp").alias("session_start_ts"), F.max("event_timestamp").alias("session_end_ts"),
                 F.count("event_id").alias("event_count")).drop("sw")


def q_stg_devices(spark, sf):
    return Inputs(spark, sf).stg_devices()


def q_dim_devices(spark, sf):
    return Inputs(spark, sf).dim_devices()


def q_dim_devices_incremental(spark, sf):
    p1, p2 = _parts(spark, sf)
    first = devices.dim_devices(p1.stg_devices())
    return devices.dim_devices_merged(p2.stg_devices(), first)


def q_dim_devices_scd(spark, sf):
    return _open_end_as_text(Inputs(spark, sf).dim_devices_scd())


def q_dim_devices_scd_incremental(spark, sf):
    p1, p2 = _parts(spark, sf)
    first = devices.dim_devices_scd(p1.stg_devices())
    return _open_end_as_text(devices.dim_devices_scd_merged(p2.stg_devices(), first))


def q_dim_device_users_scd(spark, sf):
    return _open_end_as_text(Inputs(spark, sf).dim_device_users_scd())


def q_dim_device_users_scd_incremental(spark, sf):
    p1, p2 = _parts(spark, sf)
    first = users.dim_device_users_scd(p1.stg_sessions())
    return _open_end_as_text(users.dim_device_users_scd_merged(p2.stg_sessions(), first))


def q_stg_attribution(spark, sf):
    return Inputs(spark, sf).stg_attribution()


def q_int_device_attributed_installs(spark, sf):
    return Inputs(spark, sf).dai()


def q_fct_device_attributed_installs(spark, sf):
    return Inputs(spark, sf).fct_dai()


def q_user_attributed_installs(spark, sf):
    i = Inputs(spark, sf)
    return installs.user_attributed_installs(i.fct_dai(), i.dim_device_users_scd())


def q_attribution_mapping_full(spark, sf):
    i = Inputs(spark, sf)
    return _open_end_as_text(installs.attribution_mapping(i.dai(), i.dim_device_users_scd(), i.run_ts))


def q_attribution_mapping_incremental(spark, sf):
    p1, p2 = _parts(spark, sf)
    # both are incremental tables in the reference, read several times by the second run: written once
    first = materialize(installs.attribution_mapping(p1.dai(), p1.dim_device_users_scd(), p1.run_ts), "attribution_mappingp1")
    # the second run reads the device->user dimension as merged by its own second run
    ddu = materialize(users.dim_device_users_scd_merged(p2.stg_sessions(), p1.dim_device_users_scd()),
                      "dim_device_users_scd_merged")
    return _open_end_as_text(installs.attribution_mapping_merged(p2.dai(), ddu, p2.run_ts, first))


def q_dim_users(spark, sf):
    return Inputs(spark, sf).dim_users()


def q_fct_sessions(spark, sf):
    return _ids_as_text(Inputs(spark, sf).fct_sessions())


def q_fct_events(spark, sf):
    return Inputs(spark, sf).fct_events()


def q_fct_events_incremental(spark, sf):
    p1, p2 = _parts(spark, sf)
    return p2.fct_events(target=p1.fct_events())


def q_stg_facebook_ads(spark, sf):
    return Inputs(spark, sf).facebook()


def q_stg_google_ads(spark, sf):
    return Inputs(spark, sf).google()


def q_int_ad_platform(spark, sf):
    return Inputs(spark, sf).ad_platform()


def q_int_daily_installs(spark, sf):
    return Inputs(spark, sf).daily_installs()


def q_fct_user_acquisition_daily(spark, sf):
    i = Inputs(spark, sf)
    return ads.fct_user_acquisition_daily(i.ad_platform(), i.daily_installs())


def q_user_activity(spark, sf):
    i = Inputs(spark, sf)
    return facts.user_activity(i.stg_events(), i.dim_users(), i.window.as_of)


STAGING_EXPECTATIONS = for_models(STAGING_MODELS)


def q_quality_report(spark, sf):
    i = Inputs(spark, sf)
    models = {"stg_events": i.stg_events(), "stg_sessions": i.stg_sessions(),
              "stg_attribution": i.stg_attribution(), "stg_devices": i.stg_devices()}
    return quality_report(spark, models, STAGING_EXPECTATIONS)


MART_MODELS = ("fct_sessions", "fct_events", "dim_users", "dim_devices_scd", "analytics_events_table",
               "p_ads_AdGroup")


def q_quality_report_marts(spark, sf):
    """The fact/dimension/source expectations; declared columns a model does not
    output (e.g. platform of the device-version dimension) report NULL."""
    i = Inputs(spark, sf)
    # several passes read the event fact too
    sessions = i.fct_sessions()
    events = materialize(i.fct_events(), "fct_events")
    models = {"fct_sessions": sessions, "fct_events": events, "dim_users": i.dim_users(),
              "dim_devices_scd": i.dim_devices_scd(), "analytics_events_table": fx.raw_event_log(i.events()),
              "p_ads_AdGroup": fx.google_ad_groups(i.events())}
    return quality_report(spark, models, for_models(MART_MODELS))


def q_upsert_schema_sync(spark, sf):
    """Schema evolution: a target without ``country`` and with a retired column,
    merged with the new events under ``sync_all_columns``."""
    p1, p2 = _parts(spark, sf)
    target = p1.stg_events().drop("country").withColumn("legacy_flag", F.lit(True))
    return upsert(target, p2.stg_events(), ["event_id"], policy="sync_all_columns")


#: days that both deliveries of the merge queries hold
OVERLAP = dt.timedelta(days=3)


def _deliveries(spark, sf):
    """All events in two deliveries; the days around the split come in both."""
    i = Inputs(spark, sf)
    ev = fx.read_events(spark, sf)
    return ev.filter(F.col("ts") < ntz(i.split + OVERLAP)), ev.filter(F.col("ts") >= ntz(i.split))


def q_merge_null_day(spark, sf):
    """Two deliveries merged into a stored day-partitioned table and read back.

    Every seventh event has no time (the NULL day); the second delivery moves rows between days."""
    first, second = _deliveries(spark, sf)
    timed = F.col("event_id") % 7 != 0
    later = F.col("ts") + F.make_dt_interval(F.col("event_id") % 4)
    path = scratch_path(spark, "merge_null_day")
    for delivery, ts, name in ((first, F.col("ts"), "first"), (second, later, "second")):
        rows = delivery.select(F.col("event_id").alias("k"), F.when(timed, ts).alias("ts"), F.lit(name).alias("v"))
        merge_into_table(rows, path, ["k"], partition_day_of="ts")
    return read_table(spark, path, "ts_day").drop("ts_day")


def q_merge_schema_evolution(spark, sf):
    """A second delivery with a new and without an old column, under both policies."""
    first, second = _deliveries(spark, sf)
    first = first.select(F.col("event_id").alias("k"), "ts", F.col("event_type").alias("old_col"))
    second = second.select(F.col("event_id").alias("k"), "ts", F.col("value").alias("new_col"))
    found = []
    for policy in ("append_new_columns", "sync_all_columns"):
        path = scratch_path(spark, "merge_schema")
        merge_into_table(first, path, ["k"], partition_day_of="ts")
        merge_into_table(second, path, ["k"], partition_day_of="ts", policy=policy)
        found.append(read_table(spark, path, "ts_day").drop("ts_day").withColumn("policy", F.lit(policy)))
    return found[0].unionByName(found[1], allowMissingColumns=True).select("policy", "k", "ts", "old_col", "new_col")


def q_merge_two_runs_fct_events(spark, sf):
    """Two runs of the event fact through the stored merge, read back."""
    path = scratch_path(spark, "fct_events")
    for part in _parts(spark, sf):
        target = read_table(spark, path, "event_timestamp_day").drop("event_timestamp_day") if part.part == "p2" else None
        run = facts.fct_events(part.stg_events(), part.fct_sessions(), target, merge=False)
        merge_into_table(materialize(run, "fct_events_src"), path, ["event_id"], partition_day_of="event_timestamp")
    return read_table(spark, path, "event_timestamp_day").drop("event_timestamp_day")


def q_interval_edge_cases(spark, sf):
    """Points up to 2099 in open, century-long, overlapping and backwards periods; points without one stay."""
    s = Inputs(spark, sf).stg_sessions(10)
    at = F.when(F.col("event_count") % 5 == 0, F.col("session_start_ts") + F.expr("INTERVAL 75 YEAR")).otherwise(F.col("session_start_ts"))
    points = s.select("session_id", "device_id", at.alias("at"))

    def periods(kind, opens, closes, rows):
        return rows.select(F.col("device_id").alias("period_device"), F.lit(kind).alias("kind"), opens.alias("opens"), closes.alias("closes"))

    def moment(text):
        return F.lit(text).cast("timestamp_ntz")
    per = s.groupBy("device_id").agg(F.min("session_start_ts").alias("a"), F.max("session_start_ts").alias("b"),
                                     F.max("session_end_ts").alias("c"))
    all_periods = (periods("open", F.col("a"), moment("9999-12-31 23:59:59"), per)
                   .unionByName(periods("century", moment("1950-06-01 00:00:00"), F.col("b"), per))
                   .unionByName(periods("session", F.col("session_start_ts"), F.col("session_end_ts"), s))
                   .unionByName(periods("backwards", F.col("c"), F.col("a"), per)))
    met = as_of_join(points, all_periods, "device_id", "at", "period_device", "opens", "closes", closed=True)
    return met.groupBy("session_id", "at").agg(
        F.count("kind").alias("periods"), *[F.count(F.when(F.col("kind") == k, 1)).alias(f"{n}_periods")
                                            for n, k in (("open", "open"), ("long", "century"), ("session", "session"))])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stg_events": q_stg_events,
    "identity_map": q_identity_map,
    "stg_sessions": q_stg_sessions,
    "stg_sessions_t720": q_stg_sessions_t720,
    "stg_sessions_hot_device": q_stg_sessions_hot_device,
    "sessions_by_window": q_sessions_by_window,
    "stg_devices": q_stg_devices,
    "dim_devices": q_dim_devices,
    "dim_devices_incremental": q_dim_devices_incremental,
    "dim_devices_scd": q_dim_devices_scd,
    "dim_devices_scd_incremental": q_dim_devices_scd_incremental,
    "dim_device_users_scd": q_dim_device_users_scd,
    "dim_device_users_scd_incremental": q_dim_device_users_scd_incremental,
    "stg_attribution": q_stg_attribution,
    "int_device_attributed_installs": q_int_device_attributed_installs,
    "fct_device_attributed_installs": q_fct_device_attributed_installs,
    "user_attributed_installs": q_user_attributed_installs,
    "attribution_mapping_full": q_attribution_mapping_full,
    "attribution_mapping_incremental": q_attribution_mapping_incremental,
    "dim_users": q_dim_users,
    "fct_sessions": q_fct_sessions,
    "fct_events": q_fct_events,
    "fct_events_incremental": q_fct_events_incremental,
    "stg_facebook_ads": q_stg_facebook_ads,
    "stg_google_ads": q_stg_google_ads,
    "int_ad_platform": q_int_ad_platform,
    "int_daily_installs": q_int_daily_installs,
    "fct_user_acquisition_daily": q_fct_user_acquisition_daily,
    "user_activity": q_user_activity,
    "quality_report": q_quality_report,
    "quality_report_marts": q_quality_report_marts,
    "upsert_schema_sync": q_upsert_schema_sync,
    "merge_null_day": q_merge_null_day,
    "merge_schema_evolution": q_merge_schema_evolution,
    "merge_two_runs_fct_events": q_merge_two_runs_fct_events,
    "interval_edge_cases": q_interval_edge_cases,
}

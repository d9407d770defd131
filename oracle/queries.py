"""The oracle SQL per registered query key."""

from __future__ import annotations

from oracle import jobs
from oracle.builder import Query


def _sql(builder, *args, **kw) -> str:
    q = Query()
    name = builder(q, *args, **kw)
    return q.sql(f"SELECT * FROM {name}")


def _sql_open_end(builder, *args, **kw) -> str:
    q = Query()
    name = builder(q, *args, **kw)
    return q.sql(f"SELECT * REPLACE (CAST(valid_to AS VARCHAR) AS valid_to) FROM {name}")


STAGING = ("stg_events", "stg_sessions", "stg_attribution", "stg_devices")
MARTS = ("fct_sessions", "fct_events", "dim_users", "dim_devices_scd", "analytics_events_table", "p_ads_AdGroup")


def oracle_sql() -> dict[str, str]:
    return {
        "stg_events": _sql(jobs.stg_events),
        "identity_map": _sql(jobs.identity_map),
        "stg_sessions": _sql(jobs.stg_sessions, "", 10),
        "stg_sessions_t720": _sql(jobs.stg_sessions, "", 720),
        "stg_sessions_hot_device": _sql(jobs.stg_sessions, "_hot", 720),
        "sessions_by_window": _sql(jobs.sessions_by_window),
        "stg_devices": _sql(jobs.stg_devices),
        "dim_devices": _sql(jobs.dim_devices),
        "dim_devices_incremental": _sql(jobs.dim_devices_incremental),
        "dim_devices_scd": _sql_open_end(jobs.dim_devices_scd),
        "dim_devices_scd_incremental": _sql_open_end(jobs.dim_devices_scd_incremental),
        "dim_device_users_scd": _sql_open_end(jobs.dim_device_users_scd),
        "dim_device_users_scd_incremental": _sql_open_end(jobs.dim_device_users_scd_incremental),
        "stg_attribution": _sql(jobs.stg_attribution),
        "int_device_attributed_installs": _sql(jobs.dai),
        "fct_device_attributed_installs": _sql(jobs.fct_dai),
        "user_attributed_installs": _sql(jobs.user_attributed_installs),
        "attribution_mapping_full": _sql_open_end(jobs.attribution_mapping_full),
        "attribution_mapping_incremental": _sql_open_end(jobs.attribution_mapping_incremental),
        "dim_users": _sql(jobs.dim_users),
        "fct_sessions": _sql(jobs.fct_sessions),
        "fct_events": _sql(jobs.fct_events),
        "fct_events_incremental": _sql(jobs.fct_events_incremental),
        "stg_facebook_ads": _sql(jobs.stg_facebook_ads),
        "stg_google_ads": _sql(jobs.stg_google_ads),
        "int_ad_platform": _sql(jobs.int_ad_platform),
        "int_daily_installs": _sql(jobs.int_daily_installs),
        "fct_user_acquisition_daily": _sql(jobs.fct_user_acquisition_daily),
        "user_activity": _sql(jobs.user_activity),
        "quality_report": _sql(jobs.quality_report, STAGING),
        "quality_report_marts": _sql(jobs.quality_report, MARTS, "qr_marts"),
        "upsert_schema_sync": _sql(jobs.upsert_schema_sync),
        "merge_null_day": _sql(jobs.merge_null_day),
        "merge_schema_evolution": _sql(jobs.merge_schema_evolution),
        "merge_two_runs_fct_events": _sql(jobs.fct_events_incremental),
        "interval_edge_cases": _sql(jobs.interval_edge_cases),
    }

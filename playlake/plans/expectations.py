"""The reference's declarative column tests (46: 40 not_null, 6 unique)."""

from __future__ import annotations

from playlake.operators.quality import Expectation

# Fixed values: (model, column, test) as declared by the reference's schema files.
_DECLARED = [
    ("stg_events", "event_timestamp", "not_null"), ("stg_events", "event_name", "not_null"),
    ("stg_events", "event_id", "not_null"), ("stg_events", "event_id", "unique"),
    ("stg_events", "event_source", "not_null"),
    ("stg_sessions", "session_id", "not_null"), ("stg_sessions", "session_id", "unique"),
    ("stg_sessions", "device_id", "not_null"), ("stg_sessions", "session_start_ts", "not_null"),
    ("stg_sessions", "session_end_ts", "not_null"), ("stg_sessions", "session_length_seconds", "not_null"),
    ("stg_sessions", "event_count", "not_null"),
    ("stg_attribution", "installtime", "not_null"), ("stg_attribution", "mediasource", "not_null"),
    ("stg_attribution", "appsflyerid", "not_null"), ("stg_attribution", "platform", "not_null"),
    ("stg_attribution", "extraction_date", "not_null"), ("stg_attribution", "unique_id", "not_null"),
    ("stg_attribution", "unique_id", "unique"),
    ("stg_devices", "device_id", "not_null"), ("stg_devices", "first_touch_timestamp", "not_null"),
    ("fct_sessions", "session_id", "not_null"), ("fct_sessions", "session_id", "unique"),
    ("fct_sessions", "user_id", "not_null"), ("fct_sessions", "device_id", "not_null"),
    ("fct_sessions", "session_start_ts", "not_null"), ("fct_sessions", "session_end_ts", "not_null"),
    ("fct_sessions", "session_length_seconds", "not_null"), ("fct_sessions", "event_count", "not_null"),
    ("fct_events", "event_timestamp", "not_null"), ("fct_events", "event_name", "not_null"),
    ("fct_events", "event_id", "not_null"), ("fct_events", "event_id", "unique"),
    ("fct_events", "device_id", "not_null"),
    ("dim_users", "user_id", "not_null"), ("dim_users", "first_touch_timestamp", "not_null"),
    ("dim_users", "last_touch_timestamp", "not_null"),
    ("dim_devices_scd", "id", "not_null"), ("dim_devices_scd", "id", "unique"),
    ("dim_devices_scd", "device_id", "not_null"), ("dim_devices_scd", "platform", "not_null"),
    ("dim_devices_scd", "app_version", "not_null"), ("dim_devices_scd", "os_version", "not_null"),
    ("dim_devices_scd", "valid_from", "not_null"),
    ("analytics_events_table", "publish_time", "not_null"),
    ("p_ads_AdGroup", "campaign_id", "not_null"),
]

ALL_EXPECTATIONS = [Expectation(m, c, t) for m, c, t in _DECLARED]
STAGING_MODELS = ("stg_events", "stg_sessions", "stg_attribution", "stg_devices")


def for_models(models) -> list[Expectation]:
    return [e for e in ALL_EXPECTATIONS if e.model in set(models)]

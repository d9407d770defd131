"""The 46 column tests, written out from the schema files for the oracle (fixed values).

One line a model: columns that must not be null, then columns that must be unique."""

EXPECTED = """
stg_events: event_timestamp event_name event_id event_source | event_id
stg_sessions: session_id device_id session_start_ts session_end_ts session_length_seconds event_count | session_id
stg_attribution: installtime mediasource appsflyerid platform extraction_date unique_id | unique_id
stg_devices: device_id first_touch_timestamp |
fct_sessions: session_id user_id device_id session_start_ts session_end_ts session_length_seconds event_count | session_id
fct_events: event_timestamp event_name event_id device_id | event_id
dim_users: user_id first_touch_timestamp last_touch_timestamp |
dim_devices_scd: id device_id platform app_version os_version valid_from | id
analytics_events_table: publish_time |
p_ads_AdGroup: campaign_id |
"""


def expected() -> dict[str, list[tuple[str, str]]]:
    """model -> (column, test) in any order."""
    out = {}
    for line in EXPECTED.split("\n"):
        if line:
            model, _, rest = line.partition(":")
            filled, single = rest.split("|")
            out[model] = [(c, "not_null") for c in filled.split()] + [(c, "unique") for c in single.split()]
    return out

"""Job parameters (the reference's project variables) and fixed constants."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Fixed values that must equal the reference for identical results.
# The four spellings of "infinity" used as open SCD period ends, one per job.
INFINITY_DEVICE_USERS = dt.datetime(9999, 12, 31, 23, 59, 59, 999999)  # device->user SCD2
INFINITY_DEVICE_VERSIONS = dt.datetime(9999, 12, 31, 23, 59, 59)  # device version SCD2
INFINITY_ATTRIBUTION = dt.datetime(9999, 12, 31)  # attribution mapping SCD2
INFINITY_USER_MATCH = dt.datetime(9999, 12, 31, 23, 59, 59)  # NULL valid_to in the user match
# Zero / blank advertising ids scrubbed from the event stream.
BLOCKED_AD_IDS = ("", "00000000-0000-0000-0000-000000000000", "0000-0000")
ANONYMOUS_USER = "ANONYMOUS"
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


@dataclass(frozen=True)
class Settings:
    """Tunable parameters; defaults equal the reference's declared variables."""

    session_timeout_minutes: int = 10
    activity_refresh_days: int = 7
    attribution_window_days: int = 10  # declared by the reference, never read
    null_user_placeholder: str = "___UNKNOWN_USER___"
    device_users_lookback_days: int = 30  # declared by the reference, never read
    name_snapshot_lookback_days: int = 30
    user_match_lookahead_days: int = 4
    # Width of the time buckets that split one device's timeline into
    # independently sorted pieces (skew guard for per-device windows).
    timeline_bucket_hours: int = 24
    # Device-user periods: let rows that repeat a NULL user share one period (Q2)
    collapse_null_runs: bool = False
    # Device-user merge: replace all periods of the devices in a run, not only equal keys (Q3)
    replace_keys: bool = False


@dataclass(frozen=True)
class RunWindow:
    """A processing window: events use [start, end), install reports [start, end]."""

    start: dt.date
    end: dt.date
    as_of: dt.datetime  # replaces CURRENT_TIMESTAMP(): one value per run

    @staticmethod
    def resolve(start: dt.date | str | None = None, end: dt.date | str | None = None,
                today: dt.date | None = None, days: int = 7,
                as_of: dt.datetime | None = None) -> "RunWindow":
        """Defaults: start = today - days, end = today (like the date-range macro)."""
        today = today or dt.date.today()
        s = _as_date(start) if start is not None else today - dt.timedelta(days=days)
        e = _as_date(end) if end is not None else today
        a = as_of or dt.datetime.combine(e, dt.time())
        return RunWindow(s, e, a)


def _as_date(v: dt.date | str) -> dt.date:
    if isinstance(v, dt.datetime):
        return v.date()
    if isinstance(v, dt.date):
        return v
    return dt.date.fromisoformat(v)

"""Column-building helpers: every function returns a ``pyspark.sql.Column``."""

from playlake.functions.json import json_scalar, parse
from playlake.functions.keys import fingerprint64, surrogate_key
from playlake.functions.text import clean_text, scrub_ad_id
from playlake.functions.aggregates import first_value_by, ordered_ids
from playlake.functions.time import (
    timestamp_from_millis, minus_micro, start_of_day, timeline_bucket,
    ntz, micros_since_epoch,
)

__all__ = [
    "json_scalar", "parse",
    "fingerprint64", "surrogate_key",
    "clean_text", "scrub_ad_id",
    "first_value_by", "ordered_ids",
    "timestamp_from_millis", "minus_micro", "start_of_day",
    "timeline_bucket", "ntz", "micros_since_epoch",
]

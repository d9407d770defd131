"""String cleaning used by the event stream."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playlake.config import BLOCKED_AD_IDS


def clean_text(c: Column) -> Column:
    """trim, blank -> NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def scrub_ad_id(ad_id: Column, raw_platform: Column, platform: str) -> Column:
    """NULL out blank/zero advertising ids, only on ``platform`` (lowered, not trimmed).

    A NULL platform scrubs nothing (the condition is NULL, so the value is kept).
    """
    trimmed = F.trim(ad_id)
    blocked = trimmed.isin(*BLOCKED_AD_IDS) & (F.lower(raw_platform) == F.lit(platform))
    return F.when(blocked, F.lit(None).cast("string")).otherwise(trimmed)

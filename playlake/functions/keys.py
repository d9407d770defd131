"""Deterministic keys: 64-bit fingerprints, hex digests and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playlake.config import SURROGATE_NULL


def fingerprint64(text: Column) -> Column:
    """Stable non-negative BIGINT key of a string: first 60 bits of its MD5.

    Plays the role of the warehouse's 64-bit string fingerprint (stable, 1:1 with
    the text for practical purposes); the bits differ.  NULL in -> NULL out.
    Portable: any engine with md5 and hex parsing yields the same value.
    """
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over '-'-joined parts; NULL parts become a fixed placeholder."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(SURROGATE_NULL))
             for c in cols]
    return F.md5(F.concat_ws("-", *parts))

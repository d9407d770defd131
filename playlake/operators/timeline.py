"""Exact per-key ``lag`` / ``lead`` / next-non-NULL over a time order, skew-safe.

A window ``partition by key order by ts`` puts every row of a key in one task; a key
with a third of all rows becomes one giant sorted partition.  These helpers cut each
key's timeline into time buckets (``bucket`` column):

* the window runs per (key, bucket), so a hot key is spread over its buckets;
* rows whose neighbour lies in another bucket take it from a per-(key, bucket) summary
  (a partial aggregate); the summaries go through a window per key that is bounded by
  the number of buckets of one key, not by its rows, and are joined back on
  (key, bucket).

Results equal the single-window functions for any bucket width (tested).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_bucket"


def _order(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _carry(df: DataFrame, key: str, carry: DataFrame, out: str, pick: Column) -> DataFrame:
    joined = df.join(carry, on=[key, BUCKET], how="left")
    return joined.withColumn(out, pick).drop("_carry")


def lag_across(df: DataFrame, key: str, order: Sequence[Column | str], value: str, out: str) -> DataFrame:
    """``out`` = ``value`` of the previous row of ``key`` in ``order`` (NULL for the first)."""
    o = _order(order)
    wl = Window.partitionBy(key, BUCKET).orderBy(*o)
    x = df.withColumn(out, F.lag(value).over(wl)).withColumn("_first", F.row_number().over(wl) == 1)
    last = df.groupBy(key, BUCKET).agg(F.max_by(F.col(value), F.struct(*o)).alias("_last"))
    wb = Window.partitionBy(key).orderBy(BUCKET)
    carry = last.select(key, BUCKET, F.lag("_last").over(wb).alias("_carry"))
    return _carry(x, key, carry, out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col(out))).drop("_first")


def lead_across(df: DataFrame, key: str, order: Sequence[Column | str], value: str, out: str) -> DataFrame:
    """``out`` = ``value`` of the next row of ``key`` in ``order`` (NULL for the last)."""
    o = _order(order)
    wl = Window.partitionBy(key, BUCKET).orderBy(*o)
    # one window gives both: the row after the last one has no marker
    x = df.withColumn(out, F.lead(value).over(wl)).withColumn("_last", F.lead(F.lit(True)).over(wl).isNull())
    first = df.groupBy(key, BUCKET).agg(F.min_by(F.col(value), F.struct(*o)).alias("_first"))
    wb = Window.partitionBy(key).orderBy(BUCKET)
    carry = first.select(key, BUCKET, F.lead("_first").over(wb).alias("_carry"))
    return _carry(x, key, carry, out, F.when(F.col("_last"), F.col("_carry")).otherwise(F.col(out))).drop("_last")


def next_non_null_across(df: DataFrame, key: str, order: Sequence[Column | str], value: str, out: str) -> DataFrame:
    """``out`` = first non-NULL ``value`` strictly after the row (in ``order``) within ``key``."""
    o = _order(order)
    wl = Window.partitionBy(key, BUCKET).orderBy(*o).rowsBetween(1, Window.unboundedFollowing)
    x = df.withColumn(out, F.first(value, ignorenulls=True).over(wl))
    v = F.col(value)
    firstnn = df.groupBy(key, BUCKET).agg(F.min_by(v, F.when(v.isNotNull(), F.struct(*o))).alias("_fnn"))
    wb = Window.partitionBy(key).orderBy(BUCKET).rowsBetween(1, Window.unboundedFollowing)
    carry = firstnn.select(key, BUCKET, F.first("_fnn", ignorenulls=True).over(wb).alias("_carry"))
    return _carry(x, key, carry, out, F.coalesce(F.col(out), F.col("_carry")))

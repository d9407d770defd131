"""As-of joins by a carried row: points and period starts in one timeline, one exchange of the points.

A point lies in the last period that started at or before it, if periods of a key do not overlap.  So points and
period starts are put into one timeline, cut into (key, time bucket) pieces, and one window per piece
carries the latest start to the points after it.  What a piece starts with comes from the buckets before: one
row per (key, bucket), the result of a window over bucket summaries (bounded by a key's buckets,
never by its rows), is put into the timeline as its first row.  No point is copied, no key meets
all its periods, and a key with a third of all rows is spread over its buckets.

Looking ahead works the same in the other direction: the nearest start after a point is the running
minimum over the rows behind it.

Overlapping periods cannot be carried.  ``overlapping=None`` has one job over the periods decide whether there
are any.  If so, only periods that overlap another go through the cells of ``intervals``, for points
that no other period holds.  ``overlapping=False`` says that there are none, by construction; the
plan checks it and raises where it is not so.

Points without a key or time, and periods without a key, start or end, match nothing.  Periods that end
before they start hold no point; as a start ahead they count for points before their end only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlake.functions.time import timeline_bucket
from playlake.operators.intervals import point_in_interval_join

#: rows of a timeline, in the order they stand at one time
_PERIOD, _POINT = 0, 1
_BEFORE = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def _all(df: DataFrame) -> Column:
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])


def _unpack(struct: str, df: DataFrame) -> list[Column]:
    return [F.col(struct).getField(f.name).alias(f.name) for f in df.schema]


def _holds(start: Column, end: Column, closed: bool) -> Column:
    """Whether a period holds any time at all."""
    return (start <= end) if closed else (start < end)


def _meets(end: Column, start: Column, closed: bool) -> Column:
    """Whether a period that ends at ``end`` overlaps one that starts, later or at once, at ``start``."""
    return (end >= start) if closed else (end > start)


def mark_overlaps(periods: DataFrame, key: str, start: str, end: str, closed: bool, bucket_hours: int = 24) -> DataFrame:
    """``periods`` that hold any time, with ``_overlaps``: whether another period of the key overlaps it."""
    p = periods.filter(F.col(key).isNotNull() & _holds(F.col(start), F.col(end), closed)).withColumn(
        "_bucket", timeline_bucket(F.col(start), bucket_hours))
    inside = Window.partitionBy(key, "_bucket").orderBy(start, end)
    p = (p.withColumn("_ended", F.max(end).over(inside.rowsBetween(*_BEFORE)))
          .withColumn("_next", F.lead(start).over(inside)))
    across = Window.partitionBy(key).orderBy("_bucket")
    summary = p.groupBy(key, "_bucket").agg(F.min(start).alias("_first"), F.max(end).alias("_last"))
    summary = summary.select(key, "_bucket", F.max("_last").over(across.rowsBetween(*_BEFORE)).alias("_ended_before"),
                             F.lead("_first").over(across).alias("_next_after"))
    p = p.join(summary, [key, "_bucket"])
    ended = F.greatest("_ended", "_ended_before")
    following = F.coalesce("_next", "_next_after")
    return p.withColumn("_overlaps", F.coalesce(_meets(ended, F.col(start), closed), F.lit(False))
                        | F.coalesce(_meets(F.col(end), following, closed), F.lit(False))).drop(
        "_bucket", "_ended", "_next", "_ended_before", "_next_after")


def has_overlaps(periods: DataFrame, key: str, start: str, end: str, closed: bool) -> bool:
    """One job over the periods' key, start and end."""
    marked = mark_overlaps(periods.select(key, start, end), key, start, end, closed)
    return bool(marked.filter("_overlaps").limit(1).count())


def _carried(points: DataFrame, periods: DataFrame, key: str, ts: str, period_key: str, start: str, end: str,
             closed: bool, ahead: bool, check: bool, bucket_hours: int) -> DataFrame:
    """``_point`` (all of a point), ``_at`` (the period it lies in) and, with ``ahead``, ``_next`` (the period
    of least start, then least other columns, among those beginning and not ended after it)."""
    whole = _all(periods)
    at = F.when(_holds(F.col(start), F.col(end), closed), whole)
    seen = periods.filter(F.col(period_key).isNotNull() & F.col(start).isNotNull() & F.col(end).isNotNull())
    # where a period ends before it starts, it is ahead of points before its end
    seen = seen.select(F.col(period_key).alias("_key"),
                       (F.least(start, end) if ahead else F.col(start)).alias("_ts"), F.lit(_PERIOD).alias("_kind"), at.alias("_at"),
                       F.struct(F.col(start).alias("start"), whole.alias("period")).alias("_next"))
    if not ahead:
        seen = seen.filter(F.col("_at").isNotNull())
    seen = seen.withColumn("_bucket", timeline_bucket(F.col("_ts"), bucket_hours))
    types = {f.name: f.dataType for f in seen.schema}
    point_type = points.select(_all(points).alias("_point")).schema["_point"].dataType
    nothing = {c: F.lit(None).cast(types[c]).alias(c) for c in ("_ts", "_at", "_next")}
    mine = points.select(F.col(key).alias("_key"), F.col(ts).alias("_ts"), F.lit(_POINT).alias("_kind"), nothing["_at"],
                         nothing["_next"], timeline_bucket(F.col(ts), bucket_hours).alias("_bucket"), _all(points).alias("_point"))

    # what the buckets of points get from other buckets
    ends = seen.groupBy("_key", "_bucket").agg(F.max_by("_at", F.when(F.col("_at").isNotNull(), F.col("_ts"))).alias("_at"),
                                               F.min("_next").alias("_next"))
    asked = mine.select("_key", "_bucket").distinct()
    both = ends.withColumn("_asked", F.lit(False)).unionByName(
        asked.select("_key", "_bucket", nothing["_at"], nothing["_next"], F.lit(True).alias("_asked")))
    across = Window.partitionBy("_key").orderBy("_bucket")
    carry = both.withColumn("_a", F.last("_at", ignorenulls=True).over(across.rangeBetween(*_BEFORE)))
    if ahead:
        carry = carry.withColumn("_n", F.min("_next").over(across.rangeBetween(1, Window.unboundedFollowing)))
    if not check:       # the check wants the period before each, in buckets without points too
        carry = carry.filter("_asked")
    carry = carry.select(
        "_key", nothing["_ts"], F.lit(_PERIOD).alias("_kind"), F.col("_a").alias("_at"),
        F.col("_n").alias("_next") if ahead else nothing["_next"], "_bucket")

    no_point = F.lit(None).cast(point_type).alias("_point")
    line = mine.unionByName(seen.select("*", no_point)).unionByName(carry.select("*", no_point))
    piece = Window.partitionBy("_key", "_bucket")
    # carried rows have no time and stand first, in both directions
    past = piece.orderBy(F.col("_ts").asc_nulls_first(), "_kind")
    if check:
        line = line.withColumn("_prior", F.last("_at", ignorenulls=True).over(past.rowsBetween(*_BEFORE)))
        clash = (F.col("_kind") == _PERIOD) & F.col("_ts").isNotNull() & F.col("_at").isNotNull() & _meets(
            F.col("_prior").getField(end), F.col("_at").getField(start), closed)
        keep = F.when(clash, F.raise_error(F.lit(f"periods of one {period_key} overlap"))).otherwise(F.col("_kind") == _POINT)
    else:
        keep = F.col("_kind") == _POINT
    line = line.withColumn("_now", F.last("_at", ignorenulls=True).over(past.rowsBetween(*_SO_FAR)))
    if ahead:
        future = piece.orderBy(F.col("_ts").desc_nulls_first(), F.col("_kind").desc())
        line = line.withColumn("_next", F.min("_next").over(future.rowsBetween(*_SO_FAR)))
    stop = F.col("_now").getField(end)
    inside = (F.col("_ts") <= stop) if closed else (F.col("_ts") < stop)
    return line.filter(keep).select("_point", "_ts", F.when(inside, F.col("_now")).alias("_at"), F.col("_next.period").alias("_next"))


def _matched(points: DataFrame, periods: DataFrame, key: str, ts: str, period_key: str, start: str, end: str,
             closed: bool, ahead: bool, overlapping: bool | None, bucket_hours: int) -> DataFrame:
    """``_carried`` for all points with key and time, overlapping periods included: such a point has a row for each."""
    if overlapping is None:
        overlapping = has_overlaps(periods, period_key, start, end, closed)
    if not overlapping:
        return _carried(points, periods, key, ts, period_key, start, end, closed, ahead, True, bucket_hours)
    marked = mark_overlaps(periods, period_key, start, end, closed, bucket_hours)
    several = marked.filter("_overlaps").drop("_overlaps")
    alone = marked.filter("not _overlaps").drop("_overlaps")
    found = _carried(points, alone, key, ts, period_key, start, end, closed, False, False, bucket_hours).drop("_next")
    left = found.filter(F.col("_at").isNull()).select("_point", F.col("_point").getField(key).alias("_of"), F.col("_ts").alias("_when"))
    met = point_in_interval_join(left, several, "_of", period_key, "_when", start, end, closed_end=closed)
    met = met.select("_point", F.col("_when").alias("_ts"), F.when(F.col(period_key).isNotNull(), F.struct(*[F.col(c) for c in periods.columns])).alias("_at"))
    found = found.filter(F.col("_at").isNotNull()).unionByName(met)
    none = F.lit(None).cast(found.schema["_at"].dataType).alias("_next")
    if not ahead:
        return found.select("*", none)
    # the starts ahead matter to points that lie in no period
    inside = found.filter(F.col("_at").isNotNull()).select("*", none)
    rest = found.filter(F.col("_at").isNull()).select(*_unpack("_point", points))
    return inside.unionByName(_carried(rest, periods, key, ts, period_key, start, end, closed, True, False, bucket_hours)
                              .withColumn("_at", F.lit(None).cast(found.schema["_at"].dataType)))


def as_of_join(points: DataFrame, periods: DataFrame, key: str, ts: str, period_key: str, start: str, end: str,
               closed: bool = False, how: str = "left", overlapping: bool | None = None, bucket_hours: int = 24) -> DataFrame:
    """``points`` with the columns of the period of the same key that holds their time:
    start <= ts < end, or with ``closed`` start <= ts <= end.  ``how``: 'left' or 'inner'.

    Where periods of a key overlap, a point gets a row for each that holds it."""
    has = F.col(key).isNotNull() & F.col(ts).isNotNull()
    found = _matched(points.filter(has), periods, key, ts, period_key, start, end, closed, False, overlapping, bucket_hours)
    if how == "inner":
        found = found.filter(F.col("_at").isNotNull())
    joined = found.select(*_unpack("_point", points), *_unpack("_at", periods))
    if how == "inner":
        return joined
    alone = points.filter(~has).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in periods.schema])
    return joined.unionByName(alone)


def prioritized_match(points: DataFrame, periods: DataFrame, key: str, ts: str, period_key: str, start: str, end: str,
                      ahead: dt.timedelta, how: str = "inner", overlapping: bool | None = None,
                      bucket_hours: int = 24, match: str = "match_type") -> DataFrame:
    """``points`` with the columns of their period and ``match``: 1 where the period holds the point's time
    (half-open), else 2 for the nearest start within ``ahead`` after it, of a period that ends after it.

    Equal starts ahead are decided by the period's other columns, in order.  There is one row per point,
    and no list of candidates; only where periods of a key overlap, a point has a row for each that holds it."""
    has = F.col(key).isNotNull() & F.col(ts).isNotNull()
    found = _matched(points.filter(has), periods, key, ts, period_key, start, end, False, True, overlapping, bucket_hours)
    horizon = F.col("_ts") + F.make_dt_interval(F.lit(ahead.days), F.lit(0), F.lit(0), F.lit(ahead.seconds))
    soon = F.col("_next").getField(start) <= horizon
    found = (found.withColumn(match, F.when(F.col("_at").isNotNull(), F.lit(1)).when(soon, F.lit(2)))
                  .withColumn("_at", F.when(F.col(match) == 1, F.col("_at")).when(F.col(match) == 2, F.col("_next"))))
    if how == "inner":
        found = found.filter(F.col(match).isNotNull())
    joined = found.select(*_unpack("_point", points), *_unpack("_at", periods), match)
    if how == "inner":
        return joined
    alone = points.filter(~has).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in periods.schema],
                                       F.lit(None).cast("int").alias(match))
    return joined.unionByName(alone)

"""Point-in-interval joins on a key, with cells of several widths so no key compares all pairs.

An equi-join on the key with a range residual compares every point of a key with
every interval of that key.  Here time is cut into cells of ``WIDTHS`` days, each width a
multiple of the one before.  An interval is covered by the fewest cells (wide ones in its middle,
narrow ones at its ends), fewer than 100 in all, however long or open it is.  A
point looks up the one cell of each width that it lies in, and meets exactly the intervals
that cover its day.  An exact residual on the time decides.  Any interval layout is
fine, overlapping ones included; nothing depends on the other side, so the plan is lazy.

Points are reduced to distinct (key, time) pairs before they are copied for each width, and points
without a key or time never enter the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: cell widths in days; the last spans more than the calendar's 4 million days in 14 cells
WIDTHS = (1, 8, 64, 512, 4096, 32768, 262144)
_DAY_ZERO = "0001-01-01"


def _day_number(ts: Column) -> Column:
    return F.datediff(F.to_date(ts), F.lit(_DAY_ZERO).cast("date"))


def _tagged(cells: Column, width: int) -> Column:
    return F.transform(cells, lambda c: F.struct(F.lit(width).alias("w"), c.alias("c")))


def explode_cells(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """One row per cell (``_width``, ``_cell``) that covers the interval's days; none if it ends before it starts."""
    lo, hi = _day_number(F.col(start)), _day_number(F.col(end)) + 1          # days [lo, hi)
    iv = intervals.withColumn("_lo", lo).withColumn("_hi", hi).filter(F.col(start) <= F.col(end))
    parts = []
    for i, w in enumerate(WIDTHS):
        # what wider cells cover: the multiples of their width inside [lo, hi)
        own_lo, own_hi = F.ceil(F.col("_lo") / w), F.floor(F.col("_hi") / w)
        if i + 1 == len(WIDTHS):
            spans = [(own_lo, own_hi)]
        else:
            up = WIDTHS[i + 1]
            wide_lo, wide_hi = F.ceil(F.col("_lo") / up) * (up // w), F.floor(F.col("_hi") / up) * (up // w)
            spans = [(own_lo, F.least(own_hi, F.greatest(wide_lo, own_lo))),
                     (F.greatest(own_lo, F.when(wide_lo <= wide_hi, wide_hi).otherwise(F.greatest(wide_lo, own_lo))), own_hi)]
        for a, z in spans:
            cells = F.when(a < z, F.sequence(a, z - 1)).otherwise(F.array().cast("array<bigint>"))
            parts.append(_tagged(cells, w))
    iv = iv.withColumn("_at", F.explode(F.array_distinct(F.flatten(F.array(*parts)))))
    return iv.withColumn("_width", F.col("_at.w")).withColumn("_cell", F.col("_at.c")).drop("_at", "_lo", "_hi")


def point_in_interval_join(points: DataFrame, intervals: DataFrame, point_key: str, interval_key: str,
                           ts: str, start: str, end: str, closed_end: bool, how: str = "left") -> DataFrame:
    """``points`` joined to ``intervals`` where keys match and start <= ts < end
    (``closed_end``: start <= ts <= end).  ``how`` is 'left' or 'inner'."""
    looked_up = F.array(*[F.struct(F.lit(w).alias("w"), F.floor(_day_number(F.col("_ts")) / w).alias("c")) for w in WIDTHS])
    has = F.col(point_key).isNotNull() & F.col(ts).isNotNull()
    pairs = points.filter(has).select(F.col(point_key).alias("_pk"), F.col(ts).alias("_ts")).distinct()
    pairs = pairs.withColumn("_at", F.explode(looked_up)).select(
        "_pk", "_ts", F.col("_at.w").alias("_pw"), F.col("_at.c").alias("_pc"))
    iv = explode_cells(intervals, start, end)
    t = F.col("_ts")
    inside = (t >= F.col(start)) & ((t <= F.col(end)) if closed_end else (t < F.col(end)))
    met = (pairs.join(iv, (F.col("_pk") == F.col(interval_key)) & (F.col("_pw") == F.col("_width"))
                      & (F.col("_pc") == F.col("_cell")) & inside)
           .drop("_width", "_cell", "_pw", "_pc"))
    joined = points.filter(has).join(met, (F.col(point_key) == F.col("_pk")) & (F.col(ts) == t), how).drop("_pk", "_ts")
    if how == "inner":
        return joined
    alone = points.filter(~has).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in intervals.schema])
    return joined.unionByName(alone.select(*joined.columns))

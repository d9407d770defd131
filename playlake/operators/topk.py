"""Top-1 row per key (the QUALIFY row_number() = 1 pattern) as an aggregation.

A window ``row_number() over (partition by key order by ...)`` sends every row of
a key to one task.  ``min_by(struct(row), struct(order))`` is a partial
aggregate instead: each map task keeps one candidate per key before the shuffle,
so a key holding a third of all rows (e.g. re-delivered copies) costs one row
per map task in the exchange, and never one giant sorted window partition.

Struct comparison puts NULL fields first, so ascending order is NULLS FIRST and
descending order NULLS LAST -- the SQL defaults of both the reference dialect
and Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top1_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                 descending: bool = False) -> DataFrame:
    """Keep, for each ``keys`` group, the first row under ``order``.

    All ``order`` terms share one direction.  Add trailing order columns until
    the winner is unique: the result is then deterministic.
    """
    cols = [c for c in df.columns if c not in keys]
    terms = [F.col(t) if isinstance(t, str) else t for t in order]
    ordering = F.struct(*[t.alias(f"o{i}") for i, t in enumerate(terms)])
    row = F.struct(*[F.col(c) for c in cols])
    pick = F.max_by(row, ordering) if descending else F.min_by(row, ordering)
    out = df.groupBy(*keys).agg(pick.alias("_top"))
    return out.select(*[F.col(k) for k in keys], *[F.col(f"_top.{c}").alias(c) for c in cols]).select(*df.columns)

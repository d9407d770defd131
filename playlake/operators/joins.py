"""Left joins that keep rows without a key out of the exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join_known(left: DataFrame, right: DataFrame, key: str, right_key: str, when: Column | None = None) -> DataFrame:
    """``left`` left-joined to ``right`` on ``key`` = ``right_key``.

    A NULL key (or a row for which ``when`` is not true) matches nothing, but a join would
    hash all such rows to one partition; here they bypass it with NULLs for ``right``."""
    able = F.col(key).isNotNull() if when is None else F.coalesce(F.col(key).isNotNull() & when, F.lit(False))
    joined = left.filter(able).join(right, F.col(key) == F.col(right_key), "left")
    alone = left.filter(~able).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema])
    return joined.unionByName(alone)

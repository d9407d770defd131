"""Keyed upsert (the incremental MERGE) and schema-evolution policies.

``upsert`` is a pure DataFrame function: target rows whose key appears in the
source are replaced, the rest are kept, source rows are inserted.  It is a
``left_anti`` join plus a union, so it shuffles target and source once on the
key; no row is deleted.  NULL keys never match (equi-join semantics), so such
source rows always accumulate -- as with MERGE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POLICIES = ("ignore", "append_new_columns", "sync_all_columns", "fail")


class DuplicateMatchError(ValueError):
    """A target row would be matched by more than one source row."""


def evolve_schema(target: DataFrame, source: DataFrame, policy: str = "ignore") -> tuple[DataFrame, DataFrame]:
    """Align target and source columns by ``policy`` (returns both, same columns).

    ignore: keep the target's columns (new source columns dropped);
    append_new_columns: add new source columns to the target (NULL in old rows);
    sync_all_columns: take exactly the source's columns (dropped ones vanish);
    fail: raise when the column sets differ.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}")
    t_cols, s_cols = target.columns, source.columns
    if policy == "fail" and set(t_cols) != set(s_cols):
        raise ValueError(f"schema changed: {sorted(set(t_cols) ^ set(s_cols))}")
    if policy in ("ignore", "fail"):
        cols = t_cols
    elif policy == "append_new_columns":
        cols = t_cols + [c for c in s_cols if c not in t_cols]
    else:
        cols = s_cols
    types = {**{f.name: f.dataType for f in source.schema}, **{f.name: f.dataType for f in target.schema}}

    def fit(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in cols])

    return fit(target), fit(source)


def upsert(target: DataFrame | None, source: DataFrame, keys: Sequence[str], policy: str = "ignore",
           check_duplicates: bool = False, replace_on: Sequence[str] | None = None) -> DataFrame:
    """MERGE ``source`` into ``target`` on ``keys`` (update matched, insert new).

    With ``replace_on`` every target row goes that agrees with a source row on those columns,
    so a source that holds all rows of an entity leaves no stale ones.

    With ``check_duplicates`` a (distributed) pre-check raises
    ``DuplicateMatchError`` when a target row is matched by two source rows.
    """
    if target is None:
        return source
    target, source = evolve_schema(target, source, policy)
    keys = list(keys)
    if check_duplicates:
        dup = (source.groupBy(*keys).count().filter(F.col("count") > 1)
                     .join(target.select(*keys), on=keys, how="left_semi"))
        if dup.limit(1).count():
            raise DuplicateMatchError(f"source has several rows for one target key {keys}")
    gone = list(replace_on or keys)
    kept = target.join(source.select(*gone).dropna().distinct(), on=gone, how="left_anti")
    kept = kept.select(*target.columns)
    return kept.unionByName(source)

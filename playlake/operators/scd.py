"""SCD2 by version hash: new and closed versions from one pass over target and source by business key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scd2_by_version_hash(target: DataFrame | None, source: DataFrame, business_key: str, version_hash: str,
                         run_ts: Column, infinity: Column, surrogate: str, surrogate_of: Column,
                         valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """The rows that a run adds to or changes in ``target`` (the source of its MERGE on ``surrogate``).

    A source row opens a version (``valid_from`` = ``run_ts``, ``valid_to`` = ``infinity``, id ``surrogate_of``) if its business
    key has no active version, or one with another hash; active versions of a key with a new one are closed at
    ``run_ts``.  ``target`` None: a first run, every row opens.

    Active versions and source rows meet by business key in one exchange, and are counted there by key and by
    (key, hash): there is no join, and nothing of a key is collected.  Rows without a business key match
    nothing: such source rows open, such versions stay, neither enters the exchange."""
    columns = [surrogate, *source.columns, valid_from, valid_to]

    def opened(rows: DataFrame) -> DataFrame:
        return rows.select(surrogate_of.alias(surrogate), *source.columns, run_ts.alias(valid_from), infinity.alias(valid_to))

    if target is None:
        return opened(source)
    known = F.col(business_key).isNotNull()
    active = (target.filter(known & (F.col(valid_to) == infinity)).select(surrogate, *source.columns, valid_from)
              .withColumn("_active", F.lit(1)))
    fresh = source.filter(known).select(
        F.lit(None).cast(active.schema[surrogate].dataType).alias(surrogate), *source.columns,
        F.lit(None).cast(active.schema[valid_from].dataType).alias(valid_from), F.lit(0).alias("_active"))
    same_key, same_version = Window.partitionBy(business_key), Window.partitionBy(business_key, version_hash)
    met = (active.unionByName(fresh).withColumn("_same", F.sum("_active").over(same_version))
           .withColumn("_had", F.sum("_active").over(same_key)))
    opens = (F.col("_active") == 0) & ((F.col("_had") == 0) | (F.col("_had") > F.col("_same")))
    met = met.withColumn("_opens", opens).withColumn("_renewed", F.max("_opens").over(same_key))
    rows = met.filter(F.col("_opens") | (F.col("_active") == 1) & F.col("_renewed"))
    rows = rows.select(F.when(F.col("_opens"), surrogate_of).otherwise(F.col(surrogate)).alias(surrogate), *source.columns,
                       F.when(F.col("_opens"), run_ts).otherwise(F.col(valid_from)).alias(valid_from),
                       F.when(F.col("_opens"), infinity).otherwise(run_ts).alias(valid_to))
    return rows.unionByName(opened(source.filter(~known))).select(*columns)

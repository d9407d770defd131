"""Sinks: views, full-refresh tables, day-partitioned / clustered layouts.

Tables are Parquet directories.  ``materialize`` writes a job's output once
into the shared checkpoint folder (``spark.checkpoint.dir``) and reads it back:
downstream jobs then start from a short plan over files, exactly like the
reference's staging *tables*, and a lost executor only recomputes from there.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from playlake.session import checkpoint_dir


def as_view(df: DataFrame, name: str) -> DataFrame:
    """A view: the lazy plan, registered under ``name`` for SQL users."""
    df.createOrReplaceTempView(name)
    return df


def write_table(df: DataFrame, path: str, partition_day_of: str | None = None,
                cluster_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Full-refresh table.  ``partition_day_of`` adds a derived ``<col>_day``
    partition column; ``cluster_by`` range-partitions and sorts the rows so
    files hold narrow key ranges (min/max statistics then prune reads)."""
    out = df
    parts: list[str] = []
    if partition_day_of:
        day = f"{partition_day_of}_day"
        out = out.withColumn(day, F.to_date(partition_day_of))
        parts.append(day)
    if cluster_by:
        out = out.repartitionByRange(*[F.col(c) for c in (*parts, *cluster_by)]).sortWithinPartitions(
            *parts, *cluster_by)
    w = out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)


#: the paths made in the innermost scope of this thread (or task); None outside of any
_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Temporary tables made inside (``materialize``, merge staging) are removed at the end.

    Results that are still lazy must be written before the scope ends.  A scope is its thread's own:
    what a stream or another thread makes meanwhile isn't in it."""
    token = _scope.set([])
    try:
        yield
    finally:
        paths = _scope.get() or []
        _scope.reset(token)
        for path in paths:
            _delete(spark, path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint folder, removed with the scope it is made in."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    made = _scope.get()
    if made is not None:
        made.append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table under the checkpoint folder; return a reader."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _fs_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def read_table(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """The table at ``path`` with one schema for all its files: columns that older files
    lack are NULL, and the day partition column is a DATE even if every day is NULL."""
    found = spark.read.option("mergeSchema", "true").parquet(path)
    if day is None:
        return found
    schema = StructType([StructField(f.name, DateType() if f.name == day else f.dataType) for f in found.schema])
    return spark.read.schema(schema).parquet(path)


def _on_days(df: DataFrame, day: str, days: Sequence[dt.date | None]) -> DataFrame:
    """Rows of ``df`` on one of ``days``, the NULL day included; prunes partitions."""
    cond = F.col(day).isin([d for d in days if d is not None])
    return df.filter(cond | F.col(day).isNull() if None in days else cond)


def touched_days(target: DataFrame, source: DataFrame, keys: Sequence[str], day: str, source_day: Column) -> list:
    """Days that hold a source row or a target row with the key of one (at most one a calendar day)."""
    src_keys = source.select(*keys).dropna().distinct()
    return [r[0] for r in source.select(source_day.alias(day))
            .unionByName(target.join(src_keys, on=list(keys), how="left_semi").select(day)).distinct().collect()]


def replace_days(rows: DataFrame, path: str, day: str, days: Sequence[dt.date | None],
                 cluster_by: Sequence[str] = ()) -> None:
    """Make ``rows`` (a stored table with the column ``day``) the contents of ``days`` at ``path``.

    Days with rows are overwritten in one job, then days left without any are removed.  A run
    that breaks in between is mended by merging the same source again."""
    spark = rows.sparkSession
    out = rows.repartitionByRange(day, *cluster_by).sortWithinPartitions(day, *cluster_by) if cluster_by else rows
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    filled = {r[0] for r in rows.select(day).distinct().collect()}
    for d in set(days) - filled:
        value = "__HIVE_DEFAULT_PARTITION__" if d is None else d.isoformat()
        _delete(spark, f"{path.rstrip('/')}/{day}={value}")


def merge_into_table(source: DataFrame, path: str, keys: Sequence[str], partition_day_of: str | None = None,
                     cluster_by: Sequence[str] = (), policy: str = "ignore",
                     replace_on: Sequence[str] | None = None) -> None:
    """Incremental MERGE into a Parquet table, rewriting only what changes.

    A day-partitioned table (rows without a day form the NULL partition) has only those
    days read, merged with ``upsert`` and rewritten that hold a source row or a target row
    being replaced, unless the columns change: then every day gets the new columns.  Two source
    rows for one target row raise ``DuplicateMatchError``.  Merged rows go through a staging
    table, as a path is never overwritten while it is being read.  Where tables live in a
    catalog that supports it, use ``DataFrame.mergeInto`` instead.
    """
    from playlake.operators.upsert import evolve_schema, upsert

    spark = source.sparkSession
    if not _exists(spark, path):
        write_table(source, path, partition_day_of, cluster_by)
        return
    staging = scratch_path(spark, "merge")
    if not partition_day_of:
        merged = upsert(read_table(spark, path), source, keys, policy=policy, check_duplicates=True, replace_on=replace_on)
        merged.write.mode("overwrite").parquet(staging)
        write_table(spark.read.parquet(staging), path, None, cluster_by)
        return
    day = f"{partition_day_of}_day"
    target = read_table(spark, path, day)
    source_day = F.to_date(partition_day_of)
    old, columns = target, target.drop(day).columns
    if evolve_schema(target.drop(day), source, policy)[0].columns == columns:
        days = touched_days(target, source, replace_on or keys, day, source_day)
        old = _on_days(target, day, days)
    else:
        days = [r[0] for r in target.select(day).distinct().collect()]
    merged = upsert(old.drop(day), source, keys, policy=policy, check_duplicates=True, replace_on=replace_on)
    merged.withColumn(day, source_day).write.mode("overwrite").parquet(staging)
    replace_days(spark.read.parquet(staging), path, day, days, cluster_by)

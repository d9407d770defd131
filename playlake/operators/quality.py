"""Declarative data-quality checks (not_null / unique) as one Spark pass per model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_SCHEMA = "model string, column_name string, test string, failures bigint"


@dataclass(frozen=True)
class Expectation:
    model: str
    column: str
    test: str  # "not_null" | "unique"


def _not_null(df: DataFrame, model: str, cols: Sequence[str]) -> DataFrame:
    # one aggregation over the model for all its not_null columns, then unpivot
    counts = df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in cols])
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c), F.lit(0)).alias("failures")) for c in cols
    ])).alias("r"))
    return stacked.select(F.lit(model).alias("model"), "r.column_name", F.lit("not_null").alias("test"),
                          F.col("r.failures").cast("bigint").alias("failures"))


def _unique(df: DataFrame, model: str, col: str) -> DataFrame:
    # failures = number of non-NULL values that occur more than once
    dups = df.filter(F.col(col).isNotNull()).groupBy(col).count().filter(F.col("count") > 1)
    return dups.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(col).alias("column_name"), F.lit("unique").alias("test"),
        F.col("failures").cast("bigint"))


def _cannot_run(spark: SparkSession, e: Expectation) -> DataFrame:
    # the model does not output the column: reported with NULL failures
    return spark.createDataFrame([(e.model, e.column, e.test, None)], REPORT_SCHEMA)


def quality_report(spark: SparkSession, models: Mapping[str, DataFrame],
                   expectations: Sequence[Expectation]) -> DataFrame:
    """One row per expectation: (model, column_name, test, failures).  A column the
    model does not have is reported with NULL failures (the test cannot run)."""
    parts = []
    for model, df in models.items():
        mine = [e for e in expectations if e.model == model]
        parts += [_cannot_run(spark, e) for e in mine if e.column not in df.columns]
        mine = [e for e in mine if e.column in df.columns]
        nn = [e.column for e in mine if e.test == "not_null"]
        if nn:
            parts.append(_not_null(df, model, nn))
        parts += [_unique(df, model, e.column) for e in mine if e.test == "unique"]
    if not parts:
        return spark.createDataFrame([], REPORT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)

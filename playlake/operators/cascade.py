"""Cascading lookups: the first rule that finds a row wins, in one join.

A rule names a column of the left side, a column of the right side and, perhaps, a condition on
the left row.  A chain of left joins shuffles the left side once a rule.  Here the right side becomes one
stacked lookup, a row per (rule, value), the best of its rows chosen by partial aggregation, and each left row
becomes (rule, value) rows.  One join finds all matches and one aggregation keeps the lowest rule of
each left row, which also brings back the rows that no rule matches: they never enter the join.

Values held by very many left rows (a blank or all-zero id) are found by a sketch over the (rule, value)
pairs, at most ``HEAVY`` of them, and salted on both sides, so none of them meets in one task.  The sketch
steers only where rows go, never which of them match.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: heavy values that are salted, at most; a value is heavy that holds at least this share of all pairs
HEAVY, HEAVY_SHARE = 64, 1 / 500
#: values that the sketch keeps track of
TRACKED = 8192


class Rule(NamedTuple):
    name: str
    left: str
    right: str
    when: Column | None = None


def _pairs(df: DataFrame, columns: Sequence[str], conditions: Sequence[Column | None], keep: Sequence[Column | str]) -> DataFrame:
    """(_rule, _value) rows of ``df``: one for each rule whose column has a value and whose condition holds."""
    pairs = []
    for k, (column, when) in enumerate(zip(columns, conditions)):
        able = F.col(column).isNotNull() if when is None else F.col(column).isNotNull() & when
        pairs.append(F.when(able, F.struct(F.lit(k).alias("rule"), F.col(column).cast("string").alias("value"))))
    rows = df.select(*keep, F.explode(F.array_compact(F.array(*pairs))).alias("_p"))
    return rows.select(*[c for c in rows.columns if c != "_p"], F.col("_p.rule").alias("_rule"), F.col("_p.value").alias("_value"))


def heavy_pairs(pairs: DataFrame) -> DataFrame:
    """(_rule, _value) of at most ``HEAVY`` pairs that hold a share of all rows; from one sketch."""
    tagged = pairs.select(F.concat(F.col("_rule").cast("string"), F.lit("|"), "_value").alias("_tag"))
    top = tagged.agg(F.expr(f"approx_top_k(_tag, {HEAVY}, {TRACKED})").alias("_top"), F.count("*").alias("_all"))
    each = top.select("_all", F.explode("_top").alias("_t")).filter(F.col("_t.count") >= F.col("_all") * HEAVY_SHARE)
    tag = F.col("_t.item")
    return each.select(F.substring_index(tag, "|", 1).cast("int").alias("_rule"),
                       F.substr(tag, F.instr(tag, "|") + 1).alias("_value"))


def cascade_join(left: DataFrame, right: DataFrame, rules: Sequence[Rule], take: Sequence[str], prefer: Sequence[str],
                 row_key: Sequence[str] | None = None, deal_by: Sequence[str] | None = None, method: str = "join_method",
                 no_match: str = "no_match", salts: int = 32) -> DataFrame:
    """``left`` with the columns ``take`` of the ``right`` row found by the first rule that finds any, and its name in ``method``.

    Of several rows with one value the least by ``prefer`` (ascending, NULLs first) is taken.  ``row_key`` names columns that
    tell left rows apart (default: all); rows that agree on it count as one, whose least other columns are kept.  ``deal_by``: columns of ``row_key`` that
    rows are dealt by at the end, so that a later grouping by them needs no exchange.  Values match as text.  A NULL value, or a row whose condition is false or NULL, is not looked up by that rule."""
    row_key = list(row_key or left.columns)
    rest = [c for c in left.columns if c not in row_key]
    lookup = _pairs(right, [r.right for r in rules], [None] * len(rules),
                    [F.struct(*take).alias("_take"), F.struct(*prefer).alias("_prefer")])
    lookup = lookup.groupBy("_rule", "_value").agg(F.min_by("_take", F.struct("_prefer", "_take")).alias("_take"))
    asked = _pairs(left, [r.left for r in rules], [r.when for r in rules], left.columns)
    # at most HEAVY rows, whatever the input
    heavy = F.broadcast(heavy_pairs(asked.select("_rule", "_value")).withColumn("_heavy", F.lit(True)))
    salt = F.when(F.col("_heavy"), F.pmod(F.xxhash64(*left.columns), F.lit(salts))).otherwise(F.lit(0)).cast("int")
    asked = asked.join(heavy, ["_rule", "_value"], "left").withColumn("_salt", salt).drop("_heavy")
    copies = F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    lookup = lookup.join(heavy, ["_rule", "_value"], "left").withColumn("_salt", F.explode(copies)).drop("_heavy")
    met = asked.join(lookup, ["_rule", "_value", "_salt"]).select(*left.columns, "_rule", "_take")
    none = left.select("*", F.lit(len(rules)).alias("_rule"), F.lit(None).cast(met.schema["_take"].dataType).alias("_take"))
    others = F.struct(*rest) if rest else F.lit(0)
    every = met.unionByName(none)
    if deal_by:
        every = every.repartition(*deal_by)
    best = (every.withColumn("_row", F.struct(F.col("_rule"), others.alias("_rest"), F.col("_take")))
            .groupBy(*row_key).agg(F.min("_row").alias("_row")))
    name = F.array(*[F.lit(r.name) for r in rules], F.lit(no_match))[F.col("_row._rule")]
    return best.select(*[F.col(f"_row._rest.{c}").alias(c) if c in rest else F.col(c) for c in left.columns],
                       *[F.col(f"_row._take.{c}").alias(c) for c in take], name.alias(method))

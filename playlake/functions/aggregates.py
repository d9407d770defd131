"""Aggregate helpers (all partial-aggregatable, so hot groups combine map-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_value_by(value: Column | str, *order: Column | str, descending: bool = False) -> Column:
    """First non-NULL ``value`` in ``order`` (ASC by default); NULL if all are NULL.

    ``order`` may hold several columns; later ones break ties deterministically.
    Implemented as ``min_by``/``max_by`` over an ordering that is NULL wherever the
    value is NULL, so NULL values never win.
    """
    v = F.col(value) if isinstance(value, str) else value
    o = [F.col(c) if isinstance(c, str) else c for c in order]
    key = o[0] if len(o) == 1 else F.struct(*o)
    guarded = F.when(v.isNotNull(), key)
    return F.max_by(v, guarded) if descending else F.min_by(v, guarded)


def ordered_ids(value: Column | str, *order: Column | str) -> Column:
    """Array of non-NULL ``value`` sorted by ``order`` (then by the value)."""
    v = F.col(value) if isinstance(value, str) else value
    o = [F.col(c) if isinstance(c, str) else c for c in order]
    fields = [c.alias(f"o{i}") for i, c in enumerate(o)] + [v.alias("v")]
    pairs = F.array_sort(F.collect_list(F.when(v.isNotNull(), F.struct(*fields))))
    return F.transform(pairs, lambda x: x["v"])

"""Reusable DataFrame operators (compositions of built-in Spark operators)."""

from playlake.operators.topk import top1_per_key
from playlake.operators.upsert import upsert, evolve_schema
from playlake.operators.quality import Expectation, quality_report

__all__ = ["top1_per_key", "upsert", "evolve_schema", "Expectation", "quality_report"]

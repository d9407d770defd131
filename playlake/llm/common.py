"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.session import checkpoint_dir
from playlake.sources.sinks import materialize

__all__ = ["materialize", "shared_path", "table", "text_or_empty", "unpacked", "whole_row", "without_breaks", "WORD_BREAKS", "DOCUMENT_COLUMNS"]

#: the white space of the word rule ``[^\x20\x09-\x0D]+``: a fixed value
WORD_BREAKS = " \t\n\x0b\x0c\r"
#: columns of ``documents``, in order
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def whole_row(docs: DataFrame, columns: list[str] | None = None):
    """All (or the named) columns of ``docs`` as one struct, whatever their names: nothing can clash with it."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in columns or docs.columns])


def unpacked(df: DataFrame, struct: str, columns: list[str]) -> DataFrame:
    """The columns packed by ``whole_row``."""
    return df.select(*[F.col(struct).getField(c).alias(c) for c in columns])


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def without_breaks(col):
    """``col`` without any character of ``WORD_BREAKS``."""
    return F.translate(col, WORD_BREAKS, "")

"""Bounded samples of labelled rows for fitting models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPAN = 1 << 30


def ticket(*cols) -> "F.Column":
    """A stable draw in [0, SPAN) from a row's values."""
    return F.pmod(F.xxhash64(F.lit(17), *cols), F.lit(SPAN))


def thinned(df: DataFrame, rows: int, most: int, *cols) -> DataFrame:
    """All of df's `rows` rows, or a stable sample that is expected to have `most` of them."""
    return df if rows <= most else df.where(ticket(*cols) < int(SPAN * most / rows))


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """ids (doc_id and labels; bounded by the caller) joined to their texts without a shuffle of texts."""
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")

"""Orderings of finished reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def report_order(df: DataFrame, *keys: str) -> DataFrame:
    """Total order for display; a leading minus sorts a key downwards."""
    return df.orderBy(*[F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in keys])

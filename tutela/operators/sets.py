"""Stacking."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def label_rows(df: DataFrame, labels: dict[str, Column], name: str) -> DataFrame:
    """One copy of a row per label whose test holds: overlapping groups stacked
    in a single pass over the data."""
    tags = F.array_compact(F.array(*[F.when(test, F.lit(label)) for label, test in labels.items()]))
    return df.withColumn(name, F.explode(tags))


def emit_rows(df: DataFrame, rows: list[tuple[Column, Column]]) -> DataFrame:
    """One output struct per test that holds, several rules in a single pass."""
    hits = F.array_compact(F.array(*[F.when(test, struct) for test, struct in rows]))
    return df.select(F.inline(hits))

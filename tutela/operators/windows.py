"""Windows. Partitions are a student's weeks in one term, never a term alone,
so their size is the length of a term."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tutela.operators.joins import apart


def sequence_terms(terms: DataFrame, start: str = "term_start") -> DataFrame:
    """Number the terms by start date. Terms are a calendar of a few rows."""
    return terms.withColumn("term_seq", F.row_number().over(Window.orderBy(start)))


def rolling_sum(df: DataFrame, part: Sequence[str], order: str, col: str, name: str,
                back: int = 1) -> DataFrame:
    """This week and the ``back`` weeks before it, by week number."""
    w = Window.partitionBy(*part).orderBy(order).rangeBetween(-back, 0)
    return df.withColumn(name, F.sum(col).over(w))


def running_sums(df: DataFrame, part: Sequence[str], order: str, cols: dict[str, str]) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(order).rangeBetween(Window.unboundedPreceding, 0)
    return df.withColumns({name: F.sum(c).over(w) for name, c in cols.items()})


def first_where(df: DataFrame, by: Sequence[str], order: str, test, name: str) -> DataFrame:
    """First week in which the test holds, per group; groups without one are left out."""
    return df.filter(test).groupBy(*by).agg(F.min(order).alias(name))


def with_group_min(df: DataFrame, by: Sequence[str], col: str, name: str) -> DataFrame:
    """The group's smallest value next to each row.

    Reduced by an aggregate and joined back: unlike a window, a join can split a
    group with a large share of the rows over several tasks.
    """
    least = df.groupBy(*by).agg(F.min(col).alias(name))
    return df.join(apart(least), list(by), "inner")


def last_weeks(df: DataFrame, week: str, n: int) -> DataFrame:
    """Rows of the last ``n`` weeks, counted from the largest week present."""
    newest = df.agg(F.max(week).alias("m"))
    return df.filter(F.col(week) >= newest.scalar() - (n - 1))

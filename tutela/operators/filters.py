"""Row filters. All of them drop rows whose test is unknown, as SQL does."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outside_range(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    """Known values below ``low`` or above ``high`` (NaN sorts above and is kept)."""
    return df.filter((F.col(col) < low) | (F.col(col) > high))


def not_in(df: DataFrame, col: str, ref: DataFrame, ref_col: str) -> DataFrame:
    """``col NOT IN (SELECT ref_col FROM ref)`` with its three-valued logic.

    An equi anti join scales but keeps NULL keys and ignores NULLs in the list,
    so both cases are settled by one aggregate over the list.
    """
    keys = ref.select(F.col(ref_col).alias("__ref"))
    size = keys.agg(F.count(F.lit(1)).alias("n"))
    blanks = keys.agg(F.count_if(F.col("__ref").isNull()).alias("n"))
    kept = df.join(keys, F.col(col) == F.col("__ref"), "left_anti")
    return kept.filter((size.scalar() == 0) | (F.col(col).isNotNull() & (blanks.scalar() == 0)))


def in_set(df: DataFrame, col: str, ref: DataFrame, ref_col: str) -> DataFrame:
    """``col IN (SELECT ref_col FROM ref)``."""
    keys = ref.select(F.col(ref_col).alias("__ref"))
    return df.join(keys, F.col(col) == F.col("__ref"), "left_semi")


def date_outside(df: DataFrame, col: str, first: date, last: date) -> DataFrame:
    """Rows whose date is missing, before ``first`` or after ``last``."""
    c = F.col(col)
    return df.filter(c.isNull() | (c < F.lit(first)) | (c > F.lit(last)))


def differs(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) != F.lit(value))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row count. NULL is a value."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def page_filter(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """A report page's list filter."""
    return df.filter(F.col(col).isin(*values))

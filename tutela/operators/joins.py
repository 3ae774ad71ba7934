"""Joins.

No side is broadcast by hint unless it consists of constants in the code; for
all others the planner compares the estimated or measured size with its
threshold and falls back to a shuffled join, whose hot partitions are split at
run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def on_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]],
            null_safe: bool = False) -> Column:
    tests = [left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b] for a, b in pairs]
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def apart(df: DataFrame) -> DataFrame:
    """Detach an aggregated side from the partitioning of its keys.

    A side that is already partitioned by the join keys gets no exchange of its
    own, and the runtime can only split the hot partitions of a join whose sides
    are both fresh exchanges. Costs one more exchange of the reduced side.
    """
    return df.hint("rebalance")


def left_lookup(df: DataFrame, key: Column, table: DataFrame, table_key: str) -> DataFrame:
    """Left join on an expression of ``df``; ``table_key`` must be unique in ``table``."""
    return df.join(table, key == table[table_key], "left").drop(table[table_key])


def star(fact: DataFrame, *dims: tuple[DataFrame, str]) -> DataFrame:
    """Inner join of a fact with dimensions that share the named key column."""
    for dim, key in dims:
        fact = fact.join(dim, key, "inner")
    return fact


def orphans(df: DataFrame, ref: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a partner; a NULL key has none."""
    return df.join(ref.select(*keys), list(keys), "left_anti")


def with_flag(df: DataFrame, ref: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """EXISTS as a column: is there a row in ``ref`` with the same keys?"""
    found = ref.select(*keys).distinct().withColumn(flag, F.lit(True))
    return (df.join(found, list(keys), "left")
            .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


def latest_value(df: DataFrame, key: str, value: str, order: Sequence[str], name: str) -> DataFrame:
    """Per key the value of the row last in ``order``.

    An aggregate, so every task reduces its rows to one per key before the
    exchange. The last order column must break ties.
    """
    return df.groupBy(key).agg(F.max_by(F.col(value), F.struct(*order)).alias(name))


def first_per_item(df: DataFrame, joined: str, item: str, value: str, name: str,
                   sep: str = "|") -> DataFrame:
    """Membership join made equi: one row per part of a ``sep``-joined list with
    the smallest value listing it."""
    parts = df.select(F.col(value), F.explode(F.split(joined, f"[{sep}]")).alias(item))
    return parts.groupBy(item).agg(F.min(value).alias(name))


def equi_range(left: DataFrame, right: DataFrame, keys: Sequence[str], low: str, high: str) -> DataFrame:
    """Equal keys and ``right.low <= left.high`` as a residual test of the hash or merge join."""
    tests = on_keys(left, right, [(k, k) for k in keys]) & (right[low] <= left[high])
    out = left.join(right, tests, "inner")
    for k in keys:
        out = out.drop(right[k])
    return out


def with_next(df: DataFrame, seen: DataFrame, key: str, seq: str, flag: str) -> DataFrame:
    """Is there a row of ``seen`` for the same key one step later in the sequence?"""
    following = (seen.select(key, (F.col(seq) - 1).alias(seq)).distinct()
                 .withColumn(flag, F.lit(True)))
    return (df.join(following, [key, seq], "left")
            .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


def with_group_size(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """How many rows share a row's keys; a missing key part equals a missing one.

    Counted before it moves and joined back from a fresh exchange, so the runtime
    can split a group that holds much of the table.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).select(
        *[F.col(k).alias(f"__{k}") for k in keys], name)
    sizes = apart(sizes)
    tests = on_keys(df, sizes, [(k, f"__{k}") for k in keys], null_safe=True)
    return df.join(sizes, tests).select(*df.columns, name)


def merge_suffixed(left: DataFrame, right: DataFrame, on: Sequence[str], how: str,
                   suffix: str) -> DataFrame:
    """Join on shared names; other shared names of the right side get a suffix."""
    clash = (set(left.columns) & set(right.columns)) - set(on)
    renamed = right.select([F.col(c).alias(c + suffix if c in clash else c) for c in right.columns])
    return left.join(renamed, list(on), how)

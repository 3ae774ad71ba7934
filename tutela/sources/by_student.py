"""Tables kept by student: joins and windows on the student id need no exchange.

Rows are stored in buckets of the hash of the id, sorted within. A bucket is read by one task, so keys
that hold more than ``HOT`` even shares of a bucket are kept apart, as plain files that any number of
tasks can split. There are fewer such keys than buckets, whatever the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_A_BUCKET = 1_000_000
HOT = 2.0  # of an even share of the rows; at most buckets / HOT keys have that


@dataclass(frozen=True)
class ByStudent:
    """``even`` in buckets, ``hot`` in plain files: together the table. ``keys`` lists the hot ids."""

    even: DataFrame
    hot: DataFrame
    keys: tuple
    key: str
    buckets: int

    def rows(self) -> DataFrame:
        return self.even.unionByName(self.hot)

    def per_student(self, plan: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """A plan whose groups and windows are within students, over both parts."""
        done = plan(self.even)
        return done.unionByName(plan(self.hot)) if self.keys else done

    def join(self, other: ByStudent, how: str = "inner") -> DataFrame:
        """Rows of this table with those of another one by student (inner, left, left_semi or
        left_anti). Bucket meets bucket; what is hot on either side meets the rows of those few
        students on the other, by the way the planner's size check or, both sides being fresh
        exchanges, the run-time split of hot partitions gives them."""
        if (self.key, self.buckets) != (other.key, other.buckets):
            raise ValueError("both tables must have the same key and number of buckets")
        hot = sorted({*self.keys, *other.keys})
        if not hot:
            return self.even.join(other.even, self.key, how)
        named = F.coalesce(F.col(self.key).isin(*hot), F.lit(False))
        even = self.even.filter(~named).join(other.even.filter(~named), self.key, how)
        few = other.rows().filter(named)
        return even.unionByName(self.rows().filter(named).join(few, self.key, how))


def buckets_for(rows: int, least: int) -> int:
    """Buckets of a table: one task sorts and reads each, so their rows are bounded, not their number."""
    return max(least, -(-rows // ROWS_A_BUCKET))


def _table(spark: SparkSession, path: str, schema: T.StructType, key: str, order: Sequence[str],
           buckets: int) -> str:
    """The name of an external table over bucketed files, declared in this session."""
    name = f"by_student_{hashlib.md5(path.encode()).hexdigest()}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) "
              f"SORTED BY ({', '.join(f'`{c}`' for c in order)}) INTO {buckets} BUCKETS "
              f"LOCATION '{path}'")
    return name


def hot_keys(df: DataFrame, key: str, buckets: int, hot: float = HOT) -> tuple:
    """Ids with more than ``hot`` even shares of a bucket. Counted before they move."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    share = df.agg((F.count(F.lit(1)) * hot / buckets).alias("share"))
    # fewer than buckets / hot rows
    found = counts.filter(F.col("n") > F.greatest(share.scalar(), F.lit(1.0))).select(key)
    return tuple(sorted(r[0] for r in found.collect()))


def write_by_student(df: DataFrame, path: str, buckets: int, key: str = "student_id",
                     order: Sequence[str] = (), hot: float = HOT) -> ByStudent:
    """Store a table below ``path``; ``order`` sorts the rows of a student. The input is read twice:
    for the number of rows of each student, and to be written."""
    spark, order = df.sparkSession, [key, *order]
    keys = hot_keys(df, key, buckets, hot)
    named = F.coalesce(F.col(key).isin(*keys), F.lit(False)) if keys else F.lit(False)
    name = _table(spark, f"{path}/even", df.schema, key, order, buckets)
    # one file a bucket: the writer deals rows out by the same hash
    (df.filter(~named).repartition(buckets, key).sortWithinPartitions(*order)
     .write.mode("overwrite").insertInto(name, overwrite=True))
    df.filter(named).write.mode("overwrite").parquet(f"{path}/hot")
    return read_by_student(spark, path, df.schema, buckets, keys, key, order[1:])


def read_by_student(spark: SparkSession, path: str, schema: T.StructType, buckets: int, keys: tuple,
                    key: str = "student_id", order: Sequence[str] = ()) -> ByStudent:
    """A table that ``write_by_student`` has stored, in this or an earlier session."""
    name = _table(spark, f"{path}/even", schema, key, [key, *order], buckets)
    return ByStudent(spark.table(name), spark.read.schema(schema).parquet(f"{path}/hot"), keys, key,
                     buckets)

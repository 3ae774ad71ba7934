"""Duplicate people: find groups, choose the surviving id, follow it everywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutela.operators.joins import apart, with_flag

PERSON_KEYS = ("first_name", "last_name", "dob", "program_code", "commencing_term")


def survivorship(students: DataFrame, active: DataFrame, keys: Sequence[str] = PERSON_KEYS,
                 sid: str = "student_id") -> DataFrame:
    """(duplicate_id, surviving_id), one row per duplicate.

    Records equal in all ``keys`` (NULL equals NULL) are one person. The lowest
    id found in ``active`` survives, else the lowest id. Only two minima leave
    each map task per group, so a group of any size stays cheap; the members
    meet their survivor again through a join on the keys.
    """
    scored = with_flag(students.select(sid, *keys), active, [sid], "__active")
    groups = (scored.groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("__n"), F.min(sid).alias("__low"),
                   F.min(F.when(F.col("__active"), F.col(sid))).alias("__low_active"))
              .filter(F.col("__n") > 1)
              .select(*[F.col(k).alias(f"__k_{k}") for k in keys],
                      F.coalesce("__low_active", "__low").alias("surviving_id")))
    same = None
    for k in keys:
        test = F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        same = test if same is None else same & test
    pairs = (students.select(sid, *keys).join(apart(groups), same, "inner")
             .filter(F.col(sid) != F.col("surviving_id")))
    # an id listed twice must not multiply the rows it is later joined to
    return apart(pairs.groupBy(F.col(sid).alias("duplicate_id"))
                 .agg(F.min("surviving_id").alias("surviving_id")))


def drop_duplicates_by(df: DataFrame, survivors: DataFrame, sid: str = "student_id") -> DataFrame:
    """Without the duplicate ids; a row without an id cannot be told apart and goes too."""
    gone = survivors.select(F.col("duplicate_id").alias(sid))
    return df.filter(F.col(sid).isNotNull()).join(gone, sid, "left_anti")


def remap(df: DataFrame, survivors: DataFrame, sid: str = "student_id") -> DataFrame:
    """Replace duplicate ids by the surviving one."""
    found = df.join(survivors.withColumnRenamed("duplicate_id", sid), sid, "left")
    return found.withColumn(sid, F.coalesce("surviving_id", sid)).drop("surviving_id")

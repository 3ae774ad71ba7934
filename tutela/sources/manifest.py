"""The run manifest: one small JSON document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MANIFEST_SCHEMA = (
    "seed long, as_of_date string, current_term string, students long, enrolment_rows long, "
    "weekly_activity_rows long, cases long, alerts long, injected_defects long, "
    "injected_effect struct<p_effect_if_reached: double, engagement_uplift: double, "
    "retention_logit_bonus: double>"
)


def read_manifest(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    return spark.read.schema(schema or MANIFEST_SCHEMA).option("multiLine", True).json(path)

"""The cleaning rules as functions of SQL text, inlined by Catalyst.

``register`` declares them for a session. Their bodies say what the column expressions of
``scalars`` say; a test holds the two against each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: name -> (parameters, type, body)
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "proper_case": ("s STRING", "STRING",
                    "concat(upper(left(lower(trim(s)), 1)), substr(lower(trim(s)), 2))"),
    "upper_trim": ("s STRING", "STRING", "upper(trim(s))"),
    "full_name": ("a STRING, b STRING", "STRING", "concat(a, ' ', b)"),
    "tri_state": ("s STRING", "STRING",
                  "CASE s WHEN 'Y' THEN 'Yes' WHEN 'N' THEN 'No' ELSE 'Unknown' END"),
    "number_or_null": ("s STRING", "DOUBLE",
                  r"CASE WHEN NOT rlike(s, r'[0-9.][dDfF]\s*$') THEN try_cast(s AS DOUBLE) END"),
    "iso_date": ("s STRING", "DATE", r"CASE WHEN rlike(s, r'^\s*\d{4}-\d{1,2}-\d{1,2}\s*$') "
                                     "THEN try_cast(s AS DATE) END"),
    "mixed_date": ("s STRING", "DATE", "CASE WHEN contains(s, '/') THEN "
                                       "try_to_date(trim(s), 'd/M/yyyy') ELSE iso_date(s) END"),
    "term_year": ("s STRING", "INT", "CAST(substring(s, 1, 4) AS INT)"),
    "pass_flag": ("g STRING", "BOOLEAN", "CASE WHEN g IN ('HD', 'DI', 'CR', 'PA') THEN true "
                                         "WHEN g IN ('NN', 'WN') THEN false END"),
    "certified_load": ("status STRING, eftsl DOUBLE", "DOUBLE",
                       "CASE WHEN status <> 'Withdrawn pre-census' THEN eftsl ELSE 0D END"),
    "passed_load": ("g STRING, eftsl DOUBLE", "DOUBLE",
                    "CASE WHEN g IN ('HD', 'DI', 'CR', 'PA') THEN eftsl ELSE 0D END"),
    "safe_ratio": ("a DOUBLE, b DOUBLE", "DOUBLE", "try_divide(a, b)"),
}


def register(spark: SparkSession) -> list[str]:
    """Declare all functions for this session; returns their names."""
    for name, (parameters, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} "
                  f"RETURN {body}")
    return list(FUNCTIONS)


def register_surviving(spark: SparkSession, survivors: DataFrame, name: str = "surviving") -> None:
    """``surviving(id)``: the id that stands for a person. A query that calls it joins the
    survivorship table once; an id that is no duplicate stands for itself."""
    kind = survivors.schema["duplicate_id"].dataType.simpleString()
    survivors.createOrReplaceTempView(f"{name}_ids")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(id {kind}) RETURNS {kind} RETURN "
              f"coalesce((SELECT min(surviving_id) FROM {name}_ids WHERE duplicate_id = id), id)")

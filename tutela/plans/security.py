"""Row-level restriction by advisor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tutela.plans.metrics import RELATIONSHIPS, Model

# --- fixed values: roles and the advisor each may see -----------------------
ROLES: dict[str, str | None] = {
    "Manager": None,
    "Advisor_ADV01": "ADV01",
    "Advisor_ADV09_Online": "ADV09",
}
# ---------------------------------------------------------------------------


def restrict(df: DataFrame, advisors: DataFrame, allowed: Column | None) -> DataFrame:
    """Rows of the advisors that pass the predicate; without one, all rows.

    A row without an advisor belongs to nobody and shows only to managers.
    """
    if allowed is None:
        return df
    return df.join(advisors.filter(allowed).select("advisor_id"), "advisor_id", "left_semi")


def role_predicate(role: str) -> Column | None:
    advisor = ROLES[role]
    return None if advisor is None else F.col("advisor_id") == advisor


def user_predicate(principal: str | None = None, by: str = "upn") -> Column:
    """The advisor who is signed in, by principal name or display name."""
    who = F.lit(principal) if principal is not None else F.current_user()
    return F.col(by) == who


def restrict_for_user(df: DataFrame, advisors: DataFrame, principal: str | None = None,
                      is_manager: bool = False, by: str = "upn") -> DataFrame:
    return restrict(df, advisors, None if is_manager else user_predicate(principal, by))


def scoped_model(model: Model, allowed: Column | None) -> Model:
    """The model as a role sees it: the advisor dimension itself and every table
    related to it."""
    if allowed is None:
        return model
    advisors = model.tables["dim_advisor"]
    tables = {r[0] for r in RELATIONSHIPS if r[2] == "dim_advisor"}
    seen = {t: restrict(model.tables[t], advisors, allowed) for t in tables if t in model.tables}
    return model.scoped({**seen, "dim_advisor": advisors.filter(allowed)})


def declare_restricted(spark: SparkSession, name: str, df: DataFrame, grants: DataFrame,
                       by: str = "advisor_id") -> None:
    """Table function ``name()`` for SQL users: the rows of ``df`` that the signed-in user may see.

    ``grants`` holds (principal, ``by``): the advisor a user stands for; a user with a null there is a
    manager and sees all rows. Who has no grant sees nothing, and a row without an advisor shows
    only to managers. Who is asking is settled when the query runs, from ``current_user()``; the
    advisors found are constants by the time the files are scanned, so the test reaches the scan.
    Users get the function and not the table below it; files are the store's to protect.
    """
    twice = grants.groupBy("principal").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1)
    if twice.count():
        raise ValueError("a principal has more than one grant")
    df.createOrReplaceTempView(f"{name}_rows")
    grants.createOrReplaceTempView(f"{name}_grants")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    mine = f"FROM {name}_grants WHERE principal = current_user()"
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}() RETURNS TABLE ({columns}) RETURN
        SELECT * FROM {name}_rows WHERE `{by}` = (SELECT max(`{by}`) {mine})
           OR (SELECT coalesce(bool_or(`{by}` IS NULL), false) {mine})""")

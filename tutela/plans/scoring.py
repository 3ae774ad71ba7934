"""Seeded defects and the catch rate of the rules.

Rows are chosen by a hash of their key, so the choice needs no shuffle, no
state and no driver, and a lost task chooses the same rows again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutela.functions import composite_key
from tutela.operators.sets import stack
from tutela.plans.quality import CAMPUS, DUPLICATE, FLAG, MARK
from tutela.sources import lookup

# --- fixed values: defect kinds, default rates and spelling variants --------
RATES = {
    "duplicate_student": 0.003,
    "missing_equity_flag": 0.030,
    "campus_code_variant": 0.020,
    "mark_out_of_range": 0.002,
    "name_whitespace_case": 0.010,
    "dob_format_dmy": 0.015,
}
VARIANTS = {
    "NSY": ["Nth Sydney", "NORTH SYDNEY", "NSY "],
    "MEL": ["Melb", "MELBOURNE ", "mel"],
    "BRI": ["Brisbane", "BRIS"],
    "STR": ["Strathfield", "STRATH"],
}
# ---------------------------------------------------------------------------
ENROLMENT_KEY = ("student_id", "unit_code", "term_code")
STUDENT_KINDS = ("duplicate_student", "missing_equity_flag", "name_whitespace_case",
                 "dob_format_dmy")


def draw(kind: str, key: Column, seed: int) -> Column:
    """32 hex digits that depend on kind, seed and key alone."""
    return F.md5(F.concat_ws("|", F.lit(kind), F.lit(str(seed)), key.cast("string")))


def chosen(digits: Column, rate: float) -> Column:
    """True for ``rate`` of all keys: the first eight digits as a fraction."""
    if rate >= 1:
        return F.lit(True)
    return F.left(digits, F.lit(8)) < F.lit(f"{int(rate * 16 ** 8):08x}")


def coin(digits: Column) -> Column:
    return F.substring(digits, 9, 1) < F.lit("8")


def pick(digits: Column, n: int) -> Column:
    """0 .. n-1 from further digits."""
    return F.conv(F.substring(digits, 10, 6), 16, 10).cast("int") % n


def _log(df: DataFrame, kind: str, table: str, key: Column, detail: Column) -> DataFrame:
    return df.filter("__hit").select(
        F.lit(kind).alias("defect_type"), F.lit(table).alias("table"),
        key.cast("string").alias("row_key"), detail.cast("string").alias("detail"))


def inject(df: DataFrame, kind: str, rate: float | None = None,
           seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(damaged table, answer key) for one kind of defect.

    A duplicate gets the id of its original shifted by the largest id in use,
    which is new for every row without numbering the rows.
    """
    rate = RATES[kind] if rate is None else rate
    if kind in STUDENT_KINDS:
        table, key = "banner_students", F.col("student_id")
    else:
        table, key = "banner_enrolments", composite_key(*ENROLMENT_KEY)
    digits = draw(kind, key, seed)
    able = {
        "campus_code_variant": F.col("campus_code").isin(*VARIANTS)
        if "campus_code" in df.columns else F.lit(True),
        "mark_out_of_range": F.col("mark").isNotNull() if "mark" in df.columns else F.lit(True),
        "dob_format_dmy": F.col("dob").isNotNull() if "dob" in df.columns else F.lit(True),
    }.get(kind, F.lit(True))
    hit = df.withColumn("__hit", F.coalesce(chosen(digits, rate) & able, F.lit(False)))
    flip = coin(digits)
    test = F.col("__hit")

    if kind == "duplicate_student":
        top = df.agg(F.max(F.col("student_id").cast("bigint")).alias("m")).scalar()
        dtype = dict(df.dtypes)["student_id"]
        fresh = (F.col("student_id").cast("bigint") + top).cast(dtype)
        copies = hit.filter(test).withColumns({
            "__old": F.col("student_id"), "student_id": fresh,
            "student_status": F.lit("active")})
        log = _log(copies, kind, table, F.col("student_id"),
                   F.concat(F.lit("duplicate of "), F.col("__old").cast("string")))
        return df.unionByName(copies.drop("__hit", "__old")), log

    if kind == "missing_equity_flag":
        cols = ("first_nations_flag", "disability_flag")
        out = hit.withColumns({
            cols[0]: F.when(test & flip, F.lit("")).otherwise(F.col(cols[0])),
            cols[1]: F.when(test & ~flip, F.lit("")).otherwise(F.col(cols[1]))})
        detail = F.when(flip, cols[0]).otherwise(cols[1])
    elif kind == "campus_code_variant":
        variant = None
        for code, spellings in VARIANTS.items():
            chose = F.element_at(F.array(*[F.lit(s) for s in spellings]),
                                 pick(digits, len(spellings)) + 1)
            same = F.col("campus_code") == code
            variant = F.when(same, chose) if variant is None else variant.when(same, chose)
        hit = hit.withColumn("__new", F.when(test, variant))
        out = hit.withColumn("campus_code", F.coalesce("__new", "campus_code"))
        log = _log(hit, kind, table, key,
                   F.concat(F.col("campus_code"), F.lit(" -> "), F.col("__new")))
        return out.drop("__hit", "__new"), log
    elif kind == "mark_out_of_range":
        bad = F.when(flip, F.lit(105.0)).otherwise(F.lit(-1.0))
        dtype = dict(df.dtypes)["mark"]
        out = hit.withColumn("mark", F.when(test, bad.cast(dtype)).otherwise(F.col("mark")))
        detail = bad.cast("string")
    elif kind == "name_whitespace_case":
        name = F.col("first_name")
        noisy = F.when(flip, F.concat(F.lit("  "), F.upper(name))) \
            .otherwise(F.concat(name, F.lit(" ")))
        out = hit.withColumn("first_name", F.when(test, noisy).otherwise(name))
        detail = F.lit("first_name")
    elif kind == "dob_format_dmy":
        iso = F.col("dob").cast("string")
        part = F.split(iso, "-")
        dmy = F.concat_ws("/", part[2], part[1], part[0])
        out = hit.withColumn("dob", F.when(test, dmy).otherwise(iso))
        detail = iso
    else:
        raise KeyError(kind)
    return out.drop("__hit"), _log(hit, kind, table, key, detail)


def inject_all(students: DataFrame, enrolments: DataFrame, rates: dict[str, float] | None = None,
               seed: int = 1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(students, enrolments, answer key) with all six kinds."""
    rates = {**RATES, **(rates or {})}
    logs = []
    for kind in RATES:
        if kind in STUDENT_KINDS:
            students, log = inject(students, kind, rates[kind], seed)
        else:
            enrolments, log = inject(enrolments, kind, rates[kind], seed)
        logs.append(log)
    return students, enrolments, stack(logs)


def catch_rate(injected: DataFrame, issues: DataFrame, dim: DataFrame) -> DataFrame:
    """Defects handled per kind and in total.

    Kinds with a rule of their own count the keys in the issue log. A campus
    variant counts as handled when it was resolved, i.e. is *not* in the log.
    Names and birth dates are judged by the state of the student dimension: all
    or nothing. One pass: the key is looked up once with the rule that should
    or should not have logged it. A kind of which nothing was injected is listed
    with a share of 1.
    """
    rule = (F.when(F.col("defect_type") == "duplicate_student", DUPLICATE)
            .when(F.col("defect_type") == "mark_out_of_range", MARK)
            .when(F.col("defect_type") == "campus_code_variant", CAMPUS)
            .when(F.col("defect_type") == "missing_equity_flag", FLAG))
    logged = issues.select("rule_id", "row_key").distinct().withColumn("__logged", F.lit(True))
    keyed = injected.withColumn("rule_id", rule).join(logged, ["rule_id", "row_key"], "left")
    seen = F.coalesce(F.col("__logged"), F.lit(False))
    name = F.col("first_name")
    state = dim.agg(
        (F.count_if(name.startswith(" ") | name.endswith(" ")) == 0).alias("names"),
        (F.count_if(F.col("dob").isNull()) == 0).alias("dobs"))
    kind = F.col("defect_type")
    handled = (F.when(kind == "campus_code_variant", ~seen)
               .when(kind == "name_whitespace_case", state.select("names").scalar())
               .when(kind == "dob_format_dmy", state.select("dobs").scalar())
               .otherwise(seen))
    counts = keyed.withColumn("__ok", handled).rollup("defect_type").agg(
        F.grouping("defect_type").alias("__all"), F.count(F.lit(1)).alias("injected"),
        F.count_if("__ok").alias("handled"))
    found = counts.select(
        F.when(F.col("__all") == 1, "TOTAL").otherwise(kind).alias("defect_type"),
        "injected", "handled")
    zero = F.lit(0).cast("bigint")
    every = lookup(injected.sparkSession, [(k,) for k in RATES], "defect_type string")
    listed = stack([found, every.select("defect_type", zero.alias("injected"),
                                        zero.alias("handled"))])
    share = F.round(F.col("handled").cast("double") / F.col("injected"), 4)
    return listed.groupBy("defect_type").agg(
        F.sum("injected").alias("injected"), F.sum("handled").alias("handled")).withColumn(
        "share", F.when(F.col("injected") == 0, 1.0).otherwise(share))

from datetime import date

import pytest
from pyspark.sql import functions as F

from tutela import functions as fn


def one(spark, value, expr, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr.alias("y")).first().y


@pytest.mark.parametrize("text,want", [
    ("1999-12-31", date(1999, 12, 31)), ("31/12/1999", date(1999, 12, 31)),
    ("1/2/2003", date(2003, 2, 1)), ("31/02/2020", None), ("2020", None), ("2020-05", None),
    ("soon", None), (None, None), ("", None)])
def test_mixed_date(spark, text, want):
    assert one(spark, text, fn.mixed_date("x")) == want


@pytest.mark.parametrize("text,want", [
    ("75", 75.0), (" 12.5 ", 12.5), ("75F", None), ("75d", None), ("n/a", None), (None, None),
    ("-1", -1.0)])
def test_to_double(spark, text, want):
    assert one(spark, text, fn.to_double("x")) == want


def test_nan_text_is_a_number_that_is_not_one(spark):
    assert one(spark, "NaN", F.isnan(fn.to_double("x"))) is True


@pytest.mark.parametrize("text,want", [
    ("  MARY ann ", "Mary ann"), ("o'brien", "O'brien"), ("", ""), (None, None)])
def test_proper_case(spark, text, want):
    assert one(spark, text, fn.proper_case("x")) == want


def test_strict_cast_stops_the_job(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "twelve", fn.strict("x", "int"))


@pytest.mark.parametrize("flag,want", [("Y", "Yes"), ("N", "No"), ("", "Unknown"),
                                       (None, "Unknown"), ("y", "Unknown")])
def test_tri_state(spark, flag, want):
    assert one(spark, flag, fn.tri_state("x")) == want


@pytest.mark.parametrize("x,want", [(105.0, "105.0"), (12345678.5, "12345678.5"),
                                    (1e7, "10000000.0"), (0.0, "0.0"), (-1.0, "-1.0")])
def test_number_text(spark, x, want):
    assert one(spark, x, fn.number_text("x"), "double") == want


def test_composite_key_and_name_propagate_null(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    r = df.select(fn.composite_key("a", "b").alias("k"), fn.full_name("a", "b").alias("n")).first()
    assert r.k is None and r.n is None


@pytest.mark.parametrize("x,want", [(0, "nan"), (1, "a"), (5, "a"), (6, "b"), (8, "b"), (9, "nan"),
                                    (None, "nan")])
def test_cut_is_right_closed(spark, x, want):
    assert one(spark, x, fn.cut("x", (0, 5, 8), ("a", "b")), "int") == want


def test_clip_keeps_null(spark):
    assert one(spark, None, fn.clip("x", 1, 3), "int") is None
    assert one(spark, 9, fn.clip("x", 1, 3), "int") == 3


def test_ratio_day_diff_and_flags(spark):
    df = spark.createDataFrame([(1, 0, date(2024, 1, 1), date(2024, 1, 5), "IP", None)],
                               "a int, b int, s date, e date, grade string, status string")
    r = df.select(fn.safe_ratio("a", "b").alias("q"), fn.day_diff("e", "s").alias("d"),
                  fn.day_diff("s", "e").alias("neg"), fn.pass_flag("grade").alias("p"),
                  fn.certified_load("status", F.lit(0.125)).alias("load")).first()
    assert (r.q, r.d, r.neg, r.p, r.load) == (None, 4, -4, None, 0.0)


def test_split_search_and_colour(spark):
    df = spark.createDataFrame([("NSY|STR", "was REACHED late", "P3 - x"), (None, None, "P4")],
                               "c string, o string, t string")
    got = df.select(fn.has_item("c", "STR").alias("h"), fn.has_item("c", "ST").alias("n"),
                    fn.search_text("o", "Reached").alias("s"),
                    fn.tier_colour("t").alias("k")).collect()
    assert tuple(got[0]) == (True, False, True, "#BFE3DC")
    assert tuple(got[1]) == (None, None, False, "#E6E6E6")

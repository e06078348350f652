import pytest
from pyspark.sql import functions as F

from cohort_engine.functions.text import contains_text, matches

TEXTS = ["Drug Overdose", "drug overdose (disorder)", "pain", "100% burn", "1000 burn", "it's", None]


def found(spark, condition):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    return [r.t for r in df.filter(condition).collect()]


@pytest.mark.parametrize("text", ["drug overdose", "Drug OVERDOSE"])
def test_matches_ignores_case_of_both(spark, text):
    assert found(spark, matches("t", text)) == TEXTS[:2]


def test_contains_is_case_sensitive(spark):
    assert found(spark, contains_text("t", "drug overdose")) == TEXTS[1:2]


def test_wildcards(spark):
    assert found(spark, matches("t", "100% burn")) == ["100% burn", "1000 burn"]
    assert found(spark, matches("t", "100% burn", literal=True)) == ["100% burn"]
    assert found(spark, matches("t", "p_in")) == ["pain"]
    assert found(spark, matches("t", "p_in", literal=True)) == []


def test_quote_in_text(spark):
    assert found(spark, matches("t", "it's")) == ["it's"]


def test_null_stays_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(matches(F.col("t"), "x").alias("m")).first().m is None


@pytest.mark.parametrize("text", ["a\\b", "ends\\", "50% x", "a_b"])
def test_names_from_data_are_plain_text(spark, text):
    rows = [(text,), ("axb",), ("50 then x",), (f"about {text}",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r.t for r in df.filter(contains_text("t", text, literal=True)).collect()]
    assert got == [text, f"about {text}"]


def test_backslash_is_a_plain_character(spark):
    df = spark.createDataFrame([("a\\b",), ("ab",), ("c\\",)], "t string")
    assert [r.t for r in df.filter(contains_text("t", "a\\b")).collect()] == ["a\\b"]
    assert [r.t for r in df.filter(contains_text("t", "c\\")).collect()] == ["c\\"]

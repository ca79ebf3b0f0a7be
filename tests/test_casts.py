import datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from reelmill.functions import casts


def cast_all(spark, values, cast):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, txt string")
    return [r["out"] for r in df.select("i", cast(F.col("txt")).alias("out")).orderBy("i").collect()]


def test_coerce_int(spark):
    texts = ["12", " 7 ", "1e3", "2.0", "+5", "-3", "x", "0x10", "1_000", "1d", "1f", "nan",
             "inf", "", None, "9007199254740993"]
    assert cast_all(spark, texts, casts.coerce_int) == [
        12, 7, 1000, 2, 5, -3, None, None, None, None, None, None, None, None, None,
        9007199254740993,
    ]


@pytest.mark.parametrize("text", ["1.5", "1e-1", "1e30", "1e999"])
def test_coerce_int_refuses_fractions(spark, text):
    with pytest.raises(Exception, match="not a whole number"):
        cast_all(spark, [text], casts.coerce_int)
    assert cast_all(spark, [text], lambda c: casts.coerce_int(c, "null")) == [None]


def test_coerce_int_rejects_unknown_mode(spark):
    with pytest.raises(ValueError):
        casts.coerce_int(F.col("txt"), "maybe")


def test_coerce_double(spark):
    texts = ["1.5", " 2 ", ".5", "3.", "1e3", "1d", "nan", "inf", "-inf", "1e999", "x", "", None]
    assert cast_all(spark, texts, casts.coerce_double) == [
        1.5, 2.0, 0.5, 3.0, 1000.0, None, None, None, None, None, None, None, None,
    ]


@settings(max_examples=5, deadline=None)
@given(values=st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=30))
def test_integers_survive_exactly(spark, values):
    texts = [str(v) for v in values]
    assert cast_all(spark, texts, casts.coerce_int) == values
    assert cast_all(spark, texts, casts.strict_int) == values


def test_strict_int(spark):
    assert cast_all(spark, ["0", " 1 ", None], casts.strict_int) == [0, 1, None]
    for text in ["x", "0.5", "1.0", ""]:
        with pytest.raises(Exception, match="invalid integer"):
            cast_all(spark, [text], casts.strict_int)


def test_strict_int_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="invalid integer"):
            cast_all(spark, ["x"], casts.strict_int)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_whole_number(spark):
    texts = ["1.5", "-1.5", "2.4", "abc", "7", None]
    assert cast_all(spark, texts, casts.whole_number) == [2, -2, 2, None, 7, None]


def test_coerce_date(spark):
    texts = ["2024-02-29", "2023-02-29", "", "soon", "2024", "2024-1-5", None]
    assert cast_all(spark, texts, casts.coerce_date) == [
        datetime.date(2024, 2, 29), None, None, None, None, datetime.date(2024, 1, 5), None,
    ]


def test_null_tokens(spark):
    df = spark.createDataFrame([("\\N", 1), ("", 2), ("None", 3), ("x", 4)], "t string, n int")
    assert rows(casts.normalize_nulls(df)) == rows(
        spark.createDataFrame([(None, 1), (None, 2), ("None", 3), ("x", 4)], df.schema)
    )
    as_pandas = casts.normalize_nulls(df, casts.null_tokens(pandas_na=True))
    assert [r["t"] for r in as_pandas.orderBy("n").collect()] == [None, None, None, "x"]


def test_numeric_by_type(spark):
    df = spark.createDataFrame([(1, float("nan"), "2.5")], "a int, b double, c string")
    typed = df.select(*[casts.numeric(df, c).alias(c) for c in df.columns])
    assert tuple(typed.first()) == (1, None, 2.5)
    assert dict(typed.dtypes) == {"a": "bigint", "b": "double", "c": "double"}

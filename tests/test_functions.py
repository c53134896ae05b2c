import math

import pytest
from pyspark.sql import functions as F

from chronoframe.functions import age_years, hours_between, parse_numeric, sanitize_columns, sanitize_name


def test_parse_numeric_grammar(spark):
    texts = ["1", " 2 ", "1e3", ".5", "inf", "x", "", "nan", "0x10", "1_000", "1d", None, "-2.5E-1", "1."]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(parse_numeric("v")).collect()]
    want = [1.0, 2.0, 1000.0, 0.5, math.inf, None, None, None, None, None, None, None, -0.25, 1.0]
    assert got == want


def test_parse_numeric_passes_numbers_and_drops_nan(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "v double")
    assert [r[0] for r in df.select(parse_numeric("v")).collect()] == [1.5, None, None]


def test_hours_and_age(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ '1700-01-01 00:00:00' AS dob, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS a, "
        "TIMESTAMP_NTZ '2024-01-01 01:30:00' AS b"
    )
    r = df.select(age_years("dob", "a").alias("age"), hours_between("a", "b").alias("h"),
                  hours_between("b", "a").alias("neg")).first()
    assert r["age"] == pytest.approx(118338 / 365.25, abs=1e-9)  # 324 years incl. 78 leap days
    assert r["h"] == 1.5 and r["neg"] == -1.5


def test_sanitize(spark):
    assert sanitize_name("A B-c.1") == "A_B_c_1"
    df = spark.createDataFrame([(1, 2)], "`a b` int, `c` int")
    assert sanitize_columns(df).columns == ["a_b", "c"]
    with pytest.raises(ValueError):
        sanitize_columns(spark.createDataFrame([(1, 2)], "`A B` int, `A-B` int"))

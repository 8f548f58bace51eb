"""Texts: number formats against Python's, labels, icons and dates."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scoreloom.functions import text


def texts(spark, values, build):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double").coalesce(1)
    return [r[0] for r in df.orderBy("i").select(build(F.col("x"))).collect()]


HALVES = [i / 20 for i in range(-2100, 2101)]


def test_one_decimal_agrees_with_python_on_halves(spark):
    assert texts(spark, HALVES, text.fixed_1) == [f"{v:.1f}" for v in HALVES]
    assert texts(spark, HALVES, text.signed_1) == [f"{v:+.1f}" for v in HALVES]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.floats(-300, 300), st.floats(-(2.0**53), 2.0**53)), min_size=1, max_size=300))
def test_one_decimal_agrees_with_python(spark, values):
    values = [v + 0.0 for v in values]
    expected = [f"{v:.1f}" if v else "0.0" for v in values]
    assert texts(spark, values, text.fixed_1) == expected


def test_large_numbers_and_null(spark):
    values = [200.0, 200.25, 250.25, 250.75, 999.95, 1000.25, 123456.7, 2.0**53 - 0.5, 2.0**60, -1000.75]
    assert texts(spark, values, text.fixed_1) == [f"{v:.1f}" for v in values]
    assert texts(spark, [None, float("inf"), 1e300], text.fixed_1)[0] is None


def test_trend_label(spark):
    assert texts(spark, [2.05, -2.25, 0.0], text.trend_label) == ["▲ 2.0", "▼ 2.2", "▲ 0.0"]


def test_baseline_delta_rounds_half_to_even(spark):
    values = [50.25, 50.75, 49.75, 51.3]
    assert texts(spark, values, text.baseline_delta) == [0.2, 0.8, -0.2, 1.3]


def test_trend_symbol_at_zero(spark):
    assert texts(spark, [0.0, 0.1, -0.1], text.trend_symbol) == ["▲", "▲", "▼"]


def test_thousands(spark):
    df = spark.createDataFrame([(999,), (1000,), (1234567,)], "n bigint")
    assert [r[0] for r in df.select(text.thousands(F.col("n"))).collect()] == [
        "999",
        "1,000",
        "1,234,567",
    ]


def test_icon_url_drops_blanks_apostrophes_and_dots(spark):
    names = ["Lee Sin", "Kai'Sa", "Dr. Mundo", "Lux"]
    df = spark.createDataFrame([(n,) for n in names], "c string")
    found = [r[0].split("/")[-2] for r in df.select(text.icon_url(F.col("c"))).collect()]
    assert found == ["LeeSin", "KaiSa", "DrMundo", "Lux"]


def test_sync_label(spark):
    moment = dt.datetime(2024, 3, 5, 7, 9)
    df = spark.createDataFrame([(moment,)], "t timestamp_ntz")
    assert df.select(text.sync_label(F.col("t"))).first()[0] == "Last sync: 05 Mar 2024  07:09"

"""Scalar semantics: parsing, binning, text, rounding, calendar padding."""

from decimal import Decimal

from pyspark.sql import functions as F

from paylake.functions import calendar, numeric, parse, text
from paylake.operators.enrich import amount_bucket
from paylake.schemas import NULL_TOKENS


def test_amount_bins_are_right_closed(spark):
    vals = ["0.01", "50", "50.01", "200", "500", "1000", "1000.01"]
    df = spark.createDataFrame([(v,) for v in vals], "v string").select(
        "v", amount_bucket(F.col("v").cast("decimal(12,2)")).alias("b"))
    got = {r.v: r.b for r in df.collect()}
    assert got == {
        "0.01": "Micro (<50)", "50": "Micro (<50)", "50.01": "Small (50-200)",
        "200": "Small (50-200)", "500": "Medium (200-500)", "1000": "Large (500-1k)",
        "1000.01": "High Value (1k+)",
    }


def test_numeric_text_only_clean_numbers_survive(spark):
    vals = ["N/A", "NaN", "1.5d", "inf", " 1e3 ", "1,000", "", "12.345"]
    df = spark.createDataFrame([(v,) for v in vals], "v string").select(
        "v", parse.parse_decimal(F.col("v")).alias("x"))
    got = {r.v: r.x for r in df.collect()}
    assert got[" 1e3 "] == Decimal("1000.00")
    assert got["12.345"] == Decimal("12.35")
    assert all(got[v] is None for v in ["N/A", "NaN", "1.5d", "inf", "1,000", ""])


def test_timestamp_text_declared_format_only(spark):
    vals = ["2024-01-02 03:04:05", "2024-01-02 03:04:05.123456", "2024-01-02", "2024", "12:30", "invalid_date"]
    df = spark.createDataFrame([(v,) for v in vals], "v string").select(
        "v", parse.parse_timestamp(F.col("v")).alias("t"))
    got = {r.v: r.t for r in df.collect()}
    assert got["2024-01-02 03:04:05"] is not None
    assert got["2024-01-02 03:04:05.123456"].microsecond == 123456
    assert all(got[v] is None for v in ["2024-01-02", "2024", "12:30", "invalid_date"])
    assert dict(df.dtypes)["t"] == "timestamp_ntz"


def test_null_tokens_all_become_null(spark):
    df = spark.createDataFrame([(t,) for t in NULL_TOKENS] + [("ok",)], "v string")
    out = [r.x for r in df.select(text.null_tokens(F.col("v")).alias("x")).collect()]
    assert out.count(None) == len(NULL_TOKENS) and "ok" in out


def test_title_case_restarts_after_punctuation(spark):
    df = spark.createDataFrame([("BRONG-AHAFO",), ("GREATER ACCRA",), (None,)], "r string")
    out = [r.t for r in df.select(text.initcap_words(F.col("r")).alias("t")).collect()]
    assert out == ["Brong-Ahafo", "Greater Accra", None]


def test_strip_upper_handles_tabs(spark):
    df = spark.createDataFrame([(" failed\t",), ("\nmbp ",)], "s string")
    assert [r.x for r in df.select(text.strip_upper(F.col("s")).alias("x")).collect()] == ["FAILED", "MBP"]


def test_padded_month_and_day_names(spark):
    df = spark.sql("SELECT DATE'2024-01-06' AS d").select(
        calendar.padded_month_name(F.col("d")).alias("m"), calendar.padded_day_name(F.col("d")).alias("w"))
    r = df.first()
    assert r.m == "January  " and r.w == "Saturday "


def test_weekend_is_saturday_and_sunday(spark):
    df = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'2024-01-01 00:00:00', "
                   "TIMESTAMP_NTZ'2024-01-07 00:00:00', INTERVAL 1 DAY)) AS t")
    flags = [r.w for r in df.select(calendar.is_weekend(F.col("t")).alias("w")).orderBy("t").collect()]
    assert flags == [False] * 5 + [True, True]


def test_half_up_ratio_exact_on_ties(spark):
    # 1/8 = 12.5 % -> 12.5; 1/3 = 33.333.. -> 33.33; 2/3 -> 66.67; -1/8 -> -12.5; x/0 -> null
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (-1, 8), (5, 0), (1, 16)], "n long, d long")
    got = [r.x for r in df.select(numeric.half_up_ratio(F.col("n"), F.col("d"), 2, 100).alias("x")).collect()]
    assert got == [12.5, 33.33, 66.67, -12.5, None, 6.25]
    got1 = [r.x for r in df.select(numeric.half_up_ratio(F.col("n"), F.col("d"), 1, 100).alias("x")).collect()]
    assert got1[5] == 6.3  # 6.25 rounds half up


def test_money_text_matches_python_format(spark):
    vals = [0.125, 2.675, 1234.565, 1234567.891, 583.7, 0.25, 3.05, -87.35]
    df = spark.createDataFrame([(v,) for v in vals], "x double").select(
        "x", text.money_text(F.col("x")).alias("m"), text.plain_fixed(F.col("x"), 1).alias("p"))
    for r in df.collect():
        assert r.m == f"{r.x:,.2f}"
        assert r.p == f"{r.x:.1f}"


def test_timestamp_parse_is_zone_independent(spark):
    import datetime as dt
    df = spark.createDataFrame([("2024-03-10 02:30:00",), ("2024-02-30 00:00:00",), ("2024-01-01 00:00:00.5",)], "v string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r.t for r in df.select(parse.parse_timestamp(F.col("v")).alias("t")).collect()]
        mic = [r.m for r in df.select(calendar.epoch_micros(parse.parse_timestamp(F.col("v"))).alias("m")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [dt.datetime(2024, 3, 10, 2, 30), None, dt.datetime(2024, 1, 1, 0, 0, 0, 500000)]
    assert mic[0] == int(dt.datetime(2024, 3, 10, 2, 30, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000


def test_gap_across_dst_change_is_wall_clock(spark):
    df = spark.createDataFrame([("2024-03-10 01:59:00", "2024-03-10 03:01:00")], "a string, b string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        g = df.select(calendar.gap_seconds(parse.parse_timestamp(F.col("a")),
                                           parse.parse_timestamp(F.col("b"))).alias("g")).first().g
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert g == 3720.0

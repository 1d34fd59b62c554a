"""Scalar rules on small hand-written inputs (FIXTURES.md §4)."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.functions import cleaning as C
from eventlake.functions import ranges as R


def one_col(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_bigint_from_text(spark):
    df = one_col(spark, ["1.5", "abc", "", "0x1F", " 12 ", "+5", "-7", "99999999999999999999", None])
    got = [r[0] for r in df.select(C.safe_bigint("v")).collect()]
    assert got == [None, None, None, None, 12, 5, -7, None, None]


def test_bigint_from_double_rounds_half_away_from_zero(spark):
    df = one_col(spark, [2.5, -2.5, 1.4, float("nan"), 1e30], "double")
    got = [r[0] for r in df.select(C.safe_bigint("v", T.DoubleType())).collect()]
    assert got == [3, -3, 1, None, None]


def test_double_from_text(spark):
    df = one_col(spark, ["2.5", "unrated", "1.5d", "1e3", "inf", ".5", "x", ""])
    got = [r[0] for r in df.select(C.safe_double("v")).collect()]
    assert got[:2] == [2.5, None]
    assert got[2] is None  # Java's type suffix is not a number here
    assert got[3] == 1000.0 and got[4] == float("inf") and got[5] == 0.5
    assert got[6:] == [None, None]


def test_yes_no_trims_all_whitespace(spark):
    df = one_col(spark, ["\tyes\n", " YES ", "No ", "1", "0", "False", "maybe", "", None])
    got = [r[0] for r in df.select(C.yes_no("v")).collect()]
    assert got == [True, True, False, True, False, False, None, None, None]


@pytest.mark.parametrize(
    "raw,want",
    [
        ("5.", Decimal("5")), (".5", Decimal("0.5")), ("", None), ("-", None), ("5-", None),
        ("1.234.56", None), ("1.234,56", None), ("1,234.56", None), ("USD 12,50", Decimal("12.5")),
        ("-7.25 EUR", Decimal("-7.25")), ("free", None), ("1e5", Decimal("15")),
        ("1.0000000005", Decimal("1.000000001")), ("9" * 30, None),
    ],
)
def test_price_decimal(spark, raw, want):
    got = one_col(spark, [raw]).select(C.price_decimal("v").alias("p")).first()["p"]
    assert (got is None and want is None) or got == want
    assert one_col(spark, [raw]).select(C.price_decimal("v")).schema[0].dataType == T.DecimalType(38, 9)


def test_nanos_truncate_toward_zero(spark):
    df = one_col(spark, [-1999, 1999, 1_704_067_200_000_000_789], "bigint")
    got = [r[0] for r in df.select(C.micros_of("v", T.LongType())).collect()]
    assert got == [-1, 1, 1_704_067_200_000_000]


def test_utc_date_independent_of_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = one_col(spark, [1_704_067_200_000_000 - 1, 1_704_067_200_000_000], "bigint")
        got = [r[0] for r in df.select(C.utc_date(F.col("v"))).collect()]
        assert got == [date(2023, 12, 31), date(2024, 1, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_file_day(spark):
    df = one_col(
        spark,
        ["x/20240105_OTA.parquet", "x/120240105_OTA.parquet", "x/foo_OTA.parquet", "x/20240102_XYZ.parquet",
         "x/20240105_OTA.parquet/part-0001.snappy.parquet"],
    )
    got = [r[0] for r in df.select(C.day_of_file("v")).collect()]
    assert got == [date(2024, 1, 5), date(2024, 1, 5), None, None, date(2024, 1, 5)]


def test_impossible_file_day_raises_or_nulls(spark):
    df = one_col(spark, ["x/20261399_OTA.parquet"])
    assert df.select(C.day_of_file("v", strict=False)).first()[0] is None
    with pytest.raises(Exception):
        df.select(C.day_of_file("v")).collect()


def test_range_resolution():
    assert R.resolve_range("2024-01-10", "2024-01-12") == (date(2024, 1, 10), date(2024, 1, 12))
    assert R.resolve_range(None, "2024-01-12") == (date(2024, 1, 10), date(2024, 1, 12))
    assert R.resolve_range(" None ", "null", today=date(2024, 3, 1)) == (date(2024, 2, 28), date(2024, 3, 1))
    assert R.resolve_range("", "", today=date(2024, 3, 1))[1] == date(2024, 3, 1)
    with pytest.raises(ValueError):
        R.resolve_range("2026-1-5", None)


def test_range_days(spark):
    days = R.range_days(spark, date(2024, 1, 30), date(2024, 2, 2)).collect()
    assert [r.day_key for r in days] == ["20240130", "20240131", "20240201", "20240202"]
    assert R.range_days(spark, date(2024, 2, 2), date(2024, 1, 30)).count() == 0


def test_cast_guards_change_no_result(spark):
    """The pattern tests before integer and decimal casts only spare failed casts."""
    texts = ["5.", ".5", "", "-", "5-", "1.234.56", "1.0000000005", "9" * 30, "12.50", "-7.25", ".", "-.5",
             "--5", "-0", "00012", "1.", "9" * 40, " 12 ", "+5", "1e3", "0x1F", "\t3\n", "n/a", "1.5", None]
    df = spark.createDataFrame([(v,) for v in texts], "v string")
    got = df.select(
        F.expr("TRY_CAST(v AS BIGINT)").alias("int_plain"), C.safe_bigint("v").alias("int_guarded"),
        F.expr("TRY_CAST(replace(regexp_replace(v, '[^0-9,.-]', ''), ',', '.') AS DECIMAL(38,9))").alias("dec_plain"),
        C.price_decimal("v").alias("dec_guarded"),
    ).collect()
    for r in got:
        assert r.int_plain == r.int_guarded and r.dec_plain == r.dec_guarded


def test_flag_trim_matches_whitespace_pattern(spark):
    samples = ["\\t yes\\n", "\\u00a0No\\u3000", "\\u2028true\\u2029", "\\x0b1\\f", " maybe ", "y es", ""]
    df = spark.createDataFrame([(v.encode().decode("unicode_escape"),) for v in samples], "v string")
    got = df.select(
        F.regexp_replace("v", C.EDGE_SPACE, "").alias("pattern"), F.expr(C.strip_all_sql("v")).alias("chars")
    ).collect()
    assert all(r.pattern == r.chars for r in got)

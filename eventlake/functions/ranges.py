"""Run date range: resolved once on the driver, then passed down as literals.

``None``, blank, ``none`` and ``null`` (any case, trimmed) mean "not
given". The end defaults to today (UTC), the start to end minus two days;
both are inclusive. Malformed text raises. A start after the end is an
empty range, not an error.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake.functions import cleaning as C

DEFAULT_SPAN_DAYS = 2  # start = end - 2 days: a three-day window
_NOT_GIVEN = {"", "none", "null"}


def parse_day(value: str | date | None) -> date | None:
    """Date parameter -> date; not-given spellings -> None; malformed -> ValueError."""
    if value is None:
        return None
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    text = str(value).strip()
    if text.lower() in _NOT_GIVEN:
        return None
    try:
        return datetime.fromisoformat(text).date()
    except ValueError as e:
        raise ValueError(f"invalid date parameter {value!r}: use YYYY-MM-DD") from e


def resolve_range(
    start: str | date | None = None,
    end: str | date | None = None,
    today: date | None = None,
) -> tuple[date, date]:
    """(start, end), inclusive; "today" is taken once, here, in UTC."""
    end_d = parse_day(end)
    if end_d is None:
        end_d = today or datetime.now(timezone.utc).date()
    start_d = parse_day(start)
    if start_d is None:
        start_d = end_d - timedelta(days=DEFAULT_SPAN_DAYS)
    return start_d, end_d


def range_days(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day of the range: ``day`` (DATE) and ``day_key`` (YYYYMMDD).

    Empty when start > end (``sequence`` would raise on such bounds).
    """
    lo, hi = F.lit(start), F.lit(end)
    days = F.when(lo <= hi, F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).otherwise(
        F.array().cast("array<date>")
    )
    return (
        spark.range(1)
        .select(F.explode(days).alias("day"))
        .select("day", C.day_key("day").alias("day_key"))
    )


def day_file_name(day_key: Column, suffix: str = S.DEFAULT_SUFFIX) -> Column:
    """'YYYYMMDD' -> 'YYYYMMDD_<suffix>.parquet'."""
    return F.concat(day_key, F.lit(f"_{suffix}.parquet"))


def days_between(start: date, end: date) -> list[date]:
    """The days of a range, on the driver; empty when it ends before it starts."""
    return [start + timedelta(days=i) for i in range((end - start).days + 1)]

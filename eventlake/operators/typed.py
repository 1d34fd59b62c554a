"""Typed projection: raw day-file rows (27 loose columns) -> the 32-column table.

One projection of built-in expressions, handed to Spark as SQL text in a
single ``selectExpr``. Catalyst prunes the scan to the 27 named columns
(extra source columns are never read) and the whole projection runs in one
whole-stage-codegen span.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame

from eventlake import schema as S
from eventlake.functions import cleaning as C

FILE_PATH = "_metadata.file_path"


def _load_time_sql(ingested_at: datetime | str | None) -> str:
    if ingested_at is None:
        return "current_timestamp()"
    if isinstance(ingested_at, datetime):
        ts = ingested_at if ingested_at.tzinfo else ingested_at.replace(tzinfo=timezone.utc)
        micros = int(ts.timestamp()) * 1_000_000 + ts.microsecond
        return f"timestamp_micros({micros})"
    return ingested_at  # SQL expression text, e.g. a column name


def typed_sql(
    raw: DataFrame,
    *,
    suffix: str = S.DEFAULT_SUFFIX,
    file_path: str = FILE_PATH,
    ingested_at: datetime | str | None = None,
    on_bad_day: str = "error",
) -> list[str]:
    """The 32 output expressions as SQL text, in table order.

    ``file_path`` and a string ``ingested_at`` are SQL expression text
    (a column name, ``_metadata.file_path``, ``current_timestamp()``).
    """
    missing = [c for c in S.RAW_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"raw input lacks columns: {missing}")
    types = {f.name: f.dataType for f in raw.schema.fields}
    micros = C.micros_sql("timestamp", types["timestamp"])
    rules: dict[str, str] = {
        **{c: C.safe_bigint_sql(c, types[c]) for c in S.BIGINT_COLUMNS},
        **{c: C.safe_double_sql(c, types[c]) for c in S.DOUBLE_COLUMNS},
        **{c: C.yes_no_sql(c) for c in S.FLAG_COLUMNS},
        "timestamp": f"timestamp_micros({micros})",
        "event_date": C.utc_date_sql(micros),
        "hotel_price_raw": f"CAST({C.ident('hotel_price')} AS STRING)",
        "hotel_price": C.price_decimal_sql("hotel_price", types["hotel_price"]),
        "source_day": C.day_of_file_sql(file_path, suffix, strict=(on_bad_day == "error")),
        "source_file": file_path,
        "ingested_at": _load_time_sql(ingested_at),
    }
    return C.projection_sql(S.TYPED_COLUMNS, rules)


def typed_events(
    raw: DataFrame,
    *,
    suffix: str = S.DEFAULT_SUFFIX,
    file_path: str = FILE_PATH,
    ingested_at: datetime | str | Column | None = None,
    on_bad_day: str = "error",
) -> DataFrame:
    """Typed rows of raw day-file rows.

    ``file_path`` defaults to the scanned file (``_metadata.file_path``);
    when the reader already carries the path as a column (``source_file``
    from ``landing.read_day_files``), pass that name: referencing the
    metadata struct again after a projection makes the scan compute Parquet
    row indexes it never uses (seen in explain);
    ``ingested_at`` defaults to the load time of the statement
    (``current_timestamp()``, one value per query) and may be a fixed
    datetime, SQL text or a Column. ``on_bad_day="null"`` turns an
    impossible date in a file name into NULL instead of an error.
    """
    if isinstance(ingested_at, Column):
        exprs = typed_sql(raw, suffix=suffix, file_path=file_path, on_bad_day=on_bad_day)
        exprs[S.TYPED_COLUMNS.index("ingested_at")] = "_ingested_at AS ingested_at"
        return raw.withColumn("_ingested_at", ingested_at).selectExpr(*exprs)
    return raw.selectExpr(
        *typed_sql(raw, suffix=suffix, file_path=file_path, ingested_at=ingested_at, on_bad_day=on_bad_day)
    )


def fixture_typed(raw: DataFrame) -> DataFrame:
    """Typed rows of the ``ota_raw`` fixture, which carries file and load time as columns."""
    return typed_events(raw, file_path="source_file", ingested_at="ingested_at")

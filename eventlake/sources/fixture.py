"""The ``ota_raw`` fixture: raw travel events derived from the ``events`` table.

No travel-event table ships with the test data, so every query and its SQL
oracle derive one from ``events`` (FIXTURES.md §3). Rows are four
deliveries of the same base events, each with its own file day, landing
lane and load time; the duplicates they create are what deduplication and
the keyed upsert resolve.

The Spark form reads ``events`` once: each event row is fanned out to the
deliveries it belongs to with a generator and a filter, so the work grows
linearly with the table and no union re-reads the source.

The same expressions, as SQL text, build the DuckDB side of every oracle.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from eventlake import schema as S
from eventlake.functions import cleaning as C

# Fixed values of the fixture (FIXTURES.md §3.1): column -> expression over
# ``events``, valid unchanged in Spark SQL and DuckDB, except ``timestamp``.
BASE_EXPRESSIONS = [
    ("request_id", "'r' || CAST(event_id - event_id % 4 AS STRING)"),
    ("funnel_id", "CASE WHEN event_id % 13 = 0 THEN NULL ELSE 'f' || CAST(user_id % 37 AS STRING) END"),
    ("session_id", "'s' || CAST(user_id AS STRING)"),
    ("user_id", "CASE WHEN event_id % 9 = 0 THEN 'n/a' WHEN event_id % 9 = 1 THEN '1.5' ELSE CAST(user_id AS STRING) END"),
    ("user_agent", "'ua/' || CAST(user_id % 5 AS STRING)"),
    ("device_type", "CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END"),
    ("ip_address", "'10.0.0.' || CAST(user_id % 250 AS STRING)"),
    ("timestamp", None),
    ("page_name", "event_type"),
    ("subscriber_id", "CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(user_id + 5000 AS STRING) END"),
    ("has_email_contact_permission", "CASE event_id % 6 WHEN 0 THEN ' YES ' WHEN 1 THEN 'no' WHEN 2 THEN '1' WHEN 3 THEN 'False' WHEN 4 THEN 'maybe' ELSE NULL END"),
    ("has_phone_contact_permission", "CASE event_id % 5 WHEN 0 THEN 'true' WHEN 1 THEN '0' WHEN 2 THEN '' WHEN 3 THEN 'No ' ELSE NULL END"),
    ("hotel_price", "CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'free' WHEN 2 THEN '1.234,56' WHEN 3 THEN 'USD 12,50' WHEN 4 THEN '-7.25 EUR' ELSE CAST(event_id % 500 AS STRING) || '.5' END"),
    ("hotel_id", "CASE WHEN event_id % 10 = 7 THEN 'H-1' ELSE CAST(event_id % 200 AS STRING) END"),
    ("currency", "CASE event_id % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' ELSE 'TRY' END"),
    ("country", "CASE user_id % 4 WHEN 0 THEN 'DE' WHEN 1 THEN 'TR' WHEN 2 THEN 'US' ELSE NULL END"),
    ("utm_source", "CASE event_id % 2 WHEN 0 THEN 'search' ELSE 'email' END"),
    ("search_query", "props"),
    ("num_guests", "CAST(event_id % 6 AS STRING)"),
    ("destination_id", "CAST(event_id % 90 AS STRING)"),
    ("hotel_name", "'Hotel ' || CAST(event_id % 200 AS STRING)"),
    ("hotel_rating", "CASE WHEN event_id % 8 = 0 THEN 'unrated' ELSE CAST(event_id % 5 AS STRING) || '.5' END"),
    ("selected_room_id", "CAST(event_id % 40 AS STRING)"),
    ("nights", "CAST(event_id % 14 AS STRING)"),
    ("price_per_night", "CASE WHEN event_id % 12 = 0 THEN 'x' ELSE CAST(event_id % 300 AS STRING) || '.25' END"),
    ("payment_status", "CASE event_id % 3 WHEN 0 THEN 'paid' WHEN 1 THEN 'failed' ELSE NULL END"),
    ("confirmation_number", "CASE WHEN event_id % 3 = 0 THEN 'C' || CAST(event_id AS STRING) ELSE NULL END"),
]
SPARK_NANOS = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) * 1000 + 789"
DUCKDB_NANOS = "epoch_us(ts) * 1000 + 789"

# Deliveries (FIXTURES.md §3.2): which events, day shift, lane, load time,
# changed column.
FIRST_LOAD = datetime(2024, 2, 1, tzinfo=timezone.utc)
SECOND_LOAD = datetime(2024, 2, 2, tzinfo=timezone.utc)
DELIVERY_A = "a"  # every event, first load
DELIVERY_B = "b"  # event_id % 5 = 0, redelivered
DELIVERY_C = "c"  # event_id % 50 = 3, page_name checkout
DELIVERY_D = "d"  # event_id % 11 = 0, redrop lane
DELIVERIES = (DELIVERY_A, DELIVERY_B, DELIVERY_C, DELIVERY_D)
# event_id % 97 = 5, in turn (event_id % 5): no time, no request id, text too
# long, price too large, a file without a day
DELIVERY_E = "e"
ALL_DELIVERIES = (*DELIVERIES, DELIVERY_E)
LANDING_PREFIX = "landing/"

# The three-day range, the cursor and the early landed cut-off used by queries.
RANGE_START = "2024-01-10"
RANGE_END = "2024-01-12"
CURSOR = "2024-01-15T00:00:00Z"
LANDED_UNTIL = "2024-01-15"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _instant_sql(ts: datetime) -> str:
    return f"timestamp_micros({int(ts.timestamp()) * 1_000_000})"


def ota_raw(
    spark: SparkSession,
    sf_dir: str,
    deliveries: tuple[str, ...] = DELIVERIES,
    with_delivery: bool = False,
) -> DataFrame:
    """Raw event rows of the chosen deliveries.

    Columns: the 27 raw columns (``timestamp`` as epoch nanoseconds), then
    ``source_file`` (the landed file path) and ``ingested_at`` (the load
    time of that delivery); ``delivery`` too when ``with_delivery``.
    """
    ev = events(spark, sf_dir)
    base = ev.selectExpr(
        *[f"{SPARK_NANOS if expr is None else expr} AS `{name}`" for name, expr in BASE_EXPRESSIONS],
        "event_id AS _event_id",
        "CAST(ts AS DATE) AS _day",
    )
    wanted = ", ".join(f"'{d}'" for d in deliveries)
    fanned = base.selectExpr("*", f"explode(array({wanted})) AS delivery")
    belongs = (
        f"CASE delivery WHEN '{DELIVERY_A}' THEN TRUE WHEN '{DELIVERY_B}' THEN _event_id % 5 = 0 "
        f"WHEN '{DELIVERY_C}' THEN _event_id % 50 = 3 WHEN '{DELIVERY_D}' THEN _event_id % 11 = 0 "
        f"WHEN '{DELIVERY_E}' THEN _event_id % 97 = 5 ELSE FALSE END"
    )
    source_day = f"CASE WHEN delivery = '{DELIVERY_B}' AND _event_id % 2 = 1 THEN date_add(_day, 1) ELSE _day END"
    lane = f"CASE delivery WHEN '{DELIVERY_D}' THEN 'redrop' WHEN '{DELIVERY_E}' THEN 'odd' ELSE 'daily' END"

    odd = f"delivery = '{DELIVERY_E}' AND _event_id % 5"
    changed = {
        "utm_source": f"CASE delivery WHEN '{DELIVERY_B}' THEN 'redelivered' WHEN '{DELIVERY_D}' THEN 'redrop' "
        "ELSE utm_source END",
        "timestamp": f"CASE WHEN {odd} = 0 THEN NULL ELSE `timestamp` END",
        "request_id": f"CASE WHEN {odd} = 1 THEN NULL WHEN delivery = '{DELIVERY_E}' "
        "THEN concat('odd', CAST(_event_id AS STRING)) ELSE request_id END",
        "currency": f"CASE WHEN {odd} = 2 THEN repeat(currency, 100) ELSE currency END",
        "hotel_price": f"CASE WHEN {odd} = 3 THEN '99999999999999.5' ELSE hotel_price END",
        "page_name": f"CASE WHEN delivery = '{DELIVERY_C}' THEN 'checkout' ELSE page_name END",
    }
    out = C.projection_sql(S.RAW_COLUMNS, changed)
    file_day = f"CASE WHEN delivery = '{DELIVERY_E}' AND _event_id % 5 = 4 THEN 'notes' ELSE date_format({source_day}, 'yyyyMMdd') END"
    out.append(f"concat('{LANDING_PREFIX}', {lane}, '/', {file_day}, '_{S.DEFAULT_SUFFIX}.parquet') AS source_file")
    out.append(
        f"CASE WHEN delivery = '{DELIVERY_B}' AND _event_id % 10 = 0 THEN {_instant_sql(SECOND_LOAD)} "
        f"ELSE {_instant_sql(FIRST_LOAD)} END AS ingested_at"
    )
    if with_delivery:
        out.append("delivery")
    return fanned.where(belongs).selectExpr(*out)


def bulk_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bulk file of the historic run: every base event once, no file yet."""
    return ota_raw(spark, sf_dir, deliveries=(DELIVERY_A,)).drop("source_file", "ingested_at")


# ---------------------------------------------------------------------------
# DuckDB text of the same fixture, for oracles.
# ---------------------------------------------------------------------------


def duckdb_base_sql() -> str:
    cols = ",\n    ".join(
        f"{DUCKDB_NANOS if expr is None else expr} AS \"{name}\"" for name, expr in BASE_EXPRESSIONS
    )
    return f"SELECT\n    {cols},\n    event_id AS _event_id,\n    CAST(ts AS DATE) AS _day\n  FROM events"


def duckdb_raw_sql(deliveries: tuple[str, ...] = DELIVERIES) -> str:
    """SELECT of the raw fixture (same columns as ``ota_raw``) plus ``delivery``."""
    first = "TIMESTAMP '2024-02-01 00:00:00'"
    second = "TIMESTAMP '2024-02-02 00:00:00'"
    raw_cols = [c for c in S.RAW_COLUMNS]

    def part(name: str, where: str, day: str, lane: str, loaded: str, changes: dict[str, str]) -> str:
        cols = ", ".join(changes.get(c, f'"{c}"') + f' AS "{c}"' for c in raw_cols)
        file_expr = (
            f"'{LANDING_PREFIX}' || '{lane}' || '/' || replace(CAST({day} AS STRING), '-', '') "
            f"|| '_{S.DEFAULT_SUFFIX}.parquet'"
        )
        return (
            f"SELECT {cols}, {file_expr} AS source_file, {loaded} AS ingested_at, '{name}' AS delivery "
            f"FROM base WHERE {where}"
        )

    parts = {
        DELIVERY_A: part(DELIVERY_A, "TRUE", "_day", "daily", first, {}),
        DELIVERY_B: part(
            DELIVERY_B,
            "_event_id % 5 = 0",
            "(CASE WHEN _event_id % 2 = 0 THEN _day ELSE CAST(_day + INTERVAL 1 DAY AS DATE) END)",
            "daily",
            f"(CASE WHEN _event_id % 10 = 0 THEN {second} ELSE {first} END)",
            {"utm_source": "'redelivered'"},
        ),
        DELIVERY_C: part(DELIVERY_C, "_event_id % 50 = 3", "_day", "daily", first, {"page_name": "'checkout'"}),
        DELIVERY_D: part(DELIVERY_D, "_event_id % 11 = 0", "_day", "redrop", first, {"utm_source": "'redrop'"}),
        DELIVERY_E: part(
            DELIVERY_E,
            "_event_id % 97 = 5",
            "(CASE WHEN _event_id % 5 = 4 THEN 'notes' ELSE CAST(_day AS STRING) END)",
            "odd",
            first,
            {
                "timestamp": "(CASE WHEN _event_id % 5 <> 0 THEN \"timestamp\" END)",
                "request_id": "(CASE WHEN _event_id % 5 <> 1 THEN 'odd' || _event_id END)",
                "currency": "(CASE WHEN _event_id % 5 = 2 THEN repeat(currency, 100) ELSE currency END)",
                "hotel_price": "(CASE WHEN _event_id % 5 = 3 THEN '99999999999999.5' ELSE hotel_price END)",
            },
        ),
    }
    return "\n  UNION ALL\n  ".join(parts[d] for d in deliveries)

"""Registered queries: one per operator of the inventory, each with its oracle.

Every query reads ``events`` from the given scale-factor folder, derives
the ``ota_raw`` fixture from it and runs the operator over the whole of it;
every query has a DuckDB text in ``ORACLES`` computing the same rows.
Fixed parameters (range, cursor, load times) live in ``sources.fixture``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake import session as SESSION
from eventlake.functions import cleaning as C
from eventlake.operators import dedupe as D
from eventlake.operators import typed as TY
from eventlake.plans import oracle as O
from eventlake.sources import fixture as X

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None):
    """Queries run in a session of their own; the caller's keeps its settings."""

    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(SESSION.scoped(spark), sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return wrap


def _typed(spark: SparkSession, sf_dir: str, deliveries=X.ALL_DELIVERIES) -> DataFrame:
    return TY.fixture_typed(X.ota_raw(spark, sf_dir, deliveries))


def _raw_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All deliveries, tagged; subsets are filters on it."""
    return X.ota_raw(spark, sf_dir, X.ALL_DELIVERIES, with_delivery=True)


def _subset(raw_all: DataFrame, *deliveries: str) -> DataFrame:
    return raw_all.where(F.col("delivery").isin(list(deliveries)))


# --- P1..P13: cleaning rules ------------------------------------------------


@register("safe_cast_int", O.rule_query(S.BIGINT_COLUMNS))
def safe_cast_int(spark, sf_dir):
    """Seven loose columns -> bigint (whole numbers only, else NULL)."""
    raw = X.ota_raw(spark, sf_dir, X.ALL_DELIVERIES)
    types = {f.name: f.dataType for f in raw.schema.fields}
    return raw.select(
        *[F.col(c).alias(f"{c}_raw") for c in S.BIGINT_COLUMNS],
        *[C.safe_bigint(c, types[c]).alias(c) for c in S.BIGINT_COLUMNS],
    )


@register("safe_cast_float", O.rule_query(S.DOUBLE_COLUMNS))
def safe_cast_float(spark, sf_dir):
    """Two loose columns -> double."""
    raw = X.ota_raw(spark, sf_dir, X.ALL_DELIVERIES)
    types = {f.name: f.dataType for f in raw.schema.fields}
    return raw.select(
        *[F.col(c).alias(f"{c}_raw") for c in S.DOUBLE_COLUMNS],
        *[C.safe_double(c, types[c]).alias(c) for c in S.DOUBLE_COLUMNS],
    )


@register(
    "nanos_to_timestamp",
    O.prelude()
    + f'SELECT "timestamp" AS timestamp_raw, {O.typed_rules()["timestamp"]} AS "timestamp", '
    f'{O.typed_rules()["event_date"]} AS event_date FROM raw',
)
def nanos_to_timestamp(spark, sf_dir):
    """Epoch nanoseconds -> timestamp (micro precision) and its UTC day."""
    raw = X.ota_raw(spark, sf_dir, X.ALL_DELIVERIES)
    micros = C.micros_of("timestamp", raw.schema["timestamp"].dataType)
    return raw.select(
        F.col("timestamp").alias("timestamp_raw"),
        F.timestamp_micros(micros).alias("timestamp"),
        C.utc_date(micros).alias("event_date"),
    )


@register("permission_flags", O.rule_query(S.FLAG_COLUMNS))
def permission_flags(spark, sf_dir):
    """yes/no text -> boolean."""
    raw = X.ota_raw(spark, sf_dir, X.ALL_DELIVERIES)
    return raw.select(
        *[F.col(c).alias(f"{c}_raw") for c in S.FLAG_COLUMNS],
        *[C.yes_no(c).alias(c) for c in S.FLAG_COLUMNS],
    )


@register(
    "price_parse",
    O.prelude() + f'SELECT "hotel_price" AS hotel_price_raw, {O.typed_rules()["hotel_price"]} AS hotel_price FROM raw',
)
def price_parse(spark, sf_dir):
    """Keep the price text, parse it into decimal(38,9)."""
    raw = X.ota_raw(spark, sf_dir, X.ALL_DELIVERIES)
    return raw.select(
        F.col("hotel_price").alias("hotel_price_raw"),
        C.price_decimal("hotel_price").alias("hotel_price"),
    )


@register(
    "source_day_from_name",
    O.prelude() + f'SELECT source_file, {O.typed_rules()["source_day"]} AS source_day FROM raw',
)
def source_day_from_name(spark, sf_dir):
    """File path and the day in its name."""
    raw = X.ota_raw(spark, sf_dir, X.ALL_DELIVERIES)
    return raw.select("source_file", C.day_of_file("source_file").alias("source_day"))


@register("typed_events", O.prelude() + "SELECT * FROM typed")
def typed_events(spark, sf_dir):
    """The full 27 -> 32 column typed projection."""
    return _typed(spark, sf_dir)


# --- D1, D2: deduplication ---------------------------------------------------


@register("dedupe_full", O.prelude() + "SELECT * FROM dedup")
def dedupe_full(spark, sf_dir):
    """Newest copy per event over the whole typed table."""
    return D.dedupe_full(_typed(spark, sf_dir))


@register(
    "dedupe_range",
    O.prelude(extra={"rng": f"SELECT * FROM typed WHERE {O.in_range('source_day', X.RANGE_START, X.RANGE_END)}"})
    + "SELECT * FROM (" + O.dedupe_sql("rng") + ")",
)
def dedupe_range(spark, sf_dir):
    """Newest copy per event among the rows of the source_day range."""
    return D.dedupe_range(_typed(spark, sf_dir), X.RANGE_START, X.RANGE_END)


_KEYS_JOIN = " AND ".join(f't."{c}" IS NOT DISTINCT FROM k."{c}"' for c in S.DEDUPE_KEY)


@register(
    "dedupe_keys",
    O.prelude(
        extra={
            "rng": f"SELECT * FROM typed WHERE {O.in_range('source_day', X.RANGE_START, X.RANGE_END)}",
            "touched": "SELECT t.* FROM typed t WHERE EXISTS (SELECT 1 FROM rng k WHERE " + _KEYS_JOIN + ")",
        }
    )
    + "SELECT * FROM (" + O.dedupe_sql("touched") + ")",
)
def dedupe_keys(spark, sf_dir):
    """D2 scope="keys": newest copy, over all copies, of every key touched by the range."""
    return D.dedupe_keys(_typed(spark, sf_dir), X.RANGE_START, X.RANGE_END)


# --- F1, F2, S2..S9: ranges and day files ------------------------------------

DAYS_START, DAYS_END = "2024-01-29", "2024-02-02"  # the last two days have no file
NAME_PICK = ["20240110_OTA.parquet", "20240111_OTA.parquet", "20240112_OTA.parquet"]
FILTER_START = "20240125"

_RAW27 = ", ".join(f'"{c}"' for c in S.RAW_COLUMNS)
_BASENAME = "regexp_extract(source_file, '([^/]+)/?$', 1)"
_DAY_SQL = O.typed_rules()["source_day"]
_SPLIT_KEY = "strftime(make_timestamp(\"timestamp\" // 1000), '%Y%m%d')"
_SPLIT_SQL = (
    f"SELECT {_RAW27}, {_SPLIT_KEY} AS day_key, {_SPLIT_KEY} || '_OTA.parquet' AS file_name "
    "FROM raw WHERE \"timestamp\" IS NOT NULL"
)


@register(
    "date_range_days",
    O.prelude(
        extra={
            "stats": f"SELECT {_DAY_SQL} AS day, count(DISTINCT source_file) AS n_files, count(*) AS n_rows FROM raw "
            f"WHERE COALESCE({_DAY_SQL} BETWEEN DATE '{DAYS_START}' AND DATE '{DAYS_END}', FALSE) GROUP BY 1",
            "days": f"SELECT CAST(d AS DATE) AS day FROM generate_series(DATE '{DAYS_START}', DATE '{DAYS_END}', "
            "INTERVAL 1 DAY) t(d)",
        }
    )
    + "SELECT days.day, strftime(days.day, '%Y%m%d') AS day_key, strftime(days.day, '%Y%m%d') || '_OTA.parquet' "
    "AS file_name, COALESCE(n_files, 0) AS n_files, COALESCE(n_rows, 0) AS n_rows, n_files IS NOT NULL AS has_data "
    "FROM days LEFT JOIN stats ON days.day = stats.day",
)
def date_range_days(spark, sf_dir):
    """The resolved range's days, each with the day files found for it."""
    from eventlake.functions import ranges as R
    from eventlake.sources import landing as L

    start, end = R.resolve_range(DAYS_START, DAYS_END)
    days = R.range_days(spark, start, end)
    raw = X.ota_raw(spark, sf_dir, X.ALL_DELIVERIES)
    stats = (
        raw.where(L.in_file_range("source_file", start, end))
        .groupBy(C.day_of_file("source_file").alias("day"))
        .agg(F.count_distinct("source_file").alias("n_files"), F.count("*").alias("n_rows"))
    )
    # stats: at most one row per day of the range, a size known on the driver
    joined = days.join(F.broadcast(stats), on="day", how="left")
    return joined.select(
        "day",
        "day_key",
        R.day_file_name(F.col("day_key")).alias("file_name"),
        F.coalesce("n_files", F.lit(0)).alias("n_files"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.col("n_files").isNotNull().alias("has_data"),
    )


@register("split_by_day", O.prelude((X.DELIVERY_A,)) + _SPLIT_SQL)
def split_by_day(spark, sf_dir):
    """Bulk rows with their UTC day and target day file."""
    from eventlake.sources import landing as L

    return L.split_plan(X.bulk_raw(spark, sf_dir))


@register(
    "split_summary",
    O.prelude((X.DELIVERY_A,), extra={"split": _SPLIT_SQL})
    + "SELECT count(*) AS num_files, array_to_string(list_slice(list_sort(list(file_name)), 1, 10), ',') "
    "AS files_sample, CAST(sum(n) AS BIGINT) AS num_rows FROM (SELECT file_name, count(*) AS n FROM split GROUP BY 1)",
)
def split_summary(spark, sf_dir):
    """S3/A4: number of day files, first ten names, rows."""
    from eventlake.sources import landing as L

    summary = L.split_summary(L.split_plan(X.bulk_raw(spark, sf_dir)))
    return summary.select("num_files", F.array_join("files_sample", ",").alias("files_sample"), "num_rows")


@register(
    "files_in_range",
    O.prelude()
    + f"SELECT {_RAW27}, source_file, {_DAY_SQL} AS source_day FROM raw "
    f"WHERE COALESCE({_DAY_SQL} BETWEEN DATE '{X.RANGE_START}' AND DATE '{X.RANGE_END}', FALSE)",
)
def files_in_range(spark, sf_dir):
    """Rows of the day files whose day lies in the range."""
    from eventlake.sources import landing as L

    raw = X.ota_raw(spark, sf_dir, X.ALL_DELIVERIES)
    return raw.where(L.in_file_range("source_file", X.RANGE_START, X.RANGE_END)).select(
        *S.RAW_COLUMNS, "source_file", C.day_of_file("source_file").alias("source_day")
    )


@register(
    "wildcard_scan",
    O.prelude() + f"SELECT {_RAW27}, source_file FROM raw WHERE ends_with({_BASENAME}, '_OTA.parquet')",
)
def wildcard_scan(spark, sf_dir):
    """Rows of every day file named *_OTA.parquet."""
    from eventlake.sources import landing as L

    raw = X.ota_raw(spark, sf_dir, X.ALL_DELIVERIES)
    return raw.where(L.has_suffix("source_file")).select(*S.RAW_COLUMNS, "source_file")


@register(
    "select_by_name",
    O.prelude()
    + f"SELECT DISTINCT source_file AS path, {_BASENAME} AS name FROM raw WHERE {_BASENAME} IN ("
    + ", ".join(f"'{n}'" for n in NAME_PICK)
    + ")",
)
def select_by_name(spark, sf_dir):
    """Day files by exact name (every wanted name is present)."""
    from eventlake.sources import landing as L

    return L.pick_files(L.listing_of(X.ota_raw(spark, sf_dir, X.ALL_DELIVERIES)), names=NAME_PICK)


_PAT = r"^(\d{8})_([A-Za-z0-9]+)\.parquet$"


@register(
    "select_by_range",
    O.prelude()
    + f"SELECT path, name, regexp_extract(name, '{_PAT}', 1) AS file_date, regexp_extract(name, '{_PAT}', 2) "
    f"AS file_suffix FROM (SELECT DISTINCT source_file AS path, {_BASENAME} AS name FROM raw) "
    f"WHERE regexp_matches(name, '{_PAT}') AND regexp_extract(name, '{_PAT}', 2) = 'OTA' "
    f"AND regexp_extract(name, '{_PAT}', 1) >= '{FILTER_START}'",
)
def select_by_range(spark, sf_dir):
    """Day files by anchored name pattern, suffix and first day."""
    from eventlake.sources import landing as L

    return L.select_by_filters(L.listing_of(X.ota_raw(spark, sf_dir, X.ALL_DELIVERIES)), date_start=FILTER_START, suffix="OTA")


@register(
    "land_new_days",
    O.prelude(
        extra={
            "cand": f"SELECT DISTINCT source_file AS path, {_BASENAME} AS name FROM raw WHERE delivery = 'b'",
            "landed": f"SELECT DISTINCT {_BASENAME} AS name FROM raw WHERE delivery = 'a' "
            f"AND {_DAY_SQL} <= DATE '{X.LANDED_UNTIL}'",
        }
    )
    + "SELECT c.name, c.path, CASE WHEN l.name IS NOT NULL THEN 'skipped' ELSE 'uploaded' END AS action "
    "FROM cand c LEFT JOIN landed l ON c.name = l.name",
)
def land_new_days(spark, sf_dir):
    """Days of the second delivery, landed unless already there."""
    from eventlake.sources import landing as L

    raw = _raw_all(spark, sf_dir)
    candidates = L.listing_of(_subset(raw, X.DELIVERY_B))
    first = _subset(raw, X.DELIVERY_A)
    landed = L.listing_of(first.where(C.day_of_file("source_file") <= F.lit(X.LANDED_UNTIL).cast("date")))
    return L.landing_plan(candidates, landed, skip_if_exists=True)


# --- S12..S16: tables ---------------------------------------------------------

_RNG = O.in_range("source_day", X.RANGE_START, X.RANGE_END)


def _typed_of(*deliveries: str) -> str:
    names = ", ".join(f"'{d}'" for d in deliveries)
    return O.typed_select(f"(SELECT * FROM raw WHERE delivery IN ({names}))")


@register(
    "append_typed",
    O.prelude(extra={"ta": _typed_of("a"), "tb": _typed_of("b")}) + "SELECT * FROM ta UNION ALL SELECT * FROM tb",
)
def append_typed(spark, sf_dir):
    """The typed table after appending the second delivery to the first."""
    from eventlake.operators import tables as TB

    raw = _raw_all(spark, sf_dir)
    return TB.append(TY.fixture_typed(_subset(raw, X.DELIVERY_A)), TY.fixture_typed(_subset(raw, X.DELIVERY_B)))


@register(
    "replace_range_typed",
    O.prelude(extra={"ta": _typed_of("a"), "tbd": _typed_of("b", "d")})
    + f"SELECT * FROM ta WHERE NOT {_RNG} UNION ALL SELECT * FROM tbd WHERE {_RNG}",
)
def replace_range_typed(spark, sf_dir):
    """Typed table (first delivery) after replacing the range with later deliveries."""
    from eventlake.operators import tables as TB

    raw = _raw_all(spark, sf_dir)
    target = TY.fixture_typed(_subset(raw, X.DELIVERY_A))
    batch = TY.fixture_typed(_subset(raw, X.DELIVERY_B, X.DELIVERY_D))
    return TB.replace_range(target, batch, X.RANGE_START, X.RANGE_END)


@register(
    "replace_range_deduped",
    O.prelude(extra={"rng": f"SELECT * FROM typed WHERE {_RNG}", "drng": O.dedupe_sql("rng")})
    + f"SELECT * FROM dedup WHERE NOT {_RNG} UNION ALL SELECT * FROM drng WHERE {_RNG}",
)
def replace_range_deduped(spark, sf_dir):
    """Deduplicated table after replacing the range with the range's dedupe."""
    from eventlake.operators import tables as TB

    typed = _typed(spark, sf_dir)
    return TB.replace_range(D.dedupe_full(typed), D.dedupe_range(typed, X.RANGE_START, X.RANGE_END),
                            X.RANGE_START, X.RANGE_END)


SQL_DIR = __import__("pathlib").Path(__file__).resolve().parents[1] / "sql"


@register(
    "sql_to_table",
    O.prelude(extra={"rng": f"SELECT * FROM typed WHERE {_RNG}"}) + "SELECT * FROM (" + O.dedupe_sql("rng") + ")",
)
def sql_to_table(spark, sf_dir):
    """A parameterized SQL file (range dedupe) into a table, read back."""
    from datetime import date

    from eventlake.operators import tables as TB

    name = f"newest_in_range_{uuid.uuid4().hex}"
    location = f"{SESSION.staging_root(spark)}/{name}"
    TB.run_sql(
        spark,
        "newest_in_range.sql",
        args={"start_date": date.fromisoformat(X.RANGE_START), "end_date": date.fromisoformat(X.RANGE_END)},
        base_dir=str(SQL_DIR),
        destination=name,
        location=location,
        typed=_typed(spark, sf_dir),
    )
    spark.sql(f"DROP TABLE {name}")  # the catalog's entry; the rows stay at their location
    return TB.in_table_order(spark.read.parquet(location))


# --- P17..P20, U1..U6: serving -------------------------------------------------

CHUNK = 2_000
PARAM_TS = "2024-01-20T06:30:00+02:00"
STORED_UNTIL = "2024-01-15"


@register("serving_projection", O.prelude() + O.serving_select(f"(SELECT * FROM dedup WHERE {O.reject_reason_sql()} IS NULL)"))
def serving_projection(spark, sf_dir):
    """Deduplicated rows in serving types (naive UTC, decimal(18,6))."""
    from eventlake.operators import serve as SV

    return SV.serving_projection(D.dedupe_full(_typed(spark, sf_dir)))


@register(
    "serving_rejects",
    O.prelude() + f"SELECT * FROM (SELECT *, {O.reject_reason_sql()} AS reject_reason FROM dedup) "
    "WHERE reject_reason IS NOT NULL",
)
def serving_rejects(spark, sf_dir):
    """Deduplicated rows the serving table would refuse, with the reason."""
    from eventlake.operators import serve as SV

    return SV.serving_rejects(D.dedupe_full(_typed(spark, sf_dir)))


@register(
    "cursor_start",
    O.prelude(extra={"st": f"SELECT max(\"timestamp\") AS s FROM dedup WHERE source_day <= DATE '{STORED_UNTIL}'"})
    + "SELECT 'param' AS scenario, TIMESTAMP '2024-01-20 04:30:00' AS cursor_ts, FALSE AS inclusive, "
    "'param' AS source UNION ALL "
    f"SELECT 'backfill', TIMESTAMP '{X.RANGE_START} 00:00:00', TRUE, 'override' UNION ALL "
    "SELECT 'stored', COALESCE(s, TIMESTAMP '1970-01-01 00:00:00'), FALSE, "
    "CASE WHEN s IS NULL THEN 'epoch' ELSE 'state' END FROM st UNION ALL "
    "SELECT 'first_run', TIMESTAMP '1970-01-01 00:00:00', FALSE, 'epoch'",
)
def cursor_start(spark, sf_dir):
    """Where a load starts, for four runs: run parameter, backfill
    from a start date, stored cursor (the max timestamp of an earlier load),
    and a first run with nothing stored."""
    from eventlake.operators import serve as SV

    # an earlier load stores its cursor; the next one reads it back
    state = f"{SESSION.staging_root(spark)}/cursor-{uuid.uuid4().hex}"
    loaded = D.dedupe_full(_typed(spark, sf_dir)).where(F.col("source_day") <= F.lit(STORED_UNTIL).cast("date"))
    newest = loaded.agg(F.max(F.unix_micros("timestamp"))).first()[0]
    if newest is not None:
        SV.write_cursor(spark, state, SV.EPOCH + timedelta(microseconds=newest))
    starts = [
        ("param", SV.cursor_start(param=PARAM_TS, override=X.RANGE_START, stored=SV.read_cursor(spark, state))),
        ("backfill", SV.cursor_start(override=X.RANGE_START, stored=SV.read_cursor(spark, state))),
        ("stored", SV.cursor_start(stored=SV.read_cursor(spark, state))),
        ("first_run", SV.cursor_start(stored=SV.read_cursor(spark, f"{state}-none"))),
    ]
    rows = [(n, (c.ts - SV.EPOCH) // timedelta(microseconds=1), c.inclusive, c.source) for n, c in starts]
    out = spark.createDataFrame(rows, "scenario string, us bigint, inclusive boolean, source string")
    return out.select("scenario", F.timestamp_micros("us").alias("cursor_ts"), "inclusive", "source")


def _cursor():
    from eventlake.operators import serve as SV

    return SV.cursor_start(param=X.CURSOR)


_AFTER = "\"timestamp\" > TIMESTAMP '2024-01-15 00:00:00'"


@register("cursor_slice", O.prelude() + f"SELECT * FROM dedup WHERE \"timestamp\" IS NOT NULL AND {_AFTER}")
def cursor_slice(spark, sf_dir):
    """Deduplicated rows after the cursor (strict), no cap."""
    from eventlake.operators import serve as SV

    return SV.after_cursor(D.dedupe_full(_typed(spark, sf_dir)), _cursor())


@register(
    "cursor_chunk",
    O.prelude(extra={"sl": f"SELECT * FROM dedup WHERE {_AFTER}"})
    + f"SELECT * FROM sl WHERE \"timestamp\" <= (SELECT max(\"timestamp\") FROM "
    f"(SELECT \"timestamp\" FROM sl ORDER BY \"timestamp\" LIMIT {CHUNK}))",
)
def cursor_chunk(spark, sf_dir):
    """A1: one capped chunk after the cursor, ending on a whole timestamp."""
    from eventlake.operators import serve as SV

    return SV.first_chunk(D.dedupe_full(_typed(spark, sf_dir)), _cursor(), CHUNK)


@register(
    "cursor_advance",
    O.prelude() + f"SELECT count(*) AS rows_loaded, max(\"timestamp\") AS new_cursor FROM dedup WHERE {_AFTER}",
)
def cursor_advance(spark, sf_dir):
    """U4/A3: rows loaded after the cursor and the cursor they move it to."""
    from eventlake.operators import serve as SV

    return SV.advance(SV.after_cursor(D.dedupe_full(_typed(spark, sf_dir)), _cursor()))


def _upsert_sql(old: str, new: str) -> str:
    order = ", ".join(f'"{c}" DESC NULLS LAST' for c in S.SERVING_ORDER)
    key = ", ".join(f'"{c}"' for c in S.SERVING_KEY)
    return (
        f"SELECT * EXCLUDE (_p, _rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY _p DESC, "
        f"{order}) AS _rn FROM (SELECT *, 0 AS _p FROM {old} UNION ALL SELECT *, 1 AS _p FROM {new})) WHERE _rn = 1"
    )


@register(
    "upsert_latest",
    O.prelude(
        extra={
            "ta": _typed_of("a"),
            "da": O.dedupe_sql("ta"),
            "old": O.serving_select("da"),
            "new": O.serving_select(f"(SELECT * FROM dedup WHERE {O.reject_reason_sql()} IS NULL)"),
        }
    )
    + _upsert_sql("old", "new"),
)
def upsert_latest(spark, sf_dir):
    """Serving table of the first delivery after upserting the whole dedupe."""
    from eventlake.operators import serve as SV

    raw = _raw_all(spark, sf_dir)
    old = SV.serving_projection(D.dedupe_full(TY.fixture_typed(_subset(raw, X.DELIVERY_A))))
    new = SV.serving_projection(D.dedupe_full(TY.fixture_typed(raw)))
    return SV.upsert(old, new)


# --- F1 -> U1: the recent run as one plan -------------------------------------------

_REJ = O.reject_reason_sql()


@register(
    "recent_run",
    O.prelude(
        extra={
            "ta": _typed_of("a"),
            "da": O.dedupe_sql("ta"),
            "sa": O.serving_select(f"(SELECT * FROM da WHERE {_REJ} IS NULL)"),
            "typed_after": f"SELECT * FROM ta WHERE NOT {_RNG} UNION ALL SELECT * FROM typed WHERE {_RNG}",
            "trng": f"SELECT * FROM typed_after WHERE {_RNG}",
            "drng": O.dedupe_sql("trng"),
            "deduped_after": f"SELECT * FROM da WHERE NOT {_RNG} UNION ALL SELECT * FROM drng WHERE {_RNG}",
            "sl": f"SELECT * FROM deduped_after WHERE \"timestamp\" >= TIMESTAMP '{X.RANGE_START} 00:00:00' "
            f"AND {_REJ} IS NULL",
            "sn": O.serving_select("sl"),
        }
    )
    + _upsert_sql("sa", "sn"),
)
def recent_run(spark, sf_dir):
    """F1 -> S4 -> S13 -> D2 -> S14 -> U6 -> U1: a recent run over the range,
    started from the state the first delivery left, backfilling from the
    range's start date; returns the serving table afterwards."""
    from eventlake.functions import ranges as R
    from eventlake.operators import serve as SV
    from eventlake.plans import runs as RUNS
    from eventlake.sources import landing as L

    start, end = R.resolve_range(X.RANGE_START, X.RANGE_END)
    raw = _raw_all(spark, sf_dir)
    first = TY.fixture_typed(_subset(raw, X.DELIVERY_A))
    deduped = D.dedupe_full(first)
    batch = TY.fixture_typed(raw.where(L.in_file_range("source_file", start, end)))
    cursor = SV.cursor_start(override=start)
    return RUNS.recent_plan(first, deduped, SV.serving_projection(deduped), batch, start, end, cursor)


from eventlake.plans import storage_queries  # noqa: E402, F401  registers its queries here

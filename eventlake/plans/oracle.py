"""DuckDB SQL text of every registered query, used as the correctness oracle.

Each text is self-contained over the pre-registered ``events`` view: a
chain of CTEs (the fixture, the typed projection, deduplication, ...)
followed by the query's final SELECT. Rules that differ between the two
engines carry a guard here so that DuckDB computes the Spark-side decision:
integer text must be whole numbers, floating text must be plain numbers.
"""

from __future__ import annotations

from eventlake.sources import fixture as X


def q(name: str) -> str:
    return f'"{name}"'


# The rules and lists are written out here once more, apart from the ones that
# the Spark side uses, so that a mistake in either shows.
BIGINTS = "user_id subscriber_id hotel_id num_guests destination_id selected_room_id nights".split()
DOUBLES = "hotel_rating price_per_night".split()
FLAGS = "has_email_contact_permission has_phone_contact_permission".split()
TYPED = (
    "request_id funnel_id session_id user_id user_agent device_type ip_address timestamp event_date page_name subscriber_id "
    "has_email_contact_permission has_phone_contact_permission hotel_price_raw hotel_price hotel_id currency country utm_source "
    "search_query num_guests destination_id hotel_name hotel_rating selected_room_id nights price_per_night payment_status "
    "confirmation_number source_day source_file ingested_at"
).split()
EVENT_KEY = "request_id funnel_id session_id page_name timestamp".split()
EVENT_ORDER = "ingested_at source_day source_file".split()


def typed_rules() -> dict[str, str]:
    """Typed column -> DuckDB expression over the raw columns."""
    rules = {}
    for c in BIGINTS:
        rules[c] = f"CASE WHEN regexp_full_match(trim({q(c)}), '[-+]?[0-9]+') THEN TRY_CAST({q(c)} AS BIGINT) END"
    for c in DOUBLES:
        number = "[-+]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][-+]?[0-9]+)?"
        rules[c] = f"CASE WHEN regexp_full_match(trim({q(c)}), '{number}') THEN TRY_CAST({q(c)} AS DOUBLE) END"
    for c in FLAGS:
        v = f"lower(trim({q(c)}))"
        rules[c] = f"CASE {v} WHEN 'yes' THEN TRUE WHEN 'true' THEN TRUE WHEN '1' THEN TRUE WHEN 'no' THEN FALSE WHEN 'false' THEN FALSE WHEN '0' THEN FALSE END"
    ts = 'make_timestamp("timestamp" // 1000)'
    rules["timestamp"] = ts
    rules["event_date"] = f"CAST({ts} AS DATE)"
    rules["hotel_price_raw"] = '"hotel_price"'
    rules["hotel_price"] = "TRY_CAST(replace(regexp_replace(\"hotel_price\", '[^-0-9.,]', '', 'g'), ',', '.') AS DECIMAL(38,9))"
    rules["source_day"] = "CAST(strptime(nullif(regexp_extract(source_file, '([0-9]{8})_OTA[.]parquet', 1), ''), '%Y%m%d') AS DATE)"
    rules["source_file"] = "source_file"
    rules["ingested_at"] = "ingested_at"
    return rules


def typed_select(src: str) -> str:
    """SELECT of the 32 typed columns over a raw CTE with source_file/ingested_at."""
    rules = typed_rules()
    cols = ",\n    ".join(f"{rules.get(c, q(c))} AS {q(c)}" for c in TYPED)
    return f"SELECT\n    {cols}\n  FROM {src}"


def rule_query(columns: list[str], raw_suffix: str = "_raw", extra: list[str] | None = None) -> str:
    """Raw value and typed value of some columns, over the whole raw fixture."""
    rules = typed_rules()
    cols = [f"{q(c)} AS {q(c + raw_suffix)}" for c in columns] + [f"{rules[c]} AS {q(c)}" for c in columns]
    cols += extra or []
    return prelude() + "SELECT " + ", ".join(cols) + " FROM raw"


def _newest(src: str, key: list[str], order: list[str], extra_first: str | None = None) -> str:
    part = ", ".join(q(c) for c in key)
    sort = ", ".join(f"{q(c)} DESC NULLS LAST" for c in order)
    if extra_first:
        sort = f"{extra_first}, {sort}"
    return (
        f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {sort}) AS _rn "
        f"FROM {src}) WHERE _rn = 1"
    )


def dedupe_sql(src: str) -> str:
    return _newest(src, EVENT_KEY, EVENT_ORDER)


def in_range(col: str, start: str, end: str) -> str:
    return f"COALESCE({q(col)} BETWEEN DATE '{start}' AND DATE '{end}', FALSE)"


def serving_select(src: str) -> str:
    """Serving types: naive UTC times, decimal(18,6)."""
    rules = {
        "timestamp": 'CAST("timestamp" AS TIMESTAMP)',
        "ingested_at": "CAST(ingested_at AS TIMESTAMP)",
        "hotel_price": "TRY_CAST(hotel_price AS DECIMAL(18,6))",
    }
    cols = ", ".join(f"{rules.get(c, q(c))} AS {q(c)}" for c in TYPED)
    return f"SELECT {cols} FROM {src}"


WIDTHS = {
    "request_id": 128, "funnel_id": 128, "session_id": 128, "device_type": 64, "ip_address": 64, "page_name": 255, "hotel_price_raw": 255,
    "currency": 16, "country": 64, "utm_source": 255, "hotel_name": 512, "payment_status": 64, "confirmation_number": 128,
}
TEXTS = "user_agent search_query source_file".split()


def reject_reason_sql() -> str:
    """First violated serving constraint of a typed row, NULL if none."""
    checks = [f"WHEN {q(c)} IS NULL THEN 'null {c}'" for c in ("request_id", "timestamp")]
    checks += ["WHEN hotel_price IS NOT NULL AND TRY_CAST(hotel_price AS DECIMAL(18,6)) IS NULL THEN 'hotel_price overflow'"]
    checks += [f"WHEN length({q(c)}) > {n} THEN '{c} too long'" for c, n in WIDTHS.items()]
    checks += [f"WHEN octet_length(CAST({q(c)} AS BLOB)) > 65535 THEN '{c} too long'" for c in TEXTS]
    return "CASE " + " ".join(checks) + " END"


def prelude(deliveries: tuple[str, ...] = X.ALL_DELIVERIES, extra: dict[str, str] | None = None) -> str:
    """WITH base, raw, typed[, dedup] ... for the given deliveries."""
    ctes = {
        "base": X.duckdb_base_sql(),
        "raw": X.duckdb_raw_sql(deliveries),
        "typed": typed_select("raw"),
        "dedup": dedupe_sql("typed"),
    }
    if extra:
        ctes.update(extra)
    body = ",\n".join(f"{name} AS (\n  {sql}\n)" for name, sql in ctes.items())
    return f"WITH {body}\n"

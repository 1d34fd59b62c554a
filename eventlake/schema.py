"""Column lists and types of the event tables.

Three shapes exist:

* the raw day file: 27 loosely typed columns plus the file it came from;
* the typed table (and the deduplicated table, which has the same shape):
  32 columns with fixed types;
* the serving table: the same 32 columns, narrower types, keyed on
  (request_id, timestamp).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Names, order and types must match the source tables exactly.
# ---------------------------------------------------------------------------

# Columns of a raw daily event file, in file order.
RAW_COLUMNS = [
    "request_id", "funnel_id", "session_id", "user_id", "user_agent",
    "device_type", "ip_address", "timestamp", "page_name", "subscriber_id",
    "has_email_contact_permission", "has_phone_contact_permission",
    "hotel_price", "hotel_id", "currency", "country", "utm_source",
    "search_query", "num_guests", "destination_id", "hotel_name",
    "hotel_rating", "selected_room_id", "nights", "price_per_night",
    "payment_status", "confirmation_number",
]

# Columns of the typed and deduplicated tables, in table order.
TYPED_COLUMNS = [
    "request_id", "funnel_id", "session_id", "user_id", "user_agent",
    "device_type", "ip_address", "timestamp", "event_date", "page_name",
    "subscriber_id", "has_email_contact_permission",
    "has_phone_contact_permission", "hotel_price_raw", "hotel_price",
    "hotel_id", "currency", "country", "utm_source", "search_query",
    "num_guests", "destination_id", "hotel_name", "hotel_rating",
    "selected_room_id", "nights", "price_per_night", "payment_status",
    "confirmation_number", "source_day", "source_file", "ingested_at",
]

# Raw columns that are safely cast to a 64-bit integer.
BIGINT_COLUMNS = [
    "user_id", "subscriber_id", "hotel_id", "num_guests", "destination_id",
    "selected_room_id", "nights",
]

# Raw columns that are safely cast to a double.
DOUBLE_COLUMNS = ["hotel_rating", "price_per_night"]

# Yes/no text columns turned into booleans.
FLAG_COLUMNS = ["has_email_contact_permission", "has_phone_contact_permission"]

# Accepted spellings of the yes/no flags (compared after trimming and lowering).
FLAG_TRUE = ("yes", "true", "1")
FLAG_FALSE = ("no", "false", "0")

# Deduplication: one row per event key, newest delivery first.
DEDUPE_KEY = ["request_id", "funnel_id", "session_id", "page_name", "timestamp"]
DEDUPE_ORDER = ["ingested_at", "source_day", "source_file"]

# Serving table: primary key and the order that picks one row among rows
# sharing the key (all descending, nulls last).
SERVING_KEY = ["request_id", "timestamp"]
SERVING_ORDER = [
    "ingested_at", "source_day", "source_file", "page_name", "funnel_id",
    "session_id",
]

# Clustering of the typed and deduplicated tables inside a day partition.
CLUSTER_COLUMNS = ["event_date", "country", "page_name", "hotel_id", "funnel_id"]

# Day partition column of the typed and deduplicated tables.
DAY_PARTITION = "source_day"

# Default file suffix and the day files' name shape: YYYYMMDD_<SUFFIX>.parquet
DEFAULT_SUFFIX = "OTA"

# Decimal of the typed table and the narrower decimal of the serving table.
PRICE_TYPE = T.DecimalType(38, 9)
SERVING_PRICE_TYPE = T.DecimalType(18, 6)

# Serving table text limits in characters; TEXT columns are limited in bytes.
SERVING_VARCHAR = {
    "request_id": 128, "funnel_id": 128, "session_id": 128,
    "device_type": 64, "ip_address": 64, "page_name": 255,
    "hotel_price_raw": 255, "currency": 16, "country": 64,
    "utm_source": 255, "hotel_name": 512, "payment_status": 64,
    "confirmation_number": 128,
}
SERVING_TEXT_BYTES = {"user_agent": 65535, "search_query": 65535, "source_file": 65535}
SERVING_NOT_NULL = ["request_id", "timestamp"]

# ---------------------------------------------------------------------------

_TYPED_TYPES = {
    **{c: T.LongType() for c in BIGINT_COLUMNS},
    **{c: T.DoubleType() for c in DOUBLE_COLUMNS},
    **{c: T.BooleanType() for c in FLAG_COLUMNS},
    "timestamp": T.TimestampType(),
    "ingested_at": T.TimestampType(),
    "event_date": T.DateType(),
    "source_day": T.DateType(),
    "hotel_price": PRICE_TYPE,
}

TYPED_SCHEMA = T.StructType(
    [T.StructField(c, _TYPED_TYPES.get(c, T.StringType()), True) for c in TYPED_COLUMNS]
)

_SERVING_TYPES = {
    **_TYPED_TYPES,
    "timestamp": T.TimestampNTZType(),
    "ingested_at": T.TimestampNTZType(),
    "hotel_price": SERVING_PRICE_TYPE,
}

SERVING_SCHEMA = T.StructType(
    [
        T.StructField(c, _SERVING_TYPES.get(c, T.StringType()), c not in SERVING_NOT_NULL)
        for c in TYPED_COLUMNS
    ]
)


def ddl(schema: T.StructType) -> str:
    """Column list of a schema as SQL DDL text."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)

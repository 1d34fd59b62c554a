"""Registered queries of the storage mechanisms; see ``registry``.

They write to a folder of their own below the shared staging folder, read back
what they wrote, and return it. Files stay for the lazy result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake import session as SESSION
from eventlake.operators import dedupe as D
from eventlake.operators import typed as TY
from eventlake.plans import oracle as O
from eventlake.plans.registry import _raw_all, _RNG, _subset, _typed, _typed_of, register
from eventlake.sources import fixture as X


def _place(spark: SparkSession, label: str) -> str:
    return f"{SESSION.staging_root(spark)}/{label}-{uuid.uuid4().hex}"


# --- S10: clustering by four columns --------------------------------------------

_CURVE = ["country", "page_name", "hotel_id", "funnel_id"]
_BUCKET = 'CASE WHEN "{c}" IS NULL THEN 0 ELSE (rank() OVER (ORDER BY "{c}" NULLS LAST) - 1) * 16 // count("{c}") OVER () END'
_PLACE = " + ".join(f"((b{i} >> {b}) & 1) * {1 << (4 * b + 3 - i)}" for b in range(4) for i in range(4))


@register(
    "clustered_by_curve",
    O.prelude(extra={"bk": "SELECT *, " + ", ".join(f"CAST({_BUCKET.format(c=c)} AS INTEGER) AS b{i}" for i, c in enumerate(_CURVE)) + " FROM typed"})
    + f"SELECT * EXCLUDE (b0, b1, b2, b3), CAST({_PLACE} AS INTEGER) AS curve_place FROM bk",
)
def clustered_by_curve(spark, sf_dir):
    """Typed rows with their place on the curve through the four clustering
    columns, buckets of equal row counts."""
    from eventlake.operators import ordering as OR

    typed = _typed(spark, sf_dir)
    return OR.along(typed, OR.curve(typed))


# --- S13/S14: days replaced as one visible step ------------------------------------


@register(
    "replace_range_versioned",
    O.prelude(extra={"ta": _typed_of("a", "e"), "tbd": _typed_of("b", "d")})
    + f"SELECT * FROM ta WHERE NOT {_RNG} UNION ALL SELECT * FROM tbd WHERE {_RNG}",
)
def replace_range_versioned(spark, sf_dir):
    """A refresh and then a range replacement, each a version that one
    view statement makes visible; the rows the view shows."""
    from eventlake.operators import tables as TB
    from eventlake.operators import versions as VS

    raw = _raw_all(spark, sf_dir)
    name = f"days_{uuid.uuid4().hex}"
    VS.create(spark, name, _place(spark, "versions"))
    VS.refresh(TY.fixture_typed(_subset(raw, X.DELIVERY_A, X.DELIVERY_E)), name)
    VS.replace_days(TY.fixture_typed(_subset(raw, X.DELIVERY_B, X.DELIVERY_D)), name, X.RANGE_START, X.RANGE_END)
    shown = TB.kept(TB.in_table_order(spark.table(name)), "shown")
    spark.sql(f"DROP VIEW {name}")
    spark.sql(f"DROP TABLE {name}_files")  # the catalog's entries
    return shown


# --- U5: all chunks of a load ----------------------------------------------------

_CHUNK = 300
_AFTER = "\"timestamp\" > TIMESTAMP '2024-01-15 00:00:00'"


@register(
    "chunks_in_one_pass",
    O.prelude(extra={"sl": f"SELECT * FROM dedup WHERE {_AFTER}"}).replace("WITH base", "WITH RECURSIVE base", 1)
    + f""", m AS (SELECT "timestamp" AS t, sum(count(*)) OVER (ORDER BY "timestamp") AS upto FROM sl GROUP BY 1),
tot AS (SELECT max(upto) AS total FROM m),
ends AS (
  SELECT CAST(-1 AS BIGINT) AS chunk, CAST(0 AS HUGEINT) AS upto
  UNION ALL
  SELECT e.chunk + 1, CAST(min(m.upto) AS HUGEINT) FROM ends e, m, tot
  WHERE e.upto < total AND m.upto >= least(e.upto + {_CHUNK}, total) GROUP BY e.chunk),
spans AS (SELECT e.chunk, lag(e.upto) OVER (ORDER BY e.chunk) AS lo, e.upto AS hi, m.t AS new_cursor FROM ends e LEFT JOIN m ON m.upto = e.upto)
SELECT sl.*, spans.chunk, spans.new_cursor, CAST(hi - lo AS BIGINT) AS chunk_rows
FROM sl JOIN m ON m.t = sl."timestamp" JOIN spans ON m.upto > spans.lo AND m.upto <= spans.hi""",
)
def chunks_in_one_pass(spark, sf_dir):
    """Every deduplicated row after the cursor with the number of the chunk a
    load would fetch it in, that chunk's rows and the cursor it leaves."""
    from eventlake.operators import chunks as CH
    from eventlake.operators import serve as SV

    rows, ends = CH.in_chunks(D.dedupe_full(_typed(spark, sf_dir)), SV.cursor_start(param=X.CURSOR), _CHUNK)
    return rows.join(ends.withColumnRenamed("rows", "chunk_rows"), "chunk")


# --- U1: what an upsert does to each key -----------------------------------------


def _serving_of(*deliveries: str) -> dict[str, str]:
    return {"ta": _typed_of(*deliveries), "da": O.dedupe_sql("ta"), "old0": O.serving_select(f"(SELECT * FROM da WHERE {O.reject_reason_sql()} IS NULL)")}


_SKEY = ", ".join(f'"{c}"' for c in S.SERVING_KEY)
_SORDER = ", ".join(f'"{c}" DESC NULLS LAST' for c in S.SERVING_ORDER)
_ONE = "SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {o}) AS _rn FROM {t}) WHERE _rn = 1"
_DIFFERS = " OR ".join(f'o."{c}" IS DISTINCT FROM n."{c}"' for c in S.TYPED_COLUMNS if c not in S.SERVING_KEY)


@register(
    "upsert_changes",
    O.prelude(
        extra={
            **_serving_of("a", "e"),
            "old1": _ONE.format(k=_SKEY, o=_SORDER, t="old0"),
            "new0": O.serving_select(f"(SELECT * FROM dedup WHERE {O.reject_reason_sql()} IS NULL)"),
            "new1": _ONE.format(k=_SKEY, o=_SORDER, t="new0"),
        }
    )
    + f"SELECT n.*, CASE WHEN o.request_id IS NULL THEN 'inserted' WHEN {_DIFFERS} THEN 'changed' ELSE 'unchanged' END AS status "
    'FROM new1 n LEFT JOIN old1 o ON o.request_id = n.request_id AND o."timestamp" = n."timestamp"',
)
def upsert_changes(spark, sf_dir):
    """Every key that the whole dedupe upserts into the serving table of the first
    delivery, with what that does to it: inserted, changed or unchanged."""
    from eventlake.operators import serve as SV

    raw = _raw_all(spark, sf_dir)
    first = SV.serving_projection(D.dedupe_full(TY.fixture_typed(_subset(raw, X.DELIVERY_A, X.DELIVERY_E))))
    new = SV.serving_projection(D.dedupe_full(TY.fixture_typed(raw)))
    return SV.changes(SV.upsert(first.limit(0), first), new)


# --- D2 by day filters -----------------------------------------------------------

_KEYS_JOIN = " AND ".join(f't."{c}" IS NOT DISTINCT FROM k."{c}"' for c in S.DEDUPE_KEY)


@register(
    "dedupe_keys_by_filters",
    O.prelude(
        extra={
            "rng": f"SELECT * FROM typed WHERE {_RNG}",
            "touched": "SELECT t.* FROM typed t WHERE EXISTS (SELECT 1 FROM rng k WHERE " + _KEYS_JOIN + ")",
        }
    )
    + "SELECT * FROM (" + O.dedupe_sql("touched") + ")",
)
def dedupe_keys_by_filters(spark, sf_dir):
    """D2 scope="keys" on a stored table: only days whose filter may hold a touched
    request are read."""
    from eventlake.operators import day_filters as DF
    from eventlake.operators import tables as TB

    path = _place(spark, "typed")
    TB.write_append(_typed(spark, sf_dir), path)
    DF.build(spark, path)
    table = TB.read_table(spark, path)
    touched = table.where(D.in_day_range(S.DAY_PARTITION, X.RANGE_START, X.RANGE_END))
    found = D.touched_keys(table, X.RANGE_START, X.RANGE_END)
    if found is None:
        return table.limit(0)
    return D.winners_of(table.where(DF.may_hold(spark, path, touched)), found)


# --- D1 as a stream -----------------------------------------------------------------


@register("dedupe_stream", O.prelude() + "SELECT * FROM dedup")
def dedupe_stream(spark, sf_dir):
    """D1 kept up to date by a stateful stream over three deliveries: the late one
    first, the first load second, the rest last."""
    from eventlake.operators import tables as TB
    from eventlake.streaming import latest as LT

    raw, typed, live, state = _raw_all(spark, sf_dir), _place(spark, "typed"), _place(spark, "live"), _place(spark, "state")
    for some in ((X.DELIVERY_B,), (X.DELIVERY_A,), (X.DELIVERY_C, X.DELIVERY_D, X.DELIVERY_E)):
        TB.write_append(TY.fixture_typed(_subset(raw, *some)), typed)
        LT.keep_latest(spark, typed, live, state)
    return LT.read_live(spark, live)


# --- D1 and U1 on bucketed tables -------------------------------------------------

_BUCKETS = 8


@register("dedupe_bucketed", O.prelude() + "SELECT * FROM dedup")
def dedupe_bucketed(spark, sf_dir):
    """D1 over a table bucketed by request: no exchange."""
    from eventlake.operators import bucketed as B
    from eventlake.operators import tables as TB

    name = f"typed_{uuid.uuid4().hex}"
    B.write_bucketed(_typed(spark, sf_dir), name, _place(spark, "bucketed"), _BUCKETS)
    out = TB.kept(B.newest_in_buckets(spark, name), "newest")
    spark.sql(f"DROP TABLE {name}")
    return out


@register(
    "upsert_bucketed",
    O.prelude(
        extra={
            **_serving_of("a", "e"),
            "old1": _ONE.format(k=_SKEY, o=_SORDER, t="old0"),
            "new0": O.serving_select(f"(SELECT * FROM dedup WHERE {O.reject_reason_sql()} IS NULL)"),
            "new1": _ONE.format(k=_SKEY, o=_SORDER, t="new0"),
        }
    )
    + f"SELECT * FROM new1 UNION ALL SELECT * FROM old1 WHERE ({_SKEY}) NOT IN (SELECT ({_SKEY}) FROM new1)",
)
def upsert_bucketed(spark, sf_dir):
    """U1 over two tables bucketed by request: a merge without an exchange."""
    from eventlake.operators import bucketed as B
    from eventlake.operators import serve as SV
    from eventlake.operators import tables as TB

    raw = _raw_all(spark, sf_dir)
    old, new = f"old_{uuid.uuid4().hex}", f"new_{uuid.uuid4().hex}"
    for name, rows in ((old, _subset(raw, X.DELIVERY_A, X.DELIVERY_E)), (new, raw)):
        B.write_bucketed(SV.serving_projection(D.dedupe_full(TY.fixture_typed(rows))), name, _place(spark, "bucketed"), _BUCKETS, S.SERVING_KEY)
    out = TB.kept(B.upsert_in_buckets(spark, old, new), "upserted")
    for name in (old, new):
        spark.sql(f"DROP TABLE {name}")
    return out


# --- S4/W1 and S9 on day files --------------------------------------------------

_NAME = "regexp_extract(source_file, '([^/]+)/?$', 1)"
_RAW27 = ", ".join(f'"{c}"' for c in S.RAW_COLUMNS)


@register(
    "files_in_range_by_join",
    O.prelude()
    + f"SELECT {_RAW27}, {_NAME} AS day_file, {O.typed_rules()['source_day']} AS source_day FROM raw "
    f"WHERE COALESCE({O.typed_rules()['source_day']} BETWEEN DATE '{X.RANGE_START}' AND DATE '{X.RANGE_END}', FALSE)",
)
def files_in_range_by_join(spark, sf_dir):
    """Rows of the range's day files, written as entries and read through the
    catalog by a join with the days, which prunes the scan."""
    from eventlake.sources import landing as L

    folder, name = _place(spark, "landing"), f"landing_{uuid.uuid4().hex}"
    raw = X.ota_raw(spark, sf_dir, X.ALL_DELIVERIES)
    rows = raw.withColumn(L.DAY_FILE, L.entry_name("source_file")).select(*S.RAW_COLUMNS, L.DAY_FILE)
    L.write_entries(rows, folder)
    L.landing_table(spark, name, folder, rows.schema)
    from eventlake.operators import tables as TB

    out = TB.kept(L.range_of_table(spark, name, X.RANGE_START, X.RANGE_END), "in-range")
    spark.sql(f"DROP TABLE {name}")  # the catalog's entry
    return out


@register(
    "land_new_files",
    O.prelude(extra={"n": f"SELECT *, {_NAME} AS day_file FROM raw"})
    + f"SELECT {_RAW27}, day_file FROM n WHERE delivery = 'a' AND day_file LIKE '%\\_OTA.parquet' ESCAPE '\\' "
    f"UNION ALL SELECT {_RAW27}, day_file FROM n WHERE delivery = 'b' AND day_file LIKE '%\\_OTA.parquet' ESCAPE '\\' "
    "AND day_file NOT IN (SELECT day_file FROM n WHERE delivery = 'a')",
)
def land_new_files(spark, sf_dir):
    """The first delivery's day files landed by a stream, then those of the second
    that are not landed yet; rows of the landed entries."""
    from eventlake.sources import landing as L
    from eventlake.streaming import landing as SL

    raw, source, target, state = _raw_all(spark, sf_dir), _place(spark, "incoming"), _place(spark, "landing"), _place(spark, "state")
    for delivery in (X.DELIVERY_A, X.DELIVERY_B):
        rows = _subset(raw, delivery).withColumn(L.DAY_FILE, L.entry_name("source_file")).select(*S.RAW_COLUMNS, L.DAY_FILE)
        L.write_entries(rows, f"{source}/{delivery}")
        SL.land_new(spark, source, target, state, rows.drop(L.DAY_FILE).schema)
    return spark.read.parquet(target).select(*S.RAW_COLUMNS, L.DAY_FILE)


# --- S16: a script, statement by statement ------------------------------------------


@register(
    "script_recent_range",
    O.prelude(extra={"rng": f"SELECT * FROM typed WHERE {_RNG}", "ta": _typed_of("a", "e"), "da": O.dedupe_sql("ta")})
    + f"SELECT * FROM da WHERE NOT {_RNG} UNION ALL SELECT * FROM (" + O.dedupe_sql("rng") + ")",
)
def script_recent_range(spark, sf_dir):
    """The recent run as a script with a summary of each statement; the
    deduplicated table afterwards."""
    from datetime import date

    from eventlake.operators import tables as TB
    from eventlake.plans.registry import SQL_DIR

    raw = _raw_all(spark, sf_dir)
    first = TY.fixture_typed(_subset(raw, X.DELIVERY_A, X.DELIVERY_E))
    tag, folders = uuid.uuid4().hex, [_place(spark, n) for n in ("typed", "deduped")]
    names = [f"typed_{tag}", f"deduped_{tag}"]
    for name, folder, rows in zip(names, folders, (first, D.dedupe_full(first))):
        TB.write_append(rows, folder)
        TB.ensure_table(spark, name, folder)
        TB.sync_table(spark, name)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")  # this session is the query's own
    args = {"typed": names[0], "deduped": names[1], "start_date": date.fromisoformat(X.RANGE_START), "end_date": date.fromisoformat(X.RANGE_END)}
    TB.run_script(spark, "recent_range.sql", args, str(SQL_DIR), batch=TB.in_table_order(TY.fixture_typed(raw)).select(*_TABLE_ORDER))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    return TB.read_table(spark, folders[1])


#: A catalog table has its partition column last.
_TABLE_ORDER = [*[c for c in S.TYPED_COLUMNS if c != S.DAY_PARTITION], S.DAY_PARTITION]

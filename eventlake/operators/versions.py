"""Replacing days of a table as one visible step.

A dynamic partition overwrite swaps day folders one after another, and emptied
days are dropped after that: a reader in the middle sees some days old and some
new. Here a replacement is a *version*. Its files are written in full to a
folder of their own, registered as catalog partitions ``(version, source_day)``
that nothing reads yet, and one ``CREATE OR REPLACE VIEW`` makes them visible:
the view says which version holds which days. Emptied days need no step, a
day without files in its version has no rows.

A reader resolves the view's text when it plans, and the files it then reads
are never changed, so it sees the table before or after, never between. A run
lost before the last step leaves the old view; its files are replaced when the
range runs again, or removed by ``vacuum``. The view's predicate is on partition
columns, so a day filter reads only that day of the version that holds it.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake.functions import ranges as R
from eventlake.operators import tables as TB
from eventlake.operators.dedupe import in_day_range

VERSION = "version"
_LIVE = "eventlake.live"
#: Stands for rows without a day, which no range holds.
_OPEN = "null"


def _files(name: str) -> str:
    return f"{name}_files"


def _merged(spans: list[tuple[date, date, int]]) -> list[tuple[date, date, int]]:
    out: list[tuple[date, date, int]] = []
    for start, end, v in sorted(spans):
        if out and out[-1][2] == v and out[-1][1] + timedelta(days=1) == start:
            out[-1] = (out[-1][0], end, v)
        else:
            out.append((start, end, v))
    return out


def over(spans: list[tuple[date, date, int]], start: date, end: date, version: int) -> list[tuple[date, date, int]]:
    """``spans`` (first day, last day, version; apart from each other) after the
    days from ``start`` to ``end`` went to ``version``."""
    kept = []
    for a, b, v in spans:
        if a < start:
            kept.append((a, min(b, start - timedelta(days=1)), v))
        if b > end:
            kept.append((max(a, end + timedelta(days=1)), b, v))
    return _merged([*kept, (start, end, version)])


def _spans(spark: SparkSession, name: str) -> list[tuple[date, date, int]]:
    if not spark.catalog.tableExists(name):
        return []
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    told = next(r["value"] for r in rows if r["key"] == _LIVE)
    return [(date.fromisoformat(a), date.fromisoformat(b), v) for a, b, v in json.loads(told)]


def _predicate(spans: list[tuple[date, date, int]]) -> str:
    """Which rows are live, over the partition columns alone. Rows without a day
    are those of the first version, which only a refresh replaces."""
    parts = [f"({VERSION} = {v} AND {S.DAY_PARTITION} BETWEEN DATE'{a}' AND DATE'{b}')" for a, b, v in spans]
    return " OR ".join([*parts, f"({VERSION} = {min(v for _, _, v in spans)} AND {S.DAY_PARTITION} IS NULL)"])


def _show(spark: SparkSession, name: str, spans: list[tuple[date, date, int]]) -> None:
    """The visible step: which versions the view shows, and its predicate, in one
    statement."""
    told = json.dumps([(a.isoformat(), b.isoformat(), v) for a, b, v in spans]).replace("'", "")
    columns = ", ".join(f"`{c}`" for c in S.TYPED_COLUMNS)
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_LIVE}' = '{told}') AS SELECT {columns} FROM {_files(name)} WHERE {_predicate(spans)}")


def create(spark: SparkSession, name: str, location: str) -> None:
    """The files' table of ``name``, partitioned by version and day."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name.split('.')[0]}`")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in S.TYPED_SCHEMA.fields if f.name != S.DAY_PARTITION)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_files(name)} ({columns}, {VERSION} INT, {S.DAY_PARTITION} DATE) USING parquet "
        f"PARTITIONED BY ({VERSION}, {S.DAY_PARTITION}) LOCATION '{location}'"
    )


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {_files(name)}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location").rstrip("/")


def _versions(spark: SparkSession, name: str) -> list[int]:
    """Versions with a folder, complete or not."""
    fs, root = TB._fs(spark, _location(spark, name))
    names = [st.getPath().getName() for st in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{VERSION}="))


def replace_days(
    batch: DataFrame, name: str, start: date | str, end: date | str, rebalance: bool = True, step: Callable[[str], None] = lambda at: None,
) -> dict:
    """Replace the days from ``start`` to ``end`` by the batch's rows of
    them, in one visible step. ``step`` is told each step done (tests stop there).

    The batch may read the view it replaces. A range without rows is shown as
    empty."""
    spark = batch.sparkSession
    first, last = R.parse_day(start), R.parse_day(end)
    spans = _spans(spark, name)
    version = max([*_versions(spark, name), -1]) + 1
    rows = batch if not spans and start is None else batch.where(in_day_range(S.DAY_PARTITION, first, last))
    return _publish(rows, name, version, over(spans, first, last, version), rebalance, step)


def refresh(rows: DataFrame, name: str, rebalance: bool = True, step: Callable[[str], None] = lambda at: None) -> dict:
    """The whole table, rows without a day included, in one visible step."""
    version = max([*_versions(rows.sparkSession, name), -1]) + 1
    return _publish(rows, name, version, [(date.min, date.max, version)], rebalance, step)


def _publish(rows: DataFrame, name: str, version: int, spans, rebalance: bool, step) -> dict:
    spark = rows.sparkSession
    folder = f"{_location(spark, name)}/{VERSION}={version}"
    seen = Observation("version")
    observed = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(S.DAY_PARTITION).alias("days"))
    TB._clustered(observed, rebalance).write.partitionBy(S.DAY_PARTITION).parquet(folder)
    step("files")
    days = sorted(seen.get["days"])
    # partitions that no reader asks for yet, in one statement; a day's folder is found by its name
    parts = [f"PARTITION ({VERSION} = {version}, {S.DAY_PARTITION} = DATE'{d}')" for d in days]
    if TB._fs(spark, folder)[0].exists(TB._fs(spark, f"{folder}/{S.DAY_PARTITION}=__HIVE_DEFAULT_PARTITION__")[1]):
        parts.append(f"PARTITION ({VERSION} = {version}, {S.DAY_PARTITION} = {_OPEN})")
    if parts:
        spark.sql(f"ALTER TABLE {_files(name)} ADD IF NOT EXISTS {' '.join(parts)}")
    step("partitions")
    _show(spark, name, spans)
    step("view")
    return {"rows": seen.get["rows"], "days_written": days, "version": version}


def vacuum(spark: SparkSession, name: str) -> list[int]:
    """Remove versions that hold no live day: those replaced since, and those of
    runs that were lost. To be run when no reader of an older view is left."""
    live = {v for _, _, v in _spans(spark, name)}
    gone = [v for v in _versions(spark, name) if v not in live]
    known = [r[0] for r in spark.sql(f"SHOW PARTITIONS {_files(name)}").collect()]
    for v in gone:
        mine = [p for p in known if p.startswith(f"{VERSION}={v}/")]
        specs = []
        for p in mine:
            day = p.split("=")[-1]
            value = _OPEN if day.startswith("__HIVE") or day == "null" else f"DATE'{day}'"
            specs.append(f"PARTITION ({VERSION} = {v}, {S.DAY_PARTITION} = {value})")
        if specs:
            spark.sql(f"ALTER TABLE {_files(name)} DROP IF EXISTS {', '.join(specs)}")
        fs, folder = TB._fs(spark, f"{_location(spark, name)}/{VERSION}={v}")
        if fs.exists(folder):
            fs.delete(folder, True)
    return gone

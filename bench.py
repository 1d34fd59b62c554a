"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is planned and run to completion (``noop`` sink: every row is
computed, nothing is collected) once to warm up, then ``BENCH_REPEAT``
times; the median counts. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from datetime import datetime, timezone
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from eventlake import session  # noqa: E402
from eventlake.plans.registry import QUERIES  # noqa: E402

HEADLINE = [
    "typed_events",        # typed projection, 27 -> 32 columns
    "dedupe_full",         # newest copy per event, whole table
    "dedupe_range",        # newest copy per event, three-day range
    "dedupe_keys",         # newest copy of every key the range touches
    "replace_range_typed", # three-day range replace
    "cursor_slice",        # rows after the cursor
    "cursor_chunk",        # capped chunk after the cursor
    "upsert_latest",       # keyed upsert into the serving table
    "recent_run",          # the recent run end to end, as one plan
]


def sf_of(path: str) -> float | str:
    name = Path(path.rstrip("/")).name
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def storage_runs(spark, sf_dir: str, repeat: int) -> dict[str, float]:
    """The historic run and then the recent run on storage, in a fresh
    scratch folder per repetition: split the bulk file into day files, type
    and append, rebuild the deduplicated table, load the serving table; then
    replace three days and load again."""
    from eventlake.plans import runs as RUNS
    from eventlake.sources import fixture as X

    root = Path(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    bulk = root / "bulk.parquet"
    X.bulk_raw(spark, sf_dir).write.parquet(str(bulk))
    hist, recent = [], []
    for i in range(repeat):
        base = root / f"r{i}"
        lay = RUNS.Layout(
            landing=str(base / "landing"), typed=str(base / "typed"), deduped=str(base / "deduped"),
            serving=str(base / "serving"), cursor=str(base / "cursor"),
        )
        t0 = time.perf_counter()
        RUNS.historic(spark, lay, str(bulk), loaded_at=datetime(2024, 3, 1, tzinfo=timezone.utc))
        hist.append(time.perf_counter() - t0)
        t0 = time.perf_counter()
        RUNS.recent(spark, lay, X.RANGE_START, X.RANGE_END, loaded_at=datetime(2024, 3, 2, tzinfo=timezone.utc))
        recent.append(time.perf_counter() - t0)
    return {
        "storage_historic_run": round(statistics.median(hist), 3),
        "storage_recent_run": round(statistics.median(recent), 3),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = session.local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="bench")
    timings: dict[str, float] = {}
    for name in names:
        runs = []
        for i in range(repeat + 1):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 3)
    if not sys.argv[1:] and os.environ.get("BENCH_STORAGE", "1") == "1":
        timings.update(storage_runs(spark, sf_dir, max(repeat, 1)))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf_of(sf_dir),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()

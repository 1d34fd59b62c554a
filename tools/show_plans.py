"""Print the formatted physical plan of registered queries.

    python tools/show_plans.py [sf_dir] query [query ...]

With no query names, prints the plans of the headline queries. Use it to
check that filters reach the scan, that deduplication and the upsert keep
one shuffle with WindowGroupLimit on both sides of it, and that exchanges
of the shared fixture scan are reused.
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

HEADLINE = ["typed_events", "dedupe_full", "dedupe_range", "upsert_latest"]


def main(argv: list[str]) -> None:
    from eventlake import session
    from eventlake.plans.registry import QUERIES

    sf_dir = argv[1] if len(argv) > 1 and "/" in argv[1] else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if "/" not in a] or HEADLINE
    spark = session.local_session(8)
    for name in names:
        print(f"===== {name}")
        QUERIES[name](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)

"""Every registered query against its DuckDB oracle, and the fixture's known sizes."""

import pytest

from eventlake.plans.registry import ORACLES, QUERIES
from scales import SF_SMALL

import oracle_check


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert len(QUERIES) >= 29


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    ok, detail, _ = oracle_check.compare(spark, name, SF_SMALL)
    assert ok, detail


# FIXTURES.md §3.3 at sf0.001
@pytest.mark.parametrize(
    "name,rows",
    [
        ("typed_events", 1322),
        ("dedupe_full", 1031),
        ("dedupe_range", 132),
        ("cursor_slice", 520),
        ("upsert_latest", 1002),
    ],
)
def test_known_sizes(spark, name, rows):
    assert QUERIES[name](spark, SF_SMALL).count() == rows


def test_entry_runs(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() == 1031
    # what has no SQL is registered by the training-data operators alone
    assert not set(QUERIES) & (set(entry.queries()) - set(entry.oracle_sql()))
    assert set(entry.oracle_sql()) <= set(entry.queries())

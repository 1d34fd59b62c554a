"""Keep the newest copy of every event.

``ROW_NUMBER() OVER (PARTITION BY key ORDER BY ingested_at, source_day,
source_file, all DESC NULLS LAST) = 1``. Catalyst turns the ``= 1`` filter
into ``WindowGroupLimit`` Partial + Final: every map task already drops all
but its best copy per key before the shuffle, so a hot key ships at most one
row per input task, never all its copies.

Scopes:

* ``full``  -- the whole typed table (historic rebuild);
* ``range`` -- only rows of the ``source_day`` range (recent run); copies of
  an event outside the range are not seen, as in the original job;
* ``keys``  -- every event key that has a copy in the range, deduplicated
  over all its copies anywhere (repairs cross-day duplicates).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake import schema as S

RANK = "_rn"


def in_day_range(day: str | Column, start: date | str, end: date | str) -> Column:
    """``day BETWEEN start AND end`` with NULL counted as outside."""
    d = F.col(day) if isinstance(day, str) else day
    return F.coalesce(d.between(F.lit(start).cast("date"), F.lit(end).cast("date")), F.lit(False))


def newest_first(
    df: DataFrame,
    key: list[str] = S.DEDUPE_KEY,
    order: list[str] = S.DEDUPE_ORDER,
    tiebreak: bool = True,
) -> DataFrame:
    """One row per ``key``: the first by ``order`` (all descending, nulls last).

    With ``tiebreak`` a hash of the columns that can still differ ends the
    order, so rows that tie on ``order`` give the same winner on every run.
    """
    sort = [F.col(c).desc_nulls_last() for c in order]
    if tiebreak:
        rest = [c for c in df.columns if c not in key and c not in order]
        sort.append(F.xxhash64(*[F.col(c) for c in rest]).desc())
    w = Window.partitionBy(*[F.col(c) for c in key]).orderBy(*sort)
    return df.withColumn(RANK, F.row_number().over(w)).where(F.col(RANK) == 1).drop(RANK)


def dedupe_full(typed: DataFrame) -> DataFrame:
    return newest_first(typed)


def dedupe_range(typed: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Newest copy per event among rows whose ``source_day`` lies in the range.

    The range filter sits below the window (it is not on the window's
    partition key, so Catalyst would not move it there by itself) and reaches
    the scan as a partition filter when the table is partitioned by day.
    """
    return newest_first(typed.where(in_day_range(S.DAY_PARTITION, start, end)))


KEY_PREFIX = "_k_"


def key_match() -> list[Column]:
    """Null-safe equality of the dedupe key with its ``_k_`` aliased copy
    (NULL key parts match, as in PARTITION BY)."""
    return [F.col(c).eqNullSafe(F.col(f"{KEY_PREFIX}{c}")) for c in S.DEDUPE_KEY]


@dataclass(frozen=True)
class Touched:
    """Event keys (one row each, columns ``_k_*``) and the event-time span of
    all their copies: microseconds, and whether some have no timestamp."""

    keys: DataFrame
    lo: int | None
    hi: int | None
    nulls: bool

    def in_span(self) -> Column:
        ts = F.col("timestamp")
        inside = F.lit(False)
        if self.lo is not None:
            inside = ts.between(F.timestamp_micros(F.lit(self.lo)), F.timestamp_micros(F.lit(self.hi)))
        return inside | ts.isNull() if self.nulls else inside


def touched_keys(typed: DataFrame, start: date | str, end: date | str, also: DataFrame | None = None) -> Touched | None:
    """The keys with a copy in the range, or None when the range is empty.

    ``also`` adds the keys another table holds in the range: for a range
    just replaced in the typed table, the deduplicated table's rows of the
    range name the keys whose old winner may have been deleted.

    Every copy of a touched key has its timestamp in the span, since the key
    holds the timestamp; copies without one belong to keys without one. The
    bounds come from one small aggregate over the range (partition pruned), as
    numbers, so no time zone of the driver matters, and enter later plans
    as literals: full-table scans push them to Parquet and skip row groups by
    their ``timestamp`` statistics.
    """
    in_range = typed.where(in_day_range(S.DAY_PARTITION, start, end)).select(*S.DEDUPE_KEY)
    if also is not None:
        in_range = in_range.unionByName(also.where(in_day_range(S.DAY_PARTITION, start, end)).select(*S.DEDUPE_KEY))
    micros = F.unix_micros("timestamp")
    rows, dated, lo, hi = in_range.agg(F.count(F.lit(1)), F.count("timestamp"), F.min(micros), F.max(micros)).first()
    if not rows:
        return None
    keys = in_range.select(*[F.col(c).alias(f"{KEY_PREFIX}{c}") for c in S.DEDUPE_KEY]).distinct()
    return Touched(keys, lo, hi, dated < rows)


def winners_of(typed: DataFrame, touched: Touched) -> DataFrame:
    """Newest copy of every touched key over all its copies in ``typed``.

    The table is narrowed to the span and deduplicated (map-side
    pre-reduction, so a hot key ships one row per task); the winners are kept
    when their key is touched: a null-safe semi join between two sides that
    both hold one row per key.
    """
    return newest_first(typed.where(touched.in_span())).join(touched.keys, on=key_match(), how="left_semi")


def dedupe_keys(typed: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Newest copy of every event key that has at least one copy in the range."""
    touched = touched_keys(typed, start, end)
    return typed.where(F.lit(False)) if touched is None else winners_of(typed, touched)

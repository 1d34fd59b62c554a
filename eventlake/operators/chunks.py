"""All chunks of an incremental load in one pass.

A load takes ``size`` rows after its cursor by time, goes on to the end of the
last moment, stores that as its cursor and starts again. The boundaries form a
chain: where a chunk ends depends on where the one before did. The loop needs
one job a chunk; here every row gets its chunk number at once.

Rows are counted by moment, and moments get their place in the global order
(``ordering.running_counts``). A *wish* is the rank that the current chunk would
like to end at; the chunk ends with the moment that holds it, and the next wish
is ``size`` rows further. Moments are cut into blocks of ranks. What a block does
to a wish (the wish it hands on, and how many chunks end in it) is a small
table, since a wish enters a block in its first ``size`` ranks, and is computed
for all entries at once by doubling steps. Tables of neighbouring blocks are put
together until few rows are left; these are followed from the first wish, and
the answers go back down to the blocks. No task sorts or sees all moments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.operators import serve as SV
from eventlake.operators import tables as TB

#: Ranks of a block, in chunks; blocks put together at a time; rows that the
#: driver follows.
BLOCK_CHUNKS, TOGETHER, TOP_ROWS = 256, 64, 100_000

_MAP = "block bigint, lo bigint, hi bigint, wish bigint, ended bigint, last bigint"


def _steps(upto: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For a chunk that ends with moment i: the wish it hands on out of the block
    whose moments these are, and the chunks that end in the block from then on."""
    n, end = len(upto), upto[-1]
    wish = upto + size
    to = np.where(wish <= end, np.searchsorted(upto, wish), n)
    out, ended = np.r_[wish, 0], np.r_[np.ones(n, np.int64), 0]
    to = np.r_[to, n]
    while (to < n).any():
        ended = ended + ended[to]
        out = np.where(to < n, out[to], out)
        to = to[to]
    return out[:n], ended[:n]


def _block_map(size: int):
    """Rows (lo, hi]: a wish in there becomes ``wish`` and ends ``ended`` chunks;
    ``last`` is the last rank of the block."""

    def run(key, moments: pd.DataFrame) -> pd.DataFrame:
        m = moments.sort_values("before")
        before, upto = m["before"].to_numpy(), m["upto"].to_numpy()
        wish, ended = _steps(upto, size)
        entry = before < before[0] + size
        return pd.DataFrame({"block": key[0], "lo": before[entry], "hi": upto[entry], "wish": wish[entry], "ended": ended[entry], "last": upto[-1]})

    return run


def _follow(maps: list[pd.DataFrame], wish: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Wishes, and the chunks ended so far, before each of the neighbouring blocks
    and at the end."""
    ended = np.zeros(len(wish), np.int64)
    for m in maps:
        yield wish, ended
        hi, last = m["hi"].to_numpy(), int(m["last"].iloc[0])
        at = np.minimum(np.searchsorted(hi, wish), len(hi) - 1)
        inside = wish <= last  # else the block is passed by
        wish, ended = np.where(inside, m["wish"].to_numpy()[at], wish), ended + np.where(inside, m["ended"].to_numpy()[at], 0)
    yield wish, ended


def _parts(maps: pd.DataFrame) -> list[pd.DataFrame]:
    return [g.sort_values("lo") for _, g in maps.groupby("block")]


def _put_together(size: int):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        maps = _parts(rows)
        first = int(maps[0]["lo"].iloc[0])
        # all moments in which a wish may enter, be they of the first block or a later one
        entry = pd.concat(maps)
        entry = entry[entry["lo"] < first + size]
        for wish, ended in _follow(maps, entry["hi"].to_numpy()):
            pass
        return pd.DataFrame({"block": key[0], "lo": entry["lo"], "hi": entry["hi"], "wish": wish, "ended": ended, "last": int(maps[-1]["last"].iloc[0])})

    return run


_ENTRY = "block bigint, entry bigint, chunk bigint"


def _hand_down(key, rows: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
    """The entry of each block of a group whose own entry is known."""
    maps = _parts(rows)
    out = [(int(m["block"].iloc[0]), int(w[0]), int(entry["chunk"].iloc[0] + n[0])) for m, (w, n) in zip(maps, _follow(maps, entry["entry"].to_numpy()[:1]))]
    return pd.DataFrame(out, columns=["block", "entry", "chunk"])


def _number(size: int):
    def run(key, moments: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        m = moments.sort_values("before")
        upto, wish, ends = m["upto"].to_numpy(), int(entry["entry"].iloc[0]), []
        while wish <= upto[-1]:
            ends.append(int(np.searchsorted(upto, wish)))
            wish = int(upto[ends[-1]]) + size
        # a moment is of the chunk that ends with it or after it
        chunk = int(entry["chunk"].iloc[0]) + np.searchsorted(np.array(ends, np.int64), np.arange(len(m)))
        return pd.DataFrame({"us": m["us"].to_numpy(), "n": m["n"].to_numpy(), "chunk": chunk})

    return run


def moment_chunks(moments: DataFrame, size: int) -> DataFrame:
    """(us, n, chunk): the chunk, from 0 on, of every moment of (us, n)."""
    from eventlake.operators import ordering as OR

    spark = moments.sparkSession
    counted = OR.running_counts(moments, ["us"], "n").withColumn("block", F.expr(f"before div {size * BLOCK_CHUNKS}L"))
    counted = TB.kept(counted.select("us", "n", "before", "upto", "block"), "moments")
    levels = [TB.kept(counted.groupBy("block").applyInPandas(_block_map(size), _MAP), "wishes")]
    while levels[-1].count() > TOP_ROWS:
        group = levels[-1].withColumn("group", F.expr(f"block div {TOGETHER}L"))
        fewer = TB.kept(group.groupBy("group").applyInPandas(_put_together(size), _MAP), "wishes")
        if fewer.select("block").distinct().count() == 1:
            levels.append(fewer)
            break
        levels.append(fewer)
    # at most TOP_ROWS rows, or the one table of one block (``size`` rows)
    top = _parts(levels[-1].toPandas())
    first = [(int(m["block"].iloc[0]), int(w[0]), int(n[0])) for m, (w, n) in zip(top, _follow(top, np.array([size])))]
    entries = spark.createDataFrame(first, _ENTRY)
    for maps in reversed(levels[:-1]):
        grouped = maps.withColumn("group", F.expr(f"block div {TOGETHER}L"))
        entries = grouped.groupBy("group").cogroup(entries.groupBy("block")).applyInPandas(_hand_down, _ENTRY)
    return counted.groupBy("block").cogroup(entries.groupBy("block")).applyInPandas(_number(size), "us bigint, n bigint, chunk bigint")


def in_chunks(df: DataFrame, cursor: SV.Cursor, size: int) -> tuple[DataFrame, DataFrame]:
    """(rows after the cursor with their ``chunk``; a row a chunk with its
    number of rows and the cursor that it leaves). Chunks are those that
    ``serve.first_chunk`` would take one after another.

    The input is evaluated twice: for the counts, which are staged, and for the
    rows."""
    rows = SV.after_cursor(df, cursor)
    us = F.unix_micros("timestamp")
    counts = TB.kept(rows.groupBy(us.alias("us")).agg(F.count(F.lit(1)).alias("n")), "counts")
    if counts.isEmpty():
        none = rows.withColumn("chunk", F.lit(0).cast("long"))
        return none, rows.sparkSession.createDataFrame([], "chunk bigint, rows bigint, new_cursor timestamp")
    numbered = TB.kept(moment_chunks(counts, size), "chunks")
    ends = numbered.groupBy("chunk").agg(F.sum("n").alias("rows"), F.timestamp_micros(F.max("us")).alias("new_cursor"))
    # one row a moment; Spark splits a hot moment's rows among tasks
    out = rows.withColumn("_us", us).join(numbered.select(F.col("us").alias("_us"), "chunk"), "_us").drop("_us")
    return out, ends

"""Helpers shared by the training-data operators.

Intermediate results that are read more than once, or that cut a lineage,
are written as Parquet below ``spark.checkpoint.dir`` (the folder all
executors share) and read again; nothing is kept on one machine.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventlake.session import staging_root

#: ASCII white space, the separators of the word rule ``[^\x20\x09-\x0D]+``.
SPACE_CLASS = r"[\x20\x09-\x0D]"


_SHIPPED: set[str] = set()
_HELD: dict = {}


def held(key, build):
    """In a Python worker: the one large object it keeps from task to task. A
    worker serves all operators of an application in turn, so another key, or
    ``drop_held``, lets go of the one before."""
    if key not in _HELD:
        drop_held()
        _HELD[key] = build()
    return _HELD[key]


def drop_held() -> None:
    """Nothing is held any more, and what it took goes back to the machine: Arrow
    and the C library keep freed memory for themselves, and an idle worker would
    have it beside the executor's heap as long as the application runs."""
    if not _HELD:
        return
    _HELD.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def in_slices(batches: Iterator[pa.RecordBatch], column: str, at_once: int) -> Iterator[pa.RecordBatch]:
    """All rows in their order, about ``at_once`` bytes of the text column (or one
    row) at a time: what a task makes of a batch is as large as its texts are."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // at_once
        cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


@contextmanager
def uncollected() -> Iterator[None]:
    """Python's search for reference cycles, off: it looks through all that a worker
    holds again and again while many small objects are made. Objects without cycles
    are freed as ever."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def ship(spark: SparkSession) -> SparkSession:
    """Give the Python workers this package, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        file = Path(tempfile.mkdtemp(prefix="eventlake-")) / "eventlake.zip"
        with zipfile.ZipFile(file, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(file))
        _SHIPPED.add(app)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared checkpoint folder and read it."""
    path = f"{staging_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_count(spark: SparkSession, df: DataFrame, name: str, rows: Column | None = None) -> tuple[DataFrame, int]:
    """``staged``, and how many rows were written (of them, those where ``rows``
    holds), counted by the write itself."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    out = staged(spark, df.observe(seen, F.count(F.lit(1) if rows is None else F.when(rows, 1)).alias("n")), name)
    return out, seen.get["n"]


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted, by one sort (``np.unique`` without counts hashes
    large arrays first, which takes many times as long)."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now. It does so when
    the driver has collected its garbage, which a driver with little to do may
    not do for long; jobs that follow each other ask for it."""
    for _ in range(2):  # what the first round frees refers to what the second one finds
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def block_count(texts: DataFrame, column: str, block_bytes: int) -> int:
    """Number of blocks of about ``block_bytes`` that the whole column fills.

    A block is what one task holds in memory at a time, so the number of
    blocks follows the input and the memory of a task does not.
    """
    total = texts.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(1, -(-int(total) // block_bytes))


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def row_block(blocks: int, *columns: str) -> Column:
    """Block of a row where no block needs certain rows together: by the columns
    and the partition the row is read from, so that neither rows that share an
    id nor copies of one row gather in a block."""
    return block_of(F.xxhash64(*columns, F.spark_partition_id()), blocks)


def unwrapped(rows: DataFrame, like: DataFrame, **replaced: Column) -> DataFrame:
    """The columns of ``like`` from the struct ``_row``; rows travel as one
    struct where names of further columns could clash with an operator's own."""
    return rows.select(*[replaced.get(c, F.col("_row").getField(c)).alias(c) for c in like.columns])

"""S9 as a stream: land the day files that are new in a folder.

A file stream source with a checkpoint remembers which files it has handed on,
so a run sees only files that came since; nothing is listed through Python.
The stream has one row a file and opens none. The files of the entries to be
landed are then read once, and written as day entries under their own names. An
entry that is already landed is left as it is, its new files unread, unless
``replace`` is set. With ``archive``
the source moves handled files there (``cleanSource``), so the folder that later
runs list stays small.

A batch that runs again after a failure finds the entries that it has landed and
adds the others: an entry's folder appears whole.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake import schema as S
from eventlake import session as SESSION
from eventlake.sources import landing as L


#: Columns of Spark's source of whole files; their content is never asked for.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def _read(spark: SparkSession, paths: list[str], schema: T.StructType | str) -> DataFrame:
    """Rows of the given files, with the name of their entry."""
    plain = [re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in paths]  # the reader takes patterns
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*plain)
    return rows.withColumn(L.DAY_FILE, L.entry_name(F.col("_metadata.file_path")))


def _land(folder: str, suffix: str, replace: bool, told: list[str], schema: T.StructType | str = ""):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        files = batch.where(F.col(L.DAY_FILE).endswith(f"_{suffix}.parquet"))
        names = [r[0] for r in files.select(L.DAY_FILE).distinct().collect()]  # a name a day
        if not replace:  # entries that are there already stay as they are
            names = [n for n in names if not any(L.exists(spark, f"{folder.rstrip('/')}/{p}{n}") for p in ("", f"{L.DAY_FILE}="))]
        if names:
            paths = [r[0] for r in files.where(F.col(L.DAY_FILE).isin(names)).select(L.PATH).collect()]  # as listed
            told.extend(L.write_entries(_read(spark, paths, schema), folder))

    return run


def land_new(
    spark: SparkSession,
    source: str,
    folder: str,
    checkpoint: str,
    schema: T.StructType | str,
    suffix: str = S.DEFAULT_SUFFIX,
    replace: bool = False,
    archive: str | None = None,
) -> list[str]:
    """Land what has come to ``source`` (files named ``YYYYMMDD_<suffix>.parquet``, or
    folders of that name) since the last run with this checkpoint. ``schema`` are
    the files' columns. Returns the names of the entries landed."""
    own = SESSION.scoped(spark)
    reader = own.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", "true")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    files = reader.load(source).select(L.PATH, L.entry_name(F.col("_metadata.file_path")).alias(L.DAY_FILE))
    landed: list[str] = []
    query = (
        files.writeStream.foreachBatch(_land(folder, suffix, replace, landed, schema))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sorted(landed)

"""Incremental load: new landed files are merged into a keyed table by Spark's streaming state.

A file stream is grouped by the key; the state of a key is its best row so far
(a built-in aggregate, so the state lies in Spark's state store beside the
stream's checkpoint).  The best row has the highest load number, so a file of
an older load that arrives late changes nothing.  ``trigger(availableNow=True)``
takes everything landed since the last run and stops; a run with nothing new
writes nothing.

Every micro-batch hands on only the keys whose best row may have changed.  They
are written to a folder of the batch's own (``run=<id>/batch=<n>``), which the
same batch overwrites if it runs again.  The table is the best row per key over
these folders.  A run's id lies in its checkpoint: when that is lost, the stream
begins a new run, reads all landed files again, and no folder of an earlier run
is touched.  Set ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB
provider where keys outgrow the executors' memory.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.operators.upsert import best_row


def _newest(df: DataFrame, schema, keys: Sequence[str], load_col: str) -> DataFrame:
    best = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(best_row(df.columns, keys, load_col).alias("_row"))
    return best.select(*[F.col(f"_row.`{f.name}`") for f in schema])


def _missing(read) -> bool:
    try:
        read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return True
    return False


def _run_id(spark: SparkSession, checkpoint_dir: str) -> str:
    """The id of the run that this checkpoint belongs to, new with a new checkpoint."""
    path = f"{checkpoint_dir.rstrip('/')}/run-id"
    if _missing(lambda: spark.read.text(path)):
        spark.createDataFrame([(uuid.uuid4().hex,)], "value string").coalesce(1).write.text(path)
    return spark.read.text(path).first()["value"]


def read_table(spark: SparkSession, table_root: str, schema, keys: Sequence[str], load_col: str) -> DataFrame:
    """The table's rows: the best row of every key among the written changes; raises if there is no table."""
    fields = spark.createDataFrame([], schema).schema
    changes = spark.read.schema(fields).option("recursiveFileLookup", "true").parquet(table_root)
    return _newest(changes, fields, keys, load_col)


def incremental_upsert(
    spark: SparkSession,
    landing_dir: str,
    table_root: str,
    checkpoint_dir: str,
    schema,
    keys: Sequence[str],
    load_col: str,
    initial: DataFrame | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Merge everything landed in ``landing_dir`` (Parquet) into the table at
    ``table_root``; returns the table's rows.  Of the rows of a key the one with
    the highest load number wins, then the least in its other columns.
    ``initial`` holds rows to begin a new table with.  ``files_per_trigger``
    bounds a micro-batch (unset, a run takes everything landed since the last).
    A table that a checkpoint has written to and that is gone raises."""
    root, fields = table_root.rstrip("/"), spark.createDataFrame([], schema).schema
    known = not _missing(lambda: spark.read.text(f"{checkpoint_dir.rstrip('/')}/run-id"))
    if _missing(lambda: spark.read.schema(fields).option("recursiveFileLookup", "true").parquet(root)):
        if known:
            raise FileNotFoundError(f"the table {root} is gone, but its checkpoint is not")
        first = spark.createDataFrame([], fields) if initial is None else initial.select(*fields.names)
        first.write.parquet(f"{root}/run=initial/batch=0")
    run = _run_id(spark, checkpoint_dir)
    reader = spark.readStream.schema(fields)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{root}/run={run}/batch={batch}")

    query = (
        _newest(reader.parquet(landing_dir), fields, keys, load_col)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_table(spark, root, fields, keys, load_col)

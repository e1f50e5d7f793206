"""Keyed upsert ("latest version per key wins") and table contracts.

Plain Parquet has no MERGE, so an upsert is a pure function
``(current table, batch) -> next table``: union the two with a priority
(batch over current; inside a batch, a later ``order`` wins) and keep rank 1 per
key.  The result goes to a new folder, never over the path being read
(``streaming.incremental`` keeps the rows per key in Spark's state instead).  A table
stored in buckets of its keys (``write_bucketed``) is merged in place of its buckets:
only the batch is exchanged.  Rank-1 filters become a partial
``WindowGroupLimit`` before the shuffle, so a hot key ships one row per map
task.  Re-applying the same batch gives the same table (idempotent).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert_latest(
    current: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] = (),
    stamp_col: str | None = None,
    stamp=None,
    version_col: str | None = None,
) -> DataFrame:
    """Next table version: every key once, batch rows replacing current rows.

    ``order``: ordering inside the batch, first = winner (default: all
    columns, for a deterministic survivor).  ``stamp_col``/``stamp``: refresh
    a load-time column on the rows taken from the batch.  ``version_col``:
    a load / version number carried by the rows; the highest wins before the
    batch-over-current rule (so an older load arriving late loses).
    """
    if stamp_col is not None:
        batch = batch.withColumn(stamp_col, F.lit(stamp).cast("timestamp"))
        if stamp_col not in current.columns:
            current = current.withColumn(stamp_col, F.lit(None).cast("timestamp"))
    batch = batch.select(*current.columns)
    both = current.withColumn("_prio", F.lit(0)).unionByName(batch.withColumn("_prio", F.lit(1)))
    tie = list(order) or [F.col(f"`{c}`").asc_nulls_last() for c in current.columns if c not in keys]
    first = [F.col(version_col).desc()] if version_col else []
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*first, F.col("_prio").desc(), *tie)
    return both.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn", "_prio")


def best_row(columns: Sequence[str], keys: Sequence[str], version_col: str) -> Column:
    """An aggregate: the row (a struct) with the highest version of its key, then the least in its other columns.

    A row without a version loses to any with one; NULLs come last."""
    rest = [F.col(f"`{c}`") for c in columns if c not in {*keys, version_col}]
    rank = [F.col(f"`{version_col}`").isNull(), -F.col(f"`{version_col}`")]
    for c in rest:
        rank += [c.isNull(), c]
    return F.min_by(F.struct(*[F.col(f"`{c}`") for c in columns]), F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)]))


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """Store a table bucketed and sorted on its keys, a file per bucket, at ``path``."""
    dealt = df.repartition(buckets, *[F.col(f"`{k}`") for k in keys])
    _save_buckets(dealt, table, path, keys, buckets)


def _save_buckets(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> None:
    writer = df.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys)
    writer.saveAsTable(table, format="parquet")


def merged_buckets(current: DataFrame, batch: DataFrame, keys: Sequence[str], buckets: int,
                   version_col: str | None = None) -> DataFrame:
    """``upsert_latest`` for a current table bucketed on ``keys``, every key once: only the batch is exchanged.

    The batch is cut to its best row per key (with partial aggregation, so a hot key ships a
    row per task) and dealt to the table's buckets; each bucket then joins its part in place.
    The result lies in the same buckets.  Ties go as in ``upsert_latest``: the higher version, then
    the batch, then the least of the other columns.  Keys are a primary key: a NULL in one raises."""
    cols = current.columns
    batch = batch.select(*[F.col(f"`{c}`") for c in cols])
    refused = F.raise_error(F.lit("NULL in a key column of the batch"))
    for k in keys:
        batch = batch.withColumn(k, F.coalesce(F.col(f"`{k}`"), refused.cast(batch.schema[k].dataType)))
    ids = [F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]
    # without versions all rows of the batch rank alike ahead of the other columns
    ranked = batch if version_col else batch.withColumn("_even", F.lit(0))
    best = ranked.groupBy(*ids).agg(best_row(cols, keys, version_col or "_even").alias("_new"))
    best = best.repartition(buckets, *[f"_k{i}" for i in range(len(keys))]).withColumnsRenamed(
        {f"_k{i}": f"_b{i}" for i in range(len(keys))})
    old = current.select(*ids, F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_old"))
    same = [F.col(f"_k{i}") == F.col(f"_b{i}") for i in range(len(keys))]
    both = old.join(best, same, "full_outer")
    wins = F.col("_old").isNull()
    if version_col:
        had, got = F.col("_old").getField(version_col), F.col("_new").getField(version_col)
        wins = wins | had.isNull() | F.coalesce(got >= had, F.lit(False))
    else:
        wins = F.lit(True)
    row = F.when(F.col("_new").isNotNull() & wins, F.col("_new")).otherwise(F.col("_old"))
    return both.select(row.alias("_row")).select("_row.*")


def upsert_bucketed(current_table: str, batch: DataFrame, next_table: str, path: str, keys: Sequence[str], buckets: int,
                    version_col: str | None = None) -> None:
    """The next version of a bucketed table, stored at ``path`` in the same buckets; the current one is only read."""
    current = batch.sparkSession.table(current_table)
    _save_buckets(merged_buckets(current, batch, keys, buckets, version_col), next_table, path, keys, buckets)


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (one aggregate)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def rule_violations(df: DataFrame, not_null: Sequence[str] = (), max_length: dict[str, int] | None = None) -> DataFrame:
    """One pass over the table: (column, rule, violations) rows for NOT NULL
    and varchar-length rules."""
    aggs = []
    for c in not_null:
        aggs.append(F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}|not_null"))
    for c, n in (max_length or {}).items():
        aggs.append(F.count_if(F.length(F.col(f"`{c}`")) > n).alias(f"{c}|max_length_{n}"))
    wide = df.agg(*aggs)
    long = wide.unpivot([], [F.col(f"`{a}`") for a in wide.columns], "rule_key", "violations")
    parts = F.split(F.col("rule_key"), r"\|")
    return long.select(parts[0].alias("column"), parts[1].alias("rule"), F.col("violations"))

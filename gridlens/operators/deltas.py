"""Derived tables refreshed from what an incremental load changes, by signed deltas.

A load replaces some rows of a keyed table.  ``signed_changes`` gives the rows
that leave (sign -1) and that come (sign +1); a row that stays gives none.  A
table of counts and sums per group takes them up as additions, so its refresh
costs the changed keys and the groups, not the whole table: the old row of a
key that moved to another group is taken back where it was counted.  Means and
z-scores are computed from the refreshed sums.  Sums must be of whole numbers
(or decimals): they are taken back exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlens.operators.ordered import join_null_safe
from gridlens.operators.upsert import best_row

SIGN = "_sign"


def signed_changes(current: DataFrame, batch: DataFrame, keys: Sequence[str], version_col: str) -> DataFrame:
    """Rows with ``_sign``: for every key whose row the batch replaces, the old row (-1, if any) and the new one (+1).

    ``current`` holds a key once.  Of the batch's rows the best per key counts
    (the highest version, then the least in its other columns), and it
    replaces the current row unless that one is better or equal.  NULL is a
    key like any other.  Only current rows of the batch's keys are looked at."""
    columns = current.columns
    key_cols = [F.col(f"`{k}`") for k in keys]
    best = best_row(columns, keys, version_col)
    fresh = batch.select(*columns).groupBy(*key_cols).agg(best.alias("_row")).select("_row.*")
    met = join_null_safe(current, fresh.select(*keys), list(keys), "left_semi")
    both = met.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)))
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    each = both.groupBy(*key_cols).agg(
        best.alias("_best"),
        F.max(F.when(F.col("_new") == 0, row)).alias("_old"),
    )
    moved = each.filter(~F.col("_best").eqNullSafe(F.col("_old")))
    pair = F.array(F.struct(F.lit(-1).alias("s"), F.col("_old").alias("r")), F.struct(F.lit(1).alias("s"), F.col("_best").alias("r")))
    signed = moved.select(F.explode(pair).alias("p")).filter("p.r IS NOT NULL")
    return signed.select(*[F.col(f"p.r.`{c}`") for c in columns], F.col("p.s").alias(SIGN))


def applied(current: DataFrame, signed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keyed table after the changes."""
    kept = join_null_safe(current, signed.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(signed.filter(F.col(SIGN) == 1).drop(SIGN))


def group_sums(rows: DataFrame, groups: dict[str, Column], sums: dict[str, Column]) -> DataFrame:
    """``groups..., n, sums...`` of plain rows, or of signed ones: what to add to the groups' sums."""
    sign = F.col(SIGN) if SIGN in rows.columns else F.lit(1)
    aggs = [F.sum(sign).cast("long").alias("n"), *[F.sum(sign * c).alias(name) for name, c in sums.items()]]
    return rows.groupBy(*[c.alias(name) for name, c in groups.items()]).agg(*aggs)


def refreshed(state: DataFrame, more: Sequence[DataFrame], groups: Sequence[str]) -> DataFrame:
    """The sums per group with some additions; a group that has no rows left goes."""
    values = [c for c in state.columns if c not in groups]
    every = reduce(DataFrame.unionByName, more, state)
    return every.groupBy(*groups).agg(*[F.sum(c).cast(state.schema[c].dataType).alias(c) for c in values]).filter("n != 0")

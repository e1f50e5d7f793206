"""Train / test splits that are stable under repartitioning and re-execution.

``randomSplit`` depends on partition layout and row order, so a lost executor
or a different file split can move rows between train and test.  Here the
side of a row is a function of its key (md5 of ``seed:key``), so every rerun,
on any cluster, puts each row on the same side.

* ``hash_split``       keys whose hash lies in the first ``fraction`` of the hash range go to test
* ``stratified_split`` the ceil(fraction * n_c) rows with the smallest hashes of each class go to test
* ``nested_split``     a second split of the train side (validation), by hash or stratified
* ``group_split``      hash on a group column: no group on both sides

NULL is a class like any other, and no split loses a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlens.functions.columns import HASH_BITS, stable_hash
from gridlens.operators.ordered import join_null_safe
from gridlens.session import materialize

# Hash ranges that a class's hashes are counted in before ranks are looked at.
RANGE_BITS = 16


def hash_cut(fraction: float) -> int:
    """The hash below which the first ``fraction`` of the hash range lies."""
    return int(fraction * (1 << HASH_BITS))


def hash_split(df: DataFrame, keys: Sequence[str], test_fraction: float = 0.2, seed: int = 42,
               out: str = "split") -> DataFrame:
    side = F.when(stable_hash(seed, *keys) < F.lit(hash_cut(test_fraction)), F.lit("test")).otherwise(F.lit("train"))
    return df.withColumn(out, side)


def nested_split(df: DataFrame, keys: Sequence[str], test_fraction: float = 0.2, valid_fraction: float = 0.2,
                 seed: int = 42, valid_seed: int = 43, out: str = "split", stratify: str | None = None) -> DataFrame:
    """Train / valid / test; with ``stratify``, both splits keep the shares of that column's classes."""
    if stratify is None:
        first = hash_split(df, keys, test_fraction, seed, out)
        valid = stable_hash(valid_seed, *keys) < F.lit(hash_cut(valid_fraction))
    else:
        first = stratified_split(df, keys, stratify, test_fraction, seed, out)
        rest = _thresholds(first.filter(F.col(out) != "test"), keys, stratify, valid_fraction, valid_seed)
        first = join_null_safe(first, rest, [stratify], "left")
        valid = F.coalesce(stable_hash(valid_seed, *keys) <= F.col("_cut"), F.lit(False))
    side = F.when(F.col(out) == "test", F.lit("test")).when(valid, F.lit("valid")).otherwise(F.lit("train"))
    return first.withColumn(out, side).drop("_cut")


def group_split(df: DataFrame, group_col: str, test_fraction: float = 0.2, seed: int = 42,
                out: str = "split") -> DataFrame:
    return hash_split(df, [group_col], test_fraction, seed, out)


def _thresholds(df: DataFrame, keys: Sequence[str], label: str, fraction: float, seed: int) -> DataFrame:
    """``(label, _cut)``: the largest hash with which a class's quota is not passed.

    Hashes are counted per (class, range); only the one range of each class in
    which the quota lies is looked at by single hashes.
    """
    low = HASH_BITS - RANGE_BITS
    # read by the ranges and again by the hashes inside them: each row's hash is computed once
    tagged = materialize(df.select(label, stable_hash(seed, *keys).alias("_h")).withColumn("_range", F.shiftright("_h", low)))
    hist = tagged.groupBy(label, "_range").agg(F.count(F.lit(1)).alias("_n"))
    ordered = Window.partitionBy(label).orderBy("_range")  # 2^RANGE_BITS rows a class at most
    whole = Window.partitionBy(label)
    hist = hist.withColumns({
        "_upto": F.sum("_n").over(ordered),
        "_quota": F.ceil(F.sum("_n").over(whole) * F.lit(float(fraction))),
    })
    at = hist.groupBy(label).agg(
        F.max("_quota").alias("_quota"),
        F.min(F.when(F.col("_upto") > F.col("_quota"), F.struct("_range", (F.col("_upto") - F.col("_n")).alias("before")))).alias("_at"),
    )
    at = at.select(label, "_quota", F.col("_at._range").alias("_range"), F.col("_at.before").alias("_before"))
    inside = join_null_safe(tagged, at.select(label, "_range"), [label, "_range"], "left_semi")
    single = inside.groupBy(label, "_h").agg(F.count(F.lit(1)).alias("_n"))
    single = single.withColumn("_upto", F.sum("_n").over(Window.partitionBy(label).orderBy("_h")))
    both = join_null_safe(single, at, [label]).filter(F.col("_before") + F.col("_upto") <= F.col("_quota"))
    best = both.groupBy(label).agg(F.max("_h").alias("_best"))
    below = F.shiftleft(F.col("_range"), low) - 1  # every hash of the ranges before
    end = F.when(F.col("_range").isNull(), F.lit((1 << HASH_BITS) - 1)).otherwise(below)
    return join_null_safe(at, best, [label], "left").select(label, F.coalesce("_best", end).alias("_cut"))


def stratified_split(df: DataFrame, keys: Sequence[str], label: str, test_fraction: float = 0.2,
                     seed: int = 42, out: str = "split") -> DataFrame:
    """ceil(test_fraction * n_c) rows of every class go to test — the ones with
    the smallest key hash in that class; exact when keys are unique (rows
    sharing a key always stay together).  Rows are compared with their class's
    threshold, which AQE broadcasts when the classes are few."""
    cuts = _thresholds(df, keys, label, test_fraction, seed)
    side = F.when(stable_hash(seed, *keys) <= F.col("_cut"), F.lit("test")).otherwise(F.lit("train"))
    return join_null_safe(df, cuts, [label], "left").withColumn(out, side).drop("_cut")


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weights n / (k * n_c), attached to every row; rows without a
    class do not count and get the weight 0."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    totals = counts.agg(F.struct(F.sum("_nc").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    w = counts.select(label, (totals.getField("n") / (totals.getField("k") * F.col("_nc"))).alias(out))
    return df.join(w, label, "left").withColumn(out, F.coalesce(out, F.lit(0.0)))

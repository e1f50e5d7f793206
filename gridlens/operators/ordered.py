"""Exact order statistics without a global single-task window.

``prefix_sums`` gives, for every row, the running totals of some columns in
the order of other columns (optionally within groups).  A window without
``partitionBy`` would do the same in ONE task.  Here the rows are exchanged by
ranges of (groups, order), so every partition holds one consecutive stretch;
each stretch is summed on its own, and a small table of the totals of the
stretches (at most partitions + groups rows) gives what lies ahead of it.  The
exchange samples the data for its range borders; the sums are exact.

Everything that needs a global order is built on it: rank-sum ROC-AUC, PR and
ROC curves, the best-F1 threshold, exact quantiles per group (linear
interpolation) and the frequency-ordered index.  Quantiles of whole columns come
from ``selection``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlens.operators.selection import column_quantiles
from gridlens.session import materialize


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; the keys come from the left."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond: Column | None = None
    for k in keys:
        same = F.col(f"`{k}`").eqNullSafe(F.col(f"`_r_{k}`"))
        cond = same if cond is None else cond & same
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def _stretches(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The rows exchanged by ranges, with the number of the stretch each lies in.

    Several passes use the numbers, so the frame is cut here: a range exchange
    that ran again might draw other borders.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = df.repartitionByRange(n, *[F.col(f"`{c}`") for c in (*group_cols, *order_cols)])
    return materialize(ranged.withColumn("_part", F.spark_partition_id()))


def _ahead(stretches: DataFrame, group_cols: Sequence[str], sum_cols: Sequence[str]) -> DataFrame:
    """(groups, _part, _t_<c>: total of the stretch, _o_<c>: total of the stretches before it)."""
    totals = stretches.groupBy(*group_cols, "_part").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    before = Window.partitionBy(*group_cols).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumns({f"_o_{c}": F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)) for c in sum_cols})


def prefix_sums(
    df: DataFrame,
    order_by: str | Sequence[str],
    sum_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    prefix: str = "cum_",
    distinct_order: bool = False,
) -> DataFrame:
    """Add ``cum_<c>`` = sum of ``c`` over rows at or before this row in the
    order of ``order_by`` (same group).  Equal rows get the same running total.

    Unless the caller knows the order to be distinct within each group
    (``distinct_order=True``), rows are first pre-aggregated per (group,
    value) — map-side combined — so a value repeated by a third of all rows
    is one row in the ranges; the totals are joined back afterwards."""
    group_cols = list(group_cols)
    order_cols = [order_by] if isinstance(order_by, str) else list(order_by)
    if not distinct_order:
        per_value = df.groupBy(*group_cols, *order_cols).agg(*[F.sum(c).alias(c) for c in sum_cols])
        cum = prefix_sums(per_value, order_cols, sum_cols, group_cols, prefix, distinct_order=True)
        cum = cum.select(*group_cols, *order_cols, *[f"{prefix}{c}" for c in sum_cols])
        return join_null_safe(df, cum, [*group_cols, *order_cols])
    rows = _stretches(df, group_cols, order_cols)
    ahead = _ahead(rows, group_cols, sum_cols)
    upto = Window.partitionBy(*group_cols, "_part").orderBy(*order_cols).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumns({f"_l_{c}": F.sum(c).over(upto) for c in sum_cols})
    out = join_null_safe(local, ahead, [*group_cols, "_part"])
    out = out.withColumns({f"{prefix}{c}": F.col(f"_l_{c}") + F.col(f"_o_{c}") for c in sum_cols})
    return out.select(*df.columns, *[f"{prefix}{c}" for c in sum_cols])


def value_counts(df: DataFrame, value_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """(groups, _v, _n): each distinct value with its count; NULLs are ignored."""
    vals = df.select(*group_cols, F.col(value_col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    return vals.groupBy(*group_cols, "_v").agg(F.count(F.lit(1)).alias("_n"))


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float], group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation (the pandas / numpy default):
    position h = (n - 1) p, value = v[floor h] + (h - floor h)(v[ceil h] - v[floor h]).

    Returns one row per (group, p): ``group..., p, quantile``.  NULLs are ignored.
    Without groups the values are counted by their bits and never exchanged."""
    if not group_cols:
        return column_quantiles(df.select(F.col(value_col).cast("double").alias("v")), ["v"], probs).drop("feature")
    return quantiles_of_counts(stretched_counts(df, value_col, group_cols), probs, group_cols)


def quantiles_of_counts(counts: DataFrame, probs: Sequence[float], group_cols: Sequence[str] = ()) -> DataFrame:
    """The quantiles of a value-count table that lies in stretches: the stretch
    that holds each wanted rank, then exact ranks inside these stretches only."""
    keys = list(group_cols)
    ahead = _ahead(counts, keys, ["_n"]).withColumnsRenamed({"_t__n": "_t", "_o__n": "_o"})
    # one row per group, with its stretches (as many as partitions at most)
    per_group = ahead.groupBy(*keys).agg(
        F.sum("_t").alias("_total"), F.collect_list(F.struct("_part", "_o", "_t")).alias("_spots"))
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probs]))
    per_group = per_group.filter(F.col("_total").isNotNull())  # an empty table has no ranks
    ranks = per_group.select(*keys, wanted.alias("p"), "_spots", "_total").withColumn("_h", (F.col("_total") - 1) * F.col("p"))
    low_high = F.array(
        F.struct(F.lit("lo").alias("which"), F.floor("_h").alias("r")),
        F.struct(F.lit("hi").alias("which"), F.ceil("_h").alias("r")),
    )
    ranks = ranks.select(*keys, "p", "_h", "_spots", F.explode(low_high).alias("t")).select(*keys, "p", "_h", "_spots", "t.which", "t.r")
    spot = F.filter("_spots", lambda s: (s["_o"] <= F.col("r")) & (F.col("r") < s["_o"] + s["_t"]))
    hit = ranks.withColumn("_spot", F.try_element_at(spot, F.lit(1))).select(
        *keys, F.col("_spot._part").alias("_part"), "p", "_h", "which", "r", F.col("_spot._o").alias("_o"))
    inside = join_null_safe(counts, hit.select(*keys, "_part").distinct(), [*keys, "_part"], "left_semi")
    upto = Window.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("_c", F.sum("_n").over(upto))
    # value at rank r: the smallest value whose running count passes r
    val = join_null_safe(inside, hit, [*keys, "_part"]).filter(F.col("_o") + F.col("_c") > F.col("r")).groupBy(
        *keys, "p", "_h", "which").agg(F.min("_v").alias("_val"))
    wide = val.groupBy(*keys, "p", "_h").agg(
        F.max(F.when(F.col("which") == "lo", F.col("_val"))).alias("_vlo"),
        F.max(F.when(F.col("which") == "hi", F.col("_val"))).alias("_vhi"),
    )
    frac = F.col("_h") - F.floor("_h")
    # equal neighbours need no interpolation (and infinities allow none)
    between = F.when(F.col("_vlo") == F.col("_vhi"), F.col("_vlo")).otherwise(
        F.col("_vlo") + frac * (F.col("_vhi") - F.col("_vlo")))
    return wide.select(*keys, "p", between.alias("quantile"))


def stretched_counts(df: DataFrame, value_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """``value_counts`` exchanged by ranges once, for several uses (``_part`` tells the stretch)."""
    return _stretches(value_counts(df, value_col, group_cols), group_cols, ["_v"])

"""Report frames: the data behind each chart and console summary.

All are aggregates or top-k over the table they describe; nothing is
collected to the driver to be summarised there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.functions.columns import field_text
from gridlens.operators.ordered import prefix_sums
from gridlens.operators.selection import column_quantiles
from gridlens.session import materialize

QUARTILES = [0.25, 0.5, 0.75]


def feature_statistics(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """describe(): count, mean, std (sample), min, 25/50/75 % (linear
    interpolation, exact), max — one row per feature.

    The features are stored once, side by side: no row is exploded and no value
    exchanged.  One aggregate gives the moments, four counting passes the quartiles."""
    present = [c for c in cols if c in df.columns]
    values = materialize(df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in present]))
    moments = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = values.agg(*[F.struct(*[f(F.col(f"`{c}`")).alias(m) for m, f in moments.items()]).alias(c) for c in present])
    # one row: a struct per feature, every feature has its row, with the count 0 if it has no value at all
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), *[F.col(f"`{c}`").getField(m).alias(m) for m in moments]) for c in present])
    basic = wide.select(F.inline(rows))
    q = column_quantiles(values, present, QUARTILES).groupBy("feature").pivot("p", QUARTILES).agg(F.first("quantile"))
    q = q.select("feature", *[F.col(f"`{p}`").alias(f"p{int(p * 100)}") for p in QUARTILES])
    return basic.join(q, "feature", "left").select("feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def _exact_text(c: Column, dtype: T.DataType) -> Column:
    """A text that only equal values share: of a double, its exact binary value."""
    if not isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.cast("string")
    d = c.cast("double")
    return F.when(d.isNotNull(), F.replace(F.format_string("%a", d), F.lit(".0p"), F.lit("p")))


def data_fingerprint(df: DataFrame, exclude: Sequence[str] = ("created_at",)) -> DataFrame:
    """Order- and partition-independent fingerprint of exact values: the sum of
    per-row 48-bit md5 prefixes, mod 2^48 (one aggregate, decimal sum: no
    overflow).  Fields carry their lengths and NULL has a mark of its own, so
    no two different rows share a text."""
    fields = [f for f in df.schema.fields if f.name not in set(exclude)]
    row_text = F.concat(*[field_text(_exact_text(F.col(f"`{f.name}`"), f.dataType)) for f in fields])
    h = F.conv(F.substring(F.md5(row_text), 1, 12), 16, 10).cast("decimal(20,0)")
    total = df.agg(F.sum(h).alias("s"), F.count(F.lit(1)).alias("rows"))
    low48 = F.pmod(F.coalesce(F.col("s"), F.lit(0)).cast("decimal(38,0)"), F.lit(2**48).cast("decimal(38,0)"))
    return total.select(
        F.col("rows"),
        low48.cast("bigint").alias("fingerprint"),
        F.lower(F.hex(low48.cast("bigint"))).alias("fingerprint_hex"),
        F.lit(",".join(f.name for f in fields)).alias("columns"),
    )


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows per class with share and the number of distinct classes; rows
    without a class are not counted."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("total"), F.count(F.lit(1)).alias("k"))).scalar()
    return counts.select(
        label, "n", (F.col("n") / totals.getField("total")).alias("share"), totals.getField("k").alias("n_classes")
    )


def prediction_summary(df: DataFrame, predicted: str, proba: str | None = None) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(F.col(predicted).cast("double")).alias("positive_share")]
    if proba:
        aggs.append(F.avg(proba).alias("mean_proba"))
    return df.agg(*aggs)


def gap_summary(gaps: DataFrame) -> DataFrame:
    return gaps.agg(
        F.count(F.lit(1)).alias("cells"),
        F.count_if(F.col("gap") > 0).alias("cells_need_more"),
        F.count_if(F.col("gap") < 0).alias("cells_oversupplied"),
    )


def top_by(df: DataFrame, col: str, n: int, keys: Sequence[str], descending: bool = True) -> DataFrame:
    """Top-n by ``col`` with the keys as tie-break (TakeOrderedAndProject)."""
    first = F.col(col).desc() if descending else F.col(col).asc()
    return df.orderBy(first, *[F.col(k).asc() for k in keys]).limit(n)


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram between the finite min and max, last bin closed; all
    bins are listed, empty ones with 0 (like numpy.histogram).  ``n_other``, alike
    on every row, counts the values without a bin: NULL, NaN and infinities."""
    # read three times (range, counts, edges): cut the lineage to the one column
    df = materialize(df.select(F.col(col).cast("double").alias("_v")))
    finite = F.abs("_v") < F.lit(float("inf"))  # NaN is above every number
    stats = df.agg(
        F.min(F.when(finite, F.col("_v"))).alias("_lo"),
        F.max(F.when(finite, F.col("_v"))).alias("_hi"),
        F.count_if(F.coalesce(~finite, F.lit(True))).alias("n_other"),
    )
    st = stats.select(F.struct("_lo", "_hi")).scalar()  # one row, computed once
    lo, hi = st.getField("_lo"), st.getField("_hi")
    width = (hi - lo) / F.lit(float(bins))
    idx = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((F.col("_v") - lo) / width), F.lit(bins - 1)))
    counts = df.filter(finite).groupBy(idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = stats.select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "_lo", "_hi", "n_other"
    ).filter(F.col("_lo").isNotNull())
    w = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return edges.join(counts, "bin", "left").select(
        "bin",
        (F.col("_lo") + F.col("bin") * w).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_end"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
        "n_other",
    )


def actual_vs_predicted(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Distinct (actual, predicted) pairs with counts, plus the diagonal's
    min and max over both columns."""
    df = materialize(df.select(actual, predicted))  # read by the pairs and the range
    pairs = df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rng = df.agg(F.struct(
        F.least(F.min(actual), F.min(predicted)).alias("lo"),
        F.greatest(F.max(actual), F.max(predicted)).alias("hi"),
    )).scalar()  # one row, computed once
    return pairs.withColumns({"diag_min": rng.getField("lo"), "diag_max": rng.getField("hi")})


def latest(df: DataFrame, order_col: str, filter_col: Column | None = None) -> DataFrame:
    """The newest row (one row; ``max_by`` over a struct of all columns)."""
    src = df.filter(filter_col) if filter_col is not None else df
    cols = [c for c in df.columns]
    best = src.agg(F.max_by(F.struct(*cols), F.struct(F.col(order_col), *[F.col(c) for c in cols])).alias("r"))
    return best.select("r.*").filter(F.col(order_col).isNotNull())


def run_comparison(runs: DataFrame, order_col: str = "trained_at") -> DataFrame:
    """Runs in start order with a 1-based run index, a prefix sum of ones over ranges of the order."""
    ranked = prefix_sums(runs.withColumn("_one", F.lit(1)), [order_col, "run_id"], ["_one"], distinct_order=True)
    return ranked.select(*runs.columns, F.col("cum__one").cast("int").alias("run_index"))


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, rows) for named frames: one count aggregate per stage."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows")
             for name, df in stages.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

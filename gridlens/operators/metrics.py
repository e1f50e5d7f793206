"""Model evaluation as aggregates: regression and binary-classification metrics,
confusion matrix, ROC / PR curves, best-F1 threshold.

Every metric is one aggregate (partial + final, map-side combined) over the
scored rows; the order-dependent ones (AUC, curves, thresholds, median) use
the exact prefix sums of ``ordered`` over ranges of the *distinct scores*, so
no step puts all rows, or all distinct scores, into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.functions.columns import clip_round_count
from gridlens.operators.ordered import exact_quantiles, prefix_sums


def _safe_div(a, b, default=0.0):
    return F.when(b == 0, F.lit(default)).otherwise(a / b)


def regression_metrics(df: DataFrame, label: str, pred: str, with_median: bool = True) -> DataFrame:
    """One row: n, rmse, mae, r2 (1 - SSE / SST), and the median absolute error,
    over the rows that have both a label and a prediction."""
    df = df.filter(F.col(label).isNotNull() & F.col(pred).isNotNull())
    e = F.col(pred) - F.col(label)
    sse = F.sum(e * e)
    sst = F.var_pop(label) * F.count(F.lit(1))
    out = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        F.when(sst == 0, F.lit(None).cast("double")).otherwise(F.lit(1.0) - sse / sst).alias("r2"),
    )
    if with_median:
        # an aggregate always yields one row (NULL median on empty input)
        med = exact_quantiles(df.select(F.abs(e).alias("abs_err")), "abs_err", [0.5]).agg(
            F.max("quantile")
        ).scalar()
        out = out.withColumn("median_ae", med)
    return out


def with_threshold(df: DataFrame, proba: str, threshold: float = 0.5, out: str = "predicted") -> DataFrame:
    return df.withColumn(out, (F.col(proba) >= F.lit(threshold)).cast("int"))


def _confusion_counts(df: DataFrame, label: str, predicted: str):
    y, p = F.col(label), F.col(predicted)
    return [
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    ]


def classification_metrics(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Accuracy, precision / recall / F1 of class 1 (0 when undefined), n, over
    the rows that have both a label and a prediction."""
    c = df.agg(*_confusion_counts(df, label, predicted))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    return c.select(
        n.alias("n"),
        _safe_div(tp + tn, n).alias("accuracy"),
        _safe_div(tp, tp + fp).alias("precision"),
        _safe_div(tp, tp + fn).alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def confusion_matrix(spark: SparkSession, df: DataFrame, label: str, predicted: str) -> DataFrame:
    """2x2 matrix as rows (actual, predicted, n) with all four label pairs."""
    pairs = spark.createDataFrame([(a, p) for a in (0, 1) for p in (0, 1)], "actual int, predicted int")
    counts = df.groupBy(F.col(label).cast("int").alias("actual"), F.col(predicted).cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return pairs.join(counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce(F.col("n"), F.lit(0)).alias("n")
    )


def score_histogram(df: DataFrame, label: str, score: str) -> DataFrame:
    """(score, pos, neg) per distinct score, with running totals below-or-equal.
    Rows without a label or a score (NULL, NaN) cannot be ranked and do not count."""
    s = F.col(score).cast("double")
    df = df.filter(F.col(label).isNotNull() & s.isNotNull() & ~F.isnan(s))
    h = df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum((1 - F.col(label)).cast("long")).alias("neg"),
    )
    return prefix_sums(h, "score", ["pos", "neg"], distinct_order=True)


def curve_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row per distinct score used as threshold (predict 1 when score >= t):
    tp, fp, tpr (= recall), fpr, precision, f1."""
    h = score_histogram(df, label, score)
    # class totals from the (materialised) histogram, not another pass over df
    totals = h.agg(F.struct(F.sum("pos").alias("P"), F.sum("neg").alias("N"))).scalar()
    h = h.withColumns({"P": totals.getField("P"), "N": totals.getField("N")})
    tp = F.col("P") - (F.col("cum_pos") - F.col("pos"))
    fp = F.col("N") - (F.col("cum_neg") - F.col("neg"))
    h = h.withColumns({"tp": tp, "fp": fp})
    tp, fp = F.col("tp"), F.col("fp")
    return h.select(
        F.col("score").alias("threshold"),
        "pos",
        "neg",
        "tp",
        "fp",
        _safe_div(tp, F.col("P")).alias("tpr"),
        _safe_div(fp, F.col("N")).alias("fpr"),
        _safe_div(tp, tp + fp).alias("precision"),
        _safe_div(2 * tp, tp + fp + F.col("P")).alias("f1"),
        F.col("P"),
        F.col("N"),
        (F.col("cum_neg") - F.col("neg")).alias("neg_below"),
    )


def auc_scores(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row: roc_auc (ties count half; 0.0 with one class, as the source
    pipeline reports it) and pr_auc (average precision, step-wise)."""
    pts = curve_points(df, label, score)
    agg = pts.agg(
        F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") * F.lit(0.5))).alias("_pairs"),
        F.sum(F.col("pos") * F.col("precision")).alias("_ap"),
        F.first("P").alias("P"),
        F.first("N").alias("N"),
    )
    one_class = (F.col("P") == 0) | (F.col("N") == 0) | F.col("P").isNull()
    return agg.select(
        F.when(one_class, F.lit(0.0)).otherwise(F.col("_pairs") / (F.col("P") * F.col("N"))).alias("roc_auc"),
        F.when(F.col("P") > 0, F.col("_ap") / F.col("P")).otherwise(F.lit(0.0)).alias("pr_auc"),
        F.coalesce(F.col("P"), F.lit(0)).alias("positives"),
        F.coalesce(F.col("N"), F.lit(0)).alias("negatives"),
    )


def best_f1_threshold(df: DataFrame, label: str, score: str) -> DataFrame:
    """Threshold with the highest F1 (ties: the higher threshold)."""
    pts = curve_points(df, label, score)
    best = pts.agg(F.max_by(F.struct("threshold", "f1", "precision", "tpr"), F.struct("f1", "threshold")).alias("b"))
    return best.select(
        F.col("b.threshold").alias("threshold"),
        F.col("b.f1").alias("f1"),
        F.col("b.precision").alias("precision"),
        F.col("b.tpr").alias("recall"),
    )


def gap_table(df: DataFrame, keys, predicted: str, actual: str) -> DataFrame:
    """Counts rounded half-to-even and clipped at 0; gap = predicted - actual."""
    p = clip_round_count(F.col(predicted))
    a = clip_round_count(F.col(actual))
    return df.select(*keys, p.alias("predicted_count"), a.alias("actual_count"), (p - a).alias("gap"))

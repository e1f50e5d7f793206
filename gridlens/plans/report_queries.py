"""Driver queries: report frames, splits and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlens.operators import datasets, metrics, report, split
from gridlens.plans.facility_queries import cell_rows, facility_rows
from gridlens.plans.oracle_sql import with_ctes
from gridlens.plans.registry import register, rounded
from gridlens.sources import bindings, tables


def cell_table(spark, sf_dir):
    return datasets.cell_features(cell_rows(spark, sf_dir))


def facility_table(spark, sf_dir):
    return datasets.facility_features(facility_rows(spark, sf_dir))


def gaps(spark, sf_dir):
    preds = bindings.cell_predictions(cell_table(spark, sf_dir))
    return metrics.gap_table(preds, ["lat_bin", "lon_bin"], "predicted", "actual")


_GAPS = """
gaps AS (
  SELECT lat_bin, lon_bin,
         CAST(greatest(0e0, round_even((park_count + sport_count + shopping_count) * 1.25e0
                                       + COALESCE(accessibility_rate, 0e0), 0)) AS BIGINT) AS predicted_count,
         CAST(greatest(0e0, round_even(CAST(toilet_count AS DOUBLE), 0)) AS BIGINT) AS actual_count
  FROM cell_features),
gap_t AS (SELECT lat_bin, lon_bin, predicted_count, actual_count, predicted_count - actual_count AS gap FROM gaps)"""

# ---------------------------------------------------------------- reports

_FEATURE_UNION = "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM cell_features" for c in datasets.CELL_FEATURES
)


@register(
    "feature_statistics",
    with_ctes(["cell_features"], """
SELECT feature, count(value) AS count, RND(avg(value)) AS mean, RND(stddev_samp(value)) AS std,
       RND(min(value)) AS min, RND(quantile_cont(value, 0.25)) AS p25, RND(quantile_cont(value, 0.5)) AS p50,
       RND(quantile_cont(value, 0.75)) AS p75, RND(max(value)) AS max
FROM long_features GROUP BY feature""", more="long_features AS (" + _FEATURE_UNION + ")"),
)
def q_feature_statistics(spark, sf_dir):
    return rounded(report.feature_statistics(cell_table(spark, sf_dir), datasets.CELL_FEATURES))


_FINGERPRINT_INT = ["lat_bin", "lon_bin", "toilet_count", "park_count", "sport_count", "shopping_count", "suburb_toilet_count"]
_FINGERPRINT_COLS = [
    "lat_bin", "lon_bin", "toilet_count", "avg_distance_to_center", "min_distance_to_center", "accessibility_rate",
    "avg_gender_encoded", "avg_category_encoded", "park_count", "sport_count", "shopping_count", "suburb_accessibility",
    "suburb_toilet_count",
]


def _field_sql(c):
    text = f"CAST({c} AS VARCHAR)" if c in _FINGERPRINT_INT else f"replace(printf('%a', RND({c})), 'p+', 'p')"
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE length({text}) || ':' || {text} END"


# floating features are rounded before they are hashed: their sums depend on the order of rows in the last bits
@register(
    "data_fingerprint",
    with_ctes(["cell_features"], f"""
SELECT count(*) AS "rows",
       CAST(COALESCE(sum(h), 0) % 281474976710656 AS BIGINT) AS fingerprint,
       lower(hex(CAST(COALESCE(sum(h), 0) % 281474976710656 AS BIGINT))) AS fingerprint_hex,
       '{','.join(_FINGERPRINT_COLS)}' AS columns
FROM (
  SELECT CAST(('0x' || substr(md5({' || '.join(map(_field_sql, _FINGERPRINT_COLS))}), 1, 12)) AS BIGINT) AS h
  FROM cell_features) t"""),
)
def q_data_fingerprint(spark, sf_dir):
    return report.data_fingerprint(rounded(cell_table(spark, sf_dir)))


@register(
    "class_balance",
    with_ctes(["facility_features"], """
SELECT is_accessible, count(*) AS n, RND(count(*) / sum(count(*)) OVER ()) AS share,
       count(*) OVER () AS n_classes
FROM facility_features GROUP BY is_accessible"""),
)
def q_class_balance(spark, sf_dir):
    return rounded(report.class_balance(facility_table(spark, sf_dir), "is_accessible"))


_SEV = """
sev AS (SELECT event_id, user_id, ts,
               CASE WHEN event_id % 307 <> 0 THEN CAST(event_type IN ('click', 'purchase') AS INTEGER) END AS label,
               CASE WHEN event_id % 211 <> 0 THEN value / (value + 50e0) END AS proba,
               CASE WHEN event_id % 211 <> 0 THEN CAST(value / (value + 50e0) >= 0.5e0 AS INTEGER) END AS predicted
        FROM events)"""


@register(
    "prediction_summary",
    with_ctes([], "SELECT count(*) AS n, RND(avg(CAST(predicted AS DOUBLE))) AS positive_share, "
                  "RND(avg(proba)) AS mean_proba FROM sev", more=_SEV),
)
def q_prediction_summary(spark, sf_dir):
    scored = metrics.with_threshold(bindings.scored_events(spark, sf_dir), "proba")
    return rounded(report.prediction_summary(scored, "predicted", "proba"))


@register("gap_table", with_ctes(["cell_features"], "SELECT * FROM gap_t", more=_GAPS))
def q_gap_table(spark, sf_dir):
    return gaps(spark, sf_dir)


@register(
    "gap_summary",
    with_ctes(["cell_features"], """
SELECT count(*) AS cells, count_if(gap > 0) AS cells_need_more, count_if(gap < 0) AS cells_oversupplied
FROM gap_t""", more=_GAPS),
)
def q_gap_summary(spark, sf_dir):
    return report.gap_summary(gaps(spark, sf_dir))


@register(
    "top_gaps",
    with_ctes(["cell_features"], "SELECT * FROM gap_t ORDER BY gap DESC, lat_bin, lon_bin LIMIT 10", more=_GAPS),
)
def q_top_gaps(spark, sf_dir):
    return report.top_by(gaps(spark, sf_dir), "gap", 10, ["lat_bin", "lon_bin"], descending=True)


@register(
    "bottom_gaps",
    with_ctes(["cell_features"], "SELECT * FROM gap_t ORDER BY gap ASC, lat_bin, lon_bin LIMIT 10", more=_GAPS),
)
def q_bottom_gaps(spark, sf_dir):
    return report.top_by(gaps(spark, sf_dir), "gap", 10, ["lat_bin", "lon_bin"], descending=False)


@register(
    "gap_histogram",
    with_ctes(["cell_features"], """
SELECT b.bin, RND(lo + b.bin * (hi - lo) / 50e0) AS bin_start, RND(lo + (b.bin + 1) * (hi - lo) / 50e0) AS bin_end,
       COALESCE(c.n, 0) AS n, (SELECT count(*) FROM gap_t WHERE gap IS NULL) AS n_other
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(0, 50)) b
CROSS JOIN st
LEFT JOIN (
  SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((gap - lo) / ((hi - lo) / 50e0)), 49) END AS INTEGER) AS bin,
         count(*) AS n
  FROM gap_t CROSS JOIN st GROUP BY 1) c ON b.bin = c.bin
WHERE lo IS NOT NULL""", more=_GAPS + ",\nst AS (SELECT CAST(min(gap) AS DOUBLE) AS lo, CAST(max(gap) AS DOUBLE) AS hi FROM gap_t)"),
)
def q_gap_histogram(spark, sf_dir):
    return rounded(report.histogram(gaps(spark, sf_dir), "gap", 50))


@register(
    "actual_vs_predicted",
    with_ctes(["cell_features"], """
SELECT actual_count AS actual, predicted_count AS predicted, count(*) AS n,
       (SELECT least(min(actual_count), min(predicted_count)) FROM gap_t) AS diag_min,
       (SELECT greatest(max(actual_count), max(predicted_count)) FROM gap_t) AS diag_max
FROM gap_t GROUP BY actual_count, predicted_count""", more=_GAPS),
)
def q_actual_vs_predicted(spark, sf_dir):
    return report.actual_vs_predicted(gaps(spark, sf_dir), "actual_count", "predicted_count")


# ---------------------------------------------------------------- splits

_HASH = "CAST(('0x' || substr(md5({text}), 1, 15)) AS BIGINT)"


def _h(seed, *cols):
    texts = [f"COALESCE(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in cols]
    return _HASH.format(text=" || ".join([f"'{seed}|'", *texts]))


# a fifth of the 60-bit hash range
_FIFTH = "CAST(0.2e0 * 1152921504606846976e0 AS BIGINT)"


@register(
    "hash_split",
    f"""
SELECT o_orderkey, o_orderstatus,
       CASE WHEN {_h(42, 'o_orderkey')} < {_FIFTH} THEN 'test' ELSE 'train' END AS split
FROM orders""",
)
def q_hash_split(spark, sf_dir):
    o = tables.load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return split.hash_split(o, ["o_orderkey"])


# orders with a status, some without one: NULL is a class of its own
_STATUS_SQL = "SELECT o_orderkey, CASE WHEN o_custkey % 29 <> 0 THEN o_orderstatus END AS status FROM orders"


def orders_with_status(spark, sf_dir):
    o = tables.load(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.when(F.col("o_custkey") % 29 != 0, F.col("o_orderstatus")).alias("status"))


@register(
    "stratified_split",
    f"""
SELECT o_orderkey, status,
       CASE WHEN row_number() OVER (PARTITION BY status ORDER BY {_h(42, 'o_orderkey')})
                 <= ceil(count(*) OVER (PARTITION BY status) * 0.2e0) THEN 'test' ELSE 'train' END AS split
FROM ({_STATUS_SQL}) o""",
)
def q_stratified_split(spark, sf_dir):
    return split.stratified_split(orders_with_status(spark, sf_dir), ["o_orderkey"], "status")


@register(
    "stratified_nested_split",
    f"""
WITH o AS ({_STATUS_SQL}),
first AS (
  SELECT *, row_number() OVER (PARTITION BY status ORDER BY {_h(42, 'o_orderkey')})
            <= ceil(count(*) OVER (PARTITION BY status) * 0.2e0) AS is_test FROM o),
rest AS (
  SELECT *, row_number() OVER (PARTITION BY status ORDER BY {_h(43, 'o_orderkey')})
            <= ceil(count(*) OVER (PARTITION BY status) * 0.2e0) AS is_valid FROM first WHERE NOT is_test)
SELECT o_orderkey, status, 'test' AS split FROM first WHERE is_test
UNION ALL SELECT o_orderkey, status, CASE WHEN is_valid THEN 'valid' ELSE 'train' END FROM rest""",
)
def q_stratified_nested_split(spark, sf_dir):
    return split.nested_split(orders_with_status(spark, sf_dir), ["o_orderkey"], stratify="status")


@register(
    "nested_split",
    f"""
SELECT o_orderkey,
       CASE WHEN {_h(42, 'o_orderkey')} < {_FIFTH} THEN 'test'
            WHEN {_h(43, 'o_orderkey')} < {_FIFTH} THEN 'valid' ELSE 'train' END AS split
FROM orders""",
)
def q_nested_split(spark, sf_dir):
    o = tables.load(spark, sf_dir, "orders").select("o_orderkey")
    return split.nested_split(o, ["o_orderkey"])


@register(
    "group_split",
    f"""
SELECT o_orderkey, o_custkey,
       CASE WHEN {_h(42, 'o_custkey')} < {_FIFTH} THEN 'test' ELSE 'train' END AS split
FROM orders""",
)
def q_group_split(spark, sf_dir):
    # customers are the groups: no customer has orders on both sides
    o = tables.load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return split.group_split(o, "o_custkey")


@register(
    "class_weights",
    f"""
SELECT o_orderkey, status,
       RND(CASE WHEN status IS NULL THEN 0e0
                ELSE count(status) OVER () / ((SELECT count(DISTINCT status) FROM ({_STATUS_SQL}) x)
                                              * count(*) OVER (PARTITION BY status)) END) AS weight
FROM ({_STATUS_SQL}) o""",
)
def q_class_weights(spark, sf_dir):
    return rounded(split.class_weights(orders_with_status(spark, sf_dir), "status"))


@register(
    "geo_cell_feature",
    with_ctes(["facility_rows"], """
SELECT "_id", grid_cell, CAST(cell_index AS DOUBLE) AS cell_index FROM (
  SELECT "_id", grid_cell FROM (
    SELECT "_id", CAST(lat_bin AS VARCHAR) || '_' || CAST(lon_bin AS VARCHAR) AS grid_cell FROM facility_rows) r) a
JOIN (
  SELECT grid_cell, row_number() OVER (ORDER BY count(*) DESC, grid_cell ASC) - 1 AS cell_index
  FROM (SELECT CAST(lat_bin AS VARCHAR) || '_' || CAST(lon_bin AS VARCHAR) AS grid_cell FROM facility_rows) r
  GROUP BY grid_cell) b USING (grid_cell)"""),
)
def q_geo_cell_feature(spark, sf_dir):
    from gridlens.operators.models import geo_cell_feature

    rows = facility_rows(spark, sf_dir)
    return geo_cell_feature(rows).select("_id", "grid_cell", "cell_index")


@register(
    "geo_cell_index",
    with_ctes(["facility_rows"], """
SELECT r."_id", r.lat_bin, r.lon_bin, CAST(i.cell_index AS DOUBLE) AS cell_index
FROM facility_rows r
JOIN (SELECT lat_bin, lon_bin, row_number() OVER (ORDER BY count(*) DESC, lat_bin, lon_bin) - 1 AS cell_index
      FROM facility_rows GROUP BY lat_bin, lon_bin) i
  ON r.lat_bin = i.lat_bin AND r.lon_bin = i.lon_bin"""),
)
def q_geo_cell_index(spark, sf_dir):
    from gridlens.operators.models import frequency_index

    rows = facility_rows(spark, sf_dir).select("_id", "lat_bin", "lon_bin")
    return frequency_index(rows).select("_id", "lat_bin", "lon_bin", "cell_index")


# ---------------------------------------------------------------- metrics


@register(
    "regression_metrics",
    """
WITH reg AS (SELECT l_quantity AS actual, l_extendedprice * 1e-3 AS predicted,
                    avg(l_quantity) OVER () AS mean_actual FROM lineitem WHERE l_orderkey % 199 <> 0)
SELECT count(*) AS n, RND(sqrt(avg((predicted - actual) * (predicted - actual)))) AS rmse,
       RND(avg(abs(predicted - actual))) AS mae,
       RND(1e0 - sum((predicted - actual) * (predicted - actual)) / sum((actual - mean_actual) * (actual - mean_actual))) AS r2,
       RND(quantile_cont(abs(predicted - actual), 0.5)) AS median_ae
FROM reg""",
)
def q_regression_metrics(spark, sf_dir):
    reg = bindings.lineitem_regression(spark, sf_dir)
    return rounded(metrics.regression_metrics(reg, "actual", "predicted"))


@register(
    "classification_metrics",
    with_ctes([], """
SELECT count(*) AS n, RND(avg(CAST(label = predicted AS DOUBLE))) AS accuracy,
       RND(CASE WHEN count_if(predicted = 1) = 0 THEN 0e0
                ELSE count_if(label = 1 AND predicted = 1) / count_if(predicted = 1) END) AS precision,
       RND(CASE WHEN count_if(label = 1) = 0 THEN 0e0
                ELSE count_if(label = 1 AND predicted = 1) / count_if(label = 1) END) AS recall,
       RND(CASE WHEN count_if(label = 1) + count_if(predicted = 1) = 0 THEN 0e0
                ELSE 2e0 * count_if(label = 1 AND predicted = 1) / (count_if(label = 1) + count_if(predicted = 1)) END) AS f1
FROM sev WHERE label IS NOT NULL AND predicted IS NOT NULL""", more=_SEV),
)
def q_classification_metrics(spark, sf_dir):
    scored = metrics.with_threshold(bindings.scored_events(spark, sf_dir), "proba")
    return rounded(metrics.classification_metrics(scored, "label", "predicted"))


@register(
    "threshold_predictions",
    with_ctes([], "SELECT event_id, RND(proba) AS predicted_proba, predicted AS predicted_label, label AS actual_label FROM sev",
              more=_SEV),
)
def q_threshold_predictions(spark, sf_dir):
    scored = metrics.with_threshold(bindings.scored_events(spark, sf_dir), "proba")
    return rounded(scored.select("event_id", F.col("proba").alias("predicted_proba"),
                                 F.col("predicted").alias("predicted_label"), F.col("label").alias("actual_label")))


@register(
    "confusion_matrix",
    with_ctes([], """
SELECT p.actual, p.predicted, COALESCE(c.n, 0) AS n
FROM (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(actual, predicted)) p
LEFT JOIN (SELECT label AS actual, predicted, count(*) AS n FROM sev GROUP BY 1, 2) c
  ON p.actual = c.actual AND p.predicted = c.predicted""", more=_SEV),
)
def q_confusion_matrix(spark, sf_dir):
    scored = metrics.with_threshold(bindings.scored_events(spark, sf_dir), "proba")
    return metrics.confusion_matrix(spark, scored, "label", "predicted")


_CURVE = _SEV + """,
ranked AS (SELECT * FROM sev WHERE label IS NOT NULL AND proba IS NOT NULL),
h AS (SELECT proba AS score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
      FROM ranked GROUP BY proba),
t AS (SELECT CAST(sum(label) AS BIGINT) AS "P", CAST(sum(1 - label) AS BIGINT) AS "N" FROM ranked),
c AS (SELECT h.*, sum(pos) OVER (ORDER BY score) AS cum_pos, sum(neg) OVER (ORDER BY score) AS cum_neg FROM h),
pts AS (
  SELECT score AS threshold, pos, neg,
         CAST("P" - (cum_pos - pos) AS BIGINT) AS tp, CAST("N" - (cum_neg - neg) AS BIGINT) AS fp,
         "P", "N", CAST(cum_neg - neg AS BIGINT) AS neg_below
  FROM c CROSS JOIN t),
curve AS (
  SELECT threshold, pos, neg, tp, fp,
         CASE WHEN "P" = 0 THEN 0e0 ELSE tp / "P" END AS tpr,
         CASE WHEN "N" = 0 THEN 0e0 ELSE fp / "N" END AS fpr,
         CASE WHEN tp + fp = 0 THEN 0e0 ELSE tp / (tp + fp) END AS precision,
         CASE WHEN tp + fp + "P" = 0 THEN 0e0 ELSE 2e0 * tp / (tp + fp + "P") END AS f1,
         "P", "N", neg_below
  FROM pts)"""


@register(
    "roc_auc",
    with_ctes([], """
SELECT RND(CASE WHEN max("P") = 0 OR max("N") = 0 THEN 0e0
                ELSE sum(pos * (neg_below + neg * 0.5e0)) / (max("P") * max("N")) END) AS roc_auc,
       RND(CASE WHEN max("P") > 0 THEN sum(pos * precision) / max("P") ELSE 0e0 END) AS pr_auc,
       max("P") AS positives, max("N") AS negatives
FROM curve""", more=_CURVE),
)
def q_roc_auc(spark, sf_dir):
    return rounded(metrics.auc_scores(bindings.scored_events(spark, sf_dir), "label", "proba"))


@register(
    "best_f1_threshold",
    with_ctes([], """
SELECT RND(threshold) AS threshold, RND(f1) AS f1, RND(precision) AS precision, RND(tpr) AS recall
FROM curve ORDER BY f1 DESC, threshold DESC LIMIT 1""", more=_CURVE),
)
def q_best_f1_threshold(spark, sf_dir):
    return rounded(metrics.best_f1_threshold(bindings.scored_events(spark, sf_dir), "label", "proba"))


@register(
    "pr_roc_curves",
    with_ctes([], """
SELECT RND(threshold) AS threshold, tp, fp, RND(tpr) AS tpr, RND(fpr) AS fpr, RND(precision) AS precision
FROM curve""", more=_CURVE),
)
def q_pr_roc_curves(spark, sf_dir):
    pts = metrics.curve_points(bindings.scored_events(spark, sf_dir), "label", "proba")
    return rounded(pts.select("threshold", "tp", "fp", "tpr", "fpr", "precision"))


_SCALE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register(
    "standard_scale",
    f"""
WITH li AS (
  SELECT l_orderkey, l_linenumber, {', '.join(_SCALE_COLS)},
         CASE WHEN {_h(42, 'l_orderkey', 'l_linenumber')} < {_FIFTH} THEN 'test' ELSE 'train' END AS split
  FROM lineitem),
st AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in _SCALE_COLS)} FROM li WHERE split = 'train')
SELECT l_orderkey, l_linenumber, split,
       {', '.join(f'RND(CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 0e0 ELSE ({c} - m_{c}) / s_{c} END) AS {c}' for c in _SCALE_COLS)}
FROM li CROSS JOIN st""",
)
def q_standard_scale(spark, sf_dir):
    from gridlens.operators.models import standardize

    li = tables.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_SCALE_COLS)
    li = split.hash_split(li, ["l_orderkey", "l_linenumber"])
    return rounded(standardize(li, _SCALE_COLS, fit_on=F.col("split") == "train"))


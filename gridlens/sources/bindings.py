"""Scored / run-shaped frames derived from the driver's tables.

The evaluation, report and table operators need predictions, labels, runs and
prediction tables.  These are derived from the test tables with fixed
formulas standing in for a model (no training needed to check the
operators); every row of the source table is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.sources.tables import load

# Fixed parameters of the stand-in predictors.
EVENT_POSITIVE = ["click", "purchase"]
EVENT_SCORE_SCALE = 50.0
LINEITEM_PRICE_SCALE = 1e-3


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, label (click/purchase = 1), proba = value / (value + 50); some
    events have no label, some no score."""
    ev = load(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        "user_id",
        "ts",
        F.when(F.col("event_id") % 307 != 0, F.col("event_type").isin(EVENT_POSITIVE).cast("int")).alias("label"),
        F.when(F.col("event_id") % 211 != 0, F.col("value") / (F.col("value") + F.lit(EVENT_SCORE_SCALE))).alias("proba"),
    )


def lineitem_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regression rows: actual = quantity (missing in some), predicted = extended
    price / 1000, run month = ship month."""
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_orderkey") % 199 != 0, F.col("l_quantity")).alias("actual"),
        (F.col("l_extendedprice") * F.lit(LINEITEM_PRICE_SCALE)).alias("predicted"),
        F.date_trunc("month", F.col("l_shipdate")).cast("timestamp_ntz").alias("run_month"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One evaluation run per ship month: id, experiment, metrics, parameters, tags, time, status."""
    reg = lineitem_regression(spark, sf_dir).filter(F.col("actual").isNotNull())
    e = F.col("predicted") - F.col("actual")
    sst = F.var_pop("actual") * F.count(F.lit(1))
    agg = reg.groupBy("run_month").agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        F.when(sst == 0, F.lit(None).cast("double")).otherwise(F.lit(1.0) - F.sum(e * e) / sst).alias("r2"),
    )
    month = F.month("run_month")
    params = {
        "n_estimators": F.element_at(F.array(F.lit(50), F.lit(100), F.lit(200)), (month % 3 + 1).cast("int")),
        "max_depth": (F.lit(4) + month % 4 * 2).cast("int"),
        "learning_rate": F.when(month % 2 == 0, F.lit(0.1)).otherwise(F.lit(0.2)),
    }
    agg = agg.withColumns(params)
    return agg.select(
        F.concat(F.lit("run_"), F.date_format("run_month", "yyyyMM")).alias("run_id"),
        F.lit("lineitem_quantity").alias("experiment_name"),
        F.lit("price_ratio").alias("model_version"),
        "rmse",
        "mae",
        "r2",
        "n",
        *params,
        F.to_json(F.struct(*params)).alias("params"),
        F.to_json(F.struct(F.lit("lineitem").alias("source"), F.col("n").alias("rows"))).alias("tags"),
        F.col("run_month").alias("trained_at"),
        F.when(F.col("n") >= 30, F.lit("success")).otherwise(F.lit("failed")).alias("status"),
    )


def run_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction rows keyed by (l_orderkey, l_linenumber, run_id)."""
    reg = lineitem_regression(spark, sf_dir)
    return reg.select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.lit("run_"), F.date_format("run_month", "yyyyMM")).alias("run_id"),
        "predicted",
        "actual",
    )


def cell_predictions(cells: DataFrame) -> DataFrame:
    """Stand-in count model on the cell feature table:
    predicted = 1.25 * (park + sport + shopping counts) + accessibility rate."""
    pred = (F.col("park_count") + F.col("sport_count") + F.col("shopping_count")) * F.lit(1.25) + F.coalesce(
        F.col("accessibility_rate"), F.lit(0.0)
    )
    return cells.select("lat_bin", "lon_bin", pred.alias("predicted"), F.col("toilet_count").cast("double").alias("actual"))

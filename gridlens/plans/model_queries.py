"""Driver queries: pyspark.ml training, scoring and model reports.

Model values have no SQL oracle (fitting is not SQL-expressible): the driver
records a rows-only check, and the unit tests check bounds, invariants and that
models beat the majority and mean baselines.
Inputs are the cell / facility feature tables derived from the test data, so
the training work grows with the data.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from gridlens.functions.columns import stable_hash
from gridlens.operators import datasets, metrics, models, networks, report, split
from gridlens.plans.facility_queries import cell_rows, facility_rows
from gridlens.plans.oracle_sql import with_ctes
from gridlens.plans.registry import register, rounded

CELL_KEYS = list(datasets.CELL_KEYS)
CELL_X = datasets.CELL_FEATURES
CELL_Y = datasets.CELL_TARGET
FAC_X = datasets.FACILITY_FEATURES
FAC_Y = datasets.FACILITY_TARGET

# The planned grid of hyper-parameters.
GRID = {"depths": [4, 6, 8, 10], "rates": [0.01, 0.05, 0.1, 0.2], "trees": [50, 100, 200]}


def model_root(spark):
    """Saved models live under the shared checkpoint folder, keyed by run id."""
    from gridlens.session import checkpoint_root

    return checkpoint_root(spark).rstrip("/") + "/gridlens-models"


def run_id_for(train, tag: str, pipeline) -> str:
    """Tag, fingerprint of the training data, digest of every parameter."""
    fp = report.data_fingerprint(train.drop("split")).first()["fingerprint_hex"]
    return f"{tag}_{fp}_{hashlib.md5(models.pipeline_params(pipeline).encode()).hexdigest()[:12]}"


def fit(spark, pipeline, train, tag):
    """Fit once per (training data, parameters); returns the saved copy."""
    return models.fit_cached(pipeline, train, model_root(spark), run_id_for(train, tag, pipeline))


def headline_regressor(spark, data):
    """The 100-tree regressor, trained once per training set and reused."""
    train = _train(data)
    pipe = models.gbt_regression_pipeline(CELL_X, CELL_Y)
    run_id = run_id_for(train, "gbt_regressor", pipe)
    model = models.fit_cached(pipe, train, model_root(spark), run_id)
    return model, run_id


def cell_model_data(spark, sf_dir):
    cells = datasets.cell_features(cell_rows(spark, sf_dir))
    prep = datasets.prepare(cells, CELL_X, CELL_Y, keys=CELL_KEYS)
    # sums of doubles differ in the last bits with the order of rows: model
    # inputs are rounded, so equal data has equal inputs and an equal run id.
    # read once per boosting iteration: cut the lineage to the feature rows
    return models.dealt_out(split.nested_split(rounded(prep), CELL_KEYS))


def facility_model_data(spark, sf_dir):
    fac = datasets.facility_features(facility_rows(spark, sf_dir))
    prep = datasets.prepare(fac, FAC_X, FAC_Y, keys=["_id"], integer_target=True)
    return models.dealt_out(split.stratified_split(rounded(prep), ["_id"], FAC_Y))


def _train(df):
    return df.filter(F.col("split") != "test")


def _test(df):
    return df.filter(F.col("split") == "test")


def _regression_report(model, data):
    rows = []
    for name, part in (("test", _test(data)), ("train", _train(data))):
        pred = model.transform(part)
        m = metrics.regression_metrics(pred, CELL_Y, "prediction")
        rows.append(m.select(F.lit(name).alias("split"), "*"))
    return rounded(rows[0].unionByName(rows[1]))


def _classifier_report(model, data):
    pred = models.positive_proba(model.transform(_test(data)))
    pred = metrics.with_threshold(pred, "proba", 0.5, "predicted")
    cls = metrics.classification_metrics(pred, FAC_Y, "predicted")
    auc = metrics.auc_scores(pred, FAC_Y, "proba")
    a = auc.select(F.struct(*auc.columns)).scalar()  # one row each side
    return rounded(cls.withColumns({c: a.getField(c) for c in auc.columns}))


@register("gbt_regression_metrics")
def q_gbt_regression_metrics(spark, sf_dir):
    data = cell_model_data(spark, sf_dir)
    model, _ = headline_regressor(spark, data)
    return _regression_report(model, data)


@register("scaled_glm_metrics")
def q_scaled_glm_metrics(spark, sf_dir):
    data = cell_model_data(spark, sf_dir)
    model = fit(spark, models.scaled_glm_pipeline(CELL_X, CELL_Y), _train(data), "poisson_glm")
    return _regression_report(model, data)


@register("gbt_classifier_metrics")
def q_gbt_classifier_metrics(spark, sf_dir):
    data = facility_model_data(spark, sf_dir)
    model = fit(spark, models.gbt_classifier_pipeline(FAC_X, FAC_Y), _train(data), "gbt_classifier")
    return _classifier_report(model, data)


@register("mlp_classifier_metrics")
def q_mlp_classifier_metrics(spark, sf_dir):
    data = facility_model_data(spark, sf_dir)
    model = fit(spark, models.mlp_classifier_pipeline(FAC_X, FAC_Y), _train(data), "mlp_classifier")
    return _classifier_report(model, data)


@register("logreg_baseline_metrics")
def q_logreg_baseline_metrics(spark, sf_dir):
    rows = facility_rows(spark, sf_dir).select(
        "_id",
        "distance_to_center",
        "gender_encoded",
        F.coalesce(F.col("Group"), F.lit("unknown")).alias("Group"),
        F.coalesce(F.col("Category"), F.lit("unknown")).alias("Category"),
        F.col("has_changing_place").cast("double").alias("has_changing_place"),
        F.col(FAC_Y).cast("int").alias(FAC_Y),
    )
    data = models.dealt_out(split.stratified_split(rows, ["_id"], FAC_Y))
    pipe = models.logreg_baseline_pipeline(["distance_to_center", "gender_encoded"], ["Group", "Category"],
                                           ["has_changing_place"], FAC_Y)
    return _classifier_report(fit(spark, pipe, _train(data), "logreg_baseline"), data)


@register("class_weighted_gbt_metrics")
def q_class_weighted_gbt_metrics(spark, sf_dir):
    data = models.dealt_out(split.class_weights(facility_model_data(spark, sf_dir), FAC_Y))
    model = fit(spark, models.gbt_classifier_pipeline(FAC_X, FAC_Y, weight_col="weight"), _train(data),
                "gbt_classifier_weighted")
    return _classifier_report(model, data)


@register("gbt_early_stopping")
def q_gbt_early_stopping(spark, sf_dir):
    data = facility_model_data(spark, sf_dir)
    data = models.dealt_out(split.nested_split(data.drop("split"), ["_id"], stratify=FAC_Y))  # train / valid / test
    fit_on = data.filter(F.col("split") != "test").withColumn("is_valid", F.col("split") == "valid")
    model = fit(spark, models.gbt_classifier_pipeline(FAC_X, FAC_Y, validation_col="is_valid"), fit_on,
                "gbt_early_stopping")
    part = lambda name: data.filter(F.col("split") == name)
    curve = models.iteration_curve(spark, model, part("train"), part("valid"), "logistic")
    trees = model.stages[-1].getNumTrees
    return rounded(curve.withColumn("trees_kept", F.lit(trees)))


@register("score_saved_model")
def q_score_saved_model(spark, sf_dir):
    data = cell_model_data(spark, sf_dir)
    # trained (or found) under a run id = fingerprint of its training data,
    # then loaded back by that id and applied to every cell
    _, run_id = headline_regressor(spark, data)
    loaded = models.load_model(model_root(spark), run_id)
    scored = loaded.transform(data)
    gaps = metrics.gap_table(scored, CELL_KEYS, "prediction", CELL_Y)
    return gaps.withColumns({"model_version": F.lit("gbt_regressor"), "run_id": F.lit(run_id)})


@register(
    "score_saved_model_actuals",
    with_ctes(["cell_features"], "SELECT lat_bin, lon_bin, CAST(toilet_count AS BIGINT) AS actual_count, "
                                 "true AS gap_is_the_difference FROM cell_features"),
)
def q_score_saved_model_actuals(spark, sf_dir):
    # what does not depend on the model: every cell is scored once, beside its own count
    gaps = q_score_saved_model(spark, sf_dir)
    same = F.col("gap") == F.col("predicted_count") - F.col("actual_count")
    return gaps.select("lat_bin", "lon_bin", "actual_count", same.alias("gap_is_the_difference"))


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    data = cell_model_data(spark, sf_dir)
    model, _ = headline_regressor(spark, data)
    return rounded(models.feature_importance(spark, model, CELL_X))


@register("iteration_curve")
def q_iteration_curve(spark, sf_dir):
    data = cell_model_data(spark, sf_dir)
    model, _ = headline_regressor(spark, data)
    return rounded(models.iteration_curve(spark, model, _train(data), _test(data), "squared"))


def _key_hash():
    return stable_hash(7, *CELL_KEYS)


def _is_test():
    return F.col("split") == "test"


@register("nn_classifier_epochs")
def q_nn_classifier_epochs(spark, sf_dir):
    data = facility_model_data(spark, sf_dir).drop("split")
    data = models.dealt_out(split.nested_split(data, ["_id"], stratify=FAC_Y))  # train / valid / test
    side = lambda name: F.col("split") == name
    settings = networks.Settings("classes", dropout=0.1)
    return rounded(networks.epoch_curve(data, FAC_X, FAC_Y, stable_hash(11, "_id"), side("train"), side("valid"), settings))


@register("nn_regression_epochs")
def q_nn_regression_epochs(spark, sf_dir):
    data = cell_model_data(spark, sf_dir)
    side = lambda name: F.col("split") == name
    settings = networks.Settings("numbers")
    return rounded(networks.epoch_curve(data, CELL_X, CELL_Y, _key_hash(), side("train"), side("valid"), settings))


@register("learning_curve")
def q_learning_curve(spark, sf_dir):
    data = cell_model_data(spark, sf_dir)
    return rounded(models.learning_curve(_train(data), CELL_X, CELL_Y, _key_hash()))


@register("param_grid")
def q_param_grid(spark, sf_dir):
    data = cell_model_data(spark, sf_dir)
    return rounded(models.param_grid_search(data, _is_test(), CELL_X, CELL_Y, _key_hash(), **GRID))


@register("feature_ablation")
def q_feature_ablation(spark, sf_dir):
    data = cell_model_data(spark, sf_dir)
    return rounded(models.feature_ablation(data, _is_test(), CELL_X, CELL_Y, _key_hash()))

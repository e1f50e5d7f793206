"""pyspark.ml operators: bounds and save / load (rows-only queries)."""

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.mark.parametrize("name", ["scaled_glm_metrics", "logreg_baseline_metrics", "mlp_classifier_metrics"])
def test_metric_bounds(spark, name):
    rows = E.queries()[name](spark, SF).collect()
    assert rows
    for r in rows:
        d = r.asDict()
        for k in ("accuracy", "f1", "roc_auc", "pr_auc", "precision", "recall"):
            if k in d and d[k] is not None:
                assert 0.0 <= d[k] <= 1.0
        if "r2" in d and d["r2"] is not None:
            assert d["r2"] <= 1.0
        if "rmse" in d:
            assert d["rmse"] >= 0.0


def test_saved_model_round_trip(spark, tmp_path):
    from gridlens.operators import models
    from gridlens.plans.model_queries import CELL_X, CELL_Y, cell_model_data

    data = cell_model_data(spark, SF)
    pipe = models.gbt_regression_pipeline(CELL_X, CELL_Y, {"n_estimators": 3, "max_depth": 2})
    m = pipe.fit(data)
    models.save_model(m, str(tmp_path), "r1")
    back = models.load_model(str(tmp_path), "r1")
    a = [r["prediction"] for r in m.transform(data).orderBy("lat_bin", "lon_bin").collect()]
    b = [r["prediction"] for r in back.transform(data).orderBy("lat_bin", "lon_bin").collect()]
    assert a == b


def test_merge_params():
    from gridlens.operators.models import GBT_CLASSIFIER_DEFAULTS, merge_params

    p = merge_params(GBT_CLASSIFIER_DEFAULTS, {"max_depth": 3})
    assert p["max_depth"] == 3 and p["n_estimators"] == 200


LARGER = "/root/testdata/sf0.01"


def test_classifiers_beat_the_majority(spark):
    from pyspark.sql import functions as F

    from gridlens.plans.model_queries import FAC_Y, _test, facility_model_data

    test = _test(facility_model_data(spark, LARGER))
    share = test.agg(F.avg(F.col(FAC_Y).cast("double"))).first()[0]
    row = E.queries()["logreg_baseline_metrics"](spark, LARGER).first()
    assert row["accuracy"] > max(share, 1 - share) + 0.05 and row["roc_auc"] > 0.7


def test_boosted_regression_beats_the_mean_and_its_curve_falls(spark, tmp_path):
    from gridlens.operators import metrics, models
    from gridlens.plans.model_queries import CELL_X, CELL_Y, _test, _train, cell_model_data

    data = cell_model_data(spark, LARGER)
    pipe = models.gbt_regression_pipeline(CELL_X, CELL_Y, {"n_estimators": 8, "max_depth": 4})
    model = models.fit_cached(pipe, _train(data), str(tmp_path), "r")
    assert metrics.regression_metrics(model.transform(_train(data)), CELL_Y, "prediction").first()["r2"] > 0.3
    curve = models.iteration_curve(spark, model, _train(data), _test(data), "squared").orderBy("iteration").collect()
    assert len(curve) == 8 and curve[-1]["train_loss"] < curve[0]["train_loss"]


def test_grid_counts_are_beginnings_of_one_model(spark):
    from gridlens.operators import models
    from gridlens.plans.model_queries import CELL_X, CELL_Y, _is_test, _key_hash, cell_model_data

    data = cell_model_data(spark, LARGER)
    grid = lambda trees: models.param_grid_search(data, _is_test(), CELL_X, CELL_Y, _key_hash(), [2], [0.1], trees)
    rows = grid([2, 4]).orderBy("n_estimators").collect()
    assert [(r["max_depth"], r["n_estimators"]) for r in rows] == [(2, 2), (2, 4)]
    alone = grid([2]).first()
    assert abs(rows[0]["rmse"] - alone["rmse"]) < 1e-9 and abs(rows[0]["r2"] - alone["r2"]) < 1e-9


def test_run_id_changes_with_any_parameter():
    from gridlens.operators.models import gbt_regression_pipeline, pipeline_params

    a, b = (gbt_regression_pipeline(["x"], "y", {"n_estimators": n}) for n in (3, 4))
    assert pipeline_params(a) != pipeline_params(b)
    assert pipeline_params(a) == pipeline_params(gbt_regression_pipeline(["x"], "y", {"n_estimators": 3}))


def test_a_saved_model_that_cannot_be_read_raises(spark, tmp_path):
    from gridlens.operators import models

    data = spark.createDataFrame([(float(i), float(i % 3)) for i in range(20)], "x double, y double")
    pipe = models.gbt_regression_pipeline(["x"], "y", {"n_estimators": 1, "max_depth": 1})
    models.fit_cached(pipe, data, str(tmp_path), "r")
    (tmp_path / "r").rename(tmp_path / "away")
    with pytest.raises(Exception):
        models.fit_cached(pipe, data, str(tmp_path), "r")


def test_two_classes_train_in_more_than_two_tasks(spark, monkeypatch):
    from pyspark.sql import functions as F

    from gridlens.operators import models, split

    monkeypatch.setattr(models, "LEAST_ROWS", 100)
    df = spark.range(0, 2000, 1, 3).select("id", (F.col("id") % 2).alias("y"))
    by_class = split.class_weights(split.stratified_split(df, ["id"], "y"), "y")
    n = min(20, spark.sparkContext.defaultParallelism)
    sizes = lambda data: [r["n"] for r in data.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    dealt = models.dealt_out(by_class)
    assert len(sizes(dealt)) == n and max(sizes(dealt)) <= 2000 / n + n and dealt.count() == 2000
    assert dealt.exceptAll(by_class).isEmpty()
    monkeypatch.setattr(models, "LEAST_ROWS", 2000)
    assert models.dealt_out(df).rdd.getNumPartitions() == 3


@pytest.mark.parametrize("name", ["facility_model_data", "cell_model_data"])
def test_model_rows_lie_in_equal_parts(spark, monkeypatch, name):
    from pyspark.sql import functions as F

    from gridlens.operators import models
    from gridlens.plans import model_queries

    monkeypatch.setattr(models, "LEAST_ROWS", 16)
    data = getattr(model_queries, name)(spark, SF)
    sizes = [r["n"] for r in data.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    most = max(sizes)
    assert len(sizes) == min(-(-sum(sizes) // 16), spark.sparkContext.defaultParallelism) and most - min(sizes) <= most / 2 + 3


def test_weighted_rows_are_dealt_out_again(spark, monkeypatch):
    from gridlens.operators import models
    from gridlens.plans import model_queries

    class Seen(Exception):
        pass

    def fit(_spark, _pipeline, train, _tag):
        raise Seen(train.rdd.getNumPartitions(), train.columns)

    monkeypatch.setattr(models, "LEAST_ROWS", 16)
    monkeypatch.setattr(model_queries, "fit", fit)
    with pytest.raises(Seen) as seen:
        E.queries()["class_weighted_gbt_metrics"](spark, SF)
    parts, columns = seen.value.args
    assert parts > 2 and "weight" in columns  # more than there are classes

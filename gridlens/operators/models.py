"""Model preparation, training, scoring and model-side reports on ``pyspark.ml``.

Training is distributed (``pyspark.ml`` estimators run on the executors); the
only things that reach the driver are model parameters and per-iteration /
per-feature numbers, all bounded by the model size, not the data size.

Re-aimed choices (the source trained single-machine libraries):
* boosted trees -> ``GBTRegressor`` / ``GBTClassifier``; where many models are
  compared (learning curve, grid, ablation) -> ``boosting``, all fits side by side
* neural classifier -> ``MultilayerPerceptronClassifier`` (sigmoid layers, L-BFGS)
* neural count regressor -> Poisson ``GeneralizedLinearRegression`` on scaled
  features (Spark ML has no MLP regressor)
* pickled scaler + model -> one ``PipelineModel`` saved by run id
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.functions.columns import HASH_BITS, grid_bin
from gridlens.operators.boosting import Fit, fit_scores
from gridlens.operators.ordered import join_null_safe, prefix_sums
from gridlens.session import materialize

# Default hyper-parameters of the two boosted-tree models.
GBT_REGRESSION_DEFAULTS = {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1,
                           "subsample": 0.8, "colsample_bytree": 0.8, "random_state": 42}
GBT_CLASSIFIER_DEFAULTS = {"n_estimators": 200, "max_depth": 5, "learning_rate": 0.1,
                           "subsample": 0.9, "colsample_bytree": 0.9, "random_state": 42}
MLP_HIDDEN = [64, 64]
MLP_MAX_ITER = 30
# Rows of a training task, about: so many at least before another core is used, so many at most.
LEAST_ROWS, MOST_ROWS = 16_384, 262_144


def merge_params(defaults: dict, given: dict | None) -> dict:
    """Hyper-parameters: defaults, overridden by the given values."""
    out = dict(defaults)
    out.update(given or {})
    return out


def _gbt_args(p: dict) -> dict:
    return {
        "maxIter": int(p["n_estimators"]),
        "maxDepth": int(p["max_depth"]),
        "stepSize": float(p["learning_rate"]),
        "subsamplingRate": float(p["subsample"]),
        "featureSubsetStrategy": str(p["colsample_bytree"]),
        "seed": int(p["random_state"]),
    }


def standardize(df: DataFrame, cols: Sequence[str], fit_on: Column | None = None) -> DataFrame:
    """(x - mean) / population std per column, statistics from the ``fit_on`` rows
    only (train), applied to all rows; a constant column scales to 0."""
    src = df.filter(fit_on) if fit_on is not None else df
    stats = src.agg(F.struct(*[F.avg(c).alias(f"m_{c}") for c in cols],
                             *[F.stddev_pop(c).alias(f"s_{c}") for c in cols])).scalar()  # one row, once
    scaled = {}
    for c in cols:
        m, s = stats.getField(f"m_{c}"), stats.getField(f"s_{c}")
        scaled[c] = F.when(s.isNull() | (s == 0), F.lit(0.0)).otherwise((F.col(c) - m) / s)
    return df.withColumns(scaled)


def geo_cell_feature(df: DataFrame, lat: str = "Latitude", lon: str = "Longitude", size: float | None = None,
                     out: str = "cell_index") -> DataFrame:
    """``grid_cell`` = "<lat_bin>_<lon_bin>" (cell size parameter) indexed as a
    categorical feature (most frequent cell first, ties by the text)."""
    if size is None:
        cell = F.concat_ws("_", F.col("lat_bin").cast("string"), F.col("lon_bin").cast("string"))
    else:
        cell = F.concat_ws("_", grid_bin(F.col(lat), size).cast("string"), grid_bin(F.col(lon), size).cast("string"))
    return frequency_index(df.withColumn("grid_cell", cell), ["grid_cell"], out)


def frequency_index(df: DataFrame, keys: Sequence[str] = ("lat_bin", "lon_bin"), out: str = "cell_index") -> DataFrame:
    """Dense 0-based index of each distinct key, most frequent first, ties by
    the keys ascending — a categorical encoding computed entirely on the
    executors (no label list on the driver, unlike a fitted ``StringIndexer``).

    The index is the rank in the order (count descending, keys), an exact
    prefix sum over ranges of that order; one count held by most keys is
    split like any other range."""
    counts = df.groupBy(*keys).agg((-F.count(F.lit(1))).alias("_less"), F.lit(1).alias("_one"))
    ranked = prefix_sums(counts, ["_less", *keys], ["_one"], distinct_order=True)
    index = ranked.select(*keys, (F.col("cum__one") - 1).cast("double").alias(out))
    return join_null_safe(df, index, list(keys), "left")


def dealt_out(df: DataFrame) -> DataFrame:
    """A table that every iteration of a fit reads: stored, and in equal parts over all cores.

    A join by class leaves the rows in as many parts as there are classes, and each pass
    over them runs in so many tasks.  A table that fits one part stays as it lies."""
    df = materialize(df)
    rows, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    if rows <= LEAST_ROWS:
        return df
    return materialize(df.repartition(min(-(-rows // LEAST_ROWS), cores * -(-rows // (cores * MOST_ROWS)))))


def assembler(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def gbt_regression_pipeline(features, label, params: dict | None = None) -> Pipeline:
    p = merge_params(GBT_REGRESSION_DEFAULTS, params)
    return Pipeline(stages=[assembler(features), GBTRegressor(labelCol=label, featuresCol="features", **_gbt_args(p))])


def gbt_classifier_pipeline(features, label, params: dict | None = None, weight_col: str | None = None,
                            validation_col: str | None = None) -> Pipeline:
    p = merge_params(GBT_CLASSIFIER_DEFAULTS, params)
    args = _gbt_args(p)
    if weight_col:
        args["weightCol"] = weight_col
    if validation_col:
        args["validationIndicatorCol"] = validation_col
    return Pipeline(stages=[assembler(features), GBTClassifier(labelCol=label, featuresCol="features", **args)])


def mlp_classifier_pipeline(features, label, seed: int = 42) -> Pipeline:
    return Pipeline(
        stages=[
            assembler(features, "raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
            MultilayerPerceptronClassifier(labelCol=label, featuresCol="features",
                                           layers=[len(features), *MLP_HIDDEN, 2], maxIter=MLP_MAX_ITER, seed=seed),
        ]
    )


def scaled_glm_pipeline(features, label) -> Pipeline:
    return Pipeline(
        stages=[
            assembler(features, "raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
            GeneralizedLinearRegression(labelCol=label, featuresCol="features", family="poisson", link="log",
                                        maxIter=50, regParam=1e-3),
        ]
    )


def logreg_baseline_pipeline(numeric, categorical, boolean, label) -> Pipeline:
    """Numeric as is, categorical -> index -> one-hot, boolean-ish -> 0/1 column
    (prepared by the caller), then logistic regression."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in categorical]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in categorical], outputCols=[f"{c}_ohe" for c in categorical],
                        handleInvalid="keep")
    feats = list(numeric) + list(boolean) + [f"{c}_ohe" for c in categorical]
    return Pipeline(stages=[*idx, ohe, assembler(feats), LogisticRegression(labelCol=label, featuresCol="features",
                                                                            maxIter=100)])


def positive_proba(predictions: DataFrame, out: str = "proba") -> DataFrame:
    return predictions.withColumn(out, vector_to_array(F.col("probability"))[1])


def save_model(model: PipelineModel, root: str, run_id: str) -> str:
    path = f"{root.rstrip('/')}/{run_id}"
    model.write().overwrite().save(path)
    return path


def load_model(root: str, run_id: str) -> PipelineModel:
    return PipelineModel.load(f"{root.rstrip('/')}/{run_id}")


def feature_importance(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(feature, importance) rows, most important first (bounded by #features)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), F.col("feature")
    )


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def fit_cached(pipeline: Pipeline, train: DataFrame, root: str, run_id: str) -> PipelineModel:
    """Load the model saved under ``root/run_id`` or fit, save and load it.

    ``run_id`` should identify the training data and all parameters, so the
    same inputs reuse the same model instead of training it again.  A model
    counts as saved once its marker is written; one that was saved but cannot
    be loaded raises.  The returned model is always the saved copy: it carries
    no training summary, which would otherwise pin the training session inside
    every scoring task."""
    spark = train.sparkSession
    marker = f"{root.rstrip('/')}/{run_id}.saved"
    if not _exists(spark, marker):
        save_model(pipeline.fit(train), root, run_id)
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(marker)
    return load_model(root, run_id)


def pipeline_params(pipeline: Pipeline) -> str:
    """All parameters of all stages, set or default, as one text in a fixed order."""
    out = []
    for i, stage in enumerate(pipeline.getStages()):
        values = {p.name: v for p, v in stage.extractParamMap().items()}
        out.append(f"{i}:{type(stage).__name__}:{sorted((k, str(v)) for k, v in values.items())}")
    return ";".join(out)


def _features(model: PipelineModel, data: DataFrame) -> DataFrame:
    return model.stages[0].transform(data) if len(model.stages) > 1 else data


def _losses(model: PipelineModel, data: DataFrame, loss: str | None) -> list[float]:
    gbt = model.stages[-1]
    feats = _features(model, data)
    try:
        return list(gbt.evaluateEachIteration(feats, loss) if loss else gbt.evaluateEachIteration(feats))
    except TypeError:  # the classifier takes no loss name
        return list(gbt.evaluateEachIteration(feats))


def iteration_curve(spark: SparkSession, model: PipelineModel, train: DataFrame, valid: DataFrame,
                    loss: str | None = None) -> DataFrame:
    """(iteration, train_loss, valid_loss) after each boosting iteration (the
    regressor takes a loss name; the classifier uses its own log loss).  One
    row per tree: bounded by the model."""
    pairs = zip(_losses(model, train, loss), _losses(model, valid, loss))
    rows = [(i + 1, float(a), float(b)) for i, (a, b) in enumerate(pairs)]
    return spark.createDataFrame(rows, "iteration int, train_loss double, valid_loss double")


def _boosted_params(params: dict | None = None) -> dict:
    p = merge_params(GBT_REGRESSION_DEFAULTS, params)
    return {"depth": int(p["max_depth"]), "rate": float(p["learning_rate"]), "trees": int(p["n_estimators"]),
            "subsample": float(p["subsample"]), "colsample": float(p["colsample_bytree"]), "seed": int(p["random_state"])}


def learning_curve(df: DataFrame, features: Sequence[str], label: str, key_hash: Column, params: dict | None = None,
                   sizes: Sequence[float] = tuple(i / 10 for i in range(1, 11)), folds: int = 5) -> DataFrame:
    """Mean training and validation R² of ``folds``-fold cross validation at each
    training size.  Sizes are nested ranges of the key hash (a row in the 10 %
    set is in every larger set) and a row's fold is a part of its hash too, so
    reruns pick the same rows.  The size x fold fits share one binned matrix
    and are grown side by side (see ``boosting``)."""
    fold = F.pmod(key_hash, F.lit(folds))
    fits = []
    for s in map(float, sizes):
        within = key_hash < F.lit(int(s * (1 << HASH_BITS)))
        fits += [Fit(f"{s}", within & (fold != k), within & (fold == k), tuple(features), **_boosted_params(params)) for k in range(folds)]
    # one name per size: its folds are averaged, each counted once
    fits = [replace(f, name=f"{f.name}|{i}") for i, f in enumerate(fits)]
    scores = fit_scores(df, fits, label, key_hash)
    r2 = lambda part: F.avg(F.when(F.col("part") == part, F.col("r2")))
    return scores.groupBy(F.substring_index("fit", "|", 1).cast("double").alias("train_size")).agg(
        r2("train").alias("train_r2"), r2("judge").alias("cv_r2"), F.count_if(F.col("part") == "judge").alias("folds")
    )


def param_grid_search(df: DataFrame, test: Column, features: Sequence[str], label: str, key_hash: Column, depths: Sequence[int],
                      rates: Sequence[float], trees: Sequence[int], base_params: dict | None = None) -> DataFrame:
    """RMSE and R² on the test rows for every combination of depth, rate and number of trees.

    Boosting adds trees one at a time, so the model of fewer trees is the
    beginning of the model of more: one fit per (depth, rate) gives all counts."""
    fits = [
        Fit(f"{d}|{r}", ~test, test, tuple(features),
            **_boosted_params({**(base_params or {}), "max_depth": d, "learning_rate": r, "n_estimators": max(trees)}))
        for d in depths for r in rates
    ]
    scores = fit_scores(df, fits, label, key_hash, trees).filter(F.col("part") == "judge")
    at = F.split("fit", "[|]")
    return scores.select(at[0].cast("int").alias("max_depth"), at[1].cast("double").alias("learning_rate"),
                         F.col("trees").alias("n_estimators"), "rmse", "r2")


def feature_ablation(df: DataFrame, test: Column, features: Sequence[str], label: str, key_hash: Column,
                     params: dict | None = None) -> DataFrame:
    """R² on the test rows with all features, and without each: ``dropped_feature``, ``r2``, ``r2_drop``."""
    sets = {"(none)": tuple(features)} | {f: tuple(c for c in features if c != f) for f in features}
    fits = [Fit(name, ~test, test, used, **_boosted_params(params)) for name, used in sets.items()]
    scores = fit_scores(df, fits, label, key_hash).filter(F.col("part") == "judge")
    scores = materialize(scores.select(F.col("fit").alias("dropped_feature"), "r2"))  # a row per fit
    whole = scores.filter(F.col("dropped_feature") == "(none)").agg(F.max("r2")).scalar()
    return scores.withColumn("r2_drop", whole - F.col("r2"))

"""The shared trainer of model selection: exact splits, the same trees for any layout and either path."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlens.operators import boosting, models


def frame(spark, n=600, parts=3, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b, c = (float(x) for x in rng.integers(0, 20, 3))
        rows.append((i, a, b if i % 17 else None, c, 3 * a + (5.0 if b > 9 else 0.0) + float(rng.normal())))
    rows += [(n, 1.0, 1.0, float("nan"), 4.0), (n + 1, 2.0, 2.0, 2.0, None)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double").repartition(parts)


def some_fits(trees=12):
    test = F.col("id") % 5 == 0
    of = lambda name, **k: boosting.Fit(name, ~test, test, k.pop("features", ("a", "b", "c")), trees=trees, **k)
    return [
        of("plain", depth=3),
        of("drawn", depth=4, subsample=0.7, colsample=0.7, rate=0.3),
        of("two", depth=2, features=("b", "c")),
        boosting.Fit("few", F.col("id") < 40, test, ("a",), depth=2, trees=trees),
        boosting.Fit("none", F.col("id") < 0, test, ("a",), depth=2, trees=2),
    ]


def trees_of(df, fits):
    m = boosting.Matrix(df, fits, "y", F.xxhash64("id"))
    return m, m.fit()


def test_trees_do_not_depend_on_layout_or_path(spark, monkeypatch):
    m, whole = trees_of(frame(spark), some_fits())
    scores = sorted(map(tuple, m.scores(whole, [1, 12]).collect()))
    monkeypatch.setattr(boosting, "TASK_ROWS", 0)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 50)
    monkeypatch.setattr(boosting, "BLOCKS_PER_PARTITION", 2)
    monkeypatch.setattr(boosting, "CUT", 5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        for parts in (1, 6):
            m, levels = trees_of(frame(spark, parts=parts), some_fits())
            assert levels[:-1] == whole[:-1]
            again = sorted(map(tuple, m.scores(levels, [1, 12]).collect()))
            assert [r[:4] for r in again] == [r[:4] for r in scores]
            assert np.allclose([r[4] for r in again], [r[4] for r in scores])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_the_first_split_is_the_best_of_all(spark):
    df = frame(spark)
    fit = boosting.Fit("stump", F.lit(True), F.lit(False), ("a", "c"), depth=1, rate=1.0, trees=1)
    m, [[tree]] = trees_of(df, [fit])
    rows = [(r["a"], np.inf if r["c"] != r["c"] else r["c"], r["y"]) for r in df.collect() if r["y"] is not None]
    y = np.array([r[2] for r in rows])
    best = min(
        (sum(((y[s] - y[s].mean()) ** 2).sum() for s in (x <= e, x > e)), i, e)
        for i, x in enumerate(np.array([[r[0] for r in rows], [r[1] for r in rows]]))
        for e in sorted(set(x))[:-1]
        if (x > e).any()
    )
    x = np.array([r[best[1]] for r in rows])
    assert tree.feature[0] == best[1] and m.edges[best[1]][tree.bin[0]] == best[2]
    means = [y[x <= best[2]].mean() - y.mean(), y[x > best[2]].mean() - y.mean()]
    assert np.allclose([tree.value[1], tree.value[2]], means, atol=1e-5)


def test_scores_follow_the_trees_and_beat_the_mean(spark):
    df = frame(spark)
    rows = boosting.fit_scores(df, some_fits(40), "y", F.xxhash64("id"), [1, 40]).collect()
    r2 = {(r["fit"], r["trees"], r["part"]): r["r2"] for r in rows}
    assert r2["plain", 40, "judge"] > 0.9 and r2["plain", 40, "train"] > r2["plain", 1, "train"]
    assert r2["two", 40, "judge"] < r2["plain", 40, "judge"]
    n = {(r["fit"], r["part"]): r["n"] for r in rows}
    assert n["plain", "judge"] + n["plain", "train"] == 601 and ("none", "train") not in n


@pytest.mark.parametrize("labels", [[], [None, None], [2.0, 2.0]])
def test_without_anything_to_learn(spark, labels):
    df = spark.createDataFrame([(i, float(i), y) for i, y in enumerate(labels)], "id long, a double, y double")
    fit = boosting.Fit("f", F.lit(True), F.lit(True), ("a",), trees=2)
    rows = boosting.fit_scores(df, [fit], "y", F.xxhash64("id")).collect()
    assert all(r["rmse"] == 0 and r["r2"] is None for r in rows) and len(rows) == (2 if labels == [2.0, 2.0] else 0)


def test_learning_curve_and_ablation_rows(spark):
    df = frame(spark)
    params = {"n_estimators": 5, "max_depth": 3}
    key = F.pmod(F.xxhash64("id"), F.lit(1 << 60))
    curve = models.learning_curve(df, ["a", "b", "c"], "y", key, params, sizes=(0.5, 1.0), folds=3).collect()
    assert sorted((r["train_size"], r["folds"]) for r in curve) == [(0.5, 3), (1.0, 3)]
    assert all(r["train_r2"] > r["cv_r2"] for r in curve)
    dropped = models.feature_ablation(df, F.col("id") % 5 == 0, ["a", "b", "c"], "y", key, params).collect()
    drop = {r["dropped_feature"]: r["r2_drop"] for r in dropped}
    assert drop["(none)"] == 0 and drop["a"] > 0.3 > drop["c"]

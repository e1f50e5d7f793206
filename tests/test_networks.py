"""The network trainer: gradients, layout, curves and the grouped AUC against plain computations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlens.operators import networks

def sides():
    return F.col("id") % 4 != 0, F.col("id") % 4 == 0


def frame(spark, n=500, parts=3):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        a, b = rng.normal(size=2)
        rows.append((i, float(a), float(b) if i % 19 else None, 1.0 if a * b > 0 else 0.0, float(2 * a + abs(b))))
    rows += [(n, float("nan"), float("inf"), 1.0, 0.0), (n + 1, 0.0, 0.0, None, None)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double").repartition(parts)


def curve(spark, kind, label, parts=3, **more):
    settings = networks.Settings(kind, hidden=(16, 8), rate=0.02, **({"epochs": 12} | more))
    out = networks.epoch_curve(frame(spark, parts=parts), ["a", "b"], label, F.xxhash64("id"), *sides(), settings)
    return out.orderBy("epoch").collect()


@pytest.mark.parametrize("kind", networks.KINDS)
def test_gradient_equals_finite_differences(kind):
    rng = np.random.default_rng(1)
    x, y, key = rng.normal(size=(7, 3)), rng.integers(0, 2, 7).astype(float), np.arange(7, dtype=np.uint64)
    net = networks.Network(3, networks.Settings(kind, hidden=(5, 4), dropout=0.3))
    flat = net.start() + rng.normal(0, 0.05, len(net.start()))  # no unit lies at its corner
    grad, _ = net.gradient(flat, x, y, key, 2)
    for i in range(0, len(flat), 3):
        near = [net.gradient(flat + np.eye(1, len(flat), i)[0] * e, x, y, key, 2)[1] for e in (-1e-6, 1e-6)]
        assert abs((near[1] - near[0]) / 2e-6 - grad[i]) < 1e-4


def test_a_row_drops_the_same_units_in_any_company():
    net = networks.Network(2, networks.Settings("numbers", hidden=(6,), dropout=0.5))
    x, y, key = np.ones((4, 2)), np.zeros(4), np.arange(4, dtype=np.uint64)
    whole, loss = net.gradient(net.start(), x, y, key, 1)
    parts = [net.gradient(net.start(), x[i : i + 1], y[i : i + 1], key[i : i + 1], 1) for i in range(4)]
    assert np.allclose(whole, sum(g for g, _ in parts)) and abs(loss - sum(p for _, p in parts)) < 1e-9
    assert len({round(p, 9) for _, p in parts}) > 1


def test_curves_do_not_depend_on_the_layout(spark, monkeypatch):
    one = curve(spark, "classes", "c", dropout=0.2, epochs=4)
    monkeypatch.setattr(networks, "BLOCK_ROWS", 40)
    monkeypatch.setattr(networks, "BLOCKS_PER_PARTITION", 1)
    monkeypatch.setattr(networks, "FAN_IN", 2)
    many = curve(spark, "classes", "c", parts=7, dropout=0.2, epochs=4)
    assert np.allclose([tuple(r) for r in one], [tuple(r) for r in many], atol=1e-6)


def test_classifier_and_regression_learn(spark):
    rows = curve(spark, "classes", "c")
    assert len(rows) == 12 and rows[-1]["train_loss"] < rows[0]["train_loss"] and rows[-1]["val_auc"] > 0.9
    y = np.array([r["y"] for r in frame(spark).filter(sides()[1]).collect() if r["y"] is not None])
    rows = curve(spark, "numbers", "y")
    assert rows[-1]["val_loss"] < 0.4 * y.std() and rows[-1]["val_loss"] < rows[0]["val_loss"]


def test_grouped_auc_equals_counting_pairs(spark):
    rng = np.random.default_rng(9)
    rows = [(g, float(rng.integers(0, 2)), float(rng.integers(0, 6))) for g in ("x", "y") for _ in range(40)] + [("z", 1.0, 0.5)]
    got = {r["g"]: r["auc"] for r in networks.grouped_auc(spark.createDataFrame(rows, "g string, y double, s double"), ["g"], "y", "s").collect()}
    for g in ("x", "y"):
        pos, neg = ([s for k, y, s in rows if k == g and y == v] for v in (1.0, 0.0))
        assert abs(got[g] - np.mean([(p > n) + (p == n) / 2 for p in pos for n in neg])) < 1e-12
    assert got["z"] is None


def test_without_rows_or_labels(spark):
    df = frame(spark)
    settings = networks.Settings("classes", epochs=2)
    args = (["a", "b"], "c", F.xxhash64("id"), *sides(), settings)
    assert networks.epoch_curve(df.limit(0), *args).count() == 0
    assert networks.epoch_curve(df.filter("c IS NULL"), *args).count() == 0
    one = networks.epoch_curve(df.filter("c = 1"), *args).collect()
    assert len(one) == 2 and all(r["val_auc"] is None and r["val_loss"] is not None for r in one)
    with pytest.raises(ValueError):
        networks.Settings("other")

"""Radix selection against numpy, for any values and any partitioning."""

import math

import numpy as np
from gridlens.operators import selection
from gridlens.operators.report import feature_statistics

PROBS = [0.0, 0.25, 0.5, 0.9, 1.0]


def quantiles(df, cols, probs=PROBS):
    return {(r["feature"], r["p"]): r["quantile"] for r in selection.column_quantiles(df, cols, probs).collect()}


def test_keys_sort_like_their_values_and_give_them_back(spark):
    rng = np.random.default_rng(3)
    raw = rng.integers(0, 2**63, 50_000, dtype=np.int64) * 2 + rng.integers(0, 2, 50_000)
    powers = [2.0**e for e in range(-1074, 1024)]
    edges = [0.0, -0.0, math.inf, -math.inf, math.nan, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308]
    values = np.concatenate([raw.view(np.float64), powers, np.nextafter(powers, 0), np.nextafter(powers, math.inf), edges])
    values = np.concatenate([values, -values])
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(8)
    keys = selection.ordered_keys(df, ["v"]).collect()
    back = np.array(sorted((selection.value_of(k) for (k,) in keys), key=lambda v: (math.isnan(v), v)))
    assert np.array_equal(back, np.sort(np.where(np.isnan(values), np.nan, values) + 0.0), equal_nan=True)
    by_key = [selection.value_of(k) for (k,) in sorted(keys)]
    assert np.array_equal(by_key, back, equal_nan=True)


def test_columns_of_all_magnitudes_equal_numpy(spark):
    rng = np.random.default_rng(7)
    cols = {
        "tiny": rng.normal(size=5000) * 1e-300,
        "wide": np.exp(rng.normal(size=5000) * 100) * rng.choice([-1.0, 1.0], 5000),
        "hot": np.where(rng.random(5000) < 0.4, 3.5, rng.normal(size=5000)),
        "zeros": rng.choice([0.0, -0.0, -1.0, 1.0], 5000),
        "close": 1.0 + rng.integers(0, 50, 5000) * 2.0**-52,
    }
    rows = list(zip(*(v.tolist() for v in cols.values()), strict=True))
    df = spark.createDataFrame(rows, list(cols))
    one, many = quantiles(df.coalesce(1), list(cols)), quantiles(df.repartition(13), list(cols))
    assert one == many
    for (c, p), got in one.items():
        want = np.quantile(cols[c], p)
        assert math.isclose(got, want, rel_tol=1e-12, abs_tol=1e-310), (c, p)


def test_nulls_infinities_and_nan(spark):
    inf = math.inf
    rows = [(None, -inf, 1.0), (2.0, 1.0, None), (4.0, inf, math.nan), (None, inf, math.nan)]
    got = quantiles(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"], [0.0, 0.5, 1.0])
    assert [got["a", p] for p in (0.0, 0.5, 1.0)] == [2.0, 3.0, 4.0]
    assert (got["b", 0.0], got["b", 1.0]) == (-inf, inf)
    assert got["c", 0.0] == 1.0 and math.isnan(got["c", 0.5]) and math.isnan(got["c", 1.0])


def test_more_columns_than_a_pass_takes(spark):
    n = selection.COLUMNS_A_PASS * 2 + 1
    df = spark.range(101).selectExpr(*[f"double(id * {i + 1}) as `c.{i}`" for i in range(n)])
    got = quantiles(df, df.columns, [0.5])
    assert got == {(f"c.{i}", 0.5): 50.0 * (i + 1) for i in range(n)}


def test_statistics_exchange_counts_not_values(spark):
    df = spark.range(20_000).selectExpr("id / 7.0d as a", "cast(null as double) as b", "-double(id) as c")
    out = feature_statistics(df, ["a", "b", "c"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    rows = {r["feature"]: r for r in out.collect()}
    assert rows["b"]["count"] == 0 and rows["b"]["p50"] is None and rows["b"]["mean"] is None
    assert rows["a"]["p25"] == np.quantile(np.arange(20_000) / 7.0, 0.25) and rows["c"]["min"] == -19_999.0

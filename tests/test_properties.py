"""Invariants: splits, fingerprints, bins, ordered statistics."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from gridlens.functions import columns as C
from gridlens.operators import ordered, report, split


def keys_df(spark, n=2000, parts=3):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 3).cast("int").alias("cls")).repartition(parts)


def test_hash_split_disjoint_complete_and_stable(spark):
    a = split.hash_split(keys_df(spark, parts=3), ["k"]).select("k", "split")
    b = split.hash_split(keys_df(spark, parts=7), ["k"]).select("k", "split")
    da = {r["k"]: r["split"] for r in a.collect()}
    db = {r["k"]: r["split"] for r in b.collect()}
    assert da == db and len(da) == 2000
    share = sum(v == "test" for v in da.values()) / len(da)
    assert 0.15 < share < 0.25


def test_stratified_split_exact_sizes(spark):
    out = split.stratified_split(keys_df(spark), ["k"], "cls").groupBy("cls", "split").count().collect()
    got = {(r["cls"], r["split"]): r["count"] for r in out}
    for c in range(3):
        n = sum(v for (cc, _), v in got.items() if cc == c)
        assert got[(c, "test")] == int(np.ceil(0.2 * n))


def test_group_split_no_group_on_both_sides(spark):
    df = spark.range(3000).select((F.col("id") % 97).alias("g"), F.col("id"))
    out = split.group_split(df, "g").groupBy("g").agg(F.countDistinct("split").alias("sides"))
    assert out.filter(F.col("sides") > 1).count() == 0


def test_fingerprint_order_and_partition_free(spark):
    df = spark.range(500).select("id", (F.col("id") * 0.5).alias("x"))
    f1 = report.data_fingerprint(df.repartition(2)).first()["fingerprint"]
    f2 = report.data_fingerprint(df.orderBy(F.desc("id")).repartition(5)).first()["fingerprint"]
    f3 = report.data_fingerprint(df.filter("id > 0")).first()["fingerprint"]
    assert f1 == f2 and f1 != f3


def test_bins_invariant_under_repartition(spark):
    df = spark.range(1000).select((F.col("id") * 0.0137 - 5).alias("x"))
    a = sorted(r[0] for r in df.repartition(2).select(C.grid_bin(F.col("x"), 0.01)).collect())
    b = sorted(r[0] for r in df.repartition(9).select(C.grid_bin(F.col("x"), 0.01)).collect())
    assert a == b


def test_prefix_sums_match_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 3000), "v": rng.integers(0, 400, 3000).astype(float),
                        "w": rng.integers(1, 5, 3000)})
    df = spark.createDataFrame(pdf)
    got = ordered.prefix_sums(df, "v", ["w"], ["g"]).toPandas()
    exp = pdf.copy()
    exp["cum_w"] = exp.apply(lambda r: pdf[(pdf.g == r.g) & (pdf.v <= r.v)].w.sum(), axis=1)
    m = got.sort_values(["g", "v", "w"]).reset_index(drop=True)
    e = exp.sort_values(["g", "v", "w"]).reset_index(drop=True)
    assert (m["cum_w"].values == e["cum_w"].values).all()


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(2)
    vals = rng.normal(size=1001).round(3)
    df = spark.createDataFrame(pd.DataFrame({"x": vals}))
    got = {r["p"]: r["quantile"] for r in ordered.exact_quantiles(df, "x", [0.25, 0.5, 0.75, 0.9]).collect()}
    for p in (0.25, 0.5, 0.75, 0.9):
        assert abs(got[p] - np.quantile(vals, p)) < 1e-12


def test_frequency_index_matches_pandas(spark):
    from gridlens.operators.models import frequency_index

    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.integers(-5, 5, 800), "b": rng.integers(-3, 3, 800)})
    got = frequency_index(spark.createDataFrame(pdf), ("a", "b")).select("a", "b", "cell_index").distinct().toPandas()
    cnt = pdf.groupby(["a", "b"]).size().reset_index(name="n")
    cnt = cnt.sort_values(["n", "a", "b"], ascending=[False, True, True]).reset_index(drop=True)
    cnt["exp"] = np.arange(len(cnt), dtype=float)
    m = cnt.merge(got, on=["a", "b"])
    assert len(m) == len(cnt) and (m["exp"] == m["cell_index"]).all()

"""Property tests (hypothesis, few examples: every example runs Spark jobs)."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gridlens.operators import ordered, report, upsert

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows = st.lists(st.tuples(st.integers(0, 20), st.sampled_from(["a", "b", "c", None])), min_size=0, max_size=40)


@SETTINGS
@given(cur=rows, batch=rows)
def test_upsert_idempotent_and_keyed(spark, cur, batch):
    c = spark.createDataFrame(cur, "k int, v string")
    b = spark.createDataFrame(batch, "k int, v string")
    once = upsert.upsert_latest(c, b, ["k"])
    twice = upsert.upsert_latest(once, b, ["k"])
    a1 = sorted(map(tuple, once.collect()), key=repr)
    assert a1 == sorted(map(tuple, twice.collect()), key=repr)
    keys = [k for k, _ in a1]
    assert len(keys) == len(set(keys)) == len({k for k, _ in cur} | {k for k, _ in batch})
    batch_keys = {k for k, _ in batch}
    for k, v in a1:
        if k in batch_keys:
            assert (k, v) in batch


@SETTINGS
@given(vals=st.lists(st.integers(-50, 50), min_size=1, max_size=60), seed=st.integers(0, 3))
def test_fingerprint_ignores_order(spark, vals, seed):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v int")
    shuffled = df.orderBy((df.v * (seed + 1)) % 7, df.i.desc()).repartition(seed + 1)
    assert report.data_fingerprint(df).first()["fingerprint"] == report.data_fingerprint(shuffled).first()["fingerprint"]


@SETTINGS
@given(vals=st.lists(st.integers(-1000, 1000), min_size=1, max_size=80),
       p=st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9, 1.0]))
def test_exact_quantile_equals_numpy(spark, vals, p):
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = ordered.exact_quantiles(df, "x", [p]).first()["quantile"]
    assert abs(got - float(np.quantile(np.array(vals, dtype=float), p))) < 1e-9

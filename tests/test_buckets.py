"""Upserts into tables bucketed on their keys: same rows as the plain upsert, and only the batch is exchanged."""

import random
import re
import uuid

import pytest

from gridlens.operators import upsert
from gridlens.session import scratch_path

COLS = "a int, b string, v int, x double"


def rows(rng, n, keys=8):
    return [(rng.randrange(keys), rng.choice("pq"), rng.choice([None, 1, 2, 3]), rng.choice([None, 0.5, 1.5])) for _ in range(n)]


def current_table(spark, rng, n):
    once = {(r[0], r[1]): r for r in rows(rng, n)}
    name = f"cur_{uuid.uuid4().hex[:8]}"
    upsert.write_bucketed(spark.createDataFrame(list(once.values()), COLS), name, scratch_path(spark, name), ["a", "b"], 4)
    return name


@pytest.mark.parametrize("seed,version", [(1, "v"), (2, "v"), (3, None)])
@pytest.mark.parametrize("sizes", [(30, 40), (0, 20), (20, 0)])
def test_equals_the_plain_upsert(spark, seed, version, sizes):
    rng = random.Random(seed)
    name = current_table(spark, rng, sizes[0])
    batch = spark.createDataFrame(rows(rng, sizes[1], keys=12), COLS).selectExpr("x", "b", "v", "a", "1 as more")
    want = upsert.upsert_latest(spark.table(name), batch.drop("more"), ["a", "b"], version_col=version)
    upsert.upsert_bucketed(name, batch, name + "_2", scratch_path(spark, name), ["a", "b"], 4, version)
    got = spark.table(name + "_2")
    assert got.columns == ["a", "b", "v", "x"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert upsert.pk_violations(got, ["a", "b"]).count() == 0


def test_the_current_side_is_not_exchanged(spark):
    name = current_table(spark, random.Random(5), 30)
    batch = spark.createDataFrame(rows(random.Random(6), 10), COLS)
    plan = upsert.merged_buckets(spark.table(name), batch, ["a", "b"], 4, "v")._jdf.queryExecution().executedPlan().toString()
    old, new = re.split(r"\n +\+- Sort \[_b0", plan.split("SortMergeJoin", 1)[1])
    assert "Bucketed: true" in old and "Exchange" not in old
    assert "Exchange" in new


def test_a_null_key_is_refused(spark):
    name = current_table(spark, random.Random(7), 10)
    batch = spark.createDataFrame([(None, "p", 1, 1.0)], COLS)
    with pytest.raises(Exception, match="NULL in a key column"):
        upsert.merged_buckets(spark.table(name), batch, ["a", "b"], 4).collect()

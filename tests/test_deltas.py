"""Signed deltas: every refresh equals the full rebuild."""

import random

from pyspark.sql import functions as F

from gridlens.operators import deltas

SCHEMA = "k int, g string, x long, v int"


def full(rows):
    """The best row per key, then count and sum per group."""
    best = {}
    for k, g, x, v in rows:
        rank = (v is None, -(v or 0), g is None, g or "", x is None, x or 0)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, g, x, v))
    out = {}
    for _, (_, g, x, _) in best.values():
        n, s = out.get(g, (0, 0))
        out[g] = (n + 1, s + x)
    return {r for _, r in best.values()}, out


def test_every_refresh_equals_the_rebuild(spark):
    rng = random.Random(6)
    key = lambda: None if rng.random() < 0.05 else rng.randrange(40)
    loads = [[(key(), rng.choice(["a", "b", "c", None]), rng.randrange(100), rng.choice([n, n, n - 1, None])) for _ in range(60)] for n in (1, 2, 3)]
    loads.append([])
    current, state, seen = spark.createDataFrame([], SCHEMA), None, []
    groups = {"g": F.col("g")}
    for load in loads:
        seen += load
        signed = deltas.signed_changes(current, spark.createDataFrame(load, SCHEMA), ["k"], "v")
        more = deltas.group_sums(signed, groups, {"x": F.col("x")})
        state = more if state is None else deltas.refreshed(state, [more], ["g"])
        state = spark.createDataFrame(state.collect(), state.schema)
        current = spark.createDataFrame(deltas.applied(current, signed, ["k"]).collect(), SCHEMA)
        rows, sums = full(seen)
        assert set(map(tuple, current.collect())) == rows
        assert {r["g"]: (r["n"], r["x"]) for r in state.collect()} == sums


def test_a_late_or_equal_row_changes_nothing(spark):
    now = spark.createDataFrame([(1, "a", 5, 2), (2, "b", 6, 2)], SCHEMA)
    late = spark.createDataFrame([(1, "z", 9, 1), (2, "b", 6, 2)], SCHEMA)
    assert deltas.signed_changes(now, late, ["k"], "v").count() == 0
    moved = deltas.signed_changes(now, spark.createDataFrame([(1, "c", 7, 3)], SCHEMA), ["k"], "v")
    assert sorted(map(tuple, moved.collect())) == [(1, "a", 5, 2, -1), (1, "c", 7, 3, 1)]


def test_an_emptied_group_goes(spark):
    state = spark.createDataFrame([("a", 1, 5), ("b", 2, 9)], "g string, n long, x long")
    more = spark.createDataFrame([("a", -1, -5), ("c", 1, 5)], "g string, n long, x long")
    assert sorted(map(tuple, deltas.refreshed(state, [more], ["g"]).collect())) == [("b", 2, 9), ("c", 1, 5)]

"""Whitening, ranked search and the Jaccard join against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from gridlens.llm import jaccard_join, ranked_search, whitening

from .cases import empty, pairs, prose, table

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
VECTORS = "vec_id long, embedding array<float>, label int, x int, w long, n long, z string, count int"


def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4, "z", 5) for i, v in rows], VECTORS).repartition(3)


def vectors(dim=10, n=400, seed=3):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, dim)) @ rng.normal(size=(dim, dim)) * 0.1
    rows = [(i, [float(c) for c in r]) for i, r in enumerate(data.astype(np.float32))]
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [rows[5], (None, rows[6][1])]
    bad = [None, [], [1.0] * (dim - 1) + [None], [float("nan")] * dim, [float("inf")] + [0.0] * (dim - 1), [0.5] * (dim + 1)]
    return rows, rows + [(2000 + i, v) for i, v in enumerate(bad)]


@pytest.mark.parametrize("weights", ["count", "one"])
def test_whitening_equals_a_plain_covariance(spark, weights):
    rows, with_bad = vectors()
    x = np.floor(1024 * np.array([v for _, v in rows], np.float64)).astype(np.int64) + 100_000
    fit = x if weights == "count" else np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    e, v = np.linalg.eigh(np.cov(fit.T.astype(float), bias=True))
    e, v = e[::-1][:8], v[:, ::-1][:, :8]
    want = {}
    for (i, _), r in zip(rows, x, strict=True):
        want.setdefault(i, []).append((sum((n * int(c) - int(t)) ** 2 for c, t in zip(r, s, strict=True)), (r - s / n) @ v / np.sqrt(e)))
    got = whitening.whitened(vector_table(spark, with_bad), weights=weights).collect()
    assert len(got) == len(rows) and Counter(r["vec_id"] for r in got) == Counter(i for i, _ in rows)
    flip = np.sign(np.array(got[0]["z"]) * want[got[0]["vec_id"]][0][1])
    for r in got:
        dev, z = want[r["vec_id"]][0]
        assert r["n"] == n and int(r["deviation"]) == dev
        assert np.allclose(np.array(r["z"]), z * flip, rtol=1e-9, atol=1e-9)
        assert np.allclose(r["explained"], e / np.trace(np.cov(fit.T.astype(float), bias=True)))
        assert 0 <= r["identity_error"] < 1e-9


def test_whitening_query_rows(spark):
    rows, with_bad = vectors()
    out = whitening.query(vector_table(spark, with_bad))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = out.collect()
    assert Counter(r["component"] for r in got) == {c: len(rows) for c in range(1, 9)}
    for c in range(1, 9):
        assert abs(np.mean([r["whitened"] ** 2 for r in got if r["component"] == c]) - 1) < 1e-9


def test_whitening_without_variance(spark):
    assert whitening.query(vector_table(spark, [])).count() == 0
    assert whitening.query(vector_table(spark, [(1, None), (2, [])])).count() == 0
    for rows in ([(1, [0.5, 1.0])], [(i, [0.5, 1.0]) for i in range(9)]):
        assert [r["z"] for r in whitening.whitened(vector_table(spark, rows)).collect()] == [[]] * len(rows)
        assert whitening.query(vector_table(spark, rows)).count() == 0
    # one direction only
    line = [(i, [i / 4, i / 2, 1.0]) for i in range(9)]
    assert {r["component"] for r in whitening.query(vector_table(spark, line)).collect()} == {1}
    # a square too large for 64 bits is still exact
    far = [(1, [1e6, 0.0]), (2, [-1e6, 1.0]), (3, [0.0, 2.0])] * 2000
    r = whitening.whitened(vector_table(spark, far)).where("vec_id = 1").first()
    assert int(r["deviation"]) == (6000 * 1_024_000_000) ** 2 + (6000 * 1024) ** 2


def brute_search(docs, items, k=10):
    cut = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    terms = lambda t: cut.findall((t or "").translate(A_TO_Z))
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, c, sum(c.values())) for i, c in bags if c]
    total, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    out = []
    for item, text in items:
        scored = []
        for at, (i, c, n) in enumerate(bags):
            m = 100 - 90 + (90 * n * total) // length
            score = 0
            for t in set(terms(text)):
                if c[t]:
                    score += math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, at))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i, _) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def queries_of(docs):
    rng = random.Random(4)
    texts = [t for _, t in docs if t and len(t) > 40]
    items = [(i, " ".join(rng.sample(rng.choice(texts).split(), 5)).upper()) for i in range(30)]
    items += [(30, None), (31, ""), (32, "qqqq zzzz"), (33, "the the of"), (34, rng.choice(texts)[:2000]), (35, "中文 ñ"), (36, "-.,")]
    return items + [(37, prose(rng, 60)), (38, texts[0])]


@pytest.mark.parametrize("postings,block", [(750_000, 500), (40, 7)])
def test_ranked_search_equals_brute_force(spark, monkeypatch, postings, block):
    monkeypatch.setattr(ranked_search, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", block)
    docs = table(spark)
    items = queries_of(pairs(docs))
    q = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, rid long, term int")
    got = sorted(map(tuple, ranked_search.query(docs, q).select("item_id", "rank", "doc_id", "score").collect()), key=repr)
    assert got == brute_search(pairs(docs), items)


def test_ranked_search_without_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "the water")], "item_id long, text string")
    assert ranked_search.query(table(spark), none).count() == 0
    assert ranked_search.query(empty(spark), some).count() == 0
    assert ranked_search.query(table(spark, [(1, None), (2, "")]), some).count() == 0


def test_best_positions_stop_before_the_lists_end():
    rng = np.random.default_rng(1)
    n = 4000
    term = np.repeat(np.arange(3), n)
    doc = np.concatenate([rng.permutation(n) for _ in range(3)])
    impact = np.concatenate([rng.zipf(1.5, n).clip(1, 10**6) for _ in range(3)]).astype(np.int64)
    lists = ranked_search.ImpactLists(term, doc, impact, n)
    found, score, reads = lists.best([0, 1, 2], 10, np.arange(n))
    whole = np.zeros(n, np.int64)
    np.add.at(whole, doc, impact)
    want = np.lexsort((np.arange(n), -whole))[:10]
    assert found.tolist() == want.tolist() and score.tolist() == whole[want].tolist()
    assert reads < n


def brute_jaccard(rows, percent=90, words=3):
    cut = re.compile(r"[^\x20\x09-\x0D]+")
    sets = []
    for _, t in rows:
        w = cut.findall((t or "").translate(A_TO_Z))
        sets.append({tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(top(i), []).append(rows[i][0])
    low = {g: min((d for d in ds if d is not None), default=None) for g, ds in groups.items()}
    return sorted([(d, len(sets[i]), low[top(i)]) for i, (d, _) in enumerate(rows)], key=repr)


def near_copies(seed=8):
    """Groups around the threshold, of many sizes, beside the awkward rows."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    rows = []
    for size in (3, 5, 9, 11, 12, 13, 20, 30, 31, 50, 80, 200, 400):
        base = [word() for _ in range(size)]
        rows.append(base)
        for edits in (1, 1, 2, 3, max(1, size // 60), max(1, size // 40)):
            w = list(base)
            for _ in range(edits):
                at = rng.randrange(len(w))
                kind = rng.random()
                w[at : at + 1] = [word()] if kind < 0.5 else [] if kind < 0.75 else [w[at], word()]
            rows.append(w)
        rows += [base[:-1], base + [word()], [x.upper() for x in base]]
    return [(10_000 + i, " ".join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize("percent,part,heap", [(90, 2048, 2048), (80, 3, 0)])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, percent, part, heap):
    monkeypatch.setattr(jaccard_join, "HEAP_ENTRIES", heap)
    rows = pairs(table(spark)) + near_copies()
    docs = table(spark, rows)
    got = sorted(map(tuple, jaccard_join.jaccard_groups(docs, percent, part=part).collect()), key=repr)
    want = brute_jaccard(rows, percent)
    assert got == want
    assert len({r[2] for r in want}) < len({r[1] for r in rows}) - 20  # links beside the copies


def test_jaccard_join_without_rows(spark):
    assert jaccard_join.query(empty(spark)).count() == 0


def test_linked_sets_share_a_part():
    rng = random.Random(1)
    for _ in range(3000):
        small = rng.randint(1, 60)
        big = rng.randint(small, jaccard_join.most_other(small, 90))
        room = (small + big) * 10 // 190
        both = max(-(-90 * (small + big) // 190), small - room)
        a = set(rng.sample(range(1 << 60), small))
        b = set(rng.sample(sorted(a), min(both, small))) | set(rng.sample(range(1 << 60), big - min(both, small)))
        assert 100 * len(a & b) >= 90 * len(a | b)
        if a == b:
            continue
        digests = []
        for s in (a, b):
            h = np.array(sorted(s), np.uint64)
            digests.append(set(jaccard_join.set_digests(h, 90, [1])))
        assert digests[0] & digests[1]

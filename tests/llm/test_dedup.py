"""Suffix-array dedup, exact dedup and SimHash against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from gridlens.llm import exact_dedup, fuse, simhash, suffix_array, suffix_dedup
from gridlens.llm.common import keep_rows
from gridlens.llm.components import components

from .cases import empty, pairs, table


def brute_removed(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[k : k + length] for _, t in data for k in range(len(t) - length + 1))
    out = []
    for i, t in data:
        cover = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                cover[k : k + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~cover[: len(t)]])
        spans = int((np.diff(np.append(False, cover).astype(int)) == 1).sum())
        out.append((i, len(t), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [4096, 1])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", hot)
    monkeypatch.setattr(suffix_dedup, "SCAN_BYTES", 5000)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 20_000)
    docs = table(spark)
    got = sorted(map(tuple, suffix_dedup.query(docs).collect()), key=repr)
    want = sorted(brute_removed(pairs(docs), suffix_dedup.LENGTH), key=repr)
    assert got == want
    assert any(r[2] for r in got) and any(r[3] == 1 and r[2] < r[1] for r in got)


def test_suffix_dedup_keeps_the_bytes_left_over(spark):
    docs = table(spark)
    for r in suffix_dedup.without_repeats(docs).where("n_removed > 0").collect():
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]
        assert sum(b - a for a, b in r["spans"]) == r["n_removed"]
    assert suffix_dedup.query(empty(spark)).count() == 0


def test_induced_sorting_and_permuted_prefixes():
    rng = random.Random(2)
    for _ in range(150):
        alphabet = rng.choice([b"a", b"ab", b"abc", bytes(range(256))])
        x = bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) * rng.choice([1, 3])
        data = np.frombuffer(x, np.uint8)
        order = suffix_array.sort_suffixes(np.append(data.astype(np.int64) + 1, 0), 257)[1:]
        want = sorted(range(len(x)), key=lambda i: x[i:])
        assert order.tolist() == want
        before, common = suffix_array.permuted_prefixes(data, order, 40)
        for j, i in zip(want, want[1:]):
            n = 0
            while n < 40 and max(i, j) + n < len(x) and x[i + n] == x[j + n]:
                n += 1
            assert before[i] == j and common[i] == n


def test_fuse_filter_holds_its_keys_and_few_others():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 10, 1000, 50_000):
        keys = np.unique(rng.integers(0, 2**60, n, dtype=np.uint64))
        f = fuse.build(keys)
        assert fuse.contains(f, keys).all()
        other = np.setdiff1d(rng.integers(0, 2**60, 20_000, dtype=np.uint64), keys)
        assert fuse.contains(f, other).mean() < 0.02
        if n == 50_000:
            assert len(f) < 1.35 * n


def test_exact_dedup_equals_grouping(spark):
    docs = table(spark)
    rows = pairs(docs)
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    got = exact_dedup.query(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = next(g for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        named = [i for i in ids if i is not None]
        assert r["group_size"] == len(ids) and r["keep_id"] == (max(named) if named else None)
        if r["kept"]:
            assert r["doc_id"] == r["keep_id"]
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == Counter({hashlib.sha256(t.encode()).hexdigest(): 1 for t in groups})
    assert exact_dedup.query(empty(spark)).count() == 0


def test_exact_dedup_of_a_large_batch_and_a_hot_digest(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BUCKET_KEYS", 50)
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", 20)
    rows = [(i, "hot") for i in range(300)] + [(1000 + i, f"text {i % 700}") for i in range(1000)]
    old, new = table(spark, rows[290:300] + rows[300:305]), table(spark, rows[:290] + rows[305:])
    size, keep = Counter(t for _, t in rows), {}
    for i, t in rows:
        keep[t] = max(i, keep.get(t, -1))
    got = sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup([old], new).collect())
    assert got == sorted((i, keep[t], size[t], keep[t] == i) for i, t in rows)
    # the batch is screened in many parts though the snapshot has one filter
    filters = exact_dedup.snapshot_filters(exact_dedup.digests(old).select("sha").distinct(), 1)
    incoming = exact_dedup.digests(new).select("sha").distinct()
    one, many = (sorted(r["sha"] for r in exact_dedup.screened(incoming, filters, 1, n).collect()) for n in (1, 14))
    assert one == many and hashlib.sha256(b"hot").hexdigest() in one


def test_exact_dedup_over_several_snapshots(spark):
    docs = table(spark)
    parts = [docs.where("doc_id % 3 = 0"), docs.where("doc_id % 3 = 1"), docs.where("doc_id % 3 = 2 OR doc_id IS NULL")]
    got = sorted(map(tuple, exact_dedup.exact_dedup(parts[:2], parts[2]).select("doc_id", "keep_id", "group_size").collect()), key=repr)
    assert got == sorted(map(tuple, exact_dedup.query(docs).select("doc_id", "keep_id", "group_size").collect()), key=repr)


def brute_fingerprint(text, words=3):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] if len(w) >= words else ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("part", [2048, 2])
def test_simhash_equals_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART", part)
    monkeypatch.setattr(simhash.links, "__defaults__", (3, part))
    docs = table(spark)
    rows = pairs(docs)
    fp = [brute_fingerprint(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 3:
                up[top(i)] = top(j)
    least = {}
    for n, (i, _) in enumerate(rows):
        least.setdefault(top(n), []).append(i)
    want = []
    for n, (i, _) in enumerate(rows):
        ids = [x for x in least[top(n)] if x is not None]
        want.append((i, f"{fp[n]:016x}", min(ids) if ids else None))
    got = [tuple(r) for r in simhash.query(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert simhash.query(empty(spark)).count() == 0


def test_links_join_close_fingerprints_through_chains(spark):
    rng = random.Random(4)
    values = set()
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            values.add(x)
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
    values = sorted(values)
    up = {v: v for v in values}

    def top(v):
        while up[v] != v:
            v = up[v]
        return v

    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= 3:
                up[top(b)] = top(a)
    signed = lambda v: v - 2**64 if v >> 63 else v
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    for part in (2048, 3):
        roots = {r["node"] % 2**64: r["root"] for r in components(simhash.links(fps, 3, part)).collect()}
        classes = defaultdict(set)
        for v in values:
            classes[roots.get(v, signed(v))].add(v)
        want = defaultdict(set)
        for v in values:
            want[top(v)].add(v)
        assert sorted(map(sorted, classes.values())) == sorted(map(sorted, want.values()))


def test_keep_rows_keeps_one_of_repeated_rows(spark):
    docs = table(spark)
    keys = docs.selectExpr("doc_id AS _k", "sha2(coalesce(text, ''), 256) AS _s").toDF("_id", "_sha")
    got = keep_rows(docs, keys)
    assert got.columns == docs.columns
    norm = lambda rows: sorted({(i, t or "") for i, t in rows}, key=repr)
    assert sorted([(i, t or "") for i, t in pairs(got)], key=repr) == norm(pairs(docs))

"""Quality classifier, decontamination, license scan and pseudo-likelihood."""

import random
import tracemalloc

import numpy as np
import pytest

from gridlens.llm import decontam, licenses, mlm, quality

from .cases import empty, pairs, prose, table

SF = "/root/testdata/sf0.01"


def test_quality_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality.query(docs, labels)
    assert scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").where("held_out").select("predicted", "quality", "score").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.93
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_quality_never_learns_from_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", (1 - labels.quality).cast("int")).where(quality.held_out()).unionByName(
        labels.withColumn("quality", labels.quality.cast("int")).where(~quality.held_out()), allowMissingColumns=True)
    assert quality.fit(quality.labelled_sample(docs, flipped)) == quality.fit(quality.labelled_sample(docs, labels))


@pytest.mark.parametrize("labelled", ["some", "one class", "none"])
def test_quality_of_awkward_rows(spark, labelled):
    docs = table(spark)
    rows = {"some": [(i, i % 2) for i in range(40)] + [(None, 1), (5, None)], "one class": [(i, 1) for i in range(40)], "none": []}[labelled]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    got = quality.query(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert quality.query(empty(spark), labels).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns


def edit_distance_in(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def edited(rng, text, edits):
    s = list(text)
    for _ in range(edits):
        i = rng.randrange(len(s))
        kind = rng.random()
        if kind < 0.4:
            s[i] = rng.choice("abcdefgh")
        elif kind < 0.7:
            s.insert(i, rng.choice("abcdefgh"))
        else:
            del s[i]
    return "".join(s)


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(8)
    items = [(i, prose(rng, n)) for i, n in enumerate([6, 12, 25, 40])] + [(9, "short"), (10, ""), (11, None), (None, prose(rng, 9))]
    rows = [(i, prose(rng, 15)) for i in range(6)] + [(100, None), (101, ""), (102, items[1][1])]
    for n, (i, t) in enumerate(items[:4]):
        k = decontam.budget(t)
        for m, e in enumerate((0, 1, k, k + 1, 2 * k)):
            rows.append((200 + 10 * n + m, prose(rng, 8) + "  " + edited(rng, t, e).upper() + "\n" + prose(rng, 8)))
    docs = table(spark, rows + [rows[8], (None, items[2][1])])
    bench = spark.createDataFrame(items + [items[0]], "item_id long, text string")
    want = []
    for i, t in pairs(docs):
        for j, item in items[:4]:
            d = edit_distance_in(decontam.normalise(item), decontam.normalise(t))
            if d <= decontam.budget(decontam.normalise(item)):
                want.append((i, j, d))
    got = [tuple(r) for r in decontam.query(docs, bench).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    clean = sorted(pairs(decontam.keep_clean(docs, bench)), key=repr)
    bad = {i for i, _, _ in want}
    assert clean == sorted([(i, t) for i, t in pairs(docs) if i not in bad], key=repr)
    assert decontam.query(empty(spark), bench).count() == 0
    assert decontam.keep_clean(docs, bench.limit(0)).count() == docs.count()


def test_decontamination_finds_short_items_at_word_borders(spark):
    items = [(1, "Paris"), (2, "What is  two?"), (3, "水は百度で沸騰しますか"), (4, "42"), (5, " "), (6, "c++"), (7, "a river in spring")]
    rows = [
        (1, "He said: PARIS, twice"), (2, "comparison of parishes"), (3, "so what is\ntwo? A number"), (4, "先生は水は百度で沸騰しますかと聞いた"),
        (5, "142 and 420 and 4.2"), (6, "(42)"), (7, "C++17 or c++ code"), (8, "paris\u0301"), (9, "a rivet in spring"), (10, "in A  River in Spring."),
        (11, "paris"), (12, "parisparis paris"), (13, None),
    ]
    docs, bench = table(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    want = [(1, 1, 0), (3, 2, 0), (4, 3, 0), (6, 4, 0), (7, 6, 0), (10, 7, 0), (11, 1, 0), (12, 1, 0)]
    assert sorted(map(tuple, decontam.query(docs, bench).collect())) == want
    assert sorted(i for i, _ in pairs(decontam.keep_clean(docs, bench))) == [2, 5, 8, 9, 13]


def test_decontamination_in_several_blocks(spark, monkeypatch):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = sorted(map(tuple, decontam.query(docs, bench).collect()))
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 3000)
    assert sorted(map(tuple, decontam.query(docs, bench).collect())) == want and want


def test_license_headers_and_inheritance(spark):
    rows = [
        (1, "a/LICENSE", "x y z\nReleased under the MIT License."),
        (2, "a/one.txt", "water and stone"),
        (3, "a/b/two.txt", None),
        (4, "a/b/three.py", "stone\nLicensed under the Apache License, Version 2.0.\nriver"),
        (5, "a/b/c/COPYING.txt", "This work is licensed under the GNU General Public License, version 3"),
        (6, "a/b/c/d/four", "under the river"),
        (7, "top.txt", "the license of the river"),
        (8, None, "river"),
        (9, "z/five", ""),
        (9, "z/five", ""),
        (None, "a/b/c/six", "water"),
    ]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string").selectExpr("*", "1 AS license", "2 AS folder")
    got = sorted((r["doc_id"] or 0, r["license"], r["found"], r["origin"]) for r in licenses.license_scan(files).collect() if r["doc_id"] != 9)
    assert got == [
        (0, "GPL-3.0", "inherited", "a/b/c"), (1, "MIT", "header", None), (2, "MIT", "inherited", "a"), (3, "MIT", "inherited", "a"),
        (4, "Apache-2.0", "header", None), (5, "GPL-3.0", "header", None), (6, "GPL-3.0", "inherited", "a/b/c"),
        (7, None, None, None), (8, None, None, None),
    ]
    assert licenses.license_scan(files).where("doc_id = 9 AND license IS NULL").count() == 2
    assert licenses.license_scan(files.limit(0)).count() == 0


def test_license_blocks_and_whole_texts(spark):
    rng = random.Random(4)
    whole = dict(licenses.full_texts())
    apache = "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License."
    texts = {
        "MIT": [
            "Copyright 2021 Example Inc. Released under the MIT License.", "This file is released under the terms of the MIT License.",
            "# Copyright 2020\n# Permission is hereby granted, free of charge, to any person\n# obtaining a copy of this software and\n# associated documentation files.\n",
            "The MIT License\n\nCopyright (c) 2021 Ann Other\n\n" + whole["MIT"], " ".join(whole["MIT"].split()),
        ],
        "CC-BY-NC-4.0": ["The text of this page is licensed under CC BY-NC 4.0.", prose(rng, 40) + " licensed under\nCC BY-NC 4.0 " + prose(rng, 40)],
        "Apache-2.0": ["/* Copyright 2019 Example\n * " + apache.replace("\n", "\n * ") + "\n */\nint main() {}", whole["Apache-2.0"]],
        "GPL-3.0": [whole["GPL-3.0"][:-1500], "// This program is free software: you can redistribute\n// it and/or modify it under the terms of the\n// GNU General Public License."],
        "BSD-3-Clause": ["Copyright 2022 Example\n" + whole["BSD-3-Clause"] + prose(rng, 60)],
        "MPL-2.0": [whole["MPL-2.0"][:15000]],
        "CC0-1.0": [whole["CC0-1.0"]],
        None: ["the license of the river", "released from under the stone", "public software is free", "a copy of the general terms"],
    }
    rows = [(name, t) for name, ts in texts.items() for t in ts] + [(name, "Copyright 2023 Example\n\n" + t) for name, t in whole.items()]
    files = [(i, f"f{i}/x", t) for i, (_, t) in enumerate(rows)] + [(100 + i, f"p{i}/x", prose(rng, 60)) for i in range(200)]
    got = {r["doc_id"]: r for r in licenses.license_scan(spark.createDataFrame(files, "doc_id long, path string, text string").repartition(3)).collect()}
    assert len(got) == len(files)
    assert {i: got[i]["license"] for i in range(len(rows))} == {i: name for i, (name, _) in enumerate(rows)}
    assert not any(r["license"] for i, r in got.items() if i >= 100)


def wrapped(text, width=70, mark="# "):
    out, line = [], ""
    for w in text.split():
        if len(line) + len(w) > width:
            out.append(mark + line)
            line = ""
        line = f"{line} {w}".strip()
    return "\n".join([*out, mark + line])


def test_gnu_headers_and_identifiers_keep_their_version(spark):
    rng = random.Random(12)
    later = (
        "This {thing} is free software; you can redistribute it and/or modify it under the terms of the GNU {family} Public License "
        "as published by the Free Software Foundation; either version {v} of the License, or (at your option) any later version."
    )
    rest = " This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY."
    only = "you can redistribute it and/or modify it under the terms of the GNU {family} Public License version {v} as published by the Free Software Foundation."
    rows = []
    for name, family, v in licenses.GNU:
        thing = "library" if name.startswith("L") else "program"
        for notice in (later, later + rest, only, "GNU {family} Public License version {v} only", "Licensed under the GNU {family} Public License, version {v}."):
            body = "Copyright (C) 2020 Some Body\n\n" + notice.format(thing=thing, family=family, v=v)
            rows.append((name, wrapped(body) + "\n" + prose(rng, 60)))
        rows += [(name, f"# SPDX-License-Identifier: {name}{end}\n" + prose(rng, 40)) for end in ("", "-only", "-or-later", "+")]
    rows += [(name, f"/* SPDX-License-Identifier: {name} */\n" + prose(rng, 40)) for name in licenses.IDENTIFIERS]
    plain = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License."
    rows += [("GPL-3.0", wrapped(plain) + "\n" + prose(rng, 60)), (None, "SPDX-License-Identifier: Other-1.0\n" + prose(rng, 30))]
    files = [(i, f"d{i}/f.txt", t) for i, (_, t) in enumerate(rows)] + [(100 + i, f"e{i}/f.txt", prose(rng, 90)) for i in range(40)]
    got = {r["doc_id"]: r["license"] for r in licenses.license_scan(spark.createDataFrame(files, "doc_id long, path string, text string").repartition(3)).collect()}
    assert {i: got[i] for i in range(len(rows))} == {i: name for i, (name, _) in enumerate(rows)}
    assert not any(name for i, name in got.items() if i >= 100)


def test_license_windows_equal_brute_force(spark):
    rng = random.Random(6)
    words = "licensed released under the mit license cc by 4.0 stone of river and terms".split()
    rows = [(i, f"{i}/x", " ".join(rng.choice(words) + rng.choice(["", "", ",", "\n"]) for _ in range(rng.randint(0, 25)))) for i in range(150)]
    templates = licenses.TEMPLATES[:2] + [x for x in licenses.TEMPLATES if x[0] == "CC-BY-4.0"][:1]
    n = len(rows)
    df = {}
    for _, _, t in rows:
        for w in set(licenses.terms(t)):
            df[w] = df.get(w, 0) + 1
    idf = lambda w: np.log((n + 1) / (df.get(w, 0) + 1)) + 1

    def vector(found):
        return {w: found.count(w) * idf(w) for w in found}

    def cosine(u, v):
        return sum(u[w] * v.get(w, 0) for w in u) / np.sqrt(sum(x * x for x in u.values()) * sum(x * x for x in v.values()))

    want = {}
    for i, _, t in rows:
        found, best = licenses.terms(t), 0
        for _, x in templates:
            size = len(licenses.terms(x))
            parts = [found] + [licenses.terms(line) for line in t.split("\n")]
            parts += [found[s : s + k] for k in (size, size + size // 4) for s in range(max(0, len(found) - k) + 1)]
            best = max([best] + [cosine(vector(licenses.terms(x)), vector(p)) for p in parts if p])
        want[i] = round(float(best), 9) if best >= licenses.THRESHOLD else None
    got = licenses.license_scan(spark.createDataFrame(rows, "doc_id long, path string, text string"), templates).collect()
    assert {r["doc_id"]: None if r["cosine"] is None else round(r["cosine"], 9) for r in got} == want
    assert 0 < sum(x is not None and x < 0.999 for x in want.values())


def test_license_cosine_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = pairs(docs)
    wanted = {t for _, x in licenses.TEMPLATES for t in licenses.terms(x)}
    held = {w: sum(w in set(licenses.terms(t or "")) for _, t in rows) for w in wanted}
    idf = lambda w: np.log((len(rows) + 1) / (held.get(w, 0) + 1)) + 1

    def vector(line):
        v = {}
        for w in licenses.terms(line):
            v[w] = v.get(w, 0) + idf(w)
        return v

    def cosine(u, v):
        return sum(u[w] * v.get(w, 0) for w in u) / np.sqrt(sum(x * x for x in u.values()) * sum(x * x for x in v.values()))

    templates = [(n, vector(x)) for n, x in licenses.TEMPLATES]
    want = {}
    for i, t in rows:
        best = max(((cosine(u, v), n) for line in (t or "").split("\n") if (v := vector(line)) for n, u in templates), default=(0, None))
        want[i] = round(float(best[0]), 9) if best[0] >= licenses.THRESHOLD else None
    got = licenses.query(docs).select("doc_id", "cosine").collect()
    assert {r["doc_id"]: None if r["cosine"] is None else round(r["cosine"], 9) for r in got} == want
    assert any(want.values())


def test_pseudo_likelihood_of_awkward_rows(spark):
    docs = table(spark)
    got = mlm.query(docs).collect()
    assert len(got) == docs.count()
    want = sorted((i if i is not None else -1, len(mlm.split(t or ""))) for i, t in pairs(docs))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"]) for r in got) == want
    assert all((r["log_prob"] < 0) == (r["n_words"] > 0) for r in got)
    assert mlm.query(empty(spark)).count() == 0


def test_pseudo_likelihood_tells_rare_words_apart(spark):
    frequent = [f"w{i}on" for i in range(1100)]
    texts = [" ".join(frequent[i : i + 100]) for i in range(0, 1100, 100)] * 6
    texts += ["w1on w2on xxthing w3on w4on"] * 4 + ["w1on w2on yything w3on w4on"]
    docs = table(spark, list(enumerate(texts)))
    vocab = mlm.vocabulary(mlm.word_counts(docs))
    assert set(vocab.words) == set(frequent)  # as many as the corpus has
    got = {r["doc_id"]: r["log_prob"] for r in mlm.query(docs).collect()}
    n = len(texts)
    assert abs(got[n - 2] - got[n - 1] - np.log(4)) < 1e-4


def test_pseudo_likelihood_is_a_distribution_and_learns():
    rng = random.Random(3)
    texts = ["the red fox runs over the green hill and the blue river " * 3 for _ in range(200)]
    words = sorted({w for t in texts for w in mlm.split(t)})
    size = 1 + len(words) + mlm.BUCKETS
    net, ids = mlm.Network(mlm.Code([1] * size)), mlm.Ids(words)
    around, target, _ = mlm.windows([mlm.numbers_of(ids, t) for t in texts])
    first = net.pass_(around, target, False).mean()
    for _ in range(60):
        net.pass_(around, target, True)
    assert net.pass_(around, target, False).mean() > first + 2
    shuffled = [" ".join(rng.sample(t.split(), len(t.split()))) for t in texts]
    a, t, _ = mlm.windows([mlm.numbers_of(ids, x) for x in shuffled])
    assert net.pass_(a, t, False).mean() < net.pass_(around, target, False).mean() - 0.5
    whole = sum(np.exp(net.pass_(np.repeat(around[:1], size, 0), np.arange(size), False)))
    assert abs(whole - 1) < 1e-3


def plain_log_prob(net, around, target):
    """The network's formula word by word."""
    p, code = net.parts, net.code
    out = []
    for ctx, word in zip(around, target, strict=True):
        h = np.append(np.tanh(sum(p["E"][o][w].astype(float) for o, w in enumerate(ctx))), 1)
        way = range(code.start[word], code.start[word + 1])
        out.append(sum(-np.log(1 + np.exp(-code.sign[i] * float(h @ p["U"][code.node[i]]))) for i in way))
    return np.array(out)


def test_frequent_words_have_short_ways_and_all_words_sum_to_one():
    code = mlm.Code([50, 1, 1, 20, 0, 7])
    steps = np.diff(code.start)
    assert steps.argmin() == 0 and steps[4] == steps.max()
    assert sum(2.0**-steps) == 1
    net = mlm.Network(code)
    around = np.repeat([[1, 2, 3, 0]], 6, 0)
    assert abs(np.exp(net.pass_(around, np.arange(6), False)).sum() - 1) < 1e-5
    assert np.allclose(net.pass_(around, np.arange(6), False), plain_log_prob(net, around, np.arange(6)), atol=1e-5)


def test_pseudo_likelihood_equals_a_plain_sum(spark):
    docs = table(spark, [(i, t) for i, t in pairs(table(spark)) if t is None or len(t) < 700])
    src = docs.selectExpr("doc_id", "coalesce(text, '') AS text")
    vocab = mlm.vocabulary(mlm.word_counts(src))
    total = sum(len(mlm.split(t or "")) for _, t in pairs(docs))
    flat = mlm.trained(mlm.encoded(src, vocab), total, vocab, mlm.started(src, vocab))
    net, ids = mlm.Network(vocab.code, flat), mlm.Ids(vocab.words)
    n = {r["word"]: r["n"] for r in mlm.word_counts(src).collect()}
    got = {(r["doc_id"], r["n_words"]): r["log_prob"] for r in mlm.query(docs).collect()}
    for i, t in pairs(docs)[:12]:
        around, target, _ = mlm.windows([mlm.numbers_of(ids, t or "")])
        rare = sum(np.log(n[w]) for w in mlm.split(t or "") if w not in vocab.words)
        want = plain_log_prob(net, around, target).sum() + vocab.share[target].sum() + rare
        assert abs(got[i, len(target)] - want) < 1e-3 * max(1, abs(want))


def test_pseudo_likelihood_does_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(mlm, "GROUP_WORDS", 4000)
    docs = table(spark)
    rows = [sorted((str(r["doc_id"]), r["n_words"], r["log_prob"]) for r in mlm.query(docs.repartition(n)).collect()) for n in (1, 5)]
    for a, b in zip(*rows, strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-4 * max(1, abs(a[2]))


def test_copies_are_averaged_by_their_words(spark, monkeypatch):
    monkeypatch.setattr(mlm, "FAN_IN", 2)
    rng = np.random.default_rng(2)
    copies = [(g, c, 10 + g, rng.normal(size=4).astype(np.float32)) for g in range(5) for c in range(3)]
    df = spark.createDataFrame([(g, c, n, bytearray(x.tobytes())) for g, c, n, x in copies], "g long, chunk long, n long, part binary")
    got = {r["chunk"]: np.frombuffer(r["part"], np.float32) for r in mlm._averaged(df, 5).collect()}
    for c in range(3):
        want = np.average([x for _, k, _, x in copies if k == c], axis=0, weights=[n for _, k, n, _ in copies if k == c])
        assert np.allclose(got[c], want, atol=1e-6)


def test_a_step_holds_few_pulls_at_a_time_and_sums_them_all():
    rng = np.random.default_rng(5)
    size = 3000
    code = mlm.Code(rng.zipf(1.3, size).clip(max=10**6).tolist())
    around = rng.integers(0, size, (mlm.STEP_WORDS, len(mlm.OFFSETS)))
    target = np.minimum(rng.zipf(1.3, mlm.STEP_WORDS), size) - 1
    net, was = mlm.Network(code), mlm.Network(code)
    tracemalloc.start()
    net.pass_(around, target, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    every = 4 * int(np.diff(code.start)[target].sum()) * (mlm.WIDTH + 1)  # the bytes of a step's pulls
    assert peak < 2 * every
    # the same step, pull by pull
    h = np.concatenate([np.tanh(sum(was.parts["E"][o][around[:, o]] for o in range(len(mlm.OFFSETS)))), np.ones((len(target), 1))], 1)
    steps = np.diff(code.start)[target]
    word = np.repeat(np.arange(len(target)), steps)
    at = np.concatenate([np.arange(code.start[t], code.start[t + 1]) for t in target])
    u = was.parts["U"][code.node[at]]
    pull = code.sign[at] / (1 + np.exp(code.sign[at] * (u * h[word]).sum(1)))
    want = {"U": np.zeros(was.shapes["U"]), "E": np.zeros(was.shapes["E"])}
    np.add.at(want["U"], code.node[at], -pull[:, None] * h[word])
    back = np.zeros((len(target), mlm.WIDTH))
    np.add.at(back, word, -pull[:, None] * u[:, : mlm.WIDTH])
    back *= 1 - h[:, : mlm.WIDTH] ** 2
    for o in range(len(mlm.OFFSETS)):
        np.add.at(want["E"][o], around[:, o], back)
    for name, g in want.items():
        g /= len(target)
        more = g * g
        seen = more > 1e-9  # under the start of the sums of squares, rounding shows
        step = was.parts[name] - mlm.RATE * g / np.sqrt(1e-6 + more)
        assert seen.sum() > 500 and np.allclose(net.parts[name][seen], step[seen], atol=2e-3)


def test_words_out_of_the_vocabulary_are_numbered_by_their_ending_and_not_kept(monkeypatch):
    monkeypatch.setattr(mlm, "ENDINGS", 3)
    ids = mlm.Ids(["fox", "hill"])
    for words in (["fox", "abcd", "hill", "xbcd", "fox"], [], ["o", "ab", "abc", "abd", "abe"], ["abcd", "hill"]):
        numbers, others = ids.of(words)
        assert others == [w for w in words if w not in ("fox", "hill")]
        assert numbers.dtype == np.uint16
        assert numbers.tolist() == [{"fox": 1, "hill": 2}.get(w, 3 + mlm.bucket(w)) for w in words]
    assert len(ids) == 2 and len(ids.endings) <= 3 + 5

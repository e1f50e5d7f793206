"""Token counts and SentencePiece against the libraries; sharding; the pipeline; what runs where."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from gridlens.llm import decontam, queries, quality, sharding, sp_codec, token_fst

from .cases import empty, pairs, table
from .test_dedup import brute_fingerprint

SF = "/root/testdata/sf0.01"
POOL = [
    "a", "É", "é", "ß", "İ", "Σ", "σ ς", "'s", "'ll", "'", "!!'s", "1", "²", "½", " ", " ", "  ", " " * 17, "\x1c", "\x85", "​", "\t\n", "中", "日本",
    "🙂", "<|endoftext|>", "<|startoftext|>", "the", "ing", "Straße", "ﬁ", "\x00", "﻿", "ก็", "٣", "　", "_", "DON'T", "ẛ̣", "가", "▁", "<0x0A>", "<s>", "<unk>", "ÿ",
]


def strings(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_token_counts_equal_the_library(spark):
    lib = Tokenizer.from_file(public_tokenizers.path(token_fst.TOKENIZER))
    docs = table(spark, pairs(table(spark)) + [(1000 + i, s) for i, s in enumerate(strings(300, 1))])
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_fst.query(docs).collect())
    want = []
    for i, t in pairs(docs):
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        want.append((str(i), len((t or "").encode()), n, n > 2048))
    assert got == sorted(want)
    assert token_fst.query(empty(spark)).count() == 0


def test_counts_do_not_depend_on_what_is_kept(monkeypatch):
    lib = Tokenizer.from_file(public_tokenizers.path(token_fst.TOKENIZER))
    monkeypatch.setattr(token_fst, "STATES", 30)
    monkeypatch.setattr(token_fst, "REMEMBERED", 20)
    t = token_fst.Tokenizer(public_tokenizers.path(token_fst.TOKENIZER))
    for s in [*strings(300, 7), "thing" * 400, "中" * 500]:
        assert t.count(s) == len(lib.encode(s, add_special_tokens=False).ids)


def test_chunk_maps_compose_to_the_whole():
    t = token_fst.tokenizer(public_tokenizers.path(token_fst.TOKENIZER))
    for s in strings(400, 2):
        assert {t.count(s, size) for size in (1, 2, 3, 7, 65_536)} == {t.count(s)}
    maps = [t.chunk(c) for c in ("ab", "c d", "e", " ", "fg h", "i")]
    whole = t.scan(maps)
    left = maps[0]
    for i, m in enumerate(maps[1:], 1):
        left = t.compose(left, m)
        assert whole[i] == left


def test_sentencepiece_equals_the_library(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sp_codec.MODEL))
    docs = table(spark, pairs(table(spark)) + [(1000 + i, s) for i, s in enumerate(strings(300, 3))])
    got = sp_codec.encoded(docs).select("text", "ids", "decoded").collect()
    assert len(got) == docs.count()
    for r in got:
        want = lib.encode(r["text"] or "")
        assert list(r["ids"]) == want and r["decoded"] == lib.decode(want)
    assert sp_codec.query(docs).where("NOT round_trip").count() == sum("▁" in (t or "") for _, t in pairs(docs))
    assert sp_codec.query(empty(spark)).count() == 0
    assert "ids" in sp_codec.encoded(docs).columns and sp_codec.encoded(docs).columns.count("ids") == 1


@pytest.mark.parametrize("table_size", [8192, 40])
def test_long_words_and_many_pieces(monkeypatch, table_size):
    monkeypatch.setattr(sp_codec, "TABLE", table_size)
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sp_codec.MODEL))
    own = sp_codec.Codec(public_tokenizers.path(sp_codec.MODEL))
    rng = random.Random(9)
    letters = [chr(c) for c in (*range(97, 123), *range(0x4E00, 0x4E40), 0x1F642, 0xE9, 0x7F)]
    texts = ["".join(rng.choice(letters) for _ in range(n)) for n in (150, 199, 200, 201, 5000, 40_000)] + ["x" * 3000, "a b " + "thing" * 500, ""]
    ids, bounds = own.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == lib.encode(texts)
    assert own.decode(ids, bounds) == texts


@pytest.mark.parametrize("lane_rows", [100_000, 7])
def test_shards_are_exact_and_gapless(spark, monkeypatch, lane_rows):
    monkeypatch.setattr(sharding, "LANE_ROWS", lane_rows)
    monkeypatch.setattr(sharding, "BLOCK", 10)
    docs = table(spark, pairs(table(spark)) + [(77, "one row many times")] * 45)
    rows = sharding.query(docs).collect()
    assert len(rows) == docs.count()
    sizes = Counter(r["shard"] for r in rows)
    assert [sizes[i] for i in range(24)] == sharding.shard_sizes(len(rows), 24)
    for s in range(24):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
    want = sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in pairs(docs))
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == want
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}
    key = lambda r: (str(r["doc_id"]), r["text_crc32"], r["shard"], r["slot"])
    assert sorted(map(key, rows)) == sorted(map(key, sharding.query(docs.repartition(5)).collect()))
    assert sharding.query(empty(spark)).count() == 0


def test_matrix_has_its_margins_and_its_law():
    lanes, sizes = [5, 0, 17, 8], [8, 8, 7, 7]
    draws = np.array([sharding.draw_matrix(lanes, sizes, seed) for seed in range(2000)])
    assert (draws.sum(2) == lanes).all() and (draws.sum(1) == sizes).all()
    mean = np.outer(lanes, sizes) / 30
    spread = mean * (30 - np.array(lanes)[:, None]) / 29 * (1 - np.array(sizes) / 30)
    assert np.abs(draws.mean(0) - mean).max() < 0.15 and np.abs(draws.var(0) - spread).max() < 0.3


def test_large_populations_follow_the_same_law(monkeypatch):
    rng = np.random.default_rng(5)
    big = [sharding._univariate(rng, 4 * 10**9, 90 * 10**9, 1000) for _ in range(4000)]
    assert abs(np.mean(big) - 1000 * 4 / 94) < 0.4 and abs(np.var(big) - 1000 * 4 / 94 * 90 / 94) < 4
    monkeypatch.setattr(sharding, "NUMPY_LIMIT", 0)
    draws = np.array([[sharding._univariate(rng, 8, 22, 17), sharding._univariate(rng, 22, 8, 17)] for _ in range(8000)])
    assert draws[:, 0].min() >= 0 and draws[:, 0].max() <= 8 and draws[:, 1].min() >= 9
    assert abs(draws[:, 0].mean() - 17 * 8 / 30) < 0.06
    assert abs(draws[:, 0].var() - 17 * 8 / 30 * 22 / 30 * 13 / 29) < 0.08


def test_shards_stay_native(spark):
    plan = sharding.query(table(spark))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [(r["item_id"], decontam.normalise(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    score = quality.Scorer(quality.fit(quality.labelled_sample(docs, labels))).score
    rows = [(i, t) for i, t in pairs(docs) if score(t or "") >= 0.5]
    last = {}
    for i, t in sorted(rows):
        last[t or ""] = i
    rows = sorted((i, t) for t, i in last.items())
    fp = [brute_fingerprint(t) for _, t in rows]
    kept, group = [], list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 3 and top(i) != top(j):
                group[max(top(i), top(j))] = min(top(i), top(j))
    kept = [r for n, r in enumerate(rows) if top(n) == n]
    matcher = decontam.Matcher(items)
    kept = [(i, t) for i, t in kept if not any(True for _ in matcher.find(decontam.normalise(t)))]
    got = corpus_pipeline.run(spark, SF)
    assert got.columns[: len(docs.columns)] == docs.columns
    assert sorted(pairs(got)) == sorted(kept)
    assert got.where("round_trip").count() == len(kept) < docs.count()


def test_pipeline_of_awkward_rows(spark, tmp_path):
    table(spark).write.parquet(f"{tmp_path}/some/documents.parquet")
    empty(spark).write.parquet(f"{tmp_path}/none/documents.parquet")
    for d in ("some", "none"):
        spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{d}/labels.parquet")
        spark.createDataFrame([(1, "an item that is in no document at all")], "item_id long, text string").write.parquet(f"{tmp_path}/{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/some/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, f"{tmp_path}/some").columns == docs.columns
    assert corpus_pipeline.run(spark, f"{tmp_path}/some").count() > 20
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_every_operator_has_one_query():
    names = sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())

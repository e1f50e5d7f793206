"""Removal of long repeated strings with sharded suffix arrays.

Every window of ``LENGTH`` bytes is dealt to a shard by its anchor: the place in
it whose short gram has the least hash.  Equal windows have the same anchor gram
at the same offset, so they meet in one shard.  Neighbouring windows with the
same anchor stay together as one context.  Anchors that occur once hold no
repeats; equal contexts are counted without their bytes.  Where one anchor gram
has different contexts, the bytes of each are fetched once and the shard's
suffix array is built by induced sorting; permuted common prefixes of at least
``LENGTH`` mark the repeated windows.  Spans then go back to the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from gridlens.llm.common import prepare, rows_of, shuffle_width, stored, text_or_empty
from gridlens.llm.suffix_array import permuted_prefixes, sort_suffixes

LENGTH = 400
GRAM = 64
# Bytes of a text that anchors are computed for at once, and of contexts in one suffix array.
SCAN_BYTES = 1_500_000
SHARD_BYTES = 1_000_000
# An anchor gram with more different contexts than this has its windows dealt out by their digests instead.
HOT_CONTEXTS = 4096
_BREAK = 0xFF  # does not occur in UTF-8


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes (a power of two) from each position, by doubling."""
    h = _mix(data.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    step = 1
    while step < size:
        h = _mix(h[:-step] * np.uint64(0xA24BAED4963EE407) + h[step:])
        step *= 2
    return h


def leftmost_minima(h: np.ndarray, width: int) -> np.ndarray:
    """The position of the least value, the leftmost of ties, among ``width`` from each position."""
    value, at = h, np.arange(len(h), dtype=np.int32)
    have = 1
    while have < width:
        step = min(have, width - have)
        left, right = value[:-step], value[step:]
        later = right < left
        value = np.where(later, right, left)
        at = np.where(later, at[step:], at[:-step])
        have += step
    return at


def contexts(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchors of texts that lie one after the other: (text number, gram hash, first window, windows, digest of the bytes)."""
    width = LENGTH - GRAM + 1
    if len(data) < LENGTH:
        return
    h = gram_hashes(data, GRAM)
    anchor = leftmost_minima(h, width)
    window = np.arange(len(anchor))
    text = np.searchsorted(ends, window, "right")
    valid = window + LENGTH <= ends[text]
    window, anchor, text = window[valid], anchor[valid], text[valid]
    if not len(window):
        return
    new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])))
    first, count = window[new], np.diff(np.append(new, len(window)))
    raw = data.tobytes()
    digest = np.fromiter(
        (xxh3_64_intdigest(raw[a:b]) for a, b in zip(first.tolist(), (first + count + LENGTH - 1).tolist())), np.uint64, len(first)
    )
    yield text[new], h[anchor[new]], first, count, digest


def _scan(src: DataFrame, id_type: str) -> DataFrame:
    """``(doc_id, t, key, ctx, first, windows)`` for each anchor of each text; ``first`` is a byte offset."""
    names = ["doc_id", "t", "key", "ctx", "first", "windows"]

    def block(b: pa.RecordBatch, rows: list[int], texts: list[bytes], offsets: list[int]) -> Iterator[pa.RecordBatch]:
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        for text, key, first, count, digest in contexts(data, ends):
            row = pa.array(np.array(rows, np.int64)[text])
            local = first - (ends - [len(t) for t in texts])[text] + np.array(offsets, np.int64)[text]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(row), b.column(1).take(row), pa.array(key.view(np.int64)), pa.array(digest.view(np.int64)),
                 pa.array(local.astype(np.int64)), pa.array(count.astype(np.int32))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, texts, offsets, size = [], [], [], 0
            for i, t in enumerate(b.column(2)):
                t = t.as_py()
                # a long text is scanned in parts that overlap by one window less a byte
                for at in range(0, max(1, len(t) - LENGTH + 1), SCAN_BYTES):
                    part = t[at : at + SCAN_BYTES + LENGTH - 1]
                    rows.append(i)
                    texts.append(part)
                    offsets.append(at)
                    size += len(part)
                    if size >= SCAN_BYTES:
                        yield from block(b, rows, texts, offsets)
                        rows, texts, offsets, size = [], [], [], 0
            if rows:
                yield from block(b, rows, texts, offsets)

    schema = f"doc_id {id_type}, t long, key long, ctx long, first long, windows int"
    return src.select("doc_id", "t", "data").mapInArrow(run, schema)


def repeated_windows(parts: list[tuple[int, bytes]]) -> list[np.ndarray]:
    """For contexts ``(windows, bytes)``: which of the windows of each start anywhere else too.

    One suffix array over all of them, separated by a byte that no text holds.
    """
    gap = np.full(1, _BREAK, np.uint8)
    pieces = [x for _, raw in parts for x in (np.frombuffer(raw, np.uint8), gap)]
    data = np.concatenate(pieces)
    order = sort_suffixes(np.append(data.astype(np.int64) + 1, 0), 257)[1:]
    before, common = permuted_prefixes(data, order, LENGTH)
    hit = np.flatnonzero(common >= LENGTH)
    mark = np.zeros(len(data), bool)
    mark[hit] = True
    mark[before[hit]] = True
    out, at = [], 0
    for windows, raw in parts:
        out.append(mark[at : at + windows])
        at += len(raw) + 1
    return out


def runs(mark: np.ndarray) -> list[list[int]]:
    """[begin, end) of the runs of true."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.view(np.int8), [0]])))
    return edge.reshape(-1, 2).tolist()


_RUNS = "key long, ctx long, runs array<array<int>>"


def _shards(parts: DataFrame) -> DataFrame:
    """Contexts ``(key, ctx, windows, data)`` -> their repeated windows, by suffix arrays of bounded size."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        marks = repeated_windows([(r[2], r[3]) for r in rows])
        found = [(r[0], r[1], x) for r, m in zip(rows, marks, strict=True) if (x := runs(m))]
        key, ctx, spans = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int64()), pa.array(ctx, pa.int64()), pa.array(list(spans), pa.list_(pa.list_(pa.int32())))], ["key", "ctx", "runs"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for r in rows_of(batches):
            # whole anchors only: HOT_CONTEXTS contexts of one at most
            if size >= SHARD_BYTES and r[0] != rows[-1][0]:
                yield flush(rows)
                rows, size = [], 0
            rows.append(r)
            size += len(r[3])
        if rows:
            yield flush(rows)

    n = shuffle_width(parts.sparkSession)
    dealt = parts.select("key", "ctx", "windows", "data").repartition(n, "key").sortWithinPartitions("key", "ctx")
    return dealt.mapInArrow(run, _RUNS)


def _by_digest(parts: DataFrame) -> DataFrame:
    """The same for anchors with very many contexts: windows at one offset are equal if their 128-bit digests are."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, ctx, n, raw in rows_of([b]):
                d = [hashlib.blake2b(raw[i : i + LENGTH], digest_size=16).digest() for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * n, pa.int64()), pa.array([ctx] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(d, pa.binary())],
                    ["key", "ctx", "at", "digest"],
                )

    def collect(pdf: pd.DataFrame) -> pd.DataFrame:
        at = np.sort(pdf["at"].to_numpy())
        mark = np.zeros(int(at[-1]) + 1, bool)
        mark[at] = True
        return pd.DataFrame({"key": pdf["key"].iloc[:1], "ctx": pdf["ctx"].iloc[:1], "runs": [runs(mark)]})

    each = parts.select("key", "ctx", "windows", "data").mapInArrow(windows, "key long, ctx long, at int, digest binary")
    each = stored(each, "windows")
    more = each.groupBy("key", "digest").agg(F.count("*").alias("n")).where("n > 1").select("key", "digest")
    # a context has LENGTH windows at most
    return each.join(more, ["key", "digest"]).groupBy("key", "ctx").applyInPandas(collect, _RUNS)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(doc_id, t, first, last)``: window starts that repeat, as runs; and the texts ``(doc_id, t, data)`` that may have some."""
    prepare(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    src = src.select("doc_id", F.xxhash64("text").alias("t"), F.col("text").cast("binary").alias("data"))
    anchors = stored(_scan(src, src.schema["doc_id"].dataType.simpleString()), "anchors")
    keys = anchors.groupBy("key").agg(F.count("*").alias("n"), F.min("ctx").alias("lo"), F.max("ctx").alias("hi")).where("n > 1")
    # stored, so that the join has an exchange on either side and a hot anchor's rows can be split
    keys = stored(keys.select("key", (F.col("lo") != F.col("hi")).alias("mixed")), "keys")
    found = stored(anchors.join(keys, "key"), "candidates")

    same = [F.col("doc_id").eqNullSafe(F.col("_id")), F.col("t") == F.col("_t")]
    # texts are dealt out by hash at any size, never by a broadcast of what grows with them
    ids = found.select(F.col("doc_id").alias("_id"), F.col("t").alias("_t")).distinct()
    texts = stored(src.join(ids.hint("shuffle_hash"), same, "left_semi"), "texts")

    each = found.groupBy("key", "ctx", "windows", "mixed").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "t", "first")).alias("at")
    )
    each = stored(each, "contexts")
    places = each.where("mixed").select(F.col("at.doc_id").alias("_id"), F.col("at.t").alias("_t"), F.struct("key", "ctx", "windows", "at.first").alias("c"))
    per_text = places.groupBy("_id", "_t").agg(F.collect_list("c").alias("cs"))  # bounded by the text's length
    cut = F.transform("cs", lambda c: F.struct(
        c["key"].alias("key"), c["ctx"].alias("ctx"), c["windows"].alias("windows"),
        F.substring(F.col("data"), (c["first"] + 1).cast("int"), c["windows"] + LENGTH - 1).alias("data")))
    fetched = texts.join(per_text.hint("shuffle_hash"), same).select(F.explode(cut).alias("c")).select("c.*").dropDuplicates(["key", "ctx"])
    busy = each.where("mixed").groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > HOT_CONTEXTS).select("key")
    fetched = stored(fetched, "fetched")
    marked = _shards(fetched.join(busy, "key", "left_anti")).unionByName(_by_digest(fetched.join(busy, "key", "left_semi")))

    all_of = F.array(F.array(F.lit(0), F.col("windows")))
    sure = each.where("n > 1").select("key", "ctx", all_of.alias("runs"))
    some = marked.join(each.where("n = 1").select("key", "ctx"), ["key", "ctx"], "left_semi")
    spans = stored(sure.unionByName(some), "repeats")
    hits = found.join(spans, ["key", "ctx"]).select("doc_id", "t", "first", F.explode("runs").alias("r"))
    first = F.col("first") + F.element_at("r", 1)
    last = F.col("first") + F.element_at("r", 2) - 1
    return hits.select("doc_id", "t", first.alias("first"), last.alias("last")), texts


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept)`` per row of ``docs``.

    Removes each byte of a text (as UTF-8; a null text is empty) that a string of
    ``LENGTH`` bytes covers which also starts anywhere else, in the same text or
    another; strings are judged on the input.  ``spans`` are the byte ranges
    [begin, end) that are removed and ``kept`` the bytes left over, both null
    where nothing is removed.  Texts of under ``LENGTH`` bytes stay whole;
    repeated rows are copies of each other.  Other columns are ignored.
    """
    found, texts = repeated_spans(docs, id_col, text_col)
    n = F.col("first")
    per_text = found.groupBy("doc_id", "t").agg(F.array_sort(F.collect_set(F.struct(n.alias("a"), (F.col("last") + LENGTH).alias("b")))).alias("covered"))
    same = [F.col("doc_id").eqNullSafe(F.col("_id")), F.col("t") == F.col("_t")]
    covered = per_text.select(F.col("doc_id").alias("_id"), F.col("t").alias("_t"), "covered")
    id_type = texts.schema["doc_id"].dataType.simpleString()
    changed = texts.dropDuplicates(["doc_id", "t"]).join(covered.hint("shuffle_hash"), same).select("doc_id", "t", "data", "covered")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for data, ranges in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                merged: list[list[int]] = []
                for r in ranges:
                    if merged and r["a"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], r["b"])
                    else:
                        merged.append([r["a"], r["b"]])
                left = b"".join(data[x:y] for x, y in zip([0, *(m[1] for m in merged)], [*(m[0] for m in merged), len(data)]))
                out.append((merged, left))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([m for m, _ in out], pa.list_(pa.list_(pa.int64()))), pa.array([k for _, k in out], pa.binary())],
                ["_id", "_t", "spans", "kept"],
            )

    done = changed.mapInArrow(cut, f"_id {id_type}, _t long, spans array<array<bigint>>, kept binary")
    raw = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(raw).alias("t"), F.octet_length(raw).cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("whole")
    )
    removed = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda x, r: x + F.element_at(r, 2) - F.element_at(r, 1)), F.lit(0).cast("long"))
    return rows.join(done, same, "left").select(
        "doc_id", "n_bytes", removed.alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce(F.sha2("kept", 256), "whole").alias("kept_sha256"), "spans", "kept",
    )


def query(docs: DataFrame) -> DataFrame:
    return without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")

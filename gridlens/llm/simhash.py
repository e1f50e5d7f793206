"""SimHash near-duplicates: 64-bit fingerprints, linked by Hamming distance through BK-trees.

Distinct fingerprints are dealt to shards by pairs of their five bit blocks:
two fingerprints that differ in at most three bits agree on at least two whole
blocks, so some shard holds both.  Each shard is one BK-tree; a search follows
only the edges whose distance lies within the radius.  A shard sends out a
spanning forest of its links (at most one row per member), and star contraction
joins the forests into components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from gridlens.llm.common import prepare, rows_of, shuffle_width, stored, text_or_empty
from gridlens.llm.components import components

WIDTHS = (13, 13, 13, 13, 12)
SEED = 42
# A shard with more members is dealt to tiles of two parts of this size.
PART = 2048


def shingle_hashes(text: str, words: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle of ``words`` words; ASCII lower case, ASCII white space."""
    w = text.encode("utf-8").lower().split()
    if not w:
        return np.empty(0, np.uint64)
    if len(w) <= words:
        return np.array([xxh64_intdigest(b" ".join(w), seed)], np.uint64)
    shingles = map(b" ".join, zip(*(w[i:] for i in range(words))))
    return np.fromiter(map(xxh64_intdigest, shingles, repeat(seed)), np.uint64, len(w) - words + 1)


def majority_bits(h: np.ndarray) -> int:
    """A bit is one if it is set in over half of the hashes; zero without hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 65536):
        bits = np.unpackbits(np.ascontiguousarray(h[i : i + 65536], "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, sha)``: the fingerprint as a signed long and the digest of the text."""
    prepare(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("sha", F.sha2("text", 256))
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([majority_bits(shingle_hashes(t.as_py(), words)) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), b.column(2)], ["doc_id", "fp", "sha"])

    return src.mapInArrow(run, f"doc_id {id_type}, fp long, sha string")


class BKTree:
    """Children keyed by their Hamming distance to the parent."""

    def __init__(self) -> None:
        self.value: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, x: int, radius: int) -> list[int]:
        """Positions of the members within ``radius`` of ``x``."""
        found, todo = [], [0] if self.value else []
        value, children = self.value, self.children
        while todo:
            at = todo.pop()
            d = (value[at] ^ x).bit_count()
            if d <= radius:
                found.append(at)
            kids = children[at]
            if kids:
                todo += [kids[e] for e in range(d - radius, d + radius + 1) if e in kids]
        return found

    def add(self, x: int) -> int:
        self.value.append(x)
        self.children.append({})
        new = len(self.value) - 1
        at = 0
        while at != new:
            at = self.children[at].setdefault((self.value[at] ^ x).bit_count(), new)
        return new


def forest(members: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """(member, root) links of one shard: a spanning forest of all pairs within the radius."""
    tree, up = BKTree(), []

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for x in members:
        near = tree.near(x, radius)
        me = tree.add(x)
        up.append(me)
        for j in near:
            a, b = top(me), top(j)
            if a != b:
                up[max(a, b)] = min(a, b)
    for i, x in enumerate(members):
        if (r := top(i)) != i:
            yield x, members[r]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forests(shards: DataFrame, radius: int) -> DataFrame:
    """Sorted runs of equal ``shard`` -> links; one shard's members (bounded by two parts) at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links():
            at, members = None, []
            for shard, fp in rows_of(batches):
                if shard != at:
                    if len(members) > 1:
                        yield from forest(members, radius)
                    at, members = shard, []
                members.append(fp & 0xFFFFFFFFFFFFFFFF)
            if len(members) > 1:
                yield from forest(members, radius)

        a, b = [], []
        for x, y in links():
            a.append(_signed(x))
            b.append(_signed(y))
            if len(a) == 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    n = shuffle_width(shards.sparkSession)
    dealt = shards.select("shard", "fp").repartition(n, "shard").sortWithinPartitions("shard", "fp")
    return dealt.mapInArrow(run, "a long, b long")


def _block_keys(radius: int):
    """Shard keys of a fingerprint: all choices of ``5 - radius`` of its five blocks, with their values."""
    if not 0 <= radius <= 3:
        raise ValueError("radius: 0 to 3 bits")
    low, blocks = 0, []
    for w in WIDTHS:
        blocks.append(F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << w) - 1)))
        low += w
    keys = [
        F.concat_ws(":", F.lit(str(i)), *(blocks[j].cast("string") for j in chosen))
        for i, chosen in enumerate(combinations(range(len(WIDTHS)), len(WIDTHS) - radius))
    ]
    return F.explode(F.array(*keys))


def links(fps: DataFrame, radius: int = 3, part: int = PART) -> DataFrame:
    """Links ``(a, b)`` that connect every two distinct ``fp`` within ``radius`` bits, possibly through others.

    Shards of more than ``part`` members are dealt to parts; every two parts of
    a shard form a tile of bounded size, so all their pairs are still compared.
    """
    keyed = stored(fps.select("fp").distinct().select(_block_keys(radius).alias("shard"), "fp"), "shards")
    hot = keyed.groupBy("shard").count().where(F.col("count") > part).withColumn("g", F.ceil(F.col("count") / part).cast("int"))
    marked = keyed.join(hot.select("shard", "g"), "shard", "left")
    plain = marked.where("g is null").select("shard", "fp")
    p = F.pmod(F.xxhash64("fp"), F.col("g"))
    tiles = (
        marked.where("g is not null")
        .withColumn("p", p)
        .withColumn("q", F.explode(F.expr("sequence(0L, g - 1L)")))
        .select(F.concat_ws("/", "shard", F.least("p", "q").cast("string"), F.greatest("p", "q").cast("string")).alias("shard"), "fp")
    )
    return _forests(plain.unionByName(tiles), radius)


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, sha, component_id)``, a row per document.

    ``component_id`` is the least id reachable over links of at most ``radius``
    differing bits.  A null text counts as empty; texts without words share the
    fingerprint zero and link like any other.  Rows with a null id take part
    with the id null, which never becomes a component's id unless all are null.
    Repeated rows each get their row.  Other columns are ignored.
    """
    fps = stored(fingerprints(docs, words, id_col, text_col), "fingerprints")
    each = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = components(links(each, radius))
    rooted = each.join(roots, each.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted, "roots")
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "sha", "component_id")


def query(docs: DataFrame) -> DataFrame:
    """The fingerprint as 16 lower-case hex digits, and the component, per document."""
    out = near_duplicates(docs)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

"""N-gram Jaccard join: T-occurrence search by DivideSkip inside candidate blocks.

Every text becomes the set of its distinct word shingles, as 64-bit hashes;
equal sets are one class.  Two sets over the threshold differ in a bounded
number of shingles, so of more parts than that number (shingles are dealt to
parts by their hash) one part is equal in both: sets that share a part's
digest form candidate blocks, each of which holds both ends of every link of
its members.  In a block, every set asks the inverted lists of the others for
those that hold at least T of its shingles: the short lists are merged (a heap
of their heads), which leaves the few sets that occur often enough there, and
the long lists are only probed for these by binary search.  A block sends out
a spanning forest of its links, and star contraction gives the components.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest, xxh128_digest

from gridlens.llm.common import prepare, rows_of, shuffle_width, stored, text_or_empty
from gridlens.llm.components import components

WORDS = 3
PERCENT = 90
# A block with more members is dealt to tiles of two parts of this size.
PART = 512
# DivideSkip's share of long lists, and the largest merge left to the heap.
MU = 0.0085
HEAP_ENTRIES = 2048


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct XXH64 hashes of a text's shingles; a shorter text is one shingle, none without words."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.empty(0, np.uint64)
    if len(w) <= words:
        return np.array([xxh64_intdigest(b" ".join(w))], np.uint64)
    shingles = set(map(b" ".join, zip(*(w[i:] for i in range(words)))))
    return np.unique(np.fromiter(map(xxh64_intdigest, shingles), np.uint64, len(shingles)))


def most_other(size: int, percent: int) -> int:
    """The largest size of a set that can link with one of ``size``."""
    return size * 100 // percent


def classes(largest: int, percent: int) -> list[int]:
    """The least sizes of the size classes; linked sets lie in one class or in neighbours."""
    out = [1]
    while out[-1] <= largest:
        out.append(most_other(out[-1], percent) + 1)
    return out


def most_apart(least_next: int, percent: int) -> int:
    """The most shingles that only one of two linked sets holds, the smaller set below ``least_next``."""
    small = least_next - 1
    return (small + most_other(small, percent)) * (100 - percent) // (100 + percent)


def parts_of(least: int, apart: int) -> int:
    """Parts for sets of ``least`` shingles or more: one more than can differ, and about as many more as stay empty thrice over."""
    return apart + 1 + int(3 * (apart + 1) * math.exp(-least / (apart + 1)) + 0.9)


def _mixed(h: np.ndarray, seed: int) -> np.ndarray:
    """An invertible 64-bit mix of the hashes."""
    h = h + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def part_digests(h: np.ndarray, scheme: int, n: int, apart: int) -> list[int]:
    """A digest per part that is not empty, signed.

    Linked sets agree in ``n - apart`` parts at least, so a set with fewer empty
    parts need not answer for them; a set with as many gives their numbers too.
    """
    mixed = _mixed(h, 1)
    part = ((mixed >> np.uint64(32)) % np.uint64(n)).astype(np.int64)
    total = np.zeros(n, np.uint64)
    np.add.at(total, part, _mixed(mixed, 77))
    there = np.bincount(part, minlength=n) > 0
    tag = _mixed(np.arange(n, dtype=np.uint64) + np.uint64(scheme << 40), 5)
    digest = _mixed(total ^ tag, 9).view(np.int64)
    return (digest[there] if n - there.sum() < n - apart else digest).tolist()


def set_digests(h: np.ndarray, percent: int, least: list[int]) -> list[int]:
    """The part digests of a set in the scheme of its size class and of the class below, signed.

    A class whose sets cannot differ has none.  ``least`` grows as needed.
    """
    if len(h) >= least[-1]:
        least[:] = classes(len(h), percent)
    own = int(np.searchsorted(least, len(h), "right")) - 1
    out = []
    for scheme in {own, max(own - 1, 0)}:
        if len(h) and (apart := most_apart(least[scheme + 1], percent)):
            out += part_digests(h, scheme, parts_of(least[scheme], apart), apart)
    return out


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    """The rows with ``text`` (null: empty) and its digest ``tk``."""
    text = text_or_empty(text_col)
    return docs.withColumns({"text": text, "tk": F.unhex(F.substring(F.sha2(text, 256), 1, 32))})


def shingle_sets(docs: DataFrame, percent: int, words: int, id_col: str, text_col: str) -> DataFrame:
    """``(rid, doc_id, n, d1, d2, tk, sigs)``: set size, 128-bit digest of the set, digest of the text, part digests as bytes."""
    src = _texts(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("t_")), "t_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = [1]
        for b in batches:
            n, raw, sigs = [], [], []
            for t in b.column(2):
                h = shingle_set(t.as_py(), words)
                n.append(len(h))
                raw.append(xxh128_digest(np.ascontiguousarray(h, "<u8")))
                sigs.append(np.array(set_digests(h, percent, least), "<i8").tobytes())
            d = np.frombuffer(b"".join(raw), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy()), b.column(3), pa.array(sigs, pa.binary())],
                ["rid", "doc_id", "n", "d1", "d2", "tk", "sigs"],
            )

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.select("rid", "doc_id", "text", "tk").mapInArrow(run, f"rid long, doc_id {kind}, n long, d1 long, d2 long, tk binary, sigs binary")


def signatures(sets: DataFrame) -> DataFrame:
    """``(sig, d1)``: a row per part digest; a task writes equal sets once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in batches:
            sigs, d1, times = [], [], []
            for d, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if d not in seen:
                    seen.add(d)
                    sigs.append(raw.as_py())
                    d1.append(d)
                    times.append(len(sigs[-1]) // 8)
            sig = np.frombuffer(b"".join(sigs), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(sig, pa.int64()), pa.array(np.repeat(np.array(d1, np.int64), times))], ["sig", "d1"])

    return sets.select("d1", "sigs").mapInArrow(run, "sig long, d1 long")


def block_members(docs: DataFrame, inside: DataFrame, words: int, text_col: str) -> DataFrame:
    """``(sid, block, h)``: the shingle sets of the classes in a block, cut again from one text each."""
    texts = _texts(docs.select(F.col(text_col).alias("t_")), "t_").select("text", "tk")
    one = texts.join(inside.hint("merge"), "tk").groupBy("sid", "block").agg(F.min("text").alias("text"))  # copies meet before they travel

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [shingle_set(t.as_py(), words).astype("<u8").tobytes() for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(raw, pa.binary())], ["sid", "block", "h"])

    return one.mapInArrow(run, "sid long, block long, h binary")


class InvertedLists:
    """The members of a tile (by rising set size) under each of their shingles."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets])
        token = np.concatenate(sets)
        member = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(token, kind="stable")
        self.tokens, start = np.unique(token[order], return_index=True)
        self.member, self.start = member[order], np.append(start, len(order))

    def lists(self, h: np.ndarray) -> list[np.ndarray]:
        at = np.minimum(np.searchsorted(self.tokens, h), len(self.tokens) - 1)
        return [self.member[self.start[i] : self.start[i + 1]] for i in at[self.tokens[at] == h].tolist()]

    def linked(self, h: np.ndarray, percent: int, below: int) -> list[int]:
        """Members before ``below``, no larger than the asking set, that link with it (DivideSkip)."""
        size = len(h)
        least = -(-size * percent // 100)
        low = int(np.searchsorted(self.sizes[:below], least))
        if low >= below:
            return []
        found = sorted((x[np.searchsorted(x, low) : np.searchsorted(x, below)] for x in self.lists(h)), key=len)
        found = [x for x in found if len(x)]
        # occurrences that the smallest member in reach would need
        need = -(-percent * (size + int(self.sizes[low])) // (100 + percent))
        if len(found) < need:
            return []
        longest = len(found[-1])
        n_long = min(int(need / (MU * math.log(longest + 1) + 1)), need - 1)
        short, long = found[: len(found) - n_long], found[len(found) - n_long :]
        member, times = merged(short, need - n_long)
        for k, x in enumerate(long):
            if not len(member):
                return []
            at = np.searchsorted(x, member)
            times = times + (x[np.minimum(at, len(x) - 1)] == member)
            left = len(long) - k - 1
            fit = times + left >= need
            member, times = member[fit], times[fit]
        both = size + self.sizes[member] - times
        return member[100 * times >= percent * both].tolist()


def merged(lists: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """The members that occur in at least ``least`` of some sorted lists, with how often.

    A heap merges the lists' heads; many entries are merged by one stable sort
    of the concatenated runs instead, with the same result.
    """
    if sum(map(len, lists)) <= HEAP_ENTRIES:
        runs = ((m, sum(1 for _ in g)) for m, g in groupby(heapq.merge(*(x.tolist() for x in lists))))
        hit = [(m, c) for m, c in runs if c >= least]
        member, times = zip(*hit) if hit else ((), ())
        return np.array(member, np.int64), np.array(times, np.int64)
    member, times = np.unique(np.concatenate(lists), return_counts=True)
    return member[times >= least], times[times >= least]


def forest(ids: list[int], sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """(member, root) links: a spanning forest of the links among some different sets."""
    order = sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i]))
    ids, sets = [ids[i] for i in order], [sets[i] for i in order]
    index, up = InvertedLists(sets), list(range(len(ids)))

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, h in enumerate(sets):
        for j in index.linked(h, percent, i):
            a, b = top(i), top(j)
            if a != b:
                up[max(a, b)] = min(a, b)
    for i, x in enumerate(ids):
        if (r := top(i)) != i:
            yield x, ids[r]


def _forests(tiles: DataFrame, percent: int) -> DataFrame:
    """Sorted runs of equal ``tile`` -> links; one tile's members (bounded by two parts) at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done():
            links = list(forest(ids, sets, percent)) if len(ids) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], ["a", "b"])

        at, ids, sets = None, [], []
        for tile, sid, raw in rows_of(batches):
            if tile != at:
                yield done()
                at, ids, sets = tile, [], []
            ids.append(sid)
            sets.append(np.frombuffer(raw, "<u8"))
        yield done()

    n = shuffle_width(tiles.sparkSession)
    dealt = tiles.select("tile", "sid", "h").repartition(n, "tile").sortWithinPartitions("tile", "sid")
    return dealt.mapInArrow(run, "a long, b long")


def _tiles(members: DataFrame, part: int) -> DataFrame:
    """``(tile, sid, h)`` of blocks: small ones whole, large ones as all pairs of their parts."""
    sizes = members.groupBy("block").count().withColumn("g", F.ceil(F.col("count") / part).cast("int"))
    marked = members.join(sizes.select("block", "g"), "block")
    p = F.pmod(F.xxhash64("sid"), F.col("g")).cast("int")
    other = F.explode(F.when(F.col("g") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("g") - 1)))
    dealt = marked.withColumn("p", p).withColumn("q", other)
    tile = F.concat_ws("/", "block", F.least("p", "q").cast("string"), F.greatest("p", "q").cast("string"))
    return dealt.select(tile.alias("tile"), "sid", "h")


def jaccard_groups(
    docs: DataFrame, percent: int = PERCENT, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text", part: int = PART
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, a row per document.

    Two documents link when 100 * common shingles >= ``percent`` * shingles of
    either; ``component_id`` is the least id reachable over links.  Texts that
    are null, empty or without words have an empty set and link with nothing.
    Repeated rows each get their row.  Rows with a null id take part with the
    id null, which never becomes a component's id unless all are null.  Other
    columns are ignored; an empty table gives none.  Shingles are compared by
    64-bit hashes, whole sets by 128-bit digests.
    """
    prepare(docs.sparkSession)
    sets = stored(shingle_sets(docs, percent, words, id_col, text_col), "shingle-sets")
    full = sets.where("n > 0")
    first = F.min(F.struct("rid", "tk"))
    kinds = full.groupBy("d1", "d2").agg(first.alias("one"), F.min("doc_id").alias("low"))
    kinds = stored(kinds.select("d1", "d2", F.col("one.rid").alias("sid"), F.col("one.tk").alias("tk"), "low"), "classes")
    sigs = signatures(full)
    shared = sigs.groupBy("sig").agg(F.min("d1").alias("first"), F.max("d1").alias("last")).where("first < last")
    shared = stored(shared.select("sig", "first"), "shared-parts")
    # both sides grow with the documents: one plan at every size, whatever a small table's size would allow
    near = sigs.join(shared.hint("merge"), "sig").where("d1 != first").select(F.col("d1").alias("a"), F.col("first").alias("b"))
    blocks = components(near).select(F.col("node").alias("d1"), F.col("root").alias("block"))
    inside = stored(kinds.join(blocks, "d1").select("tk", "sid", "block"), "in-blocks")
    members = stored(block_members(docs, inside, words, text_col), "block-members")
    links = _forests(_tiles(members, part), percent)
    roots = components(links)
    rooted = stored(kinds.join(roots, F.col("sid") == F.col("node"), "left").select("d1", "d2", "low", F.coalesce("root", "sid").alias("root")), "rooted")
    named = rooted.join(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("d1", "d2", "component_id")
    rest = sets.select("doc_id", "n", "d1", "d2")
    out = rest.where("n > 0").join(named, ["d1", "d2"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.unionByName(rest.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def query(docs: DataFrame) -> DataFrame:
    return jaccard_groups(docs)

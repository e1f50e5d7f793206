"""Benchmark decontamination by pigeonhole edit matching.

A test item may occur with up to ``k`` edits, ``k`` a fixed share of its length.
Cut into ``k + 1`` pieces, one piece of it must occur unchanged.  All pieces of
a block of items are found in one pass by an Aho-Corasick automaton.  Around each
hit, Myers' bit-parallel algorithm computes the least edit distance between ever
larger parts of the item, to the whole of it, and any part of the window; a part
that is over its share of the budget ends the check.  Short items have no budget:
they are one piece, found where they stand unchanged between word borders.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from unicodedata import category

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from gridlens.llm.common import prepare, stored, text_or_empty

# Edits allowed, as a share of the item's length.
ERROR_RATE = 0.1
# Shorter items must occur unchanged, and not as a part of longer words.
SHORT_CHARS = 20
# Characters of items that are broadcast at once; more items take more passes.
BLOCK_CHARS = 400_000
# Scripts without spaces between words: Thai, Lao, Burmese, Khmer, kana, Han; every place in them is a border.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


def normalise(text: str | None) -> str:
    """Lower case, white space as one space."""
    return " ".join((text or "").lower().split())


def budget(item: str, rate: float = ERROR_RATE) -> int:
    return int(len(item) * rate) if len(item) >= SHORT_CHARS else 0


def in_word(c: str) -> bool:
    return (c.isalnum() or c == "_" or category(c)[0] == "M") and not _UNSPACED.match(c)


def at_borders(text: str, start: int, end: int) -> bool:
    """Whether ``text[start:end]`` begins and ends at a word border."""
    return not any(0 < i < len(text) and in_word(text[i - 1]) and in_word(text[i]) for i in (start, end))


def masks(item: str) -> dict[str, int]:
    """For each character, the bits of its places in the item."""
    out: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        out[c] |= 1 << i
    return dict(out)


def least_distance(peq: dict[str, int], m: int, window: str) -> int:
    """Least edit distance between an item of ``m`` characters and any part of ``window``."""
    full, last = (1 << m) - 1, 1 << (m - 1)
    pv, mv, at = full, 0, m
    best = m
    for c in window:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & last:
            at += 1
        elif mh & last:
            at -= 1
            if at < best:
                best = at
        ph = (ph << 1) & full  # the item may begin anywhere: the first row stays zero
        mh = (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
    return best


def nodes(lo: int, hi: int, k: int, above: tuple = ()) -> Iterator[tuple[tuple, ...]]:
    """For each of the ``k + 1`` pieces of a part of an item, from left to right: the piece and the parts around it.

    A part ``(lo, hi, k)`` splits in two whose budgets add up to ``k - 1``: where it
    occurs with ``k`` edits, one of the two occurs within its own budget.
    """
    here = ((lo, hi, k), *above)
    if k == 0:
        yield here
        return
    left = (k - 1) // 2
    mid = lo + (hi - lo) * (left + 1) // (k + 1)
    yield from nodes(lo, mid, left, here)
    yield from nodes(mid, hi, k - 1 - left, here)


class Matcher:
    """All items of one block; ``find`` gives the least distance of each item that occurs."""

    def __init__(self, items: list[tuple[int, str]], rate: float = ERROR_RATE) -> None:
        self.items = items
        self.peq: dict[tuple[int, int, int], dict[str, int]] = {}
        places: dict[str, list[tuple]] = defaultdict(list)
        for n, (_, text) in enumerate(items):
            for piece, *around in nodes(0, len(text), budget(text, rate)):
                lo, hi, _ = piece
                places[text[lo:hi]].append((n, hi - 1, tuple(around)))
        self.trie = ahocorasick.Automaton()
        for piece, where in places.items():
            self.trie.add_word(piece, where)
        if places:
            self.trie.make_automaton()

    def _distance(self, text: str, n: int, lo: int, hi: int, k: int, start: int) -> int:
        peq = self.peq.get((n, lo, hi))
        if peq is None:
            peq = self.peq[n, lo, hi] = masks(self.items[n][1][lo:hi])
        return least_distance(peq, hi - lo, text[max(0, start + lo - k) : max(0, start + hi + k)])

    def find(self, text: str) -> Iterator[tuple[int, int]]:
        """(item id, distance) for each item within its budget in the normalised ``text``."""
        if not self.items:
            return
        best: dict[int, int] = {}
        for end, where in self.trie.iter(text):
            for n, offset, around in where:
                if best.get(n) == 0:
                    continue
                start, d = end - offset, 0
                if start < 0 or not text.startswith(self.items[n][1], start):
                    for lo, hi, k in around:  # from the piece outwards: ever larger parts, to the whole item
                        d = self._distance(text, n, lo, hi, k, start)
                        if d > k:
                            break
                    else:
                        best[n] = min(d, best.get(n, d))
                    continue
                if len(self.items[n][1]) >= SHORT_CHARS or at_borders(text, start, end + 1):
                    best[n] = 0
        for n, d in best.items():
            yield self.items[n][0], d


def _item_blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The distinct items in blocks of at most ``BLOCK_CHARS`` characters, one block on the driver at a time."""
    items = benchmark.select(F.col(item_col).alias("item_id"), text_or_empty(text_col).alias("text")).where("item_id is not null").distinct()
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // BLOCK_CHARS))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    for i in range(n):
        rows: list[Row] = items.where(F.col("block") == i).collect()
        normal = sorted({(r["item_id"], normalise(r["text"])) for r in rows})
        yield [(i_, t) for i_, t in normal if t]


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(doc_id, sha, item_id, distance)``: each document and test item that occurs in it within its edit budget.

    Case and runs of white space do not count.  Items of under ``SHORT_CHARS``
    characters must occur unchanged between word borders.  Null and empty texts
    hold nothing; items with a null id, or empty ones, are not searched for.  Repeated documents are each reported; an item listed twice
    is one item, with its least distance.  Other columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    src = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("sha", F.sha2("text", 256))
    id_type = src.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema[item_col].dataType.simpleString()
    schema = f"doc_id {id_type}, sha string, item_id {item_type}, distance int"
    out: DataFrame | None = None
    for block in _item_blocks(benchmark, item_col, item_text_col):
        found = _search(src, block, rate, schema)
        out = found if out is None else out.unionByName(found)
    return out


def _search(src: DataFrame, block: list[tuple], rate: float, schema: str) -> DataFrame:
    shared = src.sparkSession.sparkContext.broadcast(block)  # BLOCK_CHARS characters at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value, rate)
        for b in batches:
            at, items, far = [], [], []
            for i, t in enumerate(b.column(1)):
                best: dict = {}
                for item, d in matcher.find(normalise(t.as_py())):
                    best[item] = min(d, best.get(item, d))
                at += [i] * len(best)
                items += best
                far += best.values()
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(rows), b.column(2).take(rows), pa.array(items, types[2]), pa.array(far, pa.int32())], names
            )

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    names, types = arrow.names, arrow.types
    return src.mapInArrow(run, schema)


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs, benchmark).select("doc_id", "item_id", "distance")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no test item, each as often as it occurs."""
    hits = stored(contaminated(docs, benchmark).select(F.col("doc_id").alias("_hid"), F.col("sha").alias("_hsha")).distinct(), "hits")
    cols = docs.columns
    names = [f"_c{i}" for i in range(len(cols))]
    marked = docs.toDF(*names).withColumn("_sha", F.sha2(text_or_empty(names[cols.index("text")]), 256))
    same = F.col(names[cols.index("doc_id")]).eqNullSafe(F.col("_hid")) & (F.col("_sha") == F.col("_hsha"))
    return marked.join(hits.hint("shuffle_hash"), same, "left_anti").select(*names).toDF(*cols)

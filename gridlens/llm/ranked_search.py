"""Ranked lexical search: the best documents of each query by the Best Position Algorithm.

Every text becomes term counts; only postings of terms that some query holds
travel on.  Documents are dealt to shards by a hash, and queries to blocks, so
that one task holds one shard's impact lists for one block's terms.  There a
query reads its lists from the top in rounds.  A document met in one list is
looked up in all others at once (direct access), which scores it in full and
marks its place in each of them.  A list's best position ends its unbroken run
of seen places; nothing unseen has more there than the place that follows, and
the sum of these impacts bounds whatever is unseen.  The query stops when that
sum is strictly below its k-th best score, so ties are read to their end.  The
shards' best are merged per query.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlens.llm.common import prepare, small_side, stored, text_or_empty

K = 10
# Postings that one task's lists hold on average, and queries of a block.
SHARD_POSTINGS = 400_000
BLOCK_ITEMS = 500
# Places read of every list in the first round; later rounds read more.
FIRST_ROUND = 4
# All ASCII but digits and letters separates terms; A to Z become a to z.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, in order, as UTF-8 bytes."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def term_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(rid, id, n, term, tf)``: a row per document and term, and per document with terms one of the empty term.

    ``rid`` tells rows apart; ``n`` counts a document's terms with repeats.
    """
    src = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    schema = f"rid long, id {src.schema['id'].dataType.simpleString()}, n long, terms array<string>, tf array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, at, terms, tfs = [], [0], [], []
            for t in b.column(2):
                c = Counter(terms_of(t.as_py()))
                n = sum(c.values())
                sizes.append(n)
                if n:
                    terms.append(b"")
                    tfs.append(0)
                    terms += c
                    tfs += c.values()
                at.append(len(terms))
            at = pa.array(at, pa.int32())
            words = pa.ListArray.from_arrays(at, pa.array(terms, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(sizes, pa.int64()), words, pa.ListArray.from_arrays(at, pa.array(tfs, pa.int32()))],
                ["rid", "id", "n", "terms", "tf"],
            )

    counted = src.mapInArrow(run, schema)
    each = counted.select("rid", "id", "n", F.explode(F.arrays_zip("terms", "tf")).alias("p"))
    return each.select("rid", "id", "n", F.col("p.terms").alias("term"), F.col("p.tf").alias("tf"))


def first_unseen(seen: np.ndarray, p: int, z: int) -> int:
    """The first place from ``p`` on, up to ``z``, that is not seen."""
    while p < z:
        part = seen[p : min(p + 256, z)]
        gap = int(part.argmin())
        if not part[gap]:
            return p + gap
        p += len(part)
    return z


class ImpactLists:
    """One shard's postings as lists by term, highest impact first, and by document for direct access."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_docs: int) -> None:
        order = np.lexsort((doc, -impact, term))
        self.term, self.doc, self.impact = term[order], doc[order], impact[order]
        names, start = np.unique(self.term, return_index=True)
        ends = np.append(start[1:], len(order))
        self.span = {t: (int(a), int(b)) for t, a, b in zip(names.tolist(), start, ends, strict=True)}
        self.number = np.searchsorted(names, self.term)
        self.by_doc = np.argsort(self.doc, kind="stable")
        self.row = np.searchsorted(self.doc[self.by_doc], np.arange(n_docs + 1))
        self.n_docs, self.n_terms = n_docs, len(names)
        self.names = names

    def direct(self, docs: np.ndarray) -> np.ndarray:
        """Places of all postings of some documents, document by document."""
        first, size = self.row[docs], self.row[docs + 1] - self.row[docs]
        total = int(size.sum())
        shift = np.repeat(first - np.append(0, np.cumsum(size)[:-1]), size)
        return self.by_doc[np.arange(total) + shift]

    def best(self, terms: list, k: int, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The ``k`` best documents (score above 0, then least ``order``), their scores, and the places read in order."""
        lists = [self.span[t] for t in terms if t in self.span]
        if not lists:
            return np.empty(0, np.int64), np.empty(0, np.int64), 0
        begin = np.array([a for a, _ in lists])
        end = np.array([b for _, b in lists])
        wanted = np.zeros(self.n_terms, bool)
        wanted[self.number[begin]] = True
        score = np.full(self.n_docs, -1, np.int64)
        seen = np.zeros(len(self.term), bool)
        place, ahead = begin.copy(), begin.copy()  # ahead: the place after the best position
        top_docs = np.empty(0, np.int64)
        step, reads = FIRST_ROUND, 0
        while True:
            upto = np.minimum(place + step, end)
            fresh = [self.doc[a:b] for a, b in zip(place, upto, strict=True) if a < b]
            reads += int((upto - place).sum())
            place, step = upto, step * 2
            if fresh:
                met = np.unique(np.concatenate(fresh))
                met = met[score[met] < 0]
                if len(met):
                    at = self.direct(met)
                    at = at[wanted[self.number[at]]]
                    seen[at] = True
                    score[met] = 0
                    np.add.at(score, self.doc[at], self.impact[at])
                    pool = np.concatenate([top_docs, met])
                    pool = pool[score[pool] > 0]
                    top_docs = pool[np.lexsort((order[pool], -score[pool]))[:k]]
            bound = 0
            for i, z in enumerate(end.tolist()):
                ahead[i] = first_unseen(seen, int(ahead[i]), z)
                if ahead[i] < z:
                    bound += int(self.impact[ahead[i]])
            if bound == 0 or (len(top_docs) == k and bound < score[top_docs[-1]]):
                return top_docs, score[top_docs], reads


def _search(k: int):
    """One cogroup (a shard's postings, a block's queries) -> the best rows of each query there."""

    def run(post: pa.Table, items: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if len(post) and len(items):
            rid = post["rid"].to_numpy()
            rids, first, doc = np.unique(rid, return_index=True, return_inverse=True)
            ids = post["id"].take(pa.array(first))
            rank = ids.to_pylist()
            order = np.empty(len(rids), np.int64)
            order[sorted(range(len(rids)), key=lambda i: (rank[i] is None, rank[i] or 0, i))] = np.arange(len(rids))
            lists = ImpactLists(post["tid"].to_numpy(), doc, post["impact"].to_numpy(), len(rids))
            for iid, terms in zip(items["iid"].to_pylist(), items["tids"].to_pylist(), strict=True):
                found, score, _ = lists.best(terms, k, order)
                out[0] += [iid] * len(found)
                out[1] += [rank[i] for i in found.tolist()]
                out[2] += rids[found].tolist()
                out[3] += score.tolist()
        return pa.table(
            [pa.array(out[0], pa.int64()), pa.array(out[1], post.schema.field("id").type), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64())],
            names=["iid", "id", "rid", "score"],
        )

    return run


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = K,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of each query, scores above 0.

    A null or empty text has no terms: such a document is never found and does
    not count, such a query finds nothing.  Rows with equal scores rank by
    rising id, null ids last; repeated rows of either table are each searched
    and found.  Other columns are ignored; empty tables give no rows.  Long
    arithmetic that would overflow raises.
    """
    spark = docs.sparkSession
    prepare(spark)
    items = stored(term_counts(queries, item_col, item_text).where("term != ''").select(F.col("rid").alias("iid"), F.col("id").alias("item_id"), "term"), "query-terms")
    asked = stored(items.select("term").union(spark.createDataFrame([("",)], "term string")).distinct(), "asked-terms")
    post = stored(term_counts(docs, id_col, text_col).join(small_side(asked, 200), "term", "left_semi"), "postings")
    known = stored(post.groupBy("term").agg(F.count("*").alias("df"), F.sum("n").alias("total")), "term-documents")
    head = known.where("term = ''").first()
    total, length = (head["df"], head["total"]) if head else (0, 0)
    id_type, item_type = post.schema["id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    if not total:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {id_type}, score long")
    w = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * total + 2) / (2 * F.col("df") + 1)))
    terms = stored(known.where("term != ''").select("term", F.monotonically_increasing_id().alias("tid"), w.alias("w")).where("w > 0"), "terms")

    n_items = items.select("iid").distinct().count()
    n_blocks = -(-n_items // BLOCK_ITEMS)
    block = F.pmod(F.xxhash64("iid"), F.lit(n_blocks)).cast("int")
    asks = stored(items.join(terms.select("term", "tid"), "term").groupBy("iid", "item_id").agg(F.sort_array(F.collect_list("tid")).alias("tids")).withColumn("block", block), "queries")
    places = asks.select("block", F.explode("tids").alias("tid")).distinct().join(terms, "tid")
    m = F.expr(f"{100 - 90} + (90L * n * {total}L) div {length}L")
    hits = post.where("term != ''").join(places, "term").withColumn("m", m)
    hits = hits.withColumn("impact", F.expr("w * ((1000000000L * tf) div (1000L * tf + 8L * m))")).where("impact > 0")
    n_shards = max(1, -(-post.count() // SHARD_POSTINGS))
    shard = F.pmod(F.xxhash64("rid"), F.lit(n_shards)).cast("int")
    left = hits.select((F.col("block") + F.lit(0)).alias("at_block"), shard.alias("shard"), "tid", "rid", "id", "impact")
    # a block's queries go to every shard: the query set against all rows
    right = asks.select("block", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"), "iid", "tids")
    local = left.groupBy("at_block", "shard").cogroup(right.groupBy("block", "shard")).applyInArrow(_search(k), f"iid long, id {id_type}, rid long, score long")
    order = Window.partitionBy("iid").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "rid")
    best = local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = asks.select("iid", "item_id")
    return best.join(names, "iid").select("item_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score")


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return search(docs, benchmark)


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SQL = f"""
WITH tok AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM documents
), tfs AS (
  SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL
), size AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc_id
), head AS (
  SELECT count(*)::BIGINT AS total, sum(n)::BIGINT AS length FROM size
), w AS (
  SELECT term, floor(1000 * ln((2 * total + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tfs CROSS JOIN head GROUP BY term, total
), impact AS (
  SELECT doc_id, term, w * ((1000000000::BIGINT * tf) // (1000 * tf + 8 * (10 + (90 * n * total) // length))) AS impact
  FROM tfs JOIN size USING (doc_id) JOIN w USING (term) CROSS JOIN head
), ask AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark
), scored AS (
  SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM ask JOIN impact USING (term) GROUP BY ALL HAVING sum(impact) > 0
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

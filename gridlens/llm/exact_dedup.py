"""Exact duplicates of an incoming batch against immutable snapshots.

Every snapshot gets one static binary-fuse filter per digest bucket, stored
beside its digests and never changed.  The distinct digests of the batch are
screened by the filters of their bucket; only what passes joins the exact
bucket of the snapshot.  Copies inside a snapshot or inside the new batch are
grouped by themselves.  Digests that more than one row has are checked byte
for byte, so a digest collision would not merge different texts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlens.llm import fuse
from gridlens.llm.common import prepare, small_side, stored, text_or_empty

# Distinct digests per filter (about 1.2 bytes each).
BUCKET_KEYS = 100_000
# A digest of more rows is dealt to several parts.
HOT_ROWS = 500


def _key(sha: str) -> Column:
    """The first 60 bits of a hex digest, as a long: what the filters hold."""
    return F.conv(F.substring(sha, 1, 15), 16, 10).cast("long")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(rid, doc_id, sha)`` of every row, stored; ``rid`` tells repeated rows apart."""
    rid, sha = F.monotonically_increasing_id(), F.sha2(text_or_empty(text_col), 256)
    return stored(docs.select(rid.alias("rid"), F.col(id_col).alias("doc_id"), sha.alias("sha")), "digests")


def _buckets(distinct: DataFrame, n: int) -> DataFrame:
    return distinct.select("sha", _key("sha").alias("key")).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(n)))


def snapshot_filters(distinct: DataFrame, n_buckets: int) -> DataFrame:
    """``(bucket, filter)``: one fuse filter per bucket of a snapshot's distinct digests."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(pdf["key"].to_numpy().astype(np.uint64))
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "filter": [fuse.build(keys)]})

    b = _buckets(distinct, n_buckets).select("bucket", "key")
    return b.groupBy("bucket").applyInPandas(one, "bucket long, filter binary")


def screened(incoming: DataFrame, filters: DataFrame, n_buckets: int, parts: int = 1) -> DataFrame:
    """The distinct incoming digests that their bucket's filter lets pass.

    A bucket's incoming digests are dealt to ``parts``, each beside a copy of the bucket's filter.
    """

    def one(rows: pd.DataFrame, filt: pd.DataFrame) -> pd.DataFrame:
        if not len(filt) or not len(rows):
            return pd.DataFrame({"sha": pd.Series([], dtype=str)})
        hit = fuse.contains(filt["filter"].iloc[0], rows["key"].to_numpy().astype(np.uint64))
        return rows.loc[hit, ["sha"]]

    left = _buckets(incoming, n_buckets).withColumn("part", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(parts)))
    right = filters.withColumn("part", F.explode(F.expr(f"sequence(0L, {parts - 1}L)")))
    return left.groupBy("bucket", "part").cogroup(right.groupBy("bucket", "part")).applyInPandas(one, "sha string")


def _checked(texts: DataFrame, positive: DataFrame, sizes: DataFrame) -> DataFrame:
    """The distinct ``(sha, text)`` under the positive digests.

    The rows of a digest with over ``HOT_ROWS`` of them are dealt to as many
    parts as that takes, and each part's texts are combined before they meet.
    """
    hot = stored(sizes.where(F.col("n") > HOT_ROWS).select("sha", F.ceil(F.col("n") / HOT_ROWS).cast("int").alias("deal")), "hot-digests")
    salt = F.pmod(F.monotonically_increasing_id(), F.coalesce("deal", F.lit(1))).cast("int")
    rows = texts.withColumn("sha", F.sha2("text", 256)).join(small_side(hot, 200), "sha", "left").select("sha", "text", salt.alias("salt"))
    every = F.explode(F.sequence(F.lit(0), F.coalesce("deal", F.lit(1)) - 1))
    wanted = positive.join(hot, "sha", "left").select("sha", every.alias("salt"))
    # by hash at any size: the texts are dealt out alike whether or not the digests would fit a broadcast
    return rows.join(wanted.hint("shuffle_hash"), ["sha", "salt"], "left_semi").groupBy("sha", "text").count()


def exact_dedup(snapshots: list[DataFrame], batch: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of the snapshots and the batch: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the largest id stays (an id beats null; of rows
    that share the id too, one stays).  A null text counts as empty, and empty
    texts are equal to each other.  Other columns are ignored.
    """
    prepare(batch.sparkSession)
    parts = [digests(s, id_col, text_col) for s in [*snapshots, batch]]
    groups = [stored(p.groupBy("sha").agg(F.count("*").alias("n")), "digest-counts") for p in parts]
    fresh = groups[-1]
    positive = fresh.where("n > 1").select("sha")  # copies within the new batch
    sources: list[DataFrame] = []
    for old in groups[:-1]:
        # every earlier digest set is immutable: its filters are built once and stored
        n_buckets = max(1, -(-old.count() // BUCKET_KEYS))
        filters = stored(snapshot_filters(old, n_buckets), "filters")
        for new in [*sources, fresh]:
            passed = screened(new.select("sha"), filters, n_buckets, max(1, -(-new.count() // (n_buckets * BUCKET_KEYS))))
            positive = positive.union(passed.join(old.select("sha"), "sha"))
        positive = positive.union(old.where("n > 1").select("sha"))
        sources.append(old)
    positive = stored(positive.distinct(), "positives")

    rows = parts[0].select(F.lit(0).alias("part"), "*")
    for i, p in enumerate(parts[1:], 1):
        rows = rows.unionByName(p.select(F.lit(i).alias("part"), "*"))
    texts = [d.select(text_or_empty(text_col).alias("text")) for d in [*snapshots, batch]]
    every = texts[0]
    for t in texts[1:]:
        every = every.unionByName(t)
    # byte check: each positive digest and the distinct texts under it
    sizes = groups[0].select("sha", "n")
    for g in groups[1:]:
        sizes = sizes.unionByName(g.select("sha", "n"))
    checked = _checked(every, positive, sizes.groupBy("sha").agg(F.sum("n").alias("n")))
    bad = stored(checked.groupBy("sha").agg(F.count("*").alias("texts")).where("texts > 1").select("sha"), "collisions")
    if bad.limit(1).count():
        raise ValueError("different texts share a SHA-256 digest")
    order = F.struct(F.col("doc_id").alias("id"), "part", "rid")
    # groups first: the rows of a hot digest are combined before they are dealt out
    per = rows.groupBy("sha").agg(F.max(order).alias("keep"), F.count("*").alias("group_size"))
    per = stored(per.join(positive, "sha", "left_semi"), "groups")
    joined = rows.join(per, "sha", "left")
    kept = F.col("keep").isNull() | ((F.col("part") == F.col("keep.part")) & (F.col("rid") == F.col("keep.rid")))
    return joined.select(
        "doc_id",
        F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        kept.alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def arrivals(docs: DataFrame, id_col: str = "doc_id") -> tuple[list[DataFrame], DataFrame]:
    """Two arrivals by a hash of the id: a snapshot and a new batch.  Every row is in one of them."""
    first = F.pmod(F.xxhash64(id_col), F.lit(2)) == 0
    return [docs.where(first)], docs.where(~first)


def query(docs: DataFrame) -> DataFrame:
    return exact_dedup(*arrivals(docs))


SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""

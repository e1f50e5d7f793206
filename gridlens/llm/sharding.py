"""Uniform shuffle into shards of exact size through a hypergeometric communication matrix.

Rows lie in lanes (a hash of the row).  How many rows every lane sends to every
shard is drawn exactly from the multivariate hypergeometric law that a uniform
permutation of all rows would give.  Each lane is permuted, cut by its row of
the matrix and exchanged; then each shard is permuted again.  Lanes, and the
cells that a shard is permuted by, are of bounded size.  The order keys are
hashes of the row, so a task that is run again makes the same rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlens.llm.common import stored, text_or_empty

# Rows that a lane, or a cell of a shard, holds on average.
LANE_ROWS = 100_000
# Copies of one row that are made in one place.
BLOCK = 65_536
# numpy's hypergeometric law takes populations below this.
NUMPY_LIMIT = 900_000_000


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes at most one apart."""
    return [rows // shards + (i < rows % shards) for i in range(shards)]


def draw_matrix(lanes: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Rows that each lane sends to each shard, given both margins."""
    rng = np.random.default_rng(seed)
    left, out = np.array(sizes, np.int64), []
    for n in lanes:
        row = np.zeros_like(left)
        need, rest = n, int(left.sum())
        for j, have in enumerate(left.tolist()):
            rest -= have
            row[j] = _univariate(rng, have, rest, need)
            need -= int(row[j])
        out.append(row.tolist())
        left -= row
    return out


def _univariate(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many good ones are among ``draws`` out of good + bad."""
    if draws == 0 or good == 0:
        return 0
    if good + bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, draws))
    # the weights around the mode, by the ratio of neighbours, as far as a double can tell them from none
    low, high = max(0, draws - bad), min(draws, good)
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    share = good / (good + bad)
    reach = int(13 * (draws * share * (1 - share)) ** 0.5) + 40
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=np.float64)
    steps = np.log((good - k[:-1]) * (draws - k[:-1])) - np.log((k[:-1] + 1) * (bad - draws + k[:-1] + 1))
    weight = np.cumsum(np.append(0.0, steps))
    upto = np.cumsum(np.exp(weight - weight.max()))
    return int(k[np.searchsorted(upto, rng.random() * upto[-1], "right")])


def _hash(seed: int, salt: int, *cols: str) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(salt), *cols)


def _numbered(rows: DataFrame, alike: list[str]) -> DataFrame:
    """The rows with ``copy`` telling those that are alike apart, so that many copies spread like other rows.

    Copies are counted (combined before the shuffle) and made again in blocks of
    bounded size, dealt out before they are unrolled.
    """
    counted = rows.groupBy(*alike).agg(F.count("*").alias("n"))
    blocks = counted.select("*", F.explode(F.expr(f"sequence(0L, (n - 1) div {BLOCK})")).alias("block"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.repartition(n, *alike, "block")
    last = f"least(n, (block + 1) * {BLOCK}) - 1"
    return dealt.select(*alike, F.explode(F.expr(f"sequence(block * {BLOCK}, {last})")).alias("copy"))


def _placed(rows: DataFrame, by: list[str], group: str) -> DataFrame:
    """``pos``: place in the order (cell, hash) within each ``group``, gapless from 0, whatever its size."""
    counts = rows.groupBy(group, "cell").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy(group).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(group, "cell", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    here = Window.partitionBy(group, "cell").orderBy(*by)
    placed = rows.withColumn("at", F.row_number().over(here) - 1)
    return placed.join(before, [group, "cell"]).withColumn("pos", F.col("before") + F.col("at")).drop("at", "before", "cell")


def uniform_shards(docs: DataFrame, shards: int, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)``, a row per row of ``docs``.

    A null text has no bytes, like the empty text.  Rows with null or repeated
    ids are dealt like any others; rows alike in id and text are
    numbered and spread like any others.  Shards may be empty when there are fewer rows than shards.
    Other columns are ignored.
    """
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text_or_empty(text_col)) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text_or_empty(text_col).cast("binary")).alias("text_crc32"),
    )
    alike = ["doc_id", "text_crc32", "size"]
    base = stored(_numbered(base, alike), "rows")
    total = base.count()
    lanes = max(1, -(-total // LANE_ROWS))
    tie = [*alike, "copy"]
    laned = base.withColumn("lane", F.pmod(_hash(seed, 1, *tie), F.lit(lanes)).cast("int"))
    have = {r["lane"]: r["n"] for r in laned.groupBy("lane").agg(F.count("*").alias("n")).collect()}
    filled = sorted(have)
    matrix = draw_matrix([have[i] for i in filled], shard_sizes(total, shards), seed)
    cuts = base.sparkSession.createDataFrame(
        [(i, row) for i, row in zip(filled, matrix, strict=True)], "lane int, sends array<long>"
    )
    # first permutation: the order within a lane; its cells keep each sort small
    local = laned.withColumns({"h": _hash(seed, 2, *tie), "cell": F.pmod(_hash(seed, 3, *tie), F.lit(8))})
    local = _placed(local, ["h", *tie], "lane").drop("h")
    ends = cuts.select("lane", F.posexplode("sends").alias("shard", "n")).withColumn(
        "end", F.sum("n").over(Window.partitionBy("lane").orderBy("shard"))
    )
    spans = ends.where("n > 0").select("lane", "shard", (F.col("end") - F.col("n")).alias("start"), "end")
    sent = spans.groupBy("lane").agg(F.sort_array(F.collect_list(F.struct("start", "shard"))).alias("spans"))
    dealt = local.join(sent, "lane").withColumn(
        "shard", F.element_at(F.filter("spans", lambda s: s["start"] <= F.col("pos")), -1)["shard"]
    )
    # exchange, then the second permutation within each shard
    cells = max(1, -(-total // (shards * LANE_ROWS)))
    final = dealt.select(*tie, "shard").withColumns({"h": _hash(seed, 4, *tie), "cell": F.pmod(_hash(seed, 5, *tie), F.lit(max(8, cells)))})
    final = _placed(final, ["h", *tie], "shard")
    return final.select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), F.col("pos").cast("long").alias("slot"))


def query(docs: DataFrame) -> DataFrame:
    out = uniform_shards(docs, 24)
    return out.select("*", F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard"))

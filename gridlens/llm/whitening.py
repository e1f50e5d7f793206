"""Embedding whitening: a weighted covariance over distinct vectors, each whitened once.

Vectors are put on an integer grid and grouped; a distinct vector takes part
in the fit with its count (or once) as weight.  Tasks sum the weighted values,
then the weighted centred products (one matrix product per block of vectors);
what meets on the driver is one square matrix, as large as the dimension.
Every distinct vector is projected once and joined back to its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import prepare, stored

# The grid: x = floor(SCALE * c) + OFFSET.
SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8


def _matrix(col: pa.Array) -> np.ndarray:
    """Lists of equal length as the rows of a matrix."""
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def grid_rows(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, x)``: the rows with a vector whose entries are all finite numbers, on the grid."""
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = v.where(F.col("v").isNotNull() & ~bad & (F.size("v") > 0))
    return v.select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE) + F.lit(OFFSET).cast("long")).alias("x"))


def _dimension(distinct: DataFrame) -> int:
    """The length that most rows have, the longer one in a tie; 0 without rows."""
    top = distinct.groupBy(F.size("x").alias("d")).agg(F.sum("count").alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    return top["d"] if top else 0


def weighted_sums(distinct: DataFrame, d: int) -> tuple[int, list[int]]:
    """The sum of the weights, and of the weighted values per dimension: exact integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, [0] * d
        for b in batches:
            w = b.column(1).to_numpy()
            if len(w):
                n += int(w.sum())
                part = _matrix(b.column(0)).T @ w  # int64
                s = [a + int(c) for a, c in zip(s, part, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([-1, *range(d)], pa.int32()), pa.array([n, *s], pa.int64())], ["j", "s"])

    out = distinct.select("x", "w").mapInArrow(run, "j int, s long")
    sums = dict(map(tuple, out.groupBy("j").agg(F.sum("s")).collect()))
    return int(sums.get(-1) or 0), [int(sums.get(j) or 0) for j in range(d)]


def weighted_products(rows: DataFrame, values: str, d: int, centre: np.ndarray) -> np.ndarray:
    """The weighted sum of the outer products of ``values - centre``, a d by d matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = np.zeros((d, d))
        for b in batches:
            if len(b):
                m = _matrix(b.column(0)).astype(np.float64) - centre
                g += m.T @ (m * b.column(1).to_numpy().astype(np.float64)[:, None])
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(g[i, j])], ["i", "j", "v"])

    parts = rows.select(values, "w").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((d, d))
    for i, j, v in parts.collect():
        out[i, j] = out[j, i] = v
    return out


def principal(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    A direction without variance (up to rounding) has no whitened value and is
    left out.  The largest entry of each vector is positive.
    """
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    keep = e[:k] > max(e[0], 0) * len(e) * np.finfo(float).eps * 16 if len(e) else np.zeros(0, bool)
    e, v = e[:k][keep], v[:, :k][:, keep]
    sign = np.sign(v[np.abs(v).argmax(0), np.arange(v.shape[1])])
    return e, v * np.where(sign == 0, 1, sign)


def _projected(distinct: DataFrame, n: int, sums: list[int], e: np.ndarray, vec: np.ndarray) -> DataFrame:
    """``(x, w, deviation, z)`` of every distinct vector: exact deviation, whitened values."""
    s = np.array(sums, np.int64)
    centre, axes = s / n, vec / np.sqrt(e)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            x = _matrix(b.column(0))
            top = max(abs(int(x.max())), abs(int(x.min())), 1) * n + int(np.abs(s).max())
            if top * top * x.shape[1] < 2**63:
                q = n * x - s
                dev = (q * q).sum(1).tolist()
            else:  # Python integers have no end
                dev = [sum((n * c - m) ** 2 for c, m in zip(r, sums, strict=True)) for r in x.tolist()]
            z = (x - centre) @ axes
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * z.shape[1], pa.array(z.ravel()))
            dev = pa.array([int(v) for v in dev], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), dev, lists], ["x", "w", "deviation", "z"])

    return distinct.select("x", "w").mapInArrow(run, "x array<long>, w long, deviation decimal(38,0), z array<double>")


def whitened(
    vectors: DataFrame,
    components: int = COMPONENTS,
    weights: str = "count",
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """``(vec_id, n, deviation, z, explained, identity_error)``, a row per remaining row.

    ``z`` and ``explained`` are lists over the components, by falling
    eigenvalue; ``weights`` is ``count`` (the fit sees every row) or ``one``
    (every distinct vector once).  ``n`` is the sum of the weights.

    Rows whose vector is null, empty, or holds a null or a non-finite entry are
    dropped, and so are rows whose vector has another length than most rows
    have (the longer in a tie): they have no place in the same space.  Null and
    repeated ids are answered row by row; other columns are ignored.  A
    direction without variance has no component, so equal vectors, a single
    row or an empty table give no components (an empty ``z``, or no row).
    """
    if weights not in ("count", "one"):
        raise ValueError("weights: count or one")
    spark = vectors.sparkSession
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    rows = grid_rows(vectors, id_col, vec_col)
    schema = "vec_id " + rows.schema["vec_id"].dataType.simpleString()
    schema += ", n long, deviation decimal(38,0), z array<double>, explained array<double>, identity_error double"
    distinct = stored(rows.groupBy("x").count(), "distinct-vectors")
    d = _dimension(distinct)
    if not d:
        return spark.createDataFrame([], schema)
    w = F.col("count") if weights == "count" else F.lit(1).cast("long")
    distinct = distinct.where(F.size("x") == d).select("x", w.alias("w"))
    n, sums = weighted_sums(distinct, d)
    cov = weighted_products(distinct, "x", d, np.array(sums) / n) / n
    e, vec = principal(cov, components)
    each = stored(_projected(distinct, n, sums, e, vec), "whitened")
    error = 0.0
    if len(e):
        error = float(np.abs(weighted_products(each, "z", len(e), np.zeros(len(e))) / n - np.eye(len(e))).max())
    share = [float(v) for v in e / np.trace(cov)] if len(e) else []
    out = rows.join(each, "x").select(
        "vec_id",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "z",
        F.array(*map(F.lit, share)).cast("array<double>").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
    return out


def query(vectors: DataFrame) -> DataFrame:
    """A row per remaining row and component; a deviation beyond a long raises."""
    out = whitened(vectors)
    each = out.select("vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "identity_error", "explained", F.posexplode("z").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        "whitened",
        F.element_at("explained", F.col("at") + 1).alias("explained"),
        "identity_error",
    )

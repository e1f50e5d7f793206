"""Exact quantiles of columns by radix selection: the values are never exchanged or sorted.

A double becomes a 64-bit key that sorts like its value.  Four passes look at
16 bits of the keys each: every task counts its values per bin of these bits,
the counts (not the values) meet, and each wanted rank moves into the bin that
holds it.  A later pass only counts values that share the bits found so far, and
after the fourth the bits are the value.  A task sends at most 2^16 counts per
column and wanted rank, however often a value is repeated; the driver sees a row
per column and wanted rank.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlens.session import materialize

DIGIT_BITS = 16
PASSES = 64 // DIGIT_BITS
# Columns counted in one pass, which bounds the counts of a task.
COLUMNS_A_PASS = 16
INFINITE, NAN = 0x7FF0 << 48, 0x7FF8 << 48


def ordered_keys(values: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``k0, k1, ...``: the double columns as longs of the same order, one for both zeros and NaN above
    all numbers: the bits of the absolute value, negated for negative values; NULL stays NULL."""
    at = range(len(cols))
    df = values.select(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(cols)])
    df = df.withColumns({f"a{i}": F.abs(f"v{i}") for i in at})
    # exponent by the logarithm, at most one off; scaling by a power of two is exact
    near = {f"e{i}": F.greatest(F.least(F.floor(F.log2(f"a{i}")), F.lit(1023)), F.lit(-1022)) for i in at}
    df = df.withColumns(near).withColumns({f"m{i}": F.col(f"a{i}") * F.pow(F.lit(2.0), -F.col(f"e{i}")) for i in at})

    def bits(i: int) -> Column:
        a, e, m = F.col(f"a{i}"), F.col(f"e{i}") + 1023, F.col(f"m{i}")
        one = F.lit(2.0**52)
        parts = lambda e, m: F.shiftleft(e, 52) + ((m - 1) * one).cast("long")
        scaled = F.when(m < 1, parts(e - 1, m * 2)).when(m >= 2, parts(e + 1, m / 2)).otherwise(parts(e, m))
        subnormal = (a * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
        whole = F.when(F.isnan(a), NAN).when(a == float("inf"), INFINITE).when(a < 2.0**-1022, subnormal).otherwise(scaled)
        return F.when(a.isNotNull(), F.when(F.col(f"v{i}") < 0, -whole).otherwise(whole))

    return df.select(*[bits(i).alias(f"k{i}") for i in at])


def value_of(key: int) -> float:
    value = struct.unpack("<d", struct.pack("<q", abs(key)))[0]
    return -value if key < 0 else value


def _between(low: float, high: float, share: float) -> float:
    return low if low == high else low + share * (high - low)


def _quantiles_of(keys: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> list[tuple[str, float, float]]:
    spark = keys.sparkSession
    total = Window.partitionBy("col", "prefix")
    upto = total.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # (col, prob, lower or upper neighbour, bits found so far, rank under them, share); the first pass works the rank out
    found: list[tuple] = [(c, p, w, 0, -1, 0.0) for c in range(len(cols)) for p in range(len(probs)) for w in (0, 1)]
    for step in range(PASSES):
        rest = 64 - DIGIT_BITS * step
        wanted = {(c, prefix) for c, _, _, prefix, *_ in found}
        counted = []
        for c in sorted({c for c, _ in wanted}):
            k = F.col(f"k{c}")
            prefix = F.shiftright(k, rest) if step else F.when(k.isNotNull(), F.lit(0).cast("long"))
            prefix = F.when(prefix.isin(sorted(p for x, p in wanted if x == c)), prefix)
            # the first digit carries the sign
            digit = F.shiftright(k, rest - DIGIT_BITS)
            digit = (digit.bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)) if step else digit).cast("int")
            counted.append(F.struct(F.lit(c).alias("col"), prefix.alias("prefix"), digit.alias("bin")))
        if len(counted) == 1:
            digits = keys.select(counted[0].alias("d")).select("d.*")
        else:
            some = reduce(lambda a, b: a | b, [d.getField("prefix").isNotNull() for d in counted])
            digits = keys.where(some).select(F.inline(F.array(*counted)))
        counts = digits.where(F.col("prefix").isNotNull()).groupBy("col", "prefix", "bin").agg(F.count(F.lit(1)).alias("n"))
        counts = counts.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(total)})
        listed = ", ".join(f"({c}, {prefix}L, {p}, {w}, {r}L, {share!r}D, {probs[p]!r}D)" for c, p, w, prefix, r, share in found)
        ranks = spark.sql(f"SELECT * FROM VALUES {listed} AS t(col, prefix, p, w, r, share, prob)")
        rows = counts.join(F.broadcast(ranks), ["col", "prefix"])  # a row per column and rank
        if not step:
            at = (F.col("total") - 1) * F.col("prob")
            rows = rows.withColumns({"r": F.when(F.col("w") == 0, F.floor(at)).otherwise(F.ceil(at)), "share": at - F.floor(at)})
        hit = rows.where((F.col("r") >= F.col("upto") - F.col("n")) & (F.col("r") < F.col("upto")))
        left = (F.col("r") - F.col("upto") + F.col("n")).alias("r")
        longer = (F.shiftleft("prefix", DIGIT_BITS) + F.col("bin")).alias("prefix")
        found = [tuple(x) for x in hit.select("col", "p", "w", longer, left, "share").collect()]
        if not found:
            return []
    ends = {(c, p, w): (value_of(key), share) for c, p, w, key, _, share in found}
    return [(cols[c], probs[p], _between(low, ends[c, p, 1][0], share)) for (c, p, w), (low, share) in sorted(ends.items()) if w == 0]


def column_quantiles(values: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``(feature, p, quantile)``: exact quantiles of double columns with linear interpolation
    (the pandas / numpy default).  ``values`` is read once, into stored keys; four passes count these.

    NULLs are ignored, a column without values has no row, NaN counts as the largest value."""
    probs = [float(p) for p in probs]
    rows = []
    for i in range(0, len(cols), COLUMNS_A_PASS):
        block = list(cols[i : i + COLUMNS_A_PASS])
        rows += _quantiles_of(materialize(ordered_keys(values, block)), block, probs)
    return values.sparkSession.createDataFrame(rows, "feature string, p double, quantile double")

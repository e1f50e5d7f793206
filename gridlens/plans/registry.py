"""Query registry: name -> (Spark builder, optional DuckDB oracle SQL).

A builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame.  Oracle SQL
states the definition in SQL, against the pre-registered views of the driver's
tables; both sides round floating results alike (``rnd``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Builder = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Builder] = {}
_ORACLE: dict[str, str] = {}

# Digits kept for floating results in compared output; both sides round the
# same way so summation-order noise in the last bits does not count.
DIGITS = 6


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = expand_rnd(sql)
        return fn

    return deco


# Rounding used on BOTH sides of the comparison.  Engine ``round`` functions
# break decimal ties differently (one rounds the shortest decimal text, the
# other the binary value), so both sides use the same IEEE arithmetic at every
# magnitude: the nearest integer to x * 10^d, half to even, divided by 10^d.
_SCALE = float(10**DIGITS)


def rnd(c):
    return F.rint(c * F.lit(_SCALE)) / F.lit(_SCALE)


def rnd_sql(expr: str) -> str:
    return f"(round_even(CAST({expr} AS DOUBLE) * 1e6, 0) / 1e6)"


def expand_rnd(sql: str) -> str:
    """Expand ``RND(expr)`` placeholders (balanced parentheses) in oracle SQL."""
    out, i = [], 0
    while True:
        j = sql.find("RND(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 0, j + 3
        while True:
            ch = sql[k]
            depth += ch == "("
            depth -= ch == ")"
            if depth == 0:
                break
            k += 1
        out.append(rnd_sql(expand_rnd(sql[j + 4:k])))
        i = k + 1


def rounded(df: DataFrame) -> DataFrame:
    """Round every double / float column (result frames for comparison)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(rnd(F.col(f"`{f.name}`").cast("double")).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def all_queries() -> dict[str, Builder]:
    _load()
    return dict(_QUERIES)


def all_oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)


def _load() -> None:
    # Importing the query modules fills the registry.
    from gridlens.plans import (  # noqa: F401
        density_queries,
        facility_queries,
        io_queries,
        model_queries,
        report_queries,
        table_queries,
    )

"""Column-expression builders.

All of these return ``Column`` expressions built from ``pyspark.sql.functions``
so they run inside whole-stage codegen; none of them touches Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the source pipeline's for equal results.
# ---------------------------------------------------------------------------
# Text that counts as "true" for the raw gender flag columns (compared lower-cased).
FLAG_TRUE = ["true", "yes", "1"]
# Accessible values in the density job (exact match, no "TRUE").
ACCESSIBLE_STRICT = ["Yes", "yes", "YES", "True", "true"]
# Accessible / changing-place values in the feature jobs (adds "TRUE").
ACCESSIBLE_WIDE = ["Yes", "yes", "YES", "TRUE", "true", "True"]
# Gender text by the raw flag columns that say yes, in this order.
GENDER_RULES = [
    ("Unisex", ["Unisex"]), ("AllGender", ["AllGender"]), ("Male/Female", ["Male", "Female"]),
    ("Male", ["Male"]), ("Female", ["Female"]),
]
# Gender class by case-sensitive substring, first hit wins, else "unknown".
GENDER_CLASSES = [("Unisex", "unisex"), ("Male", "male"), ("Female", "female")]
GENDER_UNKNOWN = "unknown"
# Gender code by the same tests: Unisex 0, Male 1, Female 2, else 3.
GENDER_CODES = [("Unisex", 0), ("Male", 1), ("Female", 2)]
GENDER_CODE_OTHER = 3
# Category code by case-sensitive substring: Park 1, Sport 2, Shopping 3, else 0.
CATEGORY_CODES = [("Park", 1), ("Sport", 2), ("Shopping", 3)]
CATEGORY_CODE_OTHER = 0
# Grid cell size in degrees, and the fallback centre for an empty table.
GRID_SIZE = 0.01
FALLBACK_CENTER = (-31.95, 115.85)
# Metres per degree in the planar distance.
METRES_PER_DEGREE = 111000.0


def optional_column(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column if the frame has it, else a typed NULL literal."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(dtype)


def first_existing(df: DataFrame, names: Sequence[str]) -> str | None:
    """Name of the first column in ``names`` the frame has (column-level choice)."""
    for n in names:
        if n in df.columns:
            return n
    return None


def says_yes(c: Column, truthy: Iterable[str] = FLAG_TRUE) -> Column:
    """Whether the text, in lower case, is one of ``truthy``; NULL for NULL."""
    return F.lower(c.cast("string")).isin(list(truthy))


def gender_from_flags(df: DataFrame) -> Column:
    """The first of ``GENDER_RULES`` whose flag columns the frame has and all say yes; else NULL."""
    hits = []
    for label, flags in GENDER_RULES:
        if set(flags) <= set(df.columns):
            holds = reduce(and_, [says_yes(F.col(f"`{f}`")) for f in flags])
            hits.append(F.when(holds, F.lit(label)))
    return F.coalesce(*hits, F.lit(None).cast("string"))


def flag_in(c: Column, values: Sequence[str]) -> Column:
    """1 when the text is exactly one of ``values``, else 0 (NULL -> 0)."""
    return F.when(c.isin(list(values)), F.lit(1)).otherwise(F.lit(0))


def _first_contains(c: Column, table, other) -> Column:
    expr = None
    for needle, out in table:
        cond = c.contains(needle)
        expr = F.when(cond, F.lit(out)) if expr is None else expr.when(cond, F.lit(out))
    return expr.otherwise(F.lit(other))


def gender_class(c: Column) -> Column:
    return _first_contains(c, GENDER_CLASSES, GENDER_UNKNOWN)


def gender_code(c: Column) -> Column:
    return _first_contains(c, GENDER_CODES, GENDER_CODE_OTHER)


def category_code(c: Column) -> Column:
    return _first_contains(c, CATEGORY_CODES, CATEGORY_CODE_OTHER)


def contains_flag(c: Column, needle: str) -> Column:
    """True when ``c`` contains ``needle``; NULL text counts as false."""
    return F.coalesce(c.contains(needle), F.lit(False))


def grid_bin(c: Column, size: float = GRID_SIZE) -> Column:
    """``floor(c / size)`` as bigint — division, not multiplication."""
    return F.floor(c / F.lit(float(size))).cast("bigint")


def planar_distance(lat: Column, lon: Column, clat: Column, clon: Column) -> Column:
    return F.sqrt(F.pow(lat - clat, 2) + F.pow(lon - clon, 2)) * F.lit(METRES_PER_DEGREE)


def clean_number(c: Column) -> Column:
    """NULL, NaN and +-inf become 0; everything else passes as double."""
    d = c.cast("double")
    bad = d.isNull() | F.isnan(d) | (F.abs(d) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(d)


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def clip_round_count(c: Column) -> Column:
    """Round half to even, clip at 0, bigint (as wide as any count)."""
    return F.greatest(F.lit(0.0), F.rint(c)).cast("bigint")


# Bits of ``stable_hash``.
HASH_BITS = 60


def field_text(c: Column) -> Column:
    """A value's text with its length before it, or a mark that no text gives for NULL,
    so that fields joined one after the other cannot be read in two ways."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def stable_hash(seed, *cols: Column | str) -> Column:
    """A 60-bit non-negative hash of the seed and the columns from md5.

    Independent of partitioning and row order, and reproducible in any SQL
    engine with md5 (first 15 hex digits as an integer).  NULL is a value of
    its own in every place.
    """
    fields = [field_text(F.col(c) if isinstance(c, str) else c) for c in cols]
    text = F.concat(F.lit(f"{seed}|"), *fields)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")

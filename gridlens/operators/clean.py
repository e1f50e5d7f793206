"""Row filters and de-duplication, plus the three cleaning profiles.

Profiles (the three source jobs clean differently; all three are kept):

* ``density``  : coordinates not NULL/NaN -> full-row distinct -> range check
* ``cells``    : coordinates not NULL/NaN -> one row per ``_id`` (NULL ids form one group)
* ``facility`` : ``_id`` and coordinates not NULL/NaN -> one row per ``_id``

Scale notes: the full-row distinct is a hash aggregate with map-side
pre-aggregation, so a value repeated a billion times is reduced before the
shuffle.  ``dedupe_by_key`` keeps rank 1 of ``row_number``; Catalyst turns
that into a partial ``WindowGroupLimit`` *below* the exchange, so a hot key
sends at most one row per map task across the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def drop_null_coords(df: DataFrame, cols: Sequence[str] = ("Latitude", "Longitude")) -> DataFrame:
    # dropna on numeric columns also removes NaN.
    return df.dropna(subset=list(cols))


def in_range(df: DataFrame, lat: str = "Latitude", lon: str = "Longitude") -> DataFrame:
    return df.filter(F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180))


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Full-row distinct, or distinct over ``cols`` only (a projection first)."""
    return (df.select(*cols) if cols else df).dropDuplicates()


def _total_order(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None) -> list[Column]:
    if order:
        return list(order)
    return [F.col(f"`{c}`").asc_nulls_last() for c in df.columns if c not in keys]


def dedupe_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """One row per key.  The survivor is the first row in ``order`` (default:
    every other column ascending, NULLs last), so reruns and copies agree."""
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*_total_order(df, keys, order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def clean(df: DataFrame, profile: str) -> DataFrame:
    if profile == "density":
        return in_range(distinct_rows(drop_null_coords(df)))
    if profile == "cells":
        return dedupe_by_key(drop_null_coords(df), ["_id"])
    if profile == "facility":
        return dedupe_by_key(drop_null_coords(df, ["_id", "Latitude", "Longitude"]), ["_id"])
    raise ValueError(f"unknown cleaning profile {profile!r}")

"""Raw facility records -> the fixed 12-column canonical schema.

One ``select``: optional columns become typed NULLs, old and new names are
coalesced row by row, coordinates are parsed with ``try_cast`` (bad text ->
NULL instead of an ANSI error), and gender falls back to the flag columns.
The whole thing is a single projection that Catalyst fuses into the scan's
codegen stage and prunes to the columns the rest of the plan needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.functions.columns import (
    clean_number,
    optional_column,
    first_existing,
    gender_from_flags,
    nan_to_null,
)

# Canonical column -> accepted source names, coalesced left to right.
ALIASES = {
    "_id": ["_id"],
    "Name": ["Name"],
    "Address": ["Address", "Address1"],
    "Suburb": ["Suburb", "Town"],
    "Postcode": ["Postcode"],
    "Group": ["Group", "State"],
    "Category": ["Category", "FacilityType"],
    "Accessible": ["Accessible"],
    "ChangingPlace": ["ChangingPlace", "ChangingPlaces"],
}
CANONICAL = [
    "_id", "Latitude", "Longitude", "Name", "Address", "Suburb", "Postcode",
    "Group", "Category", "Accessible", "ChangingPlace", "Gender",
]


def _coalesced(df: DataFrame, names: Sequence[str]):
    cols = [optional_column(df, n) for n in names]
    return (cols[0] if len(cols) == 1 else F.coalesce(*cols)).cast("string")


def try_cast_double(df: DataFrame, name: str):
    """Text -> double; unparsable text gives NULL, 'NaN' gives NaN."""
    return optional_column(df, name).cast("string").try_cast("double")


def normalize_facilities(raw: DataFrame) -> DataFrame:
    out = {c: _coalesced(raw, names) for c, names in ALIASES.items()}
    out["Latitude"] = try_cast_double(raw, "Latitude")
    out["Longitude"] = try_cast_double(raw, "Longitude")
    out["Gender"] = F.coalesce(optional_column(raw, "Gender"), gender_from_flags(raw)).cast("string")
    return raw.select(*[out[c].alias(c) for c in CANONICAL])


def select_first_existing(df: DataFrame, choices: dict[str, Sequence[str]]) -> DataFrame:
    """Column-level variant: for each output take the first source column that
    exists in the frame (chosen once, on the driver, from the schema only)."""
    cols = []
    for out, names in choices.items():
        name = first_existing(df, names)
        cols.append((F.col(f"`{name}`") if name else F.lit(None)).cast("string").alias(out))
    return df.select(*cols)


def nulls_for_nans(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NaN -> NULL in the given numeric columns (before a row-store load)."""
    return df.withColumns({c: nan_to_null(F.col(c)) for c in cols})


def fill_features(df: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """Feature cleaning: a missing column is added as 0; NULL, NaN, +-inf -> 0."""
    return df.withColumns(
        {c: clean_number(F.col(c)) if c in df.columns else F.lit(0.0) for c in feature_cols}
    )

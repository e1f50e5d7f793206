"""Feature datasets: per grid cell (count regression) and per facility
(accessibility classification).

Plan shape (cell features)::

    cleaned rows ─ cut ──► centre (one row)
                    │
                    └────► groupBy(cell, Suburb) sums ─ cut ──┬─► per cell: count, averages, dominant suburb
                                                              └─► per suburb: rate, count ──► joined to the cells

The cleaned rows (one dedupe) and the (cell, suburb) sums are stored once and
read by what follows; everything after the sums works on pre-aggregated rows,
so a cell holding a third of the table is one row per suburb there.  Facility
features take both their context counts from one such table and one join.

Joins against aggregated dimensions are left unhinted: AQE turns them into
broadcast joins when the runtime size is under the threshold and otherwise
keeps a sort-merge join whose skewed partitions it splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlens.functions.columns import (
    ACCESSIBLE_WIDE,
    FALLBACK_CENTER,
    category_code,
    contains_flag,
    flag_in,
    gender_code,
    grid_bin,
    planar_distance,
)
from gridlens.operators.normalize import fill_features
from gridlens.operators.ordered import join_null_safe
from gridlens.session import materialize

# Model inputs and targets of the two feature tables.
CELL_FEATURES = [
    "avg_distance_to_center",
    "min_distance_to_center",
    "accessibility_rate",
    "avg_gender_encoded",
    "avg_category_encoded",
    "park_count",
    "sport_count",
    "shopping_count",
    "suburb_accessibility",
    "suburb_toilet_count",
]
CELL_TARGET = "toilet_count"
FACILITY_FEATURES = [
    "distance_to_center",
    "gender_encoded",
    "category_encoded",
    "has_changing_place",
    "suburb_toilet_count",
    "grid_toilet_count",
]
FACILITY_TARGET = "is_accessible"
CELL_KEYS = ("lat_bin", "lon_bin")


def center_point(df: DataFrame, lat: str = "Latitude", lon: str = "Longitude") -> DataFrame:
    """One row (center_lat, center_lon); the fixed fallback when the table is empty."""
    return df.agg(
        F.coalesce(F.avg(lat), F.lit(FALLBACK_CENTER[0])).alias("center_lat"),
        F.coalesce(F.avg(lon), F.lit(FALLBACK_CENTER[1])).alias("center_lon"),
    )


def with_distance(df: DataFrame, center: DataFrame | None = None) -> DataFrame:
    center = center if center is not None else center_point(df)
    c = center.select(F.struct("center_lat", "center_lon")).scalar()  # one row, computed once
    return df.withColumn(
        "distance_to_center",
        planar_distance(F.col("Latitude"), F.col("Longitude"), c.getField("center_lat"), c.getField("center_lon")),
    )


def encode(df: DataFrame) -> DataFrame:
    """Bins, wide accessible / changing-place flags, gender and category codes."""
    return df.withColumns(
        {
            "lat_bin": grid_bin(F.col("Latitude")),
            "lon_bin": grid_bin(F.col("Longitude")),
            "is_accessible": flag_in(F.col("Accessible"), ACCESSIBLE_WIDE),
            "has_changing_place": flag_in(F.col("ChangingPlace"), ACCESSIBLE_WIDE),
            "gender_encoded": gender_code(F.col("Gender")),
            "category_encoded": category_code(F.col("Category")),
        }
    )


def feature_rows(clean_df: DataFrame) -> DataFrame:
    """Per-facility derived columns on cleaned rows (codes, bins, distance).

    The cleaned rows are cut here: the centre and the features both read them."""
    return with_distance(materialize(encode(clean_df)))


def cell_suburb_partials(rows: DataFrame) -> DataFrame:
    """The one aggregation every cell / suburb output is rolled up from."""
    cat = F.col("Category")
    return rows.groupBy(*CELL_KEYS, "Suburb").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("distance_to_center").alias("sum_dist"),
        F.min("distance_to_center").alias("min_dist"),
        F.sum("is_accessible").alias("sum_acc"),
        F.sum("gender_encoded").alias("sum_gender"),
        F.sum("category_encoded").alias("sum_cat"),
        F.count_if(contains_flag(cat, "Park")).alias("park"),
        F.count_if(contains_flag(cat, "Sport")).alias("sport"),
        F.count_if(contains_flag(cat, "Shopping")).alias("shop"),
    )


def dominant_value(partials: DataFrame, value: str = "Suburb", count_col: str = "n",
                   keys=CELL_KEYS, out: str = "dominant_suburb") -> DataFrame:
    """Most frequent value per key; ties by value ascending, NULL last — but a
    NULL value with the highest count still wins (unlike ``mode``)."""
    w = Window.partitionBy(*keys).orderBy(F.col(count_col).desc(), F.col(value).asc_nulls_last())
    return (
        partials.select(*keys, value, count_col)
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .select(*keys, F.col(value).alias(out))
    )


def suburb_rollup(partials: DataFrame) -> DataFrame:
    return partials.groupBy("Suburb").agg(
        (F.sum("sum_acc") / F.sum("n")).alias("suburb_accessibility"),
        F.sum("n").alias("suburb_toilet_count"),
    )


def _stamped(df: DataFrame, stamp) -> DataFrame:
    """``created_at``: one literal per run, so every copy of a table carries the same value."""
    return df if stamp is None else df.withColumn("created_at", F.lit(stamp).cast("timestamp"))


def cell_features(rows: DataFrame, stamp=None) -> DataFrame:
    """One row per grid cell: count target + 10 features."""
    parts = materialize(cell_suburb_partials(rows))
    per_row = {
        "avg_distance_to_center": "sum_dist",
        "accessibility_rate": "sum_acc",
        "avg_gender_encoded": "sum_gender",
        "avg_category_encoded": "sum_cat",
    }
    # most rows first, then the name, a missing name last
    leading = F.min(F.struct((-F.col("n")).alias("less"), F.col("Suburb").isNull().alias("none"), F.col("Suburb").alias("name")))
    cells = parts.groupBy(*CELL_KEYS).agg(
        F.sum("n").alias("toilet_count"),
        F.min("min_dist").alias("min_distance_to_center"),
        *[(F.sum(total) / F.sum("n")).alias(name) for name, total in per_row.items()],
        *[F.sum(kind).alias(f"{name}_count") for name, kind in (("park", "park"), ("sport", "sport"), ("shopping", "shop"))],
        leading.alias("leading"),
    )
    around = suburb_rollup(parts).withColumnRenamed("Suburb", "_suburb")
    joined = cells.join(around, F.col("leading.name") == F.col("_suburb"), "left")
    return _stamped(joined.select(*CELL_KEYS, CELL_TARGET, *CELL_FEATURES), stamp)


def facility_features(rows: DataFrame, stamp=None) -> DataFrame:
    """One row per facility: 6 features + accessibility target."""
    place = [*CELL_KEYS, "Suburb"]
    pairs = rows.groupBy(*place).agg(F.count(F.lit(1)).alias("_n"))
    # (cell, suburb) pairs, not rows, are summed again; a missing suburb has no count
    suburbs = pairs.filter(F.col("Suburb").isNotNull()).groupBy(F.col("Suburb").alias("_suburb")).agg(
        F.sum("_n").alias("suburb_toilet_count"))
    cells = pairs.groupBy(*CELL_KEYS).agg(F.sum("_n").alias("grid_toilet_count"))
    context = join_null_safe(pairs.select(*place), cells, list(CELL_KEYS), "left").join(
        suburbs, F.col("Suburb") == F.col("_suburb"), "left").drop("_suburb")
    known = join_null_safe(rows, context, place, "left").withColumn("_id", F.col("_id").cast("string"))
    return _stamped(known.select("_id", *CELL_KEYS, *FACILITY_FEATURES, FACILITY_TARGET), stamp)


def prepare(df: DataFrame, features, target: str, keys=(), integer_target: bool = False) -> DataFrame:
    """Model input: keys, cleaned features (missing/NULL/NaN/inf -> 0), target
    (must exist; NULL -> 0; int for classes)."""
    if target not in df.columns:
        raise ValueError(f"prepare: the frame has no column {target!r} to predict")
    y = F.coalesce(F.col(target), F.lit(0))
    y = y.cast("int") if integer_target else y.cast("double")
    filled = fill_features(df, features)
    return filled.select(*keys, *features, y.alias(target))

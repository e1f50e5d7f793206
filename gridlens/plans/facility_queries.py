"""Driver queries: normalisation, cleaning, suburbs, feature datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlens.functions import columns as C
from gridlens.operators import clean, datasets, density, normalize
from gridlens.plans.oracle_sql import COORDS_OK, STRICT, WIDE, with_ctes
from gridlens.plans.registry import register, rounded
from gridlens.sources import tables


def facilities(spark, sf_dir):
    return normalize.normalize_facilities(tables.facility_raw(spark, sf_dir))


def cell_rows(spark, sf_dir):
    return datasets.feature_rows(clean.clean(facilities(spark, sf_dir), "cells"))


def facility_rows(spark, sf_dir):
    return datasets.feature_rows(clean.clean(facilities(spark, sf_dir), "facility"))


def density_rows(spark, sf_dir):
    return density.density_features(clean.clean(facilities(spark, sf_dir), "density"))


_FAC_COLS = ('"_id", RND("Latitude") AS "Latitude", RND("Longitude") AS "Longitude", "Name", '
             '"Address", "Suburb", "Postcode", "Group", "Category", "Accessible", "ChangingPlace", "Gender"')

# ---------------------------------------------------------------- normalise


@register("normalize_facilities", with_ctes(["fac"], f"SELECT {_FAC_COLS} FROM fac"))
def q_normalize_facilities(spark, sf_dir):
    return rounded(facilities(spark, sf_dir))


@register(
    "first_existing_col",
    with_ctes(["raw_fac"], """
SELECT "_id", "Address1" AS "Address", "State" AS "Group", "Suburb", "ChangingPlaces" AS "ChangingPlace"
FROM raw_fac"""),
)
def q_first_existing_col(spark, sf_dir):
    raw = tables.facility_raw(spark, sf_dir)
    return normalize.select_first_existing(
        raw,
        {
            "_id": ["_id"],
            "Address": ["Address", "Address1"],
            "Group": ["Group", "State"],
            "Suburb": ["Suburb", "Town"],  # column-level: Suburb exists, Town is never read
            "ChangingPlace": ["ChangingPlace", "ChangingPlaces"],
        },
    )


@register(
    "try_cast_coords",
    with_ctes(["raw_fac"], """
SELECT "_id", CASE WHEN NOT regexp_full_match("Latitude", '-?[0-9]+\\.[0-9]+') THEN "Latitude" END AS junk_text,
       RND(TRY_CAST("Latitude" AS DOUBLE)) AS "Latitude",
       TRY_CAST("Latitude" AS DOUBLE) IS NULL AS lat_is_null,
       COALESCE(isnan(TRY_CAST("Latitude" AS DOUBLE)), false) AS lat_is_nan
FROM raw_fac"""),
)
def q_try_cast_coords(spark, sf_dir):
    # every row, with the text where it is no plain decimal (junk, NaN, ...)
    raw = tables.facility_raw(spark, sf_dir)
    lat = normalize.try_cast_double(raw, "Latitude")
    return rounded(
        raw.select(
            "_id",
            F.when(~F.col("Latitude").rlike(r"^-?[0-9]+\.[0-9]+$"), F.col("Latitude")).alias("junk_text"),
            lat.alias("Latitude"),
            lat.isNull().alias("lat_is_null"),
            F.coalesce(F.isnan(lat), F.lit(False)).alias("lat_is_nan"),
        )
    )


@register(
    "gender_from_flags",
    with_ctes(["raw_fac"], """
SELECT "_id", "Gender" AS gender_text, "Unisex", "AllGender", "Male", "Female",
       COALESCE("Gender",
         CASE WHEN lower("Unisex") IN ('true', 'yes', '1') THEN 'Unisex'
              WHEN lower("AllGender") IN ('true', 'yes', '1') THEN 'AllGender'
              WHEN lower("Male") IN ('true', 'yes', '1') AND lower("Female") IN ('true', 'yes', '1') THEN 'Male/Female'
              WHEN lower("Male") IN ('true', 'yes', '1') THEN 'Male'
              WHEN lower("Female") IN ('true', 'yes', '1') THEN 'Female' END) AS "Gender"
FROM raw_fac"""),
)
def q_gender_from_flags(spark, sf_dir):
    raw = tables.facility_raw(spark, sf_dir)
    return raw.select(
        "_id",
        F.col("Gender").alias("gender_text"),
        "Unisex",
        "AllGender",
        "Male",
        "Female",
        F.coalesce(F.col("Gender"), C.gender_from_flags(raw)).alias("Gender"),
    )


@register(
    "nan_to_null",
    with_ctes(["fac"], """
SELECT "_id", CASE WHEN isnan("Latitude") THEN NULL ELSE RND("Latitude") END AS "Latitude",
       RND("Longitude") AS "Longitude"
FROM fac"""),
)
def q_nan_to_null(spark, sf_dir):
    df = facilities(spark, sf_dir).select("_id", "Latitude", "Longitude")
    return rounded(normalize.nulls_for_nans(df, ["Latitude", "Longitude"]))


# ---------------------------------------------------------------- clean


@register("clean_grid_rows", with_ctes(["fac_density"], f"SELECT {_FAC_COLS} FROM fac_density"))
def q_clean_grid_rows(spark, sf_dir):
    return rounded(clean.clean(facilities(spark, sf_dir), "density"))


@register("clean_facility_rows", with_ctes(["fac_facility"], f"SELECT {_FAC_COLS} FROM fac_facility"))
def q_clean_facility_rows(spark, sf_dir):
    return rounded(clean.clean(facilities(spark, sf_dir), "facility"))


@register("clean_cell_rows", with_ctes(["fac_cells"], f"SELECT {_FAC_COLS} FROM fac_cells"))
def q_clean_cell_rows(spark, sf_dir):
    return rounded(clean.clean(facilities(spark, sf_dir), "cells"))


@register(
    "distinct_rows",
    """
SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount, l_tax FROM lineitem""",
)
def q_distinct_rows(spark, sf_dir):
    li = tables.load(spark, sf_dir, "lineitem")
    return clean.distinct_rows(li, ["l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax"])


@register(
    "dedupe_by_key",
    """
SELECT * EXCLUDE (rn) FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_shipdate,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY l_shipdate DESC, l_partkey ASC, l_quantity ASC, l_extendedprice ASC) AS rn
  FROM lineitem) t
WHERE rn = 1""",
)
def q_dedupe_by_key(spark, sf_dir):
    # (l_orderkey, l_linenumber) repeats in the test table: keep the latest
    # shipment per key with a total tie-break.
    li = tables.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    order = [F.col("l_shipdate").desc(), F.col("l_partkey"), F.col("l_quantity"), F.col("l_extendedprice")]
    return clean.dedupe_by_key(li, ["l_orderkey", "l_linenumber"], order)


# ---------------------------------------------------------------- flags and codes


@register(
    "accessible_flag_strict",
    with_ctes(["fac"], f"""
SELECT "_id", "Accessible", CASE WHEN "Accessible" IN {STRICT} THEN 1 ELSE 0 END AS is_accessible FROM fac"""),
)
def q_accessible_flag_strict(spark, sf_dir):
    df = facilities(spark, sf_dir)
    return df.select("_id", "Accessible", C.flag_in(F.col("Accessible"), C.ACCESSIBLE_STRICT).alias("is_accessible"))


@register(
    "accessible_flag_wide",
    with_ctes(["fac"], f"""
SELECT "_id", "Accessible", "ChangingPlace",
       CASE WHEN "Accessible" IN {WIDE} THEN 1 ELSE 0 END AS is_accessible,
       CASE WHEN "ChangingPlace" IN {WIDE} THEN 1 ELSE 0 END AS has_changing_place
FROM fac"""),
)
def q_accessible_flag_wide(spark, sf_dir):
    df = facilities(spark, sf_dir)
    return df.select(
        "_id",
        "Accessible",
        "ChangingPlace",
        C.flag_in(F.col("Accessible"), C.ACCESSIBLE_WIDE).alias("is_accessible"),
        C.flag_in(F.col("ChangingPlace"), C.ACCESSIBLE_WIDE).alias("has_changing_place"),
    )


@register(
    "gender_type",
    with_ctes(["fac"], """
SELECT "_id", "Gender",
       CASE WHEN contains("Gender", 'Unisex') THEN 'unisex' WHEN contains("Gender", 'Male') THEN 'male'
            WHEN contains("Gender", 'Female') THEN 'female' ELSE 'unknown' END AS gender_type
FROM fac"""),
)
def q_gender_type(spark, sf_dir):
    df = facilities(spark, sf_dir)
    return df.select("_id", "Gender", C.gender_class(F.col("Gender")).alias("gender_type"))


@register(
    "encode_codes",
    with_ctes(["fac"], """
SELECT "_id", "Gender", "Category",
       CASE WHEN contains("Gender", 'Unisex') THEN 0 WHEN contains("Gender", 'Male') THEN 1
            WHEN contains("Gender", 'Female') THEN 2 ELSE 3 END AS gender_encoded,
       CASE WHEN contains("Category", 'Park') THEN 1 WHEN contains("Category", 'Sport') THEN 2
            WHEN contains("Category", 'Shopping') THEN 3 ELSE 0 END AS category_encoded
FROM fac"""),
)
def q_encode_codes(spark, sf_dir):
    df = facilities(spark, sf_dir)
    return df.select(
        "_id",
        "Gender",
        "Category",
        C.gender_code(F.col("Gender")).alias("gender_encoded"),
        C.category_code(F.col("Category")).alias("category_encoded"),
    )


@register(
    "like_filter",
    "SELECT p_partkey, p_name, p_brand FROM part WHERE p_name LIKE '%red%'",
)
def q_like_filter(spark, sf_dir):
    # Catalogue search: a LIKE pattern over a landed text column (pushed to the scan).
    part = tables.load(spark, sf_dir, "part")
    return part.filter(F.col("p_name").like("%red%")).select("p_partkey", "p_name", "p_brand")


# ---------------------------------------------------------------- suburbs

_SUBURB_STATS = f"""
SELECT "Suburb", "Postcode", RND(avg("Latitude")) AS avg_lat, RND(avg("Longitude")) AS avg_lon,
       RND(avg(CASE WHEN "Accessible" IN {STRICT} THEN 1 ELSE 0 END)) AS accessibility_rate,
       count(*) AS toilet_count
FROM fac_density GROUP BY "Suburb", "Postcode\""""


@register("suburb_stats", with_ctes(["fac_density"], _SUBURB_STATS))
def q_suburb_stats(spark, sf_dir):
    return rounded(density.suburb_stats(density_rows(spark, sf_dir)))


@register(
    "suburb_access",
    with_ctes(["cell_rows"], """
SELECT "Suburb", RND(avg(is_accessible)) AS suburb_accessibility, count(*) AS suburb_toilet_count
FROM cell_rows GROUP BY "Suburb\""""),
)
def q_suburb_access(spark, sf_dir):
    parts = datasets.cell_suburb_partials(cell_rows(spark, sf_dir))
    return rounded(datasets.suburb_rollup(parts))


@register(
    "suburbs_top20",
    with_ctes(["fac_density"], "SELECT * FROM (" + _SUBURB_STATS + """) t
ORDER BY toilet_count DESC, "Suburb" ASC NULLS LAST, "Postcode" ASC NULLS LAST LIMIT 20"""),
)
def q_suburbs_top20(spark, sf_dir):
    return rounded(density.suburb_stats(density_rows(spark, sf_dir)).limit(20))


@register(
    "low_access_suburbs",
    with_ctes(["fac_density"], "SELECT * FROM (" + _SUBURB_STATS + ") t WHERE accessibility_rate < 0.5"),
)
def q_low_access_suburbs(spark, sf_dir):
    stats = density.suburb_stats(density_rows(spark, sf_dir), sort=False)
    return rounded(stats.filter(F.col("accessibility_rate") < 0.5))


@register(
    "map_points",
    with_ctes(["fac"], f"""
SELECT "_id", "Name", RND("Latitude") AS "Latitude", RND("Longitude") AS "Longitude", "Suburb"
FROM fac WHERE {COORDS_OK}"""),
)
def q_map_points(spark, sf_dir):
    df = clean.drop_null_coords(facilities(spark, sf_dir))
    return rounded(df.select("_id", "Name", "Latitude", "Longitude", "Suburb"))


# ---------------------------------------------------------------- datasets


@register(
    "center_point",
    with_ctes(["fac_cells"], """
SELECT RND(COALESCE(avg("Latitude"), -3195e-2)) AS center_lat,
       RND(COALESCE(avg("Longitude"), 11585e-2)) AS center_lon
FROM fac_cells"""),
)
def q_center_point(spark, sf_dir):
    return rounded(datasets.center_point(clean.clean(facilities(spark, sf_dir), "cells")))


@register(
    "distance_to_center",
    with_ctes(["cell_rows"], 'SELECT "_id", lat_bin, lon_bin, RND(distance_to_center) AS distance_to_center FROM cell_rows'),
)
def q_distance_to_center(spark, sf_dir):
    return rounded(cell_rows(spark, sf_dir).select("_id", "lat_bin", "lon_bin", "distance_to_center"))


@register(
    "dominant_value",
    with_ctes(["cell_features"], "SELECT * FROM cell_dom"),
)
def q_dominant_value(spark, sf_dir):
    return datasets.dominant_value(datasets.cell_suburb_partials(cell_rows(spark, sf_dir)))


_CELL_COLS = """lat_bin, lon_bin, toilet_count,
  RND(avg_distance_to_center) AS avg_distance_to_center,
  RND(min_distance_to_center) AS min_distance_to_center,
  RND(accessibility_rate) AS accessibility_rate,
  RND(avg_gender_encoded) AS avg_gender_encoded,
  RND(avg_category_encoded) AS avg_category_encoded,
  park_count, sport_count, shopping_count,
  RND(suburb_accessibility) AS suburb_accessibility, suburb_toilet_count"""


# The stamp of one run: every row of its tables carries it.
RUN_STAMP = "2026-01-01 00:00:00"


@register(
    "stamped_cell_features",
    with_ctes(["cell_features"], f"SELECT lat_bin, lon_bin, toilet_count, TIMESTAMP '{RUN_STAMP}' AS created_at FROM cell_features"),
)
def q_stamped_cell_features(spark, sf_dir):
    cells = datasets.cell_features(cell_rows(spark, sf_dir), stamp=RUN_STAMP)
    return cells.select("lat_bin", "lon_bin", "toilet_count", F.col("created_at").cast("timestamp_ntz").alias("created_at"))


@register("cell_features", with_ctes(["cell_features"], f"SELECT {_CELL_COLS} FROM cell_features"))
def q_cell_features(spark, sf_dir):
    return rounded(datasets.cell_features(cell_rows(spark, sf_dir)))


@register(
    "facility_features",
    with_ctes(["facility_features"], """
SELECT "_id", lat_bin, lon_bin, RND(distance_to_center) AS distance_to_center, gender_encoded,
       category_encoded, has_changing_place, suburb_toilet_count, grid_toilet_count, is_accessible
FROM facility_features"""),
)
def q_facility_features(spark, sf_dir):
    return rounded(datasets.facility_features(facility_rows(spark, sf_dir)))


def _clean_sql(c: str) -> str:
    return (f'CASE WHEN {c} IS NULL OR isnan(CAST({c} AS DOUBLE)) OR isinf(CAST({c} AS DOUBLE)) '
            f'THEN 0e0 ELSE RND(CAST({c} AS DOUBLE)) END AS {c}')


@register(
    "prepare_features",
    with_ctes(["cell_features"], "SELECT lat_bin, lon_bin, "
              + ", ".join(_clean_sql(c) for c in datasets.CELL_FEATURES)
              + ", CAST(COALESCE(toilet_count, 0) AS DOUBLE) AS toilet_count FROM cell_features"),
)
def q_prepare_features(spark, sf_dir):
    cells = datasets.cell_features(cell_rows(spark, sf_dir))
    return rounded(datasets.prepare(cells, datasets.CELL_FEATURES, datasets.CELL_TARGET, keys=datasets.CELL_KEYS))

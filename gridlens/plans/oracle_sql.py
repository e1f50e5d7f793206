"""Shared SQL fragments for the DuckDB oracle (common table expressions).

These restate the facility binding and the canonical normalisation in plain
SQL so each oracle query is self-contained: ``with_ctes(names, body)``.
"""

from __future__ import annotations

_TRUE3 = "('true', 'yes', '1')"
_WIDE = "('Yes', 'yes', 'YES', 'TRUE', 'true', 'True')"
_STRICT = "('Yes', 'yes', 'YES', 'True', 'true')"

CTES: dict[str, str] = {}

CTES["raw_fac"] = """
raw_fac AS (
  SELECT
    CAST(CASE WHEN c_custkey % 211 = 0 THEN NULL
              WHEN c_custkey % 50 = 49 THEN c_custkey - 1 ELSE c_custkey END AS VARCHAR) AS "_id",
    CASE WHEN c_custkey % 97 = 0 THEN NULL
         WHEN c_custkey % 89 = 0 THEN 'unknown'
         WHEN c_custkey % 83 = 0 THEN 'NaN'
         WHEN c_custkey % 101 = 0 THEN '95.0'
         ELSE CAST(-32e0 + n_nationkey * 0.015625e0 + (c_custkey % 13) * 0.001953125e0 AS VARCHAR) END AS "Latitude",
    CAST(115.75e0 + floor(c_acctbal) * 0.00006103515625e0 AS VARCHAR) AS "Longitude",
    c_name AS "Name",
    'Lot ' || CAST(c_custkey AS VARCHAR) AS "Address1",
    CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN n_name END AS "Suburb",
    CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 3 <> 0 THEN n_name END AS "Town",
    CAST(6000 + n_nationkey * 2 + c_custkey % 2 AS VARCHAR) AS "Postcode",
    r_name AS "State",
    CASE c_mktsegment WHEN 'BUILDING' THEN 'Park or reserve' WHEN 'MACHINERY' THEN 'Sporting facility'
                      WHEN 'HOUSEHOLD' THEN 'Shopping centre' WHEN 'FURNITURE' THEN NULL
                      ELSE c_mktsegment END AS "Category",
    CASE WHEN (c_mktsegment IN ('BUILDING', 'HOUSEHOLD')) = (c_custkey % 11 < 9)
         THEN CASE c_custkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'true' ELSE 'TRUE' END
         ELSE CASE c_custkey % 3 WHEN 0 THEN 'No' WHEN 1 THEN 'False' END END AS "Accessible",
    CASE c_custkey % 7 WHEN 0 THEN 'True' WHEN 1 THEN 'False' WHEN 2 THEN 'TRUE' ELSE NULL END AS "ChangingPlaces",
    CASE c_custkey % 5 WHEN 0 THEN 'Unisex' WHEN 1 THEN 'Male' WHEN 2 THEN 'Female'
                       WHEN 3 THEN 'Male/Female' ELSE NULL END AS "Gender",
    CASE WHEN c_custkey % 8 IN (0, 1) THEN 'True' ELSE 'False' END AS "Unisex",
    CASE WHEN c_custkey % 8 = 5 THEN 'TRUE' END AS "AllGender",
    CASE WHEN c_custkey % 8 IN (2, 3) THEN 'yes' END AS "Male",
    CASE WHEN c_custkey % 8 IN (3, 4) THEN '1' END AS "Female"
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

CTES["fac"] = f"""
fac AS (
  SELECT "_id",
         TRY_CAST("Latitude" AS DOUBLE) AS "Latitude",
         TRY_CAST("Longitude" AS DOUBLE) AS "Longitude",
         "Name", "Address1" AS "Address", COALESCE("Suburb", "Town") AS "Suburb", "Postcode",
         "State" AS "Group", "Category", "Accessible", "ChangingPlaces" AS "ChangingPlace",
         COALESCE("Gender",
           CASE WHEN lower("Unisex") IN {_TRUE3} THEN 'Unisex'
                WHEN lower("AllGender") IN {_TRUE3} THEN 'AllGender'
                WHEN lower("Male") IN {_TRUE3} AND lower("Female") IN {_TRUE3} THEN 'Male/Female'
                WHEN lower("Male") IN {_TRUE3} THEN 'Male'
                WHEN lower("Female") IN {_TRUE3} THEN 'Female' END) AS "Gender"
  FROM raw_fac
)"""

# coordinates present (not NULL, not NaN)
_COORDS_OK = '"Latitude" IS NOT NULL AND "Longitude" IS NOT NULL AND NOT isnan("Latitude") AND NOT isnan("Longitude")'

CTES["fac_density"] = f"""
fac_density AS (
  SELECT DISTINCT * FROM fac
  WHERE {_COORDS_OK}
    AND "Latitude" BETWEEN -90 AND 90 AND "Longitude" BETWEEN -180 AND 180
)"""

_ALL_BUT_ID = ', '.join(
    f'"{c}" ASC NULLS LAST'
    for c in ["Latitude", "Longitude", "Name", "Address", "Suburb", "Postcode", "Group",
              "Category", "Accessible", "ChangingPlace", "Gender"]
)

CTES["fac_cells"] = f"""
fac_cells AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY "_id" ORDER BY {_ALL_BUT_ID}) AS rn
    FROM fac WHERE {_COORDS_OK}) t
  WHERE rn = 1
)"""

CTES["fac_facility"] = f"""
fac_facility AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY "_id" ORDER BY {_ALL_BUT_ID}) AS rn
    FROM fac WHERE "_id" IS NOT NULL AND {_COORDS_OK}) t
  WHERE rn = 1
)"""

# feature columns shared by both feature jobs (wide accessible list, codes)
_FEATURE_COLS = f"""
    CAST(floor("Latitude" / 1e-2) AS BIGINT) AS lat_bin,
    CAST(floor("Longitude" / 1e-2) AS BIGINT) AS lon_bin,
    CASE WHEN "Accessible" IN {_WIDE} THEN 1 ELSE 0 END AS is_accessible,
    CASE WHEN "ChangingPlace" IN {_WIDE} THEN 1 ELSE 0 END AS has_changing_place,
    CASE WHEN contains("Gender", 'Unisex') THEN 0 WHEN contains("Gender", 'Male') THEN 1
         WHEN contains("Gender", 'Female') THEN 2 ELSE 3 END AS gender_encoded,
    CASE WHEN contains("Category", 'Park') THEN 1 WHEN contains("Category", 'Sport') THEN 2
         WHEN contains("Category", 'Shopping') THEN 3 ELSE 0 END AS category_encoded"""

CTES["cell_rows"] = f"""
cell_center AS (
  SELECT COALESCE(avg("Latitude"), -3195e-2) AS clat, COALESCE(avg("Longitude"), 11585e-2) AS clon
  FROM fac_cells
),
cell_rows AS (
  SELECT f.*, {_FEATURE_COLS},
    sqrt(pow("Latitude" - clat, 2) + pow("Longitude" - clon, 2)) * 111000e0 AS distance_to_center
  FROM fac_cells f CROSS JOIN cell_center
)"""

CTES["facility_rows"] = f"""
facility_center AS (
  SELECT COALESCE(avg("Latitude"), -3195e-2) AS clat, COALESCE(avg("Longitude"), 11585e-2) AS clon
  FROM fac_facility
),
facility_rows AS (
  SELECT f.*, {_FEATURE_COLS},
    sqrt(pow("Latitude" - clat, 2) + pow("Longitude" - clon, 2)) * 111000e0 AS distance_to_center
  FROM fac_facility f CROSS JOIN facility_center
)"""

CTES["cell_features"] = f"""
cell_dom AS (
  SELECT lat_bin, lon_bin, "Suburb" AS dominant_suburb FROM (
    SELECT lat_bin, lon_bin, "Suburb",
           row_number() OVER (PARTITION BY lat_bin, lon_bin
                              ORDER BY count(*) DESC, "Suburb" ASC NULLS LAST) AS rn
    FROM cell_rows GROUP BY lat_bin, lon_bin, "Suburb") t
  WHERE rn = 1
),
cell_suburb AS (
  SELECT "Suburb", avg(is_accessible) AS suburb_accessibility, count(*) AS suburb_toilet_count
  FROM cell_rows GROUP BY "Suburb"
),
cell_agg AS (
  SELECT lat_bin, lon_bin, count(*) AS toilet_count,
         avg(distance_to_center) AS avg_distance_to_center,
         min(distance_to_center) AS min_distance_to_center,
         avg(is_accessible) AS accessibility_rate,
         avg(gender_encoded) AS avg_gender_encoded,
         avg(category_encoded) AS avg_category_encoded,
         count_if(COALESCE(contains("Category", 'Park'), false)) AS park_count,
         count_if(COALESCE(contains("Category", 'Sport'), false)) AS sport_count,
         count_if(COALESCE(contains("Category", 'Shopping'), false)) AS shopping_count
  FROM cell_rows GROUP BY lat_bin, lon_bin
),
cell_features AS (
  SELECT a.*, s.suburb_accessibility, s.suburb_toilet_count
  FROM cell_agg a
  LEFT JOIN cell_dom d ON a.lat_bin = d.lat_bin AND a.lon_bin = d.lon_bin
  LEFT JOIN cell_suburb s ON d.dominant_suburb = s."Suburb"
)"""

CTES["facility_features"] = """
facility_features AS (
  SELECT r."_id", r.lat_bin, r.lon_bin, r.distance_to_center, r.gender_encoded, r.category_encoded,
         r.has_changing_place, sc.suburb_toilet_count, gc.grid_toilet_count, r.is_accessible
  FROM facility_rows r
  LEFT JOIN (SELECT "Suburb", count(*) AS suburb_toilet_count FROM facility_rows GROUP BY "Suburb") sc
         ON r."Suburb" = sc."Suburb"
  LEFT JOIN (SELECT lat_bin, lon_bin, count(*) AS grid_toilet_count FROM facility_rows GROUP BY lat_bin, lon_bin) gc
         ON r.lat_bin = gc.lat_bin AND r.lon_bin = gc.lon_bin
)"""

CTES["li_counts"] = """
li_counts AS (
  SELECT CAST(floor(l_extendedprice / 1000e0) AS BIGINT) AS x_bin,
         CAST(floor(l_quantity / 5e0) AS BIGINT) AS y_bin,
         count(*) AS toilet_count
  FROM lineitem GROUP BY 1, 2
)"""

CTES["ev_z"] = """
ev_counts AS (
  SELECT CAST(floor(value / 10e0) AS BIGINT) AS x_bin, CAST(floor(CAST(user_id % 7 AS DOUBLE) / 1e0) AS BIGINT) AS y_bin,
         count(*) AS toilet_count
  FROM events GROUP BY 1, 2),
ev_stats AS (SELECT avg(toilet_count) AS mean, stddev_samp(toilet_count) AS std FROM ev_counts),
ev_z AS (
  SELECT x_bin, y_bin, toilet_count, CASE WHEN std = 0 THEN NULL ELSE (toilet_count - mean) / std END AS z_score
  FROM ev_counts CROSS JOIN ev_stats)"""

CTES["li_z"] = """
li_stats AS (
  SELECT COALESCE(avg(toilet_count), 0e0) AS mean, COALESCE(stddev_samp(toilet_count), 1e0) AS std
  FROM li_counts
),
li_z AS (
  SELECT x_bin, y_bin, toilet_count,
         CASE WHEN std = 0 THEN NULL ELSE (toilet_count - mean) / std END AS z_score
  FROM li_counts CROSS JOIN li_stats
)"""

# dependencies between fragments (emitted in this order)
_ORDER = ["raw_fac", "fac", "fac_density", "fac_cells", "fac_facility", "cell_rows",
          "facility_rows", "cell_features", "facility_features", "li_counts", "li_z", "ev_z"]
_DEPS = {
    "fac": ["raw_fac"],
    "fac_density": ["fac"],
    "fac_cells": ["fac"],
    "fac_facility": ["fac"],
    "cell_rows": ["fac_cells"],
    "facility_rows": ["fac_facility"],
    "cell_features": ["cell_rows"],
    "facility_features": ["facility_rows"],
    "li_z": ["li_counts"],
}


def with_ctes(names: list[str], body: str, more: str = "") -> str:
    """``WITH <needed fragments>[, more] body`` — ``more`` adds query-local CTEs."""
    need: set[str] = set()

    def add(n: str) -> None:
        if n in need:
            return
        need.add(n)
        for d in _DEPS.get(n, []):
            add(d)

    for n in names:
        add(n)
    parts = [CTES[n].strip() for n in _ORDER if n in need]
    if more.strip():
        parts.append(more.strip())
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


STRICT = _STRICT
WIDE = _WIDE
COORDS_OK = _COORDS_OK

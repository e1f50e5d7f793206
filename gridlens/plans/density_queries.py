"""Driver queries: grid density (bins, counts, z-scores, hot and sparse cells)."""

from __future__ import annotations

from gridlens.operators import clean, density, normalize
from gridlens.plans.oracle_sql import with_ctes
from gridlens.plans.registry import register, rounded
from gridlens.sources import tables


def lineitem_counts(spark, sf_dir):
    pts = tables.lineitem_points(spark, sf_dir)
    sx, sy = tables.LINEITEM_CELL
    binned = density.add_bins(pts, "x", "y", sx, sy, names=("x_bin", "y_bin"))
    return density.grid_counts(binned, keys=("x_bin", "y_bin"))


def lineitem_z(spark, sf_dir):
    return density.grid_zscore(lineitem_counts(spark, sf_dir))


def event_z(spark, sf_dir):
    sx, sy = tables.EVENT_CELL
    binned = density.add_bins(tables.event_points(spark, sf_dir), "x", "y", sx, sy, names=("x_bin", "y_bin"))
    return density.grid_zscore(density.grid_counts(binned, keys=("x_bin", "y_bin")))


def facilities(spark, sf_dir):
    return normalize.normalize_facilities(tables.facility_raw(spark, sf_dir))


@register(
    "grid_bin",
    with_ctes(["fac"], """
SELECT "_id", RND("Latitude") AS "Latitude", RND("Longitude") AS "Longitude",
       CAST(floor("Latitude" / 1e-2) AS BIGINT) AS lat_bin,
       CAST(floor("Longitude" / 1e-2) AS BIGINT) AS lon_bin
FROM fac
WHERE "Latitude" IS NOT NULL AND "Longitude" IS NOT NULL AND NOT isnan("Latitude") AND NOT isnan("Longitude")
"""),
)
def q_grid_bin(spark, sf_dir):
    df = clean.drop_null_coords(facilities(spark, sf_dir))
    return rounded(density.add_bins(df).select("_id", "Latitude", "Longitude", "lat_bin", "lon_bin"))


@register("grid_counts", with_ctes(["li_counts"], "SELECT * FROM li_counts"))
def q_grid_counts(spark, sf_dir):
    return lineitem_counts(spark, sf_dir)


@register(
    "global_mean_std",
    with_ctes(["li_counts"], """
SELECT RND(COALESCE(avg(toilet_count), 0e0)) AS mean,
       RND(COALESCE(stddev_samp(toilet_count), 1e0)) AS std
FROM li_counts
"""),
)
def q_global_mean_std(spark, sf_dir):
    return rounded(density.global_mean_std(lineitem_counts(spark, sf_dir)))


@register(
    "grid_zscore",
    with_ctes(["li_z"], "SELECT x_bin, y_bin, toilet_count, RND(z_score) AS z_score FROM li_z"),
)
def q_grid_zscore(spark, sf_dir):
    return rounded(lineitem_z(spark, sf_dir))


@register(
    "hotspots",
    with_ctes(["ev_z"], "SELECT x_bin, y_bin, toilet_count, RND(z_score) AS z_score FROM ev_z WHERE z_score > 2"),
)
def q_hotspots(spark, sf_dir):
    return rounded(density.hotspots(event_z(spark, sf_dir)))


@register(
    "hotspots_top10",
    with_ctes(["ev_z"], """
SELECT x_bin, y_bin, toilet_count, RND(z_score) AS z_score FROM ev_z WHERE z_score > 2
ORDER BY toilet_count DESC, x_bin, y_bin LIMIT 10
"""),
)
def q_hotspots_top10(spark, sf_dir):
    hot = density.hotspots(event_z(spark, sf_dir))
    return rounded(density.top_cells(hot, 10, keys=("x_bin", "y_bin")))


@register(
    "anomalies",
    """
WITH c AS (
  SELECT CAST(floor(p_retailprice / 10e0) AS BIGINT) AS x_bin,
         CAST(floor(CAST(p_size AS DOUBLE) / 5e0) AS BIGINT) AS y_bin, count(*) AS toilet_count
  FROM part GROUP BY 1, 2),
s AS (SELECT COALESCE(avg(toilet_count), 0e0) AS mean, COALESCE(stddev_samp(toilet_count), 1e0) AS std FROM c),
z AS (SELECT x_bin, y_bin, toilet_count,
             CASE WHEN std = 0 THEN NULL ELSE (toilet_count - mean) / std END AS z_score
      FROM c CROSS JOIN s)
SELECT x_bin, y_bin, toilet_count, RND(z_score) AS z_score FROM z WHERE z_score < -2
""",
)
def q_anomalies(spark, sf_dir):
    pts = tables.part_points(spark, sf_dir)
    sx, sy = tables.PART_CELL
    counts = density.grid_counts(density.add_bins(pts, "x", "y", sx, sy, names=("x_bin", "y_bin")),
                                 keys=("x_bin", "y_bin"))
    return rounded(density.anomalies(density.grid_zscore(counts)))


@register(
    "facility_grid_stats",
    with_ctes(["fac_density"], """
SELECT lat_bin, lon_bin, toilet_count,
       RND(CASE WHEN std = 0 THEN NULL ELSE (toilet_count - mean) / std END) AS z_score
FROM c CROSS JOIN s
""", more="""
c AS (SELECT CAST(floor("Latitude" / 1e-2) AS BIGINT) AS lat_bin,
             CAST(floor("Longitude" / 1e-2) AS BIGINT) AS lon_bin, count(*) AS toilet_count
      FROM fac_density GROUP BY 1, 2),
s AS (SELECT COALESCE(avg(toilet_count), 0e0) AS mean, COALESCE(stddev_samp(toilet_count), 1e0) AS std FROM c)
"""),
)
def q_facility_grid_stats(spark, sf_dir):
    df = density.density_features(clean.clean(facilities(spark, sf_dir), "density"))
    return rounded(density.grid_zscore(density.grid_counts(df)))


@register(
    "facility_hotspots",
    with_ctes(["fac_density"], """
SELECT lat_bin, lon_bin, toilet_count, RND(z_score) AS z_score FROM z WHERE z_score > 2
""", more="""
c AS (SELECT CAST(floor("Latitude" / 1e-2) AS BIGINT) AS lat_bin,
             CAST(floor("Longitude" / 1e-2) AS BIGINT) AS lon_bin, count(*) AS toilet_count
      FROM fac_density GROUP BY 1, 2),
s AS (SELECT COALESCE(avg(toilet_count), 0e0) AS mean, COALESCE(stddev_samp(toilet_count), 1e0) AS std FROM c),
z AS (SELECT lat_bin, lon_bin, toilet_count,
             CASE WHEN std = 0 THEN NULL ELSE (toilet_count - mean) / std END AS z_score FROM c CROSS JOIN s)
"""),
)
def q_facility_hotspots(spark, sf_dir):
    df = density.density_features(clean.clean(facilities(spark, sf_dir), "density"))
    return rounded(density.hotspots(density.grid_zscore(density.grid_counts(df))))


@register(
    "facility_hotspots_top10",
    with_ctes(["fac_density"], """
SELECT lat_bin, lon_bin, toilet_count, RND(z_score) AS z_score FROM z WHERE z_score > 2
ORDER BY toilet_count DESC, lat_bin, lon_bin LIMIT 10
""", more="""
c AS (SELECT CAST(floor("Latitude" / 1e-2) AS BIGINT) AS lat_bin,
             CAST(floor("Longitude" / 1e-2) AS BIGINT) AS lon_bin, count(*) AS toilet_count
      FROM fac_density GROUP BY 1, 2),
s AS (SELECT COALESCE(avg(toilet_count), 0e0) AS mean, COALESCE(stddev_samp(toilet_count), 1e0) AS std FROM c),
z AS (SELECT lat_bin, lon_bin, toilet_count,
             CASE WHEN std = 0 THEN NULL ELSE (toilet_count - mean) / std END AS z_score FROM c CROSS JOIN s)
"""),
)
def q_facility_hotspots_top10(spark, sf_dir):
    df = density.density_features(clean.clean(facilities(spark, sf_dir), "density"))
    hot = density.hotspots(density.grid_zscore(density.grid_counts(df)))
    return rounded(density.top_cells(hot, 10))

"""Grid density: bins, counts per cell, z-scores, hot and sparse cells, suburbs.

Scale notes
* ``grid_counts`` is a partial + final hash aggregate: each map task sends one
  row per cell it saw, so a cell holding a third of all rows costs nothing
  extra in the shuffle.
* The table-wide mean / std are a one-row aggregate over the (already small)
  cell table used as a scalar subquery: computed once, no join and no driver
  round trip (the source job collected it and re-planned).
* ``try_divide`` keeps the std = 0 case (all cells equal) a NULL z-score
  instead of an ANSI division error; such cells are neither hot nor sparse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.functions.columns import ACCESSIBLE_STRICT, GRID_SIZE, flag_in, gender_class, grid_bin


def add_bins(
    df: DataFrame,
    x: str = "Latitude",
    y: str = "Longitude",
    size_x: float = GRID_SIZE,
    size_y: float = GRID_SIZE,
    names: tuple[str, str] = ("lat_bin", "lon_bin"),
) -> DataFrame:
    return df.withColumns({names[0]: grid_bin(F.col(x), size_x), names[1]: grid_bin(F.col(y), size_y)})


def grid_counts(
    df: DataFrame,
    keys: tuple[str, str] = ("lat_bin", "lon_bin"),
    count_name: str = "toilet_count",
) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))


def global_mean_std(counts: DataFrame, count_col: str = "toilet_count") -> DataFrame:
    """One row: mean (NULL -> 0) and sample std (NULL -> 1) of the cell counts."""
    return counts.agg(
        F.coalesce(F.avg(count_col), F.lit(0.0)).alias("mean"),
        F.coalesce(F.stddev_samp(count_col), F.lit(1.0)).alias("std"),
    )


def grid_zscore(counts: DataFrame, count_col: str = "toilet_count") -> DataFrame:
    # mean and std as one scalar subquery: computed once, no join
    stats = global_mean_std(counts, count_col).select(F.struct("mean", "std")).scalar()
    return counts.select(
        *[F.col(c) for c in counts.columns],
        F.try_divide(F.col(count_col) - stats.getField("mean"), stats.getField("std")).alias("z_score"),
    )


def hotspots(z: DataFrame, threshold: float = 2.0) -> DataFrame:
    return z.filter(F.col("z_score") > threshold)


def anomalies(z: DataFrame, threshold: float = -2.0) -> DataFrame:
    return z.filter(F.col("z_score") < threshold)


def top_cells(z: DataFrame, n: int = 10, keys: tuple[str, str] = ("lat_bin", "lon_bin")) -> DataFrame:
    """Top-n cells by count, ties by cell key (a ``TakeOrderedAndProject``)."""
    return z.orderBy(F.col("toilet_count").desc(), *[F.col(k).asc() for k in keys]).limit(n)


def density_features(df: DataFrame) -> DataFrame:
    """Bins, strict accessible flag and gender class (density job columns)."""
    return add_bins(df).withColumns(
        {
            "is_accessible": flag_in(F.col("Accessible"), ACCESSIBLE_STRICT),
            "gender_type": gender_class(F.col("Gender")),
        }
    )


def suburb_stats(df: DataFrame, sort: bool = True) -> DataFrame:
    """Per (Suburb, Postcode): mean coordinates, accessibility rate, count.

    NULL keys form their own group.  ``sort`` orders by count (desc) for a
    result frame; sinks should pass ``sort=False`` and skip the range shuffle.
    """
    out = df.groupBy("Suburb", "Postcode").agg(
        F.avg("Latitude").alias("avg_lat"),
        F.avg("Longitude").alias("avg_lon"),
        F.avg("is_accessible").alias("accessibility_rate"),
        F.count(F.lit(1)).alias("toilet_count"),
    )
    if sort:
        out = out.orderBy(
            F.col("toilet_count").desc(), F.col("Suburb").asc_nulls_last(), F.col("Postcode").asc_nulls_last()
        )
    return out

"""End-to-end batch jobs (the three pipelines), written for one pass each.

Differences from a naive port, all for scale:
* the cleaned rows are cut from their lineage once (checkpoint into the shared
  checkpoint folder) because several outputs read them;
* hot / sparse cells are read back from the written grid table instead of
  recomputing the grid;
* row counts per stage come from ``Observation``s attached to the writes —
  no extra ``count()`` passes;
* result files are written unsorted (sorting is for report frames);
* one creation stamp per run, so every copy of a table carries the same value;
* secondary sinks (JDBC) are best effort or required, per call.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridlens.operators import clean, datasets, density, normalize
from gridlens.session import materialize
from gridlens.sources import io


def _observed_write(df: DataFrame, path: str, name: str) -> Observation:
    obs = Observation(name)
    io.write_parquet(df.observe(obs, F.count(F.lit(1)).alias("rows")), path)
    return obs


def _jdbc_sinks(frames: dict[str, DataFrame], jdbc: dict | None, truncate: bool, required: bool) -> list[str]:
    failed = []
    if not jdbc:
        return failed
    for table, df in frames.items():
        res = io.write_all(
            df,
            {table: lambda d, t=table: io.write_jdbc(d, jdbc["url"], t, truncate=truncate,
                                                    properties=jdbc.get("properties"))},
            required=[table] if required else [],
            counts=False,
        )
        failed += res["failed"]
    return failed


def density_job(spark: SparkSession, raw: DataFrame, out_dir: str, jdbc: dict | None = None,
                jdbc_required: bool = True) -> dict:
    """Grid counts + z-scores, sparse / hot cells, suburb statistics."""
    out = out_dir.rstrip("/")
    rows = density.density_features(clean.clean(normalize.normalize_facilities(raw), "density"))
    rows = materialize(rows)  # read by the grid and the suburb outputs
    grid = density.grid_zscore(density.grid_counts(rows))
    counts = {"grid_stats": _observed_write(grid, f"{out}/grid_stats", "grid_stats")}
    written = spark.read.parquet(f"{out}/grid_stats")
    counts["anomalies"] = _observed_write(density.anomalies(written), f"{out}/anomalies", "anomalies")
    counts["hotspots"] = _observed_write(density.hotspots(written), f"{out}/hotspots", "hotspots")
    counts["suburb_stats"] = _observed_write(density.suburb_stats(rows, sort=False), f"{out}/suburb_stats",
                                             "suburb_stats")
    failed = _jdbc_sinks(
        {t: spark.read.parquet(f"{out}/{t}") for t in ("grid_stats", "anomalies", "hotspots", "suburb_stats")},
        jdbc, truncate=False, required=jdbc_required,
    )
    report = {k: v.get.get("rows") for k, v in counts.items()}
    report["failed_sinks"] = failed
    return report


def cell_features_job(spark: SparkSession, raw: DataFrame, out_dir: str, jdbc: dict | None = None,
                      stamp: dt.datetime | None = None) -> dict:
    stamp = stamp or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = datasets.feature_rows(clean.clean(normalize.normalize_facilities(raw), "cells"))
    path = f"{out_dir.rstrip('/')}/ml_features"
    obs = _observed_write(datasets.cell_features(rows, stamp=stamp), path, "ml_features")
    failed = _jdbc_sinks({"ml_features": spark.read.parquet(path)}, jdbc, truncate=True, required=True)
    return {"ml_features": obs.get.get("rows"), "failed_sinks": failed}


def facility_features_job(spark: SparkSession, raw: DataFrame, out_dir: str, jdbc: dict | None = None,
                          stamp: dt.datetime | None = None) -> dict:
    stamp = stamp or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = datasets.feature_rows(clean.clean(normalize.normalize_facilities(raw), "facility"))
    path = f"{out_dir.rstrip('/')}/ml_accessible_features"
    obs = _observed_write(datasets.facility_features(rows, stamp=stamp), path, "ml_accessible_features")
    failed = _jdbc_sinks({"ml_accessible_features": spark.read.parquet(path)}, jdbc, truncate=True, required=True)
    return {"ml_accessible_features": obs.get.get("rows"), "failed_sinks": failed}

"""Driver queries: upserts, runs, contracts, stage counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlens.operators import clean, density, normalize, report, upsert
from gridlens.plans.facility_queries import facilities
from gridlens.plans.oracle_sql import with_ctes
from gridlens.plans.registry import register, rounded
from gridlens.session import materialize
from gridlens.sources import bindings, tables

# Orders landed in two overlapping loads: the current table holds orders
# dated before 1999; the batch re-delivers everything from mid-1998 with a
# revised price and status.  The overlap is what the upsert must resolve.
CURRENT_BEFORE = "1999-01-01"
BATCH_FROM = "1998-07-01"


def orders_loads(spark, sf_dir):
    o = tables.load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    current = o.filter(F.col("o_orderdate") < F.lit(CURRENT_BEFORE).cast("timestamp_ntz"))
    batch = o.filter(F.col("o_orderdate") >= F.lit(BATCH_FROM).cast("timestamp_ntz")).withColumns(
        {"o_totalprice": F.col("o_totalprice") * F.lit(1.1), "o_orderstatus": F.lit("F")}
    )
    return current, batch


_ORDERS_UPSERT_SQL = f"""
WITH cur AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
  WHERE o_orderdate < TIMESTAMP '{CURRENT_BEFORE}'),
bat AS (
  SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice * 1.1e0 AS o_totalprice, o_orderdate FROM orders
  WHERE o_orderdate >= TIMESTAMP '{BATCH_FROM}'),
u AS (SELECT *, 0 AS prio FROM cur UNION ALL SELECT *, 1 AS prio FROM bat),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY prio DESC, o_custkey, o_orderstatus,
                                   o_totalprice, o_orderdate) AS rn FROM u)
SELECT o_orderkey, o_custkey, o_orderstatus, RND(o_totalprice) AS o_totalprice, o_orderdate FROM r WHERE rn = 1
"""


@register("upsert_latest", _ORDERS_UPSERT_SQL)
def q_upsert_latest(spark, sf_dir):
    current, batch = orders_loads(spark, sf_dir)
    return rounded(upsert.upsert_latest(current, batch, ["o_orderkey"]))


@register(
    "upsert_composite_key",
    """
WITH cur AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate FROM lineitem
  WHERE l_shipdate < TIMESTAMP '1999-01-01'),
bat AS (
  SELECT l_orderkey, l_linenumber, l_quantity + 1e0 AS l_quantity, l_extendedprice, l_shipdate FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1998-07-01'),
u AS (SELECT *, 0 AS prio FROM cur UNION ALL SELECT *, 1 AS prio FROM bat),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY prio DESC, l_shipdate DESC, l_quantity, l_extendedprice) AS rn FROM u)
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate FROM r WHERE rn = 1
""",
)
def q_upsert_composite_key(spark, sf_dir):
    # Composite key (l_orderkey, l_linenumber), repeated inside each load:
    # inside a load the latest shipment wins, across loads the batch wins.
    li = tables.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    current = li.filter(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    batch = li.filter(F.col("l_shipdate") >= F.lit("1998-07-01").cast("timestamp_ntz")).withColumn(
        "l_quantity", F.col("l_quantity") + F.lit(1.0)
    )
    order = [F.col("l_shipdate").desc(), F.col("l_quantity"), F.col("l_extendedprice")]
    return upsert.upsert_latest(current, batch, ["l_orderkey", "l_linenumber"], order)


_RUNS_CTE = """
reg AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 199 <> 0 THEN l_quantity END AS actual,
         l_extendedprice * 1e-3 AS predicted, date_trunc('month', l_shipdate) AS run_month
  FROM lineitem),
month_mean AS (SELECT run_month, avg(actual) AS mean_actual FROM reg GROUP BY run_month),
scored AS (SELECT reg.*, mean_actual FROM reg JOIN month_mean USING (run_month) WHERE actual IS NOT NULL),
run_rows AS (
  SELECT 'run_' || strftime(run_month, '%Y%m') AS run_id, 'lineitem_quantity' AS experiment_name,
         'price_ratio' AS model_version,
         sqrt(avg((predicted - actual) * (predicted - actual))) AS rmse,
         avg(abs(predicted - actual)) AS mae,
         CASE WHEN min(actual) = max(actual) THEN NULL
              ELSE 1e0 - sum((predicted - actual) * (predicted - actual))
                         / sum((actual - mean_actual) * (actual - mean_actual)) END AS r2,
         count(*) AS n, [50, 100, 200][CAST(month(run_month) % 3 + 1 AS INTEGER)] AS n_estimators,
         CAST(4 + month(run_month) % 4 * 2 AS INTEGER) AS max_depth,
         CASE WHEN month(run_month) % 2 = 0 THEN 0.1e0 ELSE 0.2e0 END AS learning_rate, run_month AS trained_at,
         CASE WHEN count(*) >= 30 THEN 'success' ELSE 'failed' END AS status
  FROM scored GROUP BY run_month),
runs AS (
  SELECT * EXCLUDE (trained_at, status),
         '{"n_estimators":' || n_estimators || ',"max_depth":' || max_depth || ',"learning_rate":' || learning_rate || '}' AS params,
         '{"source":"lineitem","rows":' || n || '}' AS tags, trained_at, status
  FROM run_rows)"""

_RUN_COLS = ("run_id, experiment_name, model_version, RND(rmse) AS rmse, RND(mae) AS mae, RND(r2) AS r2, n, n_estimators, max_depth, "
             "RND(learning_rate) AS learning_rate, params, tags, trained_at, status")


@register(
    "runs_upsert",
    with_ctes([], f"""
SELECT {_RUN_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY prio DESC) AS rn FROM (
    SELECT *, 0 AS prio FROM runs WHERE trained_at < TIMESTAMP '1999-01-01'
    UNION ALL
    SELECT run_id, experiment_name, 'price_ratio_v2' AS model_version, rmse, mae, r2, n,
           n_estimators, max_depth, learning_rate, params, tags, trained_at, status, 1 AS prio
    FROM runs WHERE trained_at >= TIMESTAMP '1998-07-01') u) t
WHERE rn = 1""", more=_RUNS_CTE),
)
def q_runs_upsert(spark, sf_dir):
    runs = bindings.runs(spark, sf_dir)
    ts = F.col("trained_at")
    current = runs.filter(ts < F.lit("1999-01-01").cast("timestamp_ntz"))
    batch = runs.filter(ts >= F.lit("1998-07-01").cast("timestamp_ntz")).withColumn(
        "model_version", F.lit("price_ratio_v2")
    )
    return rounded(upsert.upsert_latest(current, batch, ["run_id"]))


@register(
    "latest_run",
    with_ctes([], f"""
SELECT {_RUN_COLS} FROM runs WHERE status = 'success' ORDER BY trained_at DESC, run_id DESC LIMIT 1""",
              more=_RUNS_CTE),
)
def q_latest_run(spark, sf_dir):
    runs = bindings.runs(spark, sf_dir)
    return rounded(report.latest(runs, "trained_at", F.col("status") == "success"))


@register(
    "latest_run_rows",
    with_ctes([], """
SELECT l_orderkey, l_linenumber, 'run_' || strftime(run_month, '%Y%m') AS run_id,
       RND(predicted) AS predicted, actual
FROM reg
WHERE 'run_' || strftime(run_month, '%Y%m') =
      (SELECT run_id FROM runs WHERE status = 'success' ORDER BY trained_at DESC, run_id DESC LIMIT 1)""",
              more=_RUNS_CTE),
)
def q_latest_run_rows(spark, sf_dir):
    preds = bindings.run_predictions(spark, sf_dir)
    newest = report.latest(bindings.runs(spark, sf_dir), "trained_at", F.col("status") == "success")
    # the newest run id is one row: a broadcast semi join stands in for the
    # scalar subquery
    return rounded(preds.join(F.broadcast(newest.select("run_id")), "run_id", "left_semi"))


@register(
    "run_comparison",
    with_ctes([], f"""
SELECT {_RUN_COLS}, CAST(row_number() OVER (ORDER BY trained_at, run_id) AS INTEGER) AS run_index FROM runs""",
              more=_RUNS_CTE),
)
def q_run_comparison(spark, sf_dir):
    return rounded(report.run_comparison(bindings.runs(spark, sf_dir)))


@register(
    "contract_pk_violations",
    """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def q_contract_pk_violations(spark, sf_dir):
    li = tables.load(spark, sf_dir, "lineitem")
    return upsert.pk_violations(li, ["l_orderkey", "l_linenumber"])


@register(
    "contract_null_violations",
    with_ctes(["fac"], """
SELECT '_id' AS "column", 'not_null' AS rule, CAST(count_if("_id" IS NULL) AS BIGINT) AS violations FROM fac
UNION ALL SELECT 'Latitude', 'not_null', CAST(count_if("Latitude" IS NULL) AS BIGINT) FROM fac
UNION ALL SELECT 'Longitude', 'not_null', CAST(count_if("Longitude" IS NULL) AS BIGINT) FROM fac
UNION ALL SELECT 'Suburb', 'not_null', CAST(count_if("Suburb" IS NULL) AS BIGINT) FROM fac
UNION ALL SELECT 'Name', 'max_length_18', CAST(COALESCE(count_if(length("Name") > 18), 0) AS BIGINT) FROM fac
UNION ALL SELECT 'Postcode', 'max_length_4', CAST(COALESCE(count_if(length("Postcode") > 4), 0) AS BIGINT) FROM fac"""),
)
def q_contract_null_violations(spark, sf_dir):
    df = facilities(spark, sf_dir)
    return upsert.rule_violations(
        df, not_null=["_id", "Latitude", "Longitude", "Suburb"], max_length={"Name": 18, "Postcode": 4}
    )


@register(
    "stage_counts",
    with_ctes(["fac_density", "fac_cells", "fac_facility"], """
SELECT 'raw' AS stage, CAST(count(*) AS BIGINT) AS "rows" FROM raw_fac
UNION ALL SELECT 'clean_density', count(*) FROM fac_density
UNION ALL SELECT 'clean_cells', count(*) FROM fac_cells
UNION ALL SELECT 'clean_facility', count(*) FROM fac_facility
UNION ALL SELECT 'grid_cells', count(*) FROM (SELECT DISTINCT floor("Latitude" / 1e-2), floor("Longitude" / 1e-2) FROM fac_density) t
UNION ALL SELECT 'suburbs', count(*) FROM (SELECT DISTINCT "Suburb", "Postcode" FROM fac_density) t"""),
)
def q_stage_counts(spark, sf_dir):
    # the raw rows are read and the density rows cleaned once; later stages count from these copies
    raw = materialize(tables.facility_raw(spark, sf_dir))
    fac = normalize.normalize_facilities(raw)
    dens = materialize(density.density_features(clean.clean(fac, "density")))
    return report.stage_counts(
        {
            "raw": raw,
            "clean_density": dens,
            "clean_cells": clean.clean(fac, "cells"),
            "clean_facility": clean.clean(fac, "facility"),
            "grid_cells": density.grid_counts(dens),
            "suburbs": density.suburb_stats(dens, sort=False),
        }
    )


# One stamp per run, passed in as a literal (every copy of the table agrees).
RUN_STAMP = "2026-01-01 00:00:00"


@register(
    "upsert_with_load_stamp",
    with_ctes(["fac"], f"""
SELECT "_id", RND("Latitude") AS "Latitude", RND("Longitude") AS "Longitude", "Name", "Suburb", loaded_at FROM (
  SELECT *, row_number() OVER (PARTITION BY "_id" ORDER BY prio DESC, "Latitude" ASC NULLS LAST,
                               "Longitude" ASC NULLS LAST, "Name" ASC NULLS LAST, "Suburb" ASC NULLS LAST) AS rn
  FROM (
    SELECT "_id", "Latitude", "Longitude", "Name", "Suburb", CAST(NULL AS TIMESTAMP) AS loaded_at, 0 AS prio
    FROM fac WHERE "Group" IN ('AFRICA', 'AMERICA', 'ASIA')
    UNION ALL
    SELECT "_id", "Latitude", "Longitude", upper("Name"), "Suburb", TIMESTAMP '{RUN_STAMP}', 1
    FROM fac WHERE "Group" IN ('ASIA', 'EUROPE', 'MIDDLE EAST')) u) t
WHERE rn = 1"""),
)
def q_upsert_with_load_stamp(spark, sf_dir):
    # Raw facility load on `_id`: the current table holds three regions, the
    # batch re-delivers one of them (names revised) plus two new ones; batch
    # rows replace all columns and get the run's load stamp.
    fac = facilities(spark, sf_dir).select("_id", "Latitude", "Longitude", "Name", "Suburb", "Group")
    current = fac.filter(F.col("Group").isin("AFRICA", "AMERICA", "ASIA")).drop("Group")
    batch = fac.filter(F.col("Group").isin("ASIA", "EUROPE", "MIDDLE EAST")).drop("Group").withColumn(
        "Name", F.upper("Name")
    )
    stamp = F.lit(RUN_STAMP).cast("timestamp_ntz")
    out = upsert.upsert_latest(current.withColumn("loaded_at", F.lit(None).cast("timestamp_ntz")),
                               batch.withColumn("loaded_at", stamp), ["_id"])
    return rounded(out)

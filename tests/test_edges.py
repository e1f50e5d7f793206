"""Hand-made edge rows (FIXTURES §3): one test per case."""

import math

import pytest
from pyspark.sql import functions as F

from gridlens.functions import columns as C
from gridlens.operators import clean, datasets, density, metrics, normalize, upsert
from gridlens.sources import io


def raw(spark, rows, cols):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))


def test_quoted_csv_roundtrip(spark, tmp_path):
    df = raw(spark, [("1", 'he said "hi", ok'), ("2", "line one\nline two")], ["_id", "Name"])
    path = str(tmp_path / "csv")
    io.write_csv(df, path)
    back = {r["_id"]: r["Name"] for r in io.read_csv(spark, path).collect()}
    assert back == {"1": 'he said "hi", ok', "2": "line one\nline two"}


def test_bad_nan_empty_coordinates_removed(spark):
    df = raw(spark, [("1", "abc", "1"), ("2", "NaN", "1"), ("3", "", "1"), ("4", "1.5", "2")],
             ["_id", "Latitude", "Longitude"])
    out = clean.drop_null_coords(normalize.normalize_facilities(df))
    assert [r["_id"] for r in out.collect()] == ["4"]


def test_range_check(spark):
    df = raw(spark, [("a", "90", "0"), ("b", "90.01", "0"), ("c", "0", "-180")], ["_id", "Latitude", "Longitude"])
    out = clean.clean(normalize.normalize_facilities(df), "density")
    assert sorted(r["_id"] for r in out.collect()) == ["a", "c"]


def test_renamed_columns(spark):
    df = raw(spark, [("1", "X Town", "WA", "Park", "1 Road", "Yes")],
             ["_id", "Town", "State", "FacilityType", "Address1", "ChangingPlaces"])
    r = normalize.normalize_facilities(df).first()
    assert (r["Suburb"], r["Group"], r["Category"], r["Address"], r["ChangingPlace"]) == (
        "X Town", "WA", "Park", "1 Road", "Yes")


def test_missing_gender_and_flags(spark):
    df = raw(spark, [("1", "1", "1")], ["_id", "Latitude", "Longitude"])
    r = normalize.normalize_facilities(df).select(
        "Gender", C.gender_class(F.col("Gender")).alias("cls"), C.gender_code(F.col("Gender")).alias("code")
    ).first()
    assert (r["Gender"], r["cls"], r["code"]) == (None, "unknown", 3)


def test_gender_flags(spark):
    cols = ["_id", "Male", "Female", "Unisex", "AllGender"]
    df = raw(spark, [("1", "True", "yes", None, None), ("2", "1", None, "1", None), ("3", None, None, None, "true")], cols)
    out = normalize.normalize_facilities(df).select("_id", "Gender", C.gender_class(F.col("Gender")).alias("cls"))
    got = {r["_id"]: (r["Gender"], r["cls"]) for r in out.collect()}
    assert got == {"1": ("Male/Female", "male"), "2": ("Unisex", "unisex"), "3": ("AllGender", "unknown")}


def test_gender_text_female(spark):
    df = raw(spark, [("Female",)], ["Gender"])
    r = df.select(C.gender_class(F.col("Gender")).alias("c"), C.gender_code(F.col("Gender")).alias("k")).first()
    assert (r["c"], r["k"]) == ("female", 2)


def test_accessible_true_upper(spark):
    df = raw(spark, [("TRUE",)], ["Accessible"])
    r = df.select(C.flag_in(F.col("Accessible"), C.ACCESSIBLE_STRICT).alias("s"),
                  C.flag_in(F.col("Accessible"), C.ACCESSIBLE_WIDE).alias("w")).first()
    assert (r["s"], r["w"]) == (0, 1)


def test_bins_floor_of_quotient(spark):
    df = spark.createDataFrame([(0.29,), (-31.955,)], "x double")
    got = [r[0] for r in df.select(C.grid_bin(F.col("x"), 0.01)).collect()]
    assert got == [28, -3196]


def test_one_cell_only(spark):
    counts = spark.createDataFrame([(1, 1, 5)], "lat_bin long, lon_bin long, toilet_count long")
    st = density.global_mean_std(counts).first()
    assert (st["mean"], st["std"]) == (5.0, 1.0)
    assert density.grid_zscore(counts).first()["z_score"] == 0.0


def test_all_cells_equal(spark):
    counts = spark.createDataFrame([(i, 0, 3) for i in range(5)], "lat_bin long, lon_bin long, toilet_count long")
    z = density.grid_zscore(counts)
    assert all(r["z_score"] is None for r in z.collect())
    assert density.hotspots(z).count() == 0 and density.anomalies(z).count() == 0


def test_identical_rows_collapse(spark):
    df = raw(spark, [("1", "1", "1"), ("1", "1", "1")], ["_id", "Latitude", "Longitude"])
    assert clean.clean(normalize.normalize_facilities(df), "density").count() == 1


def test_duplicate_id_tie_break(spark):
    df = raw(spark, [("1", "2", "1", "B"), ("1", "1", "1", "A")], ["_id", "Latitude", "Longitude", "Name"])
    out = clean.clean(normalize.normalize_facilities(df), "cells").collect()
    assert len(out) == 1 and out[0]["Latitude"] == 1.0


def test_null_ids(spark):
    df = raw(spark, [(None, "1", "1"), (None, "2", "2")], ["_id", "Latitude", "Longitude"])
    norm = normalize.normalize_facilities(df)
    assert clean.clean(norm, "cells").count() == 1
    assert clean.clean(norm, "facility").count() == 0


def test_dominant_value_ties_and_null(spark):
    parts = spark.createDataFrame(
        [(0, 0, "B", 2), (0, 0, "A", 2), (1, 1, None, 3), (1, 1, "A", 1)],
        "lat_bin long, lon_bin long, Suburb string, n long",
    )
    got = {(r["lat_bin"]): r["dominant_suburb"] for r in datasets.dominant_value(parts).collect()}
    assert got == {0: "A", 1: None}


def test_null_suburb_dominant_gives_null_then_zero(spark):
    rows = [("1", "0.001", "0.001", None, "Yes"), ("2", "0.002", "0.002", None, "No"),
            ("3", "0.003", "0.003", None, "No"), ("4", "0.004", "0.004", "A", "Yes")]
    df = raw(spark, rows, ["_id", "Latitude", "Longitude", "Suburb", "Accessible"])
    feats = datasets.feature_rows(clean.clean(normalize.normalize_facilities(df), "cells"))
    cells = datasets.cell_features(feats).first()
    assert cells["suburb_accessibility"] is None and cells["suburb_toilet_count"] is None
    prep = datasets.prepare(datasets.cell_features(feats), datasets.CELL_FEATURES, datasets.CELL_TARGET).first()
    assert prep["suburb_accessibility"] == 0.0 and prep["suburb_toilet_count"] == 0.0


def test_empty_table(spark):
    empty = spark.createDataFrame([], "Latitude double, Longitude double")
    c = datasets.center_point(empty).first()
    assert (c["center_lat"], c["center_lon"]) == C.FALLBACK_CENTER
    counts = spark.createDataFrame([], "lat_bin long, lon_bin long, toilet_count long")
    st = density.global_mean_std(counts).first()
    assert (st["mean"], st["std"]) == (0.0, 1.0)


def test_count_rounding_half_even_and_clip(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-0.4,)], "p double")
    assert [r[0] for r in df.select(C.clip_round_count(F.col("p"))).collect()] == [2, 4, 0]


def test_one_class_auc_zero(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "label int, proba double")
    assert metrics.auc_scores(df, "label", "proba").first()["roc_auc"] == 0.0


def test_no_predicted_positives_f1_zero(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, predicted int")
    assert metrics.classification_metrics(df, "label", "predicted").first()["f1"] == 0.0


def test_feature_cleaning(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (2.0,)], "a double")
    out = [tuple(r) for r in normalize.fill_features(df, ["a", "missing"]).collect()]
    assert out == [(0.0, 0.0), (0.0, 0.0), (0.0, 0.0), (2.0, 0.0)]


def test_upsert_idempotent(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    once = upsert.upsert_latest(cur, batch, ["k"])
    twice = upsert.upsert_latest(once, batch, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [(1, "a"), (2, "B"), (3, "C")]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    got = [r[0] for r in normalize.nulls_for_nans(df, ["x"]).collect()]
    assert got[0] is None and got[1] == 1.0 and not math.isnan(got[1])


def test_metrics_on_empty_input_give_one_row(spark):
    empty = spark.createDataFrame([], "actual double, predicted double")
    r = metrics.regression_metrics(empty, "actual", "predicted").collect()
    assert len(r) == 1 and r[0]["n"] == 0 and r[0]["median_ae"] is None
    e2 = spark.createDataFrame([], "label int, proba double")
    assert metrics.auc_scores(e2, "label", "proba").first()["roc_auc"] == 0.0


def test_metrics_without_any_label(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "actual double, predicted double")
    r = metrics.regression_metrics(df, "actual", "predicted").first()
    assert r["n"] == 0 and r["rmse"] is None and r["median_ae"] is None


def test_exact_quantiles_of_an_empty_table(spark):
    from gridlens.operators.ordered import exact_quantiles

    none = spark.createDataFrame([], "v double, g string")
    assert exact_quantiles(none, "v", [0.5]).count() == 0
    assert exact_quantiles(none, "v", [0.5], ["g"]).count() == 0


def test_a_feature_without_values_keeps_its_row(spark):
    from gridlens.operators.report import feature_statistics

    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    rows = {r["feature"]: r for r in feature_statistics(df, ["a", "b"]).collect()}
    assert rows["a"]["count"] == 2 and rows["a"]["p50"] == 2.0
    assert rows["b"]["count"] == 0 and rows["b"]["mean"] is None and rows["b"]["max"] is None
    assert [r["count"] for r in feature_statistics(df.limit(0), ["a", "b"]).collect()] == [0, 0]


def test_facilities_without_a_suburb_have_no_suburb_count(spark):
    from gridlens.operators.datasets import facility_features

    rows = spark.createDataFrame(
        [(i, 1, 1, s, 0.5, 1, 2, 0, 1) for i, s in enumerate(["x", "x", None, None, None])],
        "_id long, lat_bin long, lon_bin long, Suburb string, distance_to_center double, gender_encoded int, "
        "category_encoded int, has_changing_place int, is_accessible int")
    got = {r["_id"]: (r["suburb_toilet_count"], r["grid_toilet_count"]) for r in facility_features(rows).collect()}
    assert got == {"0": (2, 5), "1": (2, 5), "2": (None, 5), "3": (None, 5), "4": (None, 5)}


def test_pretty_printed_page_files(spark, tmp_path):
    import json

    from pyspark.sql import types as T

    for i, recs in enumerate([[{"_id": "1", "Name": "a"}, {"_id": "2", "Name": "b"}], [{"_id": "3"}], []]):
        (tmp_path / f"page{i}.json").write_text(json.dumps({"result": {"records": recs}}, indent=2))
    schema = T.StructType([T.StructField("_id", T.StringType()), T.StructField("Name", T.StringType())])
    got = sorted(map(tuple, io.read_pages(spark, str(tmp_path), schema, multi_line=True).collect()))
    assert got == [("1", "a"), ("2", "b"), ("3", None)]


def test_hash_split_takes_any_fraction(spark):
    from gridlens.operators.split import hash_split

    df = spark.range(200_000)
    for fraction in (0.005, 0.125):
        n = hash_split(df, ["id"], fraction).filter("split = 'test'").count()
        assert abs(n - 200_000 * fraction) < 5 * (200_000 * fraction) ** 0.5


def test_splits_keep_rows_without_a_class(spark):
    from gridlens.operators.split import class_weights, nested_split, stratified_split

    df = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(10)], "id int, c string")
    out = stratified_split(df, ["id"], "c", 0.4).collect()
    assert len(out) == 10
    assert sorted((str(r["c"]), r["split"]) for r in out) == sorted([("a", "test")] * 2 + [("a", "train")] * 3 + [("None", "test")] * 2 + [("None", "train")] * 3)
    assert nested_split(df, ["id"], 0.4, 0.4, stratify="c").count() == 10
    assert stratified_split(df, ["id"], "c", 1.0).filter("split = 'test'").count() == 10
    assert stratified_split(df, ["id"], "c", 0.0).filter("split = 'test'").count() == 0
    weights = {(r["c"], r["weight"]) for r in class_weights(df, "c").collect()}
    assert weights == {("a", 1.0), (None, 0.0)}


def test_fingerprint_tells_close_values_apart(spark):
    from gridlens.operators.report import data_fingerprint

    def fp(rows, schema):
        return data_fingerprint(spark.createDataFrame(rows, schema)).first()["fingerprint"]

    numbers = [1e13, 2e13, 9e15, float("inf"), float("-inf"), float("nan"), 1.0, 1.0000001, 0.0, None]
    assert len({fp([(x,)], "x double") for x in numbers}) == len(numbers)
    texts = [("x|y", "z"), ("x", "y|z"), ("", None), (None, ""), (None, None), ("", ""), ("-", "")]
    assert len({fp([t], "a string, b string") for t in texts}) == len(texts)


def test_stable_hash_gives_null_a_place(spark):
    from gridlens.functions.columns import stable_hash

    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "a"), (None, None)], "x string, y string")
    assert df.select(stable_hash(1, "x", "y").alias("h")).distinct().count() == 4


def test_wide_counts_and_bins(spark):
    from gridlens.functions.columns import clip_round_count
    from gridlens.operators.models import frequency_index

    assert spark.sql("SELECT 3e9D AS x").select(clip_round_count(F.col("x"))).first()[0] == 3_000_000_000
    df = spark.createDataFrame([(0, 2**32), (1, 0), (0, 2**32), (-(2**40), 5)], "lat_bin long, lon_bin long")
    got = {(r["lat_bin"], r["lon_bin"]): r["cell_index"] for r in frequency_index(df).collect()}
    assert got == {(0, 2**32): 0.0, (-(2**40), 5): 1.0, (1, 0): 2.0}


def test_metrics_leave_out_missing_labels_and_scores(spark):
    from gridlens.operators.metrics import auc_scores, classification_metrics, regression_metrics

    reg = spark.createDataFrame([(0.0, 1.0), (None, 1.0), (2.0, 1.5)], "y double, p double")
    row = regression_metrics(reg, "y", "p").first()
    assert row["n"] == 2 and abs(row["r2"] - 0.375) < 1e-12
    scored = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None), (None, 0.5), (1, float("nan"))], "y int, s double")
    assert auc_scores(scored, "y", "s").first()["roc_auc"] == 1.0
    cls = spark.createDataFrame([(1, 1), (0, None), (None, 1), (0, 0)], "y int, p int")
    assert classification_metrics(cls, "y", "p").first()["n"] == 2


def test_histogram_counts_what_has_no_bin_apart(spark):
    from gridlens.operators.report import class_balance, histogram

    df = spark.createDataFrame([(float(x),) for x in range(11)] + [(float("nan"),), (float("inf"),), (None,)], "x double")
    rows = histogram(df, "x", 5).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [2, 2, 2, 2, 3] and {r["n_other"] for r in rows} == {3}
    labels = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    assert {(r["c"], r["n"], r["n_classes"]) for r in class_balance(labels, "c").collect()} == {("a", 2, 2), ("b", 1, 2)}


def test_checkpoint_folder_must_be_shared_off_local_mode():
    from types import SimpleNamespace

    from gridlens.session import checkpoint_root

    conf = SimpleNamespace(get=lambda *_: None)
    sc = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="spark://somewhere:7077")
    with pytest.raises(RuntimeError):
        checkpoint_root(SimpleNamespace(sparkContext=sc))


def test_single_line_csv_is_read_without_multi_line(spark, tmp_path):
    df = raw(spark, [(str(i), f'a "quoted", {i}') for i in range(20)], ["_id", "Name"])
    io.write_csv(df, f"{tmp_path}/csv")
    both = [sorted(map(tuple, io.read_csv(spark, f"{tmp_path}/csv", multi_line=m).collect())) for m in (True, False)]
    assert both[0] == both[1] and len(both[0]) == 20

"""Awkward input of the operators: chains, constant columns, one-class and nameless groups, NaN, null keys, missing features."""

import pytest
from pyspark.sql import functions as F

from churnkit.functions.scalar import unit_hash
from churnkit.operators import cluster as cl, metrics as mt, ml, profile as pf
from churnkit.operators.prefix import positions


def test_a_long_chain_of_features_is_one_cluster(spark):
    names = [f"f{i:03d}" for i in range(200)]
    features = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "feature string, pos int")
    near = spark.createDataFrame([(a, b, 0.1) for a, b in zip(names, names[1:])], "feature1 string, feature2 string, distance double")
    got = cl.threshold_clusters(near, features).collect()
    assert {r["cluster"] for r in got} == {1} and len(got) == 200


def test_redundancy_settles_a_long_chain(spark):
    names = [f"f{i:03d}" for i in range(130)]
    pairs = spark.createDataFrame([(a, b, 0.99) for a, b in zip(names, names[1:])], "feature1 string, feature2 string, statistic double")
    importance = spark.createDataFrame([(n, float(len(names) - i)) for i, n in enumerate(names)], "feature string, importance double")
    keep = {r["feature"]: r["keep"] for r in cl.drop_correlated(pairs, importance, 0.9).collect()}
    assert keep == {n: i % 2 == 0 for i, n in enumerate(names)}


@pytest.mark.parametrize("method", ["blocks", "agg"])
def test_correlation_of_constant_and_nan(spark, method):
    rows = [(float(i), 0.1, float("nan") if i == 3 else 2.0 * i, None if i == 5 else float(i % 4)) for i in range(40)]
    df = spark.createDataFrame(rows, "x double, c double, y double, z double")
    got = {(r["feature1"], r["feature2"]): r["statistic"] for r in cl.corr_pairs(df, ["x", "c", "y", "z"], method).collect()}
    assert got[("x", "c")] is None and got[("c", "y")] is None and got[("c", "z")] is None
    assert got[("x", "y")] == pytest.approx(1.0)


def test_metrics_of_one_class_and_nameless_groups(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.2), ("pure", 1, 0.4), ("pure", 1, 0.6), (None, 0, 0.3), (None, 1, 0.7), ("a", 1, float("nan"))]
    df = spark.createDataFrame(rows, "g string, y int, p double")
    got = {r["g"]: r for r in mt.weighted_binary_metrics(df, "y", "p", by=["g"]).collect()}
    assert set(got) == {"a", "pure", None}
    assert got["a"]["auc"] == 1.0 and got[None]["auc"] == 1.0 and got["pure"]["auc"] is None and got["pure"]["ks"] is None
    assert got["a"]["n_pos"] == 1
    assert mt.balanced_accuracy(df.where("g = 'pure'"), "y", "p").first()[0] == 0.0
    flat = spark.createDataFrame([(3.0, 2.0), (3.0, 4.0)], "y double, yhat double")
    r = mt.regression_metrics(flat, "y", "yhat").first()
    assert r["rmse"] == 1.0 and r["r_squared"] is None


def test_mase_of_a_flat_and_a_short_series(spark):
    rows = [("up", t, float(t * 2), float(t * 2 + 1)) for t in range(5)] + [("flat", t, 1.0, 2.0) for t in range(3)] + [("short", 0, 1.0, 1.0)]
    got = {r["s"]: r["mase"] for r in mt.mase(spark.createDataFrame(rows, "s string, t int, y double, f double"), "y", "f", "t", ["s"]).collect()}
    assert got == {"up": 0.5, "flat": None, "short": None}


def test_profile_of_large_ids_and_nan(spark):
    rows = [(2**53 + i, float("nan") if i % 2 else 1.5) for i in range(10)]
    got = {r["column"]: r for r in pf.feature_profile(spark.createDataFrame(rows, "big long, v double")).collect()}
    assert got["big"]["n_distinct"] == 10 and got["v"]["n_distinct"] == 1 and got["v"]["n_missing"] == 5 and got["v"]["mean"] == 1.5


def test_null_keys_take_part_in_splits(spark):
    df = spark.createDataFrame([(None,), ("a",)], "k string")
    assert df.where(unit_hash("k").isNull()).count() == 0
    assert df.where(unit_hash("k", method="xxhash").isNull()).count() == 0


def test_positions_number_all_rows(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("a"), "id")
    got = sorted((r["position"], r["a"], r["id"]) for r in positions(df, [F.col("a").desc(), F.col("id")]).collect())
    want = sorted(((i % 7, i) for i in range(1000)), key=lambda x: (-x[0], x[1]))
    assert [(a, i) for _, a, i in got] == want and [p for p, _, _ in got] == list(range(1, 1001))


def test_training_and_scoring_keep_rows_with_missing_and_text_features(spark):
    rows = [(i, None if i % 3 == 0 else float(i % 10), float("nan") if i % 5 == 0 else float(i % 7),
             None if i % 11 == 0 else "abc"[i % 3], float(i % 10 > 4)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, x double, z double, kind string, y double")
    for kind in ("lr", "rf"):
        model = ml.fit(kind, ["x", "z", "kind"], "y", df)
        assert ml.evaluate(model, df, "y").first()["n_pos"] == sum(r[4] for r in rows)
        new = df.withColumn("kind", F.when(F.col("id") == 1, "unseen").otherwise(F.col("kind")))
        out = ml.batch_score(model, new, ["x", "z", "kind"], 0.5, ["id"]).collect()
        assert len(out) == 300
        missing = {r["id"] for r in out if r["prediction_status"] != "OK"}
        assert missing == {r[0] for r in rows if r[0] % 3 == 0 or r[0] % 5 == 0 or r[0] % 11 == 0}


def test_out_of_fold_stacking_scores_every_row(spark):
    rows = [(i, float(i % 2), (i * 37 % 100) / 100, (i % 2) * 0.5 + 0.2) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, y double, a double, b double")
    _, out = ml.stack(df, ["a", "b"], "y", ["id"])
    assert sorted(r["id"] for r in out.select("id").collect()) == list(range(200))


def test_blends_of_every_combination(spark):
    preds = spark.createDataFrame([(1, "a", 0.1), (1, "b", 0.4), (1, "c", 0.7), (2, "a", 0.3), (2, "b", None)], "row int, model string, p double")
    combos = spark.createDataFrame([("abc", m) for m in "abc"] + [("ab", m) for m in "ab"], "combo_id string, model string")
    got = {(r["combo_id"], r["row"], r["method"]): r["p"] for r in ml.blend_all(preds, combos, ["AVG", "MED", "MIN", "MAX"], ["row"]).collect()}
    assert got[("abc", 1, "AVG")] == pytest.approx(0.4) and got[("abc", 1, "MED")] == pytest.approx(0.4)
    assert got[("ab", 1, "MED")] == pytest.approx(0.25) and got[("ab", 1, "MAX")] == 0.4 and got[("ab", 2, "MIN")] == 0.3
    assert len(got) == 16

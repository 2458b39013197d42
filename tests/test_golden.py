"""Golden values restated from the reference's saved outputs and printed
figures, plus invariants from the test strategy."""

import math

import pytest
from pyspark.sql import functions as F

from churnkit.operators import dedup, evaluate as ev, impact as im, metrics as mt


def test_business_impact_golden_arithmetic(spark):
    # Printed business impact (interventions, TP, FP) of both
    # models with cost 10 and revenue 100.
    def rows(iv, tp, fp, model_pred, model_tgt):
        out = [(1.0, 1)] * tp + [(1.0, 0)] * fp + [(1.0, 0)] * (iv - tp - fp)
        return out
    intent = rows(26393, 5304, 21089, "p", "t")
    churn = rows(21595, 986, 20609, "p", "t")
    n = max(len(intent), len(churn))
    data = [(intent[i] if i < len(intent) else (0.0, 0)) + (churn[i] if i < len(churn) else (0.0, 0)) for i in range(n)]
    df = spark.createDataFrame(data, "churned_PREDICTION double, churned int, churn_label double, true_churned int")
    r = {x["model"]: x for x in ev.business_impact(df, 10, 100).collect()}
    assert r["intent"]["interventions"] == 26393.0
    assert r["intent"]["total_cost"] == 263930.0 and r["intent"]["total_benefit"] == 530400.0
    assert r["intent"]["roi"] == pytest.approx(1.0096237638767855, abs=1e-12)
    assert r["intent"]["cost_per_true_positive"] == pytest.approx(49.7605580693816, abs=1e-10)
    assert r["churn"]["total_cost"] == 215950.0 and r["churn"]["total_benefit"] == 98600.0
    assert r["churn"]["roi"] == pytest.approx(-0.5434128270432971, abs=1e-12)
    assert r["churn"]["cost_per_true_positive"] == pytest.approx(219.01622718052738, abs=1e-10)


def test_business_impact_no_tp_is_infinite(spark):
    df = spark.createDataFrame([(1.0, 0, 0.0, 0)], "churned_PREDICTION double, churned int, churn_label double, true_churned int")
    r = {x["model"]: x for x in ev.business_impact(df, 10, 100).collect()}
    assert math.isinf(r["intent"]["cost_per_true_positive"])
    assert r["churn"]["roi"] == 0.0


def test_classification_report_supports(spark):
    # Class supports of the printed intent report.
    n0, n1 = 323958, 19833
    df = spark.range(n0 + n1).select((F.col("id") >= n0).cast("int").alias("y"),
                                     (F.col("id") % 2).cast("double").alias("p"))
    rep = {r["label"]: r for r in ev.classification_report(df, "y", "p").collect()}
    assert rep["0.0"]["support"] == n0 and rep["1.0"]["support"] == n1
    assert rep["accuracy"]["support"] == 343791
    assert rep["macro avg"]["precision"] == pytest.approx((rep["0.0"]["precision"] + rep["1.0"]["precision"]) / 2)


def test_duplicate_marking_golden_rows(spark):
    # Two saved models with identical metrics and blueprint
    # (5 features each) and one distinct model; the second copy is a duplicate.
    rows = [("a", 0.62271, 0.57678, 5, "bp1"), ("b", 0.62271, 0.57678, 5, "bp1"), ("c", 0.63002, 0.58935, 8, "bp2"),
            ("d", None, 0.5, 9, "bp3"), ("e", None, 0.5, 7, "bp3")]
    df = spark.createDataFrame(rows, "model_id string, auc_v double, auc_h double, n_features int, blueprint_id string")
    out = {r["model_id"]: r["duplicate"] for r in
           dedup.mark_duplicates(df, ["auc_v", "auc_h", "blueprint_id"], ["n_features", "model_id"]).collect()}
    assert out == {"a": False, "b": True, "c": False, "d": True, "e": False}


def test_auc_invariants_and_ties(spark):
    data = [(1, 0.9), (0, 0.9), (1, 0.8), (0, 0.1), (0, 0.5), (1, 0.5), (0, 0.2)]
    df = spark.createDataFrame(data, "y int, p double")
    auc = mt.roc_auc(df, "y", "p").first()[0]
    # brute force: P(pos > neg) + 0.5 P(pos == neg)
    pos = [p for y, p in data if y == 1]
    neg = [p for y, p in data if y == 0]
    bf = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert auc == pytest.approx(bf)
    flipped = mt.roc_auc(df.withColumn("p", 1 - F.col("p")), "y", "p").first()[0]
    assert flipped == pytest.approx(1 - auc)


def test_auc_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, p double")
    assert mt.roc_auc(df, "y", "p").first()[0] is None


def test_fire_accumulate_single_positive_returns_first(spark):
    rows = [(0, "a", 1.0, 1.0, None), (0, "b", -1.0, -1.0, None), (0, "c", 0.0, 0.0, None)]
    df = spark.createDataFrame(rows, "model_id int, featureName string, impactUnnormalized double, "
                                     "impactNormalized double, redundantWith string")
    out = im.accumulate_select(df, 0.95).collect()
    assert [(r["position"], r["featureName"]) for r in out] == [(1, "a")]


def test_fire_rank_select_keeps_at_least_one(spark):
    rows = [(0, "a", 10.0, 1.0, None), (0, "b", 0.1, 0.01, None)]
    df = spark.createDataFrame(rows, "model_id int, featureName string, impactUnnormalized double, "
                                     "impactNormalized double, redundantWith string")
    out = im.fire_select(df, 0.5).collect()
    assert len(out) == 1 and out[0]["featureName"] == "a"


def test_feature_inclusion_and_half_ranks(spark):
    from churnkit.operators import joins as jn
    feats = spark.createDataFrame([("a",), ("b",), ("c",)], "Feature string")
    # median of an even number of ranks gives half ranks (as in saved rank files)
    imp = spark.createDataFrame([(0, "a", 3), (1, "a", 4), (0, "c", 1), (1, "c", 2)],
                                "model_id int, featureName string, rank int")
    ranks = im.median_rank(imp)
    out = {r["Feature"]: (r["rank"], r["included_in_model"]) for r in jn.feature_inclusion(feats, ranks).collect()}
    assert out == {"a": (3.5, 1), "b": (None, 0), "c": (1.5, 1)}


def test_api_names_resolve():
    from churnkit import api
    for name in ["merge_predictions", "profile", "describe", "value_counts", "top_percent", "downsample",
                 "backtest_splits", "fire_select", "accumulate_select", "dbscan", "flatten_metrics", "batch_score",
                 "business_impact", "cost_benefit", "roc_auc", "drift", "compare", "combinations", "retention"]:
        assert callable(getattr(api, name)), name


def test_shares_sum_to_one_and_empty_input(spark):
    from churnkit.operators import profile as pf
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "x string")
    tot = sum(r["share"] for r in pf.value_counts(df, ["x"]).collect())
    assert tot == pytest.approx(1.0)
    empty = spark.createDataFrame([], "churned_PREDICTION double, churned int, churn_label double, true_churned int")
    r = {x["model"]: x for x in ev.business_impact(empty, 10, 100).collect()}
    assert r["intent"]["interventions"] == 0.0 and r["intent"]["roi"] == 0.0
    assert math.isinf(r["intent"]["cost_per_true_positive"])


def test_segment_metrics_skip_null_segment(spark):
    rows = [("A", 1, 0.9, 1.0, 1, 1), ("A", 0, 0.2, 0.0, 0, 0), (None, 1, 0.8, 1.0, 1, 1), ("B", 0, 0.4, 1.0, 0, 1)]
    df = spark.createDataFrame(rows, "pubcode string, churned int, churned_1_PREDICTION double, "
                                     "churned_PREDICTION double, true_churned int, churn_label int")
    out = {r["pubcode"]: r for r in ev.segment_metrics(df).collect()}
    assert set(out) == {"A", "B"}
    assert out["A"]["intent_auc"] == 1.0 and out["B"]["intent_auc"] is None  # one class only
    assert out["B"]["intent_precision"] == 0.0


def test_backtest_roles_disjoint(spark):
    from churnkit.operators import splits as sp
    o = spark.range(400).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"),
                                F.col("id"))
    folds = sp.backtest_folds(o, "d", 3, "P0Y0M30DT0H0M0S", "P0Y1M0DT0H0M0S", "P0Y1M0DT0H0M0S")
    roles = sp.assign_roles(o, "d", folds)
    # one role per row and fold; validation windows do not overlap across folds
    assert roles.groupBy("id", "fold").count().where("count > 1").count() == 0
    v = roles.where("role = 'validation'").groupBy("id").count().where("count > 1").count()
    assert v == 0
    f = {r["fold"]: r for r in folds.collect()}
    assert f[0]["val_end"] == f[0]["holdout_start"] and f[1]["val_end"] == f[0]["val_start"]


def test_scale_settings_size_partitions():
    from churnkit.session import scale_settings
    s = scale_settings(100 * 2 ** 40, 8000)
    assert int(s["spark.sql.shuffle.partitions"]) == 100 * 2 ** 40 // (256 << 20)
    assert scale_settings(1, 16)["spark.sql.shuffle.partitions"] == "32"

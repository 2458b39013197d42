"""Invariants of the Spark ML jobs (their outputs have no SQL oracle)."""

import pytest
from pyspark.sql import functions as F

from churnkit.operators import ml
from churnkit.sources import fixtures
from tests.conftest import SF001

FEATS = ["l_quantity", "l_extendedprice", "l_discount"]


@pytest.fixture(scope="module")
def data(spark):
    df = fixtures.downsample_base(spark, SF001).withColumn("target_column", F.col("target_column").cast("double"))
    return ml.hash_partition(df, "row_key")


@pytest.fixture(scope="module")
def model(data):
    return ml.fit("lr", FEATS, "target_column", data.where("partition = 'training'"))


def test_batch_score_keeps_rows_with_missing_features(spark, data, model):
    holes = data.withColumn("l_discount", F.when(F.col("row_key") % 10 == 0, None).otherwise(F.col("l_discount")))
    out = ml.batch_score(model, holes, FEATS, 0.5, ["row_key"])
    n_in, n_out = holes.count(), out.count()
    assert n_in == n_out
    bad = out.where("prediction_status = 'missing feature'")
    assert bad.count() == holes.where("l_discount IS NULL").count()
    assert bad.where("churned_1_PREDICTION IS NOT NULL").count() == 0
    good = out.where("prediction_status = 'OK'").agg(
        F.max(F.abs(F.col("churned_1_PREDICTION") + F.col("churned_0_PREDICTION") - 1))).first()[0]
    assert good < 1e-9
    assert set(out.columns) >= {"THRESHOLD", "POSITIVE_CLASS", "churned_PREDICTION"}


def test_permutation_importance_normalised(spark, data, model):
    imp = ml.permutation_importance(model, data, FEATS, "target_column", "row_key").collect()
    assert {r["featureName"] for r in imp} == set(FEATS)
    norm = [r["impactNormalized"] for r in imp if r["impactNormalized"] is not None]
    if norm:
        assert max(norm) == pytest.approx(1.0)


def test_train_candidates_leaderboard(spark, data):
    cands = [ml.Candidate("lr", "lr", tuple(FEATS), {}), ml.Candidate("rf", "rf", tuple(FEATS), {"numTrees": 5})]
    lb, models = ml.train_candidates(data.drop("partition"), cands, "target_column", "row_key")
    rows = lb.collect()
    assert {(r["model_id"], r["partition"]) for r in rows} == {(m, p) for m in ("lr", "rf")
                                                               for p in ("validation", "holdout")}
    assert set(models) == {"lr", "rf"}


def test_select_until_stable_stops():
    calls = []

    def train_eval(feats):
        calls.append(len(feats))
        return 0.5  # never improves after the first round

    hist = ml.select_until_stable(train_eval, lambda r: ["a", "b", "c"][: max(1, int(r * 3))], 0.9, lives=3)
    assert hist[-1][5] == 0 or hist[-1][1] <= 0.01
    assert [h[4] for h in hist][0] is True and not any(h[4] for h in hist[1:])


def test_stream_scoring_restart_is_exactly_once(spark, data, model):
    import uuid

    from churnkit.session import shared_path
    from churnkit.streaming import score_stream
    run = uuid.uuid4().hex
    src, sink, ckpt = (shared_path(spark, f"test-stream/{run}/{x}") for x in ("src", "sink", "ckpt"))
    rows = data.select("row_key", *FEATS).withColumn("part", (F.col("row_key") % 2).cast("int"))
    schema = "row_key bigint, l_quantity double, l_extendedprice double, l_discount double"
    rows.where("part = 0").drop("part").write.parquet(f"{src}/a")
    score_stream(spark, model, f"{src}/*", schema, lambda d: d, FEATS, 0.5, ["row_key"], sink, ckpt)
    first = spark.read.parquet(sink).count()
    rows.where("part = 1").drop("part").write.parquet(f"{src}/b")
    score_stream(spark, model, f"{src}/*", schema, lambda d: d, FEATS, 0.5, ["row_key"], sink, ckpt)
    out = spark.read.parquet(sink)
    assert first == rows.where("part = 0").count()
    assert out.count() == rows.count()  # the restart picked up only the new files

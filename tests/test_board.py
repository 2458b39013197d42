"""The long board: upserts by key, nothing written when nothing changes, the same ids and choices when repeated."""

import uuid

import pytest
from pyspark.sql import functions as F

from churnkit.plans import board_iteration as B
from churnkit.session import shared_path
from churnkit.sources.io import current_version


@pytest.fixture
def board(spark):
    return B.Board(spark, shared_path(spark, f"test-board/{uuid.uuid4().hex}"))


def rows(spark, *values):
    return spark.createDataFrame([(m, f, "all", k, v, 1, "model", "Some Model", "lr", "{}", "x,y", 2) for m, f, k, v in values], B.SCHEMA)


def test_upsert_by_key(spark, board):
    assert board.upsert(rows(spark)) == 0 and current_version(spark, board.path) is None
    first = rows(spark, ("a", "validation", "auc", 0.7), ("a", "holdout", "auc", None), ("b", "validation", "auc", 0.6), ("b", "validation", "auc", 0.5))
    assert board.upsert(first) == 3
    version = current_version(spark, board.path)
    assert board.upsert(first) == 0 and current_version(spark, board.path) == version
    assert board.upsert(rows(spark, ("a", "holdout", "auc", 0.4), ("b", "validation", "auc", 0.6), ("c", "validation", "logloss", 0.3))) == 2
    got = {(r.model_id, r.fold, r.metric): r.value for r in board.rows().collect()}
    assert got == {("a", "validation", "auc"): 0.7, ("a", "holdout", "auc"): 0.4, ("b", "validation", "auc"): 0.6, ("c", "validation", "logloss"): 0.3}
    assert {r.model_id: (r.score, r.logloss) for r in board.models().collect()} == {"a": (0.7, None), "b": (0.6, None), "c": (None, 0.3)}


def test_model_ids_tell_models_apart():
    assert B.model_id("lr", ["x", "y"], {"a": 1, "b": 2}) == B.model_id("lr", ["x", "y"], {"b": 2, "a": 1})
    assert len({B.model_id(k, f, p) for k in ("lr", "rf") for f in (["x"], ["x", "y"], ["y", "x"]) for p in ({}, {"a": 1})}) == 12


def test_a_killed_iteration_goes_on(spark, board, monkeypatch):
    df = spark.range(600).selectExpr("id AS k", "CAST(hash(id) % 100 AS DOUBLE) AS x", "CAST(hash(id, 1) % 100 AS DOUBLE) AS z",
                                     "CAST(pmod(hash(id), 100) + pmod(hash(id, 3), 90) > 90 AS DOUBLE) AS y")
    args = (df, ["x", "z"], "y", "k", board.path, [("Logistic One", "lr", {}), ("Random Forest", "rf", {"numTrees": 2})])
    kept = B.Iteration.keep
    monkeypatch.setattr(B.Iteration, "keep", lambda self: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        B.iterate(*args, ratio=None, blend_size=2)
    before = board.rows().count()
    monkeypatch.setattr(B.Iteration, "keep", kept)
    out, changes = B.iterate(*args, ratio=None, blend_size=2)
    assert changes == 3 and out.count() == before + 3  # the marks of two models and a blend, nothing else
    assert out.where((F.col("metric") == "kept") & (F.col("value") == 1)).count() == 3


def test_a_repeated_iteration_reads_no_rows(spark, board, monkeypatch):
    df = spark.range(400).selectExpr("id AS k", "CAST(hash(id) % 100 AS DOUBLE) AS x", "CAST(hash(id, 1) % 100 AS DOUBLE) AS z",
                                     "CAST(pmod(hash(id), 100) + pmod(hash(id, 3), 90) > 90 AS DOUBLE) AS y")
    args = (df, ["x", "z"], "y", "k", board.path, [("Logistic One", "lr", {}), ("Random Forest", "rf", {"numTrees": 2})])
    first, _ = B.iterate(*args, ratio=None, blend_size=2)
    totals = {(r.fold, r.metric): r.value for r in first.where("model_category = 'blend' AND metric IN ('n_pos', 'n_neg')").collect()}
    held = B.ml.hash_partition(df, "k").where("partition <> 'training'").groupBy("partition").agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")).collect()
    assert totals == {(r.partition, m): v for r in held for m, v in (("n_pos", r.pos), ("n_neg", r.neg))}
    monkeypatch.setattr(B.ml, "hash_partition", lambda *a, **b: 1 / 0)
    monkeypatch.setattr(B.ml, "vector_table", lambda *a, **b: 1 / 0)
    again, changes = B.iterate(*args, ratio=None, blend_size=2)
    assert changes == 0 and again.count() == first.count()


def test_fits_and_scores_read_their_own_rows_alone(spark, board):
    df = spark.range(400).selectExpr("id AS k", "CAST(hash(id) % 100 AS DOUBLE) AS x", "CAST(id % 2 AS DOUBLE) AS y")
    it = B.Iteration(df, ["x"], "y", "k", board.path)
    assert it.table.rows.columns == ["y", "features", "partition"]
    want = B.ml.hash_partition(df, "k").where("partition = 'training'")
    own = it.table.rows.where("partition = 'training'")
    assert own.count() == want.count() > 200
    assert "PartitionFilters: [isnotnull(partition" in own._jdf.queryExecution().executedPlan().toString()

"""Trees on binned blocks: Spark's models, equal rows counted once, scores computed once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnkit.operators import ml, trees
from churnkit.operators.metrics import score_table


@pytest.fixture(scope="module")
def rows(spark):
    return ml.materialize(spark.range(3000).selectExpr(
        "id AS k", "CAST(hash(id) % 1000 AS DOUBLE) / 100 AS x", "IF(id % 9 = 0, NULL, CAST(hash(id, 1) % 100 AS INT)) AS z",
        "IF(id % 13 = 0, NULL, element_at(array('p', 'q', 'r'), CAST(pmod(hash(id, 2), 3) AS INT) + 1)) AS t",
        "CAST(pmod(hash(id), 1000) + pmod(hash(id, 3), 900) > 900 AS DOUBLE) AS y").repartition(4))


@pytest.mark.parametrize("feats", [["x", "z", "t"], ["z", "x"]])
def test_boosted_trees_are_those_of_sparks_learner(rows, feats, monkeypatch):
    own = ml.fit("gbt", feats, "y", rows, maxIter=3)
    monkeypatch.setattr(trees, "fit", lambda *a: None)
    want = ml.fit("gbt", feats, "y", rows, maxIter=3)
    assert own.stages[-1].totalNumNodes == want.stages[-1].totalNumNodes > 3
    assert np.allclose(own.stages[-1].featureImportances.toArray(), want.stages[-1].featureImportances.toArray())
    a, b = (ml.probability(m.transform(rows)).select("k", F.col("p1").alias(n)) for m, n in ((own, "a"), (want, "b")))
    assert a.join(b, "k").where("abs(a - b) < 1e-9").count() == 3000


def test_thresholds_of_more_rows_than_are_sampled_are_those_of_sparks_learner(spark, monkeypatch):
    many = ml.materialize(spark.range(0, 40_000, 1, 4).selectExpr(
        "id AS k", "greatest(CAST(hash(id) % 1000 AS DOUBLE) / 7, 0) AS x", "1 + CAST(pmod(hash(id, 1), 5000) AS DOUBLE) AS z",
        "CAST(pmod(hash(id), 1000) + pmod(hash(id, 3), 900) > 900 AS DOUBLE) AS y"))
    splits = lambda m: [line for line in m.stages[-1].toDebugString.split("\n") if "feature " in line]
    own = splits(ml.fit("gbt", ["x", "z"], "y", many, maxIter=2))
    monkeypatch.setattr(trees, "fit", lambda *a: None)
    assert own == splits(ml.fit("gbt", ["x", "z"], "y", many, maxIter=2)) and len(own) > 10


def test_a_forest_is_as_good_as_sparks_and_the_same_when_repeated(rows, monkeypatch):
    args = ("rf", ["x", "u"], "y", rows.withColumn("u", F.col("x") + F.col("k") % 7 / 10))
    one, again = (ml.fit(*args, numTrees=24) for _ in range(2))
    assert one.stages[-1].toDebugString.split("\n")[1:] == again.stages[-1].toDebugString.split("\n")[1:]
    monkeypatch.setattr(trees, "fit", lambda *a: None)
    a, b = (ml.evaluate(m, args[3], "y").first() for m in (one, ml.fit(*args, numTrees=24)))
    assert a["auc"] == pytest.approx(b["auc"], abs=0.03) and a["logloss"] == pytest.approx(b["logloss"], abs=0.05)


def test_what_the_blocks_cannot_hold_is_left_to_spark(rows, monkeypatch):
    asked, fit = [], trees.fit
    monkeypatch.setattr(trees, "fit", lambda *a: asked.append(fit(*a)) or asked[-1])
    ml.fit("gbt", ["x"], "y", rows, maxIter=1, subsamplingRate=0.5)
    ml.fit("rf", ["x"], "y", rows.withColumn("y", F.col("k") % 3), numTrees=1)
    ml.fit("rf", ["x"], "y", rows.withColumn("w", F.lit(2.0)), "w", numTrees=1)
    assert asked == [None] * 3


def test_rows_of_the_same_bins_and_label_are_one_row_with_their_number(spark):
    df = spark.range(0, 20_000, 1, 2).selectExpr("array(CAST(id % 5 AS DOUBLE), 0D, CAST(id % 3 AS DOUBLE)) AS x", "CAST(id % 2 AS DOUBLE) AS y")
    cuts = [np.arange(4) + 0.5, np.empty(0), np.array([0.5, 1.5])]
    blocks = trees._binned(df, cuts, None).collect()
    got: dict = {}
    for r in blocks:
        y, n = np.frombuffer(r.y, np.uint8), np.frombuffer(r.n, np.int64)
        for cell, k in zip(zip(*np.frombuffer(r.x, np.uint8).reshape(3, -1), y), n):
            got[cell] = got.get(cell, 0) + k
    assert sum(len(r.y) for r in blocks) == 60 and len({r.block for r in blocks}) == 2  # 30 cells in each of two tasks
    assert got == {(i % 5, 0, i % 3, i % 2): n for i, n in enumerate(np.bincount(np.arange(20_000) % 30))}


def test_levels_wider_than_a_pass_and_cut_histograms(rows, monkeypatch):
    want = ml.fit("gbt", ["x", "z"], "y", rows, maxIter=2).stages[-1].toDebugString.split("\n")[1:]
    monkeypatch.setattr(trees, "HISTOGRAM_BYTES", 1)
    monkeypatch.setattr(trees, "COLLECTED_BYTES", 0)
    assert ml.fit("gbt", ["x", "z"], "y", rows, maxIter=2).stages[-1].toDebugString.split("\n")[1:] == want


def test_a_score_is_computed_once_per_row_and_missing_ones_do_not_count(spark):
    calls = spark.sparkContext.accumulator(0)

    def scored(x):
        calls.add(1)
        return None if x == 3 else float("nan") if x == 4 else float(x % 2)

    df = spark.range(100).select(F.udf(scored, "double")("id").alias("p"), (F.col("id") % 5 == 0).cast("double").alias("y"))
    got = {r.score: (r.pos, r.neg, r.tot_neg) for r in score_table(df, "y", "p").collect()}
    assert calls.value == 100
    assert got == {0.0: (10.0, 39.0, 78.0), 1.0: (10.0, 39.0, 78.0)}


def test_blends_side_by_side_equal_those_of_long_predictions_without_a_shuffle(spark):
    nan = float("nan")
    values = [(1, 0.1, 0.4, 0.7), (2, 0.3, None, 0.9), (3, None, None, None), (4, nan, 0.2, 0.5), (5, 0.25, 0.25, None)]
    wide = spark.createDataFrame([(*v, float(v[0] % 2)) for v in values], "row int, a double, b double, c double, y double")
    long = spark.createDataFrame([(v[0], m, p, float(v[0] % 2)) for v in values for m, p in zip("abc", v[1:])], "row int, model string, p double, y double")
    combos = spark.createDataFrame([(c, m) for c in ("ab", "abc", "bc", "a") for m in c], "combo_id string, model string")
    methods = ["AVG", "MED", "MIN", "MAX"]
    side = ml.blend_all(wide, combos, methods, ["row"], extra={"y": F.col("y")}, p_cols={m: m for m in "abc"})
    key = lambda df: sorted((r.combo_id, r.row, r.y, r.method, repr(r.p)) for r in df.collect())
    want = key(ml.blend_all(long, combos, methods, ["row"], extra={"y": F.max("y")}))
    assert key(side) == want and len(want) > 40
    assert "Exchange" not in side._jdf.queryExecution().executedPlan().toString()

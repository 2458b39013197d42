"""Shared vectors and role bits: same metrics as fits of their own, same roles as rows per fold, one written copy."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from churnkit.operators import ml, splits
from churnkit.operators.metrics import weighted_binary_metrics


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1500).selectExpr(
        "id AS k", "CAST(hash(id) % 1000 AS DOUBLE) / 100 AS x", "IF(id % 9 = 0, NULL, CAST(hash(id, 1) % 100 AS DOUBLE)) AS `odd name`",
        "IF(id % 13 = 0, NULL, element_at(array('p', 'q', 'r'), CAST(pmod(hash(id, 2), 3) AS INT) + 1)) AS t",
        "CAST(pmod(hash(id), 1000) + pmod(hash(id, 3), 900) > 900 AS DOUBLE) AS y", "1.0D + pmod(id, 3) AS w",
        "date_add(DATE'2020-01-01', CAST(pmod(hash(id, 5), 400) AS INT)) AS d").repartition(4)


def close(a, b):
    return all(a[c] == pytest.approx(b[c], abs=1e-6) for c in ("auc", "logloss", "rmse", "average_precision"))


def test_candidates_on_shared_vectors_equal_fits_of_their_own(rows):
    parted = ml.hash_partition(rows, "k")
    cands = [ml.Candidate("all", "lr", ("x", "odd name", "t"), {"regParam": 0.01}), ml.Candidate("few", "lr", ("t", "x"), {"regParam": 0.01}),
             ml.Candidate("tree", "rf", ("odd name",), {"numTrees": 3})]
    board, models = ml.train_candidates(rows, cands, "y", "k", weight="w")
    got = {(r.model_id, r.partition): r for r in board.collect()}
    assert len(got) == 6
    for c in cands:
        own = ml.fit(c.kind, c.features, "y", parted.where("partition = 'training'"), "w", **c.params)
        want = ml.evaluate(own, parted.where("partition = 'validation'"), "y", "w").first()
        if c.kind == "lr":
            assert close(got[c.model_id, "validation"], want), c.model_id
        again = weighted_binary_metrics(ml.probability(models[c.model_id].transform(parted.where("partition = 'validation'"))), "y", "p1", "w")
        assert close(got[c.model_id, "validation"], again.first())
    assert got["few", "holdout"].n_features == 2


def folds_of(rows, n):
    return splits.backtest_folds(rows, "d", n, "P0Y0M10DT0H0M0S", "P0Y0M20DT0H0M0S", "P0Y0M15DT0H0M0S")


def test_bits_equal_rows_per_fold(rows):
    folds = folds_of(rows, 5)
    masked, ids = splits.fold_masks(rows, "d", folds)
    assert masked.count() == rows.count() and ids == list(range(5))
    want = {(r.fold, r.role): r["count"] for r in splits.assign_roles(rows, "d", folds).groupBy("fold", "role").count().collect()}
    for k in ids:
        for role, mask in (("train", "train_mask"), ("validation", "validation_mask")):
            assert masked.where(splits.in_window(mask, k)).count() == want.get((k, role), 0)


def test_more_windows_than_bits_of_a_number_open_ends_and_null_dates(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1) + dt.timedelta(i),) for i in range(200)] + [(None,)], "d date")
    windows = [(dt.date(2020, 1, 1) + dt.timedelta(i), dt.date(2020, 1, 1) + dt.timedelta(i + 2)) for i in range(150)] + [(None, None)]
    masked = df.withColumn("m", splits.window_mask("d", windows))
    one = masked.agg(*[F.count_if(splits.in_window("m", k)).alias(f"n{k}") for k in range(151)]).first()
    assert list(one) == [2] * 150 + [200]


def test_backtests_and_durations_equal_fits_on_rows_per_fold(rows):
    folds = folds_of(rows, 3)
    roles = splits.assign_roles(rows, "d", folds)
    got = {r.fold: r for r in ml.backtest_time(rows, "d", folds, "lr", ["x", "odd name"], "y", regParam=0.01).collect()}
    grid = ml.duration_grid_score(rows, "d", folds, [1, 3], "lr", ["x"], "y", regParam=0.01).collect()
    assert sorted(got) == [0, 1, 2] and {(r.fold, r.months) for r in grid} == {(f, m) for f in range(3) for m in (1, 3)}
    for f in got:
        part = roles.where(F.col("fold") == f)
        own = ml.fit("lr", ["x", "odd name"], "y", part.where("role = 'train'"), regParam=0.01)
        assert close(got[f], ml.evaluate(own, part.where("role = 'validation'"), "y").first())


def test_a_column_of_ids_is_refused_as_folds(rows):
    with pytest.raises(ValueError):
        ml.backtest_score(rows, "lr", ["x"], "y", "k")


def test_indicators_that_never_occur_are_left_out_and_change_nothing(rows):
    df = rows.select("k", "x", "odd name", "t", "y", F.col("x").alias("full"))
    table = ml.vector_table(df, ["x", "odd name", "full", "t"], "y")
    assert table.idle == {table.places["x"][1], table.places["full"][1]}
    every = ml.VectorTable(table.prepared, table.rows, table.places, table.numeric, set())
    yes = F.lit(True)
    for kind, params in (("lr", {"regParam": 0.01}), ("gbt", {"maxIter": 2}), ("rf", {"numTrees": 2})):
        fits = [ml.Fit({"m": kind}, kind, ["x", "odd name", "full", "t"], params, yes, yes)]
        (few, short), (all_, long) = (ml.run_fits(t, fits, "y") for t in (table, every))
        assert close(few.first(), all_.first()), kind
        assert long[0].stages[-1].numFeatures - short[0].stages[-1].numFeatures == (0 if kind == "rf" else 2)
    assert ml.fit("lr", ["x"], "y", df).stages[-1].numFeatures == 1
    assert ml.fit("lr", ["odd name"], "y", df).stages[-1].numFeatures == 2


def test_rounds_of_a_selection_share_one_table_of_vectors(rows, monkeypatch):
    from churnkit.plans import feature_selection

    written = []
    table = ml.vector_table
    monkeypatch.setattr(ml, "vector_table", lambda *a, **k: written.append(a) or table(*a, **k))
    got = feature_selection.run(rows, ["x", "odd name", "w"], "y", "k", kinds=("lr",), n_models=1, lives=2).collect()
    assert len(got) > 1 and len({r.features for r in got}) > 1
    assert len(written) == 1


def test_candidates_of_no_rows_and_of_one_partition(rows, spark):
    one = rows.where("k = 3")
    table = ml.candidate_table(one, ["x"], "y", "k")
    assert table.rows.count() == 1 and table.rows.schema["partition"].dataType.simpleString() == "string"
    assert ml.candidate_table(rows.where("false"), ["x"], "y", "k").rows.count() == 0


def test_impacts_after_an_improvement_are_those_of_the_features_left(rows, monkeypatch):
    from churnkit.plans import feature_selection

    train, asked = ml.train_candidates, []

    def fewer_is_better(*a, **k):
        board, models = train(*a, **k)
        return board.withColumn("auc", 1 - F.col("n_features") / 100), models

    impact = ml.permutation_importance
    monkeypatch.setattr(ml, "train_candidates", fewer_is_better)
    monkeypatch.setattr(ml, "permutation_importance", lambda m, v, feats, *a, **k: asked.append((m, feats)) or impact(m, v, feats, *a, **k))
    got = feature_selection.run(rows, ["x", "odd name", "w", "t"], "y", "k", kinds=("lr",), n_models=1, lives=1).collect()
    assert got[1].improved and got[1].n_features < 4 and len(asked) > 1
    # as those of a model fitted on the features left alone
    parted = ml.hash_partition(rows, "k")
    feats = got[1].features.split(",")
    own = ml.fit("lr", feats, "y", parted.where("partition = 'training'"))
    val = parted.where("partition = 'validation'")
    few, want = (impact(m, val, feats, "y", "k", trained_on=t).collect() for m, t in ((asked[1][0], ["x", "odd name", "w", "t"]), (own, feats)))
    # values are moved by the place of a row, so the impacts of 300 rows differ by chance
    assert all(a.featureName == b.featureName and a.impactUnnormalized == pytest.approx(b.impactUnnormalized, abs=0.2)
               for a, b in zip(few, want, strict=True))
    a, b = (ml.evaluate(m, val, "y").first() for m in (asked[1][0], own))
    assert a["auc"] == pytest.approx(b["auc"], abs=1e-4) and a["logloss"] == pytest.approx(b["logloss"], abs=1e-4)


def test_scores_of_fits_are_read_once_and_not_written(spark, monkeypatch):
    df = spark.range(300).selectExpr("id AS k", "CAST(hash(id) % 50 AS DOUBLE) AS x", "CAST(id % 3 AS DOUBLE) AS fold",
                                     "CAST(pmod(hash(id, 1), 4) AS DOUBLE) AS w", "CAST(pmod(hash(id), 2) AS DOUBLE) AS y")
    table = ml.vector_table(df, ["x"], "y", ["fold", "w"])
    fits = [ml.Fit({"fold": f}, "lr", ["x"], {}, F.col("fold") != f, F.col("fold") == f) for f in (0.0, 1.0, 2.0)]
    monkeypatch.setattr(ml, "materialize", lambda *a: 1 / 0)
    board, models = ml.run_fits(table, fits, "y", "w")
    got = {r.fold: r for r in board.collect()}
    for f, m in zip((0.0, 1.0, 2.0), models):
        rows = ml.probability(m.transform(df.where(F.col("fold") == f))).select("y", "p1", "w").collect()
        total = sum(r.w for r in rows)
        assert got[f].logloss == pytest.approx(-sum(r.w * math.log(r.p1 if r.y else 1 - r.p1) for r in rows) / total)
        assert got[f].rmse == pytest.approx(math.sqrt(sum(r.w * (r.y - r.p1) ** 2 for r in rows) / total))
    monkeypatch.undo()
    once = ml.candidate_table
    calls = []
    monkeypatch.setattr(ml, "materialize", lambda d, *a, write=ml.materialize: calls.append(1) or write(d, *a))
    once(df, ["x"], "y", "k")
    assert len(calls) == 1  # numbers alone: the vectors, and no copy of the rows before

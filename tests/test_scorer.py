"""Models as arrays: same scores as the pipeline, importances, histogram metrics against exact ones, blends."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnkit.operators import histogram as H, ml
from churnkit.operators.metrics import weighted_binary_metrics
from churnkit.operators.scorer import scorer

FEATS = ["x", "odd name", "t", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1200).selectExpr(
        "id AS k", "CAST(hash(id) % 1000 AS DOUBLE) / 100 AS x", "IF(id % 9 = 0, NULL, CAST(hash(id, 1) % 100 AS INT)) AS `odd name`",
        "IF(id % 13 = 0, NULL, element_at(array('p', 'q', 'r'), CAST(pmod(hash(id, 2), 3) AS INT) + 1)) AS t", "id % 2 = 0 AS b",
        "CAST(pmod(hash(id), 1000) + pmod(hash(id, 3), 900) > 900 AS DOUBLE) AS y").repartition(4)


@pytest.mark.parametrize("kind", ["lr", "rf", "gbt"])
def test_arrays_score_as_the_pipeline(rows, kind):
    model = ml.fit(kind, FEATS, "y", rows)
    new = rows.unionByName(rows.limit(5).withColumn("t", F.lit("unseen")).withColumn("k", F.col("k") + 9000))
    arrays = scorer(model, FEATS, rows)
    want = {r.k: r.p1 for r in ml.probability(model.transform(new)).select("k", "p1").collect()}
    got = new.select("k", *arrays.inputs()).toArrow()
    p = arrays.score({f: arrays.places(f, got[f].combine_chunks()) for f in arrays.features})
    assert len(want) == 1205 and all(abs(v - want[k]) < 1e-9 for k, v in zip(got["k"].to_pylist(), p))


def test_arrays_of_a_model_on_shared_vectors(rows):
    cands = [ml.Candidate("a", "lr", ("x", "t", "odd name", "b"), {}), ml.Candidate("few", "rf", ("t", "x"), {"numTrees": 4})]
    _, models = ml.train_candidates(rows, cands, "y", "k")
    arrays = scorer(models["few"], list(cands[0].features), rows)
    got = rows.select("k", *arrays.inputs()).toArrow()
    p = arrays.score({f: arrays.places(f, got[f].combine_chunks()) for f in arrays.features})
    want = {r.k: r.p1 for r in ml.probability(models["few"].transform(rows)).select("k", "p1").collect()}
    assert all(abs(v - want[k]) < 1e-9 for k, v in zip(got["k"].to_pylist(), p))


def test_importance_ranks_what_matters_and_is_exactly_zero_for_the_rest(rows):
    model = ml.fit("gbt", FEATS, "y", rows)
    imp = {r.featureName: r for r in ml.permutation_importance(model, rows, [*FEATS, "k"], "y", "k", trained_on=FEATS).collect()}
    assert max(imp, key=lambda f: imp[f].impactUnnormalized) == "x" and imp["x"].impactNormalized == 1
    assert imp["k"].impactUnnormalized == 0 and imp["x"].impactUnnormalized > 0.1
    again = {r.featureName: r.impactUnnormalized for r in ml.permutation_importance(model, rows, FEATS, "y", "k").collect()}
    assert again == {f: imp[f].impactUnnormalized for f in FEATS}


def test_importance_without_rows_or_with_one_class(rows):
    model = ml.fit("lr", ["x"], "y", rows)
    assert ml.permutation_importance(model, rows.limit(0), ["x"], "y", "k").first().impactUnnormalized is None
    assert ml.permutation_importance(model, rows.where("y = 1"), ["x"], "y", "k").first().impactUnnormalized is None


def test_histogram_metrics_equal_exact_ones_with_a_bin_for_every_score(spark):
    g = np.random.default_rng(3)
    p, w = np.round(g.random(900), 2), g.integers(1, 4, 900).astype(float)
    y = (g.random(900) < p).astype(float)
    edges = np.unique(p)
    total = H.empty(edges)
    for part in np.array_split(np.arange(900), 7):
        H.add(total, edges, p[part], y[part], w[part])
    want = weighted_binary_metrics(spark.createDataFrame(list(zip(y.tolist(), p.tolist(), w.tolist())), "y double, p double, w double"),
                                   "y", "p", "w").first()
    got = H.metrics(total)
    assert all(got[m] == pytest.approx(want[m], abs=1e-9) for m in H.METRICS)
    assert H.metrics(H.empty(edges))["auc"] is None


def test_blends_of_rows_that_miss_models(spark):
    preds = [(i, float(i % 2), m, v) for i in range(60) for m, v in (("a", i / 60), ("b", None if i % 5 == 0 else (i * 7 % 60) / 60), ("c", float("nan")))]
    df = spark.createDataFrame(preds, "row int, y double, model string, p double")
    combos = spark.createDataFrame([("ab", "a"), ("ab", "b"), ("b", "b"), ("c", "c")], "combo_id string, model string")
    got = {(r.combo_id, r.method): r for r in ml.blend_metrics(df, combos, ["AVG", "MAX"], ["row"], "y", bins=400).collect()}
    value = {r[0:1] + (r[2],): r[3] for r in preds}
    for combo, ms in (("ab", "ab"), ("b", "b")):
        for method, f in (("AVG", lambda v: sum(v) / len(v)), ("MAX", max)):
            vs = {i: [value[i, m] for m in ms if value[i, m] is not None] for i in range(60)}
            rows = [(float(i % 2), f(v)) for i, v in vs.items() if v]
            pairs = [(p > q) + 0.5 * (p == q) for a, p in rows if a == 1 for b, q in rows if b == 0]
            r = got[combo, method]
            assert r.n_pos + r.n_neg == len(rows) and r.auc == pytest.approx(sum(pairs) / len(pairs), abs=0.02)
    assert got["c", "AVG"].n_pos == 0 and got["c", "AVG"].auc is None

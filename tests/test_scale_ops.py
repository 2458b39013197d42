"""Distributed operators against brute force on small hand-made frames,
including a key that holds a third of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from churnkit.functions.durations import parse_duration
from churnkit.operators import cluster as cl, prefix, profile as pf, sampling as sm


def test_prefix_sum_matches_brute_force_with_hot_value(spark):
    rnd = random.Random(3)
    vals = [0.5] * 400 + [rnd.random() for _ in range(800)]  # one value holds a third of the rows
    rows = [(i, v, rnd.randint(1, 5)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "id long, s double, w long")
    out = prefix.prefix_sum(df, ["s", "id"], ["w"], ranges=16).collect()
    direct = prefix.prefix_sum(df, ["s", "id"], ["w"]).collect()  # the session's number of ranges
    assert {r["id"]: r["cum_w"] for r in direct} == {r["id"]: r["cum_w"] for r in out}
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    expect, run = {}, 0
    for r in order:
        run += r[2]
        expect[r[0]] = run
    assert {r["id"]: r["cum_w"] for r in out} == expect


@pytest.fixture(params=["1", "23"])
def plan_mode(request, spark):
    """Run a test with one range and with many."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_top_n_flag_ties_and_nulls(spark, plan_mode):
    rows = [(i, 1.0 if i < 30 else (None if i % 7 == 0 else float(i % 5))) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, s double")
    n = 40
    out = {r["id"]: r["priority"] for r in prefix.top_n_flag(df, "s", n, ["id"]).collect()}
    ranked = sorted([r for r in rows if r[1] is not None], key=lambda r: (-r[1], r[0]))
    expect = {r[0]: False for r in rows}
    for r in ranked[:n]:
        expect[r[0]] = True
    assert out == expect
    assert sum(out.values()) == n


def test_top_n_flags_of_two_rankings(spark, plan_mode):
    rnd = random.Random(5)
    rows = [(rnd.choice([None, "a", "b", "\u00e9"]), i, rnd.choice([None, 0.5, 0.5, 0.5, rnd.random(), float("nan")]), float(i))
            for i in range(300)]  # half of the first score's rows are tied
    df = spark.createDataFrame(rows, "name string, id long, s double, t double")

    def first(n, k):
        there = [r for r in rows if r[k] is not None]
        order = sorted(there, key=lambda r: (r[k] == r[k], -r[k] if r[k] == r[k] else 0, r[0] is not None, (r[0] or "").encode(), r[1]))
        return {r[1] for r in order[:n]}

    for n in (0, 1, 90, 150, 10_000):
        out = prefix.top_n_flags(df, {"x": "s", "y": "t"}, n, ["name", "id"])
        assert out.columns == [*df.columns, "x", "y"]
        got = out.collect()
        assert len(got) == len(rows)
        assert {r["id"] for r in got if r["x"]} == first(n, 2)
        assert {r["id"] for r in got if r["y"]} == first(n, 3)
        assert all(r["x"] is not None and r["y"] is not None for r in got)
    assert prefix.top_n_flags(df.limit(0), {"x": "s"}, 3, ["id"]).count() == 0


def test_top_n_per_group_counts(spark, plan_mode):
    rows = [(g, i, float((i * 7) % 11)) for g in ("a", "b") for i in range(57 if g == "a" else 23)]
    df = spark.createDataFrame(rows, "g string, id long, s double")
    out = prefix.top_n_per_group(df, "s", 10, ["id"], by=["g"])
    got = {r["g"]: r["n"] for r in out.where("priority").groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert got == {"a": 5, "b": 2}


def test_exact_quantiles_match_interpolation(spark, plan_mode):
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    d = pf.describe(df, ["x"]).first()
    s = sorted(vals)

    def q(p):
        h = (len(s) - 1) * p
        lo = int(h)
        return s[lo] + (h - lo) * (s[min(lo + 1, len(s) - 1)] - s[lo])
    assert (d["p25"], d["p50"], d["p75"]) == pytest.approx((q(0.25), q(0.5), q(0.75)))


def test_downsample_keeps_class_ratio(spark):
    df = spark.range(20000).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    ds = sm.downsample(df, "y", 6000, 0.1, "k")
    r = ds.agg(F.sum(F.when(F.col("y") > 0, F.col("weight")).otherwise(0.0)).alias("wp"),
               F.sum("weight").alias("wt"), F.count("*").alias("n")).first()
    assert r["wp"] / r["wt"] == pytest.approx(0.1, abs=0.01)
    assert ds.where("y > 0").agg(F.min("weight")).first()[0] == 1.0
    again = sm.downsample(df, "y", 6000, 0.1, "k")
    assert again.exceptAll(ds).count() == 0  # same rows every run


def test_iso_duration():
    d = parse_duration("P0Y2M0DT0H0M0S")
    assert (d.months, d.days) == (2, 0)
    assert parse_duration("P0Y0M60DT0H0M0S").days == 60
    with pytest.raises(ValueError):
        parse_duration("2 months")


def test_dbscan_hand_made(spark):
    # a-b-c close (core chain), d near c only (border), e alone (noise);
    # f-g-h a second cluster
    close = [("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("f", "g"), ("g", "h"), ("f", "h")]
    feats = ["a", "b", "c", "d", "e", "f", "g", "h"]
    pairs = [(x, y, 0.1 if (x, y) in close else 0.9) for i, x in enumerate(feats) for y in feats[i + 1:]]
    dist = spark.createDataFrame(pairs, "feature1 string, feature2 string, distance double")
    out = {r["feature"]: r["cluster"] for r in cl.dbscan(dist, cl.feature_positions(feats, spark), 0.4, 3).collect()}
    assert out == {"a": 1, "b": 1, "c": 1, "d": 1, "e": 0, "f": 2, "g": 2, "h": 2}


def test_corr_blocks_equal_agg(spark):
    rnd = random.Random(5)
    rows = [(rnd.random(), None if i % 9 == 0 else rnd.random() * 3 + i * 0.01, float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    x = {(r[0], r[1]): r[2] for r in cl.corr_pairs(df, ["a", "b", "c"], method="agg").collect()}
    y = {(r[0], r[1]): r[2] for r in cl.corr_pairs_blocks(df, ["a", "b", "c"]).collect()}
    assert x.keys() == y.keys()
    for k in x:
        assert x[k] == pytest.approx(y[k], abs=1e-9)


def test_null_keys_group_together_in_describe(spark, plan_mode):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (1, 2.0)], "g int, v double")
    d = {r["g"]: r["p50"] for r in pf.describe(df, ["v"], by=["g"]).collect()}
    assert d == {None: 2.0, 1: 2.0}


def test_merge_null_keys_match_each_other(spark):
    from churnkit.operators.joins import merge_predictions
    a = spark.createDataFrame([(1, "2024-01-01", 0.1), (None, "2024-01-01", 0.2), (2, None, 0.3), (3, "2024-02-01", 0.4)],
                              "id long, d string, p double")
    b = spark.createDataFrame([(1, "2024-01-01", 1), (None, "2024-01-01", 0), (2, None, 1), (4, "2024-02-01", 0)],
                              "id long, e string, y int")
    out = [(r["id"], r["d"], r["e"], r["p"], r["y"]) for r in merge_predictions(a, b, ["id", "d"], ["id", "e"]).collect()]
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted(out, key=key) == sorted([
        (1, "2024-01-01", "2024-01-01", 0.1, 1), (None, "2024-01-01", "2024-01-01", 0.2, 0),
        (2, None, None, 0.3, 1), (3, "2024-02-01", None, 0.4, None), (4, None, "2024-02-01", None, 0)], key=key)


def test_corr_blocks_stable_for_large_values(spark):
    """Values around 1e9 varying by about 1: the block path (per-task shift,
    re-centred on exact means) must match the exact rational result."""
    import math
    from fractions import Fraction as Fr
    rnd = random.Random(9)
    rows = [(1e9 + rnd.random(), 1e9 + 0.5 * i / 1000 + rnd.random() * 0.1) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(6)
    got = cl.corr_pairs_blocks(df, ["a", "b"]).first()["statistic"]
    a, b = [Fr(r[0]) for r in rows], [Fr(r[1]) for r in rows]
    ma, mb = sum(a) / len(a), sum(b) / len(b)
    sab = sum((x - ma) * (y - mb) for x, y in zip(a, b))
    exact = float(sab) / math.sqrt(float(sum((x - ma) ** 2 for x in a)) * float(sum((y - mb) ** 2 for y in b)))
    assert got == pytest.approx(exact, abs=1e-10)


def test_merge_fast_path_equals_null_safe_without_nulls(spark):
    from churnkit.operators.joins import any_null, merge_predictions
    a = spark.createDataFrame([(i, f"d{i % 3}", float(i)) for i in range(50)], "id long, d string, p double")
    b = spark.createDataFrame([(i, f"d{i % 3}", i % 2) for i in range(25, 80)], "id long, e string, y int")
    assert not any_null(a, ["id", "d"]) and not any_null(b, ["id", "e"])
    assert any_null(a.union(spark.createDataFrame([(None, "d0", 1.0)], a.schema)), ["id", "d"])
    fast = merge_predictions(a, b, ["id", "d"], ["id", "e"], null_keys=False)
    safe = merge_predictions(a, b, ["id", "d"], ["id", "e"], null_keys=True)
    assert fast.count() == safe.count() == 80  # 25 left-only, 25 matched, 30 right-only
    assert fast.exceptAll(safe).count() == 0 and safe.exceptAll(fast).count() == 0


def test_correlations_by_aggregates_stay_compiled(spark, monkeypatch):
    """Rows of several patterns of missing values against numpy; no aggregation has more buffers than Spark compiles."""
    import numpy as np
    from churnkit.operators import cluster as cl
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 13)) + rng.normal(size=(400, 1)) + 1e3
    x[:, 5] = 7.1  # constant
    gone = np.zeros(x.shape, bool)
    gone[:100, 2] = gone[50:200, 3] = gone[300:, [2, 5, 8]] = gone[:, 11] = True
    cols = [f"f{i}" for i in range(13)]
    rows = [[None if g else float(v) for v, g in zip(r, h)] for r, h in zip(x, gone)]
    plans = []

    def recorded(df, real=cl.materialize):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    monkeypatch.setattr(cl, "materialize", recorded)
    out = cl.corr_pairs(spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(5), cols, method="agg")
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert max(line.count("partial_") for p in plans for line in p.splitlines()) < 50
    got = {(r[0], r[1]): r[2] for r in out.collect()}
    assert len(got) == 78
    for (a, b), v in got.items():
        i, j = int(a[1:]), int(b[1:])
        there = ~gone[:, i] & ~gone[:, j]
        want = None if 11 in (i, j) or 5 in (i, j) else np.corrcoef(x[there, i], x[there, j])[0, 1]
        assert v is None if want is None else abs(v - want) < 1e-9

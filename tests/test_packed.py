"""Packed moments: equal to exact arithmetic however rows are dealt, wide tables, nothing written per task."""

from fractions import Fraction

import numpy as np
import pytest

from churnkit.operators import cluster as cl
from churnkit.operators.packed import SCHEMA, merge_tree, packed


def exact_corr(x, y):
    rows = [(Fraction(a), Fraction(b)) for a, b in zip(x, y) if a is not None and b is not None]
    n = len(rows)
    mx, my = sum(a for a, _ in rows) / n, sum(b for _, b in rows) / n
    sxy = sum((a - mx) * (b - my) for a, b in rows)
    sxx, syy = sum((a - mx) ** 2 for a, _ in rows), sum((b - my) ** 2 for _, b in rows)
    return float(sxy) / (float(sxx) ** 0.5 * float(syy) ** 0.5)


@pytest.mark.parametrize("parts", [1, 7, 23])
def test_large_values_and_missing_ones_in_any_number_of_tasks(spark, parts):
    g = np.random.default_rng(parts)
    x = (1e9 + g.normal(size=900)).tolist()
    y = [None if i % 11 == 0 else a * 0.5 + b for i, (a, b) in enumerate(zip(x, g.normal(size=900).tolist()))]
    z = [float("nan") if i < 300 else -1e6 + b for i, b in enumerate(g.normal(size=900).tolist())]
    df = spark.createDataFrame(list(zip(x, y, z)), "x double, y double, z double").repartition(parts)
    got = {(r.feature1, r.feature2): r.statistic for r in cl.corr_pairs_blocks(df, ["x", "y", "z"]).collect()}
    z = [None if v != v else v for v in z]
    assert got[("x", "y")] == pytest.approx(exact_corr(x, y), abs=1e-13)
    assert got[("x", "z")] == pytest.approx(exact_corr(x, z), abs=1e-13)
    assert got[("y", "z")] == pytest.approx(exact_corr(y, z), abs=1e-13)


def test_more_columns_than_a_tile(spark):
    g = np.random.default_rng(2)
    m = g.normal(size=(120, 70)) + g.normal(size=(120, 1))
    cols = [f"f{i}" for i in range(70)]
    df = spark.createDataFrame(m.tolist(), ", ".join(f"{c} double" for c in cols)).repartition(5)
    got = {(r.feature1, r.feature2): r.statistic for r in cl.corr_pairs_blocks(df, cols).collect()}
    assert len(got) == 70 * 69 // 2
    want = np.corrcoef(m.T)
    assert all(abs(v - want[cols.index(a), cols.index(b)]) < 1e-12 for (a, b), v in got.items())


def test_pairs_that_never_meet_constant_columns_and_no_rows(spark):
    df = spark.createDataFrame([(1.0, None, 0.1, 5.0), (2.0, None, 0.1, 4.0), (None, 3.0, 0.1, 1.0), (None, 4.0, 0.1, 9.0)],
                               "a double, b double, c double, d double").repartition(4)
    got = {(r.feature1, r.feature2): r.statistic for r in cl.corr_pairs_blocks(df, list("abcd")).collect()}
    assert ("a", "b") not in got and got[("a", "c")] is None and got[("a", "d")] == pytest.approx(-1)
    assert cl.corr_pairs_blocks(df.limit(0), ["a", "b"]).count() == 0 and cl.corr_pairs_blocks(df, ["a"]).count() == 0


def test_merge_tree_folds_every_part_once_in_order(spark):
    def rows(batches):
        for b in batches:
            for v in b["id"].to_pylist():
                yield packed({v % 3: np.array([1.0, v])})

    parts = spark.range(0, 90, 1, 18).mapInArrow(rows, SCHEMA)
    out = {r.tile: np.frombuffer(r.data) for r in merge_tree(parts, lambda a, b: a + b, fan=4).collect()}
    assert {t: a.tolist() for t, a in out.items()} == {t: [30.0, float(sum(range(t, 90, 3)))] for t in range(3)}

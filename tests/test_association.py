"""Association of mixed columns: against counts in memory, level rule, missing values, constants, no rows."""

import math
import random
from collections import Counter

import pytest

from churnkit.operators import association as ac

SCHEMA = "a string, b string, x double, d date, n int"


def brute(p):
    """Mutual information, its share of the smaller entropy, Cramer's V of pairs of values."""
    n, ca, cb, cab = len(p), Counter(a for a, _ in p), Counter(b for _, b in p), Counter(p)
    h = lambda c: -sum(v / n * math.log(v / n) for v in c.values())
    info = h(ca) + h(cb) - h(cab)
    chi2 = sum((cab[a, b] - ca[a] * cb[b] / n) ** 2 / (ca[a] * cb[b] / n) for a in ca for b in cb)
    return info, info / min(h(ca), h(cb)), math.sqrt(chi2 / n / (min(len(ca), len(cb)) - 1))


def test_counts_levels_and_missing_values(spark):
    import datetime as dt
    r = random.Random(4)
    rows = []
    for i in range(3000):
        a = r.choice("pqrs") if r.random() < 0.9 else (f"rare{i}" if r.random() < 0.7 else None)
        b = {"p": "u", "q": "v"}.get(a, r.choice("uvw"))
        x = r.choice([float("nan"), None, ord(a[0]) + r.random() * 3 if a else 1.0])
        rows.append((a, b, x, dt.date(2020, 1 + r.randrange(2), 1), i % 4))
    df = spark.createDataFrame(rows, SCHEMA).repartition(9)
    got = {(g.feature1, g.feature2): g for g in ac.association_pairs(df, list("abxdn"), bins=4, min_share=0.05).collect()}
    assert len(got) == 10
    level = lambda a: a if len(a) == 1 else "rare"
    xs = sorted(t[2] for t in rows if t[2] is not None and t[2] == t[2])

    def q(f):
        h = (len(xs) - 1) * f
        return xs[int(h)] + (h - int(h)) * (xs[min(int(h) + 1, len(xs) - 1)] - xs[int(h)])

    edges = [q(k / 4) for k in (1, 2, 3)]
    place = lambda x: sum(x >= e for e in edges)
    there = lambda x: x is not None and x == x
    for pair, data in {("a", "b"): [(level(t[0]), t[1]) for t in rows if t[0] is not None],
                       ("a", "x"): [(level(t[0]), place(t[2])) for t in rows if t[0] is not None and there(t[2])],
                       ("d", "n"): [(t[3], sum(t[4] >= e for e in (0.75, 1.5, 2.25))) for t in rows]}.items():
        want = brute(data)
        g = got[pair]
        assert g.n == len(data)
        assert (g.mutual_information, g.statistic, g.cramers_v) == pytest.approx(want, abs=1e-9)


def test_determined_independent_and_constant_columns(spark):
    rows = [("p" if i % 2 else "q", "u" if i % 2 else "v", float(i // 2 % 2), None, 7) for i in range(400)]
    got = {(g.feature1, g.feature2): g for g in ac.association_pairs(spark.createDataFrame(rows, SCHEMA), list("abxdn")).collect()}
    assert got["a", "b"].statistic == pytest.approx(1) and got["a", "b"].cramers_v == pytest.approx(1)
    assert got["a", "x"].statistic == pytest.approx(0, abs=1e-12) and got["a", "n"].statistic is None
    assert got["a", "d"].n == 0 and got["a", "d"].mutual_information is None


def test_more_distinct_values_than_any_table_holds(spark):
    df = spark.range(20000).selectExpr("concat('id', id) AS a", "CAST(id % 3 AS STRING) AS b")
    assert ac.frequent_values(df, ["a", "b"], 0.01) == {"a": [], "b": ["0", "1", "2"]}
    one = ac.association_pairs(df, ["a", "b"]).first()
    assert one.n == 20000 and one.statistic is None  # all of a's values are rare: one level


def test_no_rows_and_one_column(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert ac.association_pairs(df, list("abx")).count() == 0
    assert ac.association_pairs(df, ["a"]).count() == 0


def test_places_of_values_in_batches():
    import pyarrow as pa
    nan = float("nan")
    got = ac.bin_places(pa.array([None, nan, -1.0, -0.0, 0.0, 0.5, 2.0, 9.0]), [0.0, 2.0])
    assert list(got) == [0, 0, 1, 2, 2, 2, 3, 3]
    assert list(ac.bin_places(pa.array([None, 4.0], pa.float64()), [])) == [0, 1]
    assert list(ac.level_places(pa.array(["b", None, "rare", "a", ""], pa.string()), ["a", "b"])) == [3, 0, 1, 2, 1]
    assert list(ac.level_places(pa.array([None, "x"], pa.string()), [])) == [0, 1]

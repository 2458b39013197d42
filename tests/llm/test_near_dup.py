"""Near-duplicates of documents and vectors, and components, against brute force."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnkit.llm import common, embedding_dup, lsh_forest, near_dup
from churnkit.llm.common import Scratch, WordHasher, chunks, components, shingle_hashes


def groups(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, n):
    fold = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in "".join(" " if c in "\t\n\r\x0b\x0c" else c for c in fold).split(" ") if x]
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def brute(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return groups(sets, links), {i: len(s) for i, s in sets.items()}


def edited(rnd, words, text, k):
    w = text.split(" ")
    for _ in range(k):
        w[rnd.randrange(len(w))] = words(1)
    return " ".join(w)


@pytest.mark.parametrize("n", [4, 5])
def test_documents_match_brute_force(spark, rnd, words, n):
    rows = [(i, words(rnd.randint(1, 90))) for i in range(60)]
    for base in range(20):  # copies at all distances around the bound
        text = words(rnd.randint(30, 200))
        rows += [(len(rows) + k, edited(rnd, words, text, rnd.randint(0, max(1, len(text.split()) // 25)))) for k in range(6)]
    hot = words(120)
    rows += [(len(rows) + k, edited(rnd, words, hot, k % 5)) for k in range(150)]  # a third of all rows
    rows += [(len(rows) + k, words(30).upper()) for k in range(2)] + [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "one"), (1004, "ONE")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, component_id string, sig int")
    got = near_dup.near_duplicates(df, shingle=n).collect()
    component, size = brute(rows, n, 80)
    assert {r.doc_id: r.component_id for r in got} == component
    assert {r.doc_id: r.n_shingles for r in got} == size
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_documents_null_repeated_empty_and_very_long(spark, words, empty):
    schema = "doc_id long, text string"
    assert near_dup.near_duplicates(empty(schema)).count() == 0
    long_text = words(60) + " " + "word " * 300_000
    rows = [(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (3, "A b\tc  d E"), (7, None), (8, long_text), (9, long_text + "end")]
    got = sorted(near_dup.near_duplicates(spark.createDataFrame(rows, schema)).collect(), key=lambda r: (r.doc_id or 0))
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == [
        (None, None, True), (3, 3, True), (5, 3, False), (5, 3, False), (7, 7, True), (8, 8, True), (9, 8, False)]


def test_region_scan_finds_what_all_pairs_find(rnd):
    rng = np.random.default_rng(1)
    n = 700
    levels = np.sort(rng.integers(0, 3, (n, 1)), 0) * np.ones((1, 6), int)  # three regions far above a block
    sketch = rng.integers(0, 256, (n, 48), dtype=np.uint8)
    family = rng.integers(0, 25, n)
    sketch[:] = rng.integers(0, 256, (25, 48), dtype=np.uint8)[family]
    parts = list(lsh_forest.scan(iter([(np.zeros(n, int), levels, np.arange(n), sketch)]), 3, 64, 120, 180, 256))
    links = [(int(a), int(b)) for x, y, _, _ in parts for a, b in zip(x, y, strict=True)]
    assert all(family[a] == family[b] for a, b in links)
    assert len(links) < n * 16
    found = groups(range(n), links)
    in_block = [(a, a + 1) for a in range(n - 1) if levels[a, 0] == levels[a + 1, 0] and family[a] == family[a + 1]]
    assert all(found[a] == found[b] for a, b in in_block)


def from_template(words, template, tail):
    """A text of a template and words of its own; of two such, a longer common start of the tails adds a shingle a word."""
    return f"{template} {tail} {words(10 - len(tail.split()))}".replace("  ", " ")


def test_pairs_far_apart_in_a_long_region(spark, rnd, words):
    template = " ".join(f"t{k}" for k in range(63))  # 60 common shingles and 10 of its own: 60 / 80
    rows = [(i, from_template(words, template, f"own{i} more{i} three{i}")) for i in range(1400)]
    rows += [(10_000 + k, from_template(words, template, f"own{i} more{i} three{i}")) for k, i in enumerate(range(0, 1400, 20))]  # 63 / 77
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {i: i for i in range(1400)} | {10_000 + k: i for k, i in enumerate(range(0, 1400, 20))}
    assert {r.doc_id: r.component_id for r in got} == want


def test_a_false_certain_pair_hides_no_true_one(spark, words):
    template = " ".join(f"t{k}" for k in range(63))
    rows = [(0, from_template(words, template, "x y z")), (1, from_template(words, template, "")), (2, from_template(words, template, "x y z"))]
    # 0-1 and 1-2 seem certain, so the scan drops 0-2, the only true pair
    sketch = np.zeros((3, 192), np.uint8)
    sketch[0, :10] = sketch[2, 10:20] = 255
    a, b, _, first = lsh_forest.link_pairs(sketch, 613, 700)
    assert sorted(map(sorted, zip(a.tolist(), b.tolist(), strict=True))) == [[0, 1], [1, 2]] and first.all()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    reps = near_dup.signatures(docs, 4, "doc_id", "text").select(F.col("doc_id").alias("id"), "sig")
    pairs = spark.createDataFrame([(0, 1, 728, True), (1, 2, 728, True)], "a long, b long, same int, first boolean")
    places = near_dup.placed(reps)
    label = spark.createDataFrame([], "v long, component_id long")

    def found(links):
        again = near_dup.doubtful_regions(pairs, spark.createDataFrame(links, "a long, b long"), reps, 700)
        return again.count(), [tuple(r) for r in near_dup.settled(again, places, reps, docs, label, Scratch(spark), 600, 4, 80).collect()]

    assert found([])[1] in ([(0, 2)], [(2, 0)])
    assert found([(0, 1), (1, 2)]) == (0, [])


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(300)]
    hub = [(1000, 1000 + i) for i in range(1, 400)]
    edges = spark.createDataFrame(chain + hub + [(5000, 5000)], "a long, b long")
    got = {r.v: r.component_id for r in components(edges, Scratch(spark)).collect()}
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(400)}


def test_word_hashes_follow_words_alone():
    h = WordHasher()
    texts = [b"The  cat\tsat", b"", b" the", b"cat sat THE \n"]
    w, bound = h(texts)
    per = [w[bound[i] : bound[i + 1]].tolist() for i in range(4)]
    assert [len(x) for x in per] == [3, 0, 1, 3]
    assert per[0] == [per[3][2], per[3][0], per[3][1]] and per[2] == [per[0][0]]
    assert len({*per[0]}) == 3
    assert list(chunks([b"x" * 10] * 5, 25)) == [(0, 2), (2, 4), (4, 5)]
    assert len(shingle_hashes(w[:3], 4)) == 1 and len(shingle_hashes(w[:0], 4)) == 0


def brute_vectors(rows, bound):
    unit = {}
    for i, v in rows:
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            a = np.asarray(v, float)
            unit.setdefault(i, a / np.linalg.norm(a))
    links = [(a, b) for a, b in itertools.combinations(unit, 2)
             if len(unit[a]) == len(unit[b]) and float(unit[a] @ unit[b]) >= bound]
    count = {i: 0 for i, _ in rows}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return groups([i for i, _ in rows], links), count


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [[float(x) for x in rng.normal(size=24)] for _ in range(300)]
    for base in rng.normal(size=(20, 24)):
        rows += [[float(x) for x in base + rng.normal(size=24) * s] for s in rng.uniform(0.01, 0.3, 8)]
    hot = rng.normal(size=24)
    rows += [[float(x) for x in hot + rng.normal(size=24) * 0.05] for _ in range(600)]  # more than a tile
    rows += [[float(x) for x in hot]] * 40
    rows += [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0]]
    rows = [(i, [None if x is None else float(np.float32(x)) for x in v] if v is not None else None) for i, v in enumerate(rows)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rows int, component int")
    got = embedding_dup.near_vectors(df).collect()
    component, count = brute_vectors(rows, 0.95)
    assert {r.vec_id: r.n_links for r in got} == count
    assert {r.vec_id: r.component_id for r in got} == component
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_vectors_empty_null_id_and_repeated(spark, empty):
    schema = "vec_id long, embedding array<float>"
    assert embedding_dup.near_vectors(empty(schema)).count() == 0
    rows = [(4, [1.0, 0.0]), (4, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [1.0, 0.01]), (9, [0.0, 1.0])]
    got = sorted(embedding_dup.near_vectors(spark.createDataFrame(rows, schema)).collect(), key=lambda r: r.vec_id or 0)
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in got] == [
        (None, 0, None, True), (2, 2, 2, True), (4, 2, 2, False), (4, 2, 2, False), (9, 0, 9, True)]


def test_rows_of_is_a_semi_join(spark, monkeypatch):
    big = spark.range(5000).selectExpr("id % 2500 - 40 AS doc_id", "CAST(id AS STRING) AS text").unionByName(
        spark.createDataFrame([(None, "x")], "doc_id long, text string"))
    keys = spark.createDataFrame([(7,), (7,), (-3,), (2100,), (10**12,), (None,)], "doc_id long")
    expect = sorted((r.doc_id, r.text) for r in big.collect() if r.doc_id in (7, -3, 2100))
    for words in (common.FILTER_WORDS, 1):  # one word lets almost all through: the exact join decides
        monkeypatch.setattr(common, "FILTER_WORDS", words)
        assert sorted((r.doc_id, r.text) for r in common.rows_of(big, keys, "doc_id").collect()) == expect
    assert common.rows_of(big, keys.limit(0), "doc_id").count() == 0
    plan = common.rows_of(big, keys, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin")  # the filter comes before the shuffle


def test_verified_shuffles_the_texts_of_its_own_pairs_only(spark, words):
    rows = [(i, words(30)) for i in range(50)]
    texts = spark.createDataFrame([*rows, (50, rows[7][1]), (51, rows[7][1] + " x")], "doc_id long, text string")
    pairs = spark.createDataFrame([(7, 50), (50, 51), (1, 2)], "a long, b long")
    links = near_dup.verified(pairs, texts, 4, 80)
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bit_or") == 2  # a filter of the ends before the shuffle of each side
    assert sorted((r.a, r.b) for r in links.collect()) == [(7, 50), (50, 51)]
    kept = common.near_rows(texts, pairs.select(F.col("a").alias("doc_id")), "doc_id")
    assert {1, 7, 50} <= {r.doc_id for r in kept.collect()} and kept.count() < 10

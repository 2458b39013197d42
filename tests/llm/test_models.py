"""Language, quality and LM scoring: held-out accuracy, definitions, and awkward inputs."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from churnkit.llm import language, language_model, quality
from tests.conftest import SF01


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet")


def fold(i, m):
    return zlib.crc32(str(i).encode()) % m


def test_language_of_held_out_documents(spark, docs):
    got = {r.doc_id: r for r in language.identify_documents(docs).collect()}
    held = [(r.lang, got[r.doc_id]) for r in docs.collect() if fold(r.doc_id, 5) == 0 and r.lang]
    assert all(r.held_out for _, r in held) and sum(r.held_out for r in got.values()) == len(held)
    assert sum(lang == r.lang_pred for lang, r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_of_awkward_texts(spark, docs, empty):
    model = language.fit(docs)
    odd = [(1, None), (2, ""), (3, " 12 !! \n"), (4, "the"), (4, "the"), (None, "der die das und ist nicht"), (6, "los de la " * 300_000)]
    df = spark.createDataFrame([(i, t, "zz", 0.5) for i, t in odd], "doc_id long, text string, lang_pred string, _score double")
    got = language.identify(df, model).collect()
    assert [(r.doc_id, r.lang_pred) for r in got][:3] == [(1, "und"), (2, "und"), (3, "und")]
    assert all(r.lang_score == 0 for r in got[:3]) and got[3].lang_pred in model.labels and got[3] == got[4]
    assert got[6].lang_pred == "es"
    schema = "doc_id long, text string, lang string"
    assert language.identify_documents(empty(schema)).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None)], schema)
    assert [r.lang_pred for r in language.identify_documents(unlabelled).collect()] == ["und"]


def test_language_tables_compute_the_convolutions(docs):
    rng = np.random.default_rng(0)
    model = language.train([bytes(rng.integers(97, 123, 60).tolist()) for _ in range(40)], ["a", "b"] * 20, steps=5)
    text = bytes(rng.integers(97, 123, 300).tolist())
    buf = np.full((3, model.window), language.PAD, np.int16)
    for k in range(3):
        part = np.frombuffer(text[k * model.window : (k + 1) * model.window], np.uint8)
        buf[k, : len(part)] = part
    feats = []
    for w in language.WIDTHS:
        act = np.stack([sum(model.embed[buf[:, p + k]] @ model.filters[w][k] for k in range(w)) for p in range(model.window - w + 1)], 1)
        feats.append(act.max(1) + model.bias[w])
    z = np.maximum(np.concatenate(feats, 1), 0) @ model.dense + model.dense_bias
    want = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    assert np.allclose(language.window_scores(model, model.tables(), buf), want, atol=1e-4)
    weight = [model.window, model.window, 300 - 2 * model.window]
    assert np.allclose(language.score_texts(model, model.tables(), [text])[0], np.average(want, axis=0, weights=weight), atol=1e-4)


def test_quality_of_held_out_documents(spark, docs):
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    held = [(r.quality, got[r.doc_id]) for r in labels.collect() if fold(r.doc_id, 4) == 2 and r.quality is not None]
    assert all(r.held_out for _, r in held)
    assert sum(q == r.predicted for q, r in held) >= 0.95 * len(held)
    assert all(r.predicted == (r.score >= 0.7) for r in got.values())


def test_quality_learns_nothing_from_held_out_labels(spark, docs):
    labels = spark.read.parquet(f"{SF01}/labels.parquet").collect()
    flipped = [(r.doc_id, 1 - r.quality if fold(r.doc_id, 4) == 2 else r.quality) for r in labels]
    schema = "doc_id long, quality int"
    a = quality.classify(docs, spark.createDataFrame([(r.doc_id, r.quality) for r in labels], schema)).collect()
    b = quality.classify(docs, spark.createDataFrame(flipped, schema)).collect()
    assert sorted(a) == sorted(b)


def test_quality_of_awkward_texts(spark, empty):
    schema = "doc_id long, text string, score string"
    odd = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (None, "x", "s"), (3, "a b " * 400_000, "s")], schema)
    labels = spark.createDataFrame([(3, 1), (3, 1), (None, 0), (1, None), (2, 7)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality.classify(odd, labels).collect()}
    assert got[1] == got[2] == 0.5 and all(0 <= x <= 1 for x in got.values())
    none = quality.classify(odd, empty("doc_id long, quality int")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.classify(empty(schema), labels).count() == 0


def tokens(text):
    fold_ = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\r\x0b\x0c":
        fold_ = fold_.replace(c, " ")
    return [x for x in fold_.split(" ") if x] + ["\0end"]


def test_scores_and_base_counts(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(10**6, None), (10**6 + 1, ""), (None, "the The\tthe")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, block int")
    got = {r.doc_id: r for r in language_model.score(df).collect()}
    assert len(got) == len(rows)
    learnt = Counter(w for i, t in rows if i is not None and fold(i, 10) for w in tokens(t))
    n, v = sum(learnt.values()), len(learnt)
    for i, t in rows:
        r, w = got[i], tokens(t)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(learnt[x] > 0 for x in w), n)
        assert r.held_out == (i is not None and fold(i, 10) == 0)
        assert r.base_score == pytest.approx(sum(math.log10((learnt[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_of_a_context_sum_to_one():
    rng = np.random.default_rng(5)
    vocabulary = 300
    words = np.sort(rng.integers(1, 1 << 62, vocabulary).astype(np.uint64))
    import pyarrow as pa

    cells, size = [], []
    for _ in words:
        codes = np.sort(rng.choice(language_model.N_LEAVES, rng.integers(1, 9), replace=False))
        data = np.empty(len(codes), language_model.WIDE_CELL)
        data["code"], data["n"] = codes, rng.geometric(0.02, len(codes))
        cells.append(data)
        size.append(len(data))
    batch = pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), language_model._ragged(np.concatenate(cells), np.array(size))],
                                       ["word", "cells"])
    model = language_model.Seating((0.6, 0.6, 0.6), 1.0, vocabulary)
    c = language_model.cells_of(batch)

    def totals(state):
        leaf, up, mid, top, root = state
        count = lambda code, x, n: np.bincount(code, weights=x, minlength=n)
        return language_model.Totals(
            (count(c.code, c.customers, language_model.N_LEAVES), count(c.parent_code, up, language_model.PARENTS), float(top.sum())),
            (count(c.code, leaf, language_model.N_LEAVES), count(c.parent_code, mid, language_model.PARENTS), float(root.sum())))

    seen = []
    for s in range(4):
        state = list(language_model.sweeps(c, model, seen))[-1]
        leaf, up, mid, top, root = state
        assert ((leaf >= 1) & (leaf <= c.customers)).all() and ((mid >= 1) & (mid <= up)).all() and ((root >= 1) & (root <= top)).all()
        seen.append(totals(state))
    t, (d2, d1, d0), theta = seen[-1], model.discount, model.concentration
    root_gap = (theta + d0 * t.tables[2]) / (theta + t.customers[2])
    p_root = np.append((top - d0 * root) / (theta + t.customers[2]), 0) + root_gap * model.base  # the last is the unknown word
    assert p_root.sum() == pytest.approx(1)
    leaf_gap, parent_gap = language_model.back_off(model, [t], -1)
    for u in range(language_model.N_LEAVES):
        g = u % language_model.PARENTS
        p_mid, p = np.zeros(vocabulary + 1), np.zeros(vocabulary + 1)
        own = c.parent_code == g
        p_mid[c.parent_row[own]] = (up - d1 * mid)[own] / (theta + t.customers[1][g])
        own = c.code == u
        p[c.row[own]] = (c.customers - d2 * leaf)[own] / (theta + t.customers[0][u])
        assert (p + leaf_gap[u] * (p_mid + parent_gap[g] * p_root)).sum() == pytest.approx(1)


def test_score_is_the_same_in_any_blocks(spark, docs):
    one = language_model.score(docs, block_bytes=1 << 30).collect()
    many = language_model.score(docs, block_bytes=200_000).collect()
    a, b = ({r.doc_id: r.score for r in x} for x in (one, many))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], rel=1e-5) for k in a)


def test_scores_of_little_or_nothing(spark, empty):
    schema = "doc_id long, text string"
    assert language_model.score(empty(schema)).count() == 0
    only = next(i for i in range(100) if fold(i, 10) == 0)
    got = language_model.score(spark.createDataFrame([(only, "a b"), (only, "a b")], schema)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in got] == [(3, 0, 0)] * 2
    assert got[0].score == pytest.approx(0) and got[0].base_score == pytest.approx(0)


def test_the_word_before_tells_the_next(spark, rnd):
    after = rnd.sample(range(400), 400)  # the only word that follows each word

    def text():
        w = [rnd.randrange(400)]
        for _ in range(60):
            w.append(after[w[-1]])
        return " ".join(f"w{x}" for x in w)

    got = language_model.score(spark.createDataFrame([(i, text()) for i in range(600)], "doc_id long, text string")).collect()
    held = [r for r in got if r.held_out]
    each, base = (sum(x) / sum(r.n_tokens for r in held) for x in ([r.score for r in held], [r.base_score for r in held]))
    assert each > -1.1 and base < -2.4  # of 400 words, fewer than 13 come in question


def test_words_of_one_class_have_restaurants_of_their_own(spark, rnd):
    follower = rnd.sample(range(390), 390)  # six words or so in each class, and each of them tells the next for certain

    def text():
        w = [rnd.randrange(390)]
        for _ in range(60):
            w.append(follower[w[-1]])
        return " ".join(f"v{x}" for x in w)

    got = language_model.score(spark.createDataFrame([(i, text()) for i in range(600)], "doc_id long, text string")).collect()
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) / sum(r.n_tokens for r in held) > -0.35

"""Personal data: patterns against the contract's own, the field against enumeration, held-out sentences, odd rows."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from churnkit.llm import personal_data as P

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    def ok(kind, s):
        n = re.sub("[^0-9]", "", s)
        return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in s.split(".")),
                "card": lambda: 16 <= len(n) <= 19 and P.luhn(n), "phone": lambda: 8 <= len(n) <= 15}[kind]()

    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text) if ok(k, m.group())]


@pytest.fixture(scope="module")
def field():
    rows = P.sentences(1000, 17)
    return P.fit_field([t for t, _ in rows], [s for _, s in rows], rounds=80)


def test_patterns_equal_the_plain_ones():
    r = random.Random(3)
    pieces = ["a", "b.c", "@", ".", "1", "25", "256", "0300", "+", "+1", " ", "-", "_", "%", "(", ")", "4111111111111111", "é", "\n", "x-y", "9.8"]
    for _ in range(20000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(0, 14)))
        assert P.base_spans(text) == plain_spans(text), text
    assert P.luhn("4111111111111111") and not P.luhn("4111111111111112")


def test_long_runs_take_linear_time():
    for piece in ("1", "a", "1.", "a.", "+1", "1-", "a@", "+ "):
        P.base_spans(piece * 200_000 + "@")


def tiny(r, n):
    f = P.Field(r.normal(size=(5, P.SHAPES, P.LABELS)).astype(np.float32) * 2, np.zeros((5, 0, P.LABELS), np.float32), np.zeros(0, np.uint64),
                r.normal(size=(P.LABELS, P.LABELS)).astype(np.float32))
    t = P.Tokens(np.arange(n), np.arange(n) + 1, r.integers(0, P.SHAPES - 1, n), np.zeros(n, np.uint64))
    return f, t


def path_score(scores, moves, path):
    full = [0, *path, 0]
    return sum(scores[i, y] for i, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(full, full[1:]))


def test_viterbi_is_the_best_path_of_all():
    r = np.random.default_rng(1)
    for n in (1, 2, 3, 4):
        f, t = tiny(r, n)
        scores = f.scores(t)
        got = P.viterbi(scores, f.moves, np.array([0]), np.array([n]))
        best = max(path_score(scores, f.moves, p) for p in itertools.product(range(P.LABELS), repeat=n))
        assert abs(path_score(scores, f.moves, got.tolist()) - best) < 1e-3


def test_cutting_at_certain_and_calm_tokens_changes_nothing(field):
    rows = P.sentences(400, 5)
    t, _, _ = P.join_texts([" ".join(x for x, _ in rows[i : i + 20]).encode() for i in range(0, 400, 20)])
    scores = field.scores(t)
    label, excess = P.decode(field, t)
    inner = np.concatenate(([0], (t.shape != P.EDGE).astype(np.int8), [0]))
    turn = np.flatnonzero(inner[1:] != inner[:-1])
    whole = P.viterbi(scores, field.moves, turn[0::2], turn[1::2] - turn[0::2])
    assert (label == whole).all() and (label > 0).sum() > 300
    calm = field.calm(excess)
    assert calm.any() and (whole[calm] == 0).all() and field.certain(excess).mean() > 0.2


def test_long_texts_in_pieces_equal_whole_ones(field, words):
    r = random.Random(2)
    rows = P.sentences(300, 8)
    text = "\n".join(x + " " + words(r.randint(0, 60)) for x, _ in rows).encode() + " é".encode() * 500
    whole = P.byte_spans(field, [text])[0]
    assert len(whole) > 80
    for limit in (700, 3000, 1 << 20):
        assert P.long_spans(field, text, limit) == whole


def test_gradient_fits_and_held_out_sentences_are_found(field):
    right = wrong = missed = 0
    for text, spans in P.sentences(600, 99):
        raw = text.encode()
        got = {(P.KINDS[k], len(raw[:a].decode()), len(raw[:b].decode())) for k, a, b in P.byte_spans(field, [raw])[0]}
        right, wrong, missed = right + len(got & set(spans)), wrong + len(got - set(spans)), missed + len(set(spans) - got)
    assert right / (right + wrong) > 0.9 and right / (right + missed) > 0.9


def run(spark, field, rows, **kw):
    df = spark.createDataFrame([(i, t, "z", "q") for i, t in rows], "doc_id bigint, text string, spans string, n_email string")
    return P.find(df, field, **kw).collect()


def test_documents_odd_rows_and_added_spans(spark, field, words):
    long = words(3000) + " call (555) 123-4567 now " + words(3000) + " x@y.example.com"
    rows = [(1, None), (2, ""), (3, "mail bob at example dot com today é"), (3, "ü a@b.co 10.0.0.1"), (3, "ü a@b.co 10.0.0.1"), (None, "phone (555) 123-4567"),
            (4, long), (5, words(200)), (6, "visa 4111 1111 1111 1111, pin 4111111111111112")]
    out = run(spark, field, rows, chunk_bytes=4000)
    assert [r.doc_id for r in out] == [i for i, _ in rows]
    for r, (_, text) in zip(out, rows):
        base = plain_spans(text or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in P.KINDS]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(base, key=lambda s: (P.KINDS.index(s[0]), s[1])))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
    assert out[0].spans == out[1].spans == out[7].spans == ""
    assert out[2].spans == "email:5:27" and out[5].spans == "phone:6:20"
    assert f"phone:{long.index('(555)')}:{long.index('(555)') + 14}" in out[6].spans.split(",")
    assert out[8].spans.split(",")[0] == "card:5:24"
    assert P.find(spark.createDataFrame([], "doc_id bigint, text string"), field).count() == 0


def test_every_document_of_the_table_by_the_plain_patterns(spark, field):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    out = {r.doc_id: r for r in P.find(docs, field).collect()}
    for r in docs.collect():
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in plain_spans(r.text or ""))
        assert out[r.doc_id].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()


def test_field_of_a_labelled_table(spark):
    table = P.labelled_table(spark, 60, 3)
    f = P.fit(table.unionByName(spark.createDataFrame([(None, None), ("", [])], table.schema)), limit=40)
    assert f.shapes.shape == (5, P.SHAPES, P.LABELS)

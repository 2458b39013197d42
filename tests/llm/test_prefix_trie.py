"""The prefix trie against rebuilt conversations in memory: heads, odd rows, one long conversation, colliding keys."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from churnkit.llm import prefix_trie as T

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, n_convs int"


def brute(rows):
    def tie(role, text):
        return hashlib.sha256(f"0:{len(role.encode())}:{role}{text}".encode()).hexdigest()

    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v, key=lambda x: (x[0], tie(x[1], x[2])))] for c, v in convs.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + turns[h:]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids, leaves, saved = {}, {}, {}
    for p in nodes:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = leaves.get(p, 0) or 1
        saved[p] = saved.get(p, 0) + (len(nodes[p]) - 1) * (len(re.findall("[^\x20\x09-\x0D]+", p[-1][1])) if p else 0)
        if p:
            leaves[p[:-1]] = leaves.get(p[:-1], 0) + leaves[p]
            saved[p[:-1]] = saved.get(p[:-1], 0) + saved[p]
    return sorted((min(m), len(p), -1 if not p else min(nodes[p[:-1]]), len(m), kids.get(p, 0), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)).encode()).hexdigest())
                  for p, m in nodes.items())


def run(spark, rows):
    out = T.trie(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect()
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                   r.saved_tokens, r.ends_sha256) for r in out)


def test_arithmetic_is_exact():
    r = random.Random(1)
    a = [r.randrange(T.P) for _ in range(500)] + [T.P - 1, 0, T.P - 1]
    b = [r.randrange(T.P) for _ in range(500)] + [T.P - 1, T.P - 1, 1]
    assert T.mulmod(np.array(a, np.uint64), np.array(b, np.uint64)).tolist() == [x * y % T.P for x, y in zip(a, b)]
    assert T.running(np.array(a, np.uint64)).tolist() == [sum(a[: i + 1]) % T.P for i in range(len(a))]
    assert T.Powers(7)(np.array([0, 1, 9, 5 << 20])).tolist() == [pow(7, e, T.P) for e in (0, 1, 9, 5 << 20)]


def test_shared_heads_and_copies(spark, rnd, words):
    texts = [words(rnd.randint(0, 6)) for _ in range(12)]
    rows = [(c, t, rnd.choice(("user", "assistant")), rnd.choice(texts))
            for c in [*range(0, 90), 131, 145, -3, -20, -25] for t in range(rnd.randint(1, 9))]
    rows = [r for r in rows if r[0] not in (40, 41)]  # a base that is absent
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(0, None, None, None), (0, 0, "a", "x y"), (0, 0, "a", "x y"), (0, 0, "b", ""), (None, 1, "a", "t"), (1, 5, "", "a b\tc"),
            (7, 1, "ab", "c"), (8, 1, "a", "bc"), (9, 3, "a", None), (9, -1, None, "é" * 50_000), (20, 1, "u", "q"), (21, 1, "u", "q"),
            (22, 1, "u", "q"), (23, 1, "u", "q")]
    assert run(spark, rows) == brute(rows)


def test_one_conversation_of_most_rows_crosses_ranges(spark, rnd):
    rows = [(5, t // 2, "u", f"w{t % 3} z") for t in range(700)] + [(25, 1, "u", "same") for _ in range(300)]
    rows += [(c, t, "u", "hi there") for c in range(60, 120) for t in range(6)]
    assert run(spark, rows) == brute(rows)


def test_equal_keys_of_different_turns_are_found_and_mended(spark, monkeypatch):
    rows = [(c, t, "u", f"text {c % 3} {t}") for c in range(12) for t in range(5)]
    tried, real = [], T.turn_rows

    def colliding(df, seed):
        tried.append(seed)
        out = real(df, seed)
        return out.selectExpr("conv_id", "turn", "0L t1", "0L t2", "words", "role", "text") if seed == 0 else out

    monkeypatch.setattr(T, "turn_rows", colliding)
    got = run(spark, rows)
    assert tried == [0, 1] and got == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "u", "x")]])
def test_no_conversation_gives_no_node(spark, rows):
    assert run(spark, rows) == []

"""Conversation prefix trie: nodes are equal prefixes of rebuilt conversations, found by composable fingerprints.

A sequence of turns has the fingerprint ``(sum of t_i * B**i mod P, length)``
under two bases; joining two sequences is ``(x, m) . (y, n) = (x + B**m * y,
m + n)``, a monoid, in which a prefix can also be taken off again.  So every
prefix of a rebuilt conversation (a head of the base conversation, then an
own suffix) is combined from two running products of the *original*
conversations, and no rebuilt text is ever made.  A fingerprint's group
becomes a node only if all its members point to the same parent and the same
turn, and a turn's key only if all its texts are equal; otherwise everything
is done anew with other bases and keys, so the result is exact.

Defined results: null role or text is empty; rows without ``conv_id`` belong
to no conversation; turns of equal number are ordered by SHA-256 of role and
text, repeated rows are turns of their own; an empty table has no node.  A
conversation, node or turn text may hold any share of the rows: positions
and products come from ranges of the sorted rows, not from groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import Scratch

P = (1 << 61) - 1
WORD = r"[^\x20\x09-\x0D]+"
#: Conversations of a family share the head of the one whose id is divisible by this.
FAMILY = 20
#: A head has fewer turns than this.
HEADS = 4
#: Ids of a node that are joined to one piece of text before it is hashed.
PIECE = 1 << 15
NODE = ("depth", "f1", "f2")
PARENT = ("up", "g1", "g2")


# ---------------------------------------------------------------- arithmetic modulo 2**61 - 1

def mulmod(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """a * b modulo P, of values below P."""
    a, b = np.asarray(a, np.uint64), np.asarray(b, np.uint64)
    lo, s32, s29 = np.uint64(0xFFFFFFFF), np.uint64(32), np.uint64(29)
    a1, a0, b1, b0 = a >> s32, a & lo, b >> s32, b & lo
    mid = a1 * b0 + a0 * b1  # below 2**62
    low = a0 * b0
    p = np.uint64(P)
    # a1*b1 * 2**64 = a1*b1 * 8; mid * 2**32: its bits from 29 up wrap to the front
    out = (a1 * b1 * np.uint64(8)) % p + (mid >> s29) + ((mid & np.uint64((1 << 29) - 1)) << s32) % p + low % p
    return out % p


def running(terms: np.ndarray) -> np.ndarray:
    """Running sums modulo P, in two halves so that nothing overflows."""
    half = np.uint64(31)
    hi = np.cumsum(terms >> half) % np.uint64(P)
    lo = np.cumsum(terms & np.uint64((1 << 31) - 1)) % np.uint64(P)
    return (mulmod(hi, 1 << 31) + lo) % np.uint64(P)


class Powers:
    """Powers of a base, grown as needed; of any size for single exponents."""

    def __init__(self, base: int):
        self.base, self.table = base, np.ones(1, np.uint64)

    def __call__(self, exponents: np.ndarray) -> np.ndarray:
        need = int(exponents.max(initial=0)) + 1
        if need > 1 << 22:  # positions of very long conversations
            found, where = np.unique(exponents, return_inverse=True)
            return np.array([pow(self.base, int(e), P) for e in found], np.uint64)[where]
        while len(self.table) < need:
            self.table = np.concatenate((self.table, mulmod(self.table, pow(self.base, len(self.table), P))))
        return self.table[exponents]


def bases(seed: int) -> tuple[int, int]:
    return tuple(int.from_bytes(hashlib.sha256(f"base {i} {seed}".encode()).digest()[:7], "big") * 2 + 3 for i in (1, 2))


# ---------------------------------------------------------------- turns, positions and products

def turn_rows(conversations: DataFrame, seed: int) -> DataFrame:
    """``(conv_id, turn, t1, t2, words)``: every row's key (two numbers below 2**60 of a SHA-256) and word count."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    sha = F.sha2(F.concat(F.lit(f"{seed}:"), F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    part = lambda at: F.conv(F.substring("sha", at, 15), 16, 10).cast("long")
    return (conversations.where("conv_id IS NOT NULL")
            .select("conv_id", "turn", sha.alias("sha"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
                    role.alias("role"), text.alias("text"))
            .select("conv_id", "turn", part(1).alias("t1"), part(16).alias("t2"), "words", "role", "text"))


def _scan(powers: tuple[Powers, Powers]):
    """Positions and products of sorted rows, counted from the start of this range of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at, base = None, 0, [0, 0]
        for b in batches:
            if not b.num_rows:
                continue
            conv = b["conv_id"].to_numpy()
            first = np.concatenate(([last is None or conv[0] != last], conv[1:] != conv[:-1]))
            start = np.maximum.accumulate(np.where(first, np.arange(len(conv)), -1))
            inner = start < 0  # rows that go on with the conversation of the batch before
            pos = np.arange(len(conv)) - np.maximum(start, 0) + np.where(inner, at, 0)
            out = []
            for i, t in enumerate(("t1", "t2")):
                s = running(mulmod(b[t].to_numpy().astype(np.uint64), powers[i](pos)))
                before = np.where(start > 0, s[np.maximum(start, 1) - 1], np.uint64(0))
                s = (s + np.uint64(P) - before + np.where(inner, np.uint64(base[i]), np.uint64(0))) % np.uint64(P)
                base[i] = int(s[-1])
                out.append(s.astype(np.int64))
            last, at = conv[-1], int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [b["conv_id"], pa.array(pos + 1), *(pa.array(s) for s in out), b["t1"], b["t2"], b["words"]],
                names=["conv_id", "pos", "s1", "s2", "t1", "t2", "words"])

    return run


def positions(turns: DataFrame, scratch: Scratch, seed: int) -> DataFrame:
    """``(conv_id, pos, s1, s2, t1, t2, words)``: place (from 1) and running product of every turn in its conversation.

    Spark deals sorted ranges of rows; a conversation that crosses ranges is
    continued by its count and product in the ranges before, one row a range."""
    b1, b2 = bases(seed)
    order = ["conv_id", "turn", "t1", "t2", "n"]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (turns.withColumn("n", F.monotonically_increasing_id()).repartitionByRange(parts, *order)
              .sortWithinPartitions(*order).select("conv_id", "t1", "t2", "words"))
    schema = "conv_id bigint, pos bigint, s1 bigint, s2 bigint, t1 bigint, t2 bigint, words bigint"
    scanned = scratch.keep(ranged.mapInArrow(_scan((Powers(b1), Powers(b2))), schema)
                           .withColumn("part", F.spark_partition_id()), "scanned")
    last = F.struct("conv_id", "pos", "s1", "s2")
    ranges = scanned.groupBy("part").agg(F.min("conv_id").alias("lo"), F.max(last).alias("hi")).orderBy("part").collect()
    carry: dict[int, tuple[int, int, int, int]] = {}  # by range: the conversation that goes on, its turns and products so far
    open_ = None
    for r in ranges:
        conv, n, s1, s2 = r.hi.conv_id, r.hi.pos, r.hi.s1, r.hi.s2
        if open_ and open_[0] == r.lo:
            carry[r.part] = open_
            if conv == r.lo:
                _, n0, x1, x2 = open_
                n, s1, s2 = n + n0, (x1 + pow(b1, n0, P) * s1) % P, (x2 + pow(b2, n0, P) * s2) % P
        open_ = (conv, n, s1, s2)
    if not carry:
        return scanned.drop("part")

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            conv, part = b["conv_id"].to_numpy(), b["part"].to_numpy()
            cols = [b[c].to_numpy().copy() for c in ("pos", "s1", "s2")]
            for p in np.unique(part):
                if int(p) in carry:
                    c, n0, *x = carry[int(p)]
                    m = (part == p) & (conv == c)
                    cols[0][m] += n0
                    for s, base, x0 in zip(cols[1:], (b1, b2), x):
                        s[m] = (mulmod(s[m], pow(base, n0, P)) + np.uint64(x0)) % np.uint64(P)
            yield pa.RecordBatch.from_arrays([b["conv_id"], *map(pa.array, cols), b["t1"], b["t2"], b["words"]],
                                             names=["conv_id", "pos", "s1", "s2", "t1", "t2", "words"])

    out = scratch.keep(scanned.mapInArrow(go_on, schema), "positions")
    scratch.drop("scanned")
    return out


# ---------------------------------------------------------------- rebuilt conversations

def heads(turns: DataFrame) -> DataFrame:
    """One row a conversation: its turns ``n`` and the first turns ``head``: (pos, s1, s2, t1, t2, words), at most HEADS - 1."""
    first = F.when(F.col("pos") < HEADS, F.struct("pos", "s1", "s2", "t1", "t2", "words"))
    return turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n"), *[F.max(F.when(F.col("pos") == i, first)).alias(f"p{i}") for i in range(1, HEADS)]
    ).select("conv_id", "n", F.array_compact(F.array(*[f"p{i}" for i in range(1, HEADS)])).alias("head"))


def _family(conv: Column) -> Column:
    return conv - conv % FAMILY


def rebuilt(convs: DataFrame) -> DataFrame:
    """``(conv_id, h, hh, size, base)``: turns left out, turns taken from the base's head, rebuilt turns, the taken head.

    Own products before the suffix (``o1``, ``o2``) and the head's products (``x1``, ``x2``) are those the
    fingerprints of own turns are combined from."""
    base = convs.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("family"), F.col("head").alias("theirs"))
    h = F.crc32(F.col("conv_id").cast("string")) % HEADS
    mine = convs.withColumn("h", h.cast("int")).withColumn("family", _family(F.col("conv_id")))
    joined = mine.join(base, "family", "left").withColumn(
        "base", F.slice(F.coalesce("theirs", F.expr("slice(head, 1, 0)")), F.lit(1), F.col("h")))
    hh = F.size("base")
    end = lambda a, n, f: F.when(n > 0, F.get(a, n - 1)[f]).otherwise(F.lit(0))
    cut = F.least("h", F.size("head"))
    return joined.select(
        "conv_id", "h", hh.alias("hh"), (hh + F.greatest(F.lit(0), F.col("n") - F.col("h"))).cast("long").alias("size"), "base",
        *[end(F.col("base"), hh, f"s{i}").alias(f"x{i}") for i in (1, 2)],
        *[end(F.col("head"), cut, f"s{i}").alias(f"o{i}") for i in (1, 2)])


def members(turns: DataFrame, info: DataFrame, seed: int) -> DataFrame:
    """A row for every rebuilt turn: node and parent fingerprints, the turn's key and words, ``conv_id`` and ``last``.

    Turns of the base's head come from its stored products; own turns combine the head's product with their own
    product less what was left out."""
    b1, b2 = bases(seed)
    inverse = [[pow(b, -i, P) for i in range(HEADS)] for b in (b1, b2)]
    powers = (b1, b2)
    p = np.uint64(P)

    own = (turns.join(info.where("size > hh").select("conv_id", "h", "hh", "size", "x1", "x2", "o1", "o2").hint("merge"), "conv_id")
           .where("pos > h"))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [Powers(b) for b in powers]
        for b in batches:
            if not b.num_rows:
                continue
            col = {c: b[c].to_numpy() for c in ("pos", "h", "hh", "size")}
            shift = col["h"] - col["hh"]  # own suffix moves this many places to the front
            depth = col["pos"] - shift
            out = {}
            for i in (0, 1):
                s, t, x, o = (b[f"{c}{i + 1}"].to_numpy().astype(np.uint64) for c in "stxo")
                back = np.array(inverse[i], np.uint64)[shift]
                before = (s + p - mulmod(t, tables[i](col["pos"] - 1))) % p
                for name, v in ((f"f{i + 1}", s), (f"g{i + 1}", before)):
                    out[name] = pa.array(((x + mulmod((v + p - o) % p, back)) % p).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(depth), out["f1"], out["f2"], out["g1"], out["g2"], b["t1"], b["t2"], b["words"], b["conv_id"],
                 pa.array(depth == col["size"])],
                names=["depth", "f1", "f2", "g1", "g2", "t1", "t2", "words", "conv_id", "last"])

    tail = own.mapInArrow(combine, "depth bigint, f1 bigint, f2 bigint, g1 bigint, g2 bigint, t1 bigint, t2 bigint, "
                                   "words bigint, conv_id bigint, last boolean")
    e = F.col("e")
    before = lambda f: F.when(e["pos"] > 1, F.get(F.col("base"), (e["pos"] - 2).cast("int"))[f]).otherwise(F.lit(0))
    head = info.select("conv_id", "size", "base", F.explode("base").alias("e")).select(
        e["pos"].alias("depth"), e["s1"].alias("f1"), e["s2"].alias("f2"), before("s1").alias("g1"), before("s2").alias("g2"),
        e["t1"].alias("t1"), e["t2"].alias("t2"), e["words"].alias("words"), "conv_id", (e["pos"] == F.col("size")).alias("last"))
    return head.unionByName(tail)


# ---------------------------------------------------------------- nodes

def texts_differ(turns: DataFrame) -> bool:
    """Whether two different turns have one key: distinct texts meet by key; equal ones collapse before the shuffle."""
    return bool(turns.select("t1", "t2", "role", "text").distinct().groupBy("t1", "t2").count().where("count > 1").limit(1).count())


def ends(found: DataFrame) -> DataFrame:
    """``(depth, f1, f2, ends_sha256)`` of nodes at which conversations end.

    Ranges of the sorted ids become pieces of text; a node's pieces then pass one after another through the digest,
    which is sequential by its nature, one piece in memory at a time."""
    order = [*NODE, "conv_id"]
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b[c].to_numpy() for c in NODE], 1)
            ids = b["conv_id"].to_numpy()
            cut = np.concatenate(([True], (keys[1:] != keys[:-1]).any(1))) | (np.arange(len(ids)) % PIECE == 0)
            at = np.flatnonzero(cut)
            text = [",".join(map(str, ids[i:j].tolist())) for i, j in zip(at, [*at[1:], len(ids)])]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(keys[at, i]) for i in range(3)), pa.array(ids[at]), pa.array(text)], names=[*NODE, "first", "text"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for b in batches:
            out = []
            for *key, text in zip(*(b[c].to_pylist() for c in (*NODE, "text"))):
                if key != node:
                    if node:
                        out.append((*node, sha.hexdigest()))
                    node, sha = key, hashlib.sha256(text.encode())
                else:
                    sha.update(b"," + text.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=[*NODE, "ends_sha256"])
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, sha.hexdigest())], names=[*NODE, "ends_sha256"])

    schema = "depth bigint, f1 bigint, f2 bigint"
    cut = (found.repartitionByRange(parts, *order).sortWithinPartitions(*order)
           .mapInArrow(pieces, f"{schema}, first bigint, text string"))
    return (cut.repartition(*NODE).sortWithinPartitions(*NODE, "first").select(*NODE, "text")
            .mapInArrow(digest, f"{schema}, ends_sha256 string"))


def subtree_sums(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """``(conv_id, depth, n_leaves, saved_tokens)`` of nodes with several members, by ancestors at distance 1, 2, 4, ...

    A node of one member heads a path without branches: one leaf, nothing saved, so such nodes only count as a leaf
    of their parent.  After the round of distance d a node holds the sums of the next 2d levels below it."""
    own = nodes.select(
        "conv_id", "depth", F.col("parent_conv_id").alias("a"), (F.col("depth") - 1).alias("ad"),
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("singles")).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved")).where("n_convs > 1")
    state, step, done = scratch.keep(own, "sums-1"), 1, False
    while not done:
        below = state.where("a IS NOT NULL").groupBy("a", "ad").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        # an ancestor's ancestor at the same distance is this node's at twice the distance
        far = state.where("a IS NOT NULL").select(F.col("conv_id").alias("a"), F.col("depth").alias("ad"), F.col("a").alias("aa"))
        near = state.where(F.col("ad") >= step).join(far, ["a", "ad"]).select("conv_id", "depth", "leaves", "saved", "aa")
        gone = state.where(F.col("a").isNull() | (F.col("ad") < step)).select(
            "conv_id", "depth", "leaves", "saved", F.lit(None).cast("long").alias("aa"))
        nxt = near.unionByName(gone).join(below.select(F.col("a").alias("conv_id"), F.col("ad").alias("depth"), "l", "s"),
                                          ["conv_id", "depth"], "left")
        state = scratch.keep(nxt.select(
            "conv_id", "depth", F.col("aa").alias("a"), (F.col("depth") - 2 * step).alias("ad"),
            (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")), f"sums-{2 * step}")
        scratch.drop(f"sums-{step}")
        step *= 2
        done = not state.where("a IS NOT NULL").limit(1).count()
    return state.select("conv_id", "depth", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def _attempt(conversations: DataFrame, scratch: Scratch, seed: int) -> DataFrame | None:
    raw = turn_rows(conversations, seed)
    if texts_differ(raw):
        return None
    turns = positions(scratch.keep(raw.drop("role", "text"), "turns"), scratch, seed)
    scratch.drop("turns")
    info = scratch.keep(rebuilt(scratch.keep(heads(turns), "convs")), "info")
    scratch.drop("convs")
    found = scratch.keep(members(turns, info, seed), "members")
    every = info.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    bounds = [f(c).alias(f"{f.__name__}_{c}") for c in ("g1", "g2", "t1", "t2") for f in (F.min, F.max)]
    groups = scratch.keep(found.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                                                   F.max("words").alias("words"), *bounds), "groups")
    if groups.where(" OR ".join(f"min_{c} <> max_{c}" for c in ("g1", "g2", "t1", "t2"))).limit(1).count():
        return None
    zero = F.lit(0).cast("long")
    nodes = groups.select(*NODE, "conv_id", "n_convs", "words", (F.col("depth") - 1).alias("up"),
                          F.col("min_g1").alias("g1"), F.col("min_g2").alias("g2"))
    top = every.where("n_convs > 0").select(
        *[zero.alias(c) for c in NODE], "conv_id", "n_convs", zero.alias("words"), (zero - 1).alias("up"), zero.alias("g1"), zero.alias("g2"))
    nodes = scratch.keep(nodes.unionByName(top), "plain")
    scratch.drop("groups")
    children = (nodes.where("depth > 0").groupBy(*PARENT)
                .agg(F.count(F.lit(1)).alias("n_children"), F.sum((F.col("n_convs") == 1).cast("long")).alias("singles"))
                .toDF(*NODE, "n_children", "singles"))
    parents = nodes.select(*[F.col(c).alias(p) for c, p in zip(NODE, PARENT)], F.col("conv_id").alias("parent_conv_id"))
    ended = found.where("last").select(*NODE, "conv_id").unionByName(
        info.where("size = 0").select(*[zero.alias(c) for c in NODE], "conv_id"))
    linked = (nodes.join(children, list(NODE), "left").join(ends(ended), list(NODE), "left")
              .join(parents.hint("merge"), list(PARENT), "left"))
    full = scratch.keep(linked.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "words", F.coalesce("n_children", zero).alias("n_children"),
        F.coalesce("singles", zero).alias("singles"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")), "nodes")
    for name in ("members", "positions", "scanned", "info", "plain"):
        scratch.drop(name)
    sums = subtree_sums(full, scratch)
    out = full.join(sums, ["conv_id", "depth"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
                      F.coalesce("saved_tokens", zero).alias("saved_tokens"), "ends_sha256")


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations (``conv_id, turn, role, text`` in)."""
    scratch = Scratch(conversations.sparkSession)
    seed = 0
    while (out := _attempt(conversations, scratch, seed)) is None:  # equal fingerprints of different sequences: others
        scratch.drop()
        seed += 1
    return scratch.result(out)


def sql() -> str:
    """The trie over materialized prefixes: lists of (role, text), grouped as they are."""
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),"
           " lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),"
           " lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)")
    return f"""WITH raw AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    sha256('0:' || octet_length(role::BLOB) || ':' || role || text)) AS pos FROM raw),
convs AS (SELECT conv_id, {crc} % {HEADS} AS h FROM (SELECT DISTINCT conv_id FROM turns)),
parts AS (SELECT c.conv_id, 0 AS src, t.pos, t.role, t.text FROM convs c
    JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % {FAMILY} AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h),
paths AS (SELECT conv_id, text, row_number() OVER w AS depth, list({{'role': role, 'text': text}}) OVER w AS path
  FROM parts WINDOW w AS (PARTITION BY conv_id ORDER BY src, pos)),
mem AS (SELECT conv_id, depth, path, len(regexp_extract_all(text, '{WORD}')) AS words FROM paths
  UNION ALL SELECT conv_id, 0, [], 0 FROM convs),
ids AS (SELECT conv_id, depth, words, min(conv_id) OVER (PARTITION BY depth, path) AS node,
    depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM mem),
nodes AS (SELECT node, depth, count(*) AS n_convs, max(words) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM ids GROUP BY node, depth),
tree AS (SELECT n.*, p.node AS parent FROM nodes n LEFT JOIN ids p ON p.conv_id = n.node AND p.depth = n.depth - 1),
kids AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM tree WHERE depth > 0 GROUP BY ALL),
full_ AS (SELECT t.*, coalesce(k.n_children, 0) AS n_children FROM tree t LEFT JOIN kids k USING (node, depth)),
sums AS (SELECT i.node, i.depth, sum((f.n_children = 0)::INT) AS n_leaves, sum((f.n_convs - 1) * f.words) AS saved_tokens
  FROM full_ f JOIN ids i ON i.conv_id = f.node AND i.depth <= f.depth GROUP BY i.node, i.depth)
SELECT f.node AS conv_id, f.depth, f.parent AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves::BIGINT AS n_leaves,
  s.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM full_ f JOIN sums s USING (node, depth)"""

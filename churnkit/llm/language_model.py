"""LM scoring with a hierarchical Pitman-Yor model whose seating is sampled by Gibbs sweeps."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import Scratch, WordHasher, as_bytes, chunks, crc_mod, mix

#: Class restaurants, by the hash of the word before, above the restaurants of the words themselves; several share a parent.
LEAVES, PARENTS = 64, 8
#: The class of a text's first token.
START = LEAVES
N_LEAVES = LEAVES + 1
#: The end token; no word has this hash but by a 64-bit accident.
END = np.uint64(0xE4D0F7EC5A3B9D71)
#: What stands before a text's first token.
BEGIN = np.uint64(0x1B56C4E9A7F03D25)
#: Tokens that a task sums up before it emits their pairs.
FLUSH = 3_000_000
#: Bytes of text hashed at a time.
HASHED_BYTES = 1 << 20
#: Bytes of text whose pairs make a group of contexts, and whose words make a part of the words, about.
GROUP_BYTES, PART_BYTES = 8 << 20, 4 << 20


def parent_of(leaf: np.ndarray) -> np.ndarray:
    return leaf % PARENTS


@dataclass
class Totals:
    """Customers and tables of the restaurants of classes (leaves), parents and root after a sweep."""

    customers: tuple[np.ndarray, np.ndarray, float]
    tables: tuple[np.ndarray, np.ndarray, float]


@dataclass
class Seating:
    """Fixed parameters of the sampler: discounts of leaves, parents and root, concentration, vocabulary size, discount of
    the restaurants of the words before."""

    discount: tuple[float, float, float]
    concentration: float
    vocabulary: int
    own_discount: float = 0.5

    @property
    def base(self) -> float:
        return 1.0 / (self.vocabulary + 1)


def token_contexts(words: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, the word before each, bounds): every text's words and its end."""
    n = len(bound) - 1
    out_bound = bound + np.arange(n + 1)
    tokens = np.empty(int(out_bound[-1]), np.uint64)
    is_end = np.zeros(len(tokens), bool)
    is_end[out_bound[1:] - 1] = True
    tokens[is_end] = END
    tokens[~is_end] = words
    before = np.empty(len(tokens), np.uint64)
    before[1:] = tokens[:-1]
    before[out_bound[:-1]] = BEGIN
    return tokens, before, out_bound


def leaf_of(before: np.ndarray) -> np.ndarray:
    """The class restaurant above the restaurant of each word before."""
    return np.where(before == BEGIN, START, (mix(before) % np.uint64(LEAVES)).astype(np.int64))


def _ragged(data: np.ndarray, size: np.ndarray) -> pa.Array:
    """Binary values of ``size`` items each from consecutive items of a structured array."""
    ends = np.concatenate(([0], np.cumsum(size * data.dtype.itemsize))).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(
        np.ascontiguousarray(data).tobytes())]).cast(pa.binary())


def _unragged(column: pa.Array, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """(items, owner row of each) of a binary column."""
    wide = column.cast(pa.large_binary())
    size = np.array(pc.binary_length(wide)) // dtype.itemsize if len(wide) else np.zeros(0, np.int64)
    data = np.frombuffer(b"".join(wide.to_pylist()), dtype)
    return data, np.repeat(np.arange(len(wide)), size)


WIDE_CELL = np.dtype([("code", "u1"), ("n", "<i8")])


def uniform(word: np.ndarray, code: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on their arguments alone, so a recomputed task draws the same."""
    x = word ^ mix(code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    for s in salt:
        x = mix(x + np.uint64(s + 1))
    return ((mix(x) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def seat(customers: np.ndarray, old_base: np.ndarray, word: np.ndarray, code: np.ndarray, discount: float, sweep: int,
         level: int) -> np.ndarray:
    """Tables of each dish after its customers come in one by one: the n-th opens a table with probability proportional
    to ``old_base`` (the parent's share of a new table), else sits down with weight n - 1 - discount x tables.  Beyond
    16 customers those to come are drawn in steps of an eighth of those seated, with the probability at the step's
    start."""
    tables = np.minimum(customers, 1).astype(np.float64)
    n, step = 1, 0
    live = np.flatnonzero(customers > 1)
    while len(live):
        size = 1 if n < 16 else n // 8
        weight = old_base[live]
        p = weight / (weight + np.maximum(n - discount * tables[live], 1e-12))
        u = uniform(word[live], code[live], sweep, level, step)
        come = np.minimum(size, customers[live] - n).astype(np.float64)
        if size == 1:
            tables[live] += u < p
        else:
            draw = come * p + np.sqrt(come * p * (1 - p)) * np.log(u / (1 - u)) / 1.702  # about normal
            tables[live] += np.clip(np.rint(draw), 0, come)
        n, step = n + size, step + 1
        live = live[customers[live] > n]
    return tables


@dataclass
class Cells:
    """A batch's dishes: leaf cells (row of the word, leaf, customers) and their sums by parent."""

    word: np.ndarray
    row: np.ndarray
    code: np.ndarray
    customers: np.ndarray
    parent_row: np.ndarray
    parent_code: np.ndarray
    to_parent: np.ndarray


def cells(word: np.ndarray, row: np.ndarray, code: np.ndarray, customers: np.ndarray) -> Cells:
    parent, to_parent = np.unique(row * PARENTS + parent_of(code), return_inverse=True)
    return Cells(word, row, code, customers, parent // PARENTS, parent % PARENTS, to_parent)


def cells_of(batch: pa.RecordBatch) -> Cells:
    data, row = _unragged(batch.column("cells"), WIDE_CELL)
    return cells(batch.column("word").to_numpy().view(np.uint64), row, data["code"].astype(np.int64), data["n"].astype(np.int64))


State = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def first_state(c: Cells) -> State:
    """(leaf tables, parent customers, parent tables, root customers, root tables) with one table a dish."""
    leaf = np.minimum(c.customers, 1).astype(np.float64)
    up = np.bincount(c.to_parent, weights=leaf, minlength=len(c.parent_row))
    mid = np.minimum(up, 1)
    top = np.bincount(c.parent_row, weights=mid, minlength=len(c.word))
    return leaf, up, mid, top, np.minimum(top, 1)


def parent_probability(c: Cells, state: State, model: Seating, t: Totals) -> tuple[np.ndarray, np.ndarray]:
    """Predictive probabilities of the root for every word and of the parents for every dish of theirs."""
    _, up, mid, top, root = state
    _, d1, d0 = model.discount
    theta = model.concentration
    p_root = (top - d0 * root) / (theta + t.customers[2]) + (theta + d0 * t.tables[2]) / (theta + t.customers[2]) * model.base
    below = theta + t.customers[1][c.parent_code]
    return p_root, (up - d1 * mid) / below + (theta + d1 * t.tables[1][c.parent_code]) / below * p_root[c.parent_row]


def leaf_probability(c: Cells, state: State, model: Seating, t: Totals) -> np.ndarray:
    """Predictive probability of the leaf for every cell, without customers too."""
    p_mid = parent_probability(c, state, model, t)[1]
    own = (c.customers - model.discount[0] * state[0]) / (model.concentration + t.customers[0][c.code])
    return own + back_off(model, [t], -1)[0][c.code] * p_mid[c.to_parent]


def next_state(c: Cells, state: State, model: Seating, t: Totals, sweep: int) -> State:
    """Seat every dish anew given the restaurants' totals of the sweep before and the parents' predictive probabilities."""
    d2, d1, d0 = model.discount
    theta = model.concentration
    p_root, p_mid = parent_probability(c, state, model, t)
    leaf = seat(c.customers, (theta + d2 * t.tables[0][c.code]) * p_mid[c.to_parent], c.word[c.row], c.code, d2, sweep, 2)
    up = np.bincount(c.to_parent, weights=leaf, minlength=len(c.parent_row))
    mid = seat(up, (theta + d1 * t.tables[1][c.parent_code]) * p_root[c.parent_row], c.word[c.parent_row],
               c.parent_code, d1, sweep, 1)
    top = np.bincount(c.parent_row, weights=mid, minlength=len(c.word))
    root = seat(top, np.full(len(top), (theta + d0 * t.tables[2]) * model.base), c.word, np.zeros(len(top), np.int64), d0, sweep, 0)
    return leaf, up, mid, top, root


def sweeps(c: Cells, model: Seating, totals: list[Totals]) -> Iterator[State]:
    """States of the batch's words while their customers stay: one table a dish first, then after each Gibbs sweep."""
    state = first_state(c)
    yield state
    for s, t in enumerate(totals):
        state = next_state(c, state, model, t, s)
        yield state


def state_totals(c: Cells, state: State) -> np.ndarray:
    """Customers and tables of every restaurant of classes, parents and root, of these words."""
    leaf, up, mid, top, root = state
    total = np.zeros((2, N_LEAVES + PARENTS + 1))
    for k, (x, y, z) in enumerate(((c.customers, up, top), (leaf, mid, root))):
        total[k, :N_LEAVES] = np.bincount(c.code, weights=x, minlength=N_LEAVES)
        total[k, N_LEAVES:-1] = np.bincount(c.parent_code, weights=y, minlength=PARENTS)
        total[k, -1] = z.sum()
    return total


def back_off(model: Seating, totals: list[Totals], burn_in: int) -> tuple[np.ndarray, np.ndarray]:
    """Averaged share that each leaf and each parent leaves to the restaurant above it."""
    used = [t for s, t in enumerate(totals) if s > burn_in] or totals[-1:]
    theta = model.concentration
    return tuple(np.mean([(theta + d * t.tables[k]) / (theta + t.customers[k]) for t in used], 0)
                 for k, d in ((0, model.discount[0]), (1, model.discount[1])))


# ------------------------------------------------- restaurants of the words before, in groups; words, in parts

#: Rows that groups of contexts, parts of the words and blocks of documents hold and send each other.
ROW = "kind int, g int, q int, block long, data binary"
PAIRS, ASK, LEARNT, SEATS, TILE, COUNTS, CELLS, UP, DOWN, ANSWER = range(10)
Row = tuple[int, int, int, int, bytes]


def _rows(rows: Iterable[Row]) -> pa.RecordBatch:
    kind, g, q, block, data = zip(*rows) if (rows := list(rows)) else ((),) * 5
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(g, pa.int32()), pa.array(q, pa.int32()),
                                       pa.array(block, pa.int64()), pa.array(data, pa.binary())], ["kind", "g", "q", "block", "data"])


def grouped(rows: DataFrame, key: str, fn: Callable[[dict[int, list[Row]]], Iterable[Row]]) -> DataFrame:
    """``fn`` of the rows of each ``key`` by their kind, in the order of (g, q, block)."""

    def run(table: pa.Table) -> pa.Table:
        kinds: dict[int, list[Row]] = {}
        for row in sorted(zip(*(table.column(c).to_pylist() for c in ("kind", "g", "q", "block", "data")), strict=True),
                          key=lambda r: r[:4]):
            kinds.setdefault(row[0], []).append(row)
        return pa.Table.from_batches([_rows(fn(kinds))])

    return rows.groupBy(key).applyInArrow(run, ROW)


def distinct_pairs(tokens: np.ndarray, before: np.ndarray, split: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a place of each distinct pair in the order of group, word before, part and word; its group; the pair of every token)."""
    key = mix(before + mix(tokens))
    by_key = np.argsort(key)
    key = key[by_key]
    new = np.concatenate(([True], key[1:] != key[:-1]))[: len(key)]
    some = by_key[new]
    group = group_of(before[some], split).astype(np.int32)
    order = np.lexsort((tokens[some], part_of(tokens[some], parts).astype(np.int32), before[some], group))
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    pair = np.empty(len(key), np.int32)
    pair[by_key] = np.repeat(place, np.diff(np.append(np.flatnonzero(new), len(key))))
    return some[order], group[order], pair


def small(x: np.ndarray) -> np.ndarray:
    """The same numbers, none below 0, in as few bytes as the largest needs."""
    return x.astype(np.min_scalar_type(int(x.max())) if len(x) else np.uint8)


def group_of(before: np.ndarray, split: int) -> np.ndarray:
    """Groups of contexts; those of a group have the same class, ``group // split``."""
    return leaf_of(before) * split + (mix(before ^ BEGIN) % np.uint64(split)).astype(np.int64)


def part_of(words: np.ndarray, parts: int) -> np.ndarray:
    return (mix(words ^ END) % np.uint64(parts)).astype(np.int64)


def runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, length of each) of sorted values."""
    start = np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1]))) if len(sorted_values) else np.zeros(0, np.int64)
    return sorted_values[start], np.diff(np.append(start, len(sorted_values)))


def pair_rows(docs: DataFrame, split: int, parts: int) -> DataFrame:
    """The distinct pairs (word before, word) of each block's documents with their counts in the training documents, a
    row for each group of contexts.  A task adds up its pairs before it emits them."""

    def summed(block: int, held: list) -> Iterator[pa.RecordBatch]:
        tokens, before, learn = (np.concatenate(x) for x in zip(*held, strict=True))
        first, group, pair = distinct_pairs(tokens, before, split, parts)
        n = np.bincount(pair[learn], minlength=len(first)).astype(np.uint32)
        at = 0
        out = []
        for g, size in zip(*(x.tolist() for x in runs(group)), strict=True):
            own = first[at : at + size]
            u, length = runs(before[own])
            words, word = np.unique(tokens[own], return_inverse=True)
            out.append((PAIRS, g, 0, block, pickle.dumps((u, small(length), words, small(word), small(n[at : at + size])))))
            at += size
        yield _rows(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        lists: dict[int, list] = {}
        held = 0
        for b in batches:
            texts, block, learn = as_bytes(b.column(0)), b.column(1).to_numpy(), b.column(2).to_numpy(zero_copy_only=False)
            for a, z in chunks(texts, HASHED_BYTES):
                tokens, before, bound = token_contexts(*hasher(texts[a:z]))
                size = np.diff(bound)
                of_block, of_learn = np.repeat(block[a:z], size), np.repeat(learn[a:z], size)
                for k in np.unique(block[a:z]):
                    m = of_block == k
                    lists.setdefault(int(k), []).append((tokens[m], before[m], of_learn[m]))
                held += len(tokens)
                if held > FLUSH:
                    for k, p in lists.items():
                        yield from summed(k, p)
                    lists, held = {}, 0
        for k, p in lists.items():
            yield from summed(k, p)

    return docs.select("text", "block", "learn").mapInArrow(run, ROW)


def learnt_groups(rows: DataFrame, parts: int, used_first: bool) -> DataFrame:
    """Of each group of contexts: what its blocks ask for, its pairs in the training documents, the seats of those that
    occur more than once, and for each part of the words its words with the dishes and tokens of the group."""

    def learn(kinds: dict[int, list[Row]]) -> Iterator[Row]:
        g = kinds[PAIRS][0][1]
        got: dict[int, list] = {}
        for *_, block, data in kinds[PAIRS]:
            u, length, w, at, n = pickle.loads(data)
            got.setdefault(block, []).append((np.repeat(u, length), w[at], n.astype(np.int64)))
        u, w, n = (np.concatenate([x[k] for lists in got.values() for x in lists]) for k in range(3))
        contexts, words = np.unique(u), np.unique(w)
        part = part_of(words, parts)
        order = np.argsort(part, kind="stable")  # words are numbered by their part, and by their hash in a part
        number = np.empty(len(words), np.int64)
        number[order] = np.arange(len(words))
        words, part = words[order], part[order]
        key = np.searchsorted(contexts, u) << 32 | number[np.searchsorted(words[number], w)]
        at = 0
        for block, lists in got.items():
            size = sum(len(x[0]) for x in lists)
            own = key[at : at + size] if len(lists) == 1 else np.unique(key[at : at + size])
            at += size
            asked, length = runs(own >> 32)
            yield ASK, g, 0, block, pickle.dumps((small(np.diff(asked, prepend=0)), small(length), small(own & 0xFFFFFFFF)))
        key, pair = np.unique(key[n > 0], return_inverse=True)
        n = np.bincount(pair, weights=n[n > 0], minlength=len(key)).astype(np.int64)
        context, word, more = key >> 32, key & 0xFFFFFFFF, n > 1
        each = lambda m, of, size: small(np.bincount(of[m], minlength=size))
        yield LEARNT, g, 0, 0, pickle.dumps((each(n > 0, context, len(contexts)), small(word), small(n)))
        seat_words = np.unique(word[more])
        yield SEATS, g, 0, 0, pickle.dumps({
            "word": small(np.searchsorted(seat_words, word[more])), "of_context": each(more, context, len(contexts)), "n": small(n[more]),
            "tables": np.ones(int(more.sum()), np.uint8), "sum": np.full(int(more.sum()), int(used_first), np.uint8),
            "single": each(~more, context, len(contexts)), "parts": runs(part[seat_words])})
        yield COUNTS, g, 0, 0, pickle.dumps((int((n == 1).sum()), int((n == 2).sum())))
        single, dishes = (each(m, word, len(words)) for m in (~more, more))
        tokens = np.bincount(word, weights=n, minlength=len(words)).astype(np.int64)
        at = 0
        for q, size in zip(*(v.tolist() for v in runs(part)), strict=True):
            yield TILE, g, q, 0, pickle.dumps(tuple(small(x[at : at + size]) if x is not words else x[at : at + size]
                                                    for x in (words, single, dishes, tokens)))
            at += size

    return grouped(rows, "g", learn)


def first_cells(tiles: DataFrame, split: int) -> DataFrame:
    """Of each part of the words: their cells in the class restaurants, with one table a dish."""

    def start(kinds: dict[int, list[Row]]) -> Iterator[Row]:
        q = kinds[TILE][0][2]
        groups = np.array([r[1] for r in kinds[TILE]])
        lists = [pickle.loads(r[4]) for r in kinds[TILE]]
        words, single, dishes, tokens = (np.concatenate([x[k] for x in lists]) for k in range(4))
        size = np.array([len(x[0]) for x in lists])
        word, row = np.unique(words, return_inverse=True)
        n = np.bincount(row, weights=tokens, minlength=len(word)).astype(np.int64)  # doubles are exact to 2**53
        step, start = np.diff(row, prepend=0), np.cumsum(size) - size
        step[start] = row[start]
        part = {"n": small(n), "step": small(step), "size": size, "groups": groups, "class": small(groups // split),
                "single": small(single), "more": np.packbits(dishes > 0), "sum": None}
        c, place = placed_cells(q, part)
        c.customers = np.bincount(place, weights=single.astype(np.float64) + dishes, minlength=len(c.row))
        state = first_state(c)
        yield held_cells(q, part, c, state)
        yield COUNTS, -1, q, 0, pickle.dumps((state_totals(c, state), [int(x) for x in (n.sum(), (n > 0).sum(), (n == 1).sum(), (n == 2).sum())]))

    return grouped(tiles, "q", start)


def placed_cells(q: int, part: dict) -> tuple[Cells, np.ndarray]:
    """(cells of a part without customers, the cell of every word of every group)."""
    size, run = part["size"], np.cumsum(part["step"], dtype=np.int64)
    start = np.cumsum(size) - size
    row = run - np.repeat(run[start] - part["step"][start], size)
    cell, place = np.unique(row << 8 | np.repeat(part["class"].astype(np.int64), size), return_inverse=True)
    draw = mix(np.arange(len(part["n"]), dtype=np.uint64) + np.uint64(q + 1 << 40))
    return cells(draw, cell >> 8, cell & 255, np.zeros(len(cell))), place


def held_cells(q: int, part: dict, c: Cells, state: State) -> Row:
    return CELLS, -1, q, 0, pickle.dumps({**part, "state": [small(x) for x in (c.customers, *state)]})


def loaded(q: int, data: bytes) -> tuple[dict, Cells, np.ndarray, np.ndarray, State]:
    """(part, its cells, the cell of every word of every group, whether the group seats it anew, state)."""
    part = pickle.loads(data)
    c, place = placed_cells(q, part)
    c.customers, *state = (x.astype(np.float64) for x in part["state"])
    return part, c, place, np.unpackbits(part["more"], count=len(place)).astype(bool), tuple(state)


def down(part_rows: DataFrame, model: Seating, totals: Totals, samples: int = 0) -> DataFrame:
    """Predictive probabilities of the class restaurants for the words that a group seats anew; with ``samples`` their
    averages for all words that it asks for, and the words' counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for q, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                part, c, place, more, state = loaded(q, data)
                p = leaf_probability(c, state, model, totals)
                if samples:
                    p = (p + (0 if part["sum"] is None else part["sum"])) / samples
                    more[:] = True
                owner = np.repeat(np.arange(len(part["size"])), part["size"])[more]
                end = np.cumsum(np.bincount(owner, minlength=len(part["size"])))[:-1]
                sent = np.split(p.astype(np.float32)[place[more]], end)
                n = np.split(part["n"].astype(np.int64)[c.row[place]], end) if samples else [np.zeros(0, np.int64)] * len(sent)
                yield _rows((DOWN, g, q, 0, x.tobytes() + y.tobytes()) for g, x, y in zip(part["groups"].tolist(), sent, n, strict=True)
                            if len(x))

    return part_rows.where(f"kind = {CELLS}").select("q", "data").mapInArrow(run, ROW)


def seated(groups: DataFrame, messages: DataFrame, model: Seating, sweep: int, used: bool) -> DataFrame:
    """A sweep of the restaurants of the words before: every dish is seated anew given its restaurant's tables of the
    sweep before and the class's predictive probability; a table is a customer of the class restaurant."""
    theta, d = model.concentration, model.own_discount

    def run(kinds: dict[int, list[Row]]) -> Iterator[Row]:
        _, g, _, _, data = kinds[SEATS][0]
        s = pickle.loads(data)
        p = np.frombuffer(b"".join(r[4] for r in kinds.get(DOWN, ())), np.float32)
        context = np.repeat(np.arange(len(s["single"])), s["of_context"])
        of_context = s["single"] + np.bincount(context, weights=s["tables"], minlength=len(s["single"]))
        weight = (theta + d * of_context[context]) * p[s["word"]]
        draw = mix(np.arange(len(weight), dtype=np.uint64) + np.uint64(g + 1 << 40))
        tables = seat(s["n"].astype(np.int64), weight, draw, np.zeros(len(draw), np.int64), d, sweep, 3)
        s["tables"] = small(tables)
        if used:
            s["sum"] = small(s["sum"] + tables)
        yield SEATS, g, 0, 0, pickle.dumps(s)
        parts, size = s["parts"]
        up = np.bincount(s["word"], weights=tables, minlength=len(p)).astype(np.uint32)
        for q, x in zip(parts.tolist(), np.split(up, np.cumsum(size)[:-1])):
            yield UP, g, q, 0, x.tobytes()

    return grouped(groups.where(f"kind = {SEATS}").union(messages), "g", run)


def moved_up(part_rows: DataFrame, groups: DataFrame, model: Seating, totals: Totals, sweep: int, used: bool) -> DataFrame:
    """A sweep of the restaurants above, with the tables of the restaurants of the words before as customers.  ``used``
    says whether the state before counts in the averages."""

    def run(kinds: dict[int, list[Row]]) -> Iterator[Row]:
        _, _, q, _, data = kinds[CELLS][0]
        part, c, place, more, state = loaded(q, data)
        if used:
            p = leaf_probability(c, state, model, totals).astype(np.float32)
            part["sum"] = p if part["sum"] is None else part["sum"] + p
        tables = part["single"].astype(np.float64)
        tables[more] += np.frombuffer(b"".join(r[4] for r in kinds.get(UP, ())), np.uint32)
        c.customers = np.bincount(place, weights=tables, minlength=len(c.row))
        state = next_state(c, state, model, totals, sweep)
        yield held_cells(q, part, c, state)
        yield COUNTS, -1, q, 0, pickle.dumps((state_totals(c, state), None))

    return grouped(part_rows.where(f"kind = {CELLS}").union(groups.where(f"kind = {UP}")), "q", run)


def gathered(part_rows: DataFrame) -> tuple[Totals, np.ndarray]:
    """Totals of all restaurants above, and counts of the words, from a few numbers of each part."""
    total, stat = np.zeros((2, N_LEAVES + PARENTS + 1)), np.zeros(4, np.int64)
    for r in part_rows.where(f"kind = {COUNTS}").select("data").toLocalIterator():
        own, counts = pickle.loads(r[0])
        total += own
        stat += np.array(counts or (0,) * 4)
    cut = lambda x: (x[:N_LEAVES], x[N_LEAVES:-1], float(x[-1]))
    return Totals(cut(total[0]), cut(total[1])), stat


def answered(groups: DataFrame, seats: DataFrame, messages: DataFrame, model: Seating, samples: int) -> DataFrame:
    """``(block, g, data)``: probability of each pair that a block asks for, and the count of its word."""
    theta, d = model.concentration, model.own_discount

    def run(kinds: dict[int, list[Row]]) -> Iterator[Row]:
        length, word, n = pickle.loads(kinds[LEARNT][0][4])
        n_words = [len(r[4]) // 12 for r in kinds[DOWN]]
        p, count = (np.concatenate([np.frombuffer(r[4], t, k, at * k) for r, k in zip(kinds[DOWN], n_words, strict=True)])
                    for t, at in ((np.float32, 0), (np.int64, 4)))
        tables = np.ones(len(n))
        tables[n > 1] = pickle.loads(kinds[SEATS][0][4])["sum"] / samples
        context = np.repeat(np.arange(len(length)), length)
        customers = np.bincount(context, weights=n, minlength=len(length))
        gap = (theta + d * np.bincount(context, weights=tables, minlength=len(length))) / (theta + customers)
        own = np.append((n - d * tables) / (theta + customers[context]), 0)
        key = np.append(context << 32 | word, -1)
        for _, g, _, block, data in kinds[ASK]:
            step, size, w = pickle.loads(data)
            u = np.repeat(np.cumsum(step, dtype=np.int64), size)
            wanted = u << 32 | w
            found = np.searchsorted(key[:-1], wanted)
            out = np.where(key[found] == wanted, own[found], 0) + gap[u] * p[w]
            yield ANSWER, g, 0, block, pickle.dumps((out.astype(np.float32), small(count[w])))

    return grouped(groups.where(f"kind IN ({ASK}, {LEARNT})").union(seats.where(f"kind = {SEATS}")).union(messages), "g", run).select(
        "block", "g", "data")


def scored(docs: DataFrame, answers: DataFrame, train_tokens: int, model: Seating, split: int, parts: int, id_type: str) -> DataFrame:
    """Scores of each block's documents from the answers for its pairs."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        got = [pickle.loads(x) for _, x in sorted(zip(right.column("g").to_pylist(), right.column("data").to_pylist(), strict=True))]
        hasher = WordHasher()
        texts = as_bytes(left.column("text").combine_chunks()) if left.num_rows else []
        lists, size = [], [np.zeros(0, np.int64)]
        for a, z in chunks(texts, HASHED_BYTES):
            tokens, before, bound = token_contexts(*hasher(texts[a:z]))
            lists.append((tokens, before))
            size.append(np.diff(bound))
        size = np.concatenate(size)
        n = known = base_sum = score = np.zeros(0)
        if lists:
            tokens, before = (np.concatenate(x) for x in zip(*lists, strict=True))
            del lists, texts
            _, _, pair = distinct_pairs(tokens, before, split, parts)
            del tokens, before
            p, count = (np.concatenate(x) for x in zip(*got, strict=True))
            base = np.log10((count + 0.1) / (train_tokens + 0.1 * (model.vocabulary + 1)))
            at = np.cumsum(size) - size
            n, known, base_sum, score = size, *(np.add.reduceat(x[pair], at) for x in (
                (count > 0).astype(np.int64), base, np.log10(p.astype(np.float64))))
        return pa.table({"doc_id": left.column("doc_id"), "n_tokens": pa.array(n.astype(np.int64)),
                         "n_known": pa.array(known.astype(np.int64)),
                         "base_score": pa.array(base_sum.astype(np.float64)), "score": pa.array(score.astype(np.float64))})

    return docs.select("block", "doc_id", "text").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        run, f"doc_id {id_type}, n_tokens long, n_known long, base_score double, score double")


def discount_of(ones: int, twos: int) -> float:
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5


def score(df: DataFrame, n_sweeps: int = 4, burn_in: int = 1, concentration: float = 1.0, block_bytes: int = 16 << 20,
          held_out_mod: int = 10, id_col: str = "doc_id", text_col: str = "text", block: Column | None = None) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row.

    Every word that stands before another has a restaurant of its own (so has
    a text's start).  Its parent is that of its hash class (LEAVES, and one
    for the start); classes share parent restaurants and these the root, over
    a uniform base of the V training types and one unknown.  A table of a
    restaurant is a customer of its parent.  Each Gibbs sweep seats all dishes
    anew given the restaurants' totals of the sweep before.  Restaurants of
    words lie in groups of one class each, the dishes of classes, parents and
    root in parts of the words; in a sweep a part tells each group the class's
    probabilities of its words, and the group tells the part its tables of
    them.  Tables and probabilities are averaged over the sweeps after
    ``burn_in``.  Discounts come from the counts of counts of pairs and words.

    Documents are dealt into blocks (``block``, else by a hash of the id);
    a block asks for its distinct pairs once.  Groups and parts grow in number with
    the input, so neither grows in size but by one word's own followers.  A null text is empty: its end alone.
    Repeated rows score alike, a null id is in no fold and isn't learnt from; other columns are
    ignored.  With nothing to learn from, every token has the base's
    probability."""
    spark = df.sparkSession
    scratch = Scratch(spark)
    id_type = df.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    split = max(1, -(-size // (LEAVES * GROUP_BYTES)))
    if block is None:
        block = F.pmod(F.xxhash64(id_col), F.lit(max(1, -(-size // (2 * block_bytes)))))
    docs = df.select(F.col(id_col).alias("doc_id"), text.alias("text"), block.cast("long").alias("block"),
                     F.coalesce(crc_mod(F.col(id_col), held_out_mod) != 0, F.lit(False)).alias("learn"))
    used = [s for s in range(n_sweeps + 1) if s > burn_in] or [n_sweeps]
    groups = scratch.keep(learnt_groups(pair_rows(docs, split, parts), parts, 0 in used), "groups")
    words = scratch.keep(first_cells(groups.where(f"kind = {TILE}"), split), "words0")
    scratch.release()
    totals, (train_tokens, vocabulary, ones, twos) = gathered(words)
    pair_counts = [pickle.loads(r[0]) for r in groups.where(f"kind = {COUNTS}").select("data").toLocalIterator()]
    d = discount_of(int(ones), int(twos))
    model = Seating((d, d, d), concentration, int(vocabulary), discount_of(*(sum(x[k] for x in pair_counts) for k in (0, 1))))
    seats = groups
    for s in range(n_sweeps):
        seats = scratch.keep(seated(seats, down(words, model, totals), model, s, s + 1 in used), f"seats{s + 1}")
        words = scratch.keep(moved_up(words, seats, model, totals, s, s in used), f"words{s + 1}")
        totals, _ = gathered(words)
        scratch.drop(f"words{s}")
        if s:
            scratch.drop(f"seats{s}")
        scratch.release()
    answers = scratch.keep(answered(groups, seats, down(words, model, totals, len(used)), model, len(used)), "answers")
    for name in ("groups", f"words{n_sweeps}", f"seats{n_sweeps}"):
        scratch.drop(name)
    scratch.release()
    out = scored(docs, answers, int(train_tokens), model, split, parts, id_type)
    held = F.coalesce(crc_mod(F.col("doc_id"), held_out_mod) == 0, F.lit(False))
    return scratch.result(out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known",
                                     F.lit(int(train_tokens)).cast("long").alias("train_tokens"), "base_score", "score"))

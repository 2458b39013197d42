"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import Scratch, WordHasher, chunks, mix

#: ASCII characters that aren't letters or digits part words; letters are folded before.
SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
BASE = 0x9E3779B97F4A7C15


def rolling(words: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``n`` words, by running sums of a polynomial modulo 2**64."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    power = np.full(len(words) + 1, BASE, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    back = np.full(len(words) + 1, pow(BASE, -1, 1 << 64), np.uint64)
    back[0] = 1
    back = np.multiply.accumulate(back)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[:-1], out=total[1:])
    return mix((total[n:] - total[:-n]) * back[: len(words) - n + 1])


def tile(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (doc position, item position, length) of non-overlapping equal passages of at least
    ``least`` words, the longest first.

    A length is searched for by comparing rolling hashes of all unmarked
    windows; matches are extended as far as words agree and are unmarked, and
    marked longest first.  If one is much longer than the length searched, the
    search starts again from there; if none is left, the length is halved."""
    free_doc, free_item = np.ones(len(doc), bool), np.ones(len(item), bool)
    tiles: list[tuple[int, int, int]] = []
    length = max(least, len(item))
    while True:
        h_doc, h_item = rolling(doc, length), rolling(item, length)
        found: list[tuple[int, int, int]] = []
        if len(h_doc) and len(h_item):
            def open_at(free):
                taken = np.concatenate(([0], np.cumsum(~free)))
                return taken[length:] == taken[:-length]
            item_at: dict[int, list[int]] = {}
            for j in np.flatnonzero(open_at(free_item)):
                item_at.setdefault(int(h_item[j]), []).append(int(j))
            for i in np.flatnonzero(open_at(free_doc) & np.isin(h_doc, h_item)):
                for j in item_at.get(int(h_doc[i]), ()):
                    if i and j and doc[i - 1] == item[j - 1] and free_doc[i - 1] and free_item[j - 1]:
                        continue  # part of a match that begins before
                    n = 0
                    while (i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n]
                           and free_doc[i + n] and free_item[j + n]):
                        n += 1
                    if n >= length:
                        found.append((n, int(i), j))
        marked = False
        for n, i, j in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            if free_doc[i : i + n].all() and free_item[j : j + n].all():
                free_doc[i : i + n] = False
                free_item[j : j + n] = False
                tiles.append((i, j, n))
                marked = True
        if marked:
            continue  # what overlapped a marked match may have parts of this length left
        if length == least:
            return tiles
        length = max(least, length // 2)


def coverage(doc: np.ndarray, item: np.ndarray, least: int) -> float:
    """Share of the item's words that tiles cover."""
    return sum(n for _, _, n in tile(doc, item, least)) / len(item)


def _scan(docs: DataFrame, items: list[tuple[int, bytes]], seed: int, share: float, keep: list[str]) -> DataFrame:
    """``docs`` has ``_text``, the item ids and best coverage so far, and the columns to keep; returns the same, with
    the given items' matches added."""
    schema = docs.select("_items", "_coverage", *keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SEPARATORS)
        words, bound = hasher([t for _, t in items])
        known = [(i, words[bound[k] : bound[k + 1]]) for k, (i, _) in enumerate(items)]
        known = [(i, w) for i, w in known if len(w) >= seed]
        grams = np.concatenate([rolling(w, seed) for _, w in known] + [np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(known)), [len(w) - seed + 1 for _, w in known])
        order = np.argsort(grams, kind="stable")
        grams, owner = grams[order], owner[order]

        def matches(doc: np.ndarray, places: np.ndarray, hashes: np.ndarray) -> tuple[list[int], float]:
            """Items of which the document holds enough, and the best coverage, from its seed places."""
            by_item: dict[int, list[int]] = {}
            for p, x, y in zip(places.tolist(), np.searchsorted(grams, hashes),
                               np.searchsorted(grams, hashes, side="right"), strict=True):
                for o in set(owner[x:y].tolist()):
                    by_item.setdefault(o, []).append(p)
            got, best = [], 0.0
            for o, at in by_item.items():
                item_id, item = known[o]
                step = np.zeros(len(doc) + 1, np.int64)  # only words under a seed can lie in a tile
                np.add.at(step, at, 1)
                np.add.at(step, np.array(at) + seed, -1)
                under = np.cumsum(step)[:-1] > 0
                part = np.where(under, doc, np.uint64(o + 1))[under | np.concatenate(([False], under[:-1]))]
                cover = coverage(part, item, seed)
                best = max(best, cover)
                if cover >= share:
                    got.append(item_id)
            return got, best

        for b in batches:
            texts = [(t or "").lower().encode() for t in b.column("_text").to_pylist()]
            found, best = b.column("_items").to_pylist(), b.column("_coverage").to_numpy().copy()
            for a, z in chunks(texts):
                words, bound = hasher(texts[a:z])
                h = rolling(words, seed)
                if not len(grams) or not len(h):
                    continue
                seeded = np.flatnonzero(grams[np.minimum(np.searchsorted(grams, h), len(grams) - 1)] == h)
                doc_of = np.searchsorted(bound, seeded, side="right") - 1
                inside = seeded + seed <= bound[doc_of + 1]
                seeded, doc_of = seeded[inside], doc_of[inside]
                for k in np.unique(doc_of):
                    at = seeded[doc_of == k]
                    got, cover = matches(words[bound[k] : bound[k + 1]], at - bound[k], h[at])
                    found[a + k] = sorted({*found[a + k], *got})
                    best[a + k] = max(best[a + k], cover)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int64())), pa.array(best)] + [b.column(c) for c in keep],
                ["_items", "_coverage", *keep])

    return docs.select(*dict.fromkeys(["_text", "_items", "_coverage", *keep])).mapInArrow(run, schema)


def flag(docs: DataFrame, benchmark: DataFrame, seed: int = 5, share: float = 0.8, text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
         block_bytes: int = 32 << 20) -> DataFrame:
    """The ``keep`` columns of every row with ``contaminated``, ``item_ids`` and ``coverage``.

    A document is contaminated by an item if tiles of at least ``seed`` words
    cover ``share`` of the item's words, in any order.  Words are folded, and
    split at all ASCII characters but letters and digits.  Items of fewer
    than ``seed`` words match nothing, nor do null and empty texts (no items,
    coverage 0).  Every row is judged by itself, so repeated rows are judged
    alike; an empty benchmark leaves every document clean.

    Seeds meet in the tasks: the benchmark is cut into blocks of counted size,
    one block goes to the tasks with the code, and with several blocks the
    flagged rows are written between them.  Nothing is shuffled."""
    scratch = Scratch(docs.sparkSession)
    size = benchmark.agg(F.sum(F.octet_length(item_text_col))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    items = benchmark.where(F.col(item_text_col).isNotNull() & F.col(item_col).isNotNull()).select(
        F.col(item_col).cast("long").alias("i"), F.col(item_text_col).alias("t"))
    rows = docs.select(F.col(text_col).alias("_text"), F.array().cast("array<bigint>").alias("_items"),
                       F.lit(0.0).alias("_coverage"), *keep)
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == k).distinct().collect()  # about block_bytes
        texts = sorted((r.i, r.t.lower().encode()) for r in part)
        last = k == blocks - 1
        rows = _scan(rows, texts, seed, share, list(keep) if last else ["_text", *keep])
        if not last:
            rows = scratch.keep(rows, f"block{k}")
    return rows.select(*keep, (F.size("_items") > 0).alias("contaminated"), F.col("_items").alias("item_ids"),
                       F.col("_coverage").alias("coverage"))

"""Quality classifier: nearest-neighbour voting over latent-semantic vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import WordHasher, as_bytes, crc_mod

BUCKETS = 4096
#: Terms besides the byte trigrams: repeated-word and distinct-word shares and mean word length, each in bins.
EXTRA = 24


@dataclass
class Neighbours:
    """Term weights, the latent projection, and the labelled vectors."""

    idf: np.ndarray
    project: np.ndarray  # (BUCKETS + EXTRA, dims)
    vectors: np.ndarray  # (labelled, dims), unit length
    labels: np.ndarray  # +1 or -1
    k: int
    prior: float


def term_rows(texts: list[bytes], hasher: WordHasher) -> np.ndarray:
    """Term frequencies (rows x terms): log counts of hashed byte trigrams of the whole text, scaled to unit length,
    and the bins of its word statistics."""
    out = np.zeros((len(texts), BUCKETS + EXTRA), np.float32)
    for i, t in enumerate(texts):
        if not t:
            continue
        b = np.frombuffer(b" " + t + b" ", np.uint8).astype(np.uint32)
        h = (b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA77) ^ b[2:] * np.uint32(0xC2B2AE3D))
        row = np.log1p(np.bincount((h ^ (h >> np.uint32(15))) & np.uint32(BUCKETS - 1), minlength=BUCKETS))
        out[i, :BUCKETS] = row / np.sqrt((row * row).sum())
        words, _ = hasher([t])
        if len(words) > 1:
            repeated = float((words[1:] == words[:-1]).mean())
            n = min(len(words), 200)  # distinct share of blocks of 200 words, so that long texts compare with short ones
            blocks = np.sort(words[: len(words) // n * n].reshape(-1, n), 1)
            distinct = 1 - float((blocks[:, 1:] == blocks[:, :-1]).mean())
            out[i, BUCKETS + min(7, int(repeated * 16))] = 1
            out[i, BUCKETS + 8 + min(7, int((1 - distinct) * 10))] = 1
        out[i, BUCKETS + 16 + min(7, int(len(t) / max(1, len(words)) / 2))] = 1
    return out


def fit_neighbours(rows: np.ndarray, labels: np.ndarray, dims: int = 64, k: int = 15, prior: float = 0.5,
                   extra_weight: float = 0.35, seed: int = 3) -> Neighbours:
    """Latent axes by a randomised SVD of the weighted rows."""
    seen = (rows > 0).sum(0)
    idf = np.log((1 + len(rows)) / (1 + seen)).astype(np.float32) + 1
    idf[BUCKETS:] = extra_weight * idf[:BUCKETS].mean()
    x = rows * idf
    rng = np.random.default_rng(seed)
    rank = min(dims, *x.shape)
    q, _ = np.linalg.qr(x @ rng.normal(size=(x.shape[1], min(rank + 16, x.shape[1]))).astype(np.float32))
    for _ in range(2):
        q, _ = np.linalg.qr(x.T @ q)
        q, _ = np.linalg.qr(x @ q)
    _, _, vt = np.linalg.svd(q.T @ x, full_matrices=False)
    project = np.ascontiguousarray(vt[:rank].T, np.float32)
    return Neighbours(idf, project, _unit(x @ project), np.where(labels > 0, 1, 0).astype(np.float32), k, prior)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def vote(model: Neighbours, rows: np.ndarray) -> np.ndarray:
    """Share of label 1 among the k most similar labelled vectors, each weighted by its similarity."""
    near = _unit((rows * model.idf) @ model.project) @ model.vectors.T
    k = min(model.k, near.shape[1])
    top = np.argpartition(near, near.shape[1] - k, 1)[:, near.shape[1] - k :]
    weight = np.maximum(np.take_along_axis(near, top, 1), 0) ** 8
    good = (weight * model.labels[top]).sum(1) + 1e-6 * model.prior
    return good / (weight.sum(1) + 1e-6)


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int,
                  held_out_mod: int, held_out_rest: int) -> tuple[np.ndarray, np.ndarray]:
    """Term rows of at most ``per_class`` documents of each class (the smallest hashes of their keys), from the rows
    outside the held-out fold only."""
    able = labels.where(F.coalesce(crc_mod(F.col(id_col), held_out_mod) != held_out_rest, F.lit(False)) & F.col(label_col).isin(0, 1))
    one = able.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_label"))
    pick = [one.where(F.col("_label") == c).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for c in (0, 1)]
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        F.broadcast(pick[0].union(pick[1])), "_id")  # at most 2 x per_class rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(fold=False)
        for b in batches:
            x = term_rows(as_bytes(b.column(1)), hasher).astype(np.float16)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(2).cast(pa.int32()),
                                              pa.array([r.tobytes() for r in x], pa.binary())], ["id", "label", "x"])

    got = sorted((r.id, r.label, bytes(r.x)) for r in rows.select("_id", "_text", "_label").mapInArrow(
        run, "id long, label int, x binary").collect())
    x = np.array([np.frombuffer(b, np.float16) for _, _, b in got], np.float32).reshape(len(got), BUCKETS + EXTRA)
    return x, np.array([c for _, c, _ in got])


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", per_class: int = 1500, held_out_mod: int = 4, held_out_rest: int = 2,
             threshold: float = 0.7) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every document.

    Learns from a bounded sample (``per_class`` documents of each label,
    outside the held-out fold); about 2 x per_class vectors of 64 numbers go
    to the tasks.  Every whole text is projected and compared with all of
    them in blocks.  Null and empty texts have no direction and no neighbours:
    they score the prior, 0.5.  Without labels all texts do.  Repeated rows
    score alike; only the id and the text of a row are read."""
    x, y = labelled_rows(docs, labels, id_col, text_col, label_col, per_class, held_out_mod, held_out_rest)
    model = fit_neighbours(x, y) if len(x) else None
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(fold=False)
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                score = (vote(model, term_rows(as_bytes(b.column(1)), hasher)) if model
                         else np.full(b.num_rows, 0.5))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.clip(score, 0, 1), pa.float64())],
                                                 ["doc_id", "score"])

    scored = docs.select(id_col, text_col).mapInArrow(run, f"doc_id {id_type}, score double")
    held = F.coalesce(crc_mod(F.col("doc_id"), held_out_mod) == held_out_rest, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))

"""Language identification: a byte convolutional network trained in numpy, applied to fixed-length windows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import crc_mod

PAD = 256
WIDTHS = (2, 3, 4)


@dataclass
class ByteCnn:
    """Embedding, one filter bank per width, a dense layer; ``labels`` in output order."""

    labels: list[str]
    window: int
    embed: np.ndarray  # (257, E)
    filters: dict[int, np.ndarray]  # width -> (width, E, F)
    bias: dict[int, np.ndarray]
    dense: np.ndarray  # (len(WIDTHS) * F, K)
    dense_bias: np.ndarray

    def tables(self) -> dict[int, list[np.ndarray]]:
        """Each filter bank as lookup tables: a width is a sum of its offsets' tables, two offsets to a table
        of byte pairs."""
        out = {}
        for w, f in self.filters.items():
            one = [(self.embed @ f[k]).astype(np.float32) for k in range(w)]
            pairs = [(one[k][:, None, :] + one[k + 1][None, :, :]).reshape(-1, f.shape[2]) for k in range(0, w - 1, 2)]
            out[w] = pairs + ([one[-1]] if w % 2 else [])
        return out


def train(windows: list[bytes], labels: list[str], window: int = 128, embed: int = 8, filters: int = 16, steps: int = 900,
          batch: int = 96, seed: int = 7) -> ByteCnn:
    """Adam on the cross-entropy of balanced batches; a third of the windows is cut to a random length, so that
    short texts are learnt too.  Fixed seed: the same input gives the same network."""
    rng = np.random.default_rng(seed)
    names = sorted(set(labels))
    y_all = np.array([names.index(x) for x in labels])
    x_all = np.full((len(windows), window), PAD, np.int64)
    size = np.array([min(len(x), window) for x in windows])
    for i, x in enumerate(windows):
        x_all[i, : size[i]] = np.frombuffer(x[:window], np.uint8)
    members = [np.flatnonzero(y_all == k) for k in range(len(names))]
    par = {"e": rng.normal(0, 0.5, (257, embed)).astype(np.float32)}
    for w in WIDTHS:
        par[f"f{w}"] = rng.normal(0, 1 / np.sqrt(w * embed), (w, embed, filters)).astype(np.float32)
        par[f"b{w}"] = np.zeros(filters, np.float32)
    par["d"] = rng.normal(0, 0.2, (len(WIDTHS) * filters, len(names))).astype(np.float32)
    par["db"] = np.zeros(len(names), np.float32)
    par["e"][PAD] = 0
    m = {k: np.zeros_like(v) for k, v in par.items()}
    v2 = {k: np.zeros_like(v) for k, v in par.items()}
    for step in range(1, steps + 1 if len(names) > 1 else 1):
        y = rng.integers(0, len(names), batch)
        rows = np.array([rng.choice(members[k]) for k in y])
        x = x_all[rows].copy()
        keep = np.where(rng.random(batch) < 0.35, rng.integers(4, 48, batch), window)
        x[np.arange(window)[None, :] >= keep[:, None]] = PAD
        emb = par["e"][x]
        feats, best = [], {}
        for w in WIDTHS:
            patch = np.lib.stride_tricks.sliding_window_view(emb, w, axis=1).transpose(0, 1, 3, 2)
            patch = patch.reshape(batch, window - w + 1, w * embed)
            act = patch @ par[f"f{w}"].reshape(w * embed, filters) + par[f"b{w}"]
            best[w] = act.argmax(1), patch
            feats.append(np.take_along_axis(act, best[w][0][:, None, :], 1)[:, 0])
        h = np.concatenate(feats, 1)
        a = np.maximum(h, 0)
        z = a @ par["d"] + par["db"]
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(batch), y] -= 1
        p /= batch
        grad = {"d": a.T @ p, "db": p.sum(0), "e": np.zeros_like(par["e"])}
        da = (p @ par["d"].T) * (h > 0)
        for n, w in enumerate(WIDTHS):
            at, patch = best[w]
            g = da[:, n * filters : (n + 1) * filters]
            chosen = np.take_along_axis(patch, at[:, :, None], 1)  # (batch, F, w * E)
            grad[f"f{w}"] = np.einsum("bfe,bf->ef", chosen, g).reshape(w, embed, filters)
            grad[f"b{w}"] = g.sum(0)
            back = g[:, :, None] * par[f"f{w}"].reshape(w * embed, filters).T[None]  # (batch, F, w * E)
            seen = np.take_along_axis(x, (at[:, :, None] + np.arange(w)).reshape(batch, -1), 1)
            np.add.at(grad["e"], seen.reshape(-1), back.reshape(-1, embed))
        grad["e"][PAD] = 0
        rate = 0.01 * (1 - 0.9 * step / steps)
        for k, g in grad.items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v2[k] = 0.999 * v2[k] + 0.001 * g * g
            par[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)
    return ByteCnn(names, window, par["e"], {w: par[f"f{w}"] for w in WIDTHS}, {w: par[f"b{w}"] for w in WIDTHS},
                   par["d"], par["db"])


def window_scores(model: ByteCnn, tables: dict[int, list[np.ndarray]], buf: np.ndarray) -> np.ndarray:
    """Softmax of each row of ``buf`` (n, window) of byte codes."""
    feats = []
    pair = buf[:, :-1].astype(np.int32) * 257 + buf[:, 1:]
    for w in WIDTHS:
        act, k = None, 0
        for t in tables[w]:
            paired = len(t) > 257
            codes = (pair if paired else buf)[:, k : k + model.window - w + 1]
            got = t[codes]
            act = got if act is None else np.add(act, got, out=act)
            k += 2 if paired else 1
        feats.append(act.max(1) + model.bias[w])
    z = np.maximum(np.concatenate(feats, 1), 0) @ model.dense + model.dense_bias
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def score_texts(model: ByteCnn, tables: dict[int, list[np.ndarray]], texts: list[bytes], rows: int = 512) -> np.ndarray:
    """Class probabilities of each text: the mean over all its windows, weighted by their bytes."""
    n, w = len(texts), model.window
    total, weight = np.zeros((n, len(model.labels))), np.zeros(n)
    count = [max(1, -(-len(t) // w)) for t in texts]
    owner = np.repeat(np.arange(n), count)
    size = np.array([min(w, len(t) - k * w) for t, c in zip(texts, count, strict=True) for k in range(c)])
    flat = np.concatenate([np.frombuffer(t, np.uint8) for t in texts]) if n else np.zeros(0, np.uint8)
    start = np.concatenate(([0], np.cumsum(size)))
    for at in range(0, len(owner), rows):
        end = min(at + rows, len(owner))
        s = size[at:end]
        buf = np.full((end - at, w), PAD, np.int16)
        buf[np.arange(w)[None, :] < s[:, None]] = flat[start[at] : start[end]]
        p = window_scores(model, tables, buf)
        np.add.at(total, owner[at:end], p * s[:, None])
        np.add.at(weight, owner[at:end], s)
    return total / np.maximum(weight, 1)[:, None]


def training_windows(df: DataFrame, id_col: str, text_col: str, lang_col: str, max_docs: int, window: int,
                     per_doc: int) -> tuple[list[bytes], list[str]]:
    """At most ``max_docs`` documents of each language (the smallest hashes of their keys) and ``per_doc`` windows
    of each, at places drawn by the key.  Only ids are ordered; the texts of the chosen rows alone reach the driver,
    as windows."""
    known = df.where(F.col(lang_col).isNotNull())
    langs = [r[0] for r in known.select(lang_col).distinct().collect()]
    chosen = None
    for lang in langs:
        part = (known.where(F.col(lang_col) == lang).select(F.col(id_col).alias("_id")).distinct()
                .orderBy(F.xxhash64("_id"), "_id").limit(max_docs))
        chosen = part if chosen is None else chosen.union(part)
    if chosen is None:
        return [], []
    rows = known.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang")).join(
        F.broadcast(chosen.distinct()), "_id")  # at most max_docs x languages ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, lang = [], []
            for i, t, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                t = (t or "").lower().encode()
                if not t:
                    continue
                rng = np.random.default_rng(int(i) & 0xFFFFFFFF)
                for at in rng.integers(0, max(1, len(t) - window + 1), per_doc if len(t) > window else 1):
                    out.append(t[at : at + window])
                    lang.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(lang, pa.string())], ["w", "lang"])

    got = sorted((bytes(r.w), r.lang) for r in rows.mapInArrow(cut, "w binary, lang string").collect())
    return [x for x, _ in got], [x for _, x in got]


def identify(df: DataFrame, model: ByteCnn | None, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of every row, with ``lang_pred`` and ``lang_score``.

    Null, empty and letterless texts are ``und`` with score 0; so is all text
    when there was nothing to learn from (``model`` None).  Whole texts are
    scored in windows; ties between languages go to the first by name.
    Repeated rows are scored alike; other columns are ignored.  The network (a
    few hundred kB, fixed by its parameters) goes to the tasks with the code."""
    rows = df.select(F.col(text_col).alias("_text"), F.lit("").alias("_lang"), F.lit(0.0).alias("_score"), *keep)
    out = rows.select("_lang", "_score", *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.tables() if model else {}
        for big in batches:
            for at in range(0, big.num_rows, 512):
                b = big.slice(at, 512)
                texts = [x or "" for x in b.column(0).to_pylist()]
                letters = np.array([x[:64].isalpha() or any(map(str.isalpha, x)) for x in texts], bool)
                if model:
                    p = score_texts(model, tables, [x.lower().encode() for x in texts])
                    best, top = [model.labels[k] for k in p.argmax(1)], p.max(1)
                else:
                    best, top, letters = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x if ok else "und" for x, ok in zip(best, letters, strict=True)], pa.string()),
                     pa.array(np.where(letters, np.clip(top, 0, 1), 0.0), pa.float64()), *b.columns[3:]],
                    ["_lang", "_score", *keep])

    return rows.mapInArrow(run, out.schema).select(*keep, F.col("_lang").alias("lang_pred"), F.col("_score").alias("lang_score"))


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = 2000,
        window: int = 128, per_doc: int = 2, held_out_mod: int = 5) -> ByteCnn | None:
    """Learn from rows whose crc32(id) mod ``held_out_mod`` isn't 0; None without any labelled text."""
    learn = df.where(F.coalesce(crc_mod(F.col(id_col), held_out_mod) != 0, F.lit(False)))
    windows, labels = training_windows(learn, id_col, text_col, lang_col, max_docs, window, per_doc)
    return train(windows, labels, window) if windows else None


def identify_documents(df: DataFrame) -> DataFrame:
    """Fit on the learnable documents, then label every document: doc_id, held_out, lang_pred, score."""
    out = identify(df, fit(df))
    return out.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
                      "lang_pred", F.col("lang_score").alias("score"))

"""Helpers shared by the operators: tables, written intermediates, word hashes, connected components."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.session import shared_path


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def crc_mod(key: Column, m: int) -> Column:
    """crc32 of the key as text, modulo ``m`` (null for a null key)."""
    return F.pmod(F.crc32(key.cast("string")), F.lit(m))


class Scratch:
    """Written intermediate tables in the shared folder, deleted as soon as nothing reads them.

    ``keep`` writes a frame as Parquet and reads it back: the lineage is cut
    and a lost executor re-reads files instead of recomputing.  ``result``
    checkpoints the operator's (small) result reliably and deletes every
    table kept before, so a finished operator leaves only its result, which
    Spark's cleaner removes with the frame."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = shared_path(spark, f"llm-{uuid.uuid4().hex}")

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Let Spark's cleaner drop the shuffle files of frames that nothing refers to any more."""
        gc.collect()
        self.spark._jvm.System.gc()

    def result(self, df: DataFrame) -> DataFrame:
        out = df.checkpoint()
        self.drop()
        return out


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """One output batch per Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(run, schema)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of every value; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


#: 64-bit words of a key filter: 2**25 bits, 8 MB to every task, whatever the number of keys.
FILTER_WORDS = 1 << 19


def near_rows(big: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``big`` whose ``key`` stands in ``keys(key)``, and a few others (a null key never).

    A bit for each key is set in a filter of fixed size, which goes to the
    scan of ``big``, so of the other rows only few enter the shuffle of an
    exact join that follows.  With many more keys than bits the filter lets
    all through, and the join is as it was."""
    word = F.expr(f"pmod(shiftrightunsigned(xxhash64(`{key}`), 6), {FILTER_WORDS}L)")
    bit = F.expr(f"shiftleft(1L, CAST(xxhash64(`{key}`) & 63 AS INT))")
    marks = keys.where(F.col(key).isNotNull()).groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    near = big.where(F.col(key).isNotNull()).withColumn("_word", word).join(F.broadcast(marks), "_word")
    return near.where(F.col("_bits").bitwiseAND(bit) != 0).drop("_word", "_bits")


def rows_of(big: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``big`` whose ``key`` stands in ``keys(key)`` (a left semi join behind the filter of ``near_rows``; a null
    key matches nothing)."""
    # an inner join with distinct keys: a semi join would be moved below the filter
    return near_rows(big, keys, key).join(keys.select(key).distinct().hint("merge"), key)


# ---------------------------------------------------------------- word hashes

CHUNK_BYTES = 4 << 20
MASK = (1 << 64) - 1


def _random_u64(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, n, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit words: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class WordHasher:
    """64-bit hashes of the words of many texts at once.

    A byte's value is a random 64-bit number; a word's hash is the polynomial
    of its bytes' values modulo 2**64, taken as a difference of running sums,
    then mixed.  Equal words have equal hashes in every task and job."""

    def __init__(self, separators: bytes = b" \t\n\r\x0b\x0c", fold: bool = True):
        table = np.arange(256, dtype=np.uint8)
        if fold:
            table[65:91] += 32
        self.value = _random_u64(256, 11)[table]
        self.separator = np.zeros(256, bool)
        self.separator[list(separators)] = True
        self.base = 0x9E3779B97F4A7C15
        self.inverse = pow(self.base, -1, 1 << 64)
        self.power = self.unpower = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            def powers(b: int) -> np.ndarray:
                out = np.full(n, b, np.uint64)
                out[0] = 1
                return np.multiply.accumulate(out)
            self.power, self.unpower = powers(self.base), powers(self.inverse)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in order, and bounds: text i owns words bounds[i]:bounds[i + 1]."""
        buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        self._grow(len(buf) + 1)
        gap = self.separator[buf]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edge = np.concatenate(([0], edge))
        start, end = edge[0::2], edge[1::2]
        total = np.empty(len(buf) + 1, np.uint64)
        total[0] = 0
        np.cumsum(self.value[buf] * self.power[: len(buf)], out=total[1:])
        words = mix((total[end] - total[start]) * self.unpower[start] + (end - start).astype(np.uint64))
        ends = np.cumsum([len(t) + 1 for t in texts])
        return words, np.concatenate(([0], np.searchsorted(start, ends)))


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about ``limit`` bytes (a longer text is a range of its own)."""
    i, size = 0, 0
    for j, t in enumerate(texts):
        if j > i and size + len(t) > limit:
            yield i, j
            i, size = j, 0
        size += len(t)
    if texts:
        yield i, len(texts)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; fewer words make one shingle, none makes none."""
    if not len(words):
        return words
    if len(words) < n:
        h = np.zeros(1, np.uint64)
        for w in words:
            h = mix(h + w)
        return mix(h + np.uint64(len(words)))
    h = words[: len(words) - n + 1]
    for k in range(1, n):
        h = mix(h) + words[k : len(words) - n + 1 + k]
    h = np.sort(mix(h))
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


# ---------------------------------------------------------------- components

def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """``(v, component_id)`` for every vertex of ``edges(a, b)``: the smallest vertex reachable.

    Every round takes the smallest label among a vertex and its neighbours,
    then replaces a label by its label's label (pointer jumping), so a path of
    length L takes about log L rounds; it ends when no label changes.  All
    steps are joins and partially aggregated minima; a hub's edges can be
    split by skew-join handling.  Nothing is collected but the change count."""
    both = scratch.keep(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
                        .toDF("v", "u"), f"{name}-edges")
    label = scratch.keep(both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("l")), f"{name}-0")
    rounds = 0
    while True:
        rounds += 1
        near = both.join(label.toDF("u", "lu"), "u").groupBy("v").agg(F.min("lu").alias("lu"))
        step = label.join(near, "v").select("v", F.col("l").alias("old"), F.least("l", "lu").alias("l"))
        jump = step.join(label.toDF("l", "ll"), "l", "left").select(
            "v", F.least("l", F.coalesce("ll", "l")).alias("l"), "old")
        now = scratch.keep(jump, f"{name}-{rounds}")
        changed = now.where("l <> old").limit(1).count()
        scratch.drop(f"{name}-{rounds - 1}")
        label = now.select("v", "l")
        if not changed:
            scratch.drop(f"{name}-edges")
            return label.toDF("v", "component_id")

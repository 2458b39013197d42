"""Embedding near-duplicates by sorted projection passes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import Scratch, components

BITS = 64
WINDOW = 128
BLOCK = 256
#: Vectors of a component that are compared at a time when links are counted.
TILE = 512


def passes_for(rows: int, cosine: float, miss: float, window: int = WINDOW) -> int:
    """Passes after which a pair at the bound is missed with probability ``miss`` at most.

    Two vectors at this cosine agree in a random hyperplane's sign with
    probability q; of ``rows`` sorted codes about ``window`` share the first
    log2(rows / window) bits, so a pass finds the pair with q to that power."""
    q = 1 - math.acos(cosine) / math.pi
    found = q ** max(1.0, math.log2(max(2, rows) / window))
    return max(8, math.ceil(math.log(miss) / math.log(1 - found)))


def _planes(dim: int, number: int) -> np.ndarray:
    return np.random.default_rng([dim, number, 17]).normal(size=(dim, BITS))


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)  # no overflow of the squares
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def _matrices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, float64 matrix) for each vector length of a batch."""
    lists = batch.column(column)
    size = lists.value_lengths().to_numpy()
    for dim in np.unique(size):
        at = np.flatnonzero(size == dim)
        flat = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield at, flat.astype(np.float64).reshape(len(at), dim)


def _coded(classes: DataFrame, passes: int) -> DataFrame:
    """A row of every vector for each pass, with the pass's sign bits as a sortable key."""
    vector_type = classes.schema["vec"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for big in batches:
            for start in range(0, big.num_rows, 2000):
                b = big.slice(start, 2000)
                for at, x in _matrices(b, 1):
                    rows = b.take(pa.array(at))
                    for k in range(passes):
                        if (x.shape[1], k) not in planes:
                            planes[x.shape[1], k] = _planes(x.shape[1], k)
                        code = np.packbits(x @ planes[x.shape[1], k] >= 0, axis=1)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), k, np.int32)), pa.array(np.full(len(at), x.shape[1], np.int32)),
                             pa.array([c.tobytes() for c in code], pa.binary()), rows.column(0), rows.column(1)],
                            ["pass", "dim", "code", "id", "vec"])

    return classes.select("id", "vec").mapInArrow(run, f"pass int, dim int, code binary, id long, vec {vector_type}")


def _windows(ordered: DataFrame, cosine: float) -> DataFrame:
    """Links that connect the vectors of every window: for each group of a window that verified pairs hold together,
    its members to its smallest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compare(key, ids, vectors):
            a, b = [], []
            for at in range(0, len(ids), BLOCK):
                end = min(len(ids), at + BLOCK + WINDOW)
                near = vectors[at:end] @ vectors[at:end].T >= cosine
                near &= (key[at:end, None, :] == key[None, at:end, :]).all(2)
                np.fill_diagonal(near, True)
                if near.sum() == end - at:
                    continue
                low = np.arange(end - at)
                while True:  # smallest position reachable by verified pairs
                    new = np.where(near, low[None, :], end - at).min(1)
                    new = new[new]
                    if (new == low).all():
                        break
                    low = new
                own = ids[at:end]
                for g in np.unique(low[low != np.arange(end - at)]):
                    member = own[low == g]
                    a.append(np.full(len(member) - 1, member.min()))
                    b.append(member[member != member.min()])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

        wait: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for big in batches:
            for start in range(0, big.num_rows, 4096):
                b = big.slice(start, 4096)
                key_all = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], 1)
                for at, x in _matrices(b, 4):
                    dim = x.shape[1]
                    part = key_all[at], b.column(3).to_numpy()[at], _unit(x)
                    if dim in wait:
                        part = tuple(np.concatenate(z) for z in zip(wait[dim], part, strict=True))
                    yield from compare(*part)
                    wait[dim] = tuple(z[-WINDOW:] for z in part)

    return ordered.mapInArrow(run, "a long, b long")


def _link_counts(members: DataFrame, cosine: float) -> DataFrame:
    """``(id, links)``: for each vector the members' rows at or above the cosine, itself left out.

    Links join vectors of one component only.  A component is dealt by hash
    into tiles of about ``TILE`` vectors and every pair of tiles is one group,
    so no group grows with the component; small components share groups."""
    sized = members.groupBy("component").agg(F.count("*").alias("size")).select(
        "component", F.ceil(F.col("size") / TILE).cast("int").alias("tiles"))
    tiled = members.join(sized, "component").withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    dealt = tiled.select("*", other).select(
        "component", "id", "vec", "rows", "tile", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"),
        F.when(F.col("tiles") == 1, F.pmod(F.xxhash64("component"), F.lit(4096))).otherwise(F.col("component")).alias("home"),
        (F.col("tiles") == 1).alias("shared"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        ids, links = [], []
        for _, part in frame.groupby("component", sort=False):
            if part["lo"].iloc[0] == part["hi"].iloc[0]:
                left = right = part
            else:
                left, right = part[part["tile"] == part["lo"]], part[part["tile"] == part["hi"]]
            for (x, y) in ((left, right),) if left is right else ((left, right), (right, left)):
                if len(x) and len(y):
                    # vectors of one component have one length
                    u, v = (_unit(np.stack(z["vec"].to_numpy()).astype(np.float64)) for z in (x, y))
                    hit = u @ v.T >= cosine
                    if x is y:
                        np.fill_diagonal(hit, False)
                    ids.append(x["id"].to_numpy())
                    links.append(hit @ y["rows"].to_numpy())
        return pd.DataFrame({"id": np.concatenate(ids), "links": np.concatenate(links)}) if ids else pd.DataFrame(
            {"id": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64")})

    counted = dealt.groupBy("shared", "home", "lo", "hi").applyInPandas(run, "id long, links long")
    return counted.groupBy("id").agg(F.sum("links").alias("links"))


def near_vectors(df: DataFrame, cosine: float = 0.95, miss: float = 1e-4, id_col: str = "vec_id",
                 vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row.

    Equal vectors form a class, of which one row is compared.  Each pass sorts
    all classes by random sign bits and compares every vector with its
    neighbours in order, in double precision; the number of passes follows
    from the number of vectors and the allowed ``miss`` of a pair at the bound.
    Passes are range-partitioned by code and id, so equal codes in any number
    spread over tasks (a pair cut apart by a partition end in one pass is left
    to the others).  Links are then counted inside each component, tile by
    tile.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing, as do vectors of different lengths; a null id links
    with nothing, has no component and is kept.  Repeated rows of one id are
    linked rows of one vertex.  Other columns are ignored; an empty table
    gives no rows."""
    spark = df.sparkSession
    scratch = Scratch(spark)
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = (F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & finite
              & F.exists("vec", lambda x: x != 0))
    keyed = rows.select("vec_id", "vec", F.coalesce(usable, F.lit(False)).alias("usable"),
                        F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), F.reverse("vec")).alias("h2"))
    copies = keyed.where("usable").groupBy("h1", "h2").agg(F.min("vec_id").alias("id"), F.count("*").alias("rows"))
    # the class's vector is its smallest row's
    classes = scratch.keep(
        keyed.where("usable").join(copies.withColumnRenamed("id", "vec_id"), ["h1", "h2", "vec_id"])
        .dropDuplicates(["h1", "h2"]).select("h1", "h2", F.col("vec_id").alias("id"), "vec", "rows"), "classes")
    n = classes.count()
    order = ["pass", "dim", "code", "id"]
    coded = _coded(classes, passes_for(n, cosine, miss))
    edges = scratch.keep(_windows(coded.repartitionByRange(*order).sortWithinPartitions(*order), cosine).distinct(), "edges")
    label = scratch.keep(components(edges, scratch), "label")
    members = classes.join(label.toDF("id", "component"), "id").select("component", "id", "vec", "rows")
    links = scratch.keep(_link_counts(members, cosine), "links")
    info = (classes.select("h1", "h2", "id", "rows").join(label.toDF("id", "component"), "id", "left")
            .join(links, "id", "left")
            .select("h1", "h2", F.coalesce("component", "id").alias("component"),
                    (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links"), F.lit(True).alias("usable")))
    out = keyed.select("vec_id", "h1", "h2", "usable").join(info, ["h1", "h2", "usable"], "left")
    own = F.when(F.col("vec_id").isNotNull(), F.least(F.coalesce("component", "vec_id"), "vec_id"))
    return scratch.result(out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                                     own.alias("component_id"), F.coalesce(own == F.col("vec_id"), F.lit(True)).alias("kept")))

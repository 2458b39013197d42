"""Centroid clustering: Lloyd rounds on integer vectors, pruned by ns-bounds over a retained centroid history.

Every vector keeps, for each centroid, its distance at the round of the last
evaluation.  Against the centroid of now, that bound is loosened by the norm
of the centroid's *total* displacement since that round, read from the
history of all rounds, not by the sum of the per-round drifts.  A centroid
whose loosened bound does not rule it out is evaluated exactly.  Bounds are
rounded outwards, so results equal those of full rounds.

Defined results: a row counts where its vector has exactly ``dims``
components, none null, NaN or infinite; other rows and an empty table give no
row.  Repeated rows are vectors of their own.  A null ``vec_id`` hashes as an
empty id.  Equal hashes of repeated ids are ordered by the vectors.  With
fewer than ``k`` vectors there are as many centroids.  Components saturate at
64 bits before anything is computed, distances and sums of them in the
result.  Ties of distance go to the smaller centroid number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import Scratch

LONG_MAX = (1 << 63) - 1
#: Components up to this size have squared distances that fit in 64 bits; beyond, Python integers are used.
SMALL = 1 << 26
#: Far more than the rounding of a bound kept as a 32-bit float.
SLACK = 1e-6


def exact(x: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """``x`` in a type in which squared distances to ``others`` are exact."""
    wide = any(len(a) and (a.dtype == object or int(a.max()) > SMALL or int(a.min()) < -SMALL) for a in (x, *others))
    return x.astype(object) if wide else x


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return (d * d).sum(-1)


def root(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64))


def displacements(history: list[np.ndarray]) -> np.ndarray:
    """[round, centroid]: norm of the total displacement from that round's centroid to the last one."""
    return np.stack([root(squared(exact(history[-1], c), c)) for c in history])


def assign_full(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (the smaller number on ties) and the distances to all."""
    d = np.stack([squared(x, c) for c in centroids], 1)
    return d.argmin(1), root(d)


def assign_bounded(x: np.ndarray, a: np.ndarray, bound: np.ndarray, seen: np.ndarray, history: list[np.ndarray],
                   moved: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The same from the last assignment, distances at last evaluation and their rounds; and the evaluations made."""
    now, centroids, k = len(history) - 1, history[-1], bound.shape[1]
    rows = np.arange(len(x))
    a, bound, seen = a.copy(), bound.copy(), seen.copy()
    drift = moved[seen, np.arange(k)]
    low = bound * (1 - SLACK) - drift * (1 + SLACK)
    high = bound[rows, a] * (1 + SLACK) + drift[rows, a] * (1 + SLACK)
    low[rows, a] = np.inf
    doubt = np.flatnonzero((low <= high[:, None]).any(1))
    own = squared(x[doubt], centroids[a[doubt]])
    bound[doubt, a[doubt]], seen[doubt, a[doubt]] = root(own), now
    high[doubt] = root(own) * (1 + SLACK)
    i, j = np.nonzero(low[doubt] <= high[doubt, None])
    other = squared(x[doubt[i]], centroids[j])
    bound[doubt[i], j], seen[doubt[i], j] = root(other), now
    best = {}
    for p, c, d in zip(i.tolist(), j.tolist(), other.tolist()):
        if (d, c) < best.get(p, (own[p], a[doubt[p]])):
            best[p] = (d, c)
    for p, (_, c) in best.items():
        a[doubt[p]] = c
    return a, bound, seen, len(doubt) + len(i)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel(), kind))


def integer_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """``(vec_id, v)`` of the rows that count."""
    e = F.col("embedding")
    sound = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.select("vec_id", e).where((F.size(e) == dims) & sound)
            .select("vec_id", F.transform(e, lambda x: F.floor(x.cast("double") * scale)).alias("v")))


def first_centroids(points: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors of the smallest hashes; only k rows reach the driver."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    return [r.v for r in points.orderBy(F.sha2(name, 256), "v").limit(k).collect()]


def _assign(points: DataFrame, history: list[np.ndarray], dims: int) -> DataFrame:
    """One assignment pass: ``(vec_id, v, a, bound, seen)`` from points or from the state of the round before."""
    moved = displacements(history)
    now, k = len(history) - 1, len(history[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = exact(_matrix(b["v"], dims), *history)
            if now:
                a, bound, seen, _ = assign_bounded(x, b["a"].to_numpy(), _matrix(b["bound"], k).astype(np.float64),
                                                   _matrix(b["seen"], k), history, moved)
            else:
                a, bound = assign_full(x, history[0])
                seen = np.zeros_like(bound, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [b["vec_id"], b["v"], pa.array(a, pa.int32()), _lists(bound, pa.float32()), _lists(seen, pa.int32())],
                names=["vec_id", "v", "a", "bound", "seen"])

    kind = points.schema["vec_id"].dataType.simpleString()
    return points.mapInArrow(run, f"vec_id {kind}, v array<bigint>, a int, bound array<float>, seen array<int>")


def _means(state: DataFrame, centroids: np.ndarray, dims: int) -> np.ndarray:
    """Exact floors of the componentwise means: each task sums its vectors, Spark sums the tasks, k * dims numbers return."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dims), object), np.zeros(k, np.int64)
        for b in batches:
            x, a = exact(_matrix(b["v"], dims)), b["a"].to_numpy()
            for c in np.unique(a):
                mine = x[a == c]
                total[c] += mine.sum(0)
                n[c] += len(mine)
        full = np.flatnonzero(n)
        if len(full):
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array(n[full]),
                 pa.array([[str(s) for s in total[c]] for c in full], pa.list_(pa.string()))], names=["a", "n", "s"])

    parts = state.select("v", "a").mapInArrow(run, "a int, n bigint, s array<string>")
    sums = (parts.select("a", "n", F.posexplode("s").alias("i", "x")).groupBy("a", "i")
            .agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("s")).collect())
    out = centroids.astype(object)
    for r in sums:
        out[r.a, r.i] = int(r.s) // r.n
    return out.astype(np.int64)


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every vector that counts.

    A round reads and writes the state once, without a shuffle; the driver
    sees k centroids a round, and tasks get all rounds' centroids."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    points = integer_vectors(vectors, dims, scale)
    start = first_centroids(points, k, seed)
    history = [np.array(start, np.int64).reshape(-1, dims)]
    state = points
    for r in range(rounds if start else 0):
        state = scratch.keep(_assign(state, history, dims), f"state-{r}")
        if r:
            scratch.drop(f"state-{r - 1}")
        history.append(_means(state, history[-1], dims))
    if start:
        state = _assign(state, history, dims)
    last = history[-1]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a = b["a"].to_numpy()
            d = squared(exact(_matrix(b["v"], dims), last), last[a])
            yield pa.RecordBatch.from_arrays(
                [b["vec_id"], b["a"], pa.array(np.minimum(d, LONG_MAX).astype(np.int64))], names=["vec_id", "cluster", "distance"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    if not start:
        found = points.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    else:
        found = scratch.keep(state.select("vec_id", "v", "a").mapInArrow(finish, f"vec_id {kind}, cluster int, distance bigint"), "found")
    shas = [(c, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(last.tolist())]
    totals = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    both = sum(int(r.s) for r in totals)
    sums = {r.cluster: int(r.s) for r in totals}
    table = spark.createDataFrame(
        [(c, min(sums.get(c, 0), LONG_MAX), min(both, LONG_MAX), sha) for c, sha in shas],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    out = found.join(F.broadcast(table), "cluster")  # k rows
    return scratch.result(out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def sql(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1) -> str:
    """The same by full rounds: one table expression for each assignment and each set of means."""
    near = "list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS (SELECT rid, vec_id, v, arg_min(c, d * {k} + c) AS c, min(d) AS d
  FROM (SELECT p.rid, p.vec_id, p.v, c.c, ({near})::HUGEINT AS d FROM points p, cent{r} c) GROUP BY rid, vec_id, v)""")
        if r < rounds:
            steps.append(f"""sum{r} AS (SELECT c, i, sum(v[i])::HUGEINT AS s, count(*)::HUGEINT AS n
  FROM near{r}, range(1, {dims + 1}) t(i) GROUP BY c, i),
mean{r} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM sum{r} GROUP BY c),
cent{r + 1} AS (SELECT c.c, coalesce(m.v, c.v) AS v FROM cent{r} c LEFT JOIN mean{r} m ON m.c = c.c)""")
    return f"""WITH points AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::HUGEINT) AS v
  FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dims}),
cent0 AS (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM points ORDER BY h, v LIMIT {k})),
{''',
'''.join(steps)},
shas AS (SELECT c, sha256(array_to_string(list_transform(v, lambda x: x::VARCHAR), ',')) AS centroid_sha256 FROM cent{rounds})
SELECT n.vec_id, n.c::INT AS cluster, n.d::BIGINT AS distance,
  sum(n.d) OVER (PARTITION BY n.c)::BIGINT AS cluster_inertia, sum(n.d) OVER ()::BIGINT AS inertia, s.centroid_sha256
FROM near{rounds} n JOIN shas s ON s.c = n.c"""

"""Feature correlation, distance and clustering.

Correlations are computed over all rows: a task's Arrow batches become packed
moments of all column pairs, merged up a tree of tasks.  Everything after that works on the pair table, whose size is
features squared (never rows).  Density clustering (DBSCAN on distances) is
connected components over core features, found by repeated min-label
joins; each round is checkpointed to the shared folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnkit.functions.scalar import col_
from churnkit.operators.packed import SCHEMA, merge_tree, packed, unpacked
from churnkit.operators.util import materialize, small_side

F1, F2, STAT = "feature1", "feature2", "statistic"


def feature_positions(cols: Sequence[str], spark) -> DataFrame:
    return spark.createDataFrame([(c, i) for i, c in enumerate(cols)], "feature string, pos int")


def corr_pairs(df: DataFrame, cols: Sequence[str], method: str = "blocks") -> DataFrame:
    """Pearson correlation of every column pair (i < j in column order),
    pairwise complete: a row counts for a pair when both values exist (NaN
    counts as missing).  Null where a column is constant over the pair's rows.
    ``method``: ``blocks`` (Arrow partial moments, any width) or ``agg``
    (Spark's own aggregates over a written table, for a few columns)."""
    cols = list(cols)
    if method == "blocks":
        return corr_pairs_blocks(df, cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    num = df.select(*[F.nanvl(col_(c).cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])

    if not pairs:
        return df.sparkSession.createDataFrame([], f"{F1} string, {F2} string, {STAT} double")
    # rows that have values in the same columns share their moments: a mean and a variance for each column, a covariance for
    # each pair; few enough in an aggregation that Spark compiles it
    base = materialize(num.select("*", F.concat(*[F.when(F.col(c).isNotNull(), "1").otherwise("0") for c in num.columns]).alias("_there")))

    def grouped(items: list, size: int, aggs, fields) -> DataFrame:
        parts = [base.groupBy("_there").agg(F.count(F.lit(1)).alias("_n"), *[a for x in items[i : i + size] for a in aggs(x)]).select(
            "_there", "_n", F.explode(F.array(*[F.struct(*fields(x)) for x in items[i : i + size]])).alias("r")).select("_there", "_n", "r.*")
            for i in range(0, len(items), size)]
        return reduce(DataFrame.unionByName, parts)

    single = materialize(grouped(
        num.columns, 12, lambda c: (F.avg(c).alias(f"m_{c}"), F.var_pop(c).alias(f"v_{c}"), F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}")),
        lambda c: (F.lit(c).alias("_x"), *[F.col(f"{m}_{c}").alias(f"_{m}") for m in ("m", "v", "lo", "hi")])))
    joint = grouped([(k, f"c{cols.index(a)}", f"c{cols.index(b)}") for k, (a, b) in enumerate(pairs)], 20,
                    lambda p: (F.covar_pop(p[1], p[2]).alias(f"p{p[0]}"),),
                    lambda p: (F.lit(p[0]).alias("_k"), F.lit(p[1]).alias("_x"), F.lit(p[2]).alias("_y"), F.col(f"p{p[0]}").alias("_c")))
    each = materialize(joint.where(F.col("_c").isNotNull()).join(single.selectExpr("_there", "_x", "_m _mx", "_v _vx", "_lo _lx", "_hi _hx"), ["_there", "_x"])
                       .join(single.selectExpr("_there", "_x _y", "_m _my", "_v _vy", "_lo _ly", "_hi _hy"), ["_there", "_y"]))
    n = F.col("_n")
    mean = each.groupBy("_k").agg(*[F.min(f"_l{z}").alias(f"_low{z}") for z in "xy"],
                                  *[F.max(f"_h{z}").alias(f"_high{z}") for z in "xy"],
                                  *[(F.sum(n * F.col(f"_m{z}")) / F.sum("_n")).alias(f"_mean{z}") for z in "xy"])
    ex, ey = F.col("_mx") - F.col("_meanx"), F.col("_my") - F.col("_meany")
    whole = each.join(mean, "_k").groupBy("_k", "_lowx", "_highx", "_lowy", "_highy").agg(
        F.sum(n * (F.col("_c") + ex * ey)).alias("_cxy"), F.sum(n * (F.col("_vx") + ex * ex)).alias("_cxx"),
        F.sum(n * (F.col("_vy") + ey * ey)).alias("_cyy"))
    constant = (F.col("_lowx") == F.col("_highx")) | (F.col("_lowy") == F.col("_highy"))
    stat = F.when(~constant, F.try_divide(F.col("_cxy"), F.sqrt("_cxx") * F.sqrt("_cyy")))
    listed = df.sparkSession.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], f"_k int, {F1} string, {F2} string")
    return listed.join(whole.select("_k", stat.alias(STAT)), "_k", "left").select(F1, F2, STAT)


#: Columns of a tile: a packed tile holds the moments of up to TILE * TILE pairs.
TILE = 64
#: Moments of a pair: rows, a shift and the mean's distance from it (both columns), central sums of squares and products.
MOMENTS = ("n", "hx", "ox", "hy", "oy", "cxx", "cyy", "cxy")


def _tiles(k: int) -> list[tuple[range, range]]:
    """Blocks of rows and columns that hold every pair i < j; a tile's number is its place."""
    cuts = [range(i, min(i + TILE, k)) for i in range(0, k, TILE)]
    return [(a, b) for i, a in enumerate(cuts) for b in cuts[i:]]


def merge_moments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two sets of rows together.  Means are kept as a shift and a distance, so large values lose nothing."""
    na, hxa, oxa, hya, oya, xxa, yya, xya = a = a.reshape(len(MOMENTS), -1)
    nb, hxb, oxb, hyb, oyb, xxb, yyb, xyb = b = b.reshape(len(MOMENTS), -1)
    n = na + nb
    share = np.divide(nb, n, out=np.zeros_like(n), where=n > 0)
    dx, dy = (hxb - hxa) + (oxb - oxa), (hyb - hya) + (oyb - oya)
    w = na * share
    both = np.stack([n, hxa, oxa + dx * share, hya, oya + dy * share, xxa + xxb + w * dx * dx, yya + yyb + w * dy * dy,
                     xya + xyb + w * dx * dy])
    return np.where(na == 0, b, np.where(nb == 0, a, both)).ravel()


def _moments(k: int):
    """A task's rows as one packed array per tile, taken about its first values."""
    tiles = _tiles(k)

    def fn(batches):
        acc, shift = None, None
        for b in batches:
            x = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(k)], 1) if b.num_rows else np.empty((0, k))
            if not len(x):
                continue
            there = ~np.isnan(x)
            if shift is None:  # a column's first value, so that a constant column's sums are exactly zero
                shift = np.full(k, np.nan)
            new = np.isnan(shift) & there.any(0)
            if new.any():
                shift[new] = x[there.argmax(0)[new], np.flatnonzero(new)]
            x = np.nan_to_num(x - shift)
            m = there.astype("float64")
            x2 = x * x
            part = np.stack([m.T @ m, x.T @ m, m.T @ x, x2.T @ m, m.T @ x2, x.T @ x])
            acc = part if acc is None else acc + part
        if acc is None:
            return
        n, sx, sy, sxx, syy, sxy = acc
        safe = np.maximum(n, 1)
        h = np.nan_to_num(shift)
        hx, hy = np.broadcast_to(h[:, None], n.shape), np.broadcast_to(h[None, :], n.shape)
        full = np.stack([n, hx, sx / safe, hy, sy / safe, sxx - sx * sx / safe, syy - sy * sy / safe, sxy - sx * sy / safe])
        yield packed({t: full[:, a.start:a.stop, c.start:c.stop] for t, (a, c) in enumerate(tiles)})
    return fn


def corr_pairs_blocks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Same result for wide tables, in one pass over the rows: each task
    reduces its Arrow batches to packed moments of all pairs (over rows
    where both exist), one array per tile of 64 x 64 columns.  The tiles are
    merged up a tree of tasks, so neither rows per pair and task nor
    anything else is written."""
    cols = list(cols)
    k, tiles = len(cols), _tiles(len(cols))
    base = df.select(*[F.nanvl(col_(c).cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])

    def pairs(batches):
        for b in batches:
            for t, data in unpacked(b):
                r, c = tiles[t]
                n, hx, ox, hy, oy, cxx, cyy, cxy = data.reshape(len(MOMENTS), len(r), len(c))
                keep = (np.arange(r.start, r.stop)[:, None] < np.arange(c.start, c.stop)[None, :]) & (n > 0)
                i, j = np.nonzero(keep)
                # a constant column leaves only the rounding of its mean
                varies = ((cxx > n * (1e-12 * np.abs(hx + ox)) ** 2) & (cyy > n * (1e-12 * np.abs(hy + oy)) ** 2))[keep]
                bottom = np.sqrt(cxx[keep].clip(0)) * np.sqrt(cyy[keep].clip(0))
                stat = np.divide(cxy[keep], bottom, out=np.full(len(i), np.nan), where=varies & (bottom > 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cols[x] for x in i + r.start], pa.string()), pa.array([cols[x] for x in j + c.start], pa.string()),
                     pa.array(stat, pa.float64(), from_pandas=True)], names=[F1, F2, STAT])

    if k < 2:
        return df.sparkSession.createDataFrame([], f"{F1} string, {F2} string, {STAT} double")
    return merge_tree(base.mapInArrow(_moments(k), SCHEMA), merge_moments).mapInArrow(pairs, f"{F1} string, {F2} string, {STAT} double")


def symmetric(pairs: DataFrame) -> DataFrame:
    """Both orders of every pair."""
    return pairs.unionByName(pairs.select(F.col(F2).alias(F1), F.col(F1).alias(F2), STAT))


def distance(pairs: DataFrame) -> DataFrame:
    """``1 - statistic`` (a strong negative correlation is far)."""
    return pairs.select(F1, F2, (1 - F.col(STAT)).alias("distance"))


def drop_all_null(pairs: DataFrame) -> DataFrame:
    """Drop features (rows/columns of the matrix) whose every value is null."""
    sym = symmetric(pairs)
    live = sym.groupBy(F1).agg(F.count(STAT).alias("_n")).where("_n > 0").select(F.col(F1).alias("_f"))
    live = small_side(live)  # one row per feature
    return (pairs.join(live, F.col(F1) == F.col("_f"), "left_semi")
            .join(live, F.col(F2) == F.col("_f"), "left_semi"))


def _components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Connected components: ``(feature, root)`` with root = smallest pos in
    the component.  ``edges`` is symmetric ``(a, b)``.

    A round takes the smallest root among a node and its neighbours, then the
    root of that root (pointer jumping), so a chain of n nodes needs about
    log n rounds; it ends when nothing changes."""
    ids = nodes.select("feature", "pos")
    pairs = materialize(edges.join(ids.toDF("a", "v"), "a").join(ids.toDF("b", "u"), "b").select("v", "u").distinct())
    label = ids.select(F.col("pos").alias("v"), F.col("pos").alias("root"))
    while True:
        near = pairs.join(label.toDF("u", "_nr"), "u").groupBy("v").agg(F.min("_nr").alias("_nr"))
        low = label.join(near, "v", "left").select("v", F.col("root").alias("_old"), F.least("root", F.coalesce("_nr", "root")).alias("root"))
        jump = low.join(label.toDF("root", "_rr"), "root", "left").select("v", "_old", F.least("root", F.coalesce("_rr", "root")).alias("root"))
        new = materialize(jump)  # one written table per round; the check reads it
        label = new.select("v", "root")
        if new.where("root <> _old").limit(1).count() == 0:
            return ids.join(label.toDF("pos", "root"), "pos").select("feature", "root")


def dbscan(dist: DataFrame, features: DataFrame, eps: float = 0.4, min_pts: int = 3) -> DataFrame:
    """Density clusters of features from pair distances (``feature1``,
    ``feature2``, ``distance``; each unordered pair once).  A feature is core
    when it has at least ``min_pts`` features (itself included) within
    ``eps``.  Clusters are numbered from 1 in order of their first core
    feature; a border feature joins the lowest-numbered adjacent cluster;
    0 means unclustered.  ``features`` is ``(feature, pos)``."""
    near = dist.where(F.col("distance") <= F.lit(float(eps)))
    edges = symmetric(near.select(F1, F2, F.col("distance").alias(STAT))).select(
        F.col(F1).alias("a"), F.col(F2).alias("b"))
    deg = edges.groupBy("a").agg(F.count(F.lit(1)).alias("_d"))
    feats = features.join(deg, features.feature == deg.a, "left") \
        .select("feature", "pos", (F.coalesce("_d", F.lit(0)) + 1 >= min_pts).alias("core"))
    feats = materialize(feats)
    core = feats.where("core").select("feature", "pos")
    core_names = core.select(F.col("feature").alias("_c"))
    core_edges = (edges.join(core_names, F.col("a") == F.col("_c"), "left_semi")
                  .join(core_names, F.col("b") == F.col("_c"), "left_semi"))
    comp = _components(core, core_edges)
    ids = comp.select("root").distinct().withColumn("cluster", F.dense_rank().over(Window.orderBy("root")))
    core_cl = comp.join(ids, "root").select("feature", "cluster")
    border = (feats.where(~F.col("core")).select("feature")
              .join(edges, F.col("feature") == F.col("a"))
              .join(core_cl.withColumnRenamed("feature", "b"), "b")
              .groupBy("feature").agg(F.min("cluster").alias("cluster")))
    labelled = core_cl.unionByName(border)
    return (features.join(labelled, "feature", "left")
            .select("feature", "pos", F.coalesce("cluster", F.lit(0)).cast("bigint").alias("cluster")))


def threshold_clusters(dist: DataFrame, features: DataFrame, eps: float = 0.4) -> DataFrame:
    """Every feature in a cluster: components of ``distance <= eps``
    (DBSCAN with ``min_pts = 1``)."""
    return dbscan(dist, features, eps, 1)


def target_correlation(pairs: DataFrame, target: str) -> DataFrame:
    """Importance of each feature = its correlation to ``target``."""
    sym = symmetric(pairs)
    return sym.where(F.col(F2) == target).select(F.col(F1).alias("feature"), F.col(STAT).alias("importance"))


def minmax_scale(df: DataFrame, col: str, lo: float = 0.2, hi: float = 1.2, out: str | None = None,
                 absolute: bool = True) -> DataFrame:
    """Scale ``abs(col)`` (or ``col``) to ``[lo, hi]``."""
    v = F.abs(F.col(col)) if absolute else F.col(col)
    stats = df.agg(F.min(v).alias("_mn"), F.max(v).alias("_mx"))
    j = df.withColumn("_g", F.lit(0)).join(F.broadcast(stats.withColumn("_g", F.lit(0))), "_g").drop("_g")
    rng = F.col("_mx") - F.col("_mn")
    scaled = F.when(rng > 0, (v - F.col("_mn")) / rng).otherwise(F.lit(0.0)) * F.lit(hi - lo) + F.lit(lo)
    return j.withColumn(out or f"{col}_scaled", scaled).drop("_mn", "_mx")


def cluster_map(clusters: DataFrame, importance: DataFrame) -> DataFrame:
    """Feature, cluster, importance and importance scaled to [0.2, 1.2]
    (the data under the correlation map); the target row is excluded by
    the inner join with the importance table."""
    j = clusters.join(importance, "feature")
    return minmax_scale(j, "importance", out="importance_scaled")


def lead_features(cmap: DataFrame) -> DataFrame:
    """Per cluster (> 0) the feature with the largest scaled importance
    (first in feature order on ties)."""
    w = Window.partitionBy("cluster").orderBy(F.col("importance_scaled").desc(), F.col("pos"))
    return cmap.where("cluster > 0").withColumn("_r", F.row_number().over(w)).where("_r = 1") \
        .select("cluster", F.col("feature").alias("lead"))


def derived_feature_plan(cmap: DataFrame, leads: DataFrame, use_diff: bool = True,
                         use_ratio: bool = False) -> DataFrame:
    """Names and formulas of the de-collinearised features, one row each:
    ``lead (cluster k)`` keeps the lead; ``d_f_lead`` / ``r_f_lead`` for the
    other members; unclustered features pass through."""
    members = cmap.where("cluster > 0").join(leads, "cluster")
    keep = leads.select(F.format_string("%s (cluster %d)", "lead", "cluster").alias("name"),
                        F.lit("copy").alias("op"), F.col("lead").alias("a"), F.lit(None).cast("string").alias("b"))
    others = members.where(F.col("feature") != F.col("lead"))
    parts = [keep]
    if use_diff:
        parts.append(others.select(F.concat(F.lit("d_"), "feature", F.lit("_"), "lead").alias("name"),
                                   F.lit("diff").alias("op"), F.col("feature").alias("a"), F.col("lead").alias("b")))
    if use_ratio:
        parts.append(others.select(F.concat(F.lit("r_"), "feature", F.lit("_"), "lead").alias("name"),
                                   F.lit("ratio").alias("op"), F.col("feature").alias("a"), F.col("lead").alias("b")))
    free = cmap.where("cluster = 0").select(F.col("feature").alias("name"), F.lit("copy").alias("op"),
                                            F.col("feature").alias("a"), F.lit(None).cast("string").alias("b"))
    parts.append(free)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def decollinearise(df: DataFrame, plan_rows: Sequence, passthrough: Sequence[str] = ()) -> DataFrame:
    """One ``select`` built from the (small, collected) feature plan; ratios
    are null on a zero divisor."""
    exprs = [col_(c) for c in passthrough]
    for name, op, a, b in plan_rows:
        if op == "copy":
            e = col_(a)
        elif op == "diff":
            e = col_(a) - col_(b)
        else:
            e = F.try_divide(col_(a).cast("double"), col_(b).cast("double"))
        exprs.append(e.alias(name))
    return df.select(*exprs)


def representatives(cmap: DataFrame, leads: DataFrame, non_numeric: DataFrame) -> DataFrame:
    """Feature list after clustering: each cluster's lead, the unclustered
    features and the non-numeric features, distinct."""
    return (leads.select(F.col("lead").alias("feature"))
            .union(cmap.where("cluster = 0").select("feature"))
            .union(non_numeric.select("feature")).distinct())


def drop_correlated(pairs: DataFrame, importance: DataFrame, cut: float) -> DataFrame:
    """Greedy redundancy removal: walking features from most to least
    important, keep a feature unless ``|corr| > cut`` with a kept one.
    Rounds settle every feature whose stronger correlated partners are all
    settled, and at least one each, until none is open; returns ``(feature,
    keep)``."""
    w = Window.orderBy(F.col("importance").desc(), F.col("feature"))
    order = importance.withColumn("rank", F.row_number().over(w)).select("feature", "rank")
    strong = symmetric(pairs).where(F.abs(F.col(STAT)) > F.lit(float(cut))).select(
        F.col(F1).alias("feature"), F.col(F2).alias("other"))
    edges = (strong.join(order, "feature")
             .join(order.select(F.col("feature").alias("other"), F.col("rank").alias("orank")), "other")
             .where(F.col("orank") < F.col("rank")).select("feature", "other"))
    edges = materialize(edges)
    state = order.select("feature", F.lit(None).cast("boolean").alias("keep"))
    while True:
        st = state.select(F.col("feature").alias("other"), F.col("keep").alias("okeep"))
        info = edges.join(st, "other").groupBy("feature").agg(
            F.max(F.col("okeep").cast("int")).alias("_any_kept"),
            F.count(F.when(F.col("okeep").isNull(), 1)).alias("_open"))
        new = state.join(info, "feature", "left").select(
            "feature",
            F.when(F.col("keep").isNotNull(), F.col("keep"))
            .when(F.coalesce(F.col("_any_kept"), F.lit(0)) == 1, F.lit(False))
            .when(F.coalesce(F.col("_open"), F.lit(0)) == 0, F.lit(True)).alias("keep"))
        new = materialize(new)
        state = new
        if new.where(F.col("keep").isNull()).limit(1).count() == 0:
            return state

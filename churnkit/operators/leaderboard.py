"""Leaderboard queries over a model table.

A leaderboard holds one row per model (model attributes plus metrics, either
nested ``map<metric, map<partition, double>>`` or flat columns).  Its size is
the number of trained models; a top-n keeps n rows of each task, and whole
orders are numbered range by range (``prefix.positions``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnkit.operators.dedup import mark_duplicates
from churnkit.operators.prefix import positions

# Model-type phrases and feature-list prefixes never used for
# feature selection.
EXCLUDED_TYPE_PHRASES = ["Baseline Predictions", "Mean Response", "Majority Class", "Auto-Tuned"]
EXCLUDED_LIST_PREFIXES = ["Baseline", "Date"]


def nested_metrics(lb: DataFrame, spec: dict[str, dict[str, str]]) -> DataFrame:
    """Build ``metrics`` as ``map<metric, map<partition, double>>`` from flat
    columns (``spec[metric][partition] = column``)."""
    outer = []
    for metric, parts in spec.items():
        inner = []
        for part, col in parts.items():
            inner += [F.lit(part), F.col(col).cast("double")]
        outer += [F.lit(metric), F.create_map(*inner)]
    return lb.withColumn("metrics", F.create_map(*outer))


def flatten_metrics(lb: DataFrame, id_col: str = "model_id") -> DataFrame:
    """Nested metrics to long ``(model_id, metric, partition, value)``."""
    outer = lb.select(id_col, F.explode("metrics").alias("metric", "_parts"))
    return outer.select(id_col, "metric", F.explode("_parts").alias("partition", "value"))


def metrics_wide(long: DataFrame, id_col: str = "model_id", sep: str = "_",
                 names: Sequence[str] | None = None) -> DataFrame:
    """Long metrics to one column per ``metric<sep>partition``."""
    k = F.concat_ws(sep, "metric", "partition")
    return long.withColumn("_k", k).groupBy(id_col).pivot("_k", list(names) if names else None) \
        .agg(F.first("value"))


def direction(meta: DataFrame, metric: str, prefix_match: bool = True) -> bool:
    """Ascending flag of a metric (one row of a tiny metadata table)."""
    cond = F.col("metric_name").startswith(metric) if prefix_match else F.col("metric_name") == metric
    row = meta.where(cond).orderBy(F.length("metric_name"), "metric_name").select("ascending").first()
    if row is None:
        raise KeyError(f"unknown metric {metric}")
    return bool(row[0])


def _order(score: Column, ascending: bool) -> Column:
    return score.asc_nulls_last() if ascending else score.desc_nulls_last()


def sort_leaderboard(lb: DataFrame, score: str, ascending: bool, id_col: str = "model_id") -> DataFrame:
    """Models with a score, in metric direction, with their position."""
    return positions(lb.where(F.col(score).isNotNull()), [_order(F.col(score), ascending), F.col(id_col)])


def best_models(lb: DataFrame, score: str, ascending: bool, n: int | None = None,
                featurelist: str | None = None, id_col: str = "model_id",
                reduced_marker: str | None = None) -> DataFrame:
    """Non-blend, non-frozen models, on ``featurelist`` when given, else not
    on an automatically reduced list (one whose name holds the service's
    exact ``reduced_marker``, given by the caller); sorted nulls last; first
    ``n``."""
    f = (F.col("model_category") == "model") & ~F.col("is_frozen")
    if featurelist:
        f = f & (F.col("featurelist_name") == featurelist)
    elif reduced_marker:
        f = f & ~F.coalesce(F.col("featurelist_name").contains(reduced_marker), F.lit(False))
    ords = [_order(F.col(score), ascending), F.col(id_col)]
    if n:  # a top-n keeps n rows of each task
        best = lb.where(f).orderBy(*ords).limit(n)
        return best.withColumn("position", F.row_number().over(Window.orderBy(*ords)).cast("bigint"))
    return positions(lb.where(f), ords)


def selectable_models(lb: DataFrame, unsupervised: bool = False, type_col: str = "model_type") -> DataFrame:
    """Models usable for feature selection; empty when fewer than two remain."""
    cond = F.lit(True)
    for p in EXCLUDED_TYPE_PHRASES:
        cond = cond & ~F.col(type_col).contains(p)
    for p in EXCLUDED_LIST_PREFIXES:
        cond = cond & ~F.coalesce(F.col("featurelist_name").startswith(p), F.lit(False))
    if unsupervised:
        cond = cond & (F.col("model_category") != "blend")
    kept = lb.where(cond)
    n = kept.agg(F.count(F.lit(1)).alias("_n"))
    return (kept.withColumn("_g", F.lit(0)).join(F.broadcast(n.withColumn("_g", F.lit(0))), "_g")
            .where(F.col("_n") >= 2).drop("_g", "_n"))


def top_n_models(lb: DataFrame, n: int, partition_score: str, validation_score: str,
                 ascending: bool, id_col: str = "model_id") -> DataFrame:
    """Keep ``n`` models: validation-sorted, those already scored on the
    requested partition first, then the next best; result re-sorted by the
    partition score (nulls last, then validation)."""
    has = F.col(partition_score).isNotNull()
    picked = lb.where(F.col(validation_score).isNotNull()).orderBy(
        has.desc(), _order(F.col(validation_score), ascending), F.col(id_col)).limit(n)
    w2 = Window.orderBy(_order(F.col(partition_score), ascending), _order(F.col(validation_score), ascending),
                        F.col(id_col))
    return picked.withColumn("position", F.row_number().over(w2).cast("bigint"))


def retention(lb: DataFrame, n: int, score: str, ascending: bool, subset: Sequence[str],
              id_col: str = "model_id") -> DataFrame:
    """After marking duplicates (fewest features kept), keep the best ``n``
    distinct models; every other model is listed for deletion, blends first.
    Returns ``(model_id, action, delete_order)``."""
    marked = mark_duplicates(lb, subset, ["n_features", id_col])
    keep = (marked.where(~F.col("duplicate") & F.col(score).isNotNull())
            .orderBy(_order(F.col(score), ascending), F.col(id_col)).limit(n).select(id_col))
    dele = positions(marked.join(keep, id_col, "left_anti"), [F.col("model_category").asc(), F.col(id_col)], "delete_order")
    return (keep.select(id_col, F.lit("keep").alias("action"), F.lit(None).cast("int").alias("delete_order"))
            .unionByName(dele.select(id_col, F.lit("delete").alias("action"), F.col("delete_order").cast("int"))))


def top_of_each(lb: DataFrame, board: str, ks: dict, score: str, ascending: bool,
                id_col: str = "model_id") -> DataFrame:
    """Top ``ks[b]`` models of each board ``b`` in one pass."""
    w = Window.partitionBy(board).orderBy(_order(F.col(score), ascending), F.col(id_col))
    kcol = F.create_map(*[x for b, k in ks.items() for x in (F.lit(b), F.lit(int(k)))])
    r = lb.withColumn("board_rank", F.row_number().over(w).cast("bigint"))
    return r.where(F.col("board_rank") <= F.coalesce(kcol[F.col(board)], F.lit(0)))

"""Joins of the workflow: prediction merge, feature-list joins, model sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.functions.scalar import first_words
from churnkit.operators.util import small_side


def merge_predictions(a: DataFrame, b: DataFrame, left_on: Sequence[str],
                      right_on: Sequence[str], null_keys: bool = True) -> DataFrame:
    """Full outer equi-join, null keys matching each other (pandas ``merge``).

    Key columns with the same name on both sides come out once, coalesced;
    differently named keys are both kept.  Both sides should be unique on
    their keys (collapse first): then no key can fan out, and the sort-merge
    join stays balanced whatever the key distribution.

    ``null_keys=False`` (the caller knows no key is null, e.g. from a check
    on the source columns) joins on plain equality: a side that is already
    hash-partitioned on its keys (by its aggregation) is then not shuffled
    again.  A null-safe key is rewritten by Spark to coalesce/isnull
    expressions, which no upstream partitioning matches.
    """
    return _merge(a, b, left_on, right_on, null_safe=null_keys)


def any_null(df: DataFrame, cols: Sequence[str]) -> bool:
    """True when some row has a null in ``cols``.  Meant for raw source
    columns: the ``IS NULL`` filter reaches the Parquet scan, row groups
    without nulls are skipped from their statistics, and the first hit ends
    the job (limit 1)."""
    cond = None
    for c in cols:
        x = F.col(c).isNull()
        cond = x if cond is None else cond | x
    return df.select(*cols).where(cond).limit(1).count() > 0


def _merge(a: DataFrame, b: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
           null_safe: bool) -> DataFrame:
    shared = [l for l, r in zip(left_on, right_on) if l == r]
    bb = b
    for k in shared:
        bb = bb.withColumnRenamed(k, f"_r_{k}")
    rkeys = [f"_r_{r}" if r in shared else r for r in right_on]
    cond = None
    for l, r in zip(left_on, rkeys):
        c = a[l].eqNullSafe(bb[r]) if null_safe else (a[l] == bb[r])
        cond = c if cond is None else cond & c
    j = a.join(bb, cond, "full_outer")
    cols = []
    for c in a.columns:
        cols.append(F.coalesce(a[c], bb[f"_r_{c}"]).alias(c) if c in shared else a[c])
    cols += [bb[c] for c in bb.columns if not c.startswith("_r_")]
    return j.select(*cols)


def feature_inclusion(features: DataFrame, ranks: DataFrame, feature_col: str = "Feature",
                      rank_feature_col: str = "featureName") -> DataFrame:
    """Feature list LEFT JOIN ranks; ``included_in_model`` is 1 when matched.
    The rank table has one row per feature (hundreds): broadcast behind a
    counted size."""
    f, r = features.alias("_f"), small_side(ranks).alias("_r")
    j = f.join(r, F.col(f"_f.{feature_col}") == F.col(f"_r.{rank_feature_col}"), "left")
    return j.select("_f.*", *[F.col(f"_r.{c}") for c in ranks.columns]) \
        .withColumn("included_in_model", F.col(rank_feature_col).isNotNull().cast("int"))


def intersect_features(requested: DataFrame, available: DataFrame, col: str = "feature") -> DataFrame:
    """Requested features that exist, in the requested order (``pos``)."""
    return requested.join(available.select(col).distinct(), col, "left_semi")


def filter_ids(df: DataFrame, ids: DataFrame, col: str) -> DataFrame:
    """Rows whose id is in ``ids`` (left semi join)."""
    return df.join(ids.select(col).distinct(), col, "left_semi")


def exclude_ids(df: DataFrame, ids: DataFrame, col: str) -> DataFrame:
    return df.join(ids.select(col).distinct(), col, "left_anti")


def similar_models(candidates: DataFrame, top: DataFrame, type_col: str = "model_type",
                   words: int = 2) -> DataFrame:
    """Candidates whose type contains the first ``words`` words of a top
    model's type.  The phrase table is distinct and small (one row per top
    model), so the ``contains`` theta join is a broadcast nested loop; each
    candidate is kept once even when several phrases match."""
    phrases = top.select(first_words(type_col, words).alias("_phrase")).distinct()
    j = candidates.join(small_side(phrases), F.col(type_col).contains(F.col("_phrase")), "left_semi")
    return j


def metric_direction(meta: DataFrame, metric: str, prefix_match: bool = False) -> DataFrame:
    """Row(s) of the metric metadata giving the sort direction of ``metric``."""
    if prefix_match:
        return meta.where(F.col("metric_name").startswith(metric)).orderBy("metric_name").limit(1)
    return meta.where(F.col("metric_name") == metric)


def model_combinations(models: DataFrame, k: int, id_col: str = "model_id") -> DataFrame:
    """All combinations of ids of size 2..k as sorted arrays.  The model list
    is a short list of top models; each step joins on ``a < b`` only."""
    ids = small_side(models.select(F.col(id_col).alias("_id")).distinct())
    cur = ids.select(F.array("_id").alias("combo"), F.col("_id").alias("_last"))
    out = []
    for size in range(2, k + 1):
        cur = (cur.join(ids, F.col("_id") > F.col("_last"))
               .select(F.concat("combo", F.array("_id")).alias("combo"), F.col("_id").alias("_last")))
        out.append(cur.select(F.lit(size).alias("size"), "combo"))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


def match_members(blends: DataFrame, members: DataFrame, blend_col: str = "blend_id",
                  member_col: str = "member_id", wanted: Sequence | None = None) -> DataFrame:
    """Blends whose member set equals ``wanted`` (compared as sorted arrays)."""
    sets = blends.groupBy(blend_col).agg(F.array_sort(F.collect_set(member_col)).alias("members"))
    target = F.array_sort(F.array(*[F.lit(x) for x in (wanted or [])]))
    return sets.where(F.col("members") == target)

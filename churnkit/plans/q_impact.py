"""Queries: feature impact, rank ensembling, feature-list joins (§2.2-2.7, §2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnkit.operators import impact as im, joins as jn
from churnkit.plans.registry import query
from churnkit.sources import fixtures

MODELS = [0, 1, 2, 3, 4]


def impacts(spark, sf):
    """Impact table with normalised impact and per-model rank."""
    return im.rank_impacts(im.normalise_impacts(fixtures.feature_impacts(spark, sf)))


IMP_SQL = ("SELECT *, ROW_NUMBER() OVER (PARTITION BY model_id ORDER BY impactUnnormalized DESC, featureName) - 1 AS rank "
           "FROM (SELECT *, impactUnnormalized / NULLIF(MAX(impactUnnormalized) OVER (PARTITION BY model_id), 0) "
           "AS impactNormalized FROM feature_impacts) n")


def isql(body: str, extra: dict | None = None) -> str:
    ex = {"imp": IMP_SQL}
    ex.update(extra or {})
    return fixtures.with_views(body, "feature_impacts", extra=ex)


@query("rank_within_model", "2.5", r6=["impactUnnormalized"],
       sql=isql("SELECT model_id, featureName, impactUnnormalized, rank FROM imp"))
def q_rank(spark, sf):
    """0-based rank by unnormalised impact within each model."""
    return impacts(spark, sf).select("model_id", "featureName", "impactUnnormalized", "rank")


@query("rename_columns", "2.2", r6=["impact_normalized"], sql=isql(
    "SELECT model_id, feature_name, impact_normalized, redundant_with FROM "
    "(SELECT model_id, featureName AS feature_name, impactNormalized AS impact_normalized, "
    "redundantWith AS redundant_with FROM imp) t"))
def q_rename(spark, sf):
    return im.rename_impacts(impacts(spark, sf)).select("model_id", "feature_name", "impact_normalized", "redundant_with")


@query("zero_out_redundant", "2.2", r6=["impactNormalized"], sql=isql(
    "SELECT model_id, featureName, CASE WHEN redundantWith IS NOT NULL THEN 0.0 ELSE impactNormalized END "
    "AS impactNormalized FROM imp"))
def q_zero(spark, sf):
    return im.zero_redundant(impacts(spark, sf)).select("model_id", "featureName", "impactNormalized")


@query("impact_sum", "2.4", r6=["impactNormalized", "impactUnnormalized"], sql=isql(
    "SELECT featureName, SUM(impactNormalized) AS impactNormalized, SUM(impactUnnormalized) AS impactUnnormalized "
    "FROM imp GROUP BY featureName"))
def q_impact_sum(spark, sf):
    return im.impact_sum(impacts(spark, sf))


@query("impact_mean", "2.4", r6=["impactNormalized"], sql=isql(
    "SELECT featureName, AVG(CASE WHEN redundantWith IS NOT NULL THEN 0.0 ELSE impactNormalized END) "
    "AS impactNormalized FROM imp GROUP BY featureName"))
def q_impact_mean(spark, sf):
    return im.impact_mean(impacts(spark, sf))


_CUM_SQL = ("SELECT *, SUM(impactUnnormalized) OVER (ORDER BY impactUnnormalized DESC, featureName "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS impactCumulative FROM "
            "(SELECT featureName, SUM(impactNormalized) AS impactNormalized, SUM(impactUnnormalized) "
            "AS impactUnnormalized FROM imp GROUP BY featureName) a")


@query("cumulative_impact", "2.5", r6=["impactNormalized", "impactUnnormalized", "impactCumulative"],
       sql=isql(_CUM_SQL))
def q_cumulative(spark, sf):
    return im.cumulative(im.impact_sum(impacts(spark, sf)), im.UNNORM, im.UNNORM)


@query("impact_median_rank", "2.4", sql=isql(
    "SELECT featureName, quantile_cont(rank, 0.5) AS rank FROM imp GROUP BY featureName"))
def q_median_rank(spark, sf):
    return im.median_rank(impacts(spark, sf))


@query("impact_pivot", "2.4", r6=[f"m{m}" for m in MODELS], sql=isql(
    "SELECT featureName, " + ", ".join(f"MAX(CASE WHEN model_id = {m} THEN impactUnnormalized END) AS m{m}"
                                       for m in MODELS) + " FROM imp GROUP BY featureName"))
def q_pivot(spark, sf):
    """Unnormalised impact per feature, one column per model."""
    return im.impact_pivot(impacts(spark, sf), MODELS)


@query("impact_spread", "2.4", r6=["min", "q1", "median", "q3", "max", "mean"], sql=isql("""
SELECT featureName, MIN(impactNormalized) AS min, quantile_cont(impactNormalized, 0.25) AS q1,
  quantile_cont(impactNormalized, 0.5) AS median, quantile_cont(impactNormalized, 0.75) AS q3,
  MAX(impactNormalized) AS max, AVG(impactNormalized) AS mean
FROM imp WHERE featureName IN (SELECT featureName FROM imp GROUP BY featureName
                               ORDER BY AVG(impactNormalized) DESC, featureName LIMIT 25)
GROUP BY featureName"""))
def q_spread(spark, sf):
    """Five-number summary of impact for the top 25 features by mean."""
    return im.impact_spread(impacts(spark, sf), 25)


@query("top_features", "2.6", r6=["impactNormalized"], sql=isql(
    "SELECT model_id, featureName, impactNormalized FROM imp WHERE model_id = 0 "
    "ORDER BY impactNormalized DESC, featureName LIMIT 10"))
def q_top_features(spark, sf):
    """Top 10 features of model 0 by normalised impact."""
    return im.top_k(impacts(spark, sf).where("model_id = 0").select("model_id", "featureName", "impactNormalized"),
                    "impactNormalized", 10)


def _fire_sql(use_ranks: bool) -> str:
    cand = ("SELECT featureName, ROW_NUMBER() OVER (ORDER BY quantile_cont(rank, 0.5), featureName) AS position "
            "FROM imp GROUP BY featureName") if use_ranks else \
        ("SELECT featureName, ROW_NUMBER() OVER (ORDER BY impactUnnormalized DESC, featureName) AS position FROM cum")
    return isql(f"""
SELECT position, featureName FROM ({cand}) c,
  (SELECT GREATEST(COUNT(*) FILTER (WHERE impactCumulative <= (SELECT MAX(impactCumulative) FROM cum) * 0.95), 1)
   AS n FROM cum) n
WHERE position <= n.n""", extra={"cum": _CUM_SQL})


@query("fire_rank_select", "2.10", sql=_fire_sql(True))
def q_fire(spark, sf):
    """Features covering 95 % of summed impact (crossing one excluded), best by median rank."""
    return im.fire_select(impacts(spark, sf), 0.95, use_ranks=True)


@query("fire_rank_select_by_impact", "2.10", sql=_fire_sql(False))
def q_fire_impact(spark, sf):
    """Same count, chosen by total unnormalised impact."""
    return im.fire_select(impacts(spark, sf), 0.95, use_ranks=False)


def _acc_sql(src: str, by: str | None) -> str:
    pb = f"PARTITION BY {by} " if by else ""
    bs = f"{by}, " if by else ""
    g = f" GROUP BY {by}, featureName" if by else " GROUP BY featureName"
    return f"""
WITH mean AS (SELECT {bs}featureName, AVG(CASE WHEN redundantWith IS NOT NULL THEN 0.0 ELSE impactNormalized END) AS m
              FROM {src}{g}),
ranked AS (SELECT *, ROW_NUMBER() OVER ({pb}ORDER BY m DESC NULLS LAST, featureName) AS pos_all FROM mean),
pos AS (SELECT *, m / SUM(m) OVER ({pb.strip()}) AS share, COUNT(*) OVER ({pb.strip()}) AS k,
          ROW_NUMBER() OVER ({pb}ORDER BY m DESC, featureName) AS position FROM ranked WHERE m > 0),
pos2 AS (SELECT *, COALESCE(SUM(share) OVER ({pb}ORDER BY m DESC, featureName
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS before FROM pos),
taken AS (SELECT *, COUNT(*) FILTER (WHERE before <= 0.95) OVER ({pb.strip()}) AS t FROM pos2),
kp AS (SELECT {bs}COUNT(*) FILTER (WHERE m > 0) AS kp FROM mean{' GROUP BY ' + by if by else ''})
SELECT {bs}position, featureName FROM taken
WHERE k > 1 AND position <= round_even(LEAST(100.0, GREATEST(25.0, k * 0.5), CAST(t AS DOUBLE)), 0)
UNION ALL
SELECT {'r.' + by + ', ' if by else ''}1 AS position, featureName FROM ranked r JOIN kp
  ON {'r.' + by + ' = kp.' + by if by else 'TRUE'} WHERE pos_all = 1 AND kp.kp <= 1"""


@query("fire_accumulate_select", "2.10", sql=isql(_acc_sql("imp", None)))
def q_accumulate(spark, sf):
    """Features taken until 95 % of mean impact (crossing one included), capped."""
    return im.accumulate_select(impacts(spark, sf), 0.95)


def _models(spark, sf):
    return (impacts(spark, sf).select("model_id").distinct()
            .withColumn("featurelist_name", F.concat(F.lit("fl"), (F.col("model_id") % 2).cast("string"))))


_SCOPES_SQL = """
SELECT 'all' AS scope, model_id FROM (SELECT DISTINCT model_id FROM imp) m
UNION ALL SELECT 'list:fl' || CAST(model_id % 2 AS VARCHAR), model_id FROM (SELECT DISTINCT model_id FROM imp) m
  WHERE (SELECT COUNT(DISTINCT model_id) FROM imp i WHERE i.model_id % 2 = m.model_id % 2) >= 2
UNION ALL SELECT 'model:' || CAST(model_id AS VARCHAR), model_id FROM (SELECT DISTINCT model_id FROM imp) m"""


@query("reduced_lists_by_scope", "2.10", sql=isql(
    _acc_sql("(SELECT i.*, s.scope FROM imp i JOIN scopes s ON s.model_id = i.model_id) x", "scope"),
    extra={"scopes": _SCOPES_SQL}))
def q_reduced_lists(spark, sf):
    """Accumulated-impact selection for all models, each list with 2+ models, and each model."""
    return im.reduced_lists(impacts(spark, sf), im.scope_table(_models(spark, sf)), 0.95)


@query("redundancy_removal", "2.10", sql=isql(
    "SELECT model_id, featureName FROM imp WHERE redundantWith IS NULL"))
def q_redundancy(spark, sf):
    """Features left after dropping those marked redundant."""
    return im.drop_redundant(impacts(spark, sf)).select("model_id", "featureName")


_RANKS_POS = "SELECT featureName, quantile_cont(rank, 0.5) AS rank FROM imp WHERE impactNormalized > 0 GROUP BY featureName"


@query("feature_inclusion_join", "2.3", sql=isql(f"""
SELECT f.Feature, r.featureName, r.rank, CAST(r.featureName IS NOT NULL AS INT) AS included_in_model
FROM (SELECT DISTINCT featureName AS Feature FROM imp) f LEFT JOIN ({_RANKS_POS}) r ON f.Feature = r.featureName"""))
def q_inclusion(spark, sf):
    """Feature list left-joined to median ranks of positive impacts, with an inclusion flag."""
    imp = impacts(spark, sf)
    feats = imp.select(F.col("featureName").alias("Feature")).distinct()
    ranks = im.median_rank(imp.where("impactNormalized > 0"))
    return jn.feature_inclusion(feats, ranks).select("Feature", "featureName", "rank", "included_in_model")


@query("inclusion_intersect", "2.3", sql=isql("""
SELECT position, feature FROM (SELECT rank + 1 AS position, featureName AS feature FROM imp WHERE model_id = 0) r
WHERE feature IN (SELECT featureName FROM imp WHERE model_id = 1 AND impactNormalized >= 0.9)"""))
def q_intersect(spark, sf):
    """Model 0's ranked features that are strong (>= 0.9 normalised) in model 1, in rank order."""
    imp = impacts(spark, sf)
    req = imp.where("model_id = 0").select((F.col("rank") + 1).alias("position"), F.col("featureName").alias("feature"))
    avail = imp.where("model_id = 1 AND impactNormalized >= 0.9").select(F.col("featureName").alias("feature"))
    return jn.intersect_features(req, avail, "feature")


@query("column_difference", "2.7", sql=isql(
    "SELECT DISTINCT featureName FROM imp WHERE model_id = 0 AND impactNormalized >= 0.9 AND featureName NOT IN "
    "(SELECT featureName FROM imp WHERE model_id = 1 AND impactNormalized >= 0.9)"))
def q_col_diff(spark, sf):
    """Strong features of model 0 that are not strong in model 1 (anti join)."""
    imp = impacts(spark, sf)
    a = imp.where("model_id = 0 AND impactNormalized >= 0.9").select("featureName").distinct()
    b = imp.where("model_id = 1 AND impactNormalized >= 0.9").select("featureName")
    return a.join(b, "featureName", "left_anti")


@query("feature_union_distinct", "2.7", sql=isql(
    "SELECT featureName FROM imp WHERE model_id = 0 AND impactNormalized >= 0.9 UNION "
    "SELECT featureName FROM imp WHERE model_id = 1 AND impactNormalized >= 0.9"))
def q_union_distinct(spark, sf):
    imp = impacts(spark, sf)
    a = imp.where("model_id = 0 AND impactNormalized >= 0.9").select("featureName")
    b = imp.where("model_id = 1 AND impactNormalized >= 0.9").select("featureName")
    return a.union(b).distinct()


@query("list_frames_union", "2.1", r6=["impactUnnormalized"], sql=isql(
    "SELECT model_id, featureName, impactUnnormalized, NULL::VARCHAR AS source FROM imp WHERE model_id < 2 "
    "UNION ALL SELECT model_id, featureName, impactUnnormalized, 'late' FROM imp WHERE model_id >= 2"))
def q_union_frames(spark, sf):
    """Per-model frames stacked by name, missing columns filled with null."""
    from churnkit.sources.io import union_all
    imp = impacts(spark, sf).select("model_id", "featureName", "impactUnnormalized")
    return union_all([imp.where("model_id < 2"), imp.where("model_id >= 2").withColumn("source", F.lit("late"))])

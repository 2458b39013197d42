"""Queries: reconciliation slice and whole-table business impact (§2.3, §2.14)."""

from __future__ import annotations

from churnkit.operators import evaluate as ev
from churnkit.plans import reconcile as rc
from churnkit.plans.registry import query


@query("collapse_duplicates", "2.4", r6=rc.INTENT_VALS,
       sql=rc.sql("SELECT * FROM collapsed", level="collapsed"))
def q_collapse(spark, sf):
    """Duplicate intent rows collapsed by averaging the predictions."""
    return rc.collapsed_intent(spark, sf)


@query("merge_predictions", "2.3", r6=rc.INTENT_VALS,
       sql=rc.sql("SELECT * FROM merged", level="merged"))
def q_merge(spark, sf):
    """Full outer merge of both prediction tables on (subscriber, date)."""
    return rc.merged(spark, sf)


@query("filter_both_present", "2.2", r6=rc.INTENT_VALS, sql=rc.sql("SELECT * FROM scored"))
def q_both(spark, sf):
    """Rows scored by both models, averaged label rounded half to even."""
    return rc.both_scored(spark, sf)


_BI_SQL = rc.sql("""
SELECT model, interventions, true_positives, false_positives, total_cost, total_benefit,
  CASE WHEN total_cost > 0 THEN (total_benefit - total_cost) / total_cost ELSE 0.0 END AS roi,
  CASE WHEN true_positives > 0 THEN total_cost / true_positives ELSE CAST('inf' AS DOUBLE) END AS cost_per_true_positive
FROM (
  SELECT model, interventions, true_positives, false_positives, interventions * 10.0 AS total_cost,
    true_positives * 100.0 AS total_benefit FROM (
    SELECT 'intent' AS model, SUM(CAST(churned_PREDICTION AS DOUBLE)) AS interventions,
      COUNT(*) FILTER (WHERE churned_PREDICTION >= 1 AND churned >= 1) AS true_positives,
      COUNT(*) FILTER (WHERE churned_PREDICTION >= 1 AND churned = 0) AS false_positives FROM scored
    UNION ALL
    SELECT 'churn', SUM(CAST(churn_label AS DOUBLE)),
      COUNT(*) FILTER (WHERE churn_label >= 1 AND true_churned >= 1),
      COUNT(*) FILTER (WHERE churn_label >= 1 AND true_churned = 0) FROM scored) a) b
""")


@query("business_impact", "2.14", sql=_BI_SQL,
       r6=["interventions", "total_cost", "total_benefit", "roi", "cost_per_true_positive"])
def q_business_impact(spark, sf):
    """Interventions, TP, FP, cost, benefit, ROI, cost per TP (cost 10, revenue 100)."""
    return ev.business_impact(rc.both_scored(spark, sf), cost_per_intervention=10, revenue_per_save=100)

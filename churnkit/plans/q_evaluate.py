"""Queries: classification metrics, curves, segments and money (§2.5, §2.14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnkit.operators import evaluate as ev, metrics as mt
from churnkit.operators.util import materialize
from churnkit.plans import reconcile as rc, sqlparts as sp
from churnkit.plans.registry import query
from churnkit.sources import fixtures, load

Y, P = "churned", "churned_1_PREDICTION"
_REP = ["precision", "recall", "f1_score"]
_CURVE = ["n_pos", "n_neg", "auc", "ks", "average_precision", "max_mcc"]


@query("confusion_matrix", "2.14", sql=rc.sql("""
WITH cm AS (SELECT CAST(churned AS DOUBLE) AS y_true, CAST(churned_PREDICTION AS DOUBLE) AS y_pred, COUNT(*) AS n
            FROM scored GROUP BY 1, 2),
labels AS (SELECT y_true AS l FROM cm UNION SELECT y_pred FROM cm)
SELECT a.l AS y_true, b.l AS y_pred, CAST(COALESCE(cm.n, 0) AS BIGINT) AS n
FROM labels a CROSS JOIN labels b LEFT JOIN cm ON cm.y_true = a.l AND cm.y_pred = b.l"""))
def q_confusion(spark, sf):
    """Dense confusion counts of the intent model."""
    return ev.confusion_matrix(rc.both_scored(spark, sf), "churned", "churned_PREDICTION")


@query("classification_report", "2.14", r6=_REP, sql=rc.sql(sp.classification_report("scored", Y, "churned_PREDICTION")))
def q_report_intent(spark, sf):
    """Per-class precision/recall/F1/support of the intent model, with averages."""
    return ev.classification_report(rc.both_scored(spark, sf), Y, "churned_PREDICTION")


@query("classification_report_rule", "2.14", r6=_REP,
       sql=rc.sql(sp.classification_report("scored", "true_churned", "churn_label")))
def q_report_rule(spark, sf):
    """Rule model report on the three-valued churn label."""
    return ev.classification_report(rc.both_scored(spark, sf), "true_churned", "churn_label")


@query("classification_report_binarised", "2.14", r6=_REP, sql=fixtures.with_views(sp.classification_report(
    "(SELECT CASE WHEN true_churned >= 1 THEN 1 ELSE 0 END AS y, churn_label FROM rule_preds)", "y", "churn_label"),
    "rule_preds"))
def q_report_binarised(spark, sf):
    """Rule model report with the churn label binarised (>= 1)."""
    from churnkit.functions.scalar import binarise
    r = fixtures.rule_preds(spark, sf).withColumn("y", binarise("true_churned"))
    return ev.classification_report(r, "y", "churn_label")


@query("roc_auc", "2.14", r6=_CURVE, sql=rc.sql(sp.curve_metrics("scored", Y, P)))
def q_roc_auc(spark, sf):
    """AUC (ties at half), KS, average precision and max MCC of the intent model."""
    return mt.curve_metrics(rc.both_scored(spark, sf), Y, P)


@query("roc_points", "2.14", r6=["threshold", "fpr", "tpr"], sql=rc.sql(
    f"SELECT score AS threshold, cum_neg / tot_neg AS fpr, cum_pos / tot_pos AS tpr FROM ({sp.score_table('scored', Y, P)}) s"))
def q_roc_points(spark, sf):
    """(FPR, TPR) at every distinct score."""
    return mt.roc_points(rc.both_scored(spark, sf), Y, P)


@query("pr_curve", "2.14", r6=["threshold", "precision", "recall"], sql=rc.sql(
    f"SELECT score AS threshold, cum_pos / (cum_pos + cum_neg) AS precision, cum_pos / tot_pos AS recall "
    f"FROM ({sp.score_table('scored', Y, P)}) s"))
def q_pr_curve(spark, sf):
    """(precision, recall) at every distinct score."""
    return mt.pr_points(rc.both_scored(spark, sf), Y, P)


@query("average_precision", "2.14", r6=["average_precision"], sql=rc.sql(
    f"SELECT pubcode, average_precision FROM ({sp.curve_metrics('scored', Y, P, ['pubcode'])}) c"))
def q_average_precision(spark, sf):
    """Average precision of the intent model per segment."""
    return mt.curve_metrics(rc.both_scored(spark, sf), Y, P, by=["pubcode"]).select("pubcode", "average_precision")


@query("roc_auc_rule_vs_true_churn", "2.14", r6=_CURVE, sql=fixtures.with_views(
    sp.curve_metrics("rule_preds", "true_churned", "bin_sum"), "rule_preds"))
def q_rule_auc(spark, sf):
    """Curve metrics of the rule score (bin sum) against the churn label."""
    return mt.curve_metrics(fixtures.rule_preds(spark, sf), "true_churned", "bin_sum")


def _segments_sql(seg: str) -> str:
    return f"""SELECT '{seg}' AS segment, CAST(c.{seg} AS VARCHAR) AS value, c.size, a.auc AS intent_auc, c.intent_precision,
  c.rule_precision FROM (
  SELECT {seg}, COUNT(*) AS size,
    COALESCE(CAST(COUNT(*) FILTER (WHERE churned_PREDICTION >= 1 AND churned >= 1) AS DOUBLE)
             / NULLIF(COUNT(*) FILTER (WHERE churned_PREDICTION >= 1), 0), 0.0) AS intent_precision,
    COALESCE(CAST(COUNT(*) FILTER (WHERE churn_label >= 1 AND true_churned >= 1) AS DOUBLE)
             / NULLIF(COUNT(*) FILTER (WHERE churn_label >= 1), 0), 0.0) AS rule_precision
  FROM scored WHERE {seg} IS NOT NULL GROUP BY {seg}) c
LEFT JOIN ({sp.curve_metrics(f'(SELECT * FROM scored WHERE {seg} IS NOT NULL)', Y, P, [seg])}) a ON a.{seg} = c.{seg}"""


@query("segment_metrics_all", "2.14", r6=["intent_auc", "intent_precision", "rule_precision"],
       sql=rc.sql(" UNION ALL ".join(f"SELECT * FROM ({_segments_sql(s)}) t" for s in ("pubcode", "idsystem", "risk_label"))))
def q_segments_all(spark, sf):
    """The segment report over every segment column (one of them the rule model's bucket)."""
    s = materialize(rc.both_scored(spark, sf))
    return ev.every_segment(s, ["pubcode", "idsystem", "risk_label"], lambda d, c: ev.segment_metrics(d, segment=c))


_SEG_SQL = rc.sql(f"""
SELECT c.pubcode, c.size, a.auc AS intent_auc, c.intent_precision, c.rule_precision FROM (
  SELECT pubcode, COUNT(*) AS size,
    COALESCE(CAST(COUNT(*) FILTER (WHERE churned_PREDICTION >= 1 AND churned >= 1) AS DOUBLE)
             / NULLIF(COUNT(*) FILTER (WHERE churned_PREDICTION >= 1), 0), 0.0) AS intent_precision,
    COALESCE(CAST(COUNT(*) FILTER (WHERE churn_label >= 1 AND true_churned >= 1) AS DOUBLE)
             / NULLIF(COUNT(*) FILTER (WHERE churn_label >= 1), 0), 0.0) AS rule_precision
  FROM scored WHERE pubcode IS NOT NULL GROUP BY pubcode) c
LEFT JOIN ({sp.curve_metrics('(SELECT * FROM scored WHERE pubcode IS NOT NULL)', Y, P, ['pubcode'])}) a
  ON a.pubcode = c.pubcode""")


@query("segment_metrics", "2.14", r6=["intent_auc", "intent_precision", "rule_precision"], sql=_SEG_SQL)
def q_segments(spark, sf):
    """Per segment: size, intent AUC, intent precision, rule precision."""
    return ev.segment_metrics(rc.both_scored(spark, sf))


@query("false_positive_rate_of_total", "2.14", r6=["intent_fp_rate", "rule_fp_rate"], sql=rc.sql(
    "SELECT CAST(COUNT(*) FILTER (WHERE churned_PREDICTION >= 1 AND churned = 0) AS DOUBLE) / COUNT(*) AS intent_fp_rate, "
    "CAST(COUNT(*) FILTER (WHERE churn_label >= 1 AND true_churned = 0) AS DOUBLE) / COUNT(*) AS rule_fp_rate FROM scored"))
def q_fp_rates(spark, sf):
    return ev.fp_rates(rc.both_scored(spark, sf))


@query("false_positive_shares", "2.14", r6=["share"], sql=rc.sql("""
SELECT model, pubcode, count, CAST(count AS DOUBLE) / SUM(count) OVER (PARTITION BY model) AS share FROM (
  SELECT 'intent' AS model, pubcode, COUNT(*) AS count FROM scored
  WHERE churned_PREDICTION >= 1 AND churned = 0 AND pubcode IS NOT NULL GROUP BY pubcode
  UNION ALL
  SELECT 'churn', pubcode, COUNT(*) FROM scored
  WHERE churn_label >= 1 AND true_churned = 0 AND pubcode IS NOT NULL GROUP BY pubcode) t"""))
def q_fp_shares(spark, sf):
    """Share of each segment among each model's false positives."""
    return ev.fp_shares(rc.both_scored(spark, sf))


@query("intent_churn_rates", "2.14", r6=["intent_churn_rate", "no_intent_churn_rate"], sql=rc.sql(
    "SELECT AVG(CASE WHEN has_intent THEN true_churned END) AS intent_churn_rate, "
    "AVG(CASE WHEN NOT has_intent THEN true_churned END) AS no_intent_churn_rate FROM scored"))
def q_intent_rates(spark, sf):
    """Mean churn label with and without a stated intent."""
    return ev.intent_rates(rc.both_scored(spark, sf))


@query("intent_subset_performance", "2.14", r6=["intent_model_auc", "rule_model_precision"], sql=rc.sql(f"""
SELECT a.auc AS intent_model_auc, p.rule_model_precision FROM
 ({sp.curve_metrics('(SELECT * FROM scored WHERE stop_intent_date IS NOT NULL)', Y, P)}) a,
 (SELECT COALESCE(CAST(COUNT(*) FILTER (WHERE churn_label >= 1 AND true_churned >= 1) AS DOUBLE)
                  / NULLIF(COUNT(*) FILTER (WHERE churn_label >= 1), 0), 0.0) AS rule_model_precision
  FROM scored WHERE stop_intent_date IS NOT NULL) p"""))
def q_intent_perf(spark, sf):
    """Intent AUC and rule precision on rows with a stated intent."""
    return ev.intent_performance(rc.both_scored(spark, sf))


@query("intent_by_segment", "2.14", r6=["share"], sql=rc.sql(
    "SELECT pubcode, COUNT(*) AS count, CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () AS share FROM scored "
    "WHERE stop_intent_date IS NOT NULL AND pubcode IS NOT NULL GROUP BY pubcode"))
def q_intent_segments(spark, sf):
    """Share of each segment among rows with a stated intent."""
    return ev.intent_segments(rc.both_scored(spark, sf))


_PRIO_COLS = "idsubscrip, observation_date, pubcode, churned, bin_sum, churned_1_PREDICTION, churn_priority, intent_priority"


@query("top_percent_priority", "2.5", sql=rc.sql(f"SELECT {_PRIO_COLS} FROM ({sp.priority('scored')}) p"))
def q_top_percent(spark, sf):
    """Top 10 % flags by rule score and by intent probability (ties by the row key)."""
    return ev.prioritize(rc.both_scored(spark, sf), 10).select(*[c.strip() for c in _PRIO_COLS.split(",")])


def _cost_benefit_sql(intent_target: str = "churned"):
    return rc.sql(f"""
WITH pr AS ({sp.priority('scored')}),
counts AS (
  SELECT 'churn' AS model,
    COUNT(*) FILTER (WHERE churn_priority AND churn_label >= 1 AND true_churned >= 1) AS tp,
    COUNT(*) FILTER (WHERE churn_priority AND churn_label >= 1 AND true_churned = 0) AS fp,
    COUNT(*) FILTER (WHERE churn_priority AND churn_label = 0 AND true_churned = 0) AS tn,
    COUNT(*) FILTER (WHERE churn_priority AND churn_label = 0 AND true_churned >= 1) AS fn,
    COUNT(*) FILTER (WHERE churn_priority) AS n FROM pr
  UNION ALL
  SELECT 'intent',
    COUNT(*) FILTER (WHERE intent_priority AND churned_PREDICTION >= 1 AND {intent_target} >= 1),
    COUNT(*) FILTER (WHERE intent_priority AND churned_PREDICTION >= 1 AND {intent_target} = 0),
    COUNT(*) FILTER (WHERE intent_priority AND churned_PREDICTION = 0 AND {intent_target} = 0),
    COUNT(*) FILTER (WHERE intent_priority AND churned_PREDICTION = 0 AND {intent_target} >= 1),
    COUNT(*) FILTER (WHERE intent_priority) FROM pr),
progs AS (SELECT * FROM (VALUES ('base', 9.0, 0.5, 0.0), ('optimistic', 9.0, 0.625, 9.6),
                                ('pessimistic', 9.0, 0.375, 0.0)) t(program, cost, success_rate, additional_value)),
money AS (SELECT program, model, tp, fp, tn, fn, n,
    tp * success_rate * 96.0 AS saved_revenue, tp * success_rate * additional_value AS additional_revenue,
    tp * cost AS intervention_costs, fp * cost AS wasted_costs, fn * 96.0 AS missed_revenue
  FROM counts CROSS JOIN progs)
SELECT program, model, tp AS "TP", fp AS "FP", tn AS "TN", fn AS "FN",
  CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall,
  CAST(tp + fp AS DOUBLE) / NULLIF(n, 0) AS intervention_rate,
  saved_revenue, additional_revenue, intervention_costs, wasted_costs, missed_revenue,
  saved_revenue + additional_revenue - intervention_costs - wasted_costs - missed_revenue AS net_impact,
  CASE WHEN intervention_costs > 0 THEN (saved_revenue + additional_revenue - intervention_costs - wasted_costs)
       / (intervention_costs + wasted_costs) ELSE 0.0 END AS roi
FROM money""")


_CB = ["precision", "recall", "intervention_rate", "saved_revenue", "additional_revenue", "intervention_costs",
       "wasted_costs", "missed_revenue", "net_impact", "roi"]


@query("cost_benefit", "2.14", r6=_CB, sql=_cost_benefit_sql())
def q_cost_benefit(spark, sf):
    """Top-10 % money per model and retention program (cost 9, value 96, success 0.5)."""
    return ev.cost_benefit(rc.both_scored(spark, sf), pct=10, intervention_cost=9, success_rate=0.5,
                           customer_value=8 * 12)


@query("cost_benefit_aligned_target", "2.14", r6=_CB, sql=_cost_benefit_sql("true_churned"))
def q_cost_benefit_aligned(spark, sf):
    """Same, with the intent model judged on the churn label."""
    cols = ev.EvalCols(intent_target="true_churned")
    return ev.cost_benefit(rc.both_scored(spark, sf), pct=10, intervention_cost=9, success_rate=0.5,
                           customer_value=8 * 12, cols=cols)


@query("intervention_strategy", "2.14", r6=["precision", "total_cost", "potential_savings", "net_impact", "roi"],
       sql=rc.sql(f"""
WITH pr AS ({sp.priority('scored')}),
c AS (SELECT 'churn' AS model, COUNT(*) FILTER (WHERE churn_priority) AS n,
        COUNT(*) FILTER (WHERE churn_priority AND true_churned >= 1) AS tp,
        COUNT(*) FILTER (WHERE churn_priority AND true_churned = 0) AS fp FROM pr
      UNION ALL
      SELECT 'intent', COUNT(*) FILTER (WHERE intent_priority),
        COUNT(*) FILTER (WHERE intent_priority AND churned >= 1),
        COUNT(*) FILTER (WHERE intent_priority AND churned = 0) FROM pr)
SELECT model, n AS n_interventions, tp AS true_positives, fp AS false_positives,
  CASE WHEN n > 0 THEN CAST(tp AS DOUBLE) / n ELSE 0.0 END AS precision, n * 9.0 AS total_cost,
  tp * 0.5 * 96.0 AS potential_savings, tp * 0.5 * 96.0 - n * 9.0 AS net_impact,
  CASE WHEN n * 9.0 > 0 THEN (tp * 0.5 * 96.0 - n * 9.0) / (n * 9.0) ELSE 0.0 END AS roi FROM c"""))
def q_intervention(spark, sf):
    """Treat every top-10 % row: counts, precision, cost, savings, net, ROI."""
    return ev.intervention_strategy(rc.both_scored(spark, sf), pct=10, intervention_cost=9, success_rate=0.5,
                                    customer_value=8 * 12)


@query("model_comparison", "2.14", r6=["intent_model", "churn_rules_model"], sql=rc.sql(f"""
WITH ri AS ({sp.classification_report('scored', Y, 'churned_PREDICTION')}),
     rr AS ({sp.classification_report('scored', 'true_churned', 'churn_label')}),
     bi AS (SELECT 'intent' AS model, SUM(CAST(churned_PREDICTION AS DOUBLE)) * 10.0 AS cost,
              COUNT(*) FILTER (WHERE churned_PREDICTION >= 1 AND churned >= 1) AS tp FROM scored
            UNION ALL SELECT 'churn', SUM(CAST(churn_label AS DOUBLE)) * 10.0,
              COUNT(*) FILTER (WHERE churn_label >= 1 AND true_churned >= 1) FROM scored),
     money AS (SELECT model, CASE WHEN cost > 0 THEN (tp * 100.0 - cost) / cost ELSE 0.0 END AS roi,
                 CASE WHEN tp > 0 THEN cost / tp ELSE CAST('inf' AS DOUBLE) END AS cpt FROM bi),
     long AS (
       SELECT 'intent' AS model, 'Precision' AS metric, precision AS value FROM ri WHERE label = '1.0'
       UNION ALL SELECT 'intent', 'Recall', recall FROM ri WHERE label = '1.0'
       UNION ALL SELECT 'intent', 'F1-Score', f1_score FROM ri WHERE label = '1.0'
       UNION ALL SELECT 'churn', 'Precision', precision FROM rr WHERE label = '1.0'
       UNION ALL SELECT 'churn', 'Recall', recall FROM rr WHERE label = '1.0'
       UNION ALL SELECT 'churn', 'F1-Score', f1_score FROM rr WHERE label = '1.0'
       UNION ALL SELECT model, 'ROI', roi FROM money
       UNION ALL SELECT model, 'Cost per True Positive', cpt FROM money)
SELECT metric, MAX(CASE WHEN model = 'intent' THEN value END) AS intent_model,
  MAX(CASE WHEN model = 'churn' THEN value END) AS churn_rules_model FROM long GROUP BY metric"""))
def q_model_comparison(spark, sf):
    """Metric x model: class-1 precision/recall/F1, ROI, cost per TP."""
    s = materialize(rc.both_scored(spark, sf))  # three reports read it
    return ev.model_comparison(ev.classification_report(s, Y, "churned_PREDICTION"),
                               ev.classification_report(s, "true_churned", "churn_label"),
                               ev.business_impact(s, 10, 100))


@query("days_to_churn_stats", "2.14", r6=["median_days", "mean_days", "std_days", "conversion_rate"], sql=rc.sql(
    "SELECT quantile_cont(d, 0.5) AS median_days, AVG(d) AS mean_days, STDDEV_SAMP(d) AS std_days, "
    "AVG(CASE WHEN true_churned >= 1 THEN CAST(stop_intent_date IS NOT NULL AS DOUBLE) END) AS conversion_rate "
    "FROM (SELECT *, CASE WHEN stop_intent_date IS NOT NULL AND observation_date IS NOT NULL "
    "THEN date_diff('day', observation_date, stop_intent_date) END AS d FROM merged) t", level="merged"))
def q_days_to_churn(spark, sf):
    """Days from observation to stated intent, and intent share among churners."""
    return ev.days_to_churn(rc.merged(spark, sf), "observation_date", "stop_intent_date", "true_churned")


_WB = ["n_pos", "n_neg", "auc", "ks", "average_precision", "max_mcc", "gini_norm", "logloss", "rmse", "fve_binomial"]


@query("weighted_binary_metrics", "2.14", r6=_WB, sql=rc.sql(f"""
SELECT c.*, 2 * c.auc - 1 AS gini_norm, p.logloss, p.rmse, p.fve_binomial FROM
 ({sp.curve_metrics('scored', Y, P, ['pubcode'])}) c JOIN (
  SELECT pubcode, sll / sw AS logloss, sqrt(sse / sw) AS rmse,
    1 - (sll / sw) / (-(ybar * ln(GREATEST(LEAST(ybar, 1 - 1e-15), 1e-15))
                        + (1 - ybar) * ln(1 - GREATEST(LEAST(ybar, 1 - 1e-15), 1e-15)))) AS fve_binomial
  FROM (SELECT pubcode, SUM(1.0) AS sw, SUM(yy) / SUM(1.0) AS ybar,
          SUM(-(yy * ln(pp) + (1 - yy) * ln(1 - pp))) AS sll, SUM((yy - p) * (yy - p)) AS sse
        FROM (SELECT pubcode, CASE WHEN churned >= 1 THEN 1.0 ELSE 0.0 END AS yy, CAST({P} AS DOUBLE) AS p,
                GREATEST(LEAST(CAST({P} AS DOUBLE), 1 - 1e-15), 1e-15) AS pp
              FROM scored WHERE {P} IS NOT NULL AND churned IS NOT NULL) r GROUP BY pubcode) a) p
 ON p.pubcode IS NOT DISTINCT FROM c.pubcode"""))
def q_weighted_binary(spark, sf):
    """Leaderboard metrics of the intent probability per segment."""
    return mt.weighted_binary_metrics(rc.both_scored(spark, sf), Y, P, by=["pubcode"])


@query("max_mcc", "2.14", r6=["max_mcc"], sql=rc.sql(f"SELECT max_mcc FROM ({sp.curve_metrics('scored', Y, P)}) c"))
def q_max_mcc(spark, sf):
    return mt.curve_metrics(rc.both_scored(spark, sf), Y, P).select("max_mcc")


def _rate_sql(pct):
    return rc.sql(f"""
SELECT AVG(CASE WHEN churned >= 1 THEN 1.0 ELSE 0.0 END) AS rate_at_top FROM (
  SELECT churned, CASE WHEN {P} IS NULL THEN false ELSE ROW_NUMBER() OVER (ORDER BY {P} DESC NULLS LAST,
    {rc.ROW_KEY_SQL}) <= CAST(FLOOR(COUNT(*) OVER () * {float(pct)} / 100) AS BIGINT) END AS top
  FROM scored) t WHERE top""")


@query("rate_at_top10", "2.14", r6=["rate_at_top"], sql=_rate_sql(10))
def q_rate10(spark, sf):
    """Churn rate among the top 10 % intent scores."""
    return mt.rate_at_top(rc.both_scored(spark, sf), Y, P, 10, rc.ROW_KEY)


@query("rate_at_top5", "2.14", r6=["rate_at_top"], sql=_rate_sql(5))
def q_rate5(spark, sf):
    return mt.rate_at_top(rc.both_scored(spark, sf), Y, P, 5, rc.ROW_KEY)


@query("balanced_accuracy", "2.14", r6=["balanced_accuracy"], sql=rc.sql(
    "SELECT (CAST(COUNT(*) FILTER (WHERE churned >= 1 AND churned_PREDICTION >= 1) AS DOUBLE) / COUNT(*) FILTER (WHERE churned >= 1)"
    " + CAST(COUNT(*) FILTER (WHERE NOT churned >= 1 AND NOT churned_PREDICTION >= 1) AS DOUBLE) / COUNT(*) FILTER (WHERE NOT churned >= 1)) / 2"
    " AS balanced_accuracy FROM scored"))
def q_balanced(spark, sf):
    return mt.balanced_accuracy(rc.both_scored(spark, sf), Y, "churned_PREDICTION")


_REG = ["rmse", "mae", "r_squared", "fve_poisson", "fve_gamma", "fve_tweedie"]


@query("regression_metrics", "2.14", r6=_REG, sql="""
SELECT sqrt(SUM((y - mu) * (y - mu)) / COUNT(*)) AS rmse, SUM(ABS(y - mu)) / COUNT(*) AS mae,
  1 - SUM((y - mu) * (y - mu)) / (SUM(y * y) - SUM(y) * SUM(y) / COUNT(*)) AS r_squared,
  1 - SUM(2 * (CASE WHEN y > 0 THEN y * ln(y / mu) ELSE 0 END - (y - mu))) / SUM(2 * (CASE WHEN y > 0 THEN y * ln(y / ybar) ELSE 0 END - (y - ybar))) AS fve_poisson,
  1 - SUM(2 * (ln(mu / y) + y / mu - 1)) / SUM(2 * (ln(ybar / y) + y / ybar - 1)) AS fve_gamma,
  1 - SUM(2 * (pow(y, 0.5) / ((1 - 1.5) * (2 - 1.5)) - y * pow(mu, 1 - 1.5) / (1 - 1.5) + pow(mu, 2 - 1.5) / (2 - 1.5)))
    / SUM(2 * (pow(y, 0.5) / ((1 - 1.5) * (2 - 1.5)) - y * pow(ybar, 1 - 1.5) / (1 - 1.5) + pow(ybar, 2 - 1.5) / (2 - 1.5))) AS fve_tweedie
FROM (SELECT l_extendedprice AS y, 1000.0 * l_quantity + 500.0 AS mu, AVG(l_extendedprice) OVER () AS ybar
      FROM lineitem WHERE l_extendedprice > 0) t""")
def q_regression(spark, sf):
    """Regression metrics of a per-unit price baseline for the line amount."""
    li = load(spark, sf, "lineitem", ["l_extendedprice", "l_quantity"]).where("l_extendedprice > 0")
    return mt.regression_metrics(li.withColumn("mu", F.col("l_quantity") * 1000.0 + 500.0), "l_extendedprice", "mu")


@query("retention_programs", "2.14", r6=["success_rate", "additional_value", "expected_saves", "expected_value"],
       sql=rc.sql(f"""
WITH pr AS ({sp.priority('scored')}),
tp AS (SELECT 'churn' AS model, COUNT(*) FILTER (WHERE churn_priority AND churn_label >= 1 AND true_churned >= 1) AS tp FROM pr
       UNION ALL SELECT 'intent', COUNT(*) FILTER (WHERE intent_priority AND churned_PREDICTION >= 1 AND churned >= 1) FROM pr),
progs AS (SELECT * FROM (VALUES ('base', 9.0, 0.5, 0.0), ('optimistic', 9.0, 0.625, 9.6),
                                ('pessimistic', 9.0, 0.375, 0.0)) t(program, cost, success_rate, additional_value))
SELECT program, CAST(cost AS DOUBLE) AS cost, success_rate, additional_value, model, tp * success_rate AS expected_saves,
  tp * success_rate * (96.0 + additional_value) AS expected_value FROM progs, tp"""))
def q_programs(spark, sf):
    """Base / optimistic / pessimistic programs applied to each model's top-10 % true positives."""
    cb = ev.cost_benefit(rc.both_scored(spark, sf), pct=10, intervention_cost=9, success_rate=0.5,
                         customer_value=8 * 12)
    progs = {p.name: p for p in ev.programs(9, 0.5, 96)}
    rate = F.create_map(*[x for n, p in progs.items() for x in (F.lit(n), F.lit(float(p.success_rate)))])
    extra = F.create_map(*[x for n, p in progs.items() for x in (F.lit(n), F.lit(float(p.additional_value)))])
    return cb.select("program", F.lit(9.0).alias("cost"), rate[F.col("program")].alias("success_rate"),
                     extra[F.col("program")].alias("additional_value"), "model",
                     (F.col("TP") * rate[F.col("program")]).alias("expected_saves"),
                     (F.col("TP") * rate[F.col("program")] * (F.lit(96.0) + extra[F.col("program")])).alias("expected_value"))


def _summary_sql():
    bi = ("SELECT model, interventions, true_positives, false_positives, total_cost, total_benefit, roi, "
          "cost_per_true_positive FROM bi")
    return rc.sql(f"""
WITH bi0 AS (
  SELECT 'intent' AS model, SUM(CAST(churned_PREDICTION AS DOUBLE)) AS interventions,
    COUNT(*) FILTER (WHERE churned_PREDICTION >= 1 AND churned >= 1) AS tp,
    COUNT(*) FILTER (WHERE churned_PREDICTION >= 1 AND churned = 0) AS fp FROM scored
  UNION ALL SELECT 'churn', SUM(CAST(churn_label AS DOUBLE)),
    COUNT(*) FILTER (WHERE churn_label >= 1 AND true_churned >= 1),
    COUNT(*) FILTER (WHERE churn_label >= 1 AND true_churned = 0) FROM scored),
bi AS (SELECT model, interventions, CAST(tp AS DOUBLE) AS true_positives, CAST(fp AS DOUBLE) AS false_positives,
         interventions * 10.0 AS total_cost, tp * 100.0 AS total_benefit,
         CASE WHEN interventions * 10.0 > 0 THEN (tp * 100.0 - interventions * 10.0) / (interventions * 10.0) ELSE 0.0 END AS roi,
         CASE WHEN tp > 0 THEN interventions * 10.0 / tp ELSE CAST('inf' AS DOUBLE) END AS cost_per_true_positive FROM bi0),
fp AS (SELECT CAST(COUNT(*) FILTER (WHERE churned_PREDICTION >= 1 AND churned = 0) AS DOUBLE) / COUNT(*) AS intent_fp,
         CAST(COUNT(*) FILTER (WHERE churn_label >= 1 AND true_churned = 0) AS DOUBLE) / COUNT(*) AS rule_fp FROM scored),
cv AS ({sp.curve_metrics('scored', Y, P)}),
ri AS ({sp.classification_report('scored', Y, 'churned_PREDICTION')}),
rr AS ({sp.classification_report('scored', 'true_churned', 'churn_label')})
SELECT 'business_impact' AS report, model, metric, value FROM
  (UNPIVOT ({bi}) ON interventions, true_positives, false_positives, total_cost, total_benefit, roi,
   cost_per_true_positive INTO NAME metric VALUE value) u
UNION ALL SELECT 'false_positives', 'intent', 'fp_rate', intent_fp FROM fp
UNION ALL SELECT 'false_positives', 'churn', 'fp_rate', rule_fp FROM fp
UNION ALL SELECT 'ranking', 'intent', metric, value FROM
  (UNPIVOT (SELECT auc, ks, average_precision, max_mcc FROM cv) ON auc, ks, average_precision, max_mcc
   INTO NAME metric VALUE value) u2
UNION ALL SELECT 'classification', 'intent', metric, value FROM
  (UNPIVOT (SELECT precision, recall, f1_score FROM ri WHERE label = '1.0') ON precision, recall, f1_score
   INTO NAME metric VALUE value) u3
UNION ALL SELECT 'classification', 'churn', metric, value FROM
  (UNPIVOT (SELECT precision, recall, f1_score FROM rr WHERE label = '1.0') ON precision, recall, f1_score
   INTO NAME metric VALUE value) u4""")


@query("evaluation_summary", "2.14", r6=["value"], sql=_summary_sql())
def q_summary(spark, sf):
    """Headline evaluation numbers from one written reconciled table (many reports, one scan)."""
    from churnkit.plans.evaluation import summary
    return summary(spark, sf)


_PURE = "CASE WHEN pubcode = '1' THEN NULL WHEN pubcode = '2' THEN 'pure' ELSE pubcode END"


@query("curve_metrics_odd_groups", "2.14", r6=["auc", "ks", "average_precision", "logloss"], sql=rc.sql(f"""
SELECT c.grp, c.n_pos, c.n_neg, c.auc, c.ks, c.average_precision, p.logloss FROM ({sp.curve_metrics('odd', 'y', 'p', ['grp'])}) c
JOIN (SELECT grp, AVG(-(y * ln(pp) + (1 - y) * ln(1 - pp))) AS logloss FROM (
        SELECT *, GREATEST(LEAST(p, 1 - 1e-15), 1e-15) AS pp FROM odd) t GROUP BY grp) p
  ON p.grp IS NOT DISTINCT FROM c.grp""", extra={"odd": f"SELECT {_PURE} AS grp, CASE WHEN pubcode = '2' THEN 1 ELSE churned END AS y, "
                                            f"CAST({P} AS DOUBLE) AS p FROM scored"}))
def q_odd_groups(spark, sf):
    """Ranking metrics by groups of which one has no name and one a single class."""
    s = rc.both_scored(spark, sf).select(F.expr(_PURE).alias("grp"), F.expr("CASE WHEN pubcode = '2' THEN 1 ELSE churned END").alias("y"),
                                         F.col(P).cast("double").alias("p"))
    return mt.weighted_binary_metrics(s, "y", "p", by=["grp"]).select(
        "grp", "n_pos", "n_neg", "auc", "ks", "average_precision", "logloss")


_MONTHS = ("SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS y, "
           "COUNT(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS yhat FROM orders GROUP BY 1, 2")


@query("mase", "2.14", r6=["mase"], sql=f"""
SELECT o_orderpriority, AVG(ABS(y - yhat)) / NULLIF(AVG(step), 0) AS mase FROM (
  SELECT *, ABS(y - LAG(y) OVER (PARTITION BY o_orderpriority ORDER BY month)) AS step FROM ({_MONTHS}) m) t
GROUP BY o_orderpriority""")
def q_mase(spark, sf):
    """Scaled error of a monthly count (orders without partial ones) per order priority."""
    m = load(spark, sf, "orders", ["o_orderpriority", "o_orderdate", "o_orderstatus"]).groupBy(
        "o_orderpriority", F.expr("CAST(date_trunc('month', o_orderdate) AS DATE)").alias("month")).agg(
        F.count(F.lit(1)).alias("y"), F.count(F.when(F.col("o_orderstatus") != "P", 1)).alias("yhat"))
    return mt.mase(m, "y", "yhat", "month", ["o_orderpriority"])

"""Queries: profiling, counts, shares, histograms, duplicates (§2.2, §2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnkit.operators import dedup, profile as pf
from churnkit.plans import reconcile as rc
from churnkit.plans.registry import query
from churnkit.sources import fixtures, load

EVENT_TYPES = [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
               ("event_type", "string"), ("value", "double"), ("props", "string")]
_NUMERIC = {"bigint", "double", "int"}


def _profile_sql():
    parts = []
    for c, t in EVENT_TYPES:
        if t in _NUMERIC:
            parts.append(f"SELECT '{c}' AS \"column\", '{t}' AS dtype, COUNT(DISTINCT {c}) AS n_distinct, "
                         f"COUNT(*) - COUNT({c}) AS n_missing, AVG(CAST({c} AS DOUBLE)) AS mean, "
                         f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median FROM events")
        else:
            parts.append(f"SELECT '{c}', '{t}', COUNT(DISTINCT {c}), COUNT(*) - COUNT({c}), "
                         "CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM events")
    return "\nUNION ALL\n".join(parts)


@query("feature_profile", "2.4", sql=_profile_sql(), r6=["mean", "median"])
def q_feature_profile(spark, sf):
    """Type, distinct count, missing count, mean, median of every events column."""
    return pf.feature_profile(load(spark, sf, "events"))


@query("feature_profile_sketch", "2.4")
def q_feature_profile_sketch(spark, sf):
    """Profile in sketch mode (HyperLogLog distinct counts, approximate median): one pass over lineitem."""
    return pf.feature_profile(load(spark, sf, "lineitem"), exact=False)


@query("table_shape", "2.4", sql="SELECT COUNT(*) AS n_rows, 6 AS n_cols, COUNT(DISTINCT o_custkey) AS n_ids FROM orders")
def q_table_shape(spark, sf):
    return pf.table_shape(load(spark, sf, "orders"), "o_custkey")


_ORDER_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]


@query("table_info", "2.4", sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS dtype, COUNT({c}) AS non_null FROM orders" for c, t in _ORDER_TYPES))
def q_table_info(spark, sf):
    return pf.table_info(load(spark, sf, "orders"))


@query("distinct_values", "2.4",
       sql=fixtures.with_views("SELECT DISTINCT observation_date FROM intent_preds", "intent_preds"))
def q_distinct_values(spark, sf):
    """Distinct prediction dates of the intent model."""
    return fixtures.intent_preds(spark, sf).select("observation_date").distinct()


def _describe_sql(src: str, cols, by=None, where="TRUE"):
    parts = []
    for c in cols:
        b = f"{by}, " if by else ""
        g = f" GROUP BY {by}" if by else ""
        parts.append(
            f"SELECT {b}'{c}' AS \"column\", COUNT({c}) AS count, AVG({c}) AS mean, STDDEV_SAMP({c}) AS std, "
            f"CAST(MIN({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, "
            f"quantile_cont({c}, 0.75) AS p75, CAST(MAX({c}) AS DOUBLE) AS max FROM {src} WHERE {c} IS NOT NULL AND {where}{g}")
    return "\nUNION ALL\n".join(parts)


_DESC = ["mean", "std", "min", "p25", "p50", "p75", "max"]


@query("describe_numeric", "2.4", r6=_DESC,
       sql=rc.sql(_describe_sql("collapsed", rc.INTENT_VALS), level="collapsed"))
def q_describe(spark, sf):
    """count/mean/std/min/quartiles/max of the averaged predictions."""
    return pf.describe(rc.collapsed_intent(spark, sf), rc.INTENT_VALS)


@query("describe_by_group", "2.4", r6=_DESC,
       sql=rc.sql(_describe_sql("merged", ["days_to_intent"], by="true_churned", where="has_stop_intent"),
                  level="merged"))
def q_describe_by_group(spark, sf):
    """Days to intent by true churn label, rows with a stated intent."""
    m = rc.merged(spark, sf).where(F.col("has_stop_intent"))
    return pf.describe(m, ["days_to_intent"], by=["true_churned"])


_ALIGN_SQL = rc.sql("""
SELECT alignment, 'days_to_intent' AS "column", COUNT(days_to_intent) AS count, AVG(days_to_intent) AS mean,
  STDDEV_SAMP(days_to_intent) AS std, CAST(MIN(days_to_intent) AS DOUBLE) AS min,
  quantile_cont(days_to_intent, 0.25) AS p25, quantile_cont(days_to_intent, 0.5) AS p50,
  quantile_cont(days_to_intent, 0.75) AS p75, CAST(MAX(days_to_intent) AS DOUBLE) AS max
FROM (
  SELECT CASE WHEN churned = true_churned THEN 'aligned' ELSE 'misaligned' END AS alignment, days_to_intent
  FROM merged WHERE churned IS NOT NULL AND true_churned IS NOT NULL AND days_to_intent IS NOT NULL
  UNION ALL SELECT 'overall', days_to_intent FROM merged WHERE days_to_intent IS NOT NULL) t
GROUP BY alignment""", level="merged")


@query("describe_by_alignment", "2.4", r6=_DESC, sql=_ALIGN_SQL)
def q_describe_alignment(spark, sf):
    """Days to intent where true labels agree / disagree, and overall."""
    return pf.alignment_describe(rc.merged(spark, sf), "churned", "true_churned", "days_to_intent")


_VC_SQL = fixtures.with_views("""
SELECT risk_label, bin_sum, COUNT(*) AS count, COUNT(*) / SUM(COUNT(*)) OVER () AS share
FROM rule_preds WHERE risk_label IS NOT NULL AND bin_sum IS NOT NULL GROUP BY risk_label, bin_sum""", "rule_preds")


@query("value_counts", "2.4", sql=_VC_SQL, r6=["share"])
def q_value_counts(spark, sf):
    """Counts and shares of (risk label, bin sum) of the rule model."""
    return pf.value_counts(fixtures.rule_preds(spark, sf), ["risk_label", "bin_sum"])


@query("value_shares", "2.4", r6=["share"], sql=fixtures.with_views(
    "SELECT true_churned, COUNT(*) AS count, COUNT(*) / SUM(COUNT(*)) OVER () AS share "
    "FROM rule_preds WHERE true_churned IS NOT NULL GROUP BY true_churned", "rule_preds"))
def q_value_shares(spark, sf):
    """Share of each true churn label (0/1/2) of the rule model."""
    return pf.value_counts(fixtures.rule_preds(spark, sf), ["true_churned"])


@query("grouped_value_shares", "2.4", r6=["share"], sql=rc.sql(
    "SELECT true_churned, has_stop_intent, COUNT(*) AS count, "
    "COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY true_churned) AS share FROM merged "
    "WHERE true_churned IS NOT NULL AND has_stop_intent IS NOT NULL GROUP BY 1, 2", level="merged"))
def q_grouped_shares(spark, sf):
    """Within each true churn label: counts and shares of stated intent."""
    return pf.grouped_value_shares(rc.merged(spark, sf), "true_churned", "has_stop_intent")


@query("cross_tab_filtered", "2.4", r6=["share"], sql=rc.sql(
    "SELECT days_to_intent, COUNT(*) AS count, COUNT(*) / SUM(COUNT(*)) OVER () AS share FROM merged "
    "WHERE has_stop_intent AND true_churned = 1 AND days_to_intent IS NOT NULL GROUP BY 1", level="merged"))
def q_cross_tab(spark, sf):
    """Day-gap counts of churned rows with a stated intent."""
    m = rc.merged(spark, sf).where(F.col("has_stop_intent") & (F.col("true_churned") == 1))
    return pf.value_counts(m, ["days_to_intent"])


@query("high_score_slice", "2.2", r6=["share"], sql=rc.sql(
    "SELECT has_stop_intent, COUNT(*) AS count, COUNT(*) / SUM(COUNT(*)) OVER () AS share FROM collapsed "
    "WHERE churned_1_PREDICTION > 0.8 GROUP BY 1", level="collapsed"))
def q_high_score(spark, sf):
    """Rows scored above 0.8: counts of stated intent."""
    c = rc.collapsed_intent(spark, sf).where(F.col("churned_1_PREDICTION") > 0.8)
    return pf.value_counts(c, ["has_stop_intent"])


def _hist_sql(src, col, bins, level=None, view=None):
    body = f"""
SELECT b.bin, mn + b.bin * w AS lo, mn + (b.bin + 1) * w AS hi, COALESCE(c.cnt, 0) AS count
FROM (SELECT mn, CASE WHEN mx > mn THEN (mx - mn) / {bins} ELSE 1.0 END AS w,
             CASE WHEN mx > mn THEN mx - mn ELSE 1.0 END AS rng
      FROM (SELECT CAST(MIN({col}) AS DOUBLE) mn, CAST(MAX({col}) AS DOUBLE) mx FROM {src})) s
CROSS JOIN (SELECT CAST(range AS INT) AS bin FROM range({bins})) b
LEFT JOIN (SELECT LEAST(CAST(FLOOR((CAST({col} AS DOUBLE) - s2.mn) / s2.rng * {bins}) AS INT), {bins - 1}) AS bin,
                  COUNT(*) AS cnt
           FROM {src}, (SELECT CAST(MIN({col}) AS DOUBLE) mn,
                          CASE WHEN MAX({col}) > MIN({col}) THEN CAST(MAX({col}) AS DOUBLE) - MIN({col}) ELSE 1.0 END rng
                        FROM {src}) s2
           WHERE {col} IS NOT NULL GROUP BY 1) c ON c.bin = b.bin"""
    return rc.sql(body, level=level) if level else fixtures.with_views(body, view)


@query("histogram_bins", "2.4", r6=["lo", "hi"], sql=_hist_sql("collapsed", "churned_1_PREDICTION", 60, level="collapsed"))
def q_histogram(spark, sf):
    """60 equal-width bins of the averaged intent probability."""
    return pf.histogram(rc.collapsed_intent(spark, sf), "churned_1_PREDICTION", 60)


@query("histogram_rule_bins", "2.4", r6=["lo", "hi"], sql=_hist_sql("rule_preds", "bin_sum", 15, view="rule_preds"))
def q_histogram_rule(spark, sf):
    """15 equal-width bins of the rule model's bin sum."""
    return pf.histogram(fixtures.rule_preds(spark, sf), "bin_sum", 15)


_DUP_COLS = ["n", "churned_1_PREDICTION_mean", "churned_1_PREDICTION_min", "churned_1_PREDICTION_max",
             "churned_1_PREDICTION_std", "churned_mean", "churned_min", "churned_max", "churned_std"]
_DUP_SQL = """
SELECT idsubscrip, observation_date, COUNT(*) AS n,
  AVG(churned_1_PREDICTION) AS churned_1_PREDICTION_mean, MIN(churned_1_PREDICTION) AS churned_1_PREDICTION_min,
  MAX(churned_1_PREDICTION) AS churned_1_PREDICTION_max, STDDEV_SAMP(churned_1_PREDICTION) AS churned_1_PREDICTION_std,
  AVG(CAST(churned AS DOUBLE)) AS churned_mean, CAST(MIN(churned) AS DOUBLE) AS churned_min,
  CAST(MAX(churned) AS DOUBLE) AS churned_max, STDDEV_SAMP(CAST(churned AS DOUBLE)) AS churned_std
FROM intent_preds GROUP BY idsubscrip, observation_date HAVING COUNT(*) >= 2"""


@query("key_duplicate_report", "2.4", r6=_DUP_COLS[1:], sql=fixtures.with_views(_DUP_SQL, "intent_preds"))
def q_key_dups(spark, sf):
    """Per duplicated (subscriber, date): size and stats of score and label."""
    return dedup.key_duplicate_report(fixtures.intent_preds(spark, sf), ["idsubscrip", "observation_date"],
                                      ["churned_1_PREDICTION", "churned"])


@query("label_conflict_report", "2.4", r6=_DUP_COLS[1:],
       sql=fixtures.with_views(f"SELECT * FROM ({_DUP_SQL}) d WHERE churned_std > 0", "intent_preds"))
def q_label_conflicts(spark, sf):
    """Duplicated keys whose churn label differs between copies."""
    return dedup.label_conflicts(fixtures.intent_preds(spark, sf), ["idsubscrip", "observation_date"],
                                 "churned", "churned_1_PREDICTION")


@query("label_conflict_spread", "2.4", r6=_DESC, sql=fixtures.with_views(
    _describe_sql(f"({_DUP_SQL}) d", ["churned_1_PREDICTION_std"]), "intent_preds"))
def q_label_spread(spark, sf):
    """describe of the score std over duplicated keys."""
    rep = dedup.key_duplicate_report(fixtures.intent_preds(spark, sf), ["idsubscrip", "observation_date"],
                                     ["churned_1_PREDICTION", "churned"])
    return pf.describe(rep, ["churned_1_PREDICTION_std"])


@query("scored_sanity", "2.4", r6=["avg_prediction"], sql=rc.sql(
    "SELECT COUNT(*) AS n_rows, AVG(CAST(churned_1_PREDICTION AS DOUBLE)) AS avg_prediction FROM collapsed",
    level="collapsed"))
def q_scored_sanity(spark, sf):
    return pf.scored_summary(rc.collapsed_intent(spark, sf), "churned_1_PREDICTION")


@query("class_balance", "2.4", sql=fixtures.with_views(
    "SELECT COUNT(*) FILTER (WHERE target_column > 0) AS positive_count, COUNT(*) AS total_count, "
    "COUNT(*) - COUNT(*) FILTER (WHERE target_column > 0) AS negative_count FROM downsample_base", "downsample_base"))
def q_class_balance(spark, sf):
    return pf.class_balance(fixtures.downsample_base(spark, sf), "target_column")


@query("merge_coverage", "2.4", sql=rc.sql(
    "SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE true_churned IS NULL) AS left_only, "
    "COUNT(*) FILTER (WHERE churned IS NULL) AS right_only, "
    "COUNT(*) FILTER (WHERE churned IS NOT NULL AND true_churned IS NOT NULL) AS both_models FROM merged",
    level="merged"))
def q_merge_coverage(spark, sf):
    """Total, intent-only, rule-only and both after the merge."""
    return pf.merge_coverage(rc.merged(spark, sf), "churned", "true_churned").withColumnRenamed("both", "both_models")


@query("agreement_rate", "2.4", r6=["target_agreement", "prediction_agreement"], sql=rc.sql(
    "SELECT AVG(CASE WHEN churned IS NOT NULL AND true_churned IS NOT NULL THEN CAST(churned = true_churned AS DOUBLE) END) "
    "AS target_agreement, AVG(CASE WHEN churned_PREDICTION IS NOT NULL AND churn_label IS NOT NULL "
    "THEN CAST(churned_PREDICTION = churn_label AS DOUBLE) END) AS prediction_agreement FROM merged", level="merged"))
def q_agreement(spark, sf):
    """Share of equal true labels and of equal predicted labels."""
    m = rc.merged(spark, sf)
    return m.agg(pf.agreement_rate(m, "churned", "true_churned").alias("target_agreement"),
                 pf.agreement_rate(m, "churned_PREDICTION", "churn_label").alias("prediction_agreement"))


@query("cross_tab_filtered_any_churn", "2.4", r6=["share"], sql=rc.sql(
    "SELECT days_to_intent, COUNT(*) AS count, COUNT(*) / SUM(COUNT(*)) OVER () AS share FROM merged "
    "WHERE has_stop_intent AND true_churned >= 1 AND days_to_intent IS NOT NULL GROUP BY 1", level="merged"))
def q_cross_tab_any(spark, sf):
    """Day-gap counts of rows with a stated intent and any churn label (1 or 2)."""
    m = rc.merged(spark, sf).where(F.col("has_stop_intent") & (F.col("true_churned") >= 1))
    return pf.value_counts(m, ["days_to_intent"])


@query("high_score_day_gaps", "2.2", r6=["share"], sql=rc.sql(
    "SELECT days_to_intent, COUNT(*) AS count, COUNT(*) / SUM(COUNT(*)) OVER () AS share FROM collapsed "
    "WHERE churned_1_PREDICTION > 0.8 AND days_to_intent IS NOT NULL GROUP BY 1", level="collapsed"))
def q_high_score_gaps(spark, sf):
    """Rows scored above 0.8: counts of the day gap to the stated intent."""
    c = rc.collapsed_intent(spark, sf).where(F.col("churned_1_PREDICTION") > 0.8)
    return pf.value_counts(c, ["days_to_intent"])


@query("value_counts_keep_nulls", "2.4", r6=["share"], sql=rc.sql(
    "SELECT true_churned, churn_label, COUNT(*) AS count, COUNT(*) / SUM(COUNT(*)) OVER () AS share FROM merged "
    "GROUP BY 1, 2", level="merged"))
def q_value_counts_nulls(spark, sf):
    """(true label, rule label) counts after the merge, null pairs kept (dropna=False)."""
    return pf.value_counts(rc.merged(spark, sf), ["true_churned", "churn_label"], dropna=False)


@query("value_counts_events", "2.4", r6=["share"], sql=(
    "SELECT event_type, COUNT(*) AS count, COUNT(*) / SUM(COUNT(*)) OVER () AS share FROM events "
    "WHERE event_type IS NOT NULL GROUP BY event_type"))
def q_event_types(spark, sf):
    """Counts and shares of event types."""
    return pf.value_counts(load(spark, sf, "events", ["event_type"]), ["event_type"])


def _hist_events_sql(bins: int) -> str:
    return f"""
WITH e AS (SELECT CAST(value AS DOUBLE) AS v FROM events WHERE value IS NOT NULL),
s AS (SELECT MIN(v) AS mn, MAX(v) AS mx FROM e),
c AS (SELECT LEAST(CAST(FLOOR((v - s.mn) / CASE WHEN s.mx > s.mn THEN s.mx - s.mn ELSE 1.0 END * {bins}) AS INT),
                   {bins - 1}) AS bin, COUNT(*) AS cnt FROM e, s GROUP BY 1)
SELECT b.bin, s.mn + b.bin * w.w AS lo, s.mn + (b.bin + 1) * w.w AS hi, COALESCE(c.cnt, 0) AS count
FROM s, (SELECT CASE WHEN mx > mn THEN (mx - mn) / {bins} ELSE 1.0 END AS w FROM s) w,
     (SELECT CAST(range AS INT) AS bin FROM range({bins})) b LEFT JOIN c ON c.bin = b.bin"""


@query("histogram_events_value", "2.4", r6=["lo", "hi"], sql=_hist_events_sql(20))
def q_event_hist(spark, sf):
    """20 equal-width bins of event values."""
    return pf.histogram(load(spark, sf, "events", ["value"]), "value", 20)


_BIG = "9007199254740992 + o_orderkey"


@query("feature_profile_bigint", "2.4", r6=["mean", "median"], sql=f"""
SELECT 'big' AS "column", 'bigint' AS dtype, COUNT(DISTINCT {_BIG}) AS n_distinct, 0 AS n_missing,
  AVG(CAST({_BIG} AS DOUBLE)) / 1e15 AS mean, quantile_cont(CAST({_BIG} AS DOUBLE), 0.5) / 1e15 AS median FROM orders
UNION ALL SELECT 'holes', 'double', COUNT(DISTINCT o_totalprice) FILTER (WHERE o_custkey % 3 > 0),
  COUNT(*) FILTER (WHERE o_custkey % 3 = 0), AVG(o_totalprice) FILTER (WHERE o_custkey % 3 > 0) / 1e15,
  quantile_cont(o_totalprice, 0.5) FILTER (WHERE o_custkey % 3 > 0) / 1e15 FROM orders""")
def q_profile_bigint(spark, sf):
    """Profile of 64-bit ids beyond a double's digits, and of a column whose missing values are NaN."""
    o = load(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    df = o.select((F.lit(9007199254740992) + F.col("o_orderkey")).alias("big"),
                  F.when(F.col("o_custkey") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice").cast("double")).alias("holes"))
    p = pf.feature_profile(df)
    return p.select("column", "dtype", "n_distinct", "n_missing", (F.col("mean") / 1e15).alias("mean"),
                    (F.col("median") / 1e15).alias("median"))


@query("describe_by_predicted_alignment", "2.4", r6=_DESC, sql=_ALIGN_SQL.replace(
    "churned = true_churned", "round_even(churned_PREDICTION, 0) = churn_label").replace(
    "churned IS NOT NULL AND true_churned IS NOT NULL", "churned_PREDICTION IS NOT NULL AND churn_label IS NOT NULL"))
def q_describe_predicted_alignment(spark, sf):
    """Days to intent where the two models' predicted labels agree / disagree, and overall."""
    m = rc.merged(spark, sf).withColumn("intent_label", F.bround("churned_PREDICTION", 0))
    return pf.alignment_describe(m, "intent_label", "churn_label", "days_to_intent")

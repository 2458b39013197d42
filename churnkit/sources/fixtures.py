"""Input tables of the churn workflow, derived from the test tables.

Each fixture exists twice, with the same expressions: as a DataFrame built
from Parquet scans (what the library runs) and as SQL text (what the DuckDB
oracle runs).  The first seven expressions of ``intent_preds`` and the views
``rule_preds``, ``feature_impacts``, ``leaderboard`` and ``downsample_base``
are the portable views of FIXTURES.md section 2; the extra columns fill in the
rest of the schemas of FIXTURES.md section 1 from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.sources.tables import load

# ---------------------------------------------------------------- intent_preds
_CHURNED = "CASE WHEN o_orderstatus='F' AND o_custkey % 5 = 0 THEN 1 ELSE 0 END"
_P1 = ("CAST((o_orderkey * 48271) % 700 + CASE WHEN o_orderstatus='F' AND o_custkey % 5 = 0 "
       "THEN 300 ELSE 0 END AS DOUBLE) / 1000")
INTENT_THRESHOLD = 0.5
INTENT_EXPRS = [
    "o_custkey AS idsubscrip",
    "CAST(o_custkey % 3 AS INT) AS idsystem",
    "substr(o_orderpriority,1,1) AS pubcode",
    "CAST(date_trunc('month', o_orderdate) AS DATE) AS observation_date",
    f"{_CHURNED} AS churned",
    "CASE WHEN o_custkey % 14 = 0 THEN CAST(date_trunc('month', o_orderdate) AS DATE) "
    "+ CAST(o_custkey % 60 AS INT) END AS stop_intent_date",
    f"{_P1} AS churned_1_PREDICTION",
    f"1 - {_P1} AS churned_0_PREDICTION",
    f"CAST({_P1} >= CAST({INTENT_THRESHOLD} AS DOUBLE) AS DOUBLE) AS churned_PREDICTION",
    f"CAST({INTENT_THRESHOLD} AS DOUBLE) AS THRESHOLD",
    "'1' AS POSITIVE_CLASS",
    "'APPROVED' AS DEPLOYMENT_APPROVAL_STATUS",
    "'OK' AS prediction_status",
]

# ------------------------------------------------------------------ rule_preds
# the rule model scores ten days after the order: some keys meet no intent score, and the other way round
RULE_KEYS = [
    "o_custkey AS idsubscrip",
    "CAST(date_trunc('month', CAST(o_orderdate AS DATE) + 10) AS DATE) AS inference_date",
]
RULE_AGGS = [
    "CAST(SUM(CAST(FLOOR(o_totalprice) AS BIGINT)) % 16 AS INT) AS bin_sum",
    "MAX(CASE WHEN o_orderstatus='F' AND o_custkey % 20 = 0 THEN 2 "
    "WHEN o_orderstatus='F' AND o_custkey % 20 = 5 THEN 1 ELSE 0 END) AS true_churned",
]
RULE_OUTER = [
    "idsubscrip", "inference_date", "bin_sum",
    "CASE WHEN bin_sum >= 12 THEN 'High' WHEN bin_sum >= 6 THEN 'Medium' ELSE 'Low' END AS risk_label",
    "CASE WHEN bin_sum >= 12 THEN 1 ELSE 0 END AS churn_label",
    "true_churned",
]

# ------------------------------------------------------------- feature_impacts
# Model type names attached to the five synthetic model ids.
MODEL_TYPES = [
    "Gradient Boosted Trees Classifier",
    "Elastic-Net Logistic Classifier",
    "Histogram Gradient Boosted Trees Classifier",
    "Gradient Boosting on Linear Predictions",
    "Generalized Additive Model",
]
_MT_CASE = ("CASE model_id " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(MODEL_TYPES))
            + " END")
IMPACT_KEYS = ["CAST(l_suppkey % 5 AS INT) AS model_id",
               "concat('f', CAST(l_partkey % 60 AS STRING)) AS featureName",
               "CASE WHEN l_partkey % 60 % 11 = 10 THEN concat('f', CAST(l_partkey % 60 - 1 AS STRING)) "
               "END AS redundantWith"]
IMPACT_AGG = "CAST(SUM(CAST(l_quantity AS BIGINT)) - 4200 AS DOUBLE) / 1000 AS impactUnnormalized"

# ----------------------------------------------------------------- leaderboard
# Model types cycled over the synthetic leaderboard; the first
# four phrases are the names the candidate filter removes.
LB_MODEL_TYPES = [
    "Baseline Predictions from Last Value",
    "Mean Response Classifier",
    "Majority Class Classifier",
    "Auto-Tuned Text Classifier",
    "Gradient Boosted Trees Classifier with Early Stopping",
    "Histogram Gradient Boosted Trees Classifier",
    "Elastic-Net Logistic Classifier",
    "Generalized Additive Model",
    "Random Forest Classifier (Gini)",
    "Residual Neural Network Classifier",
    "Gradient Boosting on Linear Predictions",
]
_LB_MT_CASE = ("CASE s_suppkey % 11 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(LB_MODEL_TYPES))
               + " END")
REDUCED_MARKER = "Reduced list M"  # marks automatically reduced lists in this leaderboard
LB_EXPRS = [
    "s_suppkey AS model_id",
    "CASE WHEN s_suppkey % 9 = 0 THEN 'blend' ELSE 'model' END AS model_category",
    "s_suppkey % 13 = 0 AS is_frozen",
    f"CASE WHEN s_suppkey % 17 = 5 THEN concat('{REDUCED_MARKER}', CAST(s_suppkey % 5 AS STRING)) "
    "ELSE concat('fl', CAST(s_nationkey % 4 AS STRING)) END AS featurelist_name",
    "CAST(s_suppkey % 6 AS STRING) AS blueprint_id",
    "CAST(5 + s_suppkey % 40 AS INT) AS n_features",
    "CAST(s_suppkey * 37 % 11 AS DOUBLE) / 10 AS auc_validation",
    "CASE WHEN s_suppkey % 3 = 0 THEN CAST(s_suppkey * 53 % 10 AS DOUBLE) / 10 END AS auc_backtesting",
    f"{_LB_MT_CASE} AS model_type",
    "CAST(s_suppkey * 29 % 17 AS DOUBLE) / 20 AS logloss_validation",
    "CASE WHEN s_suppkey % 3 = 0 THEN CAST(s_suppkey * 31 % 17 AS DOUBLE) / 20 END AS logloss_backtesting",
    "CASE WHEN s_suppkey % 4 = 0 THEN CAST(s_suppkey * 41 % 11 AS DOUBLE) / 10 END AS auc_holdout",
]

# ------------------------------------------------------------- downsample_base
DOWNSAMPLE_EXPRS = [
    "l_orderkey * 8 + l_linenumber AS row_key", "l_quantity", "l_extendedprice", "l_discount",
    "CASE WHEN l_orderkey % 14 = 0 THEN 1 ELSE 0 END AS target_column",
]

# Fixed value: metric metadata (name, ascending) for the leaderboard metrics.
METRIC_DIRECTIONS = [
    ("AUC", False), ("Weighted AUC", False), ("LogLoss", True), ("Weighted LogLoss", True),
    ("RMSE", True), ("Gini Norm", False), ("Kolmogorov-Smirnov", False), ("Max MCC", False),
    ("Rate@Top10%", False), ("Rate@Top5%", False), ("FVE Binomial", False),
    ("Area Under PR Curve", False),
]


# ====================================================================== Spark
def intent_preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.selectExpr(*INTENT_EXPRS)


def rule_preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    keys = [F.expr(e) for e in RULE_KEYS]
    return (o.groupBy(*keys).agg(*[F.expr(e) for e in RULE_AGGS])
            .selectExpr(*RULE_OUTER))


def feature_impacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem", ["l_suppkey", "l_partkey", "l_quantity"])
    grouped = li.groupBy(F.expr("l_suppkey % 5").alias("_m"), F.expr("l_partkey % 60").alias("_f"))
    return (grouped.agg(F.expr(IMPACT_AGG))
            .selectExpr("CAST(_m AS INT) AS model_id",
                        "concat('f', CAST(_f AS STRING)) AS featureName",
                        "impactUnnormalized",
                        "CASE WHEN _f % 11 = 10 THEN concat('f', CAST(_f - 1 AS STRING)) END AS redundantWith")
            .withColumn("model_type", F.expr(_MT_CASE)))


def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    return s.selectExpr(*LB_EXPRS)


def downsample_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity",
                                          "l_extendedprice", "l_discount"])
    return li.selectExpr(*DOWNSAMPLE_EXPRS)


def metric_meta(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(METRIC_DIRECTIONS, "metric_name string, ascending boolean")


# ===================================================================== DuckDB
def _sql_intent() -> str:
    return f"SELECT {', '.join(INTENT_EXPRS)} FROM orders"


def _sql_rule() -> str:
    inner = (f"SELECT {', '.join(RULE_KEYS)}, {', '.join(RULE_AGGS)} FROM orders GROUP BY 1, 2")
    return f"SELECT {', '.join(RULE_OUTER)} FROM ({inner}) t"


def _sql_impacts() -> str:
    inner = (f"SELECT {', '.join(IMPACT_KEYS)}, {IMPACT_AGG} FROM lineitem "
             "GROUP BY l_suppkey % 5, l_partkey % 60")
    return f"SELECT *, {_MT_CASE} AS model_type FROM ({inner}) t"


def _sql_leaderboard() -> str:
    return f"SELECT {', '.join(LB_EXPRS)} FROM supplier"


def _sql_downsample() -> str:
    return f"SELECT {', '.join(DOWNSAMPLE_EXPRS)} FROM lineitem"


def _sql_metric_meta() -> str:
    rows = ", ".join(f"('{m}', {str(a).lower()})" for m, a in METRIC_DIRECTIONS)
    return f"SELECT * FROM (VALUES {rows}) t(metric_name, ascending)"


SQL = {
    "intent_preds": _sql_intent,
    "rule_preds": _sql_rule,
    "feature_impacts": _sql_impacts,
    "leaderboard": _sql_leaderboard,
    "downsample_base": _sql_downsample,
    "metric_meta": _sql_metric_meta,
}


def with_views(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with CTEs for the named fixture views (and extra CTEs)."""
    ctes = [f"{n} AS ({SQL[n]()})" for n in names]
    for k, v in (extra or {}).items():
        ctes.append(f"{k} AS ({v})")
    if not ctes:
        return sql
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":  # merge the body's own CTEs into ours
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + sql

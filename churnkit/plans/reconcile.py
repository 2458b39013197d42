"""Score reconciliation: the two prediction tables made into one frame.

Steps (one lazy plan): flag stated intents, collapse duplicate intent rows
by averaging (means rounded to 12 decimals, so the result does not depend on
partition order), add days to intent, full outer merge with the rule model on
(subscriber, date), keep rows scored by both, round the averaged label
half-to-even.  The same steps exist as SQL for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.functions.scalar import days_between, round_half_even
from churnkit.operators.dedup import collapse_duplicates
from churnkit.operators.joins import any_null, merge_predictions
from churnkit.sources import fixtures, load

INTENT_KEYS = ["idsubscrip", "idsystem", "pubcode", "observation_date", "THRESHOLD", "POSITIVE_CLASS",
               "DEPLOYMENT_APPROVAL_STATUS", "prediction_status", "churned", "stop_intent_date",
               "has_stop_intent"]
INTENT_VALS = ["churned_1_PREDICTION", "churned_0_PREDICTION", "churned_PREDICTION"]
# Unique key of a scored row: duplicates that disagree on segment or label
# are kept apart by the collapse, so subscriber and date alone are not unique.
ROW_KEY = ["idsubscrip", "observation_date", "pubcode", "churned"]
ROW_KEY_SQL = ", ".join(ROW_KEY)


def collapsed_intent(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.intent_preds(spark, sf_dir).withColumn("has_stop_intent", F.col("stop_intent_date").isNotNull())
    out = collapse_duplicates(raw, INTENT_KEYS, INTENT_VALS, digits=12)
    return out.withColumn("days_to_intent", days_between("stop_intent_date", "observation_date"))


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    # both keys come from orders (customer, order date): a cheap footer-level
    # check decides whether the null-safe join is needed at all
    src = load(spark, sf_dir, "orders", ["o_custkey", "o_orderdate"])
    nulls = any_null(src, ["o_custkey", "o_orderdate"])
    return merge_predictions(collapsed_intent(spark, sf_dir), fixtures.rule_preds(spark, sf_dir),
                             ["idsubscrip", "observation_date"], ["idsubscrip", "inference_date"], null_keys=nulls)


def both_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = merged(spark, sf_dir)
    return (m.where(F.col("churned").isNotNull() & F.col("true_churned").isNotNull())
            .withColumn("churned_PREDICTION", round_half_even("churned_PREDICTION"))
            .withColumn("has_intent", F.col("stop_intent_date").isNotNull()))


# ------------------------------------------------------------------ oracle SQL
SQL_COLLAPSED = (
    "SELECT " + ", ".join(INTENT_KEYS) + ", " + ", ".join(f"ROUND(AVG({v}), 12) AS {v}" for v in INTENT_VALS)
    + ", CAST(date_diff('day', observation_date, stop_intent_date) AS INTEGER) AS days_to_intent"
    " FROM (SELECT *, stop_intent_date IS NOT NULL AS has_stop_intent FROM intent_preds) t"
    " GROUP BY " + ", ".join(INTENT_KEYS)
)
SQL_MERGED = (
    "SELECT COALESCE(i.idsubscrip, r.idsubscrip) AS idsubscrip, i.* EXCLUDE (idsubscrip), "
    "r.* EXCLUDE (idsubscrip) FROM collapsed i FULL OUTER JOIN rule_preds r "
    "ON i.idsubscrip IS NOT DISTINCT FROM r.idsubscrip AND i.observation_date IS NOT DISTINCT FROM r.inference_date"
)
SQL_BOTH = (
    "SELECT * REPLACE (round_even(churned_PREDICTION, 0) AS churned_PREDICTION), "
    "stop_intent_date IS NOT NULL AS has_intent FROM merged WHERE churned IS NOT NULL AND true_churned IS NOT NULL"
)


def sql(body: str, level: str = "scored", extra: dict[str, str] | None = None) -> str:
    """``body`` with the reconciliation CTEs up to ``level``
    (``collapsed``, ``merged`` or ``scored``) in front of it."""
    steps = {"collapsed": SQL_COLLAPSED, "merged": SQL_MERGED, "scored": SQL_BOTH}
    order = ["collapsed", "merged", "scored"]
    ctes = {k: steps[k] for k in order[: order.index(level) + 1]}
    ctes.update(extra or {})
    return fixtures.with_views(body, "intent_preds", "rule_preds", extra=ctes)

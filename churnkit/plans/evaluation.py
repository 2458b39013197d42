"""The evaluation flow: one reconciled table, many reports.

The merged prediction table is written once (shared folder) and every report
is one aggregation over it, so the two Parquet scans, the collapse and the
merge run once for all of them.  ``summary`` stacks the headline numbers in
one long table ``(report, model, metric, value)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.operators import evaluate as ev, metrics as mt
from churnkit.operators.util import materialize, run_all
from churnkit.plans import reconcile as rc


def reports(spark: SparkSession, sf_dir: str, cost: float = 10, revenue: float = 100) -> dict[str, DataFrame]:
    s = materialize(rc.both_scored(spark, sf_dir))
    builders = {
        "business_impact": lambda: ev.business_impact(s, cost, revenue),
        "fp_rates": lambda: ev.fp_rates(s),
        "curve": lambda: mt.curve_metrics(s, "churned", "churned_1_PREDICTION"),
        "report_intent": lambda: ev.classification_report(s, "churned", "churned_PREDICTION"),
        "report_churn": lambda: ev.classification_report(s, "true_churned", "churn_label"),
    }
    # reports whose operators run passes while being built (running sums)
    # are independent: build them from driver threads
    built = run_all(lambda kv: (kv[0], kv[1]()), list(builders.items()))
    return dict(built)


def _long(df: DataFrame, report: str, model, metrics: list[str]) -> DataFrame:
    m = model if not isinstance(model, str) else F.lit(model)
    return df.select(F.lit(report).alias("report"), m.alias("model"),
                     F.explode(F.array(*[F.struct(F.lit(x).alias("metric"), F.col(x).cast("double").alias("value"))
                                         for x in metrics])).alias("r")).select("report", "model", "r.*")


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reports(spark, sf_dir)
    parts = [
        _long(r["business_impact"], "business_impact", F.col("model"),
              ["interventions", "true_positives", "false_positives", "total_cost", "total_benefit", "roi",
               "cost_per_true_positive"]),
        _long(r["fp_rates"].select(F.col("intent_fp_rate").alias("fp_rate")), "false_positives", "intent", ["fp_rate"]),
        _long(r["fp_rates"].select(F.col("rule_fp_rate").alias("fp_rate")), "false_positives", "churn", ["fp_rate"]),
        _long(r["curve"], "ranking", "intent", ["auc", "ks", "average_precision", "max_mcc"]),
        _long(r["report_intent"].where("label = '1.0'"), "classification", "intent", ["precision", "recall", "f1_score"]),
        _long(r["report_churn"].where("label = '1.0'"), "classification", "churn", ["precision", "recall", "f1_score"]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

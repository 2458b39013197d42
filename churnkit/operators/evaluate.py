"""Model comparison and business impact of two churn predictors.

Every report is one aggregation over the merged prediction table; only
report rows reach the driver.  Labels are compared with ``>= 1`` / ``== 0``
so a multi-valued churn label (0/1/2) counts 1 and 2 as churn.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.functions.scalar import col_
from churnkit.operators.metrics import roc_auc
from churnkit.operators.prefix import percent_rows, top_n_flags
from churnkit.operators.util import materialize


@dataclass(frozen=True)
class EvalCols:
    """Column roles of the two predictors (intent model and rule model)."""
    intent_target: str = "churned"
    churn_target: str = "true_churned"
    intent_score: str = "churned_1_PREDICTION"
    churn_score: str = "churn_label"
    intent_pred: str = "churned_PREDICTION"
    churn_pred: str = "churn_label"
    intent_date: str = "stop_intent_date"
    date: str = "observation_date"
    priority_score_churn: str = "bin_sum"
    segments: tuple[str, ...] = ("pubcode",)
    tiebreak: tuple[str, ...] = ("idsubscrip", "observation_date", "pubcode", "churned")

    def model(self, name: str) -> tuple[str, str]:
        """(prediction label, target) of model ``intent`` or ``churn``."""
        return (self.intent_pred, self.intent_target) if name == "intent" else (self.churn_pred, self.churn_target)


DEFAULT = EvalCols()


def _cnt(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


# ------------------------------------------------------------ confusion/report
def confusion_matrix(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Counts by (true, predicted), dense over the union of labels."""
    t = col_(y).cast("double").alias("y_true")
    p = col_(yhat).cast("double").alias("y_pred")
    cm = df.select(t, p).groupBy("y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))
    # the label set is tiny (classes), so the dense grid is built from one
    # array of labels rather than by joining the label table to itself
    labels = (cm.select(F.col("y_true").alias("l")).union(cm.select("y_pred")).distinct()
              .agg(F.array_sort(F.collect_list("l")).alias("ls")))
    grid = (labels.select(F.explode("ls").alias("y_true"), "ls")
            .select("y_true", F.explode("ls").alias("y_pred")))
    return grid.join(cm, ["y_true", "y_pred"], "left").select(
        "y_true", "y_pred", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def classification_report(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Per label precision/recall/F1/support, then ``accuracy`` (in the F1
    column), ``macro avg`` and ``weighted avg``; 0 on zero division."""
    base = df.where(col_(y).isNotNull() & col_(yhat).isNotNull()).select(
        col_(y).cast("double").alias("t"), col_(yhat).cast("double").alias("p"))
    cm = base.groupBy("t", "p").agg(F.count(F.lit(1)).alias("n"))
    sup = cm.groupBy(F.col("t").alias("l")).agg(F.sum("n").alias("support"))
    pred = cm.groupBy(F.col("p").alias("l")).agg(F.sum("n").alias("predicted"))
    tp = cm.where(F.col("t") == F.col("p")).select(F.col("t").alias("l"), F.col("n").alias("tp"))
    per = (sup.join(pred, "l", "full_outer").join(tp, "l", "left")
           .select("l", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("support", "predicted", "tp")]))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    per = per.select("l", "support", "tp", prec.alias("precision"), rec.alias("recall"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    per = per.withColumn("f1_score", f1)
    rows = per.select(F.col("l").cast("string").alias("label"), "precision", "recall", "f1_score",
                      F.col("support").cast("bigint").alias("support"))
    tot = per.agg(
        F.sum("support").alias("n"), F.sum("tp").alias("tp"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1_score") * F.col("support")).alias("wf"))
    n = F.col("n")
    summary = tot.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), (F.col("tp") / n).alias("f1_score"),
                 n.cast("bigint").alias("support")),
        F.struct(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1_score"), n.cast("bigint").alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), (F.col("wp") / n).alias("precision"),
                 (F.col("wr") / n).alias("recall"), (F.col("wf") / n).alias("f1_score"),
                 n.cast("bigint").alias("support")),
    )).alias("r")).select("r.*")
    return rows.unionByName(summary)


def binary_precision(y: str, yhat: str) -> Column:
    """Precision of class 1 with the true label binarised (>= 1); 0 when
    nothing is flagged (the usual zero-division rule)."""
    flagged = col_(yhat) >= 1
    return F.coalesce(F.try_divide(_cnt(flagged & (col_(y) >= 1)).cast("double"), _cnt(flagged).cast("double")),
                      F.lit(0.0))


# --------------------------------------------------------------- whole-table
def business_impact(df: DataFrame, cost_per_intervention: float = 100, revenue_per_save: float = 1000,
                    cols: EvalCols = DEFAULT) -> DataFrame:
    """interventions = sum(pred), TP, FP, total cost and benefit, ROI (0 when
    no cost), cost per TP (infinity when no TP); one row per model, one pass."""
    aggs = []
    for m in ("intent", "churn"):
        pred, tgt = cols.model(m)
        aggs += [F.coalesce(F.sum(col_(pred).cast("double")), F.lit(0.0)).alias(f"{m}_iv"),
                 _cnt((col_(pred) >= 1) & (col_(tgt) >= 1)).alias(f"{m}_tp"),
                 _cnt((col_(pred) >= 1) & (col_(tgt) == 0)).alias(f"{m}_fp")]
    one = df.agg(*aggs)
    rows = one.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(f"{m}_iv").alias("interventions"),
                 F.col(f"{m}_tp").alias("true_positives"), F.col(f"{m}_fp").alias("false_positives"))
        for m in ("intent", "churn")])).alias("r")).select("r.*")
    cost = F.col("interventions") * F.lit(float(cost_per_intervention))
    benefit = F.col("true_positives") * F.lit(float(revenue_per_save))
    return rows.select(
        "model", "interventions", "true_positives", "false_positives",
        cost.alias("total_cost"), benefit.alias("total_benefit"),
        F.when(cost > 0, (benefit - cost) / cost).otherwise(0.0).alias("roi"),
        F.when(F.col("true_positives") > 0, cost / F.col("true_positives"))
        .otherwise(F.lit(float("inf"))).alias("cost_per_true_positive"))


def segment_metrics(df: DataFrame, cols: EvalCols = DEFAULT, segment: str | None = None) -> DataFrame:
    """Per segment value: size, intent AUC, intent precision, rule precision.
    Null segments are skipped; AUC is partitioned by segment, not looped."""
    seg = segment or cols.segments[0]
    base = df.where(col_(seg).isNotNull())
    counts = base.groupBy(seg).agg(
        F.count(F.lit(1)).alias("size"),
        binary_precision(cols.intent_target, cols.intent_pred).alias("intent_precision"),
        binary_precision(cols.churn_target, cols.churn_pred).alias("rule_precision"))
    auc = roc_auc(base, cols.intent_target, cols.intent_score, by=[seg]).withColumnRenamed("auc", "intent_auc")
    return counts.join(auc, seg, "left").select(seg, "size", "intent_auc", "intent_precision", "rule_precision")


def every_segment(df: DataFrame, segments: Sequence[str], report) -> DataFrame:
    """``report(df, segment)`` for each segment column, stacked: the column's
    name, its value as text, and the report's other columns."""
    out = None
    for s in segments:
        part = report(df, s)
        part = part.select(F.lit(s).alias("segment"), col_(s).cast("string").alias("value"),
                           *[col_(c) for c in part.columns if c != s])
        out = part if out is None else out.unionByName(part)
    return out


def fp_rates(df: DataFrame, cols: EvalCols = DEFAULT) -> DataFrame:
    """False positives over all rows (not over negatives), both models."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for m in ("intent", "churn"):
        pred, tgt = cols.model(m)
        aggs.append(_cnt((col_(pred) >= 1) & (col_(tgt) == 0)).alias(f"_{m}"))
    return df.agg(*aggs).select((F.col("_intent") / F.col("_n")).alias("intent_fp_rate"),
                                (F.col("_churn") / F.col("_n")).alias("rule_fp_rate"))


def fp_shares(df: DataFrame, cols: EvalCols = DEFAULT, segment: str | None = None) -> DataFrame:
    """Share of each segment value among each model's false positives."""
    seg = segment or cols.segments[0]
    parts = []
    for m in ("intent", "churn"):
        pred, tgt = cols.model(m)
        fp = df.where((col_(pred) >= 1) & (col_(tgt) == 0) & col_(seg).isNotNull())
        parts.append(fp.groupBy(seg).agg(F.count(F.lit(1)).alias("count")).withColumn("model", F.lit(m)))
    u = parts[0].unionByName(parts[1])
    tot = u.groupBy("model").agg(F.sum("count").alias("_t"))
    return u.join(F.broadcast(tot), "model").select("model", seg, "count", (F.col("count") / F.col("_t")).alias("share"))


def intent_rates(df: DataFrame, cols: EvalCols = DEFAULT, has_intent: str = "has_intent") -> DataFrame:
    """Mean churn label with and without a stated intent."""
    flag = col_(has_intent) if has_intent in df.columns else col_(cols.intent_date).isNotNull()
    return df.agg(F.avg(F.when(flag, col_(cols.churn_target))).alias("intent_churn_rate"),
                  F.avg(F.when(~flag, col_(cols.churn_target))).alias("no_intent_churn_rate"))


def intent_performance(df: DataFrame, cols: EvalCols = DEFAULT) -> DataFrame:
    """Intent AUC and rule precision on rows with a stated intent."""
    sub = df.where(col_(cols.intent_date).isNotNull())
    prec = sub.agg(binary_precision(cols.churn_target, cols.churn_score).alias("rule_model_precision"),
                   F.lit(0).alias("_g"))
    auc = roc_auc(sub, cols.intent_target, cols.intent_score).withColumn("_g", F.lit(0))
    return auc.join(prec, "_g").select(F.col("auc").alias("intent_model_auc"), "rule_model_precision")


def intent_segments(df: DataFrame, cols: EvalCols = DEFAULT, segment: str | None = None) -> DataFrame:
    seg = segment or cols.segments[0]
    sub = df.where(col_(cols.intent_date).isNotNull() & col_(seg).isNotNull())
    c = sub.groupBy(seg).agg(F.count(F.lit(1)).alias("count"))
    tot = sub.agg(F.count(F.lit(1)).alias("_t"), F.lit(0).alias("_g"))
    return (c.withColumn("_g", F.lit(0)).join(F.broadcast(tot), "_g")
            .select(seg, "count", (F.col("count") / F.col("_t")).alias("share")))


def days_to_churn(df: DataFrame, start: str, end: str, churned: str) -> DataFrame:
    """Median/mean/std of days from ``start`` to ``end`` where both exist, and
    the share of churned rows that have an ``end`` date."""
    d = F.datediff(col_(end), col_(start))
    both = col_(end).isNotNull() & col_(start).isNotNull()
    return df.agg(
        F.median(F.when(both, d)).alias("median_days"), F.avg(F.when(both, d)).alias("mean_days"),
        F.stddev_samp(F.when(both, d)).alias("std_days"),
        F.avg(F.when(col_(churned) >= 1, col_(end).isNotNull().cast("double"))).alias("conversion_rate"))


# ---------------------------------------------------------- retention money
@dataclass(frozen=True)
class Program:
    name: str
    cost: float
    success_rate: float
    additional_value: float


def programs(intervention_cost: float = 150, success_rate: float = 0.5,
             customer_value: float = 1000) -> list[Program]:
    """Fixed rule: base; optimistic (success x1.25, extra 10 % of value);
    pessimistic (success x0.75)."""
    return [Program("base", intervention_cost, success_rate, 0.0),
            Program("optimistic", intervention_cost, success_rate * 1.25, customer_value * 0.1),
            Program("pessimistic", intervention_cost, success_rate * 0.75, 0.0)]


def programs_table(spark, intervention_cost=150, success_rate=0.5, customer_value=1000) -> DataFrame:
    rows = [(p.name, float(p.cost), float(p.success_rate), float(p.additional_value))
            for p in programs(intervention_cost, success_rate, customer_value)]
    return spark.createDataFrame(rows, "program string, cost double, success_rate double, additional_value double")


def prioritize(df: DataFrame, pct: float = 10, cols: EvalCols = DEFAULT) -> DataFrame:
    """``churn_priority`` / ``intent_priority``: top ``int(N * pct / 100)``
    rows by rule score and by intent probability (ties by the tiebreak
    columns, never nulls)."""
    rows = materialize(df)
    return top_n_flags(rows, _rankings(cols), percent_rows(rows, pct), cols.tiebreak, materialized=True)


def _rankings(cols: EvalCols) -> dict[str, str]:
    return {"churn_priority": cols.priority_score_churn, "intent_priority": cols.intent_score}


def _priority_counts(df: DataFrame, pct: float, cols: EvalCols) -> DataFrame:
    """Per model: TP/FP/TN/FN inside that model's priority rows and the
    priority row count (one row per model)."""
    allcols = list(dict.fromkeys([cols.priority_score_churn, cols.intent_score, *cols.model("churn"),
                                  *cols.model("intent"), *cols.tiebreak]))
    flagged = prioritize(df.select(*allcols), pct, cols)

    def counts(m):
        pred, tgt = cols.model(m)
        pr = F.col(f"{m}_priority")
        return F.struct(
            F.lit(m).alias("model"),
            _cnt(pr & (col_(pred) >= 1) & (col_(tgt) >= 1)).alias("tp"),
            _cnt(pr & (col_(pred) >= 1) & (col_(tgt) == 0)).alias("fp"),
            _cnt(pr & (col_(pred) == 0) & (col_(tgt) == 0)).alias("tn"),
            _cnt(pr & (col_(pred) == 0) & (col_(tgt) >= 1)).alias("fn"),
            _cnt(pr).alias("n"), _cnt(pr & (col_(tgt) >= 1)).alias("tp_any"), _cnt(pr & (col_(tgt) == 0)).alias("fp_any"))

    # one aggregate over the flagged rows for both models
    return flagged.agg(F.array(counts("churn"), counts("intent")).alias("m")).select(F.inline("m"))


def cost_benefit(df: DataFrame, pct: float = 10, intervention_cost: float = 150,
                 success_rate: float = 0.5, customer_value: float = 1000,
                 program_names: Sequence[str] = ("base", "optimistic", "pessimistic"),
                 cols: EvalCols = DEFAULT) -> DataFrame:
    """Money on each model's top-``pct`` rows, for each retention program.
    Programs are parameters, so they become literal columns (no join)."""
    counts = _priority_counts(df, pct, cols)
    progs = [p for p in programs(intervention_cost, success_rate, customer_value) if p.name in program_names]
    tp, fp, tn, fn, n = (F.col(c) for c in ("tp", "fp", "tn", "fn", "n"))
    parts = []
    for p in progs:
        saved = tp * F.lit(p.success_rate) * F.lit(float(customer_value))
        add = tp * F.lit(p.success_rate) * F.lit(p.additional_value)
        ic = tp * F.lit(float(p.cost))
        wasted = fp * F.lit(float(p.cost))
        missed = fn * F.lit(float(customer_value))
        parts.append(counts.select(
            F.lit(p.name).alias("program"), "model", tp.alias("TP"), fp.alias("FP"), tn.alias("TN"), fn.alias("FN"),
            F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0).alias("precision"),
            F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0).alias("recall"),
            F.try_divide((tp + fp).cast("double"), n.cast("double")).alias("intervention_rate"),
            saved.alias("saved_revenue"), add.alias("additional_revenue"), ic.alias("intervention_costs"),
            wasted.alias("wasted_costs"), missed.alias("missed_revenue"),
            (saved + add - ic - wasted - missed).alias("net_impact"),
            F.when(ic > 0, (saved + add - ic - wasted) / (ic + wasted)).otherwise(0.0).alias("roi")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def intervention_strategy(df: DataFrame, pct: float = 10, intervention_cost: float = 150,
                          success_rate: float = 0.5, customer_value: float = 1000,
                          cols: EvalCols = DEFAULT) -> DataFrame:
    """Treat every top-``pct`` row: counts, precision, cost, savings, net, ROI."""
    c = _priority_counts(df, pct, cols)
    n, tp, fp = F.col("n"), F.col("tp_any"), F.col("fp_any")
    cost = n * F.lit(float(intervention_cost))
    sav = tp * F.lit(float(success_rate)) * F.lit(float(customer_value))
    return c.select("model", n.alias("n_interventions"), tp.alias("true_positives"), fp.alias("false_positives"),
                    F.when(n > 0, tp / n).otherwise(0.0).alias("precision"), cost.alias("total_cost"),
                    sav.alias("potential_savings"), (sav - cost).alias("net_impact"),
                    F.when(cost > 0, (sav - cost) / cost).otherwise(0.0).alias("roi"))


def model_comparison(report_intent: DataFrame, report_churn: DataFrame, impact: DataFrame) -> DataFrame:
    """Metric x model table: class-1 precision/recall/F1 and ROI, cost per TP."""
    def cls1(rep, m):
        r = rep.where(F.col("label") == "1.0")
        return r.select(F.lit(m).alias("model"), F.explode(F.array(
            F.struct(F.lit("Precision").alias("metric"), F.col("precision").alias("value")),
            F.struct(F.lit("Recall").alias("metric"), F.col("recall").alias("value")),
            F.struct(F.lit("F1-Score").alias("metric"), F.col("f1_score").alias("value")))).alias("r")) \
            .select("model", "r.*")
    money = impact.select("model", F.explode(F.array(
        F.struct(F.lit("ROI").alias("metric"), F.col("roi").alias("value")),
        F.struct(F.lit("Cost per True Positive").alias("metric"), F.col("cost_per_true_positive").alias("value"))))
        .alias("r")).select("model", "r.*")
    long = cls1(report_intent, "intent").unionByName(cls1(report_churn, "churn")).unionByName(money)
    return (long.groupBy("metric").pivot("model", ["intent", "churn"]).agg(F.first("value"))
            .withColumnRenamed("intent", "intent_model").withColumnRenamed("churn", "churn_rules_model"))

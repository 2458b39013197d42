"""Exact ranking and classification metrics.

All threshold metrics come from one pass: rows are pre-aggregated by distinct
score (map-side partial aggregation), running sums in descending score order
come from ``prefix_sum`` (no single-partition window), and one aggregation
turns them into AUC, KS, average precision, max MCC and curve points.  Ties
are handled exactly (half credit in AUC).  Labels >= 1 are positive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnkit.functions.scalar import col_
from churnkit.operators.prefix import prefix_sum, top_n_per_group


def _weight(w: str | None) -> Column:
    return F.lit(1.0) if w is None else col_(w).cast("double")


def present(c: str) -> Column:
    """Neither null nor NaN."""
    return col_(c).isNotNull() & ~F.isnan(col_(c).cast("double"))


def score_table(df: DataFrame, y: str, p: str, by: Sequence[str] = (), w: str | None = None) -> DataFrame:
    """``(by..., score, pos, neg)`` per distinct score with running sums
    ``cum_pos``/``cum_neg`` (inclusive, descending score) and group totals
    ``tot_pos``/``tot_neg``."""
    by = list(by)
    is_pos = col_(y) >= 1
    scored = df.where(present(y)).withColumn("_score", col_(p).cast("double"))
    agg = scored.groupBy(*[col_(b) for b in by], "_score").agg(
        F.sum(F.when(is_pos, _weight(w)).otherwise(F.lit(0.0))).alias("pos"),
        F.sum(F.when(is_pos, F.lit(0.0)).otherwise(_weight(w))).alias("neg"), F.bool_or(present("_score")).alias("_there"))
    # missing scores go after the grouping: a filter of the rows would compute a model's score once more for itself
    return prefix_sum(agg.where("_there").drop("_there").withColumnRenamed("_score", "score"), "score", ["pos", "neg"], by=by, descending=True, totals=True)


def _curve_aggs() -> list[Column]:
    P, N = F.col("tot_pos"), F.col("tot_neg")
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    fn, tn = P - tp, N - fp
    mcc_den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    mcc = F.when(mcc_den > 0, (tp * tn - fp * fn) / mcc_den).otherwise(F.lit(0.0))
    return [
        F.max(P).alias("n_pos"), F.max(N).alias("n_neg"),
        F.when((F.max(P) > 0) & (F.max(N) > 0),
               F.try_divide(F.sum(F.col("neg") * (tp - F.lit(0.5) * F.col("pos"))), F.max(P) * F.max(N))).alias("auc"),
        F.when((F.max(P) > 0) & (F.max(N) > 0), F.max(F.try_divide(tp, P) - F.try_divide(fp, N))).alias("ks"),
        F.when(F.max(P) > 0, F.sum(F.try_divide(F.col("pos"), P) * F.try_divide(tp, tp + fp))).alias("average_precision"),
        F.max(mcc).alias("max_mcc"),
    ]


def curve_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = (), w: str | None = None) -> DataFrame:
    """``(by..., n_pos, n_neg, auc, ks, average_precision, max_mcc)``."""
    st = score_table(df, y, p, by, w)
    return st.groupBy(*by).agg(*_curve_aggs())


def roc_auc(df: DataFrame, y: str, p: str, by: Sequence[str] = (), w: str | None = None) -> DataFrame:
    """Area under ROC, ties at half; null when a group has one class only."""
    return curve_metrics(df, y, p, by, w).select(*by, "auc")


def roc_points(df: DataFrame, y: str, p: str, by: Sequence[str] = (), w: str | None = None) -> DataFrame:
    """One (FPR, TPR) point per distinct score, descending."""
    st = score_table(df, y, p, by, w)
    return st.select(*by, F.col("score").alias("threshold"),
                     F.try_divide(F.col("cum_neg"), F.col("tot_neg")).alias("fpr"),
                     F.try_divide(F.col("cum_pos"), F.col("tot_pos")).alias("tpr"))


def pr_points(df: DataFrame, y: str, p: str, by: Sequence[str] = (), w: str | None = None) -> DataFrame:
    """One (precision, recall) point per distinct score."""
    st = score_table(df, y, p, by, w)
    return st.select(*by, F.col("score").alias("threshold"),
                     F.try_divide(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
                     F.try_divide(F.col("cum_pos"), F.col("tot_pos")).alias("recall"))


def rate_at_top(df: DataFrame, y: str, p: str, pct: float, tiebreak: Sequence[str],
                by: Sequence[str] = ()) -> DataFrame:
    """Positive rate among the first ``int(rows * pct / 100)`` rows by score."""
    flagged = top_n_per_group(df, p, pct, tiebreak, by=by, out="_top")
    return (flagged.where("_top").groupBy(*by)
            .agg(F.avg(F.when(col_(y) >= 1, 1.0).otherwise(0.0)).alias("rate_at_top")))


def weighted_binary_metrics(df: DataFrame, y: str, p: str, w: str | None = None,
                            by: Sequence[str] = (), eps: float = 1e-15) -> DataFrame:
    """Leaderboard metrics of a probability column, optionally weighted:
    AUC, Gini Norm, KS, average precision (area under PR), max MCC, LogLoss,
    RMSE and FVE Binomial (1 - LogLoss / LogLoss of the weighted mean)."""
    by = list(by)
    # a score's rows count by their weights, so the distinct scores hold all that the sums need: the rows are read once
    pp = F.least(F.greatest(F.col("score"), F.lit(eps)), F.lit(1 - eps))
    pos, neg = (F.coalesce(c, F.lit(0.0)) for c in ("pos", "neg"))
    off = 1 - F.col("score")
    sums = score_table(df, y, p, by, w).groupBy(*by).agg(
        *_curve_aggs(), F.sum(pos + neg).alias("_sw"), F.sum(pos).alias("_swy"),
        F.sum(-(pos * F.log(pp) + neg * F.log(1 - pp))).alias("_sll"),
        F.sum(pos * off * off + neg * F.col("score") * F.col("score")).alias("_sse"))
    per = lambda c: F.try_divide(F.col(c), F.col("_sw"))  # noqa: E731  null where the weights sum to 0
    ybar = per("_swy")
    ybar_c = F.least(F.greatest(ybar, F.lit(eps)), F.lit(1 - eps))
    null_ll = -(ybar * F.log(ybar_c) + (1 - ybar) * F.log(1 - ybar_c))
    return sums.select(*by, "n_pos", "n_neg", "auc", "ks", "average_precision", "max_mcc", (2 * F.col("auc") - 1).alias("gini_norm"),
                       per("_sll").alias("logloss"), F.sqrt(per("_sse")).alias("rmse"),
                       (1 - F.try_divide(per("_sll"), null_ll)).alias("fve_binomial"))


def regression_metrics(df: DataFrame, y: str, yhat: str, w: str | None = None,
                       by: Sequence[str] = (), tweedie_power: float = 1.5) -> DataFrame:
    """RMSE, MAE, R squared and FVE Poisson/Gamma/Tweedie (1 - deviance /
    deviance of the weighted mean), weighted when ``w`` is given.

    One aggregation pass: the deviance of the mean is expanded into sums
    (of w, w*y, w*y^2, w*y*log y, w*log y, w*y^(2-p)) so it needs no second
    pass over the rows after the mean is known."""
    by = list(by)
    yv, mu, ww = col_(y).cast("double"), col_(yhat).cast("double"), _weight(w)
    pw = float(tweedie_power)
    base = df.where(present(y) & present(yhat))
    pos = (yv > 0) & (mu > 0)
    s = F.sum
    agg = base.groupBy(*by).agg(
        s(ww).alias("sw"), s(ww * yv).alias("swy"), s(ww * yv * yv).alias("swyy"),
        s(ww * (yv - mu) * (yv - mu)).alias("sse"), s(ww * F.abs(yv - mu)).alias("sae"),
        s(F.when(mu > 0, ww * 2 * (F.when(yv > 0, yv * F.log(yv / mu)).otherwise(0.0) - (yv - mu))))
        .alias("dev_pois"),
        s(F.when(yv > 0, ww * yv * F.log(yv)).otherwise(0.0)).alias("swylogy"),
        s(F.when(pos, ww * 2 * (F.log(mu / yv) + yv / mu - 1))).alias("dev_gamma"),
        s(F.when(pos, ww)).alias("sw_pos"), s(F.when(pos, ww * yv)).alias("swy_pos"),
        s(F.when(pos, ww * F.log(yv))).alias("swlogy_pos"),
        s(F.when(mu > 0, ww * 2 * (F.pow(F.greatest(yv, F.lit(0.0)), 2 - pw) / ((1 - pw) * (2 - pw))
                                   - yv * F.pow(mu, 1 - pw) / (1 - pw) + F.pow(mu, 2 - pw) / (2 - pw))))
        .alias("dev_tw"),
        s(ww * F.pow(F.greatest(yv, F.lit(0.0)), 2 - pw)).alias("swy2p"), F.min(yv).alias("least"),
    )
    c = F.col
    ybar = F.try_divide(c("swy"), c("sw"))
    sst = c("swyy") - c("swy") * ybar
    null_pois = 2 * (c("swylogy") - F.log(ybar) * c("swy") - c("swy") + ybar * c("sw"))
    ybar_pos = F.try_divide(c("swy_pos"), c("sw_pos"))
    null_gamma = 2 * (F.log(ybar_pos) * c("sw_pos") - c("swlogy_pos") + F.try_divide(c("swy_pos"), ybar_pos) - c("sw_pos"))
    null_tw = 2 * (c("swy2p") / ((1 - pw) * (2 - pw)) - c("swy") * F.pow(ybar, 1 - pw) / (1 - pw)
                   + c("sw") * F.pow(ybar, 2 - pw) / (2 - pw))
    def explained(deviance: Column, of_mean: Column) -> Column:
        # a constant target has no deviance but rounding: nothing to explain
        return F.when(sst > F.lit(1e-12) * c("swyy"), 1 - F.try_divide(deviance, of_mean))

    # deviances of counts and amounts are not defined for negative targets
    amounts = lambda d, m: F.when(c("least") >= 0, explained(d, m))
    return agg.select(
        *by, F.sqrt(F.try_divide(c("sse"), c("sw"))).alias("rmse"), F.try_divide(c("sae"), c("sw")).alias("mae"),
        explained(c("sse"), sst).alias("r_squared"), amounts(c("dev_pois"), null_pois).alias("fve_poisson"),
        amounts(c("dev_gamma"), null_gamma).alias("fve_gamma"), amounts(c("dev_tw"), null_tw).alias("fve_tweedie"))


def balanced_accuracy(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean recall over the classes that occur (one class alone: its recall); null without rows."""
    t = col_(y) >= 1
    h = col_(yhat) >= 1
    hit, miss = F.sum(F.when(t & h, 1.0).otherwise(0.0)), F.sum(F.when(~t & ~h, 1.0).otherwise(0.0))
    pos = F.try_divide(hit, F.sum(F.when(t, 1.0).otherwise(0.0)))
    neg = F.try_divide(miss, F.sum(F.when(~t, 1.0).otherwise(0.0)))
    return df.groupBy(*by).agg(F.coalesce((pos + neg) / 2, pos, neg).alias("balanced_accuracy"))


def mase(df: DataFrame, y: str, yhat: str, time: str, series: Sequence[str] = (), lag: int = 1) -> DataFrame:
    """Mean absolute scaled error per series: the forecast's mean absolute
    error over that of the naive forecast ``lag`` steps before; null when the
    naive error is zero or a series is too short.  ``(series..., mase)``."""
    series = list(series)
    ok = df.where(present(y) & present(yhat))
    w = Window.partitionBy(*series).orderBy(time)
    step = F.abs(col_(y) - F.lag(col_(y), lag).over(w))
    each = ok.select(*series, F.abs(col_(y) - col_(yhat)).cast("double").alias("_e"), step.cast("double").alias("_n"))
    return each.groupBy(*series).agg(F.try_divide(F.avg("_e"), F.avg("_n")).alias("mase"))

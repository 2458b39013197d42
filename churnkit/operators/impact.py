"""Feature impact tables and feature selection by rank ensembling.

Impact tables hold one row per (model, feature): models x features, bounded
by the leaderboard size times the schema width, so ordered windows over one
model or over the feature list are small.  Ties in sort keys are broken by
feature name so results do not depend on input order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FEATURE, MODEL = "featureName", "model_id"
NORM, UNNORM = "impactNormalized", "impactUnnormalized"


def normalise_impacts(df: DataFrame, model: str = MODEL) -> DataFrame:
    """``impactNormalized`` = unnormalised impact / the model's largest."""
    mx = df.groupBy(model).agg(F.max(UNNORM).alias("_mx"))
    return df.join(mx, model).withColumn(NORM, F.try_divide(F.col(UNNORM), F.col("_mx"))).drop("_mx")


def rename_impacts(df: DataFrame) -> DataFrame:
    """Service column names to snake case."""
    return df.withColumnsRenamed({NORM: "impact_normalized", FEATURE: "feature_name",
                                  "redundantWith": "redundant_with"})


def zero_redundant(df: DataFrame, col: str = NORM, flag: str = "redundantWith") -> DataFrame:
    """Impact set to 0 where the feature is marked redundant."""
    return df.withColumn(col, F.when(F.col(flag).isNotNull(), F.lit(0.0)).otherwise(F.col(col)))


def rank_impacts(df: DataFrame, model: str = MODEL) -> DataFrame:
    """0-based rank by unnormalised impact, descending, within each model."""
    w = Window.partitionBy(model).orderBy(F.col(UNNORM).desc(), F.col(FEATURE))
    return df.withColumn("rank", (F.row_number().over(w) - 1).cast("bigint"))


def impact_sum(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, FEATURE).agg(F.sum(NORM).alias(NORM), F.sum(UNNORM).alias(UNNORM))


def impact_mean(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean normalised impact per feature after zeroing redundant ones."""
    return zero_redundant(df).groupBy(*by, FEATURE).agg(F.avg(NORM).alias(NORM))


def cumulative(df: DataFrame, order: str, val: str, by: Sequence[str] = (), out: str = "impactCumulative") -> DataFrame:
    """Running sum of ``val`` in descending ``order`` (ties by feature).
    One row per feature, so the window holds at most the schema width."""
    w = Window.partitionBy(*by).orderBy(F.col(order).desc(), F.col(FEATURE)) \
        .rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(val).over(w))


def median_rank(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Median rank per feature over models (a feature has one rank per model)."""
    return df.groupBy(*by, FEATURE).agg(F.median("rank").alias("rank"))


def fire_select(impacts: DataFrame, ratio: float = 0.95, use_ranks: bool = True,
                by: Sequence[str] = ()) -> DataFrame:
    """Rank-ensembled selection: n = features whose cumulative summed impact
    is ``<= ratio * max(cumulative)`` (the crossing feature excluded, at least
    one); then the n best by median rank (or by total impact).
    Returns ``(by..., position, featureName)``."""
    by = list(by)
    ranked = rank_impacts(impacts, model=MODEL) if "rank" not in impacts.columns else impacts
    agg = cumulative(impact_sum(ranked, by), UNNORM, UNNORM, by)
    limit = agg.groupBy(*by).agg((F.max("impactCumulative") * F.lit(float(ratio))).alias("_lim"))
    n = (agg.join(limit, by) if by else agg.withColumn("_g", F.lit(0))
         .join(limit.withColumn("_g", F.lit(0)), "_g").drop("_g"))
    n = n.groupBy(*by).agg(F.greatest(F.count(F.when(F.col("impactCumulative") <= F.col("_lim"), 1)),
                                      F.lit(1)).alias("_n"))
    if use_ranks:
        cand = median_rank(ranked, by)
        order = [F.col("rank").asc(), F.col(FEATURE)]
    else:
        cand = agg
        order = [F.col(UNNORM).desc(), F.col(FEATURE)]
    pos = cand.withColumn("position", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("bigint"))
    joined = pos.join(n, by) if by else pos.withColumn("_g", F.lit(0)).join(n.withColumn("_g", F.lit(0)), "_g")
    return joined.where(F.col("position") <= F.col("_n")).select(*by, "position", FEATURE)


def accumulate_select(impacts: DataFrame, ratio: float = 0.95, by: Sequence[str] = ()) -> DataFrame:
    """Selection by accumulated impact: zero redundant features, mean per
    feature, keep positive, normalise to sum 1, take features while the
    accumulated share before them is ``<= ratio`` (the crossing feature is
    included), at most ``round(min(100, max(25, 0.5 * count), taken))``
    (half to even).  With one or no positive feature, the top feature.
    Returns ``(by..., position, featureName)``."""
    by = list(by)
    mean = impact_mean(impacts, by)
    w_all = Window.partitionBy(*by)
    w_ord = Window.partitionBy(*by).orderBy(F.col(NORM).desc(), F.col(FEATURE))
    ranked = mean.withColumn("_pos_all", F.row_number().over(w_ord))
    pos = ranked.where(F.col(NORM) > 0)
    pos = (pos.withColumn("_share", F.col(NORM) / F.sum(NORM).over(w_all))
           .withColumn("_k", F.count(F.lit(1)).over(w_all))
           .withColumn("position", F.row_number().over(w_ord).cast("bigint")))
    pos = pos.withColumn("_before", F.coalesce(
        F.sum("_share").over(w_ord.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    taken = pos.withColumn("_taken", F.count(F.when(F.col("_before") <= F.lit(float(ratio)), 1)).over(w_all))
    cap = F.bround(F.least(F.lit(100.0), F.greatest(F.lit(25.0), F.col("_k") * 0.5),
                           F.col("_taken").cast("double")), 0)
    many = taken.where((F.col("_k") > 1) & (F.col("position") <= cap)).select(*by, "position", FEATURE)
    # groups with at most one positive feature return their first feature
    kcount = ranked.groupBy(*by).agg(F.count(F.when(F.col(NORM) > 0, 1)).alias("_kp"))
    first = ranked.where(F.col("_pos_all") == 1)
    first = (first.join(kcount, by) if by else first.withColumn("_g", F.lit(0))
             .join(kcount.withColumn("_g", F.lit(0)), "_g"))
    few = first.where(F.col("_kp") <= 1).select(*by, F.lit(1).cast("bigint").alias("position"), FEATURE)
    return many.unionByName(few)


def scope_table(models: DataFrame, model: str = MODEL, featurelist: str = "featurelist_name") -> DataFrame:
    """Scopes for reduced lists: all models; each feature list with two or
    more models; each model alone.  Returns ``(scope, model_id)``."""
    allm = models.select(F.lit("all").alias("scope"), model)
    per_fl = models.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(featurelist))) \
        .where(F.col("_n") >= 2).select(F.concat(F.lit("list:"), F.col(featurelist)).alias("scope"), model)
    per_m = models.select(F.concat(F.lit("model:"), F.col(model).cast("string")).alias("scope"), model)
    return allm.unionByName(per_fl).unionByName(per_m)


def reduced_lists(impacts: DataFrame, scopes: DataFrame, ratio: float = 0.95) -> DataFrame:
    """``accumulate_select`` for every scope in one partitioned pass."""
    return accumulate_select(impacts.join(scopes, MODEL), ratio, by=["scope"])


def cross_board_select(boards: DataFrame, ks: dict, impacts: DataFrame, score: str, ascending: bool = False, ratio: float = 0.99,
                       board: str = "board") -> DataFrame:
    """The best ``ks[b]`` models of each board ``b``, their impacts ensembled at ``ratio``: per scope (``all`` boards
    together, and each board) the features that hold ``ratio`` of the summed impact, best median rank first.

    One plan: picks, scopes and impacts meet in one join per table, and all
    scopes are selected side by side.  A feature that only some boards know is
    ranked among the models that know it.  ``(scope, position, featureName, n_models)``."""
    from churnkit.operators.leaderboard import top_of_each
    picked = top_of_each(boards, board, ks, score, ascending).select(F.col(board).alias("_b"), MODEL)
    scopes = (picked.select(F.lit("all").alias("scope"), MODEL).distinct()
              .unionByName(picked.select(F.concat(F.lit("board:"), "_b").alias("scope"), MODEL)))
    ranked = rank_impacts(impacts, model=MODEL) if "rank" not in impacts.columns else impacts
    chosen = ranked.join(scopes, MODEL)
    known = chosen.groupBy("scope", FEATURE).agg(F.countDistinct(MODEL).alias("n_models"))
    return fire_select(chosen, ratio, use_ranks=True, by=["scope"]).join(known, ["scope", FEATURE]).select(
        "scope", "position", FEATURE, "n_models")


def impact_pivot(impacts: DataFrame, models: Sequence) -> DataFrame:
    """Unnormalised impact per feature, one column per model."""
    return (impacts.groupBy(FEATURE).pivot(MODEL, list(models)).agg(F.first(UNNORM))
            .withColumnsRenamed({str(m): f"m{m}" for m in models}))


def impact_spread(impacts: DataFrame, n: int = 25) -> DataFrame:
    """Five-number summary of normalised impact over models for the top
    ``n`` features by mean impact (data under a box plot)."""
    mean = impacts.groupBy(FEATURE).agg(F.avg(NORM).alias("_m"))
    top = mean.orderBy(F.col("_m").desc(), F.col(FEATURE)).limit(n)  # top-n report
    sel = impacts.join(F.broadcast(top.select(FEATURE)), FEATURE, "left_semi")
    q = F.percentile(NORM, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return sel.groupBy(FEATURE).agg(F.min(NORM).alias("min"), q.alias("_q"), F.max(NORM).alias("max"),
                                    F.avg(NORM).alias("mean")) \
        .select(FEATURE, "min", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                F.col("_q")[2].alias("q3"), "max", "mean")


def drop_redundant(impacts: DataFrame) -> DataFrame:
    """Features not marked redundant, per model."""
    return impacts.where(F.col("redundantWith").isNull())


def top_k(df: DataFrame, by: str, k: int, tiebreak: str = FEATURE) -> DataFrame:
    """First ``k`` rows by ``by`` descending (TakeOrderedAndProject)."""
    return df.orderBy(F.col(by).desc(), F.col(tiebreak)).limit(k)

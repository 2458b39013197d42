"""Queries: Spark ML jobs replacing the service calls, blends, drift,
streaming scoring (§2.10, §2.11, §2.13, §2.15).  Model outputs are checked
by rows; blends and drift have exact oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from churnkit.operators import drift as dr, impact as im, ml
from churnkit.operators.metrics import curve_metrics
from churnkit.operators.sampling import split_group
from churnkit.operators.util import materialize
from churnkit.plans import reconcile as rc, sqlparts as sp
from churnkit.plans.q_sampling import uhash_sql
from churnkit.plans.registry import query
from churnkit.session import shared_path
from churnkit.sources import fixtures, load

FEATS = ["l_quantity", "l_extendedprice", "l_discount"]
LABEL, KEY = "target_column", "row_key"


def base(spark, sf):
    return fixtures.downsample_base(spark, sf).withColumn(LABEL, F.col(LABEL).cast("double"))


def fitted(spark, sf, kind="lr"):
    df = materialize(ml.hash_partition(base(spark, sf), KEY))
    return df, ml.fit(kind, FEATS, LABEL, df.where("partition = 'training'"))


@query("train_candidates", "2.13")
def q_train(spark, sf):
    """Logistic regression, random forest and GBT fitted on the training partition; validation/holdout metrics."""
    cands = [ml.Candidate("lr", "lr", tuple(FEATS), {}), ml.Candidate("rf", "rf", tuple(FEATS), {}),
             ml.Candidate("gbt", "gbt", tuple(FEATS), {})]
    lb, _ = ml.train_candidates(base(spark, sf), cands, LABEL, KEY)
    return lb


@query("tune_grid", "2.13")
def q_tune(spark, sf):
    """Elastic-net grid on the same hash partitions."""
    grid = [{"regParam": 0.0}, {"regParam": 0.01, "elasticNetParam": 0.5}, {"regParam": 0.1, "elasticNetParam": 0.0}]
    return ml.tune_grid(base(spark, sf), "lr", FEATS, LABEL, KEY, grid)


@query("backtest_score", "2.13")
def q_backtest_score(spark, sf):
    """Each of three group folds scored by a model fitted on the others."""
    return ml.backtest_score(split_group(base(spark, sf), [KEY], 3), "lr", FEATS, LABEL, "fold")


@query("batch_score", "2.13")
def q_batch_score(spark, sf):
    """Scores in the prediction-table layout (probabilities, label, threshold, status)."""
    df, m = fitted(spark, sf)
    return ml.batch_score(m, df, FEATS, 0.1211, [KEY, LABEL])


@query("write_predictions", "2.1")
def q_write_predictions(spark, sf):
    """Scored rows appended to a folder partitioned by status, read back."""
    from churnkit.sources.io import write_predictions
    df, m = fitted(spark, sf)
    path = shared_path(spark, f"churnkit-out/preds-{uuid.uuid4().hex}")
    write_predictions(ml.batch_score(m, df, FEATS, 0.1211, [KEY]), path, mode="append",
                      partition_by=["prediction_status"])
    return spark.read.parquet(path)


@query("write_predictions_repeated", "2.1", sql=fixtures.with_views("""
SELECT b.batch, CAST(COUNT(*) AS BIGINT) AS n, CAST(COUNT(DISTINCT row_key) AS BIGINT) AS n_keys, b.added
FROM downsample_base, (VALUES ('2024-01', 'true,false'), ('2024-02', 'true')) b(batch, added) GROUP BY b.batch, b.added""", "downsample_base"))
def q_write_repeated(spark, sf):
    """Two batches of scored rows, the first written twice: it is there once."""
    from churnkit.sources.io import write_predictions
    rows = base(spark, sf).select(KEY, (F.col("l_discount") * 10).alias("p"))
    path = shared_path(spark, f"churnkit-out/preds-{uuid.uuid4().hex}")
    first = [str(write_predictions(rows, path, batch_id="2024-01")).lower() for _ in range(2)]
    second = str(write_predictions(rows, path, batch_id="2024-02")).lower()
    out = spark.read.schema(f"{KEY} bigint, p double, batch string").parquet(path)
    added = F.when(F.col("batch") == "2024-01", ",".join(first)).otherwise(second)
    return out.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(KEY).alias("n_keys")).withColumn("added", added)


@query("blend_stacked", "2.13")
def q_stack(spark, sf):
    """GLM blender over the two churn predictors' scores."""
    s = rc.both_scored(spark, sf).withColumn("y", (F.col("true_churned") >= 1).cast("double")) \
        .withColumn("rule_p", F.col("bin_sum") / 15.0)
    _, out = ml.stack(s, ["churned_1_PREDICTION", "rule_p"], "y", rc.ROW_KEY, "GLM")
    return curve_metrics(out, "y", "p1")


@query("blend_stacked_methods", "2.13")
def q_stack_methods(spark, sf):
    """ENET and RF blenders over the two churn predictors' scores, out of fold."""
    s = materialize(rc.both_scored(spark, sf).withColumn("y", (F.col("true_churned") >= 1).cast("double"))
                    .withColumn("rule_p", F.col("bin_sum") / 15.0))
    out = None
    for method in ("ENET", "RF"):
        _, p = ml.stack(s, ["churned_1_PREDICTION", "rule_p"], "y", rc.ROW_KEY, method)
        p = p.select(F.lit(method).alias("method"), "y", "p1")
        out = p if out is None else out.unionByName(p)
    return curve_metrics(out, "y", "p1", by=["method"])


@query("permutation_importance", "2.10")
def q_perm(spark, sf):
    """Metric drop per shuffled feature over all rows (hash-bucket shuffles)."""
    df, m = fitted(spark, sf)
    return ml.permutation_importance(m, df.where("partition <> 'training'"), FEATS, LABEL, KEY)


@query("permutation_unused_feature", "2.10", sql="""SELECT 'unused' AS featureName, CAST(0.0 AS DOUBLE) AS impactUnnormalized, true AS others_move
UNION ALL SELECT 'constant', CAST(0.0 AS DOUBLE), true""")
def q_perm_unused(spark, sf):
    """Impact of a feature that the model does not use and of one that is the same in every row: exactly 0."""
    df = materialize(ml.hash_partition(base(spark, sf), KEY).withColumn("unused", F.col("l_discount") * 2).withColumn("constant", F.lit(3.5)))
    m = ml.fit("lr", [*FEATS, "constant"], LABEL, df.where("partition = 'training'"))
    imp = ml.permutation_importance(m, df, [*FEATS, "constant", "unused"], LABEL, KEY, "logloss", trained_on=[*FEATS, "constant"])
    moved = imp.agg(F.max(F.abs("impactUnnormalized")) > 0).first()[0]
    return imp.where(~F.col("featureName").isin(FEATS)).select("featureName", "impactUnnormalized", F.lit(moved).alias("others_move"))


@query("linear_contribution_impact", "2.10")
def q_linear(spark, sf):
    """Mean |coef * (x - mean)| per feature of the logistic model."""
    df, m = fitted(spark, sf)
    return ml.linear_impact(m, df, FEATS)


_COEFS = {"l_quantity": 0.25, "l_extendedprice": -0.0005, "l_discount": 3.0}


@query("linear_contribution_fixed", "2.10", r6=["impactUnnormalized"], sql=fixtures.with_views(
    "SELECT featureName, impactUnnormalized FROM (" + " UNION ALL ".join(
        f"SELECT '{f}' AS featureName, AVG(ABS({c} * ({f} - (SELECT AVG({f}) FROM downsample_base)))) AS impactUnnormalized "
        "FROM downsample_base" for f, c in _COEFS.items()) + ") t", "downsample_base"))
def q_linear_fixed(spark, sf):
    """The same impact for a linear model with given coefficients."""
    return ml.contribution_impact(base(spark, sf), _COEFS)


@query("ratio_decay_search", "2.10")
def q_decay(spark, sf):
    """Select by accumulated importance, retrain, square the ratio on no gain; three lives.  A better model's own
    impacts are what the next round selects by."""
    df, m = fitted(spark, sf)
    train, val = df.where("partition = 'training'"), df.where("partition = 'validation'")

    def impacts(model, feats):
        return (ml.permutation_importance(model, val, feats, LABEL, KEY).withColumn("model_id", F.lit(0))
                .withColumn("redundantWith", F.lit(None).cast("string")))

    now = {"impacts": impacts(m, FEATS), "best": None}

    def select(ratio):
        return [r[0] for r in im.accumulate_select(now["impacts"], ratio).select("featureName").collect()]

    def train_eval(feats):
        model = ml.fit("lr", feats, LABEL, train)
        auc = ml.evaluate(model, val, LABEL).select("auc").first()[0]
        if now["best"] is None or auc > now["best"]:
            now.update(best=auc, impacts=impacts(model, feats))
        return auc

    hist = ml.select_until_stable(train_eval, select, 0.95, lives=3)
    return spark.createDataFrame(hist, "round int, ratio double, n_features int, metric double, improved boolean, lives int")


@query("add_one_back_search", "2.11")
def q_add_one_back(spark, sf):
    """Per feature cluster, retrain with each member added back; best member by log loss."""
    from churnkit.plans import q_cluster as qc
    cm = qc.cmap(spark, sf)
    members = cm.where("cluster > 0").groupBy("cluster").agg(F.sort_array(F.collect_list("feature")).alias("m")).collect()
    data = qc.feature_frame(spark, sf).withColumn("returned", (F.col("l_returnflag") == "R").cast("double"))
    feats = [f for f in qc.FEATURES if f != qc.TARGET]
    clusters = [(r["cluster"], [f for f in r["m"] if f != qc.TARGET]) for r in members]
    return ml.add_one_back(data, clusters, feats, "returned", "rid")


# The two-model blend written as row arithmetic: a DuckDB double SUM is
# compensated and can round differently with input order, which would split
# ties; Spark's two-value mean (a + b) / 2 and median 0.5 * lo + 0.5 * hi are
# exact functions of the pair.
_BLEND_SQL = rc.sql("""
WITH pair AS (SELECT true_churned AS y, churned_1_PREDICTION AS a, bin_sum / 15.0 AS b
              FROM scored),
bl AS (SELECT 'AVG' AS method, y, (a + b) / 2 AS p FROM pair
       UNION ALL SELECT 'MED', y, 0.5 * LEAST(a, b) + 0.5 * GREATEST(a, b) FROM pair
       UNION ALL SELECT 'MIN', y, LEAST(a, b) FROM pair
       UNION ALL SELECT 'MAX', y, GREATEST(a, b) FROM pair)
""" + f"SELECT method, auc, average_precision FROM ({sp.curve_metrics('bl', 'y', 'p', ['method'])}) c")


@query("blend_simple", "2.13", r6=["auc", "average_precision"], sql=_BLEND_SQL)
def q_blend(spark, sf):
    """AVG/MED/MIN/MAX blends of the intent probability and the scaled rule score, judged on churn."""
    s = rc.both_scored(spark, sf)
    row = rc.ROW_KEY
    preds = (s.select(*row, "true_churned", F.lit("intent").alias("model"), F.col("churned_1_PREDICTION").alias("p"))
             .unionByName(s.select(*row, "true_churned", F.lit("rule").alias("model"), (F.col("bin_sum") / 15.0).alias("p"))))
    combos = spark.createDataFrame([("intent+rule", "intent"), ("intent+rule", "rule")], "combo_id string, model string")
    b = ml.blend_all(preds, combos, ["AVG", "MED", "MIN", "MAX"], row, extra={"y": F.max("true_churned")})
    return curve_metrics(b, "y", "p", by=["method"]).select("method", "auc", "average_precision")


@query("blend_histograms", "2.13", sql=rc.sql("""
SELECT m.method, CAST(SUM(CASE WHEN true_churned >= 1 THEN 1 ELSE 0 END) AS DOUBLE) AS n_pos,
  CAST(SUM(CASE WHEN true_churned >= 1 THEN 0 ELSE 1 END) AS DOUBLE) AS n_neg, true AS near_exact
FROM scored, (VALUES ('AVG'), ('MED'), ('MIN'), ('MAX')) m(method)
WHERE true_churned IS NOT NULL GROUP BY m.method"""))
def q_blend_histograms(spark, sf):
    """The same blends from score histograms filled in the tasks: class totals, and whether AUC and average precision
    are within 0.005 of the exact ones."""
    row, methods = rc.ROW_KEY, ["AVG", "MED", "MIN", "MAX"]
    s = rc.both_scored(spark, sf)
    preds = materialize(s.select(*row, "true_churned", F.lit("intent").alias("model"), F.col("churned_1_PREDICTION").alias("p"))
                        .unionByName(s.select(*row, "true_churned", F.lit("rule").alias("model"), (F.col("bin_sum") / 15.0).alias("p"))))
    combos = spark.createDataFrame([("intent+rule", "intent"), ("intent+rule", "rule")], "combo_id string, model string")
    rough = ml.blend_metrics(preds, combos, methods, row, "true_churned")
    exact = curve_metrics(ml.blend_all(preds, combos, methods, row, extra={"y": F.max("true_churned")}), "y", "p", by=["method"])
    both = rough.join(exact.select("method", F.col("auc").alias("a"), F.col("average_precision").alias("b")), "method")
    return both.select("method", "n_pos", "n_neg", ((F.abs(F.col("auc") - F.col("a")) < 0.005)
                                                    & (F.abs(F.col("average_precision") - F.col("b")) < 0.005)).alias("near_exact"))


_DRIFT_COLS = ["l_quantity", "l_extendedprice", "l_discount"]
_CUT = "TIMESTAMP '1996-01-01 00:00:00'"


def _drift_sql():
    cast = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _DRIFT_COLS)
    on = ", ".join(_DRIFT_COLS)
    qs = ", ".join(f"quantile_cont(v, {i / 10})" for i in range(1, 10))
    return f"""
WITH lb AS (SELECT "column", v FROM (UNPIVOT (SELECT {cast} FROM lineitem WHERE l_shipdate < {_CUT}) ON {on}
            INTO NAME "column" VALUE v) u WHERE v IS NOT NULL),
ln AS (SELECT "column", v FROM (UNPIVOT (SELECT {cast} FROM lineitem WHERE NOT (l_shipdate < {_CUT})) ON {on}
            INTO NAME "column" VALUE v) u WHERE v IS NOT NULL),
edges AS (SELECT DISTINCT "column", e FROM (SELECT "column", UNNEST([{qs}]) AS e FROM lb GROUP BY "column") x),
nb AS (SELECT "column", COUNT(*) + 1 AS k FROM edges GROUP BY "column"),
bins AS (SELECT "column", CAST(range AS INT) AS bin FROM nb, range(k)),
bb AS (SELECT l."column", (SELECT COUNT(*) FROM edges e WHERE e."column" = l."column" AND e.e <= l.v) AS bin FROM lb l),
bn AS (SELECT l."column", (SELECT COUNT(*) FROM edges e WHERE e."column" = l."column" AND e.e <= l.v) AS bin FROM ln l),
p AS (SELECT "column", bin, CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (PARTITION BY "column") AS p FROM bb GROUP BY 1, 2),
q AS (SELECT "column", bin, CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (PARTITION BY "column") AS q FROM bn GROUP BY 1, 2),
j AS (SELECT b."column", b.bin, GREATEST(COALESCE(p.p, 0.0), 1e-6) AS p, GREATEST(COALESCE(q.q, 0.0), 1e-6) AS q
      FROM bins b LEFT JOIN p USING ("column", bin) LEFT JOIN q USING ("column", bin))
SELECT "column", SUM((q - p) * ln(q / p)) AS psi, COUNT(*) AS n_bins FROM j GROUP BY "column"
"""


@query("drift_report", "2.13", r6=["psi"], sql=_drift_sql())
def q_drift(spark, sf):
    """PSI of line-item amounts shipped from 1996 against earlier ones (base deciles)."""
    li = load(spark, sf, "lineitem", [*_DRIFT_COLS, "l_shipdate"])
    cut = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    return dr.numeric_drift(li.where(F.col("l_shipdate") < cut), li.where(~(F.col("l_shipdate") < cut)), _DRIFT_COLS)


@query("drift_report_categorical", "2.13", r6=["psi"], sql=f"""
WITH b AS (SELECT "column", bin FROM (UNPIVOT (SELECT l_returnflag, l_linestatus FROM lineitem WHERE l_shipdate < {_CUT})
           ON l_returnflag, l_linestatus INTO NAME "column" VALUE bin) u WHERE bin IS NOT NULL),
n AS (SELECT "column", bin FROM (UNPIVOT (SELECT l_returnflag, l_linestatus FROM lineitem WHERE NOT (l_shipdate < {_CUT}))
      ON l_returnflag, l_linestatus INTO NAME "column" VALUE bin) u WHERE bin IS NOT NULL),
p AS (SELECT "column", bin, CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (PARTITION BY "column") AS p FROM b GROUP BY 1, 2),
q AS (SELECT "column", bin, CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (PARTITION BY "column") AS q FROM n GROUP BY 1, 2),
j AS (SELECT COALESCE(p."column", q."column") AS "column", GREATEST(COALESCE(p.p, 0.0), 1e-6) AS p,
        GREATEST(COALESCE(q.q, 0.0), 1e-6) AS q FROM p FULL OUTER JOIN q ON p."column" = q."column" AND p.bin = q.bin)
SELECT "column", SUM((q - p) * ln(q / p)) AS psi, COUNT(*) AS n_bins FROM j GROUP BY "column"
""")
def q_drift_cat(spark, sf):
    """PSI of return flag and line status, 1996 onwards against earlier."""
    li = load(spark, sf, "lineitem", ["l_returnflag", "l_linestatus", "l_shipdate"])
    cut = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    return dr.categorical_drift(li.where(F.col("l_shipdate") < cut), li.where(~(F.col("l_shipdate") < cut)),
                                ["l_returnflag", "l_linestatus"])


@query("streaming_batch_score", "2.15")
def q_stream(spark, sf):
    """The scoring transform run as a stream over the line-item files (availableNow)."""
    from churnkit.streaming import score_stream
    _, m = fitted(spark, sf)
    schema = "l_orderkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double"
    run = uuid.uuid4().hex
    sink = shared_path(spark, f"churnkit-out/stream-{run}")
    ckpt = shared_path(spark, f"churnkit-ckpt/stream-{run}")

    def prepare(df):
        return df.selectExpr("l_orderkey * 8 + l_linenumber AS row_key", *FEATS)

    # a file source watches a folder or glob; the glob selects the one table file
    score_stream(spark, m, f"{sf}/lineitem.parque[t]", schema, prepare, FEATS, 0.1211, [KEY], sink, ckpt)
    return spark.read.parquet(sink)


@query("fire_feature_selection", "2.10")
def q_fire_flow(spark, sf):
    """The whole selection loop on the 12 line-item features (label: returned), rank ensembling of two models."""
    from churnkit.plans import feature_selection, q_cluster as qc
    data = qc.feature_frame(spark, sf).withColumn("returned", (F.col("l_returnflag") == "R").cast("double"))
    feats = [f for f in qc.FEATURES if f != qc.TARGET]
    return feature_selection.run(data, feats, "returned", "rid", kinds=("lr", "gbt"), n_models=2)


@query("redundancy_loop", "2.10")
def q_redundancy_loop(spark, sf):
    """Drop correlated features, refit, until none is redundant (label: returned)."""
    from churnkit.plans import feature_selection, q_cluster as qc
    data = qc.feature_frame(spark, sf).withColumn("returned", (F.col("l_returnflag") == "R").cast("double"))
    return feature_selection.without_redundant(data, [f for f in qc.FEATURES if f != qc.TARGET], "returned", "rid")


_PART_SQL = (f"SELECT *, CASE WHEN {uhash_sql('row_key', 0)} < 0.1 THEN 'holdout' WHEN {uhash_sql('row_key', 0)} < 0.1 + 0.2 "
             "THEN 'validation' ELSE 'training' END AS partition FROM downsample_base")


@query("train_candidates_counts", "2.13", sql=fixtures.with_views(f"""
SELECT m.model_id, m.model_type, 3 AS n_features, p.partition, p.n_pos, p.n_neg, true AS in_range
FROM (SELECT partition, CAST(SUM(target_column) AS DOUBLE) AS n_pos, CAST(COUNT(*) - SUM(target_column) AS DOUBLE) AS n_neg
      FROM ({_PART_SQL}) x WHERE partition <> 'training' GROUP BY partition) p
CROSS JOIN (SELECT * FROM (VALUES ('lr', 'lr'), ('rf', 'rf')) v(model_id, model_type)) m""", "downsample_base"))
def q_train_counts(spark, sf):
    """What a leaderboard holds whatever the models learn: models, partitions, class totals, metrics in their ranges
    and a log loss not above a constant's by much."""
    cands = [ml.Candidate("lr", "lr", tuple(FEATS), {}), ml.Candidate("rf", "rf", tuple(FEATS), {"numTrees": 5})]
    lb, _ = ml.train_candidates(base(spark, sf), cands, LABEL, KEY)
    ok = F.col("auc").between(0, 1) & F.col("ks").between(0, 1) & (F.col("logloss") > 0) & (F.col("fve_binomial") > -0.1)
    return lb.select("model_id", "model_type", "n_features", "partition", "n_pos", "n_neg", ok.alias("in_range"))


_START = [("Logistic Regression", "lr", {}), ("Random Forest (small)", "rf", {"numTrees": 4, "maxDepth": 3})]
_REPOSITORY = [("Logistic Regression (L2)", "lr", {"regParam": 0.05}), ("Random Forest (deep)", "rf", {"numTrees": 4, "maxDepth": 6}),
               ("Gradient Boosted Trees", "gbt", {"maxIter": 3})]


@query("leaderboard_iteration", "2.12", sql=fixtures.with_views(f"""
SELECT v.part, v.n_models, p.n_pos, p.n_neg, v.second_run FROM (
  SELECT partition, CAST(SUM(target_column) AS DOUBLE) AS n_pos, CAST(COUNT(*) - SUM(target_column) AS DOUBLE) AS n_neg
  FROM ({_PART_SQL}) x WHERE partition <> 'training' GROUP BY partition) p
JOIN (SELECT * FROM (VALUES ('start', 'validation', 2, 0), ('start', 'holdout', 2, 0), ('similar', 'validation', 2, 0), ('similar', 'holdout', 2, 0),
  ('blends', 'validation', 8, 0), ('blends', 'holdout', 8, 0), ('kept', 'validation', 3, 0)) v(part, fold, n_models, second_run)) v
ON v.fold = p.partition""", "downsample_base"))
def q_iteration(spark, sf):
    """The iteration run twice on one board: models of the steps whose number does not depend on what models learn, their
    class totals, and how many rows the second run changed."""
    from churnkit.plans.board_iteration import iterate
    path = shared_path(spark, f"churnkit-out/board-{uuid.uuid4().hex}")
    args = (base(spark, sf), FEATS, LABEL, KEY, path, _START, _REPOSITORY, 0.9, {"lr": [{"regParam": 0.01}]}, ("AVG", "MED"))
    iterate(*args)
    board, again = iterate(*args)
    part = (F.when(F.col("segment") == "retention", "kept").when(F.col("step") == 1, "start").when(F.col("step") == 2, "similar")
            .when(F.col("step") == 5, "blends"))
    value = lambda m: F.max(F.when(F.col("metric") == m, F.col("value")))
    rows = board.where("segment = 'all' AND metric IN ('n_pos', 'n_neg') OR metric = 'kept' AND value = 1").withColumn("part", part)
    totals = board.where("segment = 'all'").groupBy("fold").agg(value("n_pos").alias("n_pos"), value("n_neg").alias("n_neg"))
    same = rows.where("part IS NOT NULL").groupBy("part", "fold").agg(F.countDistinct("model_id").cast("int").alias("n_models"))
    return same.join(totals, "fold").select("part", "n_models", "n_pos", "n_neg", F.lit(again).alias("second_run"))


@query("batch_score_checks", "2.13", sql=fixtures.with_views("""
SELECT CASE WHEN l_quantity > 40 THEN 'missing feature' ELSE 'OK' END AS prediction_status, COUNT(*) AS n,
  CAST(SUM(target_column) AS BIGINT) AS positives, true AS consistent FROM downsample_base GROUP BY 1""", "downsample_base"))
def q_batch_checks(spark, sf):
    """Scored rows by status (a feature made missing): none is lost, probabilities add up, labels follow the threshold."""
    df, m = fitted(spark, sf)
    holes = df.withColumn("l_discount", F.when(F.col("l_quantity") <= 40, F.col("l_discount")))
    out = ml.batch_score(m, holes, FEATS, 0.1211, [KEY, LABEL])
    p1, p0 = F.col("churned_1_PREDICTION"), F.col("churned_0_PREDICTION")
    right = (F.abs(p1 + p0 - 1) < 1e-9) & ((p1 >= 0.1211).cast("double") == F.col("churned_PREDICTION")) & p1.between(0, 1)
    empty = p1.isNull() & p0.isNull() & F.col("churned_PREDICTION").isNull()
    ok = F.when(F.col("prediction_status") == "OK", right).otherwise(empty)
    return out.groupBy("prediction_status").agg(F.count(F.lit(1)).alias("n"), F.sum(LABEL).cast("bigint").alias("positives"),
                                                F.min(ok).alias("consistent"))


@query("backtest_score_counts", "2.13", sql=fixtures.with_views("""
SELECT fold, CAST(SUM(target_column) AS DOUBLE) AS n_pos, CAST(COUNT(*) - SUM(target_column) AS DOUBLE) AS n_neg, true AS in_range
FROM (SELECT *, CAST((('0x' || substr(md5('0:' || CAST(row_key AS VARCHAR)), 1, 8))::BIGINT) % 3 AS INT) AS fold
      FROM downsample_base) t GROUP BY fold""", "downsample_base"))
def q_backtest_counts(spark, sf):
    """Class totals of each group fold that is scored by the models of the others."""
    out = ml.backtest_score(split_group(base(spark, sf), [KEY], 3), "lr", FEATS, LABEL, "fold")
    return out.select("fold", "n_pos", "n_neg", (F.col("auc").between(0, 1) & (F.col("logloss") > 0)).alias("in_range"))


@query("blend_combinations", "2.13")
def q_blend_combos(spark, sf):
    """AVG/MED/MIN/MAX blends of every 2..3-model combination of LR, RF and GBT on the validation rows."""
    from churnkit.operators.joins import model_combinations
    # row_key repeats in this table: blend per row needs a unique id, fixed
    # by writing the table once
    df = materialize(ml.hash_partition(base(spark, sf), KEY).withColumn("_rid", F.monotonically_increasing_id()))
    train, val = df.where("partition = 'training'"), df.where("partition = 'validation'")
    kinds = ["lr", "rf", "gbt"]
    from churnkit.operators.util import run_all
    fitted_models = run_all(lambda k: ml.fit(k, FEATS, LABEL, train), kinds)  # independent fits from threads
    # a row's predictions stand side by side, so no row is shuffled
    preds, columns = ml.side_by_side(dict(zip(kinds, fitted_models)), val, ["_rid", LABEL], FEATS)
    preds = materialize(preds)
    models = spark.createDataFrame([(k,) for k in kinds], "model_id string")
    combos = model_combinations(models, 3).select(F.array_join("combo", "+").alias("combo_id"),
                                                  F.explode("combo").alias("model"))
    blended = ml.blend_all(preds, combos, ["AVG", "MED", "MIN", "MAX"], ["_rid"], extra={"y": F.col(LABEL)}, p_cols=columns)
    return curve_metrics(blended, "y", "p", by=["combo_id", "method"])


@query("backtest_score_time", "2.13")
def q_backtest_time(spark, sf):
    """Logistic model scored on three time backtests of the line items (60-day gap, 2-month validation)."""
    from churnkit.operators.splits import backtest_folds
    from churnkit.plans import q_cluster as qc
    data = qc.feature_frame(spark, sf, with_date=True) \
        .withColumn("returned", (F.col("l_returnflag") == "R").cast("double"))
    feats = [f for f in qc.FEATURES if f != qc.TARGET]
    folds = backtest_folds(data, "l_shipdate", 3, "P0Y0M60DT0H0M0S", "P0Y2M0DT0H0M0S", "P0Y1M0DT0H0M0S")
    return ml.backtest_time(data, "l_shipdate", folds, "lr", feats, "returned")


@query("training_duration_score", "2.9")
def q_duration_score(spark, sf):
    """Logistic model trained on the last 1, 2 and 4 months before each backtest's gap, scored on its validation."""
    from churnkit.operators.splits import backtest_folds
    from churnkit.plans import q_cluster as qc
    data = qc.feature_frame(spark, sf, with_date=True) \
        .withColumn("returned", (F.col("l_returnflag") == "R").cast("double"))
    feats = [f for f in qc.FEATURES if f != qc.TARGET]
    folds = backtest_folds(data, "l_shipdate", 2, "P0Y0M60DT0H0M0S", "P0Y2M0DT0H0M0S", "P0Y1M0DT0H0M0S")
    return ml.duration_grid_score(data, "l_shipdate", folds, [1, 2, 4], "lr", feats, "returned")


@query("tune_grid_backtests", "2.13")
def q_tune_backtests(spark, sf):
    """Elastic-net grid on two time backtests: per-fold metrics and mean AUC per parameter map."""
    from churnkit.operators.splits import backtest_folds
    from churnkit.plans import q_cluster as qc
    data = qc.feature_frame(spark, sf, with_date=True) \
        .withColumn("returned", (F.col("l_returnflag") == "R").cast("double"))
    feats = [f for f in qc.FEATURES if f != qc.TARGET]
    folds = backtest_folds(data, "l_shipdate", 2, "P0Y0M60DT0H0M0S", "P0Y2M0DT0H0M0S", "P0Y1M0DT0H0M0S")
    grid = [{"regParam": 0.0}, {"regParam": 0.01, "elasticNetParam": 0.5}]
    return ml.tune_on_backtests(data, "l_shipdate", folds, "lr", feats, "returned", grid)


# A logistic regression whose penalty leaves no coefficient predicts the training rows' positive share, so what the fits,
# folds and partitions around it must give can be said in SQL to the last digit.
_ONLY_INTERCEPT = {"regParam": 1000.0, "elasticNetParam": 1.0}


def _constant_logloss(p: str, pos: str = "n_pos", neg: str = "n_neg") -> str:
    return f"-({pos} * LN({p}) + {neg} * LN(1 - ({p}))) / ({pos} + {neg})"


_SHARES_SQL = f"""parted AS ({_PART_SQL}),
share AS (SELECT AVG(target_column) AS p FROM parted WHERE partition = 'training'),
val AS (SELECT CAST(SUM(target_column) AS DOUBLE) AS n_pos, CAST(COUNT(*) - SUM(target_column) AS DOUBLE) AS n_neg
        FROM parted WHERE partition = 'validation')"""


@query("tune_grid_fixed", "2.13", r6=["logloss", "auc"], sql=fixtures.with_views(f"""
WITH {_SHARES_SQL}
SELECT g.grid_id, n_pos, n_neg, {_constant_logloss('p')} AS logloss, 0.5 AS auc
FROM share, val, (VALUES (0), (1)) g(grid_id)""", "downsample_base"))
def q_tune_fixed(spark, sf):
    """Grid points whose penalty leaves the intercept alone: log loss of the training share on the validation rows."""
    grid = [_ONLY_INTERCEPT, _ONLY_INTERCEPT | {"regParam": 500.0}]
    out = ml.tune_grid(base(spark, sf), "lr", FEATS, LABEL, KEY, grid)
    return out.select("grid_id", "n_pos", "n_neg", "logloss", "auc")


@query("backtest_score_fixed", "2.13", r6=["logloss"], sql=fixtures.with_views(f"""
WITH t AS (SELECT *, CAST((('0x' || substr(md5('0:' || CAST(row_key AS VARCHAR)), 1, 8))::BIGINT) % 3 AS INT) AS fold
           FROM downsample_base),
f AS (SELECT fold, CAST(SUM(target_column) AS DOUBLE) AS n_pos, CAST(COUNT(*) - SUM(target_column) AS DOUBLE) AS n_neg
      FROM t GROUP BY fold),
o AS (SELECT a.fold, a.n_pos, a.n_neg, SUM(b.n_pos) / SUM(b.n_pos + b.n_neg) AS p
      FROM f a JOIN f b ON a.fold <> b.fold GROUP BY ALL)
SELECT fold, n_pos, n_neg, {_constant_logloss('p')} AS logloss FROM o""", "downsample_base"))
def q_backtest_fixed(spark, sf):
    """Each fold's log loss under the positive share of the other folds."""
    out = ml.backtest_score(split_group(base(spark, sf), [KEY], 3), "lr", FEATS, LABEL, "fold", **_ONLY_INTERCEPT)
    return out.select("fold", "n_pos", "n_neg", "logloss")


@query("blend_stacked_fixed", "2.13", r6=["p1"], sql=fixtures.with_views("""
WITH f AS (SELECT CAST((('0x' || substr(md5('0:' || CAST(row_key AS VARCHAR)), 1, 8))::BIGINT) % 4 AS INT) AS fold,
             CAST(SUM(target_column) AS BIGINT) AS positives, COUNT(*) AS n FROM downsample_base GROUP BY 1)
SELECT a.fold, a.n, a.positives, SUM(b.positives) / SUM(b.n) AS p1, 1 AS distinct_scores
FROM f a JOIN f b ON a.fold <> b.fold GROUP BY a.fold, a.n, a.positives""", "downsample_base"))
def q_stack_fixed(spark, sf):
    """Four folds of a stacked blender reduced to its intercept: every row is scored once, by the share of the others."""
    s = base(spark, sf).withColumn("a", F.col("l_discount") * 10).withColumn("b", F.col("l_quantity") / 50)
    _, out = ml.stack(s, ["a", "b"], LABEL, [KEY], "ENET", folds=4, params=_ONLY_INTERCEPT)
    return split_group(out, [KEY], 4).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum(LABEL).cast("bigint").alias("positives"), F.avg("p1").alias("p1"),
        F.countDistinct(F.round("p1", 9)).cast("int").alias("distinct_scores"))


@query("add_one_back_fixed", "2.11", r6=["metric"], sql=fixtures.with_views(f"""
WITH {_SHARES_SQL}
SELECT c.cluster, c.feature, {_constant_logloss('p')} AS metric, c.best
FROM share, val, (VALUES (1, 'l_discount', true), (1, 'l_extendedprice', false), (2, 'l_quantity', true)) c(cluster, feature, best)""",
    "downsample_base"))
def q_add_one_back_fixed(spark, sf):
    """Members of two clusters added back to a model that uses none of them: equal metrics, the first name wins."""
    clusters = [(1, ["l_extendedprice", "l_discount"]), (2, ["l_quantity"])]
    return ml.add_one_back(base(spark, sf), clusters, FEATS, LABEL, KEY, **_ONLY_INTERCEPT)


_DECAY_COEFS = {"l_quantity": 0.13, "l_extendedprice": -0.0005, "l_discount": 3.0}


@query("ratio_decay_schedule", "2.10", r6=["ratio", "metric"], sql=fixtures.with_views(
    "SELECT * FROM (WITH RECURSIVE imp AS (" + " UNION ALL ".join(
        f"SELECT '{f}' AS f, AVG(ABS({c} * ({f} - (SELECT AVG({f}) FROM downsample_base)))) AS v FROM downsample_base"
        for f, c in _DECAY_COEFS.items()) + """),
ranked AS (SELECT ROW_NUMBER() OVER (ORDER BY v DESC, f) AS k, SUM(v) OVER (ORDER BY v DESC, f) AS total,
             SUM(v) OVER (ORDER BY v DESC, f) - v AS before, SUM(v) OVER () AS whole FROM imp),
prefix AS (SELECT CAST(k AS INT) AS n, total / (k * k) AS metric, before / whole AS lo,
             COALESCE(LEAD(before / whole) OVER (ORDER BY k), 2) AS hi FROM ranked),
step AS (
  SELECT 0 AS "round", CAST(0.95 AS DOUBLE) AS ratio, n AS n_features, metric, true AS improved, 3 AS lives, metric AS best
  FROM prefix WHERE lo <= 0.95 AND hi > 0.95
  UNION ALL
  SELECT s."round" + 1, CASE WHEN p.metric > s.best THEN s.ratio ELSE s.ratio * s.ratio END, p.n, p.metric, p.metric > s.best,
    CASE WHEN p.metric > s.best THEN s.lives ELSE s.lives - 1 END, GREATEST(p.metric, s.best)
  FROM step s JOIN prefix p ON p.lo <= s.ratio AND p.hi > s.ratio
  WHERE s.lives > 0 AND s.ratio > 0.01 AND NOT (s.improved AND s.n_features <= 1))
SELECT "round", ratio, n_features, metric, improved, lives FROM step) t""", "downsample_base"))
def q_decay_schedule(spark, sf):
    """The search on the impacts of a linear model with given coefficients and a metric that follows from them: which
    features each ratio takes, when a life is lost, when it ends."""
    impacts = materialize(ml.contribution_impact(base(spark, sf), _DECAY_COEFS).withColumn("model_id", F.lit(0))
                          .withColumn("redundantWith", F.lit(None).cast("string")))
    value = {r["featureName"]: r["impactUnnormalized"] for r in impacts.collect()}  # one row for each feature
    impacts = impacts.withColumn(im.NORM, F.col("impactUnnormalized") / max(value.values()))
    hist = ml.select_until_stable(lambda feats: sum(value[f] for f in feats) / len(feats) ** 2,
                                  lambda ratio: [r[0] for r in im.accumulate_select(impacts, ratio).select("featureName").collect()], 0.95, lives=3)
    return spark.createDataFrame(hist, "round int, ratio double, n_features int, metric double, improved boolean, lives int")

"""Queries: leaderboard flattening, sorting, selection, dedup, retention (§2.3, §2.5-2.7, §2.12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnkit.operators import joins as jn, leaderboard as lbo
from churnkit.operators.dedup import duplicate_subset, mark_duplicates
from churnkit.plans.registry import query
from churnkit.sources import fixtures

SPEC = {"AUC": {"validation": "auc_validation", "backtesting": "auc_backtesting", "holdout": "auc_holdout"},
        "LogLoss": {"validation": "logloss_validation", "backtesting": "logloss_backtesting"}}
METRIC_COLS = [c for parts in SPEC.values() for c in parts.values()]
WIDE_NAMES = [f"{m}_{p}" for m, parts in SPEC.items() for p in parts]


def lb(spark, sf):
    return fixtures.leaderboard(spark, sf)


def lsql(body: str, extra: dict | None = None) -> str:
    return fixtures.with_views(body, "leaderboard", "metric_meta", extra=extra)


_LONG_SQL = "\nUNION ALL\n".join(
    f"SELECT model_id, '{m}' AS metric, '{p}' AS partition, {c} AS value FROM leaderboard"
    for m, parts in SPEC.items() for p, c in parts.items())


@query("flatten_metrics", "2.12", sql=lsql(_LONG_SQL))
def q_flatten(spark, sf):
    """Nested metric map to long (model, metric, partition, value)."""
    return lbo.flatten_metrics(lbo.nested_metrics(lb(spark, sf), SPEC))


@query("flatten_metrics_wide", "2.12", sql=lsql(
    "SELECT model_id, " + ", ".join(f'{c} AS "{m}_{p}"' for m, parts in SPEC.items() for p, c in parts.items())
    + " FROM leaderboard"))
def q_flatten_wide(spark, sf):
    """Nested metrics to one column per metric_partition."""
    long = lbo.flatten_metrics(lbo.nested_metrics(lb(spark, sf), SPEC))
    return lbo.metrics_wide(long, names=WIDE_NAMES)


@query("map_access", "2.8", sql=lsql(
    "SELECT model_id, auc_validation AS auc_val, logloss_backtesting AS logloss_bt FROM leaderboard"))
def q_map_access(spark, sf):
    """``metrics[metric][partition]`` lookups on the nested map."""
    n = lbo.nested_metrics(lb(spark, sf), SPEC)
    return n.select("model_id", F.element_at(F.element_at("metrics", F.lit("AUC")), F.lit("validation")).alias("auc_val"),
                    F.col("metrics")["LogLoss"]["backtesting"].alias("logloss_bt"))


@query("metric_direction_lookup", "2.3", sql=lsql(
    f"SELECT l.model_id, l.metric, l.partition, l.value, m.ascending FROM ({_LONG_SQL}) l "
    "JOIN metric_meta m ON m.metric_name = l.metric"))
def q_direction(spark, sf):
    """Long metrics joined to the metric metadata (sort direction)."""
    long = lbo.flatten_metrics(lbo.nested_metrics(lb(spark, sf), SPEC))
    meta = fixtures.metric_meta(spark)
    return long.join(F.broadcast(meta), long.metric == meta.metric_name).select(
        "model_id", "metric", "partition", "value", "ascending")


@query("sort_leaderboard", "2.6", sql=lsql(
    "SELECT model_id, auc_validation, ROW_NUMBER() OVER (ORDER BY auc_validation DESC, model_id) AS position "
    "FROM leaderboard WHERE auc_validation IS NOT NULL"))
def q_sort(spark, sf):
    """Models with a validation AUC, best first (direction from metric metadata)."""
    asc = lbo.direction(fixtures.metric_meta(spark), "AUC")
    return lbo.sort_leaderboard(lb(spark, sf), "auc_validation", asc).select("model_id", "auc_validation", "position")


@query("sort_leaderboard_logloss_backtesting", "2.6", sql=lsql(
    "SELECT model_id, logloss_backtesting, ROW_NUMBER() OVER (ORDER BY logloss_backtesting ASC, model_id) AS position "
    "FROM leaderboard WHERE logloss_backtesting IS NOT NULL"))
def q_sort_ll(spark, sf):
    """Ascending metric on the backtesting partition (nulls dropped)."""
    asc = lbo.direction(fixtures.metric_meta(spark), "LogLoss")
    return lbo.sort_leaderboard(lb(spark, sf), "logloss_backtesting", asc).select(
        "model_id", "logloss_backtesting", "position")


_BEST = ("SELECT model_id, auc_validation, ROW_NUMBER() OVER (ORDER BY auc_validation DESC NULLS LAST, model_id) "
         "AS position FROM leaderboard WHERE model_category = 'model' AND NOT is_frozen {cond}")


@query("best_models", "2.6", sql=lsql(
    "SELECT * FROM (" + _BEST.format(cond="AND NOT COALESCE(contains(featurelist_name, '" + fixtures.REDUCED_MARKER + "'), false)")
    + ") b WHERE position <= 5"))
def q_best(spark, sf):
    """Top 5 non-blend, non-frozen models by validation AUC, nulls last, none on a reduced list."""
    return lbo.best_models(lb(spark, sf), "auc_validation", False, n=5, reduced_marker=fixtures.REDUCED_MARKER).select("model_id", "auc_validation", "position")


@query("best_models_on_list", "2.6", sql=lsql(
    "SELECT * FROM (" + _BEST.format(cond="AND featurelist_name = 'fl1'") + ") b WHERE position <= 5"))
def q_best_list(spark, sf):
    """Top 5 models on feature list fl1."""
    return lbo.best_models(lb(spark, sf), "auc_validation", False, n=5, featurelist="fl1") \
        .select("model_id", "auc_validation", "position")


@query("head_rows", "2.6", sql=lsql("SELECT * EXCLUDE (model_type) FROM leaderboard ORDER BY model_id LIMIT 5"))
def q_head(spark, sf):
    """First five models by id."""
    return lb(spark, sf).drop("model_type").orderBy("model_id").limit(5)


@query("candidate_model_filter", "2.10", sql=lsql("""
SELECT model_id FROM (SELECT model_id, COUNT(*) OVER () AS n FROM leaderboard
  WHERE NOT contains(model_type, 'Baseline Predictions') AND NOT contains(model_type, 'Mean Response')
    AND NOT contains(model_type, 'Majority Class') AND NOT contains(model_type, 'Auto-Tuned')
    AND NOT COALESCE(starts_with(featurelist_name, 'Baseline'), false)
    AND NOT COALESCE(starts_with(featurelist_name, 'Date'), false)) t WHERE n >= 2"""))
def q_candidates(spark, sf):
    """Models usable for feature selection (fixed name phrases and list prefixes removed)."""
    return lbo.selectable_models(lb(spark, sf)).select("model_id")


@query("top_n_prefer_backtested", "2.12", sql=lsql("""
SELECT model_id, auc_validation, auc_backtesting,
  ROW_NUMBER() OVER (ORDER BY auc_backtesting DESC NULLS LAST, auc_validation DESC NULLS LAST, model_id) AS position
FROM (SELECT * FROM leaderboard WHERE auc_validation IS NOT NULL
      ORDER BY auc_backtesting IS NOT NULL DESC, auc_validation DESC NULLS LAST, model_id LIMIT 9) t"""))
def q_top_n(spark, sf):
    """Nine models, backtested ones first, re-sorted by backtesting AUC."""
    return lbo.top_n_models(lb(spark, sf), 9, "auc_backtesting", "auc_validation", False) \
        .select("model_id", "auc_validation", "auc_backtesting", "position")


_SUBSET = duplicate_subset(METRIC_COLS + ["blueprint_id", "n_features"])
_DUP_SQL = ("SELECT *, ROW_NUMBER() OVER (PARTITION BY " + ", ".join(_SUBSET)
            + " ORDER BY n_features, model_id) > 1 AS duplicate FROM leaderboard")


@query("full_row_duplicates", "2.5", sql=lsql(f"SELECT model_id, n_features, duplicate FROM ({_DUP_SQL}) d"))
def q_dups(spark, sf):
    """Models equal on every metric and blueprint; the one with fewest features kept."""
    return mark_duplicates(lb(spark, sf), _SUBSET, ["n_features", "model_id"]).select("model_id", "n_features", "duplicate")


_RET_SQL = f"""
WITH d AS ({_DUP_SQL}),
keep AS (SELECT model_id FROM (SELECT model_id, ROW_NUMBER() OVER (ORDER BY auc_validation DESC, model_id) AS r
         FROM d WHERE NOT duplicate AND auc_validation IS NOT NULL) k WHERE r <= 9),
del AS (SELECT d.model_id, ROW_NUMBER() OVER (ORDER BY model_category, d.model_id) AS delete_order
        FROM d WHERE d.model_id NOT IN (SELECT model_id FROM keep))"""


@query("retention_keep_top_n", "2.12", sql=lsql(_RET_SQL + """
SELECT model_id, 'keep' AS action, CAST(NULL AS INT) AS delete_order FROM keep
UNION ALL SELECT model_id, 'delete', CAST(delete_order AS INT) FROM del"""))
def q_retention(spark, sf):
    """Keep the 9 best distinct models; list the rest for deletion, blends first."""
    return lbo.retention(lb(spark, sf), 9, "auc_validation", False, _SUBSET)


@query("keep_anti_join", "2.3", sql=lsql(_RET_SQL + "\nSELECT model_id, model_category FROM d WHERE model_id NOT IN (SELECT model_id FROM keep)"))
def q_anti(spark, sf):
    """Models not among the kept ids (left anti join)."""
    r = lbo.retention(lb(spark, sf), 9, "auc_validation", False, _SUBSET)
    keep = r.where("action = 'keep'").select("model_id")
    return jn.exclude_ids(lb(spark, sf), keep, "model_id").select("model_id", "model_category")


@query("cross_board_top", "2.7", sql=lsql("""
SELECT model_id, board, auc_validation, board_rank FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY board ORDER BY auc_validation DESC NULLS LAST, model_id) AS board_rank
  FROM (SELECT *, CASE WHEN featurelist_name IN ('fl0', 'fl1') THEN 'a' ELSE 'b' END AS board FROM leaderboard) x) y
WHERE board_rank <= CASE board WHEN 'a' THEN 4 WHEN 'b' THEN 3 ELSE 0 END"""))
def q_cross_board(spark, sf):
    """Top 4 of board a plus top 3 of board b, one pass."""
    l = lb(spark, sf).withColumn("board", F.when(F.col("featurelist_name").isin("fl0", "fl1"), "a").otherwise("b"))
    return lbo.top_of_each(l, "board", {"a": 4, "b": 3}, "auc_validation", False) \
        .select("model_id", "board", "auc_validation", "board_rank")


_BOARDS_SQL = {
    "boards": "SELECT *, CASE WHEN featurelist_name IN ('fl0', 'fl1') THEN 'a' ELSE 'b' END AS board FROM leaderboard",
    "picked": "SELECT board, model_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY board ORDER BY auc_validation DESC NULLS LAST, model_id) "
              "AS r FROM boards) x WHERE r <= CASE board WHEN 'a' THEN 4 ELSE 3 END",
    "imp": "SELECT l_suppkey AS model_id, 'f' || CAST(l_partkey % 40 AS VARCHAR) AS featureName, SUM(l_quantity) AS u FROM lineitem GROUP BY ALL",
    "ranked": "SELECT *, ROW_NUMBER() OVER (PARTITION BY model_id ORDER BY u DESC, featureName) - 1 AS rank FROM imp",
    "scopes": "SELECT DISTINCT 'all' AS scope, model_id FROM picked UNION ALL SELECT 'board:' || board, model_id FROM picked",
    "chosen": "SELECT * FROM ranked JOIN scopes USING (model_id)",
    "cum": "SELECT scope, SUM(u) OVER (PARTITION BY scope ORDER BY u DESC, featureName ROWS UNBOUNDED PRECEDING) AS c "
           "FROM (SELECT scope, featureName, SUM(u) AS u FROM chosen GROUP BY ALL) t",
    "taken": "SELECT scope, GREATEST(1, COUNT(*) FILTER (WHERE c <= m * 0.99)) AS n FROM (SELECT *, MAX(c) OVER (PARTITION BY scope) AS m "
             "FROM cum) t GROUP BY scope",
    "place": "SELECT scope, featureName, COUNT(DISTINCT model_id) AS n_models, ROW_NUMBER() OVER (PARTITION BY scope "
             "ORDER BY quantile_cont(rank, 0.5), featureName) AS position FROM chosen GROUP BY scope, featureName",
}


@query("cross_board_ensemble", "2.7", sql=lsql(
    "SELECT scope, position, featureName, n_models FROM place JOIN taken USING (scope) WHERE position <= n", _BOARDS_SQL))
def q_cross_board_ensemble(spark, sf):
    """Impacts of the top 4 models of board a and the top 3 of board b, ensembled at ratio 0.99: both boards and each."""
    from churnkit.operators import impact as im
    from churnkit.sources import load
    boards = lb(spark, sf).withColumn("board", F.when(F.col("featurelist_name").isin("fl0", "fl1"), "a").otherwise("b"))
    impacts = (load(spark, sf, "lineitem", ["l_suppkey", "l_partkey", "l_quantity"])
               .groupBy(F.col("l_suppkey").alias("model_id"), F.concat(F.lit("f"), (F.col("l_partkey") % 40).cast("string")).alias("featureName"))
               .agg(F.sum("l_quantity").alias("impactUnnormalized")))
    return im.cross_board_select(boards, {"a": 4, "b": 3}, im.normalise_impacts(impacts), "auc_validation", False, 0.99)


_TOP3 = ("SELECT model_type FROM leaderboard WHERE model_category = 'model' AND NOT is_frozen "
         "ORDER BY auc_validation DESC NULLS LAST, model_id LIMIT 3")


@query("similar_name_join", "2.3", sql=lsql(f"""
SELECT model_id, model_type FROM leaderboard c WHERE EXISTS (
  SELECT 1 FROM (SELECT DISTINCT array_to_string(list_slice(list_filter(string_split_regex(trim(model_type), '\\s+'),
                  lambda w: w <> ''), 1, 2), ' ') AS phrase FROM ({_TOP3}) t) p WHERE contains(c.model_type, p.phrase))"""))
def q_similar(spark, sf):
    """Models whose type contains the first two words of a top-3 model's type."""
    l = lb(spark, sf)
    top = lbo.best_models(l, "auc_validation", False, n=3)
    return jn.similar_models(l, top).select("model_id", "model_type")


_TOP5 = ("SELECT model_id FROM leaderboard WHERE model_category = 'model' AND NOT is_frozen "
         "ORDER BY auc_validation DESC NULLS LAST, model_id LIMIT 5")


@query("model_combinations", "2.3", sql=lsql(f"""
WITH t AS ({_TOP5})
SELECT 2 AS size, [a.model_id, b.model_id] AS combo FROM t a JOIN t b ON b.model_id > a.model_id
UNION ALL
SELECT 3, [a.model_id, b.model_id, c.model_id] FROM t a JOIN t b ON b.model_id > a.model_id
  JOIN t c ON c.model_id > b.model_id"""))
def q_combos(spark, sf):
    """All combinations of size 2 and 3 of the five best models."""
    top = lbo.best_models(lb(spark, sf), "auc_validation", False, n=5)
    return jn.model_combinations(top, 3)


@query("set_equal_match", "2.3", sql=lsql(f"""
WITH t AS ({_TOP5}),
combos AS (SELECT [a.model_id, b.model_id] AS combo FROM t a JOIN t b ON b.model_id > a.model_id
           UNION ALL SELECT [a.model_id, b.model_id, c.model_id] FROM t a JOIN t b ON b.model_id > a.model_id
           JOIN t c ON c.model_id > b.model_id),
wanted AS (SELECT list_sort(list(model_id)) AS w FROM (SELECT model_id FROM leaderboard WHERE model_category = 'model'
           AND NOT is_frozen ORDER BY auc_validation DESC NULLS LAST, model_id LIMIT 2) x)
SELECT array_to_string(combo, '-') AS blend_id, combo AS members FROM combos, wanted WHERE list_sort(combo) = w"""))
def q_set_match(spark, sf):
    """The candidate blend whose member set equals the two best models."""
    l = lb(spark, sf)
    combos = jn.model_combinations(lbo.best_models(l, "auc_validation", False, n=5), 3)
    members = combos.select(F.array_join("combo", "-").alias("blend_id"), F.explode("combo").alias("member_id"))
    wanted = [r[0] for r in lbo.best_models(l, "auc_validation", False, n=2).select("model_id").collect()]
    return jn.match_members(members, members, wanted=wanted)


@query("by_id_semi_join", "2.3", sql=fixtures.with_views(
    "SELECT idsubscrip, observation_date, churned FROM intent_preds i WHERE idsubscrip IN "
    "(SELECT idsubscrip FROM rule_preds WHERE risk_label = 'High')", "intent_preds", "rule_preds"))
def q_semi(spark, sf):
    """Intent rows of subscribers the rule model ever put in the High bucket (left semi join)."""
    ids = fixtures.rule_preds(spark, sf).where("risk_label = 'High'").select("idsubscrip")
    return jn.filter_ids(fixtures.intent_preds(spark, sf), ids, "idsubscrip").select(
        "idsubscrip", "observation_date", "churned")

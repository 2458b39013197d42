"""The operators under the names of the survey's signature column.

Plain bindings to the implementations in ``operators``, ``sources``,
``functions`` and ``plans``; a few small adapters where the signature shape
differs.  Everything takes and returns DataFrames (or Columns).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.functions.durations import shift_date  # noqa: F401
from churnkit.functions import scalar as _sc
from churnkit.functions.scalar import days_between, keep_share, parse_dates, round_half_even, safe_div  # noqa: F401
from churnkit.operators import cluster as _cl, evaluate as _ev, impact as _im, joins as _jn
from churnkit.operators import leaderboard as _lb, metrics as _mt, ml as _ml, profile as _pf, sampling as _sm
from churnkit.operators import splits as _sp
from churnkit.operators.dedup import (  # noqa: F401
    collapse_duplicates as collapse, key_duplicate_report as key_duplicates, label_conflicts, mark_duplicates,
)
from churnkit.operators.drift import categorical_drift, numeric_drift  # noqa: F401
from churnkit.operators.prefix import prefix_sum, top_n_flag, top_n_per_group  # noqa: F401
from churnkit.sources.io import (  # noqa: F401
    load_csv, output_name, read_table, replace_table, select_features, union_all, write_csv, write_predictions,
)

# 2.2 projections and predicates: Column form, or DataFrame form adding a column


def flag_not_null(df_or_col, col: str | None = None, out: str | None = None):
    if isinstance(df_or_col, DataFrame):
        return df_or_col.withColumn(out or f"has_{col}", _sc.flag_not_null(col))
    return _sc.flag_not_null(df_or_col)


def binarise(df_or_col, col: str | None = None, cut: float = 1, out: str | None = None):
    if isinstance(df_or_col, DataFrame):
        return df_or_col.withColumn(out or col, _sc.binarise(col, cut))
    return _sc.binarise(df_or_col, cut if col is None else col)


def apply_threshold(df_or_p, p=None, t: float = 0.5, out: str = "label"):
    if isinstance(df_or_p, DataFrame):
        return df_or_p.withColumn(out, _sc.apply_threshold(p, t))
    return _sc.apply_threshold(df_or_p, p if p is not None else t)


rename = DataFrame.withColumnsRenamed
numeric_columns = _pf.numeric_columns
non_numeric_columns = _pf.non_numeric_columns
predictor_columns = _pf.predictor_columns
zero_redundant = _im.zero_redundant
drop_all_null = _cl.drop_all_null

# 2.3 joins
merge_predictions = _jn.merge_predictions
feature_inclusion = _jn.feature_inclusion
intersect_features = _jn.intersect_features
filter_ids = _jn.filter_ids
similar_models = _jn.similar_models
metric_direction = _lb.direction
combinations = _jn.model_combinations
match_members = _jn.match_members
retention = _lb.retention

# 2.4 aggregations
profile = _pf.feature_profile
shape = _pf.table_shape
info = _pf.table_info
describe = _pf.describe
alignment_describe = _pf.alignment_describe
histogram = _pf.histogram
scored_summary = _pf.scored_summary
class_balance = _pf.class_balance
weighted_balance = _pf.weighted_balance
merge_coverage = _pf.merge_coverage
impact_mean = _im.impact_mean
impact_sum = _im.impact_sum
median_rank = _im.median_rank
impact_pivot = _im.impact_pivot
impact_spread = _im.impact_spread


def value_counts(df: DataFrame, cols: Sequence[str], dropna: bool = True, by: str | None = None) -> DataFrame:
    """Counts and shares; with ``by``, shares within each ``by`` value."""
    if by:
        return _pf.grouped_value_shares(df, by, cols[0])
    return _pf.value_counts(df, cols, dropna)


def agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(_pf.agreement_rate(df, a, b).alias("agreement"))


# 2.5 windows and ranking
rank_impacts = _im.rank_impacts
cumulative = _im.cumulative
lead_feature = _cl.lead_features


def top_percent(df: DataFrame, score: str, pct: float, tiebreak: Sequence[str], by: Sequence[str] = (),
                out: str = "priority") -> DataFrame:
    return top_n_per_group(df, score, pct, tiebreak, by=by, out=out)


def minmax(df: DataFrame, c: str, lo: float = 0.2, hi: float = 1.2) -> DataFrame:
    return _cl.minmax_scale(df, c, lo, hi)


# 2.6 sorts and limits
top_k = _im.top_k
sort_leaderboard = _lb.sort_leaderboard
best_models = _lb.best_models


# 2.7 set operations
def except_features(a: DataFrame, b: DataFrame, col: str = "feature") -> DataFrame:
    return a.join(b.select(col), col, "left_anti")


def union_features(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


top_of_each = _lb.top_of_each

# 2.9 sampling and splits
target_rows = _sm.target_rows
downsample = _sm.downsample
split_holdout = _sm.split_holdout
split_random = _sm.split_random
split_group = _sm.split_group
backtest_splits = _sp.backtest_folds
assign_roles = _sp.assign_roles


def duration_grid(df: DataFrame, date: str, folds: DataFrame, months: Sequence[int]) -> DataFrame:
    return _sp.duration_slices(df, date, _sp.duration_windows(folds, months))


# 2.10 feature selection
fire_select = _im.fire_select
accumulate_select = _im.accumulate_select
reduced_lists = _im.reduced_lists
select_until_stable = _ml.select_until_stable
representatives = _cl.representatives
drop_redundant = _im.drop_redundant
drop_correlated = _cl.drop_correlated
selectable_models = _lb.selectable_models
permutation_importance = _ml.permutation_importance
linear_impact = _ml.linear_impact

# 2.11 correlation and clusters
corr_pairs = _cl.corr_pairs
symmetric = _cl.symmetric
distance = _cl.distance
dbscan = _cl.dbscan
threshold_clusters = _cl.threshold_clusters
target_corr = _cl.target_correlation
cluster_map = _cl.cluster_map
decollinearise = _cl.decollinearise
add_one_back = _ml.add_one_back

# 2.12 leaderboard
flatten_metrics = _lb.flatten_metrics
top_n_models = _lb.top_n_models

# 2.13 modelling and scoring
train_candidates = _ml.train_candidates
tune = _ml.tune_grid
score_backtests = _ml.backtest_score
blend = _ml.blend
stack = _ml.stack
batch_score = _ml.batch_score


def drift(base: DataFrame, new: DataFrame, cols: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """PSI per column: numeric columns on base deciles, categorical on categories."""
    out = numeric_drift(base, new, cols) if cols else None
    if categorical:
        cat = categorical_drift(base, new, categorical)
        out = cat if out is None else out.unionByName(cat)
    return out


# 2.14 evaluation and business impact
confusion = _ev.confusion_matrix
classification_report = _ev.classification_report
roc_auc = _mt.roc_auc
roc_points = _mt.roc_points
pr_points = _mt.pr_points
segment_metrics = _ev.segment_metrics
fp_rates = _ev.fp_rates
fp_shares = _ev.fp_shares
intent_rates = _ev.intent_rates
intent_performance = _ev.intent_performance
intent_segments = _ev.intent_segments
business_impact = _ev.business_impact
programs = _ev.programs_table
cost_benefit = _ev.cost_benefit
intervention_strategy = _ev.intervention_strategy
compare = _ev.model_comparison
days_to_churn = _ev.days_to_churn
weighted_binary_metrics = _mt.weighted_binary_metrics
regression_metrics = _mt.regression_metrics
curve_metrics = _mt.curve_metrics


def average_precision(df: DataFrame, y: str, p: str, by: Sequence[str] = (), w: str | None = None) -> DataFrame:
    return _mt.curve_metrics(df, y, p, by, w).select(*by, "average_precision")


def rate_at_top(df: DataFrame, y: str, p: str, pct: float, tiebreak: Sequence[str],
                by: Sequence[str] = ()) -> DataFrame:
    return _mt.rate_at_top(df, y, p, pct, tiebreak, by)


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("annotations", "Sequence", "DataFrame", "F")]

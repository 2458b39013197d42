"""Queries: downsampling, splits and time folds (§2.9, §2.2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnkit.functions.scalar import keep_share
from churnkit.operators import profile as pf, sampling as sm, splits as sp
from churnkit.plans.registry import query
from churnkit.sources import fixtures, load


def uhash_sql(key: str, seed) -> str:
    """DuckDB twin of ``unit_hash``."""
    return f"(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0)"


HOLDOUT = 0.1


def _downsampled(spark, sf):
    base = fixtures.downsample_base(spark, sf)
    target = base.count() // 4
    return sm.downsample(base, "target_column", target, HOLDOUT, "row_key", seed=0)


_DS_SQL = fixtures.with_views(f"""
WITH live AS (SELECT * FROM downsample_base WHERE {uhash_sql('row_key', 0)} >= {HOLDOUT}),
tot AS (SELECT (SELECT COUNT(*) // 4 FROM downsample_base) AS target,
          COUNT(*) FILTER (WHERE target_column > 0) AS p, COUNT(*) - COUNT(*) FILTER (WHERE target_column > 0) AS neg
        FROM live),
r AS (SELECT LEAST(1.0, GREATEST(CAST(target - p AS DOUBLE) / neg, 1.0 / GREATEST(neg, 1))) AS ratio FROM tot)
SELECT l.*, CASE WHEN COALESCE(l.target_column > 0, false) THEN 1.0 ELSE 1.0 / r.ratio END AS weight
FROM live l, r
WHERE COALESCE(l.target_column > 0, false) OR {uhash_sql('l.row_key', '0n')} < r.ratio""", "downsample_base")


@query("downsample_weighted", "2.9", sql=_DS_SQL, r6=["weight"])
def q_downsample(spark, sf):
    """All positives plus hash-sampled negatives (weight 1/r) outside a 10 % holdout, a quarter of the rows."""
    return _downsampled(spark, sf)


@query("union_all_classes", "2.7", r6=["weight"], sql=f"""
SELECT target_column > 0 AS positive, COUNT(*) AS n, SUM(weight) AS weight FROM ({_DS_SQL}) q GROUP BY 1""")
def q_union_classes(spark, sf):
    """Positives and sampled negatives stacked as two branches (UNION ALL form)."""
    base = fixtures.downsample_base(spark, sf)
    plan = sm.plan_downsample(base, "target_column", base.count() // 4, HOLDOUT, "row_key")
    ds = sm.downsample(base, "target_column", plan.target_rows, HOLDOUT, "row_key", plan=plan)
    pos = ds.where("target_column > 0")
    neg = ds.where("NOT (target_column > 0)")
    return pos.unionByName(neg).groupBy((F.col("target_column") > 0).alias("positive")) \
        .agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight"))


@query("weighted_balance", "2.4", r6=["weighted_positive_count", "weighted_total_count", "weighted_positive_ratio"],
       sql=f"""SELECT SUM(CASE WHEN target_column > 0 THEN weight ELSE 0.0 END) AS weighted_positive_count,
  SUM(weight) AS weighted_total_count,
  SUM(CASE WHEN target_column > 0 THEN weight ELSE 0.0 END) / SUM(weight) AS weighted_positive_ratio
FROM ({_DS_SQL}) d""")
def q_weighted_balance(spark, sf):
    """Weighted positives / weighted total after downsampling."""
    return pf.weighted_balance(_downsampled(spark, sf), "target_column", "weight")


@query("estimate_row_bytes", "2.9", r6=["bytes_per_row"], sql=fixtures.with_views(
    "SELECT bpr AS bytes_per_row, CAST(FLOOR(1e9 / bpr) AS BIGINT) AS target_rows FROM (SELECT AVG(strlen(CAST(to_json("
    "{'l_quantity': l_quantity, 'l_extendedprice': l_extendedprice, 'l_discount': l_discount, "
    "'target_column': target_column}) AS VARCHAR))) AS bpr FROM downsample_base) t", "downsample_base"))
def q_row_bytes(spark, sf):
    """Mean serialised bytes per row of a projection (whole table), and rows for 1 GB."""
    base = fixtures.downsample_base(spark, sf)
    cols = ["l_quantity", "l_extendedprice", "l_discount", "target_column"]
    s = sm.row_bytes(base, cols)
    return s.select("bytes_per_row", F.floor(F.lit(1e9) / F.col("bytes_per_row")).cast("bigint").alias("target_rows"))


@query("holdout_split", "2.9", sql=fixtures.with_views(
    f"SELECT row_key, target_column, {uhash_sql('row_key', 7)} < 0.1 AS is_holdout FROM downsample_base",
    "downsample_base"))
def q_holdout(spark, sf):
    """Repeatable 10 % holdout flag from a hash of the row key."""
    return sm.split_holdout(fixtures.downsample_base(spark, sf).select("row_key", "target_column"),
                            "row_key", 0.1, seed=7)


@query("random_row_filter", "2.8", sql=fixtures.with_views(
    f"SELECT row_key, l_quantity FROM downsample_base WHERE {uhash_sql('row_key', 3)} < 0.3", "downsample_base"))
def q_random_filter(spark, sf):
    """Rows kept by a repeatable 30 % hash filter."""
    b = fixtures.downsample_base(spark, sf)
    return b.where(keep_share("row_key", 0.3, seed=3)).select("row_key", "l_quantity")


@query("random_tvh_split", "2.9", sql=f"""
SELECT partition, COUNT(*) AS n FROM (
  SELECT CASE WHEN {uhash_sql('o_orderkey', 11)} < 0.1 THEN 'holdout'
              WHEN {uhash_sql('o_orderkey', 11)} < 0.1 + 0.2 THEN 'validation' ELSE 'train' END AS partition
  FROM orders) t GROUP BY partition""")
def q_tvh(spark, sf):
    """Train / validation (20 %) / holdout (10 %) by hash of the order key."""
    o = load(spark, sf, "orders", ["o_orderkey"])
    return sm.split_random(o, "o_orderkey", 0.2, 0.1, seed=11).groupBy("partition").agg(F.count(F.lit(1)).alias("n"))


@query("group_kfold", "2.9", sql="""
SELECT o_orderkey, o_custkey,
  CAST((('0x' || substr(md5('5:' || CAST(o_custkey AS VARCHAR)), 1, 8))::BIGINT) % 5 AS INT) AS fold FROM orders""")
def q_group_kfold(spark, sf):
    """Five folds keeping every order of a customer in one fold."""
    o = load(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    return sm.split_group(o, ["o_custkey"], 5, seed=5)


GAP, VAL, HOLD = "P0Y0M60DT0H0M0S", "P0Y2M0DT0H0M0S", "P0Y1M0DT0H0M0S"

_FOLDS_SQL = """
top AS (SELECT MAX(CAST(o_orderdate AS DATE)) + 1 AS "end" FROM orders),
f1 AS (SELECT CAST(r.range AS INT) AS fold, t."end", CAST(t."end" - INTERVAL 1 MONTH AS DATE) AS holdout_start
       FROM top t, range(3) r),
f2 AS (SELECT *, CAST(holdout_start - to_months(2 * fold) AS DATE) AS val_end FROM f1),
f3 AS (SELECT *, CAST(val_end - INTERVAL 2 MONTH AS DATE) AS val_start FROM f2),
folds AS (SELECT fold, CAST(val_start - INTERVAL 60 DAY AS DATE) AS train_end, val_start, val_end, holdout_start, "end"
          FROM f3)"""


def _folds(spark, sf):
    o = load(spark, sf, "orders", ["o_orderdate"])
    return o, sp.backtest_folds(o, "o_orderdate", 3, GAP, VAL, HOLD)


@query("backtest_splits", "2.9", sql=f"""WITH {_FOLDS_SQL}
SELECT f.fold, f.train_end, f.val_start, f.val_end, f.holdout_start, r.role, r.n FROM folds f JOIN (
  SELECT fold, role, COUNT(*) AS n FROM (
    SELECT f.fold, CASE WHEN d >= holdout_start THEN 'holdout'
                      WHEN d >= val_start AND d < val_end THEN 'validation'
                      WHEN d < train_end THEN 'train' WHEN d < val_start THEN 'gap' ELSE 'unused' END AS role
    FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) o, folds f) x GROUP BY fold, role) r ON r.fold = f.fold""")
def q_backtests(spark, sf):
    """Three backtests (60-day gap, 2-month validation, 1-month holdout): fold bounds and rows per role."""
    o, folds = _folds(spark, sf)
    roles = sp.assign_roles(o, "o_orderdate", folds)
    counts = roles.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("n"))
    return folds.join(counts, "fold").select("fold", "train_end", "val_start", "val_end", "holdout_start", "role", "n")


@query("training_duration_slice", "2.9", sql=f"""WITH {_FOLDS_SQL},
w AS (SELECT fold, train_end, m AS months, CAST(train_end - to_months(m) AS DATE) AS train_start
      FROM folds, (SELECT UNNEST([1, 2, 4]) AS m) g)
SELECT w.fold, w.months, w.train_start, w.train_end, COUNT(*) AS n
FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) o JOIN w ON o.d >= w.train_start AND o.d < w.train_end
GROUP BY 1, 2, 3, 4""")
def q_durations(spark, sf):
    """Rows in the last 1, 2 and 4 months before each fold's gap."""
    o, folds = _folds(spark, sf)
    win = sp.duration_windows(folds, [1, 2, 4])
    return (sp.duration_slices(o, "o_orderdate", win)
            .groupBy("fold", "months", "train_start", "train_end").agg(F.count(F.lit(1)).alias("n")))


@query("fold_role_masks", "2.13", sql=f"""WITH {_FOLDS_SQL},
w AS (SELECT fold, 0 AS months, 'train' AS role, DATE '0001-01-01' AS a, LEAST(train_end, holdout_start) AS b FROM folds
      UNION ALL SELECT fold, 0, 'validation', val_start, LEAST(val_end, holdout_start) FROM folds
      UNION ALL SELECT fold, m, 'duration', CAST(train_end - to_months(m) AS DATE), train_end FROM folds, (SELECT UNNEST([1, 2, 4]) AS m) g)
SELECT w.fold, w.months, w.role, COUNT(*) AS n FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) o
JOIN w ON o.d >= w.a AND o.d < w.b GROUP BY 1, 2, 3""")
def q_masks(spark, sf):
    """Rows of every fold role and training window, counted in one pass over rows that carry their roles as bits."""
    o, folds = _folds(spark, sf)
    rows, ids = sp.fold_masks(o, "o_orderdate", folds)
    rows, pairs = sp.duration_masks(rows, "o_orderdate", sp.duration_windows(folds, [1, 2, 4]))
    return sp.mask_counts(rows, {"train": ("train_mask", [(f, 0) for f in ids]), "validation": ("validation_mask", [(f, 0) for f in ids]),
                                 "duration": ("duration_mask", pairs)}, ["fold", "months"])


@query("weighted_auc_downsampled", "2.14", r6=["n_pos", "n_neg", "auc", "ks", "average_precision", "max_mcc"],
       sql=f"""
WITH d AS ({_DS_SQL}),
s AS (SELECT CAST(l_discount AS DOUBLE) AS score,
        SUM(CASE WHEN target_column >= 1 THEN weight ELSE 0.0 END) AS pos,
        SUM(CASE WHEN target_column >= 1 THEN 0.0 ELSE weight END) AS neg
      FROM d WHERE l_discount IS NOT NULL AND target_column IS NOT NULL GROUP BY 1),
st AS (SELECT score, pos, neg,
         SUM(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
         SUM(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
         SUM(pos) OVER () AS tot_pos, SUM(neg) OVER () AS tot_neg FROM s),
c AS (SELECT *, tot_pos - tp AS fn, tot_neg - fp AS tn FROM st),
c2 AS (SELECT *, sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) AS den FROM c)
SELECT MAX(tot_pos) AS n_pos, MAX(tot_neg) AS n_neg,
  SUM(neg * (tp - 0.5 * pos)) / (MAX(tot_pos) * MAX(tot_neg)) AS auc, MAX(tp / tot_pos - fp / tot_neg) AS ks,
  SUM(pos / tot_pos * (tp / (tp + fp))) AS average_precision,
  MAX(CASE WHEN den > 0 THEN (tp * tn - fp * fn) / den ELSE 0.0 END) AS max_mcc FROM c2""")
def q_weighted_auc(spark, sf):
    """Weighted curve metrics of the discount as a score on the downsampled table (weights 1/r undo the sampling)."""
    from churnkit.operators.metrics import curve_metrics
    return curve_metrics(_downsampled(spark, sf), "target_column", "l_discount", w="weight")


_JOB_SQL = fixtures.with_views(f"""
WITH bpr AS (SELECT AVG(strlen(CAST(to_json({{'l_quantity': l_quantity, 'l_extendedprice': l_extendedprice,
               'l_discount': l_discount, 'target_column': target_column}}) AS VARCHAR))) AS b FROM downsample_base),
tgt AS (SELECT CAST(FLOOR(1000000.0 / b) AS BIGINT) AS target FROM bpr),
live AS (SELECT * FROM downsample_base WHERE {uhash_sql('row_key', 0)} >= {HOLDOUT}),
tot AS (SELECT (SELECT target FROM tgt) AS target, COUNT(*) FILTER (WHERE target_column > 0) AS p,
          COUNT(*) - COUNT(*) FILTER (WHERE target_column > 0) AS neg, COUNT(*) AS n FROM live),
r AS (SELECT target, p, n, LEAST(1.0, GREATEST(CAST(target - p AS DOUBLE) / neg, 1.0 / GREATEST(neg, 1))) AS ratio FROM tot),
d AS (SELECT l.target_column, CASE WHEN COALESCE(l.target_column > 0, false) THEN 1.0 ELSE 1.0 / r.ratio END AS weight
      FROM live l, r WHERE COALESCE(l.target_column > 0, false) OR {uhash_sql('l.row_key', '0n')} < r.ratio)
SELECT CAST(r.p AS DOUBLE) / r.n AS original_positive_ratio, (SELECT COUNT(*) FROM d) AS rows_written,
  (SELECT SUM(CASE WHEN target_column > 0 THEN weight ELSE 0.0 END) / SUM(weight) FROM d) AS weighted_positive_ratio,
  r.target AS target_rows, r.ratio AS negative_ratio FROM r""", "downsample_base")


@query("downsample_job", "2.9", r6=["original_positive_ratio", "weighted_positive_ratio", "negative_ratio"],
       sql=_JOB_SQL)
def q_downsample_job(spark, sf):
    """The whole job for a 1 MB budget: size estimate, class totals, sample, table replace, balance check."""
    import uuid
    from churnkit.plans import downsample_job
    from churnkit.session import shared_path
    out = shared_path(spark, f"churnkit-out/downsampled-{uuid.uuid4().hex}")
    return downsample_job.run(fixtures.downsample_base(spark, sf), ["l_quantity", "l_extendedprice", "l_discount"],
                              "target_column", "row_key", 0.001, HOLDOUT, out)

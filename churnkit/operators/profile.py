"""Profiling, counts, shares, histograms and describe tables.

Exact quantiles (linear interpolation, as pandas ``describe`` and DuckDB
``quantile_cont``) are computed from a long ``(column, value, count)`` table
with distributed running counts (``prefix_sum``), never by holding all values
of a group in one buffer.  Profiles of many columns run as one unpivot and
one aggregation instead of one job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.functions.scalar import col_
from churnkit.operators.prefix import prefix_sum
from churnkit.operators.util import join_null_safe, materialize

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def non_numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, NUMERIC)]


def predictor_columns(df: DataFrame, target: str, date_col: str, drop: Sequence[str] = ()) -> list[str]:
    """Drop the target, the date column, listed columns, any column whose
    name contains the date column's name, and derived date parts."""
    parts = (" (Year)", " (Month)", " (Week)", " (Day of Month)", " (Day of Week)")
    return [c for c in df.columns
            if c not in {target, date_col, *drop} and date_col not in c and not any(p in c for p in parts)]


def _with_const(df: DataFrame, one: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame to every row (equi-join on a
    constant key; the one-row side is broadcast)."""
    return df.withColumn("_g", F.lit(0)).join(F.broadcast(one.withColumn("_g", F.lit(0))), "_g").drop("_g")


def to_long(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), name: str = "column",
            value: str = "value") -> DataFrame:
    """Unpivot ``cols`` (cast to double) into ``(by..., column, value)``."""
    base = df.select(*[col_(b) for b in by], *[col_(c).cast("double").alias(c) for c in cols])
    return base.unpivot(list(by), list(cols), name, value)


def quantiles_long(long: DataFrame, probs: Sequence[float], by: Sequence[str] = ("column",),
                   value: str = "value", names: Sequence[str] | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles of ``value`` per ``by`` group.

    Counts per distinct value, running counts per group, then for each
    probability the values at positions floor/ceil of ``(n - 1) * q``."""
    return quantiles_of(materialize(value_table(long, by, value)), probs, by, value, names)


def value_table(long: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """``(by..., value, _c)``: counts of the distinct values that are neither null nor NaN."""
    return (long.where(F.col(value).isNotNull() & ~F.isnan(F.col(value)))
            .groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c")))


def quantiles_of(counts: DataFrame, probs: Sequence[float], by: Sequence[str], value: str = "value",
                 names: Sequence[str] | None = None) -> DataFrame:
    """``quantiles_long`` from a written table of counts."""
    by = list(by)
    names = list(names) if names else [f"q{int(round(q * 100))}" for q in probs]
    pre = prefix_sum(counts, value, ["_c"], by=by, totals=True, checkpoint=False)
    lo_excl = F.col("cum__c") - F.col("_c")
    aggs = []
    for q, nm in zip(probs, names):
        h = (F.col("tot__c") - 1) * F.lit(float(q))
        lo, hi = F.floor(h), F.ceil(h)
        v_lo = F.max(F.when((lo_excl <= lo) & (lo < F.col("cum__c")), F.col(value)))
        v_hi = F.max(F.when((lo_excl <= hi) & (hi < F.col("cum__c")), F.col(value)))
        frac = F.max(h - lo)
        aggs.append((v_lo + frac * (v_hi - v_lo)).alias(nm))
    return pre.groupBy(*by).agg(*aggs)


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (interpolated), max for each
    column, one row per (by..., column)."""
    by = list(by)
    long = to_long(df, cols, by)
    v, c = F.col("value"), F.col("_c")
    # the rows are read once: all that follows works on counts of distinct values
    counts = materialize(value_table(long, [*by, "column"]))
    mean = counts.groupBy(*by, "column").agg(
        F.sum("_c").alias("count"), (F.sum(v * c) / F.sum("_c")).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"))
    square = join_null_safe(counts, mean.select(*by, "column", F.col("mean").alias("_mean")), [*by, "column"]) \
        .groupBy(*by, "column").agg(F.sum(c * (v - F.col("_mean")) * (v - F.col("_mean"))).alias("_ss"))
    stats = join_null_safe(mean, square, [*by, "column"]).withColumn(
        "std", F.sqrt(F.try_divide(F.col("_ss"), F.col("count") - 1)))
    qs = quantiles_of(counts, [0.25, 0.5, 0.75], [*by, "column"], names=["p25", "p50", "p75"])
    return join_null_safe(stats, qs, [*by, "column"], "left").select(
        *by, "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def feature_profile(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True,
                    rsd: float = 0.01, accuracy: int = 10000) -> DataFrame:
    """Per column: type, distinct non-null values, missing count, mean and
    median (numeric only).  One unpivot; distinct values come from the same
    grouped ``(column, value)`` table that feeds the median.

    ``exact=False`` is the sketch mode for very wide or very large tables:
    one pass in which each task keeps per-column HyperLogLog and quantile
    sketches (``approx_count_distinct`` with relative error ``rsd``,
    ``percentile_approx`` with ``accuracy``); only sketches are shuffled,
    not the distinct values."""
    cols = list(cols or df.columns)
    if not exact:
        return _profile_sketch(df, cols, rsd, accuracy)
    types = dict(df.dtypes)
    num = [c for c in cols if isinstance(df.schema[c].dataType, NUMERIC)]
    oth = [c for c in cols if c not in num]
    total = df.agg(F.count(F.lit(1)).alias("rows"))
    parts = []
    if num:
        long = to_long(df, num)
        # distinct values count by their own digits: a double has no room for those of 64-bit ids; NaN is missing
        exact_long = df.select(*[F.when(~F.isnan(col_(c).cast("double")), col_(c)).cast("string").alias(c) for c in num]) \
            .unpivot([], num, "column", "value").where(F.col("value").isNotNull())
        grouped = exact_long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_c"))
        number = F.col("value").cast("double")
        agg = grouped.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"), F.sum("_c").alias("n_present"),
                                            (F.sum(number * F.col("_c")) / F.sum("_c")).alias("mean"))
        med = quantiles_long(long, [0.5], names=["median"])
        parts.append(agg.join(med, "column", "left"))
    if oth:
        slong = df.select(*[col_(c).cast("string").alias(c) for c in oth]).unpivot([], oth, "column", "value")
        grouped = slong.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("_c"))
        agg = grouped.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"), F.sum("_c").alias("n_present"),
                                            F.lit(None).cast("double").alias("mean"),
                                            F.lit(None).cast("double").alias("median"))
        parts.append(agg)
    res = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    type_rows = df.sparkSession.createDataFrame([(c, types[c]) for c in cols], "column string, dtype string")
    res = type_rows.join(res, "column", "left")
    res = _with_const(res, total)
    return res.select("column", "dtype", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
                      (F.col("rows") - F.coalesce("n_present", F.lit(0))).alias("n_missing"), "mean", "median")


def _profile_sketch(df: DataFrame, cols: list[str], rsd: float, accuracy: int) -> DataFrame:
    types = dict(df.dtypes)
    num = [c for c in cols if isinstance(df.schema[c].dataType, NUMERIC)]
    oth = [c for c in cols if c not in num]
    parts = []
    if num:
        long = to_long(df, num)
        v = F.col("value")
        parts.append(long.groupBy("column").agg(
            F.approx_count_distinct(v, rsd).alias("n_distinct"), F.count(F.lit(1)).alias("_rows"),
            F.count(v).alias("_present"), F.avg(v).alias("mean"),
            F.percentile_approx(v, 0.5, accuracy).cast("double").alias("median")))
    if oth:
        slong = df.select(*[col_(c).cast("string").alias(c) for c in oth]).unpivot([], oth, "column", "value")
        v = F.col("value")
        parts.append(slong.groupBy("column").agg(
            F.approx_count_distinct(v, rsd).alias("n_distinct"), F.count(F.lit(1)).alias("_rows"),
            F.count(v).alias("_present"), F.lit(None).cast("double").alias("mean"),
            F.lit(None).cast("double").alias("median")))
    res = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    type_rows = df.sparkSession.createDataFrame([(c, types[c]) for c in cols], "column string, dtype string")
    return type_rows.join(res, "column").select(
        "column", "dtype", "n_distinct", (F.col("_rows") - F.col("_present")).alias("n_missing"), "mean", "median")


def table_shape(df: DataFrame, id_col: str) -> DataFrame:
    """Rows, columns and distinct ids (exact; distinct ids by a grouped count)."""
    ids = df.groupBy(col_(id_col)).agg(F.count(F.lit(1)).alias("_n"))
    return ids.agg(F.sum("_n").alias("n_rows"), F.count(F.col(id_col)).alias("n_ids")) \
        .select("n_rows", F.lit(len(df.columns)).alias("n_cols"), "n_ids")


def table_info(df: DataFrame) -> DataFrame:
    """Non-null count and type per column (one aggregation)."""
    counts = df.agg(*[F.count(col_(c)).alias(c) for c in df.columns])
    long = counts.select(*[F.col(f"`{c}`").cast("bigint").alias(c) for c in df.columns]) \
        .unpivot([], df.columns, "column", "non_null")
    types = df.sparkSession.createDataFrame(df.dtypes, "column string, dtype string")
    return types.join(long, "column")


def value_counts(df: DataFrame, cols: Sequence[str], dropna: bool = True) -> DataFrame:
    """Counts per value combination, with the share of all counted rows."""
    base = df
    if dropna:
        for c in cols:
            base = base.where(col_(c).isNotNull())
    counts = base.groupBy(*[col_(c) for c in cols]).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("_total"))
    return _with_const(counts, total).select(*cols, "count", (F.col("count") / F.col("_total")).alias("share"))


def grouped_value_shares(df: DataFrame, by: str, col: str) -> DataFrame:
    """Within each ``by`` value: counts and shares of ``col`` values."""
    base = df.where(col_(col).isNotNull() & col_(by).isNotNull())
    counts = base.groupBy(col_(by), col_(col)).agg(F.count(F.lit(1)).alias("count"))
    tot = counts.groupBy(by).agg(F.sum("count").alias("_t"))
    return counts.join(tot, by).select(by, col, "count", (F.col("count") / F.col("_t")).alias("share"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins between min and max (last bin closed), all bins
    listed even when empty; no rows without a value.  The rows are read once, for counts of distinct
    values; edges and bins follow from these."""
    counts = materialize(value_table(df.select(col_(col).cast("double").alias("value")), []))
    ends = counts.agg(F.min("value").alias("_mn"), F.max("value").alias("_mx")).where("_mn IS NOT NULL")
    width = F.when(F.col("_mx") > F.col("_mn"), (F.col("_mx") - F.col("_mn")) / bins).otherwise(F.lit(1.0))
    span = F.when(F.col("_mx") > F.col("_mn"), F.col("_mx") - F.col("_mn")).otherwise(F.lit(1.0))
    place = F.least(F.floor((F.col("value") - F.col("_mn")) / span * F.lit(bins)).cast("int"), F.lit(bins - 1))
    held = _with_const(counts, ends).groupBy(place.alias("bin")).agg(F.sum("_c").alias("count"))
    grid = _with_const(df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")), ends)
    edges = grid.select("bin", (F.col("_mn") + F.col("bin") * width).alias("lo"),
                        (F.col("_mn") + (F.col("bin") + 1) * width).alias("hi"))
    return edges.join(held, "bin", "left").select("bin", "lo", "hi", F.coalesce("count", F.lit(0)).alias("count"))


def class_balance(df: DataFrame, y: str) -> DataFrame:
    """Positives (y > 0), total and negatives in one aggregation."""
    return df.agg(F.count(F.when(col_(y) > 0, 1)).alias("positive_count"),
                  F.count(F.lit(1)).alias("total_count")) \
        .withColumn("negative_count", F.col("total_count") - F.col("positive_count"))


def weighted_balance(df: DataFrame, y: str, w: str) -> DataFrame:
    return df.agg(F.sum(F.when(col_(y) > 0, col_(w)).otherwise(0.0)).alias("weighted_positive_count"),
                  F.sum(col_(w)).alias("weighted_total_count")) \
        .withColumn("weighted_positive_ratio", F.col("weighted_positive_count") / F.col("weighted_total_count"))


def merge_coverage(df: DataFrame, left_flag: str, right_flag: str) -> DataFrame:
    """Total, left-only, right-only and both, from non-null marker columns."""
    l, r = col_(left_flag).isNotNull(), col_(right_flag).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("total"), F.count(F.when(r.eqNullSafe(False), 1)).alias("left_only"),
                  F.count(F.when(l.eqNullSafe(False), 1)).alias("right_only"),
                  F.count(F.when(l & r, 1)).alias("both"))


def agreement_rate(df: DataFrame, a: str, b: str) -> Column:
    """Share of rows with both present whose values are equal."""
    both = col_(a).isNotNull() & col_(b).isNotNull()
    return F.avg(F.when(both, (col_(a) == col_(b)).cast("double")))


def scored_summary(df: DataFrame, p: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(col_(p).cast("double")).alias("avg_prediction"))


def alignment_describe(df: DataFrame, a: str, b: str, value: str) -> DataFrame:
    """describe of ``value`` for rows where ``a`` and ``b`` (both present)
    disagree, agree, and over all rows."""
    present = col_(a).isNotNull() & col_(b).isNotNull() & col_(value).isNotNull()
    tagged = df.where(present).withColumn("alignment", F.when(col_(a) == col_(b), "aligned").otherwise("misaligned"))
    overall = df.withColumn("alignment", F.lit("overall"))
    both = tagged.select("alignment", value).unionByName(overall.select("alignment", value))
    return describe(both, [value], by=["alignment"])

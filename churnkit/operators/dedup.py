"""Duplicate keys: reports, collapsing, and full-row duplicate marking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.functions.scalar import col_
from churnkit.operators.util import join_null_safe


def key_duplicate_report(df: DataFrame, keys: Sequence[str], vals: Sequence[str],
                         min_size: int = 2) -> DataFrame:
    """Per key: size and mean/min/max/sample-std of each value; keys seen at
    least ``min_size`` times (``HAVING``).  Partial aggregation happens
    before the shuffle, so a key holding a third of the rows costs no more
    than any other."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for v in vals:
        c = col_(v).cast("double")
        aggs += [F.avg(c).alias(f"{v}_mean"), F.min(c).alias(f"{v}_min"),
                 F.max(c).alias(f"{v}_max"), F.stddev_samp(c).alias(f"{v}_std")]
    return df.groupBy(*keys).agg(*aggs).where(F.col("n") >= min_size)


def label_conflicts(df: DataFrame, keys: Sequence[str], label: str, score: str) -> DataFrame:
    """Duplicate keys whose label varies (sample std > 0)."""
    rep = key_duplicate_report(df, keys, [score, label])
    return rep.where(F.col(f"{label}_std") > 0)


def stable_mean(c, digits: int = 12):
    """Mean rounded to ``digits`` decimals.  A double sum depends in its last
    bits on the order in which partitions are combined; rounding far above
    that noise makes equal means equal doubles on every run (and in any
    engine), so ties in later rankings stay ties."""
    return F.round(F.avg(col_(c)), digits)


def collapse_duplicates(df: DataFrame, keys: Sequence[str], vals: Sequence[str],
                        digits: int | None = None) -> DataFrame:
    """One row per key set with values averaged; null keys form their own
    group (``groupby(dropna=False)``).  ``digits`` rounds the means (see
    ``stable_mean``) so that they are reproducible."""
    aggs = [(stable_mean(v, digits) if digits is not None else F.avg(col_(v))).alias(v) for v in vals]
    return df.groupBy(*[col_(k) for k in keys]).agg(*aggs)


def mark_duplicates(df: DataFrame, subset: Sequence[str], order: Sequence[str],
                    out: str = "duplicate") -> DataFrame:
    """``duplicated(keep='first')`` after sorting by ``order``: a row is a
    duplicate when an earlier row has equal values (null equals null) on
    every ``subset`` column.  ``order`` must identify rows uniquely.

    The first row of each group is found by a partial aggregation (min of
    the order struct), then joined back null-safely: a group holding a third
    of all rows is reduced map-side and its join is split by AQE, instead of
    one task sorting the whole group in a window."""
    key = F.struct(*[col_(c).alias(f"_o{i}") for i, c in enumerate(order)])
    tagged = df.withColumn("_ord", key)
    first = tagged.groupBy(*[col_(c) for c in subset]).agg(F.min("_ord").alias("_first"))
    j = join_null_safe(tagged, first, list(subset))
    return j.withColumn(out, F.col("_ord") != F.col("_first")).drop("_ord", "_first")


def duplicate_subset(columns: Sequence[str], ignore: Sequence[str] = ("n_features",),
                     id_col: str = "model_id") -> list[str]:
    """Columns that define a duplicate model: everything but the id, the
    ignored columns and list-valued ``*Scores`` columns."""
    return [c for c in columns if c != id_col and c not in ignore and not c.endswith("Scores")]

"""Class-weighted downsampling and repeatable splits.

Random draws are a hash of the row key (``unit_hash``), never ``rand()``:
the same rows are chosen on every run, on every executor, and when a lost
task is recomputed, so a holdout never leaks into training.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.functions.scalar import col_, unit_hash


def row_bytes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``bytes_per_row``: mean serialised (JSON) length of a row over
    ``cols``, over all rows; one column-pruned scan."""
    return df.agg(F.avg(F.octet_length(F.to_json(F.struct(*[col_(c) for c in cols])))).alias("bytes_per_row"))


def estimate_row_bytes(df: DataFrame, cols: Sequence[str]) -> float:
    """``row_bytes`` as a number; 0 for an empty table."""
    return float(row_bytes(df, cols).first()[0] or 0.0)


def target_rows(df: DataFrame, cols: Sequence[str], target_gb: float) -> int:
    """Rows that fit ``target_gb`` at the mean bytes per row."""
    bpr = estimate_row_bytes(df, cols)
    return int(target_gb * 1e9 / bpr) if bpr > 0 else 0


def split_holdout(df: DataFrame, key: str, pct: float, seed: int = 0, out: str = "is_holdout",
                  method: str = "md5") -> DataFrame:
    return df.withColumn(out, unit_hash(key, seed, method) < F.lit(float(pct)))


def split_random(df: DataFrame, key: str, validation: float, holdout: float, seed: int = 0,
                 out: str = "partition") -> DataFrame:
    """Train / validation / holdout by hash buckets of the key."""
    u = unit_hash(key, seed)
    return df.withColumn(out, F.when(u < F.lit(float(holdout)), "holdout")
                         .when(u < F.lit(float(holdout + validation)), "validation").otherwise("train"))


def group_fold(cols: Sequence[str], k: int, seed: int = 0) -> Column:
    """Fold number 0..k-1 from a hash of the group key: every row of a group
    lands in the same fold."""
    key = F.concat_ws("\u0001", *[col_(c).cast("string") for c in cols])
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(int(k))).cast("int")


def split_group(df: DataFrame, group_cols: Sequence[str], k: int = 5, seed: int = 0, out: str = "fold") -> DataFrame:
    return df.withColumn(out, group_fold(group_cols, k, seed))


@dataclass(frozen=True)
class DownsamplePlan:
    positive_count: int
    negative_count: int
    target_rows: int
    negative_ratio: float

    @property
    def negative_weight(self) -> float:
        return 1.0 / self.negative_ratio


def plan_downsample(df: DataFrame, y: str, target: int, holdout_pct: float, key: str,
                    seed: int = 0) -> DownsamplePlan:
    """Class totals outside the holdout (one aggregation; two numbers reach
    the driver) and the negative keep ratio, clamped to (0, 1]."""
    pos = col_(y) > 0
    live = df.where(unit_hash(key, seed) >= F.lit(float(holdout_pct)))
    r = live.agg(F.count(F.when(pos, 1)).alias("p"), F.count(F.lit(1)).alias("t")).first()
    p, t = int(r["p"]), int(r["t"])
    neg = t - p
    ratio = (target - p) / neg if neg > 0 else 1.0
    ratio = min(1.0, max(ratio, 1.0 / max(neg, 1)))
    return DownsamplePlan(p, neg, int(target), float(ratio))


def downsample(df: DataFrame, y: str, target: int, holdout_pct: float, key: str, seed: int = 0,
               weight: str = "weight", plan: DownsamplePlan | None = None) -> DataFrame:
    """All positives (weight 1) plus negatives kept with probability r
    (weight 1/r), outside a repeatable holdout.  Both classes lose the same
    holdout share, so the weighted positive ratio equals the original."""
    plan = plan or plan_downsample(df, y, target, holdout_pct, key, seed)
    pos = F.coalesce(col_(y) > 0, F.lit(False))
    live = unit_hash(key, seed) >= F.lit(float(holdout_pct))
    keep_neg = unit_hash(key, f"{seed}n") < F.lit(plan.negative_ratio)
    return (df.where(live & (pos | keep_neg))
            .withColumn(weight, F.when(pos, F.lit(1.0)).otherwise(F.lit(plan.negative_weight))))

"""The downsampling job end to end.

1. bytes per row over the chosen columns, target rows for the size budget;
2. class totals outside the holdout (one aggregation, two numbers to the driver);
3. one lazy plan: scan, hash filter, weight column;
4. replace the output table (a folder in the shared space or a catalog table);
5. verify: rows written and the weighted positive ratio against the original.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.functions.scalar import col_, unit_hash
from churnkit.operators import sampling as sm
from churnkit.sources.io import read_table, replace_table


def run(df: DataFrame, features: Sequence[str], target: str, key: str, target_gb: float, holdout_pct: float,
        output: str, seed: int = 0) -> DataFrame:
    """Run the job; returns a one-row verification frame."""
    cols = [*features, target]
    target_rows = sm.target_rows(df, cols, target_gb)
    plan = sm.plan_downsample(df, target, target_rows, holdout_pct, key, seed)
    out = sm.downsample(df.select(key, *cols), target, target_rows, holdout_pct, key, seed, plan=plan)
    replace_table(out, output)
    written = read_table(df.sparkSession, output)
    live = df.where(unit_hash(key, seed) >= F.lit(float(holdout_pct)))
    orig = live.agg((F.count(F.when(col_(target) > 0, 1)) / F.count(F.lit(1))).alias("original_positive_ratio"))
    ver = written.agg(F.count(F.lit(1)).alias("rows_written"),
                      (F.sum(F.when(col_(target) > 0, F.col("weight")).otherwise(0.0)) / F.sum("weight"))
                      .alias("weighted_positive_ratio"))
    return (orig.withColumn("_g", F.lit(0)).join(ver.withColumn("_g", F.lit(0)), "_g").drop("_g")
            .withColumn("target_rows", F.lit(int(target_rows)).cast("bigint"))
            .withColumn("negative_ratio", F.lit(float(plan.negative_ratio))))

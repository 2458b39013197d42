"""Population stability (drift) between a base table and a new table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.functions.scalar import col_
from churnkit.operators.profile import quantiles_of, to_long, value_table
from churnkit.operators.util import materialize

EPS = 1e-6


def numeric_drift(base: DataFrame, new: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Per column: decile bins from the base (exact interpolated quantiles,
    equal edges merged), share of base and new rows per bin, and
    PSI = sum((p - q) * ln(p / q)) with empty bins floored at 1e-6.

    Base and new are read once each, for counts of distinct values per column;
    edges (a few numbers per column reach the driver) and shares follow from
    these tables."""
    cols = list(cols)
    probs = [i / bins for i in range(1, bins)]
    counts = materialize(value_table(to_long(base, cols), ["column"]))
    qs = quantiles_of(counts, probs, ["column"], names=[f"e{i}" for i in range(1, bins)]).collect()
    edges = {r["column"]: sorted({float(r[f"e{i}"]) for i in range(1, bins) if r[f"e{i}"] is not None})
             for r in qs}
    present = [c for c in cols if c in edges]

    def bin_of():
        which = F.lit(None).cast("int")
        for c in present:
            n = F.lit(0)
            for e in edges[c]:
                n = n + (F.col("value") >= F.lit(e)).cast("int")
            which = F.when(F.col("column") == c, n).otherwise(which)
        return which

    def shares(values: DataFrame, tag: str) -> DataFrame:
        g = values.select("column", bin_of().alias("bin"), "_c").where("bin IS NOT NULL") \
            .groupBy("column", "bin").agg(F.sum("_c").alias("n"))
        t = g.groupBy("column").agg(F.sum("n").alias("t"))
        return g.join(t, "column").select("column", "bin", (F.col("n") / F.col("t")).alias(tag))

    spark = base.sparkSession
    grid = spark.createDataFrame([(c, b) for c in present for b in range(len(edges[c]) + 1)],
                                 "column string, bin int")
    j = (grid.join(shares(counts, "p"), ["column", "bin"], "left")
         .join(shares(value_table(to_long(new, cols), ["column"]), "q"), ["column", "bin"], "left")
         .select("column", "bin", F.coalesce("p", F.lit(0.0)).alias("p"), F.coalesce("q", F.lit(0.0)).alias("q")))
    return _psi(j)


def categorical_drift(base: DataFrame, new: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: share of each category in base and new, PSI per column."""
    def shares(df, tag):
        long = df.select(*[col_(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "bin")
        g = long.where("bin IS NOT NULL").groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))
        t = g.groupBy("column").agg(F.sum("n").alias("t"))
        return g.join(t, "column").select("column", "bin", (F.col("n") / F.col("t")).alias(tag))
    j = shares(base, "p").join(shares(new, "q"), ["column", "bin"], "full_outer") \
        .select("column", "bin", F.coalesce("p", F.lit(0.0)).alias("p"), F.coalesce("q", F.lit(0.0)).alias("q"))
    return _psi(j)


def _psi(j: DataFrame) -> DataFrame:
    p = F.greatest(F.col("p"), F.lit(EPS))
    q = F.greatest(F.col("q"), F.lit(EPS))
    return j.groupBy("column").agg(F.sum((q - p) * F.log(q / p)).alias("psi"),
                                   F.count(F.lit(1)).alias("n_bins"))

"""Global running sums and exact top-N without one task holding all rows.

An un-partitioned ``Window.orderBy`` moves every row into one task.  Here, at
every size, Spark range-partitions the rows on the whole order key (groups
first, then all order columns, nulls included), each range is summed, the
running offset is computed over the small range table, and the exact running
sum is a window *within* a range plus its offset.  The order columns may have
any orderable type.  Since the whole key cuts the ranges, a first column that
repeats is split by the next ones.

``top_n_flag`` builds on it: it finds the boundary value where the running
count crosses N, then orders only the rows tied at that value by a tiebreak
id, again range by range, so a value shared by a third of all rows is still
split over many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnkit.operators.util import join_null_safe, materialize, run_all

_RANGE = "_pfx_range"


def prefix_sum(df: DataFrame, order: str | Sequence[str], values: Sequence[str],
               by: Sequence[str] = (), descending: bool = False, inclusive: bool = True,
               ranges: int | None = None, prefix: str = "cum_",
               totals: bool = False, checkpoint: bool = True) -> DataFrame:
    """Add ``cum_<v>``: the sum of ``v`` over rows at or before this row in
    ``order``, within each ``by`` group; nulls come first (last when
    descending).

    Rows that tie on every order column must not exist (pre-aggregate first,
    or add a tiebreak column to ``order``), otherwise the split between tied
    rows is arbitrary.  ``inclusive=False`` excludes the row itself;
    ``totals=True`` also adds ``tot_<v>``, the sum over the whole group.

    The input (normally a pre-aggregated table, much smaller than the rows)
    is written once because range partitioning reads it twice (``checkpoint=
    False`` if it is cheap to compute), and once more with its ranges, so
    that sums and rows agree on them.  ``ranges`` defaults to the session's
    shuffle partitions.
    """
    order = [order] if isinstance(order, str) else list(order)
    by = list(by)
    base = materialize(df) if checkpoint else df
    ords = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    key = [*[F.col(c) for c in by], *ords]
    dealt = base.repartitionByRange(ranges, *key) if ranges else base.repartitionByRange(*key)
    b = materialize(dealt.withColumn(_RANGE, F.spark_partition_id()))
    tot = b.groupBy(*by, _RANGE).agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    w_off = Window.partitionBy(*by).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*by)
    off = tot.select(*by, _RANGE, *[F.coalesce(F.sum(f"_t_{v}").over(w_off), F.lit(0))
                                    .alias(f"_o_{v}") for v in values],
                     *[F.sum(f"_t_{v}").over(w_all).alias(f"tot_{v}") for v in (values if totals else [])])
    # Without `by` the offset table has one row for each range: broadcast is
    # safe.  With `by` its size grows with the groups; AQE picks at runtime.
    j = b.join(F.broadcast(off), _RANGE) if not by else join_null_safe(b, off, [*by, _RANGE])
    w_in = Window.partitionBy(*by, _RANGE).orderBy(*ords).rowsBetween(Window.unboundedPreceding, 0)
    for v in values:
        run = F.sum(v).over(w_in) + F.col(f"_o_{v}")
        if not inclusive:
            run = run - F.col(v)
        j = j.withColumn(f"{prefix}{v}", run)
    return j.drop(_RANGE, *[f"_o_{v}" for v in values])


def positions(df: DataFrame, ords: Sequence[Column], out: str = "position") -> DataFrame:
    """Number all rows from 1 in the order of ``ords`` (sort expressions that
    leave no ties): row numbers within Spark's ranges plus the rows of the
    ranges before, so no task sees all rows."""
    b = materialize(df.repartitionByRange(*ords).withColumn(_RANGE, F.spark_partition_id()))
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    off = b.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("_n")).select(
        _RANGE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    within = F.row_number().over(Window.partitionBy(_RANGE).orderBy(*ords))
    # one row for each range: broadcast is safe
    return b.join(F.broadcast(off), _RANGE).withColumn(out, (within + F.col("_o")).cast("bigint")).drop(_RANGE, "_o")


def top_n_flag(df: DataFrame, score: str, n: int | DataFrame, tiebreak: Sequence[str],
               by: Sequence[str] = (), descending: bool = True, out: str = "priority",
               materialized: bool = False) -> DataFrame:
    """Flag the first ``n`` rows ordered by ``score`` (descending by default)
    then ``tiebreak`` ascending; null scores are never flagged.

    ``n`` is an int, or a DataFrame ``(by..., n)`` (one row without ``by``).
    Matches ``rank(method='first') <= n`` when the tiebreak is the input
    order.  The tiebreak columns must identify rows uniquely; they may be of
    any orderable type and hold nulls, which come first.
    """
    by = list(by)
    tiebreak = list(tiebreak)
    if not materialized:
        df = materialize(df)  # read by four passes below; run its plan once
    rows = df.where(F.col(score).isNotNull())
    nulls = df.where(F.col(score).isNull()).withColumn(out, F.lit(False))
    cnt = rows.groupBy(*by, score).agg(F.count(F.lit(1)).alias("_n"))
    # the input rows are written above, so the count table is cheap to
    # recompute and is not written again
    pre = prefix_sum(cnt, score, ["_n"], by=by, descending=descending, inclusive=False, totals=True,
                     checkpoint=False)
    if isinstance(n, DataFrame) and by:
        pre = join_null_safe(pre, n.withColumnRenamed("n", "_target"), by)
    elif isinstance(n, DataFrame):  # one-row frame holding n
        pre = (pre.withColumn("_g", F.lit(0))
               .join(F.broadcast(n.withColumnRenamed("n", "_target").withColumn("_g", F.lit(0))), "_g").drop("_g"))
    else:
        pre = pre.withColumn("_target", F.lit(int(n)))
    target = F.least(F.col("_target"), F.col("tot__n"))
    bound = (pre
             .where((F.col("cum__n") < target) & (F.col("cum__n") + F.col("_n") >= target))
             .select(*by, F.col(score).alias("_bscore"), (target - F.col("cum__n")).alias("_k")))
    if by:
        tagged = join_null_safe(rows, bound, by, "left")
    else:  # at most one boundary row: broadcast it, keyed on a constant
        tagged = (rows.withColumn("_g", F.lit(0))
                  .join(F.broadcast(bound.withColumn("_g", F.lit(0))), "_g", "left").drop("_g"))
    better = (F.col(score) > F.col("_bscore")) if descending else (F.col(score) < F.col("_bscore"))
    clear = tagged.where(F.col("_bscore").isNull() | (F.col(score) != F.col("_bscore"))) \
        .withColumn(out, F.coalesce(better, F.lit(False)))
    ties = tagged.where(F.col(score) == F.col("_bscore")).withColumn("_one", F.lit(1))
    ranked = prefix_sum(ties, tiebreak, ["_one"], by=by, descending=False, checkpoint=True)
    ties_flag = ranked.withColumn(out, F.col("cum__one") <= F.col("_k")).drop("_one", "cum__one")
    cols = [*df.columns, out]
    return (clear.select(*cols).unionByName(ties_flag.select(*cols))
            .unionByName(nulls.select(*cols)))


def top_n_per_group(df: DataFrame, score: str, pct: float, tiebreak: Sequence[str],
                    by: Sequence[str] = (), out: str = "priority", materialized: bool = False) -> DataFrame:
    """``top_n_flag`` with ``n = int(rows * pct / 100)`` per group (all rows,
    null scores included in the count, as the pandas rule does).
    ``materialized=True``: ``df`` already reads a written table."""
    if not materialized:
        df = materialize(df)
    ns = df.groupBy(*by).agg(F.floor(F.count(F.lit(1)).cast("double") * F.lit(float(pct)) / 100)
                             .cast("bigint").alias("n"))
    return top_n_flag(df, score, ns, tiebreak, by=by, out=out, materialized=True)


def top_n_flags(df: DataFrame, picks: dict[str, str], n: int, tiebreak: Sequence[str],
                materialized: bool = False) -> DataFrame:
    """Flag the first ``n`` rows of several rankings of one table: ``picks``
    maps a flag's name to its score (descending, ties by ``tiebreak``
    ascending, null scores never flagged).

    A ranking comes down to its boundary, the score at which the running count
    crosses ``n`` and, where only a part of the rows tied there is in, the last
    one's tiebreak (one row, found range by range).  All flags are then
    comparisons of a row's own columns with these boundaries: the rows are
    written once and flagged in one pass without a shuffle, however many
    rankings there are.  The tiebreak columns must identify rows uniquely;
    nulls in them come first."""
    tiebreak = list(tiebreak)
    if not materialized:
        df = materialize(df)

    def boundary(out: str):
        score = picks[out]
        cnt = df.where(F.col(score).isNotNull()).groupBy(score).agg(F.count(F.lit(1)).alias("_n"))
        pre = prefix_sum(cnt, score, ["_n"], descending=True, inclusive=False, totals=True, checkpoint=False)
        target = F.least(F.lit(int(n)), F.col("tot__n"))
        at = pre.where((F.col("cum__n") < target) & (F.col("cum__n") + F.col("_n") >= target)).select(
            score, (target - F.col("cum__n")).alias("k"), F.col("_n").alias("tied")).first()
        if at is None or at.k == at.tied:
            return at and at[0], None
        ties = df.where(F.col(score) == F.lit(at[0])).select(*tiebreak, F.lit(1).alias("_one"))
        last = prefix_sum(ties, tiebreak, ["_one"], checkpoint=False).where(F.col("cum__one") == at.k)
        return at[0], last.select(F.struct(*tiebreak).alias(f"_last_{out}"), F.lit(0).alias("_g"))

    found = dict(zip(picks, run_all(boundary, picks), strict=True))
    rows = df.withColumn("_g", F.lit(0))
    for _, last in found.values():
        if last is not None:  # one row
            rows = rows.join(F.broadcast(last), "_g", "left")
    flags = []
    for out, (bound, last) in found.items():
        score = F.col(picks[out])
        if bound is None:
            flag = F.lit(False)
        elif last is None:
            flag = score >= F.lit(bound)
        else:
            flag = (score > F.lit(bound)) | ((score == F.lit(bound)) & (F.struct(*tiebreak) <= F.col(f"_last_{out}")))
        flags.append(F.coalesce(flag, F.lit(False)).alias(out))
    return rows.select(*df.columns, *flags)


def percent_rows(df: DataFrame, pct: float) -> int:
    """``int(rows * pct / 100)``."""
    return math.floor(df.count() * float(pct) / 100)

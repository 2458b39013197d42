"""Time-based validation folds (backtests) and training-duration windows.

Fold rule: ``end = max(date) + 1 day``; holdout ``[end - h, end)``; fold i
validation ``[v_end - v, v_end)`` with ``v_end = end - h - i*v``; training is
``date < v_start - gap``.  The fold table has one row per fold (bounded by the
number of backtests) and is broadcast into a range join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.functions.durations import IsoDuration, parse_duration
from churnkit.functions.scalar import col_


def _shift(c: Column, d: IsoDuration, times: Column | int = 1) -> Column:
    """``c - times * d`` (months then days)."""
    t = times if isinstance(times, Column) else F.lit(times)
    out = c
    if d.months:
        out = F.add_months(out, (-t * F.lit(d.months)).cast("int"))
    if d.days:
        out = F.date_sub(out, (t * F.lit(d.days)).cast("int"))
    return out


def backtest_folds(df: DataFrame, date: str, n: int, gap: str, validation: str,
                   holdout: str | None = None) -> DataFrame:
    """One row per fold: fold, train_end, val_start, val_end, holdout_start, end."""
    g, v = parse_duration(gap), parse_duration(validation)
    h = parse_duration(holdout) if holdout else IsoDuration()
    top = df.agg(F.date_add(F.max(col_(date).cast("date")), 1).alias("end"))
    top = top.withColumn("holdout_start", _shift(F.col("end"), h))
    folds = top.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("fold"))
    folds = folds.withColumn("val_end", _shift(F.col("holdout_start"), v, F.col("fold")))
    folds = folds.withColumn("val_start", _shift(F.col("val_end"), v))
    folds = folds.withColumn("train_end", _shift(F.col("val_start"), g))
    return folds.select("fold", "train_end", "val_start", "val_end", "holdout_start", "end")


def assign_roles(df: DataFrame, date: str, folds: DataFrame) -> DataFrame:
    """Each row once per fold with its role: train, gap, validation, holdout
    or unused (after the validation window)."""
    d = col_(date).cast("date")
    # the fold table has n rows: broadcast and key it on a constant
    j = df.withColumn("_g", F.lit(0)).join(F.broadcast(folds.withColumn("_g", F.lit(0))), "_g").drop("_g")
    role = (F.when(d >= F.col("holdout_start"), "holdout")
            .when((d >= F.col("val_start")) & (d < F.col("val_end")), "validation")
            .when(d < F.col("train_end"), "train")
            .when(d < F.col("val_start"), "gap").otherwise("unused"))
    return j.withColumn("role", role)


def duration_windows(folds: DataFrame, months: Sequence[int]) -> DataFrame:
    """Fold x duration table: training window ``[train_end - d, train_end)``."""
    arr = F.array(*[F.lit(int(m)) for m in months])
    t = folds.select("fold", "train_end", F.explode(arr).alias("months"))
    return t.withColumn("train_start", F.add_months(F.col("train_end"), -F.col("months")))


def duration_slices(df: DataFrame, date: str, windows: DataFrame) -> DataFrame:
    """Rows of each (fold, duration) training window; the window table is
    tiny (folds x durations) and broadcast into a range join."""
    d = col_(date).cast("date")
    return df.join(F.broadcast(windows), (d >= F.col("train_start")) & (d < F.col("train_end")))


# ---------------------------------------------------------------- roles as bits

#: Windows per number: the sign and one more bit stay free.
BITS = 62


def window_mask(date: str, windows: Sequence[tuple]) -> Column:
    """Bit k tells whether the date lies in window k ``[start, end)`` (either may be None: open); an array of numbers
    of ``BITS`` bits each, all zero for a null date."""
    d = col_(date).cast("date")
    words = []
    for at in range(0, max(1, len(windows)), BITS):
        word = F.lit(0).cast("bigint")
        for k, (start, end) in enumerate(windows[at : at + BITS]):
            inside = F.lit(True)
            if start is not None:
                inside = inside & (d >= F.lit(start))
            if end is not None:
                inside = inside & (d < F.lit(end))
            word = word.bitwiseOR(F.when(inside & d.isNotNull(), F.lit(1 << k).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
        words.append(word)
    return F.array(*words)


def in_window(mask: str, k: int) -> Column:
    """Whether bit k of a mask column is set."""
    return F.get(F.col(mask), F.lit(k // BITS)).bitwiseAND(F.lit(1 << (k % BITS)).cast("bigint")) != 0


def fold_masks(df: DataFrame, date: str, folds: DataFrame) -> tuple[DataFrame, list[int]]:
    """``df`` with ``train_mask`` and ``validation_mask``, one bit per fold, and the folds in the order of the bits.

    A row is there once, whatever the number of folds; a fold's rows are a
    filter on its bit.  The fold table (one row per backtest) is read by the driver."""
    rows = folds.orderBy("fold").collect()
    early = [(None, min(r["train_end"], r["holdout_start"])) for r in rows]
    val = [(r["val_start"], min(r["val_end"], r["holdout_start"])) for r in rows]
    out = df.withColumn("train_mask", window_mask(date, early)).withColumn("validation_mask", window_mask(date, val))
    return out, [r["fold"] for r in rows]


def duration_masks(df: DataFrame, date: str, windows: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    """``df`` with ``duration_mask``, one bit per (fold, months) training window, and these pairs in the order of the bits."""
    rows = windows.orderBy("fold", "months").collect()
    return (df.withColumn("duration_mask", window_mask(date, [(r["train_start"], r["train_end"]) for r in rows])),
            [(r["fold"], r["months"]) for r in rows])


def mask_counts(df: DataFrame, masks: dict[str, Sequence], names: Sequence[str]) -> DataFrame:
    """Rows per window of each mask in one aggregation: ``(names..., role, n)`` of windows with rows; ``masks`` maps a
    role to its column and the windows' keys."""
    cells = [(role, column, k, key if isinstance(key, tuple) else (key,))
             for role, (column, keys) in masks.items() for k, key in enumerate(keys)]
    one = df.agg(*[F.count_if(in_window(column, k)).alias(f"n{i}") for i, (_, column, k, _) in enumerate(cells)])
    rows = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, key)], F.lit(role).alias("role"), F.col(f"n{i}").alias("n"))
                     for i, (role, _, _, key) in enumerate(cells)])
    return one.select(F.explode(rows).alias("r")).select("r.*").where("n > 0")

"""Column -> Column helpers.  All are built-in expressions (codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_", "flag_not_null", "binarise", "apply_threshold", "round_half_even",
    "days_between", "parse_dates", "safe_div", "unit_hash", "keep_share",
    "first_words", "nan_to_null",
]


def col_(c: str | Column) -> Column:
    if isinstance(c, Column):
        return c
    return F.col(f"`{c}`") if any(ch in c for ch in " ()|%@-") else F.col(c)


def flag_not_null(c: str | Column) -> Column:
    return col_(c).isNotNull()


def binarise(c: str | Column, cut: float = 1) -> Column:
    """``label >= cut`` to 1, else 0 (null stays 0, like ``np.where``)."""
    return F.when(col_(c) >= F.lit(cut), F.lit(1)).otherwise(F.lit(0))


def apply_threshold(p: str | Column, t: float | Column) -> Column:
    """Predicted class from probability and threshold (``p >= t``)."""
    t = t if isinstance(t, Column) else F.lit(float(t))
    return (col_(p) >= t).cast("int")


def round_half_even(c: str | Column, scale: int = 0) -> Column:
    """Banker's rounding, as ``Series.round`` (0.5 goes to 0)."""
    return F.bround(col_(c), scale)


def days_between(end: str | Column, start: str | Column) -> Column:
    """Whole days ``end - start``; null when either is null."""
    return F.datediff(col_(end), col_(start))


def parse_dates(df, cols, fmt: str | None = None):
    """String columns to dates; unparsable values become null."""
    for c in cols:
        expr = F.try_to_timestamp(col_(c), F.lit(fmt)) if fmt else F.try_to_timestamp(col_(c).cast("string"))
        df = df.withColumn(c, F.to_date(expr))
    return df


def safe_div(a: str | Column, b: str | Column) -> Column:
    """Division that gives null instead of failing (ANSI) on a zero divisor."""
    return F.try_divide(col_(a).cast("double"), col_(b).cast("double"))


def unit_hash(key: str | Column, seed: int | str = 0, method: str = "md5") -> Column:
    """Repeatable uniform number in [0, 1) from a key.

    ``md5`` (default): the first 32 bits of MD5 over ``seed:key``, the same
    on every run, every executor and after a lost task is recomputed, and
    reproducible in other SQL engines.  ``xxhash``: Spark's 64-bit xxHash of
    (key, seed), cheaper per row, for when only Spark must agree.  A null key
    hashes like an empty one, so its row takes part in every split.
    """
    if method == "xxhash":
        h = F.xxhash64(F.coalesce(col_(key).cast("string"), F.lit("")), F.lit(str(seed)))
        return F.pmod(h, F.lit(4294967296)).cast("double") / F.lit(4294967296.0)
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(col_(key).cast("string"), F.lit(""))))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def keep_share(key: str | Column, share: float, seed: int | str = 0) -> Column:
    """True for about ``share`` of the keys, the same keys every time."""
    return unit_hash(key, seed) < F.lit(float(share))


def first_words(c: str | Column, n: int = 2) -> Column:
    """First ``n`` whitespace-separated words joined by one space."""
    words = F.filter(F.split(F.trim(col_(c)), r"\s+"), lambda w: w != "")
    return F.array_join(F.slice(words, 1, n), " ")


def nan_to_null(c: str | Column) -> Column:
    """Map a NaN double to null (pandas treats NaN as missing)."""
    return F.nanvl(col_(c), F.lit(None).cast("double"))

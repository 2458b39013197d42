"""Association of columns of any type: mutual information from joint counts.

Numeric columns become quantile bins, others their values; every value whose
share of the column's rows is under ``min_share`` counts as one rare level,
so a column has at most ``1 / min_share + 1`` levels whatever the number
of distinct values.  One pass counts all pairs of levels of all column
pairs in tables inside the tasks, which are merged up a tree; a pair counts
the rows where both columns have a value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.functions.scalar import col_
from churnkit.operators.cluster import F1, F2, STAT
from churnkit.operators.packed import SCHEMA, merge_tree, packed, unpacked
from churnkit.operators.profile import numeric_columns, quantiles_of, to_long, value_table
from churnkit.operators.util import materialize

RESULT = f"{F1} string, {F2} string, n bigint, mutual_information double, {STAT} double, cramers_v double"


def quantile_edges(df: DataFrame, cols: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Distinct inner quantiles of each column (a few numbers per column reach the driver)."""
    cols = list(cols)
    if not cols:
        return {}
    counts = materialize(value_table(to_long(df, cols), ["column"]))
    names = [f"e{i}" for i in range(1, bins)]
    rows = quantiles_of(counts, [i / bins for i in range(1, bins)], ["column"], names=names).collect()
    found = {r["column"]: sorted({r[n] for n in names if r[n] is not None}) for r in rows}
    return {c: found.get(c, []) for c in cols}


def frequent_values(df: DataFrame, cols: Sequence[str], min_share: float) -> dict[str, list[str]]:
    """Values (as text) of at least ``min_share`` of the column's rows that have one: at most ``1 / min_share`` a column."""
    cols = list(cols)
    if not cols:
        return {}
    long = df.select(*[col_(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value").where("value IS NOT NULL")
    counts = materialize(long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy("column").agg(F.sum("n").alias("t"))
    rows = counts.join(F.broadcast(totals), "column").where(F.col("n") >= F.col("t") * F.lit(float(min_share))).collect()
    found: dict[str, list[str]] = {c: [] for c in cols}
    for r in sorted(rows, key=lambda r: r["value"]):
        found[r["column"]].append(r["value"])
    return found


def bin_places(column: pa.Array, edges: Sequence[float]) -> np.ndarray:
    """One more than the number of edges at or below each value; 0 for null and NaN."""
    v = column.to_numpy(zero_copy_only=False).astype(np.float64)
    return np.where(np.isnan(v), 0, np.searchsorted(np.array(edges, np.float64), v, "right") + 1)


def level_places(column: pa.Array, values: Sequence[str]) -> np.ndarray:
    """Place of each value among the frequent ones, from 2; 1 for a rare one; 0 for null."""
    text = pc.cast(column, pa.string())
    at = pc.fill_null(pc.index_in(text, pa.array(list(values), pa.string())), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.where(pc.is_null(text).to_numpy(zero_copy_only=False), 0, at + 2)


def _counter(places: list[tuple[Callable, Sequence]], sizes: list[int]):
    """A task's joint counts: tile i holds the tables of columns i < j, one after another; place 0 is a missing value.
    Values become places in arrays, a batch at a time."""
    k = len(sizes)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {(i, j): np.zeros(sizes[i] * sizes[j]) for i in range(k) for j in range(i + 1, k)}
        some = False
        for b in batches:
            codes = [place(b.column(i), known) for i, (place, known) in enumerate(places)]
            for (i, j), t in tables.items():
                t += np.bincount(codes[i] * sizes[j] + codes[j], minlength=len(t))
            some = some or b.num_rows > 0
        if some:
            for i in range(k - 1):
                yield packed({i: np.concatenate([tables[i, j] for j in range(i + 1, k)])})
    return fn


def _entropy(n: np.ndarray) -> float:
    p = n[n > 0] / n.sum()
    return float(-(p * np.log(p)).sum())


def measures(table: np.ndarray) -> tuple[int, float | None, float | None, float | None]:
    """Rows, mutual information (nats), its share of the smaller entropy, and Cramer's V of a table of counts; the
    latter two are null where a column is constant."""
    n = table.sum()
    if n == 0:
        return 0, None, None, None
    a, b = table.sum(1), table.sum(0)
    ha, hb = _entropy(a), _entropy(b)
    info = max(0.0, ha + hb - _entropy(table.ravel()))
    la, lb = int((a > 0).sum()), int((b > 0).sum())
    if min(la, lb) < 2:
        return int(n), info, None, None
    want = np.outer(a[a > 0], b[b > 0]) / n
    chi2 = ((table[a > 0][:, b > 0] - want) ** 2 / want).sum()
    return int(n), info, min(1.0, info / min(ha, hb)), float(np.sqrt(chi2 / n / (min(la, lb) - 1)))


def association_pairs(df: DataFrame, cols: Sequence[str], bins: int = 10, min_share: float = 0.01) -> DataFrame:
    """``(feature1, feature2, n, mutual_information, statistic, cramers_v)`` of every column pair, in column order.

    ``statistic`` is the mutual information over the smaller of the two
    entropies: 0 for independent columns, 1 where one column determines the
    other; it feeds the same distances and clusters as a correlation.  A
    task's tables take ``(sum of levels) ** 2 / 2`` numbers."""
    cols = list(cols)
    base = materialize(df.select(*[col_(c) for c in cols]))
    numeric = [c for c in cols if c in set(numeric_columns(base))]
    other = [c for c in cols if c not in numeric]
    edges, values = quantile_edges(base, numeric, bins), frequent_values(base, other, min_share)
    places = [(bin_places, edges[c]) if c in edges else (level_places, values[c]) for c in cols]
    sizes = [len(edges[c] if c in edges else values[c]) + 2 for c in cols]
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], RESULT)
    plain = base.select(*[col_(c).cast("double" if c in edges else "string").alias(f"c{i}") for i, c in enumerate(cols)])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, data in unpacked(b):
                rows, at = [], 0
                for j in range(i + 1, len(cols)):
                    size = sizes[i] * sizes[j]
                    table = data[at : at + size].reshape(sizes[i], sizes[j])[1:, 1:]
                    at += size
                    rows.append((cols[i], cols[j], *measures(table)))
                kinds = [pa.string(), pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                                 names=[F1, F2, "n", "mutual_information", STAT, "cramers_v"])

    counts = merge_tree(plain.mapInArrow(_counter(places, sizes), SCHEMA), np.add)
    return counts.mapInArrow(finish, RESULT)

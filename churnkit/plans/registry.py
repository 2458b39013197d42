"""Registry of named queries: a Spark callable and its DuckDB oracle.

A query takes ``(spark, sf_dir)`` and returns a DataFrame.  Its oracle is SQL
over the base tables (DuckDB registers them as views).  Double columns named
in ``r6`` are rounded to 6 decimals on both sides so that sums taken in a
different order compare equal (``+ 0.0`` turns a DuckDB ``-0.0`` into ``0.0``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    r6: tuple[str, ...]
    section: str


REGISTRY: dict[str, Query] = {}


def round_doubles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    if not cols:
        return df
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    exprs = []
    for c in df.columns:
        if c in cols and isinstance(types[c], (DoubleType, FloatType)):
            exprs.append(F.round(F.col(f"`{c}`").cast("double"), 6).alias(c))
        else:
            exprs.append(F.col(f"`{c}`"))
    return df.select(*exprs)


def rounded_sql(sql: str, cols: Sequence[str]) -> str:
    if not cols:
        return sql
    rep = ", ".join(f'ROUND(CAST("{c}" AS DOUBLE), 6) + 0.0 AS "{c}"' for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) q"


def query(name: str, section: str, sql: str | None = None, r6: Sequence[str] = ()):
    def deco(fn):
        cols = tuple(r6)

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir), cols)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, run, rounded_sql(sql, cols) if sql else None, cols, section)
        return fn
    return deco

"""Queries: association of numeric and text columns, clusters and
representatives from it (§2.10, §2.11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnkit.operators import association as ac, cluster as cl
from churnkit.operators.util import materialize
from churnkit.plans.q_cluster import _dbscan_sql, _SCALED
from churnkit.plans.registry import query
from churnkit.sources import load

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "net_price", "p_size", "p_retailprice", "o_totalprice"]
TEXT = ["l_returnflag", "l_linestatus", "ship_half", "size_class", "p_brand", "maker", "p_type", "o_orderstatus", "o_orderpriority"]
COLUMNS = [*NUMERIC, *TEXT]
TARGET = "l_returnflag"
BINS, MIN_SHARE, EPS = 10, 0.04, 0.8

_EXPRS = ["l_quantity", "l_extendedprice", "l_discount", "l_extendedprice * (1 - l_discount) AS net_price", "p_size",
          "p_retailprice", "o_totalprice", "l_returnflag", "l_linestatus",
          "CASE WHEN l_linenumber > 6 THEN NULL WHEN l_shipdate < TIMESTAMP '1995-06-17 00:00:00' THEN 'early' ELSE 'late' END AS ship_half",
          "CASE WHEN p_size <= 15 THEN 'small' WHEN p_size <= 35 THEN 'medium' ELSE 'large' END AS size_class",
          "p_brand", "substr(p_brand, 1, length(p_brand) - 1) AS maker", "p_type", "o_orderstatus", "o_orderpriority"]


def frame(spark, sf):
    """Line items with part and order attributes; some values of ``ship_half`` are missing."""
    li = load(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                                      "l_returnflag", "l_linestatus", "l_shipdate"])
    pt = load(spark, sf, "part", ["p_partkey", "p_brand", "p_type", "p_size", "p_retailprice"])
    od = load(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"])
    return li.join(pt, li.l_partkey == pt.p_partkey).join(od, li.l_orderkey == od.o_orderkey).selectExpr(*_EXPRS)


def pairs(spark, sf):
    return ac.association_pairs(frame(spark, sf), COLUMNS, BINS, MIN_SHARE)


def strengths(spark, sf):
    return materialize(pairs(spark, sf).select(cl.F1, cl.F2, cl.STAT))


_Q = ", ".join(f"quantile_cont(CAST({{c}} AS DOUBLE), {i / BINS})" for i in range(1, BINS))
_POS = ", ".join(f"('{c}', {i})" for i, c in enumerate(COLUMNS))
_NUM_CODES = "\nUNION ALL ".join(
    f"SELECT rid, '{c}' AS feature, CAST((SELECT COUNT(*) FROM (SELECT DISTINCT UNNEST(e) AS e FROM (SELECT [{_Q.format(c=c)}] AS e FROM fr)) "
    f"x WHERE x.e <= fr.{c}) AS INT) AS code FROM fr WHERE {c} IS NOT NULL" for c in NUMERIC)
_TEXT_CODES = "\nUNION ALL ".join(
    f"SELECT rid, '{c}', CASE WHEN COUNT(*) OVER (PARTITION BY {c}) >= {MIN_SHARE} * COUNT(*) OVER () "
    f"THEN DENSE_RANK() OVER (ORDER BY {c}) ELSE 0 END FROM fr WHERE {c} IS NOT NULL" for c in TEXT)
_BASE = {
    "fr": "SELECT row_number() OVER () AS rid, " + ", ".join(_EXPRS) + " FROM lineitem JOIN part ON p_partkey = l_partkey "
          "JOIN orders ON o_orderkey = l_orderkey",
    "pos": f"SELECT * FROM (VALUES {_POS}) t(feature, pos)",
    "codes": f"SELECT x.*, p.pos FROM ({_NUM_CODES}\nUNION ALL {_TEXT_CODES}) x JOIN pos p USING (feature)",
    "cells": "SELECT a.feature AS f, b.feature AS g, a.code AS x, b.code AS y, CAST(COUNT(*) AS DOUBLE) AS c FROM codes a JOIN codes b "
             "ON a.rid = b.rid AND a.pos < b.pos GROUP BY ALL",
    "marg": "SELECT *, SUM(c) OVER (PARTITION BY f, g) AS n, SUM(c) OVER (PARTITION BY f, g, x) AS cx, "
            "SUM(c) OVER (PARTITION BY f, g, y) AS cy FROM cells",
    "hx": "SELECT f, g, -SUM(cx / n * ln(cx / n)) AS h, COUNT(*) AS l FROM (SELECT DISTINCT f, g, x, cx, n FROM marg) t GROUP BY f, g",
    "hy": "SELECT f, g, -SUM(cy / n * ln(cy / n)) AS h, COUNT(*) AS l FROM (SELECT DISTINCT f, g, y, cy, n FROM marg) t GROUP BY f, g",
    "mi": "SELECT f, g, MAX(n) AS n, SUM(c / n * ln(c * n / (cx * cy))) AS info, SUM(c * c / (cx * cy)) - 1 AS phi2 FROM marg GROUP BY f, g",
    "pairs": """SELECT f AS feature1, g AS feature2, CAST(n AS BIGINT) AS n, GREATEST(info, 0.0) AS mutual_information,
  CASE WHEN LEAST(hx.l, hy.l) > 1 THEN LEAST(1.0, GREATEST(info, 0.0) / LEAST(hx.h, hy.h)) END AS statistic,
  CASE WHEN LEAST(hx.l, hy.l) > 1 THEN sqrt(GREATEST(phi2, 0.0) / (LEAST(hx.l, hy.l) - 1)) END AS cramers_v
FROM mi JOIN hx USING (f, g) JOIN hy USING (f, g)""",
}


def asql(body: str, extra: dict | None = None, recursive: bool = False) -> str:
    ctes = {**_BASE, **(extra or {})}
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + body


_R6 = ["mutual_information", "statistic", "cramers_v"]


@query("association_mixed", "2.11", r6=_R6, sql=asql("SELECT * FROM pairs"))
def q_association(spark, sf):
    """Mutual information, normalised association and Cramer's V of all pairs of numeric and text columns."""
    return pairs(spark, sf)


def _clusters_sql(min_pts: int) -> dict:
    return {k: v.replace("1 - statistic <= 0.4", f"1 - statistic <= {EPS}") for k, v in _dbscan_sql(min_pts).items()}


def clusters(spark, p):
    return cl.dbscan(cl.distance(p), cl.feature_positions(COLUMNS, spark), EPS, 2)


@query("association_mixed_clusters", "2.11", sql=asql("SELECT * FROM clusters", _clusters_sql(2), recursive=True))
def q_clusters(spark, sf):
    """Density clusters of numeric and text columns by their association; 0 = none."""
    return clusters(spark, strengths(spark, sf))


_REP = {**_clusters_sql(2),
        "imp": "SELECT feature1 AS feature, statistic AS importance FROM (SELECT feature1, feature2, statistic FROM pairs UNION ALL "
               f"SELECT feature2, feature1, statistic FROM pairs) s WHERE feature2 = '{TARGET}'",
        "cm0": "SELECT c.feature, c.pos, c.cluster, i.importance FROM clusters c JOIN imp i USING (feature)",
        "cmap": "SELECT feature, pos, cluster, importance, importance_scaled FROM (" + _SCALED.format(src="cm0") + ") t",
        "leads": "SELECT cluster, feature AS lead FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cluster ORDER BY "
                 "round(importance_scaled, 9) DESC, pos) AS r FROM cmap WHERE cluster > 0) x WHERE r = 1"}


@query("cluster_representatives_mixed", "2.10", sql=asql(
    "SELECT lead AS feature, cluster FROM leads UNION ALL SELECT feature, 0 FROM cmap WHERE cluster = 0", _REP, recursive=True))
def q_representatives(spark, sf):
    """Each association cluster's column that says most about the return flag, text columns included, and the columns
    without a cluster."""
    p = strengths(spark, sf)
    target = cl.target_correlation(p, TARGET)
    cm = materialize(cl.cluster_map(clusters(spark, p), target).withColumn("importance_scaled", F.round("importance_scaled", 9)))
    leads = cl.lead_features(cm)
    return (leads.select(F.col("lead").alias("feature"), "cluster")
            .unionByName(cm.where("cluster = 0").select("feature", "cluster")))

"""Queries: correlation pairs, distances, density clusters, de-collinearised
features (§2.2, §2.5, §2.11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnkit.operators import cluster as cl
from churnkit.plans.registry import query
from churnkit.sources import load

# numeric features of line items with their part (correlated families:
# quantity/price/net/charge, discount, tax, part attributes, keys)
FEATURE_EXPRS = [
    ("l_orderkey", "l_orderkey"), ("l_partkey", "l_partkey"), ("l_suppkey", "l_suppkey"),
    ("l_linenumber", "l_linenumber"), ("l_quantity", "l_quantity"), ("l_extendedprice", "l_extendedprice"),
    ("l_discount", "l_discount"), ("l_tax", "l_tax"),
    ("net_price", "l_extendedprice * (1 - l_discount)"),
    ("charge", "l_extendedprice * (1 - l_discount) * (1 + l_tax)"),
    ("unit_price", "l_extendedprice / l_quantity"),
    ("p_retailprice", "p_retailprice"), ("p_size", "p_size"),
]
FEATURES = [n for n, _ in FEATURE_EXPRS]
TARGET = "charge"
EPS, MIN_PTS = 0.4, 3


def feature_frame(spark, sf, with_date: bool = False):
    extra = ["l_shipdate"] if with_date else []
    li = load(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                      "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                                      *extra])
    pt = load(spark, sf, "part", ["p_partkey", "p_retailprice", "p_size"])
    j = li.join(pt, li.l_partkey == pt.p_partkey)
    return j.selectExpr("l_orderkey * 8 + l_linenumber AS rid", *[f"{e} AS {n}" for n, e in FEATURE_EXPRS],
                        "l_returnflag", "l_linestatus", *extra)


_FEAT_SQL = ("SELECT l_orderkey * 8 + l_linenumber AS rid, " + ", ".join(f"{e} AS {n}" for n, e in FEATURE_EXPRS)
             + ", l_returnflag, l_linestatus FROM lineitem JOIN part ON p_partkey = l_partkey")
_PAIRS = [(a, b) for i, a in enumerate(FEATURES) for b in FEATURES[i + 1:]]
_CORR_ROW = "SELECT " + ", ".join(f"corr({a}, {b}) AS p{k}" for k, (a, b) in enumerate(_PAIRS)) + " FROM feat"
_PAIRS_SQL = "\nUNION ALL ".join(f"SELECT '{a}' AS feature1, '{b}' AS feature2, p{k} AS statistic FROM c"
                                  for k, (a, b) in enumerate(_PAIRS))
_POS_SQL = "SELECT * FROM (VALUES " + ", ".join(f"('{f}', {i})" for i, f in enumerate(FEATURES)) + ") t(feature, pos)"
_BASE = {"feat": _FEAT_SQL, "c": _CORR_ROW, "pairs": _PAIRS_SQL, "pos": _POS_SQL}


def csql(body: str, extra: dict | None = None, recursive: bool = False) -> str:
    ctes = dict(_BASE)
    ctes.update(extra or {})
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + body


def pairs(spark, sf, method: str = "blocks"):
    return cl.corr_pairs(feature_frame(spark, sf), FEATURES, method=method)


def positions(spark):
    return cl.feature_positions(FEATURES, spark)


@query("corr_pairs", "2.11", r6=["statistic"], sql=csql("SELECT * FROM pairs"))
def q_corr(spark, sf):
    """Pearson correlation of all numeric feature pairs (Arrow partial moments for 78 pairs)."""
    return pairs(spark, sf)


@query("corr_pairs_single_agg", "2.11", r6=["statistic"], sql=csql("SELECT * FROM pairs"))
def q_corr_agg(spark, sf):
    """Same correlations from one aggregation of corr() calls (the narrow-table path)."""
    return pairs(spark, sf, method="agg")


@query("association_to_pairs", "2.11", r6=["statistic"], sql=csql(
    "SELECT * FROM pairs UNION ALL SELECT feature2, feature1, statistic FROM pairs"))
def q_symmetric(spark, sf):
    return cl.symmetric(pairs(spark, sf))


@query("corr_distance", "2.11", r6=["distance"], sql=csql(
    "SELECT feature1, feature2, 1 - statistic AS distance FROM pairs"))
def q_distance(spark, sf):
    return cl.distance(pairs(spark, sf))


@query("drop_empty_rows_cols", "2.2", r6=["statistic"], sql=csql("""
SELECT * FROM pairs WHERE feature1 IN (SELECT f FROM live) AND feature2 IN (SELECT f FROM live)""",
    extra={"live": "SELECT f FROM (SELECT feature1 AS f, statistic FROM pairs UNION ALL "
                   "SELECT feature2, statistic FROM pairs) s GROUP BY f HAVING COUNT(statistic) > 0"}))
def q_drop_null(spark, sf):
    """Pairs of features that have at least one defined correlation."""
    return cl.drop_all_null(pairs(spark, sf))


def _dbscan_sql(min_pts: int) -> dict:
    return {
        "edges": f"SELECT feature1 AS a, feature2 AS b FROM pairs WHERE 1 - statistic <= {EPS} "
                 f"UNION ALL SELECT feature2, feature1 FROM pairs WHERE 1 - statistic <= {EPS}",
        "core": f"SELECT p.feature, p.pos FROM pos p WHERE 1 + (SELECT COUNT(*) FROM edges e WHERE e.a = p.feature) >= {min_pts}",
        "cedges": "SELECT a, b FROM edges WHERE a IN (SELECT feature FROM core) AND b IN (SELECT feature FROM core)",
        "reach": "SELECT feature AS f, feature AS g FROM core UNION SELECT r.f, e.b FROM reach r JOIN cedges e ON e.a = r.g",
        "comp": "SELECT r.f AS feature, MIN(p.pos) AS root FROM reach r JOIN pos p ON p.feature = r.g GROUP BY r.f",
        "ids": "SELECT root, DENSE_RANK() OVER (ORDER BY root) AS cluster FROM (SELECT DISTINCT root FROM comp) x",
        "core_cl": "SELECT feature, cluster FROM comp JOIN ids USING (root)",
        "border": "SELECT e.a AS feature, MIN(cc.cluster) AS cluster FROM edges e JOIN core_cl cc ON cc.feature = e.b "
                  "WHERE e.a NOT IN (SELECT feature FROM core) GROUP BY e.a",
        "clusters": "SELECT p.feature, p.pos, COALESCE(cc.cluster, b.cluster, 0) AS cluster FROM pos p "
                    "LEFT JOIN core_cl cc USING (feature) LEFT JOIN border b USING (feature)",
    }


def clusters(spark, sf, min_pts: int = MIN_PTS, p=None):
    p = pairs(spark, sf) if p is None else p
    return cl.dbscan(cl.distance(p), positions(spark), EPS, min_pts)


@query("dbscan_features", "2.11", sql=csql("SELECT * FROM clusters", _dbscan_sql(MIN_PTS), recursive=True))
def q_dbscan(spark, sf):
    """Density clusters of features (eps 0.4 on 1 - r, at least 3 incl. itself); 0 = none."""
    return clusters(spark, sf)


@query("exhaustive_clusters", "2.11", sql=csql("SELECT * FROM clusters", _dbscan_sql(1), recursive=True))
def q_exhaustive(spark, sf):
    """Every feature in a cluster: components of distance <= 0.4."""
    return clusters(spark, sf, 1)


_IMP = {"imp": f"SELECT feature1 AS feature, statistic AS importance FROM (SELECT * FROM pairs UNION ALL "
               f"SELECT feature2, feature1, statistic FROM pairs) s WHERE feature2 = '{TARGET}'"}


@query("target_correlation", "2.11", r6=["importance"], sql=csql("SELECT * FROM imp", _IMP))
def q_target_corr(spark, sf):
    """Importance = correlation to the target (charge); the target excluded."""
    return cl.target_correlation(pairs(spark, sf), TARGET)


_SCALED = ("SELECT *, CASE WHEN mx - mn > 0 THEN (ABS(importance) - mn) / (mx - mn) ELSE 0.0 END * 1.0 + 0.2 "
           "AS importance_scaled FROM {src}, (SELECT MIN(ABS(importance)) AS mn, MAX(ABS(importance)) AS mx FROM {src}) s")


@query("minmax_scale_abs", "2.5", r6=["importance", "importance_scaled"], sql=csql(
    "SELECT feature, importance, importance_scaled FROM (" + _SCALED.format(src="imp") + ") t", _IMP))
def q_minmax(spark, sf):
    """abs(importance) scaled to [0.2, 1.2]."""
    return cl.minmax_scale(cl.target_correlation(pairs(spark, sf), TARGET), "importance", out="importance_scaled")


def cmap(spark, sf):
    from churnkit.operators.util import materialize
    p = materialize(pairs(spark, sf))  # one pair table for clusters and importance
    return materialize(cl.cluster_map(clusters(spark, sf, p=p), cl.target_correlation(p, TARGET)))


_CMAP = dict(_dbscan_sql(MIN_PTS))
_CMAP.update(_IMP)
_CMAP["cm0"] = "SELECT c.feature, c.pos, c.cluster, i.importance FROM clusters c JOIN imp i USING (feature)"
_CMAP["cmap"] = ("SELECT feature, pos, cluster, importance, importance_scaled FROM ("
                 + _SCALED.format(src="cm0") + ") t")
_CMAP["leads"] = ("SELECT cluster, feature AS lead FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cluster ORDER BY "
                  "importance_scaled DESC, pos) AS r FROM cmap WHERE cluster > 0) x WHERE r = 1")


@query("cluster_map_table", "2.11", r6=["importance", "importance_scaled"],
       sql=csql("SELECT * FROM cmap", _CMAP, recursive=True))
def q_cmap(spark, sf):
    """Feature, cluster, importance and scaled importance (data under the map)."""
    return cmap(spark, sf).select("feature", "pos", "cluster", "importance", "importance_scaled")


@query("argmax_per_cluster", "2.5", sql=csql("SELECT * FROM leads", _CMAP, recursive=True))
def q_leads(spark, sf):
    """Lead feature of each cluster (largest scaled importance)."""
    return cl.lead_features(cmap(spark, sf))


_PLAN = dict(_CMAP)
_PLAN["plan"] = """
SELECT lead || ' (cluster ' || CAST(cluster AS VARCHAR) || ')' AS name, 'copy' AS op, lead AS a, NULL AS b FROM leads
UNION ALL SELECT 'd_' || m.feature || '_' || l.lead, 'diff', m.feature, l.lead
  FROM cmap m JOIN leads l USING (cluster) WHERE m.cluster > 0 AND m.feature <> l.lead
UNION ALL SELECT 'r_' || m.feature || '_' || l.lead, 'ratio', m.feature, l.lead
  FROM cmap m JOIN leads l USING (cluster) WHERE m.cluster > 0 AND m.feature <> l.lead
UNION ALL SELECT feature, 'copy', feature, NULL FROM cmap WHERE cluster = 0"""


def _pick(col: str) -> str:
    return "CASE " + col + " " + " ".join(f"WHEN '{f}' THEN CAST(r.{f} AS DOUBLE)" for f in FEATURES) + " END"


@query("derive_cluster_features", "2.11", r6=["mean"], sql=csql("""
SELECT name, COUNT(v) AS n, AVG(v) AS mean FROM (
  SELECT name, CASE op WHEN 'copy' THEN va WHEN 'diff' THEN va - vb
                  ELSE CASE WHEN vb = 0 THEN NULL ELSE va / vb END END AS v
  FROM (SELECT p.name, p.op, """ + _pick("p.a") + " AS va, " + _pick("p.b") + """ AS vb
        FROM plan p, feat r) x) t
GROUP BY name""", _PLAN, recursive=True))
def q_derive(spark, sf):
    """De-collinearised features (lead kept, differences and ratios to it), summarised per column."""
    cm = cmap(spark, sf)
    plan = cl.derived_feature_plan(cm, cl.lead_features(cm), use_diff=True, use_ratio=True).collect()
    wide = cl.decollinearise(feature_frame(spark, sf), [tuple(r) for r in plan])
    names = [r[0] for r in plan]
    long = wide.select(*[F.col(f"`{n}`").cast("double").alias(n) for n in names]).unpivot([], names, "name", "v")
    return long.groupBy("name").agg(F.count("v").alias("n"), F.avg("v").alias("mean"))


@query("cluster_representatives", "2.10", sql=csql("""
SELECT lead AS feature FROM leads UNION SELECT feature FROM cmap WHERE cluster = 0
UNION SELECT * FROM (VALUES ('l_returnflag'), ('l_linestatus')) t(feature)""", _CMAP, recursive=True))
def q_representatives(spark, sf):
    """Cluster leads, unclustered features and non-numeric features."""
    cm = cmap(spark, sf)
    f = feature_frame(spark, sf)
    from churnkit.operators.profile import non_numeric_columns
    nn = spark.createDataFrame([(c,) for c in non_numeric_columns(f)], "feature string")
    return cl.representatives(cm, cl.lead_features(cm), nn)


_GREEDY = dict(_IMP)
_GREEDY.update({
    "ord": "SELECT feature, ROW_NUMBER() OVER (ORDER BY ROUND(importance, 9) DESC, feature) AS rk FROM imp",
    "strong": "SELECT feature1 AS f, feature2 AS g FROM pairs WHERE ABS(statistic) > 0.9 "
              "UNION ALL SELECT feature2, feature1 FROM pairs WHERE ABS(statistic) > 0.9",
    "walk": "SELECT 0 AS i, CAST([] AS VARCHAR[]) AS kept UNION ALL "
            "SELECT w.i + 1, CASE WHEN EXISTS (SELECT 1 FROM strong s WHERE s.f = o.feature "
            "AND list_contains(w.kept, s.g)) THEN w.kept ELSE list_append(w.kept, o.feature) END "
            "FROM walk w JOIN ord o ON o.rk = w.i + 1",
})


@query("redundancy_by_correlation", "2.10", sql=csql("""
SELECT o.feature, list_contains((SELECT kept FROM walk ORDER BY i DESC LIMIT 1), o.feature) AS keep FROM ord o""",
    _GREEDY, recursive=True))
def q_drop_correlated(spark, sf):
    """Walk features by importance; drop one with |r| > 0.9 to a kept stronger feature."""
    p = pairs(spark, sf)
    importance = cl.target_correlation(p, TARGET).withColumn("importance", F.round("importance", 9))  # equal ones tie in any order of sums
    return cl.drop_correlated(p, importance, 0.9)


_CONST = ["l_quantity", "fixed", "l_discount"]


@query("corr_pairs_constant", "2.11", r6=["statistic"], sql="""
SELECT 'l_quantity' AS feature1, 'fixed' AS feature2, CAST(NULL AS DOUBLE) AS statistic
UNION ALL SELECT 'l_quantity', 'l_discount', corr(l_quantity, l_discount) FROM lineitem
UNION ALL SELECT 'fixed', 'l_discount', NULL""")
def q_corr_constant(spark, sf):
    """Correlations with a constant column: null, as undefined."""
    li = load(spark, sf, "lineitem", ["l_quantity", "l_discount"]).withColumn("fixed", F.lit(0.1))
    return cl.corr_pairs(li, _CONST)


@query("drop_empty_after_constant", "2.2", r6=["statistic"], sql="""
SELECT 'l_quantity' AS feature1, 'l_discount' AS feature2, corr(l_quantity, l_discount) AS statistic FROM lineitem""")
def q_drop_constant(spark, sf):
    """A constant column's undefined correlations leave the pair table with the column."""
    return cl.drop_all_null(q_corr_constant(spark, sf))

"""Queries: scalar functions, column selection, sources and sinks (§2.1, §2.2, §2.8)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from churnkit.functions import scalar as sc
from churnkit.functions.durations import shift_date
from churnkit.operators import profile as pf
from churnkit.plans.registry import query
from churnkit.session import shared_path
from churnkit.sources import fixtures, io, load


def _scratch(spark, name: str) -> str:
    return shared_path(spark, f"churnkit-out/{name}-{uuid.uuid4().hex}")


@query("parse_dates", "2.8", sql="SELECT o_orderkey, CAST(CAST(CAST(o_orderdate AS VARCHAR) AS TIMESTAMP) AS DATE) AS d FROM orders")
def q_parse_dates(spark, sf):
    """Order dates written as text, parsed back to dates."""
    o = load(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    return sc.parse_dates(o.select("o_orderkey", F.col("o_orderdate").cast("string").alias("d")), ["d"])


@query("days_between", "2.8", sql=fixtures.with_views(
    "SELECT idsubscrip, observation_date, stop_intent_date, "
    "CAST(date_diff('day', observation_date, stop_intent_date) AS INTEGER) AS days "
    "FROM intent_preds", "intent_preds"))
def q_days(spark, sf):
    i = fixtures.intent_preds(spark, sf)
    return i.select("idsubscrip", "observation_date", "stop_intent_date",
                    sc.days_between("stop_intent_date", "observation_date").alias("days"))


@query("apply_duration", "2.8", sql=fixtures.with_views(
    "SELECT idsubscrip, observation_date, CAST(observation_date + INTERVAL 2 MONTH AS DATE) AS plus_validation, "
    "CAST(observation_date - INTERVAL 60 DAY AS DATE) AS minus_gap FROM intent_preds", "intent_preds"))
def q_duration(spark, sf):
    """Dates moved by ISO durations (2-month validation forward, 60-day gap back)."""
    i = fixtures.intent_preds(spark, sf)
    return i.select("idsubscrip", "observation_date",
                    shift_date("observation_date", "P0Y2M0DT0H0M0S").alias("plus_validation"),
                    shift_date("observation_date", "P0Y0M60DT0H0M0S", sign=-1).alias("minus_gap"))


@query("null_flags", "2.8", sql=fixtures.with_views(
    "SELECT idsubscrip, observation_date, stop_intent_date IS NOT NULL AS has_stop_intent, "
    "stop_intent_date IS NULL AS no_intent FROM intent_preds", "intent_preds"))
def q_null_flags(spark, sf):
    i = fixtures.intent_preds(spark, sf)
    return i.select("idsubscrip", "observation_date", sc.flag_not_null("stop_intent_date").alias("has_stop_intent"),
                    F.col("stop_intent_date").isNull().alias("no_intent"))


@query("conditional_value", "2.8", sql=fixtures.with_views(
    "SELECT idsubscrip, inference_date, CASE WHEN true_churned >= 1 THEN 1 ELSE 0 END AS churn_bin, "
    "CASE WHEN risk_label = 'High' THEN 1 ELSE 0 END AS high FROM rule_preds", "rule_preds"))
def q_conditional(spark, sf):
    r = fixtures.rule_preds(spark, sf)
    return r.select("idsubscrip", "inference_date", sc.binarise("true_churned").alias("churn_bin"),
                    F.when(F.col("risk_label") == "High", 1).otherwise(0).alias("high"))


@query("binarise_label", "2.2", sql=fixtures.with_views(
    "SELECT true_churned, CASE WHEN true_churned >= 1 THEN 1 ELSE 0 END AS y, COUNT(*) AS n FROM rule_preds GROUP BY 1, 2",
    "rule_preds"))
def q_binarise(spark, sf):
    r = fixtures.rule_preds(spark, sf)
    return r.groupBy("true_churned", sc.binarise("true_churned").alias("y")).agg(F.count(F.lit(1)).alias("n"))


@query("threshold_label", "2.2", sql=fixtures.with_views(
    "SELECT idsubscrip, observation_date, churned_1_PREDICTION, CAST(churned_1_PREDICTION >= 0.1211 AS INT) AS label_deployed, "
    "CAST(churned_1_PREDICTION >= 0.5 AS INT) AS label_half FROM intent_preds", "intent_preds"))
def q_threshold(spark, sf):
    """Labels at the deployed threshold (0.1211) and at 0.5."""
    i = fixtures.intent_preds(spark, sf)
    return i.select("idsubscrip", "observation_date", "churned_1_PREDICTION",
                    sc.apply_threshold("churned_1_PREDICTION", 0.1211).alias("label_deployed"),
                    sc.apply_threshold("churned_1_PREDICTION", 0.5).alias("label_half"))


@query("round_half_even", "2.2", sql=fixtures.with_views(
    "SELECT churned_PREDICTION, round_even(churned_PREDICTION, 0) AS rounded, COUNT(*) AS n FROM "
    "(SELECT AVG(churned_PREDICTION) AS churned_PREDICTION FROM intent_preds GROUP BY idsubscrip, observation_date) t "
    "GROUP BY 1, 2", "intent_preds"), r6=["churned_PREDICTION"])
def q_round_even(spark, sf):
    """Averaged labels rounded half to even (0.5 goes to 0)."""
    i = fixtures.intent_preds(spark, sf).groupBy("idsubscrip", "observation_date") \
        .agg(F.avg("churned_PREDICTION").alias("churned_PREDICTION"))
    return i.groupBy("churned_PREDICTION", sc.round_half_even("churned_PREDICTION").alias("rounded")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("safe_arithmetic", "2.8", r6=["discount_per_tax", "kept_share", "gap"], sql="""
SELECT l_orderkey, l_linenumber, CAST(l_discount AS DOUBLE) / NULLIF(l_tax, 0) AS discount_per_tax,
  1 - l_discount AS kept_share, ABS(l_extendedprice - l_quantity * 1000) AS gap FROM lineitem""")
def q_safe(spark, sf):
    """Ratio with a zero guard (null, not an ANSI error), complement, absolute gap."""
    li = load(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_extendedprice", "l_quantity"])
    return li.select("l_orderkey", "l_linenumber", sc.safe_div("l_discount", "l_tax").alias("discount_per_tax"),
                     (1 - F.col("l_discount")).alias("kept_share"),
                     F.abs(F.col("l_extendedprice") - F.col("l_quantity") * 1000).alias("gap"))


@query("rounding", "2.8", sql="""
SELECT l_orderkey, l_linenumber, round_even(l_quantity / 4, 0) AS q4, round_even(l_discount * 10, 0) AS d10
FROM lineitem""")
def q_rounding(spark, sf):
    """Half-to-even rounding to an integer."""
    li = load(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_discount"])
    return li.select("l_orderkey", "l_linenumber", F.bround(F.col("l_quantity") / 4, 0).alias("q4"),
                     F.bround(F.col("l_discount") * 10, 0).alias("d10"))


@query("casts", "2.8", r6=["p"], sql=fixtures.with_views(
    "SELECT idsubscrip, observation_date, CAST(CAST(churned_1_PREDICTION AS VARCHAR) AS DOUBLE) AS p, "
    "CAST(stop_intent_date IS NOT NULL AS INT) AS has_intent FROM intent_preds", "intent_preds"))
def q_casts(spark, sf):
    """Prediction text to number; boolean to 0/1."""
    i = fixtures.intent_preds(spark, sf)
    return i.select("idsubscrip", "observation_date",
                    F.col("churned_1_PREDICTION").cast("string").cast("double").alias("p"),
                    F.col("stop_intent_date").isNotNull().cast("int").alias("has_intent"))


@query("string_tests", "2.8", sql=fixtures.with_views(
    "SELECT model_id, starts_with(model_type, 'Gradient') AS starts_gradient, suffix(model_type, 'Classifier') AS ends_clf, "
    "contains(model_type, 'Gradient') AS has_gradient, suffix(model_type, 'Scores') AS ends_scores FROM leaderboard",
    "leaderboard"))
def q_string_tests(spark, sf):
    lb = fixtures.leaderboard(spark, sf)
    t = F.col("model_type")
    return lb.select("model_id", t.startswith("Gradient").alias("starts_gradient"), t.endswith("Classifier").alias("ends_clf"),
                     t.contains("Gradient").alias("has_gradient"), t.endswith("Scores").alias("ends_scores"))


@query("string_reshape", "2.8", sql=fixtures.with_views(
    "SELECT model_id, replace(model_type, ' Classifier', '') AS short_type, "
    "array_to_string(list_slice(string_split(model_type, ' '), 1, 2), ' ') AS phrase, "
    "array_to_string(list_slice(string_split(model_type, ' '), 2, 3), '_') AS middle FROM leaderboard", "leaderboard"))
def q_string_reshape(spark, sf):
    lb = fixtures.leaderboard(spark, sf)
    parts = F.split(F.col("model_type"), " ")
    return lb.select("model_id", F.replace(F.col("model_type"), F.lit(" Classifier"), F.lit("")).alias("short_type"),
                     F.array_join(F.slice(parts, 1, 2), " ").alias("phrase"),
                     F.array_join(F.slice(parts, 2, 2), "_").alias("middle"))


@query("array_ops", "2.8", sql=fixtures.with_views("""
SELECT model_id, pos, word, sorted_words, n_distinct FROM (
  SELECT model_id, list_sort(string_split(model_type, ' ')) AS sorted_words,
    CAST(len(list_distinct(string_split(lower(model_type), ' '))) AS INTEGER) AS n_distinct,
    CAST(UNNEST(range(0, len(string_split(model_type, ' ')))) AS INTEGER) AS pos, UNNEST(string_split(model_type, ' ')) AS word
  FROM leaderboard) t""", "leaderboard"))
def q_array_ops(spark, sf):
    """Word arrays of model types: sort, distinct count, (position, word) rows."""
    lb = fixtures.leaderboard(spark, sf)
    w = F.split(F.col("model_type"), " ")
    return lb.select("model_id", F.array_sort(w).alias("sorted_words"),
                     F.size(F.array_distinct(F.split(F.lower("model_type"), " "))).alias("n_distinct"),
                     F.posexplode(w).alias("pos", "word"))


NUM_LINEITEM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                "l_discount", "l_tax"]


@query("select_by_dtype", "2.2", sql="SELECT " + ", ".join(NUM_LINEITEM) + " FROM lineitem")
def q_dtype(spark, sf):
    """Numeric columns of lineitem only."""
    li = load(spark, sf, "lineitem")
    return li.select(*pf.numeric_columns(li))


@query("select_by_name_rule", "2.2", sql=fixtures.with_views(
    "SELECT idsystem, pubcode, churned_1_PREDICTION, churned_0_PREDICTION, churned_PREDICTION, THRESHOLD, "
    "POSITIVE_CLASS, DEPLOYMENT_APPROVAL_STATUS, prediction_status FROM intent_preds", "intent_preds"))
def q_name_rule(spark, sf):
    """Predictors: target, date column, listed ids and any name containing the date column dropped."""
    i = fixtures.intent_preds(spark, sf)
    return i.select(*pf.predictor_columns(i, "churned", "observation_date", ["idsubscrip", "stop_intent_date"]))


@query("project_features", "2.1", sql="SELECT l_quantity, l_extendedprice, l_discount FROM lineitem")
def q_project(spark, sf):
    return io.select_features(load(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@query("read_table", "2.1", sql="SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def q_read_table(spark, sf):
    """A Parquet path read with a column list and a filter pushed into the scan."""
    df = io.read_table(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_totalprice", "o_orderstatus"])
    return df.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@query("load_csv", "2.1", sql="SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem")
def q_load_csv(spark, sf):
    """lineitem columns written as CSV with a header and read back with a declared schema."""
    path = _scratch(spark, "csv")
    io.write_csv(load(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_discount"]), path)
    return io.load_csv(spark, path, schema="l_orderkey bigint, l_linenumber int, l_quantity double, l_discount double")


@query("load_csv_inferred", "2.1", r6=["l_quantity", "l_discount"], sql="SELECT l_orderkey, l_quantity, l_discount, l_returnflag FROM lineitem")
def q_load_csv_inferred(spark, sf):
    """The same without a schema: types are inferred from the whole file."""
    path = _scratch(spark, "csv")
    io.write_csv(load(spark, sf, "lineitem", ["l_orderkey", "l_quantity", "l_discount", "l_returnflag"]), path)
    return io.load_csv(spark, path)


@query("write_csv", "2.1", sql="SELECT risk_label, COUNT(*) AS n FROM (" + fixtures.SQL["rule_preds"]() + ") r GROUP BY 1")
def q_write_csv(spark, sf):
    """A report saved as CSV (index column first) and read back."""
    rep = fixtures.rule_preds(spark, sf).groupBy("risk_label").agg(F.count(F.lit(1)).alias("n"))
    path = _scratch(spark, "report")
    io.write_csv(rep, path, index_col="risk_label")
    return spark.read.option("header", True).schema("risk_label string, n bigint").csv(path)


@query("replace_table_as", "2.1", sql="SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY o_custkey")
def q_replace(spark, sf):
    """CREATE OR REPLACE TABLE AS SELECT into the shared folder, then read."""
    path = _scratch(spark, "table")
    agg = load(spark, sf, "orders", ["o_custkey"]).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    io.replace_table(agg, path)
    io.replace_table(agg, path)  # replacing is idempotent
    return io.read_table(spark, path)


@query("replace_table_catalog", "2.1", sql="SELECT o_custkey, COUNT(*) AS n_orders, SUM(o_totalprice) AS total FROM orders GROUP BY o_custkey",
       r6=["total"])
def q_replace_catalog(spark, sf):
    """A catalog table replaced by one with another column, read by its name."""
    name = f"churnkit_replace_{uuid.uuid4().hex[:8]}"
    orders = load(spark, sf, "orders", ["o_custkey", "o_totalprice"])
    io.replace_table(orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders")), name)
    io.replace_table(orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total")), name)
    return io.read_table(spark, name)


@query("load_csv_quarantine", "2.1", sql="""
SELECT 'good' AS what, COUNT(*) AS n, SUM(l_orderkey) AS keys, 'bigint,double,date,string' AS types FROM lineitem WHERE l_linenumber <> 6
UNION ALL SELECT 'rejected', COUNT(*), NULL, NULL FROM lineitem WHERE l_linenumber = 6""")
def q_quarantine(spark, sf):
    """Line items as CSV in which every sixth line of an order has a field too many: rejected lines are counted and the
    others get the narrowest types, the file read once."""
    path = _scratch(spark, "csv")
    li = load(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "l_returnflag"])
    quantity = F.when(F.col("l_linenumber") == 1, F.format_string("%.2f", "l_quantity")).otherwise(F.col("l_quantity").cast("int").cast("string"))
    line = F.concat_ws(",", "l_orderkey", quantity, F.to_date("l_shipdate").cast("string"), "l_returnflag",
                       F.when(F.col("l_linenumber") == 6, F.lit("more")))
    header = ["key", "quantity", "shipped", "flag"]
    li.select(line.alias("value")).write.text(path)
    got = io.load_csv_checked(spark, path, header)
    good = got.rows.agg(F.count(F.lit(1)).alias("n"), F.sum("key").alias("keys"))
    return (good.select(F.lit("good").alias("what"), "n", "keys", F.lit(",".join(got.types.values())).alias("types"))
            .unionByName(got.rejected.agg(F.count(F.lit(1)).alias("n"))
                         .select(F.lit("rejected").alias("what"), "n", F.lit(None).cast("bigint").alias("keys"),
                                 F.lit(None).cast("string").alias("types"))))


@query("versioned_output_name", "2.1", sql=fixtures.with_views(
    "SELECT 'intent-m1' AS model_id, MAX(observation_date) AS max_date, "
    "'predictions_intent-m1_' || strftime(MAX(observation_date), '%Y%m%d') AS output_name FROM intent_preds",
    "intent_preds"))
def q_output_name(spark, sf):
    return io.output_name(fixtures.intent_preds(spark, sf), "intent-m1", "observation_date")


@query("flag_not_null", "2.2", sql=fixtures.with_views(
    "SELECT stop_intent_date IS NOT NULL AS has_stop_intent, COUNT(*) AS n FROM intent_preds GROUP BY 1", "intent_preds"))
def q_flag_not_null(spark, sf):
    """``has_stop_intent`` from the presence of an intent date, counted."""
    i = fixtures.intent_preds(spark, sf)
    return i.groupBy(sc.flag_not_null("stop_intent_date").alias("has_stop_intent")).agg(F.count(F.lit(1)).alias("n"))


@query("conditional_class_filter", "2.2", sql=fixtures.with_views(
    "SELECT 'positive' AS branch, COUNT(*) AS n, SUM(l_quantity) AS quantity FROM downsample_base WHERE target_column > 0 "
    "UNION ALL SELECT 'negative', COUNT(*), SUM(l_quantity) FROM downsample_base WHERE target_column = 0",
    "downsample_base"))
def q_class_filter(spark, sf):
    """The two class branches of the downsampling query (target > 0, target = 0)."""
    b = fixtures.downsample_base(spark, sf)
    pos = b.where(F.col("target_column") > 0).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))
    neg = b.where(F.col("target_column") == 0).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))
    return pos.select(F.lit("positive").alias("branch"), "*").unionByName(neg.select(F.lit("negative").alias("branch"), "*"))

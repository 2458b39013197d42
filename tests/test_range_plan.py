"""The range plan of the prefix scan on awkward keys, and with many ranges on
real data against the oracles."""

import pytest

import __spark_entry__ as entry
from churnkit.operators import prefix
from tests.conftest import SF01
from tools.oracle_check import compare

NAMES = ["roc_auc", "segment_metrics", "top_percent_priority", "cost_benefit", "describe_by_group",
         "weighted_auc_downsampled", "drift_report"]


@pytest.mark.parametrize("name", NAMES)
def test_many_ranges_match_oracle(spark, con01, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    try:
        r = compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], SF01, con01)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert r["status"] == "ok", r


def test_null_order_values_keep_their_rows(spark):
    df = spark.createDataFrame([(None, 1), (1.0, 2), (2.0, 3)], "s double, w long")
    got = {r["s"]: r["cum_w"] for r in prefix.prefix_sum(df, "s", ["w"], ranges=3).collect()}
    assert got == {None: 1, 1.0: 3, 2.0: 6}


def test_ties_with_null_repeated_and_text_tiebreaks(spark):
    rows = [(1.0, None if i < 3 else "same" if i < 9 else f"t{i}", i) for i in range(14)]
    df = spark.createDataFrame(rows, "s double, name string, id long")
    out = prefix.top_n_flag(df, "s", 4, ["name", "id"]).collect()
    assert len(out) == 14
    assert sorted(r["id"] for r in out if r["priority"]) == [0, 1, 2, 3]

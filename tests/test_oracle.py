"""Every query of the churn workflow against its DuckDB oracle at sf0.01."""

import pytest

import __spark_entry__ as entry
from churnkit.plans import catalog
from tests.conftest import SF01
from tools.oracle_check import compare

NAMES = sorted(catalog.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con01, name):
    sql = entry.oracle_sql().get(name)
    r = compare(spark, name, entry.queries()[name], sql, SF01, con01)
    assert r["status"] == ("ok" if sql else "rows-only") and (sql or r["rows"] > 0), r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["report", "model", "metric", "value"]
    assert {r["report"] for r in rows} == {"business_impact", "false_positives", "ranking", "classification"}

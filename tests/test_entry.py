"""The driver's entry without the corpus operators, and metrics that the given data never reach."""

import os
import shutil
import subprocess
import sys

import pytest

from churnkit.operators.metrics import regression_metrics, weighted_binary_metrics
from tests.conftest import ROOT


@pytest.mark.parametrize("keep_pipeline", [False, True])
def test_entry_without_the_corpus_operators(tmp_path, keep_pipeline):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if keep_pipeline else ["corpus_pipeline.py"])))
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); print(len(q), len(s), any(n.startswith('op') or n == 'pipeline' for n in q))"
    env = {**os.environ, "PYTHONPATH": str(copy)}
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) >= int(out[1]) > 150 and out[2] == "False"


def test_weights_that_sum_to_nothing(spark):
    df = spark.createDataFrame([("a", 1.0, 0.4, 0.0), ("a", 0.0, 0.3, 0.0), ("b", 1.0, 0.8, 1.0), ("b", 0.0, 0.1, 2.0)], "g string, y double, p double, w double")
    got = {r.g: r for r in weighted_binary_metrics(df, "y", "p", "w", by=["g"]).collect()}
    assert got["a"].logloss is None and got["a"].rmse is None and got["a"].auc is None and got["b"].auc == 1
    none = {r.g: r for r in regression_metrics(df, "y", "p", "w", by=["g"]).collect()}
    assert none["a"].rmse is None and none["a"].r_squared is None and none["b"].rmse > 0


def test_negative_targets_have_no_deviance(spark):
    df = spark.createDataFrame([(-1.0, 2.0), (3.0, 2.5), (5.0, 4.0)], "y double, p double")
    r = regression_metrics(df, "y", "p").first()
    assert r.fve_poisson is None and r.fve_gamma is None and r.fve_tweedie is None and r.r_squared is not None

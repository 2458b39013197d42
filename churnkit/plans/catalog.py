"""All registered queries (importing the query modules fills the registry)."""

from __future__ import annotations

from churnkit.plans import (  # noqa: F401
    q_association, q_cluster, q_evaluate, q_functions, q_impact, q_leaderboard, q_ml, q_profile, q_reconcile, q_sampling,
)
from churnkit.plans.registry import REGISTRY


def queries():
    return {k: q.fn for k, q in REGISTRY.items()}


def oracle_sql():
    return {k: q.sql for k, q in REGISTRY.items() if q.sql}

"""Imports every query module so the registry is complete."""

from __future__ import annotations

from ledgerlens.plans import (dashboard_queries, ledger_queries, model_queries,  # noqa: F401
                              profile_queries,
                              resolve_queries, stream_queries)
from ledgerlens.plans.registry import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)

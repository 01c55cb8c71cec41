"""All registered queries (importing the binding modules fills the registry)."""

from __future__ import annotations

from metroframe.plans import bind_ingest, bind_marts, bind_ops, bind_staging, bind_timeline  # noqa: F401
from metroframe.plans.registry import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in ORACLE.items() if k in QUERIES}

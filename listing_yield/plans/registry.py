"""Collects the registered queries and oracles from every query module."""

from __future__ import annotations

from . import queries, queries_model, queries_more, queries_profile, queries_stream, queries_text  # noqa: F401


def all_queries():
    return dict(queries.QUERIES)


def oracle_sql():
    return {k: v for k, v in queries.ORACLES.items() if k in queries.QUERIES}

"""Assembles the registry from the query modules."""

from __future__ import annotations

from bankspark.queries import funding_q, io_q, market_q, models_q, report_q, stats_q

_MODULES = [funding_q, report_q, market_q, stats_q, models_q, io_q]


def queries():
    out = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql():
    out = {}
    for m in _MODULES:
        out.update(m.ORACLE)
    return out

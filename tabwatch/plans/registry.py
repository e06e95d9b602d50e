"""All registered queries and their DuckDB oracle statements."""

from __future__ import annotations

import importlib

_MODULES = [
    "tabwatch.plans.drift_queries",
    "tabwatch.plans.prep_queries",
    "tabwatch.plans.runlog_queries",
    "tabwatch.plans.sampling_queries",
    "tabwatch.plans.feature_queries",
    "tabwatch.plans.model_queries",
    "tabwatch.plans.stream_queries",
]


def _load():
    queries, oracles = {}, {}
    for m in _MODULES:
        mod = importlib.import_module(m)
        for k, fn in mod.QUERIES.items():
            if k in queries:
                raise KeyError(f"duplicate query {k}")
            queries[k] = fn
        oracles.update(getattr(mod, "ORACLES", {}))
    return queries, oracles


def all_queries():
    return _load()[0]


def all_oracles():
    return _load()[1]

"""Registered queries: every operator applied to the shared tables, with equivalent SQL where SQL can say it."""

from __future__ import annotations

from importlib import import_module

MODULES = [
    "qc",
    "time_joins",
    "cycle_fits",
    "grades",
    "series_stats",
    "anomalies",
    "day_windows",
    "science",
    "overviews",
    "files",
]


def load() -> dict[str, tuple]:
    """``name -> (spark query, SQL or None)`` over all modules."""
    out: dict[str, tuple] = {}
    for m in MODULES:
        for name, pair in import_module(f"respira.catalog.{m}").QUERIES.items():
            if name in out:
                raise ValueError(f"query {name} is registered twice")
            out[name] = pair
    return out

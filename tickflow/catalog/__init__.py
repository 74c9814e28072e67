"""The registered queries over the shared test tables, with their SQL checks."""

from __future__ import annotations

import importlib

from tickflow.catalog import registry

MODULES = ["feeds", "gridded", "ordered", "features", "books", "reports", "cleaning", "regimes", "sinks", "streams", "days"]


def load():
    for name in MODULES:
        importlib.import_module(f"tickflow.catalog.{name}")
    return registry.QUERIES, registry.SQL

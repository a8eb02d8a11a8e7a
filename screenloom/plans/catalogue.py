"""All registered queries of the engine's own operators."""

from __future__ import annotations

import importlib
import pkgutil

MODULES = [importlib.import_module(f"{__package__}.{m.name}") for m in pkgutil.iter_modules(__import__(__package__, fromlist=["x"]).__path__) if m.name.startswith("q_")]
QUERIES = {k: v for m in MODULES for k, v in m.query.QUERIES.items()}
ORACLE_SQL = {k: v for m in MODULES for k, v in m.query.ORACLE_SQL.items()}

"""Collects a module's queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable


class Registry:
    def __init__(self) -> None:
        self.QUERIES: dict[str, Callable] = {}
        self.ORACLE_SQL: dict[str, str] = {}

    def __call__(self, sql: str | None = None) -> Callable:
        def add(f: Callable) -> Callable:
            self.QUERIES[f.__name__] = f
            if sql:
                self.ORACLE_SQL[f.__name__] = sql
            return f

        return add

"""Collects a module's queries and, where given, their SQL."""

from __future__ import annotations

from collections.abc import Callable


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        def register(fn):
            self.queries[fn.__name__] = fn
            if sql:
                self.sql[fn.__name__] = sql
            return fn

        return register

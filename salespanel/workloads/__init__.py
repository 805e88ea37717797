"""Registered queries over the star-schema tables, each with its SQL where SQL can say it."""

from . import cleaning, forecasts, panels, reports, storage

MODULES = (cleaning, panels, forecasts, reports, storage)


def all_queries() -> dict:
    return {name: q for m in MODULES for name, q in m.query.queries.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.query.sql.items()}

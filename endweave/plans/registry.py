"""All queries of the engine by name, with the SQL that gives the same rows."""

from __future__ import annotations

import importlib

_FOUND: dict = {}
_SQL: dict[str, str] = {}
_MODULES = ("core", "models", "statistics", "tables", "checks", "files", "gates")


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame under its name."""

    def add(f):
        _FOUND[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def sql_of(name: str) -> str:
    """The SQL of a query of a module that is imported already."""
    return _SQL[name]


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"endweave.plans.{name}")


def queries() -> dict:
    _load()
    return dict(_FOUND)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)

"""Where queries register themselves."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from grantlens.catalogue.roles import ROLES_SQL, Tables

_BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {}
_SQL: dict[str, str] = {}

# Modules that register queries.
_MODULES = ("questions", "summary_tables", "filtered_views", "variant_views", "cleaning",
            "sampling", "reporting", "stored")


def _text(sql: str, ctes: str) -> str:
    """Role views, then ``ctes``, then the query (which may open with further views: ', x AS')."""
    views = ROLES_SQL + ("," + ctes if ctes else "")
    return f"WITH {views}\n{sql.strip()}"


def query(name: str, sql: str | None = None, ctes: str = ""):
    """Register ``f(tables) -> DataFrame``.

    ``sql`` sees the role views (patents, inventors, companies, patent_relationships,
    patent_cpc) and whatever ``ctes`` adds to them.
    """

    def register(build):
        if name in _BUILDERS:
            raise ValueError(f"query {name} is registered twice")
        _BUILDERS[name] = build
        if sql is not None:
            _SQL[name] = _text(sql, ctes)
        return build

    return register


def _load() -> None:
    for module in _MODULES:
        importlib.import_module(f"grantlens.catalogue.{module}")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(build):
        return lambda spark, sf_dir: build(Tables(spark, sf_dir))

    return {name: bind(build) for name, build in _BUILDERS.items()}


def all_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)

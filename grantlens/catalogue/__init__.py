"""Registered queries over the driver tables, each with its checking SQL where SQL can say it."""

from grantlens.catalogue.registry import all_queries, all_sql

__all__ = ["all_queries", "all_sql"]

"""Registered queries and the SQL that each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, *names: str):
    """Registers a query; ``names``: stand-ins that its SQL starts with."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = (fixtures.cte(*names) if names else "") + sql if not sql.startswith(",") else fixtures.cte(*names).rstrip() + sql
        return f

    return keep

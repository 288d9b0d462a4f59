"""Collects queries and their oracle SQL by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from civicspark.plans.bindings import table, with_bindings

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, uses: str = ""):
    """Registers f(table) -> DataFrame, where table(name) is a driver or domain table, under f's name."""

    def add(f: Callable[[Callable[[str], DataFrame]], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: table(spark, sf_dir, name))
        if sql:
            ORACLE_SQL[f.__name__] = with_bindings(sql, *uses.split())
        return f

    return add

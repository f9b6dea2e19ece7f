"""Registry of queries and their SQL counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable
from importlib import import_module
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare
from .views import Tables
from .views_sql import SQL_VIEWS

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLE: dict[str, str] = {}
MODULES = ["q_log", "q_windows", "q_ops", "q_cdc", "q_orders", "q_reliability", "q_txn_saga", "q_search", "q_streams"]


def query(name: str, sql: str | None = None):
    """Register a query under its operator name, with the SQL that must give the same rows."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return fn

    return add


def with_views(sql: str) -> str:
    """Prefix a statement with the views it names, each after the ones it needs."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for view in SQL_VIEWS:
            if view not in ordered and re.search(rf"\b{view}\b", text):
                visit(SQL_VIEWS[view])
                if view not in ordered:
                    ordered.append(view)

    sql = dedent(sql).strip()
    visit(sql)
    if not ordered:
        return sql
    ctes = [f"{v} AS ({dedent(SQL_VIEWS[v]).strip()})" for v in ordered]
    if sql.startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + sql[len("WITH ") :]
    return "WITH " + ",\n".join(ctes) + "\n" + sql


def bind(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Tables(prepare(spark), sf_dir))

    run.__doc__ = fn.__doc__
    return run


def load() -> None:
    """Import every module that registers queries."""
    for module in MODULES:
        import_module(f"{__package__}.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load()
    return {name: bind(fn) for name, fn in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    load()
    return dict(ORACLE)

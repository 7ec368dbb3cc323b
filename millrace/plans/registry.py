"""Collects the registered queries and their SQL from the modules of this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the SQL that gives the same rows."""

    def keep(query: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = query
        if sql is not None:
            _SQL[name] = sql
        return query

    return keep


def queries() -> dict[str, Query]:
    load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(_SQL)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register_columns(name: str, table: str, keys: list[str], columns: dict[str, tuple[Callable[[], object], str | None]]) -> None:
    """A query that selects ``keys`` and named columns of a table, with their SQL.

    ``columns`` maps an alias to (what makes the Column, its SQL).  Columns have
    to be made when the query runs, as there is no session before.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return load(spark, sf_dir, table).select(*keys, *(make().alias(alias) for alias, (make, _) in columns.items()))

    sql = None
    if all(text is not None for _, text in columns.values()):
        sql = f"SELECT {', '.join([*keys, *(f'{text} AS {alias}' for alias, (_, text) in columns.items())])} FROM {table}"
    register(name, sql)(query)


def load_all() -> None:
    """Import the modules that register queries."""
    import importlib

    for module in ("q_functions", "q_records", "q_text", "q_analytics", "q_sources", "q_more"):
        importlib.import_module(f"millrace.plans.{module}")

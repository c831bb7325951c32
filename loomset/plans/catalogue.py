"""All queries of the engine and their SQL, but for those on training data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import data_queries, document_queries, model_queries, more_queries, names_queries, records

_REGISTRIES = (data_queries.query, names_queries.query, model_queries.query, document_queries.query, more_queries.query)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for r in _REGISTRIES for k, v in r.queries.items()} | records.queries()


def oracle_sql() -> dict[str, str]:
    return {k: v for r in _REGISTRIES for k, v in r.sql.items()} | records.oracle_sql()

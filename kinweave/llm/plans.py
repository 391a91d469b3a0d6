"""All registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kinweave.llm import plans_languages, plans_leaks, plans_mixing, plans_records, plans_tables, plans_vectors

MODULES = (plans_tables, plans_vectors, plans_records, plans_leaks, plans_mixing, plans_languages)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}

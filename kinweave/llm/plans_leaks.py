"""Queries of problem 8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinweave.llm.leaks import find_leaks
from kinweave.session import read_table


def p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    return find_leaks(read_table(spark, d, "documents"), read_table(spark, d, "eval_items"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_leaks(spark, d).select("item_id", "doc_id")


QUERIES = {"p8_found": p8_found, "p8_leaks": p8_leaks}
SQL: dict[str, str] = {}

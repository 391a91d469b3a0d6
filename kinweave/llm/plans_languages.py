"""Queries of problem 10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm.languages import languages, wrong_or_foreign
from kinweave.session import cut, read_table


def _tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return read_table(spark, d, "documents").select("doc_id", "text", "lang"), read_table(spark, d, "notebook_cells")


def p10_labels(spark: SparkSession, d: str) -> DataFrame:
    """Every document's language and every foreign paragraph, with confidences."""
    return languages(*_tables(spark, d))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    docs, cells = _tables(spark, d)
    # cut: the labelling is dear and its rows are read twice
    found = wrong_or_foreign(docs, cut(languages(docs, cells)))
    return found.select("doc_id", F.col("cell_no").cast("int"), F.col("para_no").cast("int"), "lang").distinct()


QUERIES = {"p10_found": p10_found, "p10_labels": p10_labels}
SQL: dict[str, str] = {}

"""Queries of problem 9."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm.mixing import mix
from kinweave.session import read_table

TOKENIZER = os.environ.get("KINWEAVE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = read_table(spark, d, "documents").select("doc_id", "source", "text", "n_cells")
    # notebooks with more cells count as better
    return mix(docs, read_table(spark, d, "mix_targets"), TOKENIZER, weight=F.log1p(F.col("n_cells").cast("double")))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The documents of the mixture, each with the target and the reached share of its source."""
    chosen, report = _mix(spark, d)
    return chosen.join(F.broadcast(report.select("source", "target_share", F.round("share", 6).alias("share"))), "source")


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[1]


def p9_summary(spark: SparkSession, d: str) -> DataFrame:
    """Of each target source, whether its size misses its budget by half a document at most and the budget is at least the target share or all that the repeats allow, and whether none is repeated too often."""
    r = p9_report(spark, d)
    r = r.crossJoin(r.agg(F.sum("budget").alias("size")))
    near = F.abs(F.col("tokens") - F.col("budget")) <= F.col("largest") / 2 + 1
    near &= (F.col("budget") >= F.col("target_share") * F.col("size") * (1 - 1e-9)) | (F.col("budget") >= F.col("total_tokens") * F.col("max_repeats") - 1)
    near = near.cast("int")
    return r.select("source", near.alias("near"), (F.col("max_used") <= F.col("max_repeats")).cast("int").alias("capped"))


QUERIES = {"p9_mixture": p9_mixture, "p9_report": p9_report, "p9_summary": p9_summary}
SQL = {"p9_summary": "SELECT DISTINCT lower(trim(source)) AS source, 1 AS near, 1 AS capped FROM mix_targets WHERE source IS NOT NULL"}

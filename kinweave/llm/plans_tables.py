"""Queries of problems 1 and 2, on candidate_pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm.splits import assign_splits
from kinweave.llm.topn import top_n_per_group
from kinweave.session import cut, read_table

BLANKS = r"^\s+|\s+$"


def entity_key(c: str = "source1_entity_id") -> Column:
    return F.upper(F.regexp_replace(F.col(c), BLANKS, ""))


def _best(spark: SparkSession, d: str, n: int) -> DataFrame:
    pairs = read_table(spark, d, "candidate_pairs").select("source1_entity_id", "candidate_entity_id", "blocking_score")
    return top_n_per_group(pairs, entity_key(), F.col("candidate_entity_id"), F.col("blocking_score"), n, names=("source1_entity_id", "candidate_entity_id", "blocking_score"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _best(spark, d, 5).select("source1_entity_id", "candidate_entity_id")


def p1_ranked(spark: SparkSession, d: str) -> DataFrame:
    return _best(spark, d, 10)


def split_rows(spark: SparkSession, d: str) -> DataFrame:
    pairs = read_table(spark, d, "candidate_pairs")
    targets = {r["split_name"]: r["target_share"] for r in read_table(spark, d, "split_targets").collect()}
    key = F.when(entity_key() != "", entity_key())
    # each spelling is a node; the common form links all spellings of one entity
    return assign_splits(pairs, {"spelling": F.when(key.isNotNull(), F.col("source1_entity_id")), "entity": key}, targets)


def p2_splits(spark: SparkSession, d: str) -> DataFrame:
    """Every row of candidate_pairs with its split."""
    return split_rows(spark, d)


def p2_summary(spark: SparkSession, d: str) -> DataFrame:
    """Of each target split, whether its share of rows is within 0.02; and of all, the rows and how many entities lie in several splits."""
    rows = cut(split_rows(spark, d).select(entity_key().alias("entity"), "split"))
    total = rows.agg(F.count("*").alias("n_rows"))
    parted = rows.where("entity <> ''").groupBy("entity").agg(F.min("split").alias("lo"), F.max("split").alias("hi")).agg(F.count(F.when(F.col("lo") != F.col("hi"), 1)).alias("parted"))
    per = rows.groupBy("split").agg(F.count("*").alias("n"))
    targets = read_table(spark, d, "split_targets").select("split_name", "target_share")
    near = targets.join(per, F.col("split") == F.col("split_name"), "left").crossJoin(total).crossJoin(parted)
    share = F.coalesce("n", F.lit(0)) / F.greatest("n_rows", F.lit(1))
    return near.select("split_name", (F.abs(share - F.col("target_share")) <= 0.02).cast("int").alias("near"), "n_rows", "parted")


QUERIES = {"p1_found": p1_found, "p1_ranked": p1_ranked, "p2_splits": p2_splits, "p2_summary": p2_summary}

_PAIRS = r"""
WITH m AS (SELECT upper(regexp_replace(source1_entity_id, '^\s+|\s+$', '', 'g')) AS source1_entity_id, candidate_entity_id, max(blocking_score) AS blocking_score
  FROM candidate_pairs WHERE source1_entity_id IS NOT NULL AND candidate_entity_id <> '' AND blocking_score IS NOT NULL AND NOT isnan(blocking_score) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY blocking_score DESC, candidate_entity_id) AS rank FROM m WHERE source1_entity_id <> '')
"""
SQL = {
    "p2_summary": "SELECT split_name, 1 AS near, (SELECT count(*) FROM candidate_pairs) AS n_rows, 0 AS parted FROM split_targets",
    "p1_found": _PAIRS + "SELECT source1_entity_id, candidate_entity_id FROM r WHERE rank <= 5",
    "p1_ranked": _PAIRS + "SELECT source1_entity_id, candidate_entity_id, blocking_score, rank FROM r WHERE rank <= 10",
}

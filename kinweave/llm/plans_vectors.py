"""Queries of problem 3, on name_vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm.similar import similar
from kinweave.session import read_table


def p3_similar(spark: SparkSession, d: str) -> DataFrame:
    """The ten nearest of every entity whose number is divisible by 100, among all entities, in all shards."""
    asks = F.try_to_number(F.substring("entity_id", 4, 10), F.lit("9999999999")) % 100 == 0
    return similar(read_table(spark, d, "name_vectors"), k=10, margin=None, beam=40, asks=asks)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    # so close vectors lie near one another in any shard: a narrow margin and beam find them
    close = similar(read_table(spark, d, "name_vectors"), k=10, min_cosine=0.95, margin=0.1, beam=16)
    return close.select(F.least("id", "other").alias("entity_id_a"), F.greatest("id", "other").alias("entity_id_b")).distinct()


QUERIES = {"p3_found": p3_found, "p3_similar": p3_similar}
SQL = {
    "p3_found": """
WITH one AS (SELECT entity_id, min(vec) AS vec FROM name_vectors WHERE entity_id IS NOT NULL AND vec IS NOT NULL GROUP BY entity_id),
u AS (SELECT entity_id, vec::DOUBLE[48] AS v FROM one WHERE len(vec) = 48 AND list_sum(list_transform(vec, lambda x: x * x)) > 0),
s AS (SELECT a.entity_id AS a, b.entity_id AS b, array_cosine_similarity(a.v, b.v) AS c FROM u a JOIN u b ON a.entity_id <> b.entity_id),
r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(c, 9) DESC, b) AS n FROM s)
SELECT DISTINCT least(a, b) AS entity_id_a, greatest(a, b) AS entity_id_b FROM r WHERE n <= 10 AND c >= 0.95""",
}

"""Queries of problems 5, 6 and 7, on the tables of business records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm.crossmatch import match
from kinweave.llm.places import same_building_records
from kinweave.llm.records import with_fields
from kinweave.llm.variants import same_business
from kinweave.session import cut, read_table

BLANKS = r"^\s+|\s+$"


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = same_building_records(read_table(spark, d, "train_source1"))
    return pairs.select(F.col("a").alias("entity_id_a"), F.col("b").alias("entity_id_b"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = same_business(cut(with_fields(read_table(spark, d, "train_source1"))))
    return pairs.select(F.col("a").alias("entity_id_a"), F.col("b").alias("entity_id_b"))


def p6_matches(spark: SparkSession, d: str) -> DataFrame:
    """Every candidate pair of train_source1 and the other two tables with its confidence."""
    s1 = cut(with_fields(read_table(spark, d, "train_source1")))
    others = cut(with_fields(read_table(spark, d, "train_source2").unionByName(read_table(spark, d, "train_source3"))))
    clean = lambda c: F.upper(F.regexp_replace(c, BLANKS, ""))
    labels = read_table(spark, d, "train_labels").select(clean("source1_entity_id").alias("a"), "matched_entity_ids")
    truth = labels.select("a", F.explode(F.split("matched_entity_ids", ",")).alias("b")).select("a", clean("b").alias("b"))
    return match(s1, others, truth.where("b <> '' AND b <> 'NAN'"), labels.select("a"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    labelled = read_table(spark, d, "train_labels").select(F.upper(F.regexp_replace("source1_entity_id", BLANKS, "")).alias("a"))
    found = p6_matches(spark, d).where("confidence >= 0.5").join(labelled.where("a IS NOT NULL").distinct(), "a", "left_anti")
    return found.select(F.col("a").alias("source1_entity_id"), F.col("b").alias("candidate_entity_id"))


QUERIES = {"p5_found": p5_found, "p6_found": p6_found, "p6_matches": p6_matches, "p7_found": p7_found}
SQL: dict[str, str] = {}

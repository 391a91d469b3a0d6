"""Queries on keys that hold most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.operators.heavy_keys import heavy_keys, profile_by_key, with_share
from kinweave.session import read_table

BLANKS = r"^\s+|\s+$"


def country_key(c: str | Column = "country") -> Column:
    return F.lower(F.regexp_replace(F.col(c) if isinstance(c, str) else c, BLANKS, ""))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    s1 = read_table(spark, d, "train_source1").select("country", "entity_id", "loaded_at")
    return heavy_keys(s1, country_key(), F.col("entity_id"), 0.08).select(F.col("key").alias("country"))


def p4_country_profile(spark: SparkSession, d: str) -> DataFrame:
    """Per country of train_source1: rows, entities, labelled matches within the country, share of rows and whether it is heavy."""
    s1 = read_table(spark, d, "train_source1")
    base = with_share(profile_by_key(s1.select("country", "entity_id", "loaded_at"), F.coalesce(country_key(), F.lit("")), F.col("entity_id")))
    lab = (
        read_table(spark, d, "train_labels")
        .select(F.upper(F.regexp_replace("source1_entity_id", BLANKS, "")).alias("a"), F.explode(F.split("matched_entity_ids", ",")).alias("b"))
        .select("a", F.upper(F.regexp_replace("b", BLANKS, "")).alias("b"))
        .distinct()
    )
    home = s1.select(F.col("entity_id").alias("a"), F.coalesce(country_key(), F.lit("")).alias("country")).distinct()
    other = read_table(spark, d, "train_source2").unionByName(read_table(spark, d, "train_source3"))
    other = other.select(F.col("entity_id").alias("b"), F.coalesce(country_key(), F.lit("")).alias("country")).distinct()
    within = lab.join(home, "a").join(other, ["b", "country"]).select("country", F.concat_ws("|", "a", "b").alias("pair"))
    matches = profile_by_key(within, F.col("country"), F.col("pair")).select("key", F.col("n_distinct").alias("n_matches"))
    return base.join(matches, "key", "left").select(
        F.col("key").alias("country"),
        F.col("n_rows"),
        F.col("n_distinct").alias("n_entities"),
        F.coalesce("n_matches", F.lit(0).cast("long")).alias("n_matches"),
        F.round("share", 6).alias("share"),
        ((F.col("share") > 0.08) & (F.col("key") != "")).alias("heavy"),
    )


QUERIES = {"p4_found": p4_found, "p4_country_profile": p4_country_profile}

_KEY = r"lower(regexp_replace(country, '^\s+|\s+$', '', 'g'))"
SQL = {
    "p4_found": f"""
WITH k AS (SELECT {_KEY} AS country FROM train_source1)
SELECT country FROM k GROUP BY country
HAVING country <> '' AND count(*) > 0.08 * (SELECT count(*) FROM k)""",
    "p4_country_profile": f"""
WITH s AS (SELECT coalesce({_KEY}, '') AS country, entity_id FROM train_source1),
o AS (SELECT DISTINCT coalesce({_KEY}, '') AS country, entity_id AS b FROM (
  SELECT country, entity_id FROM train_source2 UNION ALL SELECT country, entity_id FROM train_source3)),
l AS (SELECT DISTINCT upper(regexp_replace(a, '^\\s+|\\s+$', '', 'g')) AS a, upper(regexp_replace(b, '^\\s+|\\s+$', '', 'g')) AS b
  FROM (SELECT source1_entity_id AS a, unnest(string_split(matched_entity_ids, ',')) AS b FROM train_labels)),
m AS (SELECT country, count(*) AS n FROM (
  SELECT DISTINCT l.a, l.b, o.country FROM l JOIN (SELECT DISTINCT country, entity_id AS a FROM s) h ON h.a = l.a JOIN o ON o.b = l.b AND o.country = h.country) GROUP BY country)
SELECT s.country, count(*) AS n_rows, count(DISTINCT entity_id) AS n_entities, coalesce(any_value(m.n), 0) AS n_matches,
  round(count(*) / (SELECT count(*) FROM s)::DOUBLE, 6) AS share, (count(*) > 0.08 * (SELECT count(*) FROM s) AND s.country <> '') AS heavy
FROM s LEFT JOIN m ON m.country = s.country GROUP BY s.country""",
}

"""The nineteen features of a candidate pair.

Token and n-gram arrays are made once for each record, before the join to pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions.fuzzy import FUZZY, fuzzy_scores
from kinweave.functions.text import char_ngrams, tokens

# The features in order.
FEATURE_NAMES = [
    "name_token_jaccard", "name_char3_jaccard", "name_levenshtein", "name_token_sort", "name_token_set", "name_partial", "name_len_diff", "name_exact", "name_core_exact",
    "addr_token_jaccard", "addr_char3_jaccard", "addr_levenshtein", "addr_token_sort", "addr_token_set", "addr_len_diff",
    "postal_match", "postal_both_present", "country_match", "blocking_score",
]


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all elements of two distinct arrays; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / F.greatest(union, F.lit(1)))


def len_diff(a: Column, b: Column) -> Column:
    x, y = F.length(a), F.length(b)
    return F.abs(x - y) / F.greatest(x, y, F.lit(1))


def equal_nonblank(a: Column, b: Column) -> Column:
    return F.when((a != "") & (a == b), F.lit(1.0)).otherwise(F.lit(0.0))


def profiles(prepared: DataFrame, side: str) -> DataFrame:
    cols = ["name_norm", "name_core", "addr_norm", "postal", "country"]
    arrays = {"nt": tokens(F.col("name_norm")), "ng": char_ngrams(F.col("name_norm")), "at": tokens(F.col("addr_norm")), "ag": char_ngrams(F.col("addr_norm"))}
    return prepared.select(F.col("entity_id").alias(f"id{side}"), *[F.col(c).alias(f"{c}{side}") for c in cols], *[v.alias(f"{k}{side}") for k, v in arrays.items()])


def attach(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs with both records' profiles; pairs of unknown ids are dropped. Ids must be unique on each side."""
    p = pairs.select("source1_entity_id", "candidate_entity_id", "blocking_score")
    return p.join(profiles(left, "1"), F.col("source1_entity_id") == F.col("id1")).join(profiles(right, "2"), F.col("candidate_entity_id") == F.col("id2"))


def native_features(attached: DataFrame) -> DataFrame:
    """The features that built-in functions compute, with the texts the others need."""
    c = F.col
    return attached.select(
        "source1_entity_id",
        "candidate_entity_id",
        jaccard(c("nt1"), c("nt2")).alias("name_token_jaccard"),
        jaccard(c("ng1"), c("ng2")).alias("name_char3_jaccard"),
        len_diff(c("name_norm1"), c("name_norm2")).alias("name_len_diff"),
        equal_nonblank(c("name_norm1"), c("name_norm2")).alias("name_exact"),
        equal_nonblank(c("name_core1"), c("name_core2")).alias("name_core_exact"),
        jaccard(c("at1"), c("at2")).alias("addr_token_jaccard"),
        jaccard(c("ag1"), c("ag2")).alias("addr_char3_jaccard"),
        len_diff(c("addr_norm1"), c("addr_norm2")).alias("addr_len_diff"),
        equal_nonblank(c("postal1"), c("postal2")).alias("postal_match"),
        F.when((c("postal1") != "") & (c("postal2") != ""), 1.0).otherwise(0.0).alias("postal_both_present"),
        F.when(c("country1") == c("country2"), 1.0).otherwise(0.0).alias("country_match"),
        "blocking_score",
        "name_norm1",
        "name_norm2",
        "addr_norm1",
        "addr_norm2",
    )


def pair_features(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """(source1_entity_id, candidate_entity_id, the nineteen features)."""
    n = native_features(attach(pairs, left, right))
    # one Python stage; nothing downstream filters on its output, so it is not evaluated twice
    f = n.withColumn("_f", fuzzy_scores(F.col("name_norm1"), F.col("name_norm2"), F.col("addr_norm1"), F.col("addr_norm2")))
    return f.select("source1_entity_id", "candidate_entity_id", *[F.col(f"_f.{x}") if x in FUZZY else F.col(x) for x in FEATURE_NAMES])


def with_labels(pairs: DataFrame, truth_pairs: DataFrame) -> DataFrame:
    """Adds label: 1 if the pair is in truth_pairs (s1_id, cand_id), else 0."""
    t = truth_pairs.select(F.col("s1_id").alias("source1_entity_id"), F.col("cand_id").alias("candidate_entity_id"), F.lit(1).alias("_t")).distinct()
    return pairs.join(t, ["source1_entity_id", "candidate_entity_id"], "left").withColumn("label", F.coalesce("_t", F.lit(0))).drop("_t")

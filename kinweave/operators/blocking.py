"""Candidate pairs of records by several blocking signals.

Country and source are join keys, never loops: s1 holds prepared records of the
left table, ref those of all others with a column src. With same_country_only
False the country key is a constant.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinweave.operators.neighbours import lists_within, pairs_within
from kinweave.operators.topk import best_of_lists
from kinweave.session import cut, union_all

KEYS = ["src", "country"]


@dataclass(frozen=True)
class BlockingConfig:
    """Parameters that must be the same in training and inference."""

    top_k: int = 30
    same_country_only: bool = True
    window: int = 40
    max_group_size: int = 2000
    min_token_len: int = 3


def key_counts(ref: DataFrame, key: str, by: list[str] = KEYS) -> DataFrame:
    """Rows of each non-blank key on the reference side."""
    return ref.where(F.col(key) != "").groupBy(*by, F.col(key).alias("key")).agg(F.count("*").alias("n"))


def allowed_keys(ref: DataFrame, key: str, cap: int | None) -> DataFrame:
    counts = key_counts(ref, key)
    return counts if cap is None else counts.where(F.col("n") <= cap)


def _pairs(joined: DataFrame, score: Column) -> DataFrame:
    return joined.select(F.col("left_id").alias("source1_entity_id"), F.col("right_id").alias("candidate_entity_id"), F.col("src").alias("source"), "country", score.alias("blocking_score"))


def exact_key_pairs(s1: DataFrame, ref: DataFrame, key: str, cap: int | None = 2000, score: float = 1.0) -> DataFrame:
    """Pairs with an equal non-blank key, unless more than cap reference rows of the source and country have it."""
    ok = allowed_keys(ref, key, cap).select(*KEYS, "key")
    right = ref.select(*KEYS, F.col("entity_id").alias("right_id"), F.col(key).alias("key")).join(ok, [*KEYS, "key"], "left_semi")
    left = s1.where(F.col(key) != "").select("country", F.col("entity_id").alias("left_id"), F.col(key).alias("key"))
    return _pairs(left.join(right, ["country", "key"]), F.lit(score))


def _tokens(df: DataFrame, column: str, min_len: int, by: list[str]) -> DataFrame:
    """Tokens with how often each record repeats them: repeated tokens count each time."""
    t = df.select(*by, "entity_id", F.explode(F.split(column, " ")).alias("key")).where(F.length("key") >= min_len)
    return t.groupBy(*by, "entity_id", "key").agg(F.count("*").alias("m"))


def token_weights(ref: DataFrame, column: str = "name_core", cap: int | None = 2000, min_len: int = 3) -> DataFrame:
    """(src, country, key, n, weight): tokens within the cap, the rarer the heavier, 1 for the rarest of a source and country."""
    n = _tokens(ref, column, min_len, KEYS).groupBy(*KEYS, "key").agg(F.sum("m").alias("n"))
    kept = n if cap is None else n.where(F.col("n") <= cap)
    raw = 1.0 / F.log1p(F.col("n") + 1.0)
    # weight falls with n, so the rarest token of a partition has the greatest; the aggregate is tiny beside the tokens
    least = kept.groupBy(*KEYS).agg(F.min("n").alias("least"))
    return kept.join(least, KEYS).select(*KEYS, "key", "n", (raw * F.log1p(F.col("least") + 1.0)).alias("weight"))


def token_pairs(s1: DataFrame, ref: DataFrame, column: str = "name_core", cap: int | None = 2000, min_len: int = 3) -> DataFrame:
    """Pairs that share tokens, scored by the sum of their weights, at most 1."""
    weights = token_weights(ref, column, cap, min_len).select(*KEYS, "key", "weight")
    right = _tokens(ref, column, min_len, KEYS).join(weights, [*KEYS, "key"]).select(*KEYS, "key", F.col("entity_id").alias("right_id"), (F.col("m") * F.col("weight")).alias("w"))
    left = _tokens(s1, column, min_len, ["country"]).select("country", "key", F.col("entity_id").alias("left_id"), "m")
    summed = left.join(right, ["country", "key"]).groupBy("left_id", "right_id", *KEYS).agg(F.sum(F.col("m") * F.col("w")).alias("s"))
    return _pairs(summed, F.least(F.lit(1.0), F.col("s")))


def _in_order(s1: DataFrame, ref: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    sides = s1.select("country", F.col("entity_id").alias("id"), F.col(column).alias("key")).withColumn("side", F.lit(0))
    # left records stand in the order of every source once
    left = sides.withColumn("src", F.explode(F.array(*[F.lit(r["src"]) for r in ref.select("src").distinct().collect()]).cast("array<string>")))
    return left, ref.select("country", F.col("entity_id").alias("id"), F.col(column).alias("key"), F.lit(1).alias("side"), "src")


def neighbourhood_pairs(s1: DataFrame, ref: DataFrame, column: str, window: int = 40) -> DataFrame:
    """Pairs of opposite sides at most window rows apart in the order of column within their source and country, scored 1 / distance. Ties: left records first, then by id."""
    left, right = _in_order(s1, ref, column)
    near = pairs_within(left.unionByName(right), KEYS, "key", "side", "id", window)
    return _pairs(near, 1.0 / F.col("distance"))


def neighbourhood_lists(s1: DataFrame, ref: DataFrame, column: str, worth: list[float], floors: DataFrame) -> DataFrame:
    """(src, country, left_id, items): the pairs of neighbourhood_pairs as lists of (right_id, below), below the negative worth of their distance. Pairs below the floors (src, country, left_id, floor) of their left records may be left out."""
    left, right = _in_order(s1, ref, column)
    # one more than the inverse, so that rounded scores don't matter
    far = F.ceil(1.0 / F.col("floor")) + 1
    left = left.join(floors.select(*KEYS, F.col("left_id").alias("id"), far.alias("reach")), [*KEYS, "id"], "left")
    return lists_within(left.unionByName(right.withColumn("reach", F.lit(None).cast("long"))), KEYS, "key", "side", "id", worth, reach="reach")


SIGNALS = ["block_key", "postal", "token", "neighbours_name", "neighbours_reversed", "neighbours_address"]


def signal_pairs(s1: DataFrame, ref: DataFrame, config: BlockingConfig, cap: int | None = -1) -> dict[str, DataFrame]:
    """The pairs of each of the six signals, before any top-k. cap overrides the group size."""
    cap = config.max_group_size if cap == -1 else cap
    return {
        "block_key": exact_key_pairs(s1, ref, "block_key", cap, 1.0),
        "postal": exact_key_pairs(s1, ref, "postal", cap, 0.9),
        "token": token_pairs(s1, ref, "name_core", cap, config.min_token_len),
        "neighbours_name": neighbourhood_pairs(s1, ref, "name_core", config.window),
        "neighbours_reversed": neighbourhood_pairs(s1, ref, "name_core_rev", config.window),
        "neighbours_address": neighbourhood_pairs(s1, ref, "addr_norm", config.window),
    }


def partitioned(df: DataFrame, same_country_only: bool) -> DataFrame:
    return df if same_country_only else df.withColumn("country", F.lit("*"))


def key_lists(right: DataFrame, by: list[str], k: int) -> DataFrame:
    """(by, n, ids): how many ids each key of (by, right_id) has, and the k smallest of them."""
    key = W.partitionBy(*by)
    ranked = right.distinct().select(*by, "right_id", F.count("*").over(key).alias("n"), F.row_number().over(key.orderBy("right_id")).alias("_rank")).where(F.col("_rank") <= k)
    return ranked.groupBy(*by).agg(F.first("n").alias("n"), F.collect_list(F.struct("right_id")).alias("ids"))


def token_couples(left: DataFrame, right: DataFrame) -> DataFrame:
    """(left_id, right_id, src, country, s): pairs that share two tokens or more of (src, country, id, key, m) and (..., w), s the sum of m w over all they share."""

    def couples(t: DataFrame, id_col: str, value: str) -> DataFrame:
        held = t.groupBy(*KEYS, id_col).agg(F.collect_list(F.struct("key", value)).alias("held")).where(F.size("held") > 1)
        first = held.select(*KEYS, id_col, "held", F.explode("held").alias("x"))
        both = first.select(*KEYS, id_col, "x", F.explode(F.filter("held", lambda y: y["key"] > F.col("x.key"))).alias("y"))
        return both.select(*KEYS, id_col, F.col("x.key").alias("key1"), F.col("y.key").alias("key2"), F.col(f"x.{value}").alias(f"{value}1"), F.col(f"y.{value}").alias(f"{value}2"))

    met = couples(left, "left_id", "m").hint("merge").join(couples(right, "right_id", "w").hint("merge"), [*KEYS, "key1", "key2"])
    # j shared tokens make n = j (j - 1) / 2 couples, and each token is in j - 1 of them
    summed = met.groupBy("left_id", "right_id", *KEYS).agg(F.sum(F.col("m1") * F.col("w1") + F.col("m2") * F.col("w2")).alias("s"), F.count("*").alias("n"))
    others = (F.sqrt(1.0 + 8.0 * F.col("n")) - 1.0) / 2.0
    return summed.select("left_id", "right_id", *KEYS, (F.col("s") / F.round(others)).alias("s"))


def leading_lists(s1: DataFrame, ref: DataFrame, config: BlockingConfig, digits: int | None = None) -> DataFrame:
    """(left_id, src, country, items): of the pairs of all signals those that can be among the top_k of their left record in a source and country, as lists of (right_id, below), below the negative score.

    A reference record that shares one key of a kind with a left record (a block key, a postal code, a token so many times) ties
    with all that share it alike; top_k of them with smaller ids leave no place for it. So a key's list of its top_k smallest ids is enough; records
    that share several tokens are found by couples of tokens. The best score that top_k records of one list reach is the left
    record's floor, below which no pair of any signal is among its top_k. Lists stay lists until all that a left record has is in one task.
    """
    k, cap = config.top_k, config.max_group_size
    score = lambda s: F.round(F.least(F.lit(1.0), s), digits) if digits is not None else F.least(F.lit(1.0), s)
    weights = token_weights(ref, "name_core", cap, config.min_token_len).select(*KEYS, "key", "weight")
    words = cut(_tokens(ref, "name_core", config.min_token_len, KEYS).join(weights, [*KEYS, "key"]).select(*KEYS, "key", F.col("entity_id").alias("right_id"), (F.col("m") * F.col("weight")).alias("w")))
    own_words = cut(_tokens(s1, "name_core", config.min_token_len, ["country"]).select("country", "key", F.col("entity_id").alias("left_id"), "m"))
    rights, lefts = [words.withColumn("kind", F.lit("token"))], [own_words.withColumn("kind", F.lit("token"))]
    for kind, worth in (("block_key", 1.0), ("postal", 0.9)):
        ok = allowed_keys(ref, kind, cap).select(*KEYS, "key")
        right = ref.select(*KEYS, F.col("entity_id").alias("right_id"), F.col(kind).alias("key")).join(ok, [*KEYS, "key"], "left_semi")
        rights.append(right.withColumns({"w": F.lit(worth), "kind": F.lit(kind)}))
        lefts.append(s1.where(F.col(kind) != "").select("country", F.col("entity_id").alias("left_id"), F.col(kind).alias("key"), F.lit(1).cast("long").alias("m"), F.lit(kind).alias("kind")).distinct())
    group = [*KEYS, "kind", "key", "w"]
    lists = cut(key_lists(union_all(rights), group, k))
    shared = union_all(lefts).join(lists.drop("ids"), ["country", "kind", "key"]).select(*group, "left_id", "n", score(F.col("m") * F.col("w")).alias("score"))
    floors = cut(shared.where(F.col("n") >= k).groupBy(*KEYS, "left_id").agg(F.max("score").alias("floor")))
    above = lambda pairs: pairs.join(floors, [*KEYS, "left_id"], "left").where(F.col("score") >= F.coalesce("floor", F.lit(0.0)))
    listed = above(shared).select(*group, "left_id", "score").hint("merge").join(lists.select(*group, "ids").hint("merge"), group)
    known = own_words.join(words.select(*KEYS, "key").distinct(), ["country", "key"])
    couples = above(token_couples(known, words).withColumn("score", score(F.col("s"))))
    item = lambda x, s: F.struct(x["right_id"].alias("right_id"), (-s).alias("below"))
    parts = [
        listed.select("left_id", *KEYS, F.transform("ids", lambda x: item(x, F.col("score"))).alias("items")),
        couples.select("left_id", *KEYS, F.array(item(F.struct("right_id"), F.col("score"))).alias("items")),
    ]
    # the score of each distance, rounded as all others are
    worth = s1.sparkSession.range(1).select(F.array(*[score(F.lit(1.0) / F.lit(d)) for d in range(1, config.window + 1)])).first()[0]
    for column in ("name_core", "name_core_rev", "addr_norm"):
        parts.append(neighbourhood_lists(s1, ref, column, worth, floors).select("left_id", *KEYS, "items"))
    return union_all(parts)


def leading_pairs(s1: DataFrame, ref: DataFrame, config: BlockingConfig, digits: int | None = None) -> DataFrame:
    """(source1_entity_id, candidate_entity_id, source, country, blocking_score): the pairs of leading_lists."""
    met = leading_lists(s1, ref, config, digits).select("left_id", *KEYS, F.explode("items").alias("_c"))
    return _pairs(met.select("left_id", "_c.right_id", *KEYS, "_c.below"), -F.col("below"))


def generate_candidates(s1: DataFrame, ref: DataFrame, config: BlockingConfig = BlockingConfig(), digits: int | None = None) -> DataFrame:
    """(source1_entity_id, candidate_entity_id, source, blocking_score): the best candidates of every left record in each source, over all signals."""
    s1, ref = partitioned(s1, config.same_country_only), partitioned(ref, config.same_country_only)
    best = best_of_lists(leading_lists(s1, ref, config, digits), ["left_id", *KEYS], config.top_k)
    return _pairs(best, F.col("score")).drop("country")


def prepared_tables(s1: DataFrame, others: dict[str, DataFrame], prepare) -> tuple[DataFrame, DataFrame]:
    """(left, ref) prepared once and cut, since every signal reads them."""
    ref = union_all([prepare(df).withColumn("src", F.lit(src)) for src, df in others.items()])
    return cut(prepare(s1)), cut(ref)

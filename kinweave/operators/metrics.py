"""Recall of candidates, F-beta of matches, threshold and parameter choice, and why matches were missed.

Truth is two tables: spine(s1_id), one row for each known record, which keeps
those without a match, and pairs(s1_id, cand_id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions.text import parse_id_list
from kinweave.operators.blocking import KEYS, SIGNALS, BlockingConfig, _tokens, key_counts, partitioned, signal_pairs
from kinweave.session import union_all

GRID = [round(0.05 + 0.02 * i, 2) for i in range(46)]


def truth_tables(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(spine, pairs) of a table (source1_entity_id, matched_entity_ids). Rows of one record are joined; null ids are dropped."""
    rows = labels.where(F.col("source1_entity_id").isNotNull()).select(F.col("source1_entity_id").alias("s1_id"), parse_id_list(F.col("matched_entity_ids")).alias("ids"))
    return rows.select("s1_id").distinct(), rows.select("s1_id", F.explode("ids").alias("cand_id")).distinct()


def _pairs(candidates: DataFrame) -> DataFrame:
    return candidates.select(F.col("source1_entity_id").alias("s1_id"), F.col("candidate_entity_id").alias("cand_id")).distinct()


def found_pairs(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Truth pairs with found, 1 or 0."""
    return pairs.join(_pairs(candidates).withColumn("_f", F.lit(1)), ["s1_id", "cand_id"], "left").select("s1_id", "cand_id", F.coalesce("_f", F.lit(0)).alias("found"))


def share(part: Column, whole: Column, empty: float) -> Column:
    return F.when(whole > 0, part / F.greatest(whole, F.lit(1))).otherwise(F.lit(empty))


def blocking_recall(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row: candidate_recall (1 without truth), total_true_matches, total_found, entities_with_missed_matches."""
    per = found_pairs(pairs, candidates).groupBy("s1_id").agg(F.count("*").alias("n"), F.sum("found").alias("f"))
    total = per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_true_matches"), F.coalesce(F.sum("f"), F.lit(0)).cast("long").alias("total_found"), F.count_if(F.col("f") < F.col("n")).alias("entities_with_missed_matches")
    )
    return total.select(share(F.col("total_found"), F.col("total_true_matches"), 1.0).alias("candidate_recall"), "total_true_matches", "total_found", "entities_with_missed_matches")


def recall_by_country(s1: DataFrame, pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Per country of the left record: n_entities_with_matches, total_true_matches, total_found, recall."""
    home = s1.select(F.col("entity_id").alias("s1_id"), F.coalesce("country", F.lit("")).alias("country")).distinct()
    per = found_pairs(pairs, candidates).groupBy("s1_id").agg(F.count("*").alias("n"), F.sum("found").alias("f")).join(home, "s1_id", "left")
    grouped = per.groupBy(F.coalesce("country", F.lit("")).alias("country")).agg(F.count("*").alias("n_entities_with_matches"), F.sum("n").alias("total_true_matches"), F.sum("f").alias("total_found"))
    return grouped.withColumn("recall", share(F.col("total_found"), F.col("total_true_matches"), 0.0))


def per_signal_recall(s1: DataFrame, ref: DataFrame, pairs: DataFrame, config: BlockingConfig) -> DataFrame:
    """Recall of each signal before top-k and of their union (UNION); a signal without pairs has recall 0."""
    signals = signal_pairs(partitioned(s1, config.same_country_only), partitioned(ref, config.same_country_only), config)
    tagged = union_all([_pairs(p).withColumn("signal", F.lit(name)) for name, p in signals.items()])
    hits = tagged.join(pairs, ["s1_id", "cand_id"])
    each = hits.groupBy("signal").agg(F.count("*").alias("found"))
    union = hits.select("s1_id", "cand_id").distinct().agg(F.count("*").alias("found")).select(F.lit("UNION").alias("signal"), "found")
    spine = s1.sparkSession.createDataFrame([(x,) for x in [*SIGNALS, "UNION"]], "signal string")
    total = pairs.agg(F.count("*").alias("total"))
    return spine.join(each.unionByName(union), "signal", "left").crossJoin(F.broadcast(total)).select("signal", F.coalesce("found", F.lit(0)).cast("long").alias("found"), share(F.coalesce("found", F.lit(0)), F.col("total"), 1.0).alias("recall"))


def cap_victims(s1: DataFrame, ref: DataFrame, pairs: DataFrame, config: BlockingConfig, per_source: bool = False) -> DataFrame:
    """(kind, matched_under_cap, dropped_by_cap, no_shared_key, missing_ids) for block_key, postal and token over the truth pairs.

    Keys are counted over all reference sources together, by the left record's country; per_source counts each source for itself, as blocking does.
    """
    by = KEYS if per_source else ["country"]
    left = s1.select(F.col("entity_id").alias("s1_id"), "country", *[F.col(k).alias(f"{k}_1") for k in ("block_key", "postal", "name_core")])
    right = ref.select(F.col("entity_id").alias("cand_id"), "src", *[F.col(k).alias(f"{k}_2") for k in ("block_key", "postal", "name_core")])
    known = pairs.join(left, "s1_id").join(right, "cand_id")
    lost = pairs.join(left.select("s1_id"), "s1_id", "left").join(right.select("cand_id", F.lit(1).alias("r")), "cand_id", "left").join(left.select("s1_id", F.lit(1).alias("l")), "s1_id", "left")
    missing = lost.where(F.col("r").isNull() | F.col("l").isNull()).agg(F.count("*").alias("missing_ids"))
    parts = []
    for k in ("block_key", "postal"):
        shared = known.where((F.col(f"{k}_1") == F.col(f"{k}_2")) & (F.col(f"{k}_1") != "")).withColumn("key", F.col(f"{k}_1")).join(key_counts(ref, k, by), [*by, "key"], "left")
        parts.append(shared.select(F.lit(k).alias("kind"), "s1_id", "cand_id", (F.coalesce("n", F.lit(0)) <= config.max_group_size).cast("int").alias("under")))
    n = _tokens(ref, "name_core", config.min_token_len, by).groupBy(*by, "key").agg(F.sum("m").alias("n"))
    words = known.select("s1_id", "cand_id", "src", "country", F.explode(F.array_intersect(F.split("name_core_1", " "), F.split("name_core_2", " "))).alias("key")).where(F.length("key") >= config.min_token_len)
    shared = words.join(n, [*by, "key"], "left").groupBy("s1_id", "cand_id").agg(F.max((F.coalesce("n", F.lit(0)) <= config.max_group_size).cast("int")).alias("under"))
    parts.append(shared.select(F.lit("token").alias("kind"), "s1_id", "cand_id", "under"))
    counts = union_all(parts).groupBy("kind").agg(F.count_if(F.col("under") == 1).alias("a"), F.count_if(F.col("under") == 0).alias("b"))
    total = known.agg(F.count("*").alias("t")).crossJoin(missing)
    kinds = s1.sparkSession.createDataFrame([("block_key",), ("postal",), ("token",)], "kind string")
    a, b = (F.coalesce(c, F.lit(0)).cast("long") for c in ("a", "b"))
    return kinds.join(counts, "kind", "left").crossJoin(F.broadcast(total)).select("kind", a.alias("matched_under_cap"), b.alias("dropped_by_cap"), (F.col("t") - a - b).alias("no_shared_key"), "missing_ids")


def cross_country_matches(s1: DataFrame, others: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row, n: truth pairs whose records' raw countries differ. Two null countries differ; an unknown id has no country; two unknown ids don't count."""
    a = s1.select(F.col("entity_id").alias("s1_id"), F.col("country").alias("c1"), F.lit(True).alias("k1")).distinct()
    b = others.select(F.col("entity_id").alias("cand_id"), F.col("country").alias("c2"), F.lit(True).alias("k2")).distinct()
    j = pairs.join(a, "s1_id", "left").join(b, "cand_id", "left")
    return j.where((F.col("k1").isNotNull() | F.col("k2").isNotNull()) & (F.col("c1").isNull() | F.col("c2").isNull() | (F.col("c1") != F.col("c2")))).agg(F.count("*").alias("n"))


def f_beta(precision: Column, recall: Column, beta: float = 0.5) -> Column:
    """0 where precision and recall are 0."""
    below = beta * beta * precision + recall
    return F.when(below > 0, (1 + beta * beta) * precision * recall / F.when(below > 0, below).otherwise(1.0)).otherwise(0.0)


def entity_score(n_pred: Column, n_true: Column, n_hit: Column, beta: float = 0.5) -> Column:
    """1 if neither side has ids, 0 if only one has, else F-beta."""
    p, r = n_hit / F.greatest(n_pred, F.lit(1)), n_hit / F.greatest(n_true, F.lit(1))
    return F.when((n_pred == 0) & (n_true == 0), 1.0).when((n_pred == 0) | (n_true == 0), 0.0).otherwise(f_beta(p, r, beta))


def entity_counts(spine: DataFrame, pairs: DataFrame, predicted: DataFrame) -> DataFrame:
    """(s1_id, n_true, n_pred, n_hit) for every record of the spine."""
    pred = _pairs(predicted)
    t = pairs.groupBy("s1_id").agg(F.count("*").alias("n_true"))
    h = pred.join(pairs.withColumn("_h", F.lit(1)), ["s1_id", "cand_id"], "left").groupBy("s1_id").agg(F.count("*").alias("n_pred"), F.count("_h").alias("n_hit"))
    return spine.join(t, "s1_id", "left").join(h, "s1_id", "left").na.fill(0, ["n_true", "n_pred", "n_hit"])


def macro_f_beta(spine: DataFrame, pairs: DataFrame, predicted: DataFrame, beta: float = 0.5) -> DataFrame:
    """One row, macro_f_beta: the mean score over all records of the spine; 0 without any. Predictions for others are ignored."""
    s = entity_score(F.col("n_pred"), F.col("n_true"), F.col("n_hit"), beta)
    return entity_counts(spine, pairs, predicted).agg(F.coalesce(F.avg(s), F.lit(0.0)).alias("macro_f_beta"))


def threshold_sweep(spine: DataFrame, pairs: DataFrame, scored: DataFrame, prob: str = "prob", beta: float = 0.5, grid: list[float] | None = None) -> DataFrame:
    """(threshold, macro_f_beta), best first, ties by the lower threshold.

    One pass: each scored pair counts for all thresholds up to its probability, which for a sorted grid is one number, so
    records get a row for each step at which their counts change and never one for each threshold and pair.
    """
    grid = sorted(grid or GRID)
    # number of grid points that the pair passes
    level = sum((F.when(F.col(prob) >= t, 1).otherwise(0) for t in grid), F.lit(0))
    t = pairs.withColumn("_h", F.lit(1))
    p = scored.select(F.col("source1_entity_id").alias("s1_id"), F.col("candidate_entity_id").alias("cand_id"), level.alias("level")).groupBy("s1_id", "cand_id").agg(F.max("level").alias("level"))
    hist = p.join(t, ["s1_id", "cand_id"], "left").groupBy("s1_id", "level").agg(F.count("*").alias("n"), F.count("_h").alias("h"))
    per = hist.groupBy("s1_id").agg(F.collect_list(F.struct("level", "n", "h")).alias("steps"))  # at most one for each grid point
    all_ = spine.join(pairs.groupBy("s1_id").agg(F.count("*").alias("n_true")), "s1_id", "left").join(per, "s1_id", "left")
    g = F.posexplode(F.array(*map(F.lit, grid))).alias("i", "threshold")
    rows = all_.select("s1_id", F.coalesce("n_true", F.lit(0)).alias("n_true"), "steps", g)
    zero = F.lit(0).cast("long")
    pred = F.coalesce(F.aggregate(F.filter("steps", lambda x: x["level"] > F.col("i")), zero, lambda s, x: s + x["n"]), zero)
    hit = F.coalesce(F.aggregate(F.filter("steps", lambda x: x["level"] > F.col("i")), zero, lambda s, x: s + x["h"]), zero)
    scores = rows.select("threshold", entity_score(pred, F.col("n_true"), hit, beta).alias("s"))
    return scores.groupBy("threshold").agg(F.avg("s").alias("macro_f_beta")).orderBy(F.desc("macro_f_beta"), "threshold")


def best_threshold(sweep: DataFrame) -> tuple[float, float]:
    r = sweep.first()
    return (r["threshold"], r["macro_f_beta"]) if r else (0.5, 0.0)

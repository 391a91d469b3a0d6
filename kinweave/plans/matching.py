"""Queries of record matching, each over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions import text as T
from kinweave.functions.fuzzy import FUZZY
from kinweave.operators import blocking as B
from kinweave.operators import metrics as M
from kinweave.operators import nearest as N
from kinweave.operators import topk as K
from kinweave.operators.features import FEATURE_NAMES, attach, native_features, pair_features, with_labels
from kinweave.operators.learning import TreeConfig, fold_of, out_of_fold
from kinweave.session import cut, read_table, union_all

CONFIG = B.BlockingConfig()
SCORES = ["source1_entity_id", "candidate_entity_id", "source", "blocking_score"]
Query = Callable[[SparkSession, str], DataFrame]


def sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    t = {f"S{i}": read_table(spark, d, f"train_source{i}") for i in (1, 2, 3)}
    return B.prepared_tables(t["S1"], {"S2": t["S2"], "S3": t["S3"]}, T.prepare)


def others(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "train_source2").unionByName(read_table(spark, d, "train_source3"))


def all_records(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "train_source1").unionByName(others(spark, d))


def truth(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return M.truth_tables(read_table(spark, d, "train_labels"))


def rounded(pairs: DataFrame) -> DataFrame:
    return pairs.select("source1_entity_id", "candidate_entity_id", "source", F.round("blocking_score", 6).alias("blocking_score"))


def known_pairs(spark: SparkSession, d: str) -> DataFrame:
    """candidate_pairs with both ids and a score."""
    p = read_table(spark, d, "candidate_pairs").select(*SCORES)
    ids = F.upper(F.trim("source1_entity_id"))
    return p.withColumn("source1_entity_id", ids).where("source1_entity_id <> '' AND candidate_entity_id <> '' AND blocking_score IS NOT NULL AND NOT isnan(blocking_score)")


# Texts


def basic_clean(spark: SparkSession, d: str) -> DataFrame:
    return all_records(spark, d).select("entity_id", T.basic_clean(F.col("business_name")).alias("name_clean"), T.basic_clean(F.col("business_address")).alias("addr_clean")).distinct()


def prepared(columns: list[str]) -> Query:
    return lambda spark, d: T.prepare(all_records(spark, d)).select("entity_id", *columns)


def char_ngrams(spark: SparkSession, d: str) -> DataFrame:
    p = T.prepare(all_records(spark, d))
    return p.select("entity_id", F.size(T.tokens(F.col("name_norm"))).alias("n_tokens"), F.array_join(F.array_sort(T.char_ngrams(F.col("name_norm"))), "|").alias("grams"))


def parse_id_list(spark: SparkSession, d: str) -> DataFrame:
    ids = T.parse_id_list(F.col("matched_entity_ids"))
    return read_table(spark, d, "train_labels").select("source1_entity_id", F.size(ids).alias("n_ids"), F.array_join(ids, "|").alias("ids"))


def prepare_text(spark: SparkSession, d: str) -> DataFrame:
    p = T.prepare_text(all_records(spark, d), "name_address")
    return p.select("entity_id", "country", F.concat(F.lit(T.default_prefixes("intfloat/multilingual-e5-small")[1]), "text").alias("text"), T.source_of(F.col("entity_id")).alias("source"))


# Blocking


def exact_key_join(key: str, score: float) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        left, ref = sides(spark, d)
        return rounded(B.exact_key_pairs(left, ref, key, CONFIG.max_group_size, score))

    return run


def key_frequency(spark: SparkSession, d: str) -> DataFrame:
    return B.key_counts(sides(spark, d)[1], "block_key")


def group_size_cap(spark: SparkSession, d: str) -> DataFrame:
    return B.allowed_keys(sides(spark, d)[1], "postal", 2)


def token_weights(spark: SparkSession, d: str) -> DataFrame:
    w = B.token_weights(sides(spark, d)[1], cap=CONFIG.max_group_size)
    return w.select("src", "country", "key", "n", F.round("weight", 6).alias("weight"))


def token_join(spark: SparkSession, d: str) -> DataFrame:
    left, ref = sides(spark, d)
    return rounded(B.token_pairs(left, ref, cap=CONFIG.max_group_size))


def sorted_neighbourhood(column: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        left, ref = sides(spark, d)
        return rounded(B.neighbourhood_pairs(left, ref, column, CONFIG.window))

    return run


def generate_candidates(spark: SparkSession, d: str, config: B.BlockingConfig = CONFIG) -> DataFrame:
    left, ref = sides(spark, d)
    return B.generate_candidates(left, ref, config, digits=6)


def cap_top_k_per_source(spark: SparkSession, d: str) -> DataFrame:
    return K.cap_per_source(known_pairs(spark, d).withColumn("source", T.source_of(F.col("candidate_entity_id"))), 5)


def cap_top_k_global(spark: SparkSession, d: str) -> DataFrame:
    return K.cap_global(known_pairs(spark, d), 5)


def merge_candidates(spark: SparkSession, d: str) -> DataFrame:
    left, ref = sides(spark, d)
    return K.merge_candidates(known_pairs(spark, d), B.exact_key_pairs(left, ref, "block_key", CONFIG.max_group_size, 1.0), k=CONFIG.top_k)


def joined_id_lists(spark: SparkSession, d: str) -> DataFrame:
    spine = read_table(spark, d, "train_source1").select(F.col("entity_id").alias("source1_entity_id")).distinct()
    return K.joined_lists(known_pairs(spark, d).where("blocking_score >= 0.9"), spine)


# Features and learning


def pairs_and_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    left, ref = sides(spark, d)
    return K.distinct_pairs(known_pairs(spark, d)), left, ref


def pair_features_native(spark: SparkSession, d: str) -> DataFrame:
    f = native_features(attach(*pairs_and_sides(spark, d))).drop("name_norm1", "name_norm2", "addr_norm1", "addr_norm2")
    return f.select("source1_entity_id", "candidate_entity_id", *[F.round(c, 6).alias(c) for c in f.columns[2:]])


def pair_features_all(spark: SparkSession, d: str) -> DataFrame:
    return pair_features(*pairs_and_sides(spark, d)).select("source1_entity_id", "candidate_entity_id", *[F.round(c, 6).alias(c) for c in FEATURE_NAMES])


def labels(spark: SparkSession, d: str) -> DataFrame:
    return with_labels(K.distinct_pairs(known_pairs(spark, d)).select("source1_entity_id", "candidate_entity_id"), truth(spark, d)[1])


def positive_rate(spark: SparkSession, d: str) -> DataFrame:
    return labels(spark, d).agg(F.count("*").alias("n"), F.sum("label").alias("positives"), F.round(F.avg("label"), 6).alias("rate"))


def gbt_scores(spark: SparkSession, d: str) -> DataFrame:
    """Out-of-fold probabilities of the pairs of labelled records, 20 rounds and 3 folds."""
    pairs, left, ref = pairs_and_sides(spark, d)
    spine, pos = truth(spark, d)
    known = pairs.join(spine.select(F.col("s1_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")
    return out_of_fold(with_labels(pair_features(known, left, ref), pos), TreeConfig(rounds=20, folds=3))[0]


# Metrics


def blocking_recall(spark: SparkSession, d: str) -> DataFrame:
    r = M.blocking_recall(truth(spark, d)[1], known_pairs(spark, d))
    return r.withColumn("candidate_recall", F.round("candidate_recall", 6))


def recall_by_country(spark: SparkSession, d: str) -> DataFrame:
    r = M.recall_by_country(read_table(spark, d, "train_source1"), truth(spark, d)[1], known_pairs(spark, d))
    return r.withColumn("recall", F.round("recall", 6))


def per_signal_recall(spark: SparkSession, d: str) -> DataFrame:
    left, ref = sides(spark, d)
    return M.per_signal_recall(left, ref, cut(truth(spark, d)[1]), CONFIG).withColumn("recall", F.round("recall", 6))


def cap_victims(spark: SparkSession, d: str, per_source: bool = False) -> DataFrame:
    left, ref = sides(spark, d)
    return M.cap_victims(left, ref, cut(truth(spark, d)[1]), CONFIG, per_source)


def cross_country(spark: SparkSession, d: str) -> DataFrame:
    return M.cross_country_matches(read_table(spark, d, "train_source1"), others(spark, d), truth(spark, d)[1])


def macro_f_beta(spark: SparkSession, d: str) -> DataFrame:
    spine, pos = truth(spark, d)
    r = M.macro_f_beta(spine, pos, known_pairs(spark, d).where("blocking_score >= 0.9"))
    return r.select(F.round("macro_f_beta", 6).alias("macro_f_beta"))


def threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    spine, pos = truth(spark, d)
    return M.threshold_sweep(spine, pos, known_pairs(spark, d), "blocking_score").select("threshold", F.round("macro_f_beta", 6).alias("macro_f_beta"))


# Nearest neighbours: queries are the rows whose id is divisible by 100, searched among all rows


def _vectors(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    base = read_table(spark, d, "embeddings").select("label", F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return base.where(F.col("id") % 100 == 0), base


def _found(df: DataFrame) -> DataFrame:
    return df.select("label", "left_id", "right_id", F.round("score", 6).alias("score"), "rank")


def flat_ann_topk(spark: SparkSession, d: str) -> DataFrame:
    return _found(N.flat_search(*_vectors(spark, d), 10, ["label"]))


def _ann(spark: SparkSession, d: str, pq_parts: int | None) -> DataFrame:
    """The ten nearest in one index over all vectors, at default settings, also where the table is small enough for exact search."""
    asked, base = _vectors(spark, d)
    return N.ivf_search(asked.drop("label"), base.drop("label"), 10, [], pq_parts=pq_parts, flat_rows=0)


def ann_ivf(spark: SparkSession, d: str) -> DataFrame:
    return _ann(spark, d, None).select("left_id", "right_id", F.round("score", 6).alias("score"), "rank")


def ann_ivfpq(spark: SparkSession, d: str) -> DataFrame:
    return _ann(spark, d, 16).select("left_id", "right_id", F.round("score", 6).alias("score"), "rank")


def ann_recall(spark: SparkSession, d: str) -> DataFrame:
    """Whether ann_ivf and ann_ivfpq find nine tenths of what exact search finds."""
    asked, base = (t.drop("label") for t in _vectors(spark, d))
    exact = cut(N.flat_search(asked, base, 10, []))
    rows = [N.recall_of(_ann(spark, d, parts), exact, []).withColumn("kind", F.lit(kind)) for kind, parts in (("ivf", None), ("ivfpq", 16))]
    return union_all(rows).select("kind", "n_exact", (F.col("recall") >= 0.9).cast("int").alias("reached"))


def fuzzy_of_labels(spark: SparkSession, d: str) -> DataFrame:
    """The sequence similarities of all labelled matches."""
    left, ref = sides(spark, d)
    known = truth(spark, d)[1].select(F.col("s1_id").alias("source1_entity_id"), F.col("cand_id").alias("candidate_entity_id"), F.lit(1.0).alias("blocking_score"))
    names = [f for f in FUZZY if f != "name_partial"]
    return pair_features(known, left, ref).select("source1_entity_id", "candidate_entity_id", *[F.round(c, 6).alias(c) for c in names])


def folds_of_pairs(spark: SparkSession, d: str) -> DataFrame:
    """That the folds of cross-validation keep every record's pairs together and lose none."""
    folded = K.distinct_pairs(known_pairs(spark, d)).withColumn("fold", fold_of(F.col("source1_entity_id"), TreeConfig().folds))
    per = folded.groupBy("source1_entity_id").agg(F.countDistinct("fold").alias("folds"), F.count("*").alias("n"))
    return per.agg(F.sum("n").alias("n_pairs"), F.count("*").alias("n_entities"), F.sum((F.col("folds") > 1).cast("long")).alias("parted"))


def embedding_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Nearest names by hashed trigrams within a country, all records of S1 against S2 and S3."""
    t = {f"S{i}": read_table(spark, d, f"train_source{i}") for i in (1, 2, 3)}
    return N.embedding_candidates(t["S1"], {"S2": t["S2"], "S3": t["S3"]}, N.TrigramEmbedder(64), k=5)


QUERIES: dict[str, Query] = {
    "basic_clean": basic_clean,
    "name_norm_core": prepared(["name_norm", "name_core", "name_core_rev"]),
    "addr_norm_postal": prepared(["addr_norm", "postal", "country"]),
    "block_key": prepared(["block_key"]),
    "char_ngrams": char_ngrams,
    "parse_id_list": parse_id_list,
    "prepare_text": prepare_text,
    "exact_key_join_block": exact_key_join("block_key", 1.0),
    "exact_key_join_postal": exact_key_join("postal", 0.9),
    "key_frequency": key_frequency,
    "group_size_cap": group_size_cap,
    "token_weights": token_weights,
    "token_join": token_join,
    "sorted_neighborhood_name": sorted_neighbourhood("name_core"),
    "sorted_neighborhood_rev": sorted_neighbourhood("name_core_rev"),
    "sorted_neighborhood_addr": sorted_neighbourhood("addr_norm"),
    "generate_candidates": generate_candidates,
    "generate_candidates_any_country": partial(generate_candidates, config=B.BlockingConfig(same_country_only=False)),
    "cap_top_k_per_source": cap_top_k_per_source,
    "cap_top_k_global": cap_top_k_global,
    "merge_candidates": merge_candidates,
    "joined_id_lists": joined_id_lists,
    "pair_features_native": pair_features_native,
    "pair_features_all": pair_features_all,
    "labels": labels,
    "positive_rate": positive_rate,
    "gbt_scores": gbt_scores,
    "blocking_recall": blocking_recall,
    "recall_by_country": recall_by_country,
    "per_signal_recall": per_signal_recall,
    "cap_victims": cap_victims,
    "cap_victims_per_source": partial(cap_victims, per_source=True),
    "cross_country": cross_country,
    "macro_f_beta": macro_f_beta,
    "threshold_sweep": threshold_sweep,
    "flat_ann_topk": flat_ann_topk,
    "ann_ivf": ann_ivf,
    "ann_ivfpq": ann_ivfpq,
    "ann_recall": ann_recall,
    "fuzzy_of_labels": fuzzy_of_labels,
    "folds_of_pairs": folds_of_pairs,
    "embedding_candidates": embedding_candidates,
}

# SQL

REC = T.sql_prepared({"S1": "train_source1", "S2": "train_source2", "S3": "train_source3"})
SIDES = REC + ",\ns1 AS MATERIALIZED (SELECT * FROM rec WHERE src = 'S1'), ref AS MATERIALIZED (SELECT * FROM rec WHERE src <> 'S1')"
ALL = "(SELECT entity_id, business_name, business_address, country FROM train_source1 UNION ALL SELECT entity_id, business_name, business_address, country FROM train_source2 UNION ALL SELECT entity_id, business_name, business_address, country FROM train_source3)"
OTHERS = "(SELECT DISTINCT entity_id, country FROM train_source2 UNION SELECT DISTINCT entity_id, country FROM train_source3)"
KNOWN = "known AS (SELECT * FROM (SELECT upper(trim(source1_entity_id, ' ')) AS source1_entity_id, candidate_entity_id, source, blocking_score FROM candidate_pairs) WHERE source1_entity_id <> '' AND candidate_entity_id <> '' AND blocking_score IS NOT NULL AND NOT isnan(blocking_score))"
TRUTH = f"""spine AS (SELECT DISTINCT source1_entity_id AS s1_id FROM train_labels WHERE source1_entity_id IS NOT NULL),
truth AS (SELECT DISTINCT s1_id, cand_id FROM (SELECT source1_entity_id AS s1_id, unnest({T.sql_id_list("matched_entity_ids")}) AS cand_id FROM train_labels WHERE source1_entity_id IS NOT NULL))"""


def sql_exact(key: str, score: float, cap: int) -> str:
    return f"""SELECT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id, b.src AS source, b.country, {score}::DOUBLE AS blocking_score
FROM (SELECT src, country, {key} AS key FROM ref WHERE {key} <> '' GROUP BY ALL HAVING count(*) <= {cap}) c
JOIN ref b ON b.src = c.src AND b.country = c.country AND b.{key} = c.key JOIN s1 a ON a.country = c.country AND a.{key} = c.key"""


def sql_words(table: str) -> str:
    return f"SELECT src, country, entity_id, w AS key FROM (SELECT src, country, entity_id, unnest({T.sql_tokens('name_core')}) AS w FROM {table}) WHERE length(w) >= 3"


def sql_weights(cap: int) -> str:
    return f"""words AS MATERIALIZED ({sql_words("ref")}),
counts AS (SELECT src, country, key, count(*) AS n FROM words GROUP BY ALL HAVING count(*) <= {cap}),
weights AS (SELECT *, (1 / ln(n + 2)) / max(1 / ln(n + 2)) OVER (PARTITION BY src, country) AS weight FROM counts)"""


SQL_TOKEN = f"""SELECT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id, b.src AS source, b.country, least(1.0, sum(w.weight)) AS blocking_score
FROM ({sql_words("s1")}) a JOIN words b ON a.country = b.country AND a.key = b.key JOIN weights w ON w.src = b.src AND w.country = b.country AND w.key = b.key GROUP BY ALL"""


def sql_neighbours(column: str, window: int) -> str:
    return f"""SELECT CASE WHEN x.side = 0 THEN x.id ELSE y.id END AS source1_entity_id, CASE WHEN x.side = 0 THEN y.id ELSE x.id END AS candidate_entity_id, x.src AS source, x.country, 1.0 / (y.p - x.p) AS blocking_score
FROM (SELECT *, row_number() OVER (PARTITION BY src, country ORDER BY key, side, id) AS p FROM (SELECT t.src, country, entity_id AS id, {column} AS key, 0 AS side FROM s1, (VALUES ('S2'), ('S3')) t(src) UNION ALL SELECT src, country, entity_id, {column}, 1 FROM ref)) x
JOIN (SELECT *, row_number() OVER (PARTITION BY src, country ORDER BY key, side, id) AS p FROM (SELECT t.src, country, entity_id AS id, {column} AS key, 0 AS side FROM s1, (VALUES ('S2'), ('S3')) t(src) UNION ALL SELECT src, country, entity_id, {column}, 1 FROM ref)) y
ON x.src = y.src AND x.country = y.country AND x.side <> y.side AND y.p BETWEEN x.p + 1 AND x.p + {window}"""


def sql_signals(c: B.BlockingConfig) -> dict[str, str]:
    return {
        "block_key": sql_exact("block_key", 1.0, c.max_group_size),
        "postal": sql_exact("postal", 0.9, c.max_group_size),
        "token": SQL_TOKEN,
        "neighbours_name": sql_neighbours("name_core", c.window),
        "neighbours_reversed": sql_neighbours("name_core_rev", c.window),
        "neighbours_address": sql_neighbours("addr_norm", c.window),
    }


def sql_cap(pairs: str, k: int, by: str) -> str:
    return f"SELECT source1_entity_id, candidate_entity_id, source, blocking_score FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY blocking_score DESC, candidate_entity_id) AS r FROM ({pairs})) WHERE r <= {k}"


def sql_generate(c: B.BlockingConfig, sides_sql: str) -> str:
    union = " UNION ALL ".join(sql_signals(c).values())
    best = f"SELECT source1_entity_id, candidate_entity_id, source, country, max(round(blocking_score, 6)) AS blocking_score FROM ({union}) GROUP BY ALL"
    return f"WITH {sides_sql}, {sql_weights(c.max_group_size)} " + sql_cap(best, c.top_k, "source1_entity_id, source, country")


ROUNDED = "SELECT source1_entity_id, candidate_entity_id, source, round(blocking_score, 6) AS blocking_score FROM"
SOURCE = "left(candidate_entity_id, 2) AS source"
GLOBAL = f"SELECT source1_entity_id, candidate_entity_id, {SOURCE}, max(blocking_score) AS blocking_score FROM known GROUP BY ALL"
DISTINCT_PAIRS = f"pairs AS MATERIALIZED ({GLOBAL})"


def sql_jaccard(a: str, b: str) -> str:
    return f"(CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 1.0 ELSE len(list_intersect({a}, {b}))::DOUBLE / (len({a}) + len({b}) - len(list_intersect({a}, {b}))) END)"


def sql_len_diff(a: str, b: str) -> str:
    return f"(abs(length({a}) - length({b}))::DOUBLE / greatest(length({a}), length({b}), 1))"


def sql_same(a: str, b: str) -> str:
    return f"(CASE WHEN {a} <> '' AND {a} = {b} THEN 1.0 ELSE 0.0 END)"


# token and n-gram lists only of records that occur in a pair
PROFILE = f"prof AS MATERIALIZED (SELECT *, list_distinct({T.sql_tokens('name_norm')}) AS nt, {T.sql_ngrams('name_norm')} AS ng, list_distinct({T.sql_tokens('addr_norm')}) AS at, {T.sql_ngrams('addr_norm')} AS ag FROM rec WHERE entity_id IN (SELECT source1_entity_id FROM pairs UNION SELECT candidate_entity_id FROM pairs))"


def sql_f(p: str, t: str, h: str) -> str:
    """Score of an entity from its numbers of predicted, true and common ids, beta 0.5."""
    pr, re = f"({h}::DOUBLE / greatest({p}, 1))", f"({h}::DOUBLE / greatest({t}, 1))"
    return f"(CASE WHEN {p} = 0 AND {t} = 0 THEN 1.0 WHEN {p} = 0 OR {t} = 0 OR {h} = 0 THEN 0.0 ELSE 1.25 * {pr} * {re} / (0.25 * {pr} + {re}) END)"


FOUND = "found AS (SELECT t.s1_id, t.cand_id, (k.s1 IS NOT NULL)::INT AS f FROM truth t LEFT JOIN (SELECT DISTINCT source1_entity_id AS s1, candidate_entity_id AS c FROM known) k ON k.s1 = t.s1_id AND k.c = t.cand_id), per AS (SELECT s1_id, count(*) AS n, sum(f) AS f FROM found GROUP BY s1_id)"


def sql_victims(cap: int, per_source: bool) -> str:
    by = "src, country" if per_source else "country"
    on = " AND ".join(f"c.{x} = k.{x}" for x in by.split(", "))
    join = "known_t AS (SELECT t.s1_id, t.cand_id, b.src, a.country, a.block_key AS bk1, b.block_key AS bk2, a.postal AS po1, b.postal AS po2, a.name_core AS nc1, b.name_core AS nc2 FROM truth t JOIN s1 a ON a.entity_id = t.s1_id JOIN ref b ON b.entity_id = t.cand_id)"
    parts = []
    for kind, x, y in (("block_key", "bk1", "bk2"), ("postal", "po1", "po2")):
        parts.append(f"SELECT '{kind}' AS kind, k.s1_id, k.cand_id, coalesce(c.n, 0) <= {cap} AS under FROM known_t k LEFT JOIN (SELECT {by}, {kind} AS key, count(*) AS n FROM ref GROUP BY ALL) c ON {on} AND c.key = k.{x} WHERE k.{x} = k.{y} AND k.{x} <> ''")
    parts.append(
        f"SELECT 'token' AS kind, s1_id, cand_id, bool_or(under) AS under FROM (SELECT k.s1_id, k.cand_id, coalesce(c.n, 0) <= {cap} AS under FROM (SELECT s1_id, cand_id, src, country, unnest(list_distinct(list_intersect({T.sql_tokens('nc1')}, {T.sql_tokens('nc2')}))) AS key FROM known_t) k "
        f"LEFT JOIN (SELECT {by}, key, count(*) AS n FROM ({sql_words('ref')}) GROUP BY ALL) c ON {on} AND c.key = k.key WHERE length(k.key) >= 3) GROUP BY ALL"
    )
    return f"""WITH {SIDES}, {TRUTH}, {join}, hits AS ({" UNION ALL ".join(parts)}),
lost AS (SELECT count(*) AS missing_ids FROM truth t WHERE t.s1_id NOT IN (SELECT entity_id FROM s1) OR t.cand_id NOT IN (SELECT entity_id FROM ref))
SELECT v.kind, count(h.kind) FILTER (WHERE h.under) AS matched_under_cap, count(h.kind) FILTER (WHERE NOT h.under) AS dropped_by_cap,
  (SELECT count(*) FROM known_t) - count(h.kind) AS no_shared_key, any_value(lost.missing_ids) AS missing_ids
FROM (VALUES ('block_key'), ('postal'), ('token')) v(kind) LEFT JOIN hits h ON h.kind = v.kind, lost GROUP BY v.kind"""


def sql_lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence: a fold over the letters of b whose state is, for all beginnings of a, the length so far."""
    places = f"range(1, length({a}) + 1)"
    met = f"list_transform({places}, lambda j: greatest(r[j], CASE WHEN ord(substring({a}, j, 1)) = s[1] THEN coalesce(r[j - 1], 0) + 1 ELSE 0 END))"
    row = f"list_transform([{met}], lambda t: list_transform({places}, lambda j: list_max(t[1:j])))[1]"
    letters = f"list_transform(string_split({b}, ''), lambda c: [ord(c)::BIGINT])"
    return f"(CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE list_reduce(list_prepend(list_transform({places}, lambda j: 0::BIGINT), {letters}), lambda r, s: {row})[length({a})] END)"


def sql_ratio(a: str, b: str) -> str:
    return f"(CASE WHEN length({a}) + length({b}) = 0 THEN 1.0 ELSE 2.0 * {sql_lcs(a, b)} / (length({a}) + length({b})) END)"


def _sql_fuzzy() -> str:
    """Sequence similarities of the labelled matches, names and addresses as rows of one table."""
    joined = lambda x: f"array_to_string(list_sort({x}), ' ')"
    size = lambda x: f"(length(shared) + gap + length({x}))"
    return f"""WITH {REC}, {TRUTH},
p AS (SELECT t.s1_id, t.cand_id, unnest(['name', 'addr']) AS field, unnest([a.name_norm, a.addr_norm]) AS x, unnest([b.name_norm, b.addr_norm]) AS y
  FROM truth t JOIN rec a ON a.src = 'S1' AND a.entity_id = t.s1_id JOIN rec b ON b.src <> 'S1' AND b.entity_id = t.cand_id),
w AS (SELECT *, {T.sql_tokens("x")} AS wx, {T.sql_tokens("y")} AS wy FROM p),
d AS (SELECT *, {joined("wx")} AS sx, {joined("wy")} AS sy, {joined("list_intersect(list_distinct(wx), list_distinct(wy))")} AS shared,
  {joined("list_filter(list_distinct(wx), lambda e: NOT list_contains(wy, e))")} AS dx, {joined("list_filter(list_distinct(wy), lambda e: NOT list_contains(wx, e))")} AS dy FROM w),
g AS (SELECT *, (shared <> '')::INT AS gap FROM d),
f AS (SELECT s1_id, cand_id, field, round({sql_ratio("x", "y")}, 6) AS whole, round({sql_ratio("sx", "sy")}, 6) AS sorted,
  round(CASE WHEN len(wx) = 0 OR len(wy) = 0 THEN 0.0 WHEN shared <> '' AND (dx = '' OR dy = '') THEN 1.0
    ELSE greatest(1.0 - (length(dx) + length(dy) - 2 * {sql_lcs("dx", "dy")}) / ({size("dx")} + {size("dy")})::DOUBLE,
      CASE WHEN gap = 1 THEN 1.0 - (gap + length(dx)) / (length(shared) + {size("dx")})::DOUBLE ELSE 0.0 END,
      CASE WHEN gap = 1 THEN 1.0 - (gap + length(dy)) / (length(shared) + {size("dy")})::DOUBLE ELSE 0.0 END) END, 6) AS sets FROM g)
SELECT n.s1_id AS source1_entity_id, n.cand_id AS candidate_entity_id, n.whole AS name_levenshtein, n.sorted AS name_token_sort, n.sets AS name_token_set,
  a.whole AS addr_levenshtein, a.sorted AS addr_token_sort, a.sets AS addr_token_set
FROM f n JOIN f a ON a.s1_id = n.s1_id AND a.cand_id = n.cand_id AND a.field = 'addr' WHERE n.field = 'name'"""


_ANY = SIDES.replace("SELECT * FROM rec WHERE src = 'S1'", "SELECT * REPLACE ('*' AS country) FROM rec WHERE src = 'S1'").replace("SELECT * FROM rec WHERE src <> 'S1'", "SELECT * REPLACE ('*' AS country) FROM rec WHERE src <> 'S1'")
_GRID = ", ".join(f"({t})" for t in M.GRID)
SQL: dict[str, str] = {
    "basic_clean": f"SELECT DISTINCT entity_id, {T.sql_clean('business_name')} AS name_clean, {T.sql_clean('business_address')} AS addr_clean FROM {ALL}",
    "name_norm_core": f"WITH {REC} SELECT entity_id, name_norm, name_core, name_core_rev FROM rec",
    "addr_norm_postal": f"WITH {REC} SELECT entity_id, addr_norm, postal, country FROM rec",
    "block_key": f"WITH {REC} SELECT entity_id, block_key FROM rec",
    "char_ngrams": f"WITH {REC} SELECT entity_id, len(list_distinct({T.sql_tokens('name_norm')})) AS n_tokens, array_to_string(list_sort({T.sql_ngrams('name_norm')}), '|') AS grams FROM rec",
    "parse_id_list": f"SELECT source1_entity_id, len({T.sql_id_list('matched_entity_ids')}) AS n_ids, array_to_string(ids, '|') AS ids FROM (SELECT *, (SELECT coalesce(list(e ORDER BY i), []) FROM (SELECT e, min(i) AS i FROM (SELECT unnest(x) AS e, generate_subscripts(x, 1) AS i) GROUP BY e)) AS ids FROM (SELECT *, CASE WHEN matched_entity_ids IS NULL OR lower(trim(matched_entity_ids)) IN ('', 'nan') THEN [] ELSE list_filter(list_transform(string_split(matched_entity_ids, ','), lambda e: regexp_replace(e, '^\\s+|\\s+$', '', 'g')), lambda e: e <> '') END AS x FROM train_labels))",
    "prepare_text": f"SELECT DISTINCT entity_id, coalesce(country, '') AS country, 'passage: ' || (CASE WHEN trim(coalesce(business_address, '')) = '' THEN coalesce(business_name, '') ELSE coalesce(business_name, '') || ' -- ' || business_address END) AS text, left(entity_id, 2) AS source FROM {ALL}",
    "exact_key_join_block": f"WITH {SIDES} {ROUNDED} ({sql_exact('block_key', 1.0, CONFIG.max_group_size)})",
    "exact_key_join_postal": f"WITH {SIDES} {ROUNDED} ({sql_exact('postal', 0.9, CONFIG.max_group_size)})",
    "key_frequency": f"WITH {SIDES} SELECT src, country, block_key AS key, count(*) AS n FROM ref WHERE block_key <> '' GROUP BY ALL",
    "group_size_cap": f"WITH {SIDES} SELECT src, country, postal AS key, count(*) AS n FROM ref WHERE postal <> '' GROUP BY ALL HAVING count(*) <= 2",
    "token_weights": f"WITH {SIDES}, {sql_weights(CONFIG.max_group_size)} SELECT src, country, key, n, round(weight, 6) AS weight FROM weights",
    "token_join": f"WITH {SIDES}, {sql_weights(CONFIG.max_group_size)} {ROUNDED} ({SQL_TOKEN})",
    "sorted_neighborhood_name": f"WITH {SIDES} {ROUNDED} ({sql_neighbours('name_core', CONFIG.window)})",
    "sorted_neighborhood_rev": f"WITH {SIDES} {ROUNDED} ({sql_neighbours('name_core_rev', CONFIG.window)})",
    "sorted_neighborhood_addr": f"WITH {SIDES} {ROUNDED} ({sql_neighbours('addr_norm', CONFIG.window)})",
    "generate_candidates": sql_generate(CONFIG, SIDES),
    "generate_candidates_any_country": sql_generate(CONFIG, _ANY),
    "cap_top_k_per_source": f"WITH {KNOWN} " + sql_cap(GLOBAL, 5, "source1_entity_id, source"),
    "cap_top_k_global": f"WITH {KNOWN} " + sql_cap(GLOBAL, 5, "source1_entity_id"),
    "merge_candidates": f"WITH {SIDES}, {KNOWN} " + sql_cap(f"SELECT source1_entity_id, candidate_entity_id, {SOURCE}, max(blocking_score) AS blocking_score FROM (SELECT source1_entity_id, candidate_entity_id, blocking_score FROM known UNION ALL SELECT source1_entity_id, candidate_entity_id, blocking_score FROM ({sql_exact('block_key', 1.0, CONFIG.max_group_size)})) GROUP BY ALL", CONFIG.top_k, "source1_entity_id"),
    "joined_id_lists": f"WITH {KNOWN} SELECT s.entity_id AS source1_entity_id, coalesce(string_agg(DISTINCT k.candidate_entity_id, ',' ORDER BY k.candidate_entity_id), '') AS candidate_entity_ids FROM (SELECT DISTINCT entity_id FROM train_source1) s LEFT JOIN known k ON k.source1_entity_id = s.entity_id AND k.blocking_score >= 0.9 GROUP BY s.entity_id",
    "pair_features_native": f"""WITH {REC}, {KNOWN}, {DISTINCT_PAIRS}, {PROFILE}
SELECT p.source1_entity_id, p.candidate_entity_id, round({sql_jaccard("a.nt", "b.nt")}, 6) AS name_token_jaccard, round({sql_jaccard("a.ng", "b.ng")}, 6) AS name_char3_jaccard, round({sql_len_diff("a.name_norm", "b.name_norm")}, 6) AS name_len_diff,
{sql_same("a.name_norm", "b.name_norm")}::DOUBLE AS name_exact, {sql_same("a.name_core", "b.name_core")}::DOUBLE AS name_core_exact, round({sql_jaccard("a.at", "b.at")}, 6) AS addr_token_jaccard, round({sql_jaccard("a.ag", "b.ag")}, 6) AS addr_char3_jaccard,
round({sql_len_diff("a.addr_norm", "b.addr_norm")}, 6) AS addr_len_diff, {sql_same("a.postal", "b.postal")}::DOUBLE AS postal_match, (a.postal <> '' AND b.postal <> '')::INT::DOUBLE AS postal_both_present, (a.country = b.country)::INT::DOUBLE AS country_match, round(p.blocking_score, 6) AS blocking_score
FROM pairs p JOIN prof a ON a.src = 'S1' AND a.entity_id = p.source1_entity_id JOIN prof b ON b.src <> 'S1' AND b.entity_id = p.candidate_entity_id""",
    "labels": f"WITH {KNOWN}, {DISTINCT_PAIRS}, {TRUTH} SELECT p.source1_entity_id, p.candidate_entity_id, (t.s1_id IS NOT NULL)::INT AS label FROM pairs p LEFT JOIN truth t ON t.s1_id = p.source1_entity_id AND t.cand_id = p.candidate_entity_id",
    "positive_rate": f"WITH {KNOWN}, {DISTINCT_PAIRS}, {TRUTH} SELECT count(*) AS n, count(t.s1_id) AS positives, round(count(t.s1_id) / count(*)::DOUBLE, 6) AS rate FROM pairs p LEFT JOIN truth t ON t.s1_id = p.source1_entity_id AND t.cand_id = p.candidate_entity_id",
    "blocking_recall": f"WITH {KNOWN}, {TRUTH}, {FOUND} SELECT round(CASE WHEN sum(n) > 0 THEN sum(f) / sum(n)::DOUBLE ELSE 1.0 END, 6) AS candidate_recall, coalesce(sum(n), 0)::BIGINT AS total_true_matches, coalesce(sum(f), 0)::BIGINT AS total_found, count(*) FILTER (WHERE f < n) AS entities_with_missed_matches FROM per",
    "recall_by_country": f"WITH {KNOWN}, {TRUTH}, {FOUND} SELECT coalesce(s.country, '') AS country, count(*) AS n_entities_with_matches, sum(n)::BIGINT AS total_true_matches, sum(f)::BIGINT AS total_found, round(sum(f) / sum(n)::DOUBLE, 6) AS recall FROM per LEFT JOIN (SELECT DISTINCT entity_id, country FROM train_source1) s ON s.entity_id = per.s1_id GROUP BY 1",
    "per_signal_recall": f"WITH {SIDES}, {sql_weights(CONFIG.max_group_size)}, {TRUTH}, hits AS MATERIALIZED (SELECT DISTINCT signal, t.s1_id, t.cand_id FROM ("
    + " UNION ALL ".join(f"SELECT '{k}' AS signal, source1_entity_id, candidate_entity_id FROM ({q})" for k, q in sql_signals(CONFIG).items())
    + f""") p JOIN truth t ON t.s1_id = p.source1_entity_id AND t.cand_id = p.candidate_entity_id),
n AS (SELECT signal, count(*) AS found FROM hits GROUP BY signal UNION ALL SELECT 'UNION', count(*) FROM (SELECT DISTINCT s1_id, cand_id FROM hits))
SELECT v.signal, coalesce(n.found, 0) AS found, round(coalesce(n.found, 0) / (SELECT count(*) FROM truth)::DOUBLE, 6) AS recall FROM (VALUES {", ".join(f"('{x}')" for x in [*B.SIGNALS, "UNION"])}) v(signal) LEFT JOIN n ON n.signal = v.signal""",
    "cap_victims": sql_victims(CONFIG.max_group_size, False),
    "cap_victims_per_source": sql_victims(CONFIG.max_group_size, True),
    "cross_country": f"WITH {TRUTH} SELECT count(*) AS n FROM truth t LEFT JOIN (SELECT DISTINCT entity_id, country FROM train_source1) a ON a.entity_id = t.s1_id LEFT JOIN {OTHERS} b ON b.entity_id = t.cand_id WHERE (a.entity_id IS NOT NULL OR b.entity_id IS NOT NULL) AND (a.country IS NULL OR b.country IS NULL OR a.country <> b.country)",
    "macro_f_beta": f"""WITH {KNOWN}, {TRUTH}, pred AS (SELECT DISTINCT source1_entity_id AS s1_id, candidate_entity_id AS cand_id FROM known WHERE blocking_score >= 0.9),
e AS (SELECT s.s1_id, (SELECT count(*) FROM truth t WHERE t.s1_id = s.s1_id) AS t, (SELECT count(*) FROM pred p WHERE p.s1_id = s.s1_id) AS p, (SELECT count(*) FROM pred p JOIN truth t USING (s1_id, cand_id) WHERE p.s1_id = s.s1_id) AS h FROM spine s)
SELECT round(coalesce(avg({sql_f("p", "t", "h")}), 0.0), 6) AS macro_f_beta FROM e""",
    "threshold_sweep": f"""WITH {KNOWN}, {TRUTH}, best AS (SELECT source1_entity_id AS s1_id, candidate_entity_id AS cand_id, max(blocking_score) AS prob FROM known GROUP BY ALL),
g AS (SELECT threshold::DOUBLE AS threshold FROM (VALUES {_GRID}) v(threshold)),
n AS (SELECT s1_id, count(*) AS t FROM truth GROUP BY s1_id),
c AS (SELECT g.threshold, b.s1_id, count(*) AS p, count(t.s1_id) AS h FROM g JOIN best b ON b.prob >= g.threshold LEFT JOIN truth t ON t.s1_id = b.s1_id AND t.cand_id = b.cand_id GROUP BY ALL)
SELECT g.threshold, round(avg({sql_f("coalesce(c.p, 0)", "coalesce(n.t, 0)", "coalesce(c.h, 0)")}), 6) AS macro_f_beta FROM g CROSS JOIN spine s LEFT JOIN n ON n.s1_id = s.s1_id LEFT JOIN c ON c.threshold = g.threshold AND c.s1_id = s.s1_id GROUP BY g.threshold""",
    "ann_recall": "WITH n AS (SELECT sum(least(10, (SELECT count(*) FROM embeddings)))::BIGINT AS n_exact FROM embeddings WHERE vec_id % 100 = 0) SELECT k.kind, n.n_exact, 1 AS reached FROM (VALUES ('ivf'), ('ivfpq')) k(kind), n",
    "fuzzy_of_labels": _sql_fuzzy(),
    "folds_of_pairs": f"WITH {KNOWN} SELECT count(*) AS n_pairs, count(DISTINCT source1_entity_id) AS n_entities, 0 AS parted FROM (SELECT DISTINCT source1_entity_id, candidate_entity_id FROM known)",
    "flat_ann_topk": """WITH s AS (SELECT a.label, a.vec_id AS left_id, b.vec_id AS right_id, list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS x FROM embeddings a JOIN embeddings b ON a.label = b.label WHERE a.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY label, left_id ORDER BY round(x, 12) DESC, right_id) AS rank FROM s)
SELECT label, left_id, right_id, round(x, 6) AS score, rank FROM r WHERE rank <= 10""",
}

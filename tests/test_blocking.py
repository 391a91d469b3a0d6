"""Blocking, top-k and neighbourhoods on toy tables with known answers, and against brute force."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from kinweave.functions.text import prepare
from kinweave.operators import blocking as B
from kinweave.operators import metrics as M
from kinweave.operators import topk as K
from kinweave.operators.neighbours import in_blocks, pairs_within, positions
from tests.conftest import rows

RECORD = "entity_id string, business_name string, business_address string, country string"
S1 = [
    ("S1-001", "Acme Corporation", "123 Main St, Springfield", "US"),
    ("S1-002", "Globex Pvt Ltd", "45 Nehru Road, Mumbai 400001", "India"),
    ("S1-003", "Standalone Widgets Inc", "9 Lonely Ave", "US"),
    ("S1-004", "Cafe de Paris SARL", "10 Rue de Rivoli, Paris 75001", "France"),
]
S2 = [("S2-001", "Acme Corp", "123 Main Street, Springfield", "US"), ("S2-002", "Totally Unrelated LLC", "1 Nowhere Rd", "US"), ("S2-003", "Globex Private Limited", "45 Nehru Rd, Mumbai", "India")]
S3 = [("S3-001", "Acme Corporation", "123 Main St., Springfield", "US"), ("S3-002", "Cafe de Paris", "10 Rue de Rivoli, 75001 Paris", "France")]
TRUTH = [("S1-001", "S2-001,S3-001"), ("S1-002", "S2-003"), ("S1-003", None), ("S1-004", "S3-002")]


def toy(spark):
    t = [spark.createDataFrame(x, RECORD) for x in (S1, S2, S3)]
    labels = spark.createDataFrame(TRUTH, "source1_entity_id string, matched_entity_ids string")
    return t, B.prepared_tables(t[0], {"S2": t[1], "S3": t[2]}, prepare), M.truth_tables(labels)


def test_toy_end_to_end(spark):
    tables, (left, ref), (spine, truth) = toy(spark)
    pairs = B.generate_candidates(left, ref, B.BlockingConfig(top_k=5))
    assert M.blocking_recall(truth, pairs).first().asDict() == {"candidate_recall": 1.0, "total_true_matches": 4, "total_found": 4, "entities_with_missed_matches": 0}
    assert {r["source"] for r in pairs.select("source").collect()} == {"S2", "S3"}
    assert M.cross_country_matches(tables[0], tables[1].union(tables[2]), truth).first()["n"] == 0
    # candidates stay within the country
    assert {r[0] for r in pairs.where("source1_entity_id = 'S1-002'").select("candidate_entity_id").collect()} == {"S2-003"}
    any_country = B.generate_candidates(left, ref, B.BlockingConfig(top_k=50, same_country_only=False))
    assert any_country.count() > pairs.count()


def test_caps(spark):
    p = spark.createDataFrame([("S1-1", "S2-1", 0.5), ("S1-1", "S2-1", 0.9), ("S1-1", "S2-2", 0.8), ("S1-1", "S2-3", 0.1), ("S1-1", "S3-1", 0.95)], "source1_entity_id string, candidate_entity_id string, blocking_score double")
    got = K.cap_global(p, 3).orderBy(F.desc("blocking_score")).collect()
    assert [(r["candidate_entity_id"], r["blocking_score"], r["source"]) for r in got] == [("S3-1", 0.95, "S3"), ("S2-1", 0.9, "S2"), ("S2-2", 0.8, "S2")]
    per = K.cap_per_source(p.withColumn("source", F.substring("candidate_entity_id", 1, 2)), 1)
    assert {(r["source"], r["candidate_entity_id"]) for r in per.collect()} == {("S2", "S2-1"), ("S3", "S3-1")}
    ties = p.withColumn("blocking_score", F.lit(1.0))
    assert [r[0] for r in K.cap_global(ties, 2).select("candidate_entity_id").orderBy("candidate_entity_id").collect()] == ["S2-1", "S2-2"]
    assert K.cap_global(p.limit(0), 3).count() == 0


def test_merge(spark):
    a = spark.createDataFrame([("S1-1", "S2-1", 1.0), ("S1-1", "S2-9", 0.9)], "source1_entity_id string, candidate_entity_id string, blocking_score double")
    b = spark.createDataFrame([("S1-1", "S2-1", 0.6), ("S1-1", "S3-7", 0.99)], "source1_entity_id string, candidate_entity_id string, blocking_score double")
    assert {(r["candidate_entity_id"], r["blocking_score"]) for r in K.merge_candidates(a, b, k=10).collect()} == {("S2-1", 1.0), ("S3-7", 0.99), ("S2-9", 0.9)}
    assert K.merge_candidates(a.limit(0), b.limit(0)).count() == 0


def test_joined_lists_keep_the_spine(spark):
    p = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", "x")], "source1_entity_id string, candidate_entity_id string")
    spine = spark.createDataFrame([("a",), ("b",)], "source1_entity_id string")
    assert rows(K.joined_lists(p, spine)) == [("a", "x,y"), ("b", "")]


def test_group_cap_and_token_repeats(spark):
    ref = spark.createDataFrame([("S2", "US", f"r{i}", "big") for i in range(5)] + [("S2", "US", "r9", "rare rare word")], "src string, country string, entity_id string, name_core string")
    left = spark.createDataFrame([("US", "l1", "big rare")], "country string, entity_id string, name_core string")
    capped = B.token_pairs(left, ref, cap=4)
    # rare occurs twice and word once; word is the rarest, so rare weighs ln 3 / ln 4, and counts twice
    assert [(r["candidate_entity_id"], round(r["blocking_score"], 6)) for r in capped.collect()] == [("r9", 1.0)]
    assert B.token_pairs(left, ref, cap=None).count() == 6


def test_positions_and_windows_against_brute_force(spark):
    rng = random.Random(5)
    data = [(rng.choice("xy"), rng.choice(["a", "b", "hot", "hot", "hot"]), rng.randrange(2), f"{i:04d}") for i in range(400)]
    df = spark.createDataFrame(data, "g string, key string, side int, id string")
    placed = {r["id"]: r["pos"] for r in positions(df, ["g", "key", "side", "id"]).collect()}
    order = sorted(data)
    assert [placed[x[3]] for x in order] == list(range(400))
    got = {(r["g"], r["left_id"], r["right_id"], r["distance"]) for r in pairs_within(df, ["g"], "key", "side", "id", 7).collect()}
    want = set()
    for i, x in enumerate(order):
        for d in range(1, 8):
            if i + d < len(order) and order[i + d][0] == x[0] and order[i + d][2] != x[2]:
                a, b = (x, order[i + d]) if x[2] == 0 else (order[i + d], x)
                want.add((x[0], a[3], b[3], d))
    assert got == want
    assert pairs_within(df.limit(0), ["g"], "key", "side", "id", 7).count() == 0


def test_blocks_meet_every_close_pair_once(spark):
    import pandas as pd

    df = spark.createDataFrame([(i * 7 % 101,) for i in range(101)], "v int")

    def compare(pdf, n_own):
        v = pdf["v"].tolist()
        return pd.DataFrame([(v[i], v[j]) for i in range(n_own) for j in range(i + 1, min(len(v), i + 4))], columns=["a", "b"])

    got = [tuple(r) for r in in_blocks(df, ["v"], 3, compare, "a int, b int", block=10).collect()]
    assert sorted(got) == sorted((i, j) for i in range(101) for j in range(i + 1, min(101, i + 4)))


def test_empty_and_null_records(spark):
    empty = spark.createDataFrame([], RECORD)
    left, ref = B.prepared_tables(empty, {"S2": empty, "S3": empty}, prepare)
    assert B.generate_candidates(left, ref, B.BlockingConfig()).count() == 0
    nulls = spark.createDataFrame([("S1-1", None, None, None), ("S1-1", None, None, None)], RECORD)
    other = spark.createDataFrame([("S2-1", None, None, None)], RECORD)
    left, ref = B.prepared_tables(nulls, {"S2": other}, prepare)
    got = B.generate_candidates(left, ref, B.BlockingConfig())
    # blank keys join nothing; blank records still are neighbours
    assert [(r["candidate_entity_id"], r["blocking_score"]) for r in got.collect()] == [("S2-1", 1.0)]


def test_broadcast_only_of_counted_sides(spark):
    from kinweave.session import broadcast_if_small, plan_bytes

    small = spark.range(100).withColumnRenamed("id", "k")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    many = spark.range(1000).selectExpr("id % 100 AS k", "id AS v")
    assert plan_bytes(small) > 0
    assert "BroadcastHashJoin" in plan(many.join(broadcast_if_small(small, 100), "k"))
    assert "SortMergeJoin" in plan(many.join(broadcast_if_small(small, 99), "k"))

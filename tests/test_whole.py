"""Registered queries do the whole job: nothing is cut before the work."""

from __future__ import annotations

import numpy as np

from kinweave.operators import blocking as B
from kinweave.operators import nearest as N
from kinweave.plans import matching as Q

RECORD = "entity_id string, business_name string, business_address string, country string"


def write_tables(spark, d, n):
    """One record of S1 with n candidates in S2, the true one last by score; the pair of the best one given twice."""
    save = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    save([("S1-1", "Acme Corp", "1 Main St 12345", "US")], RECORD, "train_source1")
    save([(f"S2-{i}", f"Acme {i}", f"{i} Main St", "US") for i in range(n)], RECORD, "train_source2")
    save([("S3-1", "Other", "9 Far Rd", "US")], RECORD, "train_source3")
    pairs = [("S1-1", f"S2-{i}", "S2", 1 - i / 100) for i in range(n)]
    save([*pairs, ("s1-1 ", "S2-0", "S2", 0.2)], "source1_entity_id string, candidate_entity_id string, source string, blocking_score double", "candidate_pairs")
    save([("S1-1", f"S2-{n - 1}")], "source1_entity_id string, matched_entity_ids string", "train_labels")


def test_features_and_labels_of_every_pair(spark, tmp_path):
    d = str(tmp_path)
    write_tables(spark, d, 40)
    want = {f"S2-{i}" for i in range(40)}
    for query in (Q.pair_features_native, Q.pair_features_all, Q.labels):
        got = [r["candidate_entity_id"] for r in query(spark, d).select("candidate_entity_id").collect()]
        assert len(got) == 40 and set(got) == want
    assert Q.positive_rate(spark, d).first().asDict() == {"n": 40, "positives": 1, "rate": 0.025}
    best = Q.pair_features_all(spark, d).where("candidate_entity_id = 'S2-0'").first()
    assert best["blocking_score"] == 1.0  # the higher of its two scores


def test_blocking_runs_with_the_default_parameters():
    assert Q.CONFIG == B.BlockingConfig(top_k=30, same_country_only=True, window=40, max_group_size=2000, min_token_len=3)


def test_index_of_each_group_by_its_own_size(spark):
    rng = np.random.default_rng(0)
    large, small = rng.normal(size=(401, 8)).repeat(50, axis=0) + 0.1 * rng.normal(size=(20_050, 8)), rng.normal(size=(60, 8))
    x = np.concatenate([large, small])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    base = spark.createDataFrame([("large" if i < len(large) else "small", i, v) for i, v in enumerate(x.tolist())], "g string, id long, vec array<float>").repartition(8).cache()
    asked = base.where("g = 'small' OR id % 400 = 0")
    of = lambda df, g: {(r["left_id"], r["right_id"]) for r in df.collect() if r["g"] == g}
    found, exact = N.search(asked, base, 10, ["g"]).cache(), N.flat_search(asked, base, 10, ["g"]).cache()
    assert of(found, "small") == of(exact, "small")  # up to 20,000 rows, so exact beside a larger group too
    assert len(of(found, "large") & of(exact, "large")) >= 0.9 * len(of(exact, "large"))


def test_keys_of_more_than_fifty_rows_are_joined(spark, tmp_path):
    d = str(tmp_path)
    write_tables(spark, d, 60)  # "acme" is in all 60 names
    assert {r["key"]: r["n"] for r in Q.token_weights(spark, d).collect()}["acme"] == 60
    assert Q.token_join(spark, d).where("source = 'S2'").count() == 60
    assert Q.generate_candidates(spark, d).where("source = 'S2'").count() == 30
    found = {r["signal"]: r["found"] for r in Q.per_signal_recall(spark, d).collect()}
    assert found["token"] == found["UNION"] == 1

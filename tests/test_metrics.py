from __future__ import annotations

import random

from kinweave.operators import metrics as M
from tests.conftest import rows

PAIRS = "source1_entity_id string, candidate_entity_id string"


def f(p: set, t: set) -> float:
    if not p and not t:
        return 1.0
    h = len(p & t)
    if not p or not t or not h:
        return 0.0
    x, y = h / len(p), h / len(t)
    return 1.25 * x * y / (0.25 * x + y)


def tables(spark, truth: dict):
    return spark.createDataFrame([(k,) for k in truth], "s1_id string"), spark.createDataFrame([(k, c) for k, v in truth.items() for c in v], "s1_id string, cand_id string")


def test_corners(spark):
    for pred, true, want in [(set(), set(), 1.0), ({"a"}, set(), 0.0), (set(), {"a"}, 0.0), ({"a"}, {"a", "b"}, 0.833333), ({"a", "b"}, {"a"}, 0.555556)]:
        spine, pairs = tables(spark, {"x": true})
        got = M.macro_f_beta(spine, pairs, spark.createDataFrame([("x", c) for c in pred], PAIRS)).first()[0]
        assert round(got, 6) == want
    spine, pairs = tables(spark, {})
    assert M.macro_f_beta(spine, pairs, spark.createDataFrame([("x", "a")], PAIRS)).first()[0] == 0.0
    assert M.blocking_recall(pairs, spark.createDataFrame([], PAIRS)).first()["candidate_recall"] == 1.0


def test_sweep_against_brute_force(spark):
    rng = random.Random(3)
    truth = {f"e{i}": {f"c{j}" for j in range(6) if rng.random() < 0.2} for i in range(30)}
    probs = {(f"e{i}", f"c{j}"): round(rng.random(), 2) for i in range(32) for j in range(6) if rng.random() < 0.6}
    spine, pairs = tables(spark, truth)
    scored = spark.createDataFrame([(a, b, p) for (a, b), p in probs.items()], PAIRS + ", prob double")
    got = {r["threshold"]: r["macro_f_beta"] for r in M.threshold_sweep(spine, pairs, scored).collect()}
    for t in M.GRID:
        want = sum(f({b for (a, b), p in probs.items() if a == e and p >= t}, c) for e, c in truth.items()) / len(truth)
        assert abs(got[t] - want) < 1e-9
    top = max(got.values())
    assert M.best_threshold(M.threshold_sweep(spine, pairs, scored))[0] == min(t for t, v in got.items() if abs(v - top) < 1e-12)


def test_truth_tables(spark):
    labels = spark.createDataFrame([("a", "x, y"), ("a", "x"), ("b", None), (None, "z")], "source1_entity_id string, matched_entity_ids string")
    spine, pairs = M.truth_tables(labels)
    assert rows(spine) == [("a",), ("b",)]
    assert rows(pairs) == [("a", "x"), ("a", "y")]


def test_cross_country(spark):
    a = spark.createDataFrame([("1", "US"), ("2", None), ("3", "US")], "entity_id string, country string")
    b = spark.createDataFrame([("x", "US"), ("y", None), ("z", "FR")], "entity_id string, country string")
    pairs = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", "z"), ("1", "unknown"), ("no", "nobody")], "s1_id string, cand_id string")
    assert M.cross_country_matches(a, b, pairs).first()["n"] == 3

from __future__ import annotations

import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from kinweave.functions import fuzzy as Z
from kinweave.functions.text import prepare
from kinweave.operators.features import FEATURE_NAMES, pair_features, with_labels

WORDS = st.text(alphabet="abc ", max_size=12)


def slow_lcs(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(WORDS, WORDS)
def test_ratio(a, b):
    assert Z.lcs_length(a, b) == slow_lcs(a, b)
    assert Z.ratio(a, b) == (1.0 if not a + b else 2 * slow_lcs(a, b) / (len(a) + len(b)))
    assert Z.ratio(a, b) == Z.ratio(b, a)
    assert Z.token_sort_ratio(a, b) == Z.ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


@settings(max_examples=300, deadline=None)
@given(WORDS, WORDS)
def test_partial_ratio_is_the_best_window(a, b):
    got = Z.partial_ratio(a, b)
    if not a or not b:
        assert got == (1.0 if a == b else 0.0)
        return
    short, long = (a, b) if len(a) <= len(b) else (b, a)

    def best(s, t):
        windows = [t[max(0, i) : i + len(s)] for i in range(1 - len(s), len(t))]
        return max(2 * slow_lcs(s, w) / (len(s) + len(w)) for w in windows)

    want = best(short, long)
    if len(a) == len(b):
        want = max(want, best(long, short))
    assert math.isclose(got, want)


def test_token_set():
    assert Z.token_set_ratio("", "") == 0.0
    assert Z.token_set_ratio("a", "") == 0.0
    assert Z.token_set_ratio("new york mets", "mets york new york") == 1.0
    assert Z.token_set_ratio("acme corp", "acme") == 1.0
    x = Z.token_set_ratio("alpha beta", "alpha gamma")
    assert 0.5 < x < 1


def test_pair_features(spark):
    c = "entity_id string, business_name string, business_address string, country string"
    left = prepare(spark.createDataFrame([("S1-1", "Acme Corp", "1 Main St 12345", "US"), ("S1-2", None, None, None)], c))
    right = prepare(spark.createDataFrame([("S2-1", "Acme Corporation", "1 Main Street 12345", "US"), ("S2-2", None, None, None)], c))
    pairs = spark.createDataFrame([("S1-1", "S2-1", 0.5), ("S1-2", "S2-2", 0.1), ("S1-1", "S2-404", 0.9)], "source1_entity_id string, candidate_entity_id string, blocking_score double")
    got = {r["source1_entity_id"]: r.asDict() for r in pair_features(pairs, left, right).collect()}
    assert set(got) == {"S1-1", "S1-2"}  # unknown ids are dropped
    assert all(got["S1-1"][f] == (0.0 if f.endswith("len_diff") else 0.5 if f == "blocking_score" else 1.0) for f in FEATURE_NAMES)
    blank = got["S1-2"]
    assert blank["name_token_jaccard"] == 1.0 and blank["name_token_set"] == 0.0 and blank["name_exact"] == 0.0 and blank["country_match"] == 1.0 and blank["name_levenshtein"] == 1.0
    truth = spark.createDataFrame([("S1-1", "S2-1")], "s1_id string, cand_id string")
    assert {(r["source1_entity_id"], r["label"]) for r in with_labels(pairs.where("candidate_entity_id <> 'S2-404'"), truth).collect()} == {("S1-1", 1), ("S1-2", 0)}


def test_batches_equal_single_pairs():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcde é東") for _ in range(rng.choice([0, 1, 3, 8, 20, 63, 64, 65, 90])))
    x = [word() for _ in range(400)]
    y = [rng.choice([word(), x[i], x[i][::-1], x[i][1:] + "z"]) for i in range(400)]
    for many, one in ((Z.lcs_lengths, Z.lcs_length), (Z.ratios, Z.ratio), (Z.token_set_ratios, Z.token_set_ratio), (Z.partial_ratios, Z.partial_ratio)):
        got = many(x, y)
        assert max(abs(g - one(p, q)) for g, p, q in zip(got, x, y, strict=True)) < 1e-12, one.__name__
        assert len(many([], [])) == 0

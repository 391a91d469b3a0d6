"""Candidates from key lists are those of all pairs of all signals."""

from __future__ import annotations

import random

from kinweave.functions.text import prepare
from kinweave.operators import blocking as B
from kinweave.operators import topk as K
from kinweave.session import union_all
from tests.conftest import rows
from tests.test_blocking import RECORD


def records(rng, side, n):
    words = ["acme", "globex", "initech", "umbrella", "hooli", "stark", "wayne", "tyrell"]
    name = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(1, 5)))
    place = lambda: f"{rng.randrange(9)} {rng.choice(words)} road {rng.choice(['', '400001', '75001'])}"
    return [(f"{side}-{i:03d}", rng.choice([name(), name(), None]), rng.choice([place(), None]), rng.choice(["US", "India", None])) for i in range(n)]


def test_leading_pairs_against_all_pairs(spark):
    rng = random.Random(3)
    t = [spark.createDataFrame(records(rng, s, n), RECORD) for s, n in (("S1", 60), ("S2", 150), ("S3", 90))]
    left, ref = B.prepared_tables(t[0], {"S2": t[1].union(t[1].limit(9)), "S3": t[2]}, prepare)
    for same in (True, False):
        config = B.BlockingConfig(top_k=4, same_country_only=same, window=9, max_group_size=70)
        x, y = B.partitioned(left, same), B.partitioned(ref, same)
        every = union_all(list(B.signal_pairs(x, y, config).values())).cache()
        assert rows(B.generate_candidates(left, ref, config, 6)) == rows(K.cap_per_source(every, 4, 6).drop("country"))


def test_a_frequent_token_is_not_paired_out(spark):
    t = [spark.createDataFrame([(f"{s}-{i:03d}", f"acme {x * 3}{i}", None, "US") for i in range(n)], RECORD) for s, n, x in (("S1", 20, "w"), ("S2", 300, "v"))]
    left, ref = B.prepared_tables(t[0], {"S2": t[1]}, prepare)
    config = B.BlockingConfig(top_k=4, window=9)
    every = union_all(list(B.signal_pairs(left, ref, config).values())).cache()
    # what can't be among the best is never paired
    assert every.count() > 20 * 300 and B.leading_pairs(left, ref, config, 6).count() < 20 * 50
    assert rows(B.generate_candidates(left, ref, config, 6)) == rows(K.cap_per_source(every, 4, 6).drop("country"))

"""Pairs as lists of each left record: neighbours, and the best of all lists."""

from __future__ import annotations

import random

from kinweave.operators.neighbours import lists_within, pairs_within
from kinweave.operators.topk import best_of_lists
from tests.conftest import rows


def test_neighbours_in_lists_are_those_of_pairs(spark):
    rng = random.Random(4)
    data = [(rng.choice(["g", "h", None]), rng.choice("abcde"), rng.randrange(2), i, rng.choice([None, 2, 9])) for i in range(400)]
    df = spark.createDataFrame(data, "g string, key string, side int, id long, reach long")
    got = lists_within(df, ["g"], "key", "side", "id", [1.0 / d for d in range(1, 8)], reach="reach", block=10)
    pairs = {(r["g"], r["left_id"], x["right_id"], round(-1 / x["below"])) for r in got.collect() for x in r["items"]}
    assert pairs == set(rows(pairs_within(df, ["g"], "key", "side", "id", 7, reach="reach"))) and pairs
    # one row for each left record
    assert got.count() == len({p[1] for p in pairs})
    assert lists_within(df.limit(0), ["g"], "key", "side", "id", [1.0]).count() == 0


def test_best_of_lists(spark):
    rng = random.Random(5)
    data = [(rng.choice(["a", "b", "c", None]), [(rng.choice(["x", "y", "é", None, "zz", f"r{rng.randrange(9)}"]), -rng.choice([0.0, 0.5, 0.9, 1.0])) for _ in range(rng.randrange(1, 5))]) for _ in range(60)]
    df = spark.createDataFrame(data, "l string, items array<struct<right_id: string, below: double>>")
    want = []
    for left in {d[0] for d in data}:
        best: dict = {}
        for one, items in data:
            for right, below in items if one == left else []:
                best[right] = max(best.get(right, 0.0), -below)
        order = sorted(best, key=lambda r: (-best[r], r is not None, (r or "").encode()))
        want += [(left, r, best[r]) for r in order[:5]]
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for batch in ("3", size):  # lists of one record in several batches
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        assert set(rows(best_of_lists(df, ["l"], 5))) == set(want)
    assert best_of_lists(df.limit(0), ["l"], 5).count() == 0

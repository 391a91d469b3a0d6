"""Top N per group and splits, against brute force and in corner cases."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kinweave.llm.splits import assign_splits, hash_to_min, rendezvous, split_shares
from kinweave.llm.topn import top_n_per_group

PAIR = "g string, i string, s double, _group string, rank int"


def best(data, n):
    score = {}
    for g, i, s in data:
        if g and i and s is not None and s == s:
            score[g, i] = max(score.get((g, i), -1e300), s)
    groups = defaultdict(list)
    for (g, i), s in score.items():
        groups[g].append((-s, i))
    return {(g, i, -s, r) for g, v in groups.items() for r, (s, i) in enumerate(sorted(v)[:n], 1)}


@pytest.mark.parametrize("subgroups", [1, 4, 32])
def test_top_n_against_brute_force(spark, subgroups):
    rng = random.Random(2)
    data = [(rng.choice(["hot"] * 5 + ["a", "b", "", None]), rng.choice([f"i{k}" for k in range(60)] + [None, ""]), rng.choice([0.1, 0.5, 0.5, 0.9, None, float("nan"), -1.0])) for _ in range(3000)]
    # columns with the operator's own working names play no part
    df = spark.createDataFrame([(*x, "clash", 7) for x in data], PAIR)
    got = {tuple(r) for r in top_n_per_group(df, F.col("g"), F.col("i"), F.col("s"), 5, subgroups).collect()}
    assert got == best(data, 5)


def test_top_n_corners(spark):
    df = spark.createDataFrame([("é" * 5000, "x", 1.0), ("é" * 5000, "x", 1.0)], "g string, i string, s double")
    top = lambda d, n: top_n_per_group(d, F.col("g"), F.col("i"), F.col("s"), n)
    assert top(df, 3).count() == 1
    assert top(df, 0).count() == 0
    assert top(df.limit(0), 3).count() == 0


def test_hash_to_min_against_union_find(spark):
    rng = random.Random(4)
    edges = [(f"{rng.randrange(300):03d}", f"{rng.randrange(300):03d}") for _ in range(170)] + [(f"p{i:02d}", f"p{i + 1:02d}") for i in range(40)] + [("star", f"s{i}") for i in range(100)] + [("loop", "loop"), (None, "x"), ("x", None)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    least = defaultdict(list)
    for n in list(parent):
        least[root(n)].append(n)
    want = {n: min(v) for v in least.values() for n in v}
    got = {r["node"]: r["component"] for r in hash_to_min(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == want
    assert hash_to_min(spark.createDataFrame([], "a string, b string")).count() == 0


def test_splits_keep_relations_and_shares(spark):
    rng = random.Random(5)
    data = [("hot" if rng.random() < 0.33 else f"a{rng.randrange(400)}", f"s{rng.randrange(900)}" if rng.random() < 0.1 else None, i) for i in range(6000)] + [(None, None, i) for i in range(300)]
    df = spark.createDataFrame([(*x, "old", 1) for x in data], "author string, source string, n int, split string, component int")
    targets = {"train": 0.8, "validation": 0.1, "test": 0.1}
    out = assign_splits(df, {"author": F.col("author")}, targets)
    rows = out.collect()
    assert len(rows) == len(data) and set(out.columns) == set(df.columns)
    by = defaultdict(set)
    for r in rows:
        if r["author"]:
            by[r["author"]].add(r["split"])
    assert all(len(v) == 1 for v in by.values())
    shares = Counter(r["split"] for r in rows)
    assert all(abs(shares[k] / len(rows) - v) < 0.03 for k, v in targets.items())
    # two keys: chains of rows stay together
    rows = assign_splits(df, {"author": F.col("author"), "source": F.col("source")}, targets).collect()
    for key in ("author", "source"):
        by = defaultdict(set)
        for r in rows:
            if r[key]:
                by[r[key]].add(r["split"])
        assert all(len(v) == 1 for v in by.values())
    assert assign_splits(df.limit(0), {"author": F.col("author")}, targets).count() == 0
    with pytest.raises(ValueError):
        assign_splits(df, {"author": F.col("author")}, {"train": 0})


def test_copies_without_key_stay_together_and_shares_are_reported(spark):
    df = spark.createDataFrame([(None, "same")] * 50, "k string, v string")
    out = assign_splits(df, {"k": F.col("k")}, {"a": 1, "b": 1})
    assert out.select("split").distinct().count() == 1
    assert split_shares(out).first()["share"] == 1.0


def test_rendezvous_follows_weights(spark):
    n = Counter(r[0] for r in spark.range(20000).select(rendezvous(F.col("id").cast("string"), {"a": 3, "b": 1, "c": 0})).collect())
    assert set(n) == {"a", "b"} and abs(n["a"] / 20000 - 0.75) < 0.02

from __future__ import annotations

import random
from collections import defaultdict

from pyspark.sql import functions as F

from kinweave.operators.heavy_keys import heavy_keys, profile_by_key


def test_profile_against_brute_force(spark):
    rng = random.Random(1)
    # one key holds most rows, and one of its secondary values most of those
    data = [(rng.choice(["hot"] * 8 + ["a", "b", None, ""]), rng.choice(["same"] * 6 + [f"v{i}" for i in range(40)] + [None])) for _ in range(5000)]
    want = defaultdict(lambda: [0, set(), 0])
    for k, v in data:
        want[k][0] += 1
        if v is None:
            want[k][2] += 1
        else:
            want[k][1].add(v)
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(data)], "k string, v string, key int")
    for parts in (1, 3, 7):
        got = {r["key"]: [r["n_rows"], r["n_distinct"], r["n_null"]] for r in profile_by_key(df, F.col("k"), F.col("v"), n_parts=parts).collect()}
        assert got == {k: [n, len(s), z] for k, (n, s, z) in want.items()}
    assert [r["key"] for r in heavy_keys(df, F.col("k"), F.col("v"), 0.08).orderBy("key").collect()] == sorted(k for k, x in want.items() if k and x[0] > 0.08 * len(data))


def test_spreads_over_partitions(spark):
    df = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").cast("string").alias("v"))
    sizes = [r["count"] for r in df.repartitionByRange(4, "k", "v").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 1600
    assert profile_by_key(df, F.col("k"), F.col("v")).first()["n_distinct"] == 4000


def test_empty_and_copies(spark):
    df = spark.createDataFrame([], "k string, v string")
    assert profile_by_key(df, F.col("k"), F.col("v")).count() == 0
    df = spark.createDataFrame([("a", "x")] * 9 + [("a", "é" * 10000)], "k string, v string")
    r = profile_by_key(df, F.col("k"), F.col("v"), n_parts=3).first()
    assert (r["n_rows"], r["n_distinct"], r["n_null"]) == (10, 2, 0)

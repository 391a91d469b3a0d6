from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinweave.operators import nearest as N
from kinweave.operators.topk import source_of
from kinweave.sources.cache import EmbeddingCache

RECORD = "entity_id string, business_name string, business_address string, country string"
S1 = [("S1-1", "Acme Corporation", "1 Main St, Springfield", "US"), ("S1-2", "Globex International Pvt Ltd", "22 Nehru Road, Delhi", "India"), ("S1-3", "Zzy Unmatched Co", "9 Nowhere Ave", "US")]
S2 = [("S2-1", "Acme Corp", "1 Main Street, Springfield", "US"), ("S2-2", "Globex Intl Private Limited", "22 Nehru Rd, Delhi", "India"), ("S2-3", "Totally Different LLC", "500 Elm St", "US"), ("S2-4", "Random Biz", "1 X St", "US")]
S3 = [("S3-1", "Acme Corporation Inc", "1 Main St, Springfield", "US")]


def vectors(spark, n=600, d=16, seed=0):
    x = np.random.default_rng(seed).normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x, spark.createDataFrame([(i % 3, i, [float(v) for v in r]) for i, r in enumerate(x)], "g int, id long, vec array<float>")


def test_flat_is_exact(spark):
    x, base = vectors(spark)
    got = {}
    for r in N.flat_search(base.where("id % 50 = 0"), base, 5, ["g"], block=64).collect():
        got.setdefault(r["left_id"], []).append((r["rank"], r["right_id"]))
    for q, found in got.items():
        ids = [i for i in range(len(x)) if i % 3 == q % 3]
        want = sorted(ids, key=lambda i: (-round(float(x[i].astype(np.float32).astype(float) @ x[q].astype(np.float32).astype(float)), 12), i))[:5]
        assert [i for _, i in sorted(found)] == want


def test_ivf_and_pq_recall(spark):
    x, base = vectors(spark, 3000)
    q = base.where("id % 100 = 0")
    flat = {(r["left_id"], r["right_id"]) for r in N.flat_search(q, base, 10, ["g"]).collect()}
    for pq_parts in (None, 8):
        found = {(r["left_id"], r["right_id"]) for r in N.ivf_search(q, base, 10, ["g"], pq_parts=pq_parts, flat_rows=0).collect()}
        assert len(flat & found) >= 0.9 * len(flat)
    # exact up to flat_rows, and in pieces of a large cell
    assert {(r["left_id"], r["right_id"]) for r in N.ivf_search(q, base, 10, ["g"]).collect()} == flat
    whole = {(r["left_id"], r["right_id"]) for r in N.ivf_search(q, base, 10, ["g"], nprobe=10_000, flat_rows=0, cell_rows=5).collect()}
    assert whole == flat


def test_probes_grow_where_there_are_no_clusters():
    rng = np.random.default_rng(2)
    loose = rng.normal(size=(2000, 32))
    tight = rng.normal(size=(50, 32)).repeat(40, axis=0) + 0.05 * rng.normal(size=(2000, 32))
    need = []
    for x in (tight, loose):
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        x = x[rng.permutation(len(x))]
        cells = N.kmeans(x, 50)
        need.append(N.probes_needed(x, N.nearest_of(x, cells)[:, 0], cells, 10, 0.97))
    assert need[0] < need[1]


def test_index_choice():
    assert [N.index_kind(n) for n in (10, 20_000, 20_001, 500_000, 500_001)] == ["flat", "flat", "ivfflat", "ivfflat", "ivfpq"]
    with pytest.raises(ValueError):
        N.index_kind(5, "tree")


def test_candidates_of_the_toy(spark, tmp_path):
    t = [spark.createDataFrame(x, RECORD) for x in (S1, S2, S3)]
    got = N.embedding_candidates(t[0], {"S2": t[1], "S3": t[2]}, k=2)
    assert got.columns == ["source1_entity_id", "candidate_entity_id", "source", "blocking_score"]
    of = lambda df, i: {r["candidate_entity_id"] for r in df.where(F.col("source1_entity_id") == i).collect()}
    assert of(got, "S1-1") == {"S2-1", "S3-1"}
    assert of(got, "S1-2") == {"S2-2"}
    assert got.where(source_of(F.col("candidate_entity_id")) != F.col("source")).count() == 0
    # the cache computes each text once and gives the same
    calls = spark.sparkContext.accumulator(0)

    class Counting(N.TrigramEmbedder):
        def __call__(self, texts):
            calls.add(len(texts))
            return super().__call__(texts)

    cache = EmbeddingCache(str(tmp_path / "cache"), Counting(), "trigrams")
    again = N.embedding_candidates(t[0], {"S2": t[1], "S3": t[2]}, k=2, embed=cache)
    first = calls.value
    assert {tuple(r) for r in again.select("source1_entity_id", "candidate_entity_id").collect()} == {tuple(r) for r in got.select("source1_entity_id", "candidate_entity_id").collect()}
    N.embedding_candidates(t[0], {"S2": t[1], "S3": t[2]}, k=2, embed=cache).count()
    assert first > 0 and calls.value == first


def test_empty(spark):
    _, base = vectors(spark, 30)
    assert N.flat_search(base.limit(0), base, 3, ["g"]).count() == 0
    assert N.flat_search(base, base.limit(0), 3, ["g"]).count() == 0

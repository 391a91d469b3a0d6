"""The most similar vectors of every vector.

Distinct vectors are dealt to shards by their nearest of a few centroids (k-means
on a bounded sample); a shard that is too large is split by hash. Each shard builds
a robust-pruned directed graph (graph.py) of all its vectors and answers, by beam
search, the queries routed to it: those whose own shard it is, and those that lie
within margin of the border to it. With margin None every query goes to every
shard. Exact copies of a vector are one node; they come back in when the answers
are spread to ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinweave.llm.graph import Graph
from kinweave.session import cut


def centroids_of(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """Unit centroids by spherical k-means; the same sample gives the same ones."""
    c = sample[np.random.default_rng(seed).choice(len(sample), k, replace=False)].astype(np.float64)
    for _ in range(rounds):
        best = (sample @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, best, sample)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 0, total / np.maximum(norm, 1e-12), c)
    return c


def usable(vec: str, dim: int) -> Column:
    """Vectors of the length dim that are sound: no null, NaN or infinite number, and not all zero."""
    v = F.col(vec)
    return v.isNotNull() & (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 1e18)) & F.exists(v, lambda x: x != 0)


def similar(
    df: DataFrame, k: int = 10, min_cosine: float | None = None, id_col: str = "entity_id", vec_col: str = "vec", shard_size: int = 12_000, sample_size: int = 20_000, margin: float | None = 0.25, beam: int = 40, asks: Column | None = None
) -> DataFrame:
    """(id, other, cosine, rank): for each id the k most similar other ids found, best first, ties by the smaller other id.

    Approximate: see the README for the recall measured against brute force. min_cosine drops less similar ones. An
    id that comes again counts once, with the vector of least hash; null ids, and null, all-zero and unsound vectors and
    those of another than the commonest length, take no part. Equal vectors have cosine 1. Fewer than two usable
    vectors give no rows. asks picks the rows that are queries (all by default); every row is searched. Other columns, whatever their names, play no part.
    """
    spark = df.sparkSession
    id_type = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<float>").alias("vec"), (F.lit(True) if asks is None else F.coalesce(asks, F.lit(False))).alias("ask")).where("id IS NOT NULL AND vec IS NOT NULL")
    lengths = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if lengths is None or not lengths["dim"]:
        return spark.createDataFrame([], f"id {id_type}, other {id_type}, cosine double, rank int")
    sound = rows.where(usable("vec", lengths["dim"])).withColumn("rid", F.xxhash64("vec"))
    # about sample_size vectors, drawn by hash, so that the driver's part does not grow
    share = min(1.0, sample_size / lengths["count"])
    drawn = sound.where(F.pmod(F.xxhash64("rid"), F.lit(1 << 30)) < int(share * (1 << 30))).select("rid", "vec").collect()
    if not drawn:
        drawn = sound.select("rid", "vec").limit(1).collect()
    if not drawn:
        return spark.createDataFrame([], f"id {id_type}, other {id_type}, cosine double, rank int")
    sample = unit(np.array([r["vec"] for r in sorted(drawn)], np.float32)).astype(np.float64)
    # no more centroids than the sample can place, so that neither the driver's part nor the routing of a vector grows with the collection
    cents = centroids_of(sample, max(1, min(math.ceil(lengths["count"] / shard_size), len(sample) // 20)))
    held_share = np.bincount((sample @ cents.T).argmax(axis=1), minlength=len(cents)) / len(sample)
    # shards that the sample shows to be too large are split by hash
    split = np.maximum(1, np.ceil(held_share * lengths["count"] / (2 * shard_size))).astype(np.int64)
    if split.max() >= 1 << 20:
        raise ValueError("shard_size is too small for so many vectors")
    held = spark.sparkContext.broadcast((cents, split))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, split = held.value
        for b in batches:
            if not b.num_rows:
                continue
            rid = b.column("rid").to_numpy(zero_copy_only=False)
            x = unit(b.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(len(rid), -1))
            sim = x @ c.T
            at = np.arange(len(x))
            home = sim.argmax(axis=1)
            # distance to the border between the own shard and each other one
            kinds, of = np.unique(home, return_inverse=True)
            gap = np.sqrt(np.maximum((c[kinds] ** 2).sum(axis=1)[:, None] + (c**2).sum(axis=1)[None] - 2 * c[kinds] @ c.T, 1e-24))
            near = (sim[at, home][:, None] - sim) / gap[of] <= (np.inf if margin is None else margin)
            near &= b.column("ask").to_numpy(zero_copy_only=False)[:, None]
            near[at, home] = True
            piece = (rid.view(np.uint64) % split[home].astype(np.uint64)).astype(np.int64)
            who, shard = np.nonzero(near)
            n = split[shard]
            who, shard = np.repeat(who, n), np.repeat(shard, n)
            part = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
            stored = (shard == home[who]) & (part == piece[who])
            flat = pa.py_buffer(np.ascontiguousarray(x[who]).tobytes())
            width = x.shape[1] * 4
            vec = pa.Array.from_buffers(pa.binary(), len(who), [None, pa.py_buffer((np.arange(len(who) + 1) * width).astype(np.int32).tobytes()), flat])
            yield pa.RecordBatch.from_arrays([pa.array(rid[who]), pa.array((shard << 20) + part), pa.array(stored), b.column("ask").take(pa.array(who)), vec], ["rid", "shard", "stored", "ask", "vec"])

    def answer(table: pa.Table) -> pa.Table:
        rid, stored, ask = (table.column(c).to_numpy() for c in ("rid", "stored", "ask"))
        x = np.frombuffer(b"".join(table.column("vec").to_pylist()), np.float32).reshape(len(rid), -1)
        # copies of one vector carry one number and are one node
        asking = np.unique(rid[ask.astype(bool)])
        rid, first = np.unique(rid, return_index=True)
        x, stored = x[first], stored[first]
        base, names = x[stored], rid[stored]
        asked = np.isin(rid, asking)
        x, rid = x[asked], rid[asked]
        if not len(base) or not len(x):
            return pa.table({"rid": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "cosine": pa.array([], pa.float64())})
        found, _ = Graph(base, beam=beam).search(x, k + 1, max(beam, k + 1))
        rows, cols = np.nonzero(found >= 0)
        a, b = rid[rows], names[found[rows, cols]]
        cos = np.einsum("ij,ij->i", x[rows].astype(np.float64), base[found[rows, cols]].astype(np.float64))
        keep = a != b
        if min_cosine is not None:
            keep &= cos >= min_cosine
        return pa.table({"rid": a[keep], "other": b[keep], "cosine": cos[keep]})

    tasks = min(int(split.sum()), 100_000)
    dealt = sound.select("rid", "vec", "ask").mapInArrow(route, "rid long, shard long, stored boolean, ask boolean, vec binary")
    found = cut(dealt.repartition(tasks, "shard").groupBy("shard").applyInArrow(answer, "rid long, other long, cosine double"))
    near = found.withColumn("_n", F.row_number().over(W.partitionBy("rid").orderBy(F.desc("cosine"), "other"))).where(F.col("_n") <= k).select("rid", "other", "cosine")
    member = cut(sound.groupBy("id").agg(F.min("rid").alias("rid"), F.max("ask").alias("ask")))
    # of a group of copies only the k + 1 smallest ids can be anyone's answer
    first = member.withColumn("_n", F.row_number().over(W.partitionBy("rid").orderBy("id"))).where(F.col("_n") <= k + 1).select(F.col("rid").alias("other"), F.col("id").alias("other_id"))
    copies = member.groupBy("rid").agg(F.count("*").alias("n")).where("n > 1").select("rid", F.col("rid").alias("other"), F.lit(1.0).alias("cosine"))
    answers = near.union(copies).join(first, "other").select("rid", "other_id", "cosine")
    top = answers.withColumn("_n", F.row_number().over(W.partitionBy("rid").orderBy(F.desc("cosine"), "other_id"))).where(F.col("_n") <= k + 1)
    spread = member.where("ask").join(top, "rid").where(F.col("id") != F.col("other_id")).withColumn("rank", F.row_number().over(W.partitionBy("id").orderBy(F.desc("cosine"), "other_id")))
    return spread.where(F.col("rank") <= k).select("id", F.col("other_id").alias("other"), "cosine", "rank")


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)

"""Candidate pairs by nearness of embedded texts."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinweave.functions.text import default_prefixes, prepare_text
from kinweave.operators.topk import cap_global
from kinweave.session import broadcast_if_small, cut, union_all

Embedder = Callable[[list[str]], np.ndarray]


class TrigramEmbedder:
    """The offline default: a bag of hashed character trigrams with a stable hash."""

    name = "trigrams"

    def __init__(self, dim: int = 256):
        self.dim = dim

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), np.float32)
        for i, t in enumerate(texts):
            t = f"  {t.lower()} "
            for j in range(len(t) - 2):
                out[i, xxhash.xxh64_intdigest(t[j : j + 3]) % self.dim] += 1
        return out


def embed_texts(df: DataFrame, embedder: Embedder, prefix: str = "", text: str = "text", out: str = "vec", batch: int = 512) -> DataFrame:
    """df with unit vectors of prefix + text in out; an all-zero embedding stays zero. Any callable from texts to an array will do."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{out}` array<float>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [prefix + (t or "") for t in pdf[text]]
            vecs = [np.asarray(embedder(texts[i : i + batch]), np.float32) for i in range(0, len(texts), batch)]
            v = np.concatenate(vecs) if vecs else np.zeros((0, 1), np.float32)
            v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
            yield pdf.assign(**{out: list(v)})

    return df.mapInPandas(run, schema)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def index_kind(n: int, kind: str = "auto") -> str:
    """flat up to 20,000 vectors, ivfflat up to 500,000, ivfpq beyond."""
    if kind == "auto":
        return "flat" if n <= 20_000 else "ivfflat" if n <= 500_000 else "ivfpq"
    if kind not in ("flat", "ivfflat", "ivfpq"):
        raise ValueError(f"unknown index type {kind!r}")
    return kind


def top_k(scored: DataFrame, k: int, by: list[str], id_col: str = "right_id") -> DataFrame:
    w = W.partitionBy(*by).orderBy(F.desc("score"), id_col)
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def flat_search(queries: DataFrame, base: DataFrame, k: int, on: list[str], block: int = 4096, ask: int = 8192) -> DataFrame:
    """(on, left_id, right_id, score, rank): exact inner-product top k of each query among base vectors with equal on.

    queries: (on, id, vec); base: the same. Both sides are cut to blocks by hash, of about block and ask rows; every two blocks
    of a group meet in one matrix product that keeps k a query, so no group sits in one task, and at most k rows a query and block are merged.
    """
    count = lambda df, n, size: df.groupBy(*on).agg(F.ceil(F.count("*") / size).cast("int").alias(n))
    sizes = broadcast_if_small(count(base, "blocks", block).join(count(queries, "parts", ask), on) if on else count(base, "blocks", block).crossJoin(count(queries, "parts", ask)))
    piece = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    meet = lambda df: df.join(sizes, on) if on else df.crossJoin(sizes)
    b = meet(base).where("blocks > 0 AND parts > 0").select(*on, F.col("id").alias("rid"), "vec", piece("blocks").alias("block"), every("parts").alias("part"), F.lit(1).alias("side"))
    q = meet(queries).where("blocks > 0 AND parts > 0").select(*on, F.col("id").alias("rid"), "vec", every("blocks").alias("block"), piece("parts").alias("part"), F.lit(0).alias("side"))
    t = dict(base.dtypes)["id"]
    keys = ", ".join(f"`{c}` {dict(base.dtypes)[c]}" for c in on)

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1].sort_values("rid")
        if not len(left) or not len(right):
            return nothing(pdf, on)
        y = np.stack(right["vec"].to_numpy()).astype(np.float64)
        found = [best_of(left.iloc[lo : lo + 1024], y, right["rid"].to_numpy(), k) for lo in range(0, len(left), 1024)]
        return pd.concat(found).assign(**{c: pdf[c].iloc[0] for c in on})[[*on, "left_id", "right_id", "score"]]

    found = q.unionByName(b).groupBy(*on, "block", "part").applyInPandas(search, f"{keys + ', ' if on else ''}left_id {t}, right_id {t}, score double")
    return top_k(found, k, [*on, "left_id"])


def nothing(pdf: pd.DataFrame, on: list[str]) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series(dtype=float if c == "score" else pdf[c if c in on else "rid"].dtype) for c in [*on, "left_id", "right_id", "score"]})


def best_of(left: pd.DataFrame, y: np.ndarray, ids: np.ndarray, k: int) -> pd.DataFrame:
    """The k best rows of y, in id order, for each query of left; ties by id."""
    m = min(k, len(ids))
    s = np.stack(left["vec"].to_numpy()).astype(np.float64) @ y.T
    best = np.argsort(-s.round(12), axis=1, kind="stable")[:, :m]
    return pd.DataFrame({"left_id": np.repeat(left["rid"].to_numpy(), m), "right_id": ids[best].ravel(), "score": np.take_along_axis(s, best, 1).ravel()})


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 0) -> np.ndarray:
    c = x[np.random.default_rng(seed).choice(len(x), min(k, len(x)), replace=False)].astype(np.float64)
    for _ in range(rounds):
        best = nearest_of(x, c)[:, 0]
        n = np.bincount(best, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, best, x)
        c[n > 0] = total[n > 0] / n[n > 0][:, None]
    return c


def nearest_of(x: np.ndarray, c: np.ndarray, n: int = 1) -> np.ndarray:
    """The n nearest rows of c for each row of x."""
    d = (c * c).sum(axis=1)[None] - 2 * x @ c.T
    return np.argsort(d, axis=1, kind="stable")[:, :n]


def ivf_search(queries: DataFrame, base: DataFrame, k: int, on: list[str], train_size: int = 20_000, nprobe: int | None = None, pq_parts: int | None = None, rescore: int = 16, target: float = 0.97, flat_rows: int = 20_000, cell_rows: int = 4096) -> DataFrame:
    """As flat_search, approximately: a query meets only the base vectors of its nearest cells.

    Every group of on has cells of its own, k-means centroids fitted on its at most train_size vectors with the smallest id hashes;
    every vector is indexed. A query probes its nprobe nearest cells; by default as many as 256 vectors of the sample need to find the
    share target of their k nearest in the sample, so that vectors without clusters are searched more widely. Groups of at most flat_rows are searched exactly. With pq_parts, vectors
    are stored as product-quantised codes beside their ids, compared by table lookup, and the best rescore * k of a cell exactly. A large
    cell is dealt to pieces of about cell_rows by hash.
    """
    groups = base.groupBy(*on).agg(F.count("*").alias("n")).where(F.col("n") > flat_rows).collect()  # at most rows / flat_rows
    large = [reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(r[c])) for c in on], F.lit(True)) for r in groups]
    small = reduce(Column.__and__, [~at for at in large], F.lit(True))
    parts = [flat_search(queries.where(small), base.where(small), k, on)]
    return union_all([*parts, *[_indexed(queries.where(at), base.where(at), r["n"], k, on, train_size, nprobe, pq_parts, rescore, target, cell_rows) for at, r in zip(large, groups, strict=True)]])


def _indexed(queries: DataFrame, base: DataFrame, n: int, k: int, on: list[str], train_size: int, nprobe: int | None, pq_parts: int | None, rescore: int, target: float, cell_rows: int) -> DataFrame:
    """ivf_search within one group of n vectors."""
    spark = base.sparkSession
    sample = np.array([r["vec"] for r in base.select("vec", F.xxhash64("id").alias("h"), "id").orderBy("h", "id").limit(train_size).collect()], np.float64)
    cells = kmeans(sample, max(1, min(4096, int(4 * math.sqrt(n)), len(sample) // 4)))
    own = nearest_of(sample, cells)[:, 0]
    held = np.bincount(own, minlength=len(cells)) / len(sample)
    nprobe = nprobe or probes_needed(sample, own, cells, k, target)
    pieces = np.maximum(1, np.ceil(held * n / cell_rows)).astype(np.int64)
    books = None
    if pq_parts:
        while sample.shape[1] % pq_parts:
            pq_parts -= 1
        books = [kmeans(p, min(256, len(p)), seed=1) for p in np.split(sample, pq_parts, axis=1)]
    index = spark.sparkContext.broadcast((cells, pieces, books))
    keys = "".join(f"`{c}` {dict(base.dtypes)[c]}, " for c in on)
    t = dict(base.dtypes)["id"]

    def store(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells, pieces, books = index.value
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack(pdf["vec"].to_numpy()).astype(np.float64)
            cell = nearest_of(x, cells)[:, 0]
            codes = [np.stack([nearest_of(p, c)[:, 0] for p, c in zip(np.split(x, len(books), axis=1), books, strict=True)], axis=1).astype(np.uint8)] if books else None
            yield pdf.assign(cell=cell.astype(np.int32), part=(pdf["h"].to_numpy() % pieces[cell]).astype(np.int32), code=[c.tobytes() for c in codes[0]] if books else b"", side=1)

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells, pieces, _ = index.value
        for pdf in batches:
            for lo in range(0, len(pdf), 2048):
                some = pdf.iloc[lo : lo + 2048]
                near = nearest_of(np.stack(some["vec"].to_numpy()).astype(np.float64), cells, nprobe)
                row, cell = np.repeat(np.arange(len(some)), near.shape[1]), near.ravel()
                many = pieces[cell]
                row, cell = np.repeat(row, many), np.repeat(cell, many)
                part = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                yield some.iloc[row].assign(cell=cell.astype(np.int32), part=part.astype(np.int32), code=b"", side=0)

    placed = f"{keys}rid {t}, vec array<float>, h long, cell int, part int, code binary, side int"
    rows = lambda df: df.select(*on, F.col("id").alias("rid"), "vec", F.pmod(F.xxhash64("id"), F.lit(1 << 30)).alias("h"))
    b = cut(rows(base).mapInPandas(store, placed))  # the index: every vector's cell, piece and code
    q = rows(queries).mapInPandas(probe, placed)

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1].sort_values("rid")
        if not len(left) or not len(right):
            return nothing(pdf, on)
        y, ids = np.stack(right["vec"].to_numpy()).astype(np.float64), right["rid"].to_numpy()
        books = index.value[2]
        out = []
        for lo in range(0, len(left), 1024):
            some = left.iloc[lo : lo + 1024]
            if not books or len(ids) <= rescore * k:
                out.append(best_of(some, y, ids, k))
                continue
            x = np.stack(some["vec"].to_numpy()).astype(np.float64)
            codes = np.frombuffer(b"".join(right["code"]), np.uint8).reshape(len(ids), -1)
            rough = sum((p @ c.T)[:, codes[:, j]] for j, (p, c) in enumerate(zip(np.split(x, len(books), axis=1), books, strict=True)))
            pick = np.sort(np.argpartition(-rough, rescore * k, axis=1)[:, : rescore * k], axis=1)
            s = np.einsum("ij,ikj->ik", x, y[pick])
            best = np.argsort(-s.round(12), axis=1, kind="stable")[:, :k]
            out.append(pd.DataFrame({"left_id": np.repeat(some["rid"].to_numpy(), best.shape[1]), "right_id": ids[np.take_along_axis(pick, best, 1)].ravel(), "score": np.take_along_axis(s, best, 1).ravel()}))
        return pd.concat(out).assign(**{c: pdf[c].iloc[0] for c in on})[[*on, "left_id", "right_id", "score"]]

    found = q.unionByName(b).groupBy(*on, "cell", "part").applyInPandas(search, f"{keys}left_id {t}, right_id {t}, score double")
    return top_k(found, k, [*on, "left_id"])


def probes_needed(sample: np.ndarray, own: np.ndarray, cells: np.ndarray, k: int, target: float) -> int:
    """How many of its nearest cells (own: each sample vector's cell) a vector must search to find the share target of its k nearest others, by the first 256 of the sample."""
    some = sample[:256]
    s = some @ sample.T
    s[np.arange(len(some)), np.arange(len(some))] = -np.inf
    best = np.argsort(-s, axis=1)[:, : min(k, len(sample) - 1)]
    place = np.argsort(nearest_of(some, cells, len(cells)), axis=1)  # of each cell in a vector's order of cells
    return int(np.quantile(np.take_along_axis(place, own[best], 1), target, method="higher")) + 1 if best.size else len(cells)


def recall_of(found: DataFrame, exact: DataFrame, on: list[str]) -> DataFrame:
    """(n_exact, recall): the share of the exact pairs that an approximate search found."""
    pair = [*on, "left_id", "right_id"]
    hit = exact.select(pair).join(found.select(pair).withColumn("_f", F.lit(1)), pair, "left")
    return hit.agg(F.count("*").alias("n_exact"), (F.count("_f") / F.greatest(F.count("*"), F.lit(1))).alias("recall"))


def search(queries: DataFrame, base: DataFrame, k: int, on: list[str], kind: str = "auto") -> DataFrame:
    """flat_search or ivf_search for each group of on, as index_kind says for its size; a group searched by cells has its own."""
    index_kind(0, kind)  # an unknown kind fails before any work
    if kind == "flat":
        return flat_search(queries, base, k, on)
    large = []
    for r in base.groupBy(*on).agg(F.count("*").alias("n")).where(F.col("n") > (20_000 if kind == "auto" else 0)).collect():
        large.append((reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(r[c])) for c in on], F.lit(True)), index_kind(r["n"], kind)))
    if not large:
        return flat_search(queries, base, k, on)
    found = [ivf_search(queries.where(at), base.where(at), k, on, pq_parts=48 if chosen == "ivfpq" else None, flat_rows=0) for at, chosen in large]
    small = ~reduce(Column.__or__, [at for at, _ in large])
    return union_all([flat_search(queries.where(small), base.where(small), k, on), *found])


def embedding_candidates(
    s1: DataFrame, others: dict[str, DataFrame], embedder: Embedder | None = None, model_name: str = "trigrams", fields: tuple[str, ...] = ("name",), k: int = 30, same_country_only: bool = True, kind: str = "auto",
    query_prefix: str | None = None, passage_prefix: str | None = None, embed: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Pairs by cosine of embedded raw texts, capped over all fields and sources. embed(df, prefix) may serve vectors from a cache."""
    embedder = embedder or TrigramEmbedder()
    qp, pp = default_prefixes(model_name)
    qp, pp = qp if query_prefix is None else query_prefix, pp if passage_prefix is None else passage_prefix
    embed = embed or (lambda df, prefix: embed_texts(df, embedder, prefix))
    country = F.col("country") if same_country_only else F.lit("*")
    parts = []
    for f in fields:
        q = prepare_text(s1, f).select(F.col("entity_id").alias("id"), country.alias("country"), "text").where("text <> ''")
        b = union_all([prepare_text(df, f).select(F.col("entity_id").alias("id"), country.alias("country"), "text", F.lit(src).alias("src")) for src, df in others.items()]).where("text <> ''")
        sources = list(others)
        base = cut(embed(b, pp).select("src", "country", "id", "vec"))
        asked = cut(embed(q, qp).select("country", "id", "vec")).withColumn("src", F.explode(F.array(*map(F.lit, sources))))
        parts.append(search(asked.select("src", "country", "id", "vec"), base, k, ["src", "country"], kind))
    pairs = union_all([p.select(F.col("left_id").alias("source1_entity_id"), F.col("right_id").alias("candidate_entity_id"), F.col("score").alias("blocking_score")) for p in parts])
    return cap_global(pairs, k)

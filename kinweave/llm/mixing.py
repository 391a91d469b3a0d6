"""Mixing sources to target shares of the total size.

Every document's size is its number of tokens. The largest mixture that honours
the shares and repeats no source more than it may is found from the sources'
totals; where the caps leave a source short, the others keep their shares among
themselves. Each source then enters in complete epochs and one fractional epoch,
which Efraimidis-Spirakis sampling fills: each document draws the key
-ln(u) / weight with u uniform by a hash of its id, documents are sorted by key
within their source, and the prefix sum of tokens is cut at the budget.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinweave.session import cut, partitions

PIECE = 1_000_000
# The pre-splitting rule of the public byte-level vocabulary, a fixed value.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encoders: dict[str, object] = {}


def encoder(path: str):
    """The tokenizer of a ranks file, made once for each worker."""
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _encoders[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def count_tokens(texts: list[str | None], path: str) -> list[int]:
    """Tokens of each text; null and empty texts have 0. Texts over PIECE characters are counted piecewise, cut at line ends where there are any."""
    enc = encoder(path)

    def count(t: str) -> int:
        n, lo = 0, 0
        while lo < len(t):
            hi = min(len(t), lo + PIECE)
            if hi < len(t):
                line = t.rfind("\n", lo + PIECE // 2, hi)
                hi = line + 1 if line > 0 else hi
            n += len(enc.encode_ordinary(t[lo:hi]))
            lo = hi
        return n

    return [count(t) if t else 0 for t in texts]


def with_tokens(df: DataFrame, id_col: str, keep: dict[str, Column], text: str, tokenizer: str) -> DataFrame:
    """(id, the columns of keep, n_tokens); texts are read in a map-only stage and dropped at once."""
    rows = df.select(F.col(id_col).alias("id"), *[c.alias(k) for k, c in keep.items()], F.col(text).alias("_text"))
    fields = [f for f in rows.schema.fields if f.name != "_text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = pa.array(count_tokens(b.column("_text").to_pylist(), tokenizer), pa.int64())
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in fields], n], [*[f.name for f in fields], "n_tokens"])

    return rows.mapInArrow(run, schema)


def budgets(totals: dict[str, int], targets: dict[str, float], max_repeats: dict[str, int], size: int | None = None) -> dict[str, float]:
    """Tokens each source gives.

    Without size, the largest total at which the source that runs out first still holds its share; with size, that
    total, where sources that run out give all they may and the others share what is left by their targets, as far
    as they reach. Sources without tokens or target give 0.
    """
    cap = {s: totals.get(s, 0) * max(0, max_repeats[s] or 0) for s in targets}
    live = {s: w for s, w in targets.items() if (w or 0) > 0 and cap[s] > 0}
    if not live:
        return dict.fromkeys(targets, 0.0)
    if size is None:
        size = int(min(cap[s] / (w / sum(live.values())) for s, w in live.items()))
    out, left, open_ = dict.fromkeys(targets, 0.0), float(min(size, sum(cap[s] for s in live))), dict(live)
    while open_ and left > 1e-9:
        scale = left / sum(open_.values())
        full = [s for s, w in open_.items() if w * scale >= cap[s]]
        if not full:
            for s, w in open_.items():
                out[s] = w * scale
            break
        for s in full:
            out[s] = float(cap[s])
            left -= cap[s]
            del open_[s]
    return out


def mix(docs: DataFrame, targets: DataFrame, tokenizer: str, weight: Column | None = None, size: int | None = None, id_col: str = "doc_id", source: str = "source", text: str = "text", seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(chosen, report). chosen: (doc_id, source, n_tokens, repeats), the documents of the mixture; report: one row for each target.

    Sources compare trimmed and in lower case; documents of a null, blank or unlisted source take no part. targets has
    source, target_share and max_repeats, a few rows; a repeated source there counts once. weight is a positive
    quality (1 by default; null, NaN and values not above 0 count as the smallest positive weight 1e-9): heavier documents come first. Documents of
    a repeated id count once, the one with most tokens; null ids take no part. Ties of the key go by id. The last
    document of a fractional epoch is taken while the prefix before it is below the budget and taking it comes nearer to it, so a
    source misses its budget by half a document at most. Documents without tokens are never chosen.
    """
    spark = docs.sparkSession
    goals = {r["source"].strip().lower(): (float(r["target_share"] or 0), int(r["max_repeats"] or 0)) for r in targets.select("source", "target_share", "max_repeats").collect() if r["source"]}
    key = F.lower(F.trim(F.col(source)))
    w = F.coalesce(weight.cast("double"), F.lit(0.0)) if weight is not None else F.lit(1.0)
    listed = docs.where(F.col(id_col).isNotNull() & key.isin(*goals))
    sized = with_tokens(listed, id_col, {"source": key, "weight": F.when(F.isnan(w) | (w <= 0), F.lit(1e-9)).otherwise(w)}, text, tokenizer)
    one = sized.groupBy("id").agg(F.max(F.struct("n_tokens", "source", "weight")).alias("r")).select("id", "r.*").where("n_tokens > 0")
    u = (F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    keyed = cut(one.withColumn("key", -F.log(u) / F.col("weight")))
    held = keyed.groupBy("source").agg(F.sum("n_tokens").alias("n"), F.max("n_tokens").alias("largest")).collect()  # one row for each target
    totals, largest = {r["source"]: r["n"] for r in held}, {r["source"]: r["largest"] for r in held}
    give = budgets(totals, {s: g[0] for s, g in goals.items()}, {s: g[1] for s, g in goals.items()}, size)
    plan = [(s, totals.get(s, 0), give[s], int(give[s] // totals[s]) if totals.get(s) else 0, give[s] % totals[s] if totals.get(s) else 0.0, largest.get(s, 0)) for s in goals]
    plan_df = spark.createDataFrame(pd.DataFrame(plan, columns=["source", "total_tokens", "budget", "epochs", "rest", "largest"]), "source string, total_tokens long, budget double, epochs long, rest double, largest long")
    order = prefix_sums(keyed)
    taken = order.join(F.broadcast(plan_df), "source").withColumn("extra", ((F.col("before") < F.col("rest")) & (F.col("rest") - F.col("before") >= F.col("n_tokens") / 2)).cast("long"))
    chosen = taken.withColumn("repeats", F.col("epochs") + F.col("extra")).where("repeats > 0").select(F.col("id").alias(id_col), "source", "n_tokens", "repeats")
    got = chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("n_docs"), F.max("repeats").alias("max_used"))
    shares = spark.createDataFrame(pd.DataFrame([(s, g[0], g[1]) for s, g in goals.items()], columns=["source", "target_share", "max_repeats"]), "source string, target_share double, max_repeats int")
    report = shares.join(got, "source", "left").join(plan_df.select("source", "total_tokens", "budget", "largest"), "source").na.fill(0, ["tokens", "n_docs", "max_used"])
    every = report.agg(F.sum("tokens").alias("all_tokens"))
    report = report.crossJoin(F.broadcast(every)).withColumn("share", F.when(F.col("all_tokens") > 0, F.col("tokens") / F.col("all_tokens")).otherwise(0.0)).drop("all_tokens")
    return chosen, report


def prefix_sums(keyed: DataFrame) -> DataFrame:
    """keyed with before, the tokens of its source ahead of it in the order (key, id), without ever putting a source in one task.

    Rows are range-partitioned on (source, key, id); sums run within a partition and source, and each starts from the
    sum of that source over the partitions before: at most partitions x sources small rows.
    """
    n = partitions(keyed.sparkSession)
    ranged = cut(keyed.repartitionByRange(n, "source", "key", "id").withColumn("part", F.spark_partition_id()))
    inner = W.partitionBy("source", "part").orderBy("key", "id").rowsBetween(W.unboundedPreceding, -1)
    heads = ranged.groupBy("source", "part").agg(F.sum("n_tokens").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("source", "part", "base")
    run = ranged.withColumn("run", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)))
    return run.join(F.broadcast(heads), ["source", "part"]).withColumn("before", F.col("base") + F.col("run")).drop("part", "base", "run")

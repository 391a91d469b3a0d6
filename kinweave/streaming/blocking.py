"""Blocking of records that arrive as a stream against a table of known ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.functions.text import prepare
from kinweave.operators.blocking import KEYS, allowed_keys, token_weights


def reference_keys(ref: DataFrame, cap: int | None = 2000) -> DataFrame:
    """(src, country, signal, key, candidate_entity_id, score): the keys of prepared reference records within the cap, to be kept as a table."""
    parts = []
    for signal, score in (("block_key", 1.0), ("postal", 0.9)):
        ok = allowed_keys(ref, signal, cap).select(*KEYS, "key")
        parts.append(ref.select(*KEYS, F.lit(signal).alias("signal"), F.col(signal).alias("key"), F.col("entity_id").alias("candidate_entity_id"), F.lit(score).alias("score")).join(ok, [*KEYS, "key"], "left_semi"))
    w = token_weights(ref, cap=cap).select(*KEYS, "key", F.col("weight").alias("score"))
    words = ref.select(*KEYS, F.lit("token").alias("signal"), F.explode(F.split("name_core", " ")).alias("key"), F.col("entity_id").alias("candidate_entity_id"))
    parts.append(words.join(w, [*KEYS, "key"]).select(*KEYS, "signal", "key", "candidate_entity_id", "score"))
    cols = [*KEYS, "signal", "key", "candidate_entity_id", "score"]
    return parts[0].select(cols).unionByName(parts[1].select(cols)).unionByName(parts[2].select(cols))


def record_keys(prepared: DataFrame) -> DataFrame:
    """The keys of records, without aggregation, so that it also runs on streams."""
    word = F.transform(F.filter(F.split("name_core", " "), lambda t: F.length(t) >= 3), lambda t: F.struct(F.lit("token").alias("signal"), t.alias("key")))
    keys = F.concat(F.array(*[F.struct(F.lit(s).alias("signal"), F.col(s).alias("key")) for s in ("block_key", "postal")]), word)
    return prepared.select(F.col("entity_id").alias("source1_entity_id"), "country", F.explode(F.filter(keys, lambda k: k["key"] != "")).alias("k")).select("source1_entity_id", "country", "k.*")


def match_stream(arriving: DataFrame, keys: DataFrame) -> DataFrame:
    """Stream-static join: (source1_entity_id, candidate_entity_id, source, signal, key, score) for every shared key of an arriving record."""
    hits = record_keys(prepare_stream(arriving)).join(keys, ["country", "signal", "key"])
    return hits.select("source1_entity_id", "candidate_entity_id", F.col("src").alias("source"), "signal", "key", "score")


def prepare_stream(df: DataFrame) -> DataFrame:
    """prepare without its distinct, which a stream would have to keep state for."""
    if not df.isStreaming:
        return prepare(df)
    from kinweave.functions import text as t

    c = df.select("entity_id", F.coalesce("country", F.lit("")).alias("country"), t.basic_clean(F.col("business_name")).alias("n"), t.basic_clean(F.col("business_address")).alias("a"))
    c = c.select("entity_id", "country", t.name_norm(F.col("n")).alias("name_norm"), t.name_core(F.col("n")).alias("name_core"), t.addr_norm(F.col("a")).alias("addr_norm"), t.postal_code(F.col("a")).alias("postal"))
    return c.withColumn("block_key", t.block_key(F.col("name_core")))


def capped_batches(out, k: int):
    """A foreachBatch function that caps each batch's candidates at k per record (each record arrives once) and hands them to out(pairs, batch_id)."""
    from kinweave.operators.topk import cap_global

    def run(batch: DataFrame, batch_id: int) -> None:
        total = batch.groupBy("source1_entity_id", "candidate_entity_id", "signal").agg(F.least(F.lit(1.0), F.sum("score")).alias("blocking_score"))
        out(cap_global(total, k), batch_id)

    return run

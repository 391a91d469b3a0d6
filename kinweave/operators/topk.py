"""Capping candidate pairs per record, merging pair sets, id lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinweave.functions.text import source_of
from kinweave.session import union_all

PAIR = ["source1_entity_id", "candidate_entity_id"]


def _capped(pairs: DataFrame, by: list[str], k: int, score: Column) -> DataFrame:
    best = pairs.groupBy(*dict.fromkeys([*PAIR, *by])).agg(F.max(score).alias("blocking_score"))
    rank = F.row_number().over(W.partitionBy(*by).orderBy(F.desc("blocking_score"), "candidate_entity_id"))
    return best.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def cap_per_source(pairs: DataFrame, k: int, digits: int | None = None) -> DataFrame:
    """The k best candidates of each record in each source and country; ties by candidate id. digits rounds scores before ranking."""
    score = F.round("blocking_score", digits) if digits is not None else F.col("blocking_score")
    by = ["source1_entity_id", "source", *(["country"] if "country" in pairs.columns else [])]
    return _capped(pairs, by, k, score)


def best_of_lists(lists: DataFrame, by: list[str], k: int) -> DataFrame:
    """(by, right_id, score): the k best distinct right_id of each by over its lists of (right_id, below), score the negative of its least below; ties by right_id.

    Lists are brought together and sorted by by, and ranked on Arrow batch by batch: pairs that don't stay never are rows. Only the lists of one by are held over from batch to batch.
    """
    types = dict(lists.dtypes)
    id_type = lists.schema["items"].dataType.elementType["right_id"].dataType.simpleString()

    def best(t: pa.Table, new: np.ndarray) -> pa.Table:
        items = t["items"].combine_chunks()
        group = np.repeat(np.cumsum(new) - 1, pc.list_value_length(items).to_numpy())
        flat = items.flatten()
        ids, below = flat.field("right_id").dictionary_encode(null_encoding="encode"), flat.field("below").to_numpy()
        code = ids.indices.to_numpy()
        rank = np.empty(len(ids.dictionary), np.int64)
        rank[pc.sort_indices(ids.dictionary, null_placement="at_start").to_numpy()] = np.arange(len(rank))
        order = np.lexsort((rank[code], below, group))
        pair = (group * len(rank) + rank[code])[order]
        # a right_id's first item has its best score
        first = np.sort(np.unique(pair, return_index=True)[1])
        order = order[first]
        head = np.flatnonzero(np.append(True, group[order][1:] != group[order][:-1]))
        place = np.arange(len(order)) - np.repeat(head, np.diff(np.append(head, len(order))))
        order = order[place < k]
        mine = t.select(by).take(pa.array(np.flatnonzero(new)[group[order]]))
        return pa.table([*mine.columns, ids.dictionary.take(pa.array(code[order])), pa.array(-below[order])], names=[*by, "right_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def starts(t: pa.Table) -> np.ndarray:
            codes = [t[c].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy() for c in by]
            return np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in codes]))

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            t = pa.Table.from_batches(held)
            new = starts(t)
            last = int(np.flatnonzero(new)[-1])
            if last:
                yield from best(t.slice(0, last), new[:last]).to_batches()
            held = t.slice(last).combine_chunks().to_batches()
        if held:
            t = pa.Table.from_batches(held)
            yield from best(t, starts(t)).to_batches()

    fields = [*(f"{c} {types[c]}" for c in by), f"right_id {id_type}", "score double"]
    return lists.select(*by, "items").repartition(*by).sortWithinPartitions(*by).mapInArrow(run, ", ".join(fields))


def cap_global(pairs: DataFrame, k: int, digits: int | None = None) -> DataFrame:
    """The k best candidates of each record over all sources, with source taken from the candidate's id."""
    score = F.round("blocking_score", digits) if digits is not None else F.col("blocking_score")
    return _capped(pairs, ["source1_entity_id"], k, score).select(*PAIR, source_of(F.col("candidate_entity_id")).alias("source"), "blocking_score")


def distinct_pairs(pairs: DataFrame) -> DataFrame:
    """Every pair once, with its highest score and source taken from the candidate's id; no cap."""
    return pairs.groupBy(*PAIR).agg(F.max("blocking_score").alias("blocking_score")).select(*PAIR, source_of(F.col("candidate_entity_id")).alias("source"), "blocking_score")


def merge_candidates(*sets: DataFrame, k: int = 30) -> DataFrame:
    """Union of pair sets, a pair's highest score, capped over all sources. Empty sets give no rows."""
    return cap_global(union_all([s.select(*PAIR, "blocking_score") for s in sets]), k)


def joined_lists(pairs: DataFrame, spine: DataFrame, out: str = "candidate_entity_ids") -> DataFrame:
    """(source1_entity_id, list): each record of spine with its distinct candidates sorted and joined by commas, '' for none."""
    lists = pairs.groupBy("source1_entity_id").agg(F.array_join(F.array_sort(F.collect_set("candidate_entity_id")), ",").alias(out))
    return spine.select("source1_entity_id").join(lists, "source1_entity_id", "left").select("source1_entity_id", F.coalesce(out, F.lit("")).alias(out))

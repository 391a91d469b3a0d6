"""Positions in a global order, and neighbourhoods in it, over any number of tasks."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.session import cut, partitions


def positions(df: DataFrame, order: list[str], name: str = "pos") -> DataFrame:
    """df with each row's position (from 0) in the given total order.

    Rows are range-partitioned by sampled quantiles and numbered within their partition; only the partitions' sizes
    reach the driver. No task holds more than a partition, however frequent a key is. Empty tables stay empty.
    """
    ranged = df.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = cut(ranged)
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).orderBy("_part").collect()  # one row for each partition
    base, total = [], 0
    for r in sizes:
        base.append((r["_part"], total))
        total += r["n"]
    bases = df.sparkSession.createDataFrame(base, "_part long, _base long")
    based = placed.withColumn("_part", part).join(F.broadcast(bases), "_part")  # as many rows as partitions
    return based.withColumn(name, F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_part", "_base")


def in_blocks(df: DataFrame, order: list[str], window: int, compare: Callable[[pd.DataFrame, int], pd.DataFrame], schema: str, block: int = 4000) -> DataFrame:
    """compare(rows, n_own) of every block, whose rows come in order; pairs whose first row is among the first n_own are this block's own.

    Blocks have equal length and overlap by window, so every two rows at most window apart meet in the block of the first.
    order must be a total order (end it with an id). An empty table gives no rows.
    """
    placed = positions(df, order, "_pos")
    own = F.floor(F.col("_pos") / block).cast("long")
    # the first rows of a block are also the last of the block before
    to = F.when((F.col("_pos") % block < window) & (F.col("_pos") >= block), F.array(own, own - 1)).otherwise(F.array(own))
    dealt = placed.withColumn("_block", F.explode(to))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos", ignore_index=True)
        n_own = int((pdf["_pos"] // block == pdf["_block"]).sum())
        return compare(pdf, n_own)

    return dealt.groupBy("_block").applyInPandas(run, schema)


def pairs_within(df: DataFrame, group: list[str], key: str, side: str, id_col: str, window: int, left_side: int = 0, reach: str | None = None) -> DataFrame:
    """(group, left id, right id, distance): rows of opposite sides at most window positions apart in their group's order (key, side, id).

    Left rows are joined with the right rows of their own bucket of window positions and of both beside it, inside the JVM. A column
    reach gives the distance up to which a left row's pairs are wanted, null for all.
    """
    placed = positions(df.select(*group, key, side, id_col, *([reach] if reach else [])), [*group, key, side, id_col])
    bucket = F.floor(F.col("pos") / window)
    far = F.coalesce(F.col(reach), F.lit(window)) if reach else F.lit(window)
    a = placed.where(F.col(side) == left_side).select(*group, F.col(id_col).alias("left_id"), F.col("pos").alias("_p1"), far.alias("_far"), F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("_b"))
    b = placed.where(F.col(side) != left_side).select(*group, F.col(id_col).alias("right_id"), F.col("pos").alias("_p2"), bucket.alias("_b"))
    d = F.abs(F.col("_p2") - F.col("_p1"))
    return a.join(b, [*group, "_b"]).where((d <= window) & (d <= F.col("_far"))).select(*group, "left_id", "right_id", d.alias("distance"))


def lists_within(df: DataFrame, group: list[str], key: str, side: str, id_col: str, worth: list[float], left_side: int = 0, reach: str | None = None, block: int = 4000) -> DataFrame:
    """(group, left_id, items): the pairs of pairs_within in a window of len(worth) as one list of (right_id, below) for each left row that has any, below the negative worth of the distance.

    Done by blocks of positions that overlap by the window, on Arrow: a left row's neighbours are one stretch of its block's right rows.
    """
    window = len(worth)
    block = max(block, 4 * window)
    placed = positions(df.select(*group, key, side, id_col, *([reach] if reach else [])), [*group, key, side, id_col])
    far = F.least(F.coalesce(F.col(reach), F.lit(window)), F.lit(window)) if reach else F.lit(window)
    to = F.explode(F.sequence(F.floor((F.col("pos") - window) / block), F.floor((F.col("pos") + window) / block)))
    known = reduce(lambda a, b: a & b, [F.col(g).isNotNull() for g in group])
    dealt = placed.where(known).select(*group, (F.col(side) == left_side).alias("_left"), F.col(id_col).alias("_id"), "pos", far.cast("long").alias("_far"), to.alias("_b"))
    below = -np.array([0.0, *worth])

    def near(t: pa.Table) -> pa.Table:
        t = t.sort_by("pos").combine_chunks()
        pos, left, far = (t[c].to_numpy() for c in ("pos", "_left", "_far"))
        # a group's rows stand together: where each row's group begins and ends
        codes = [t[g].combine_chunks().dictionary_encode().indices.to_numpy() for g in group]
        new = np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in codes]))
        start, of = np.flatnonzero(new), np.cumsum(new) - 1
        begin, end = pos[start][of], pos[np.append(start[1:], len(pos)) - 1][of]
        rights = np.flatnonzero(~left)
        own = np.flatnonzero(left & (pos // block == t["_b"][0].as_py()))
        lo = np.searchsorted(pos[rights], np.maximum(pos[own] - far[own], begin[own]))
        n = np.maximum(np.searchsorted(pos[rights], np.minimum(pos[own] + far[own], end[own]), side="right") - lo, 0)
        own, lo, n = own[n > 0], lo[n > 0], n[n > 0]
        upto = np.append(0, np.cumsum(n))
        met = rights[np.repeat(lo - upto[:-1], n) + np.arange(upto[-1])]
        distance = np.abs(pos[met] - np.repeat(pos[own], n))
        items = pa.StructArray.from_arrays([t["_id"].combine_chunks().take(pa.array(met)), pa.array(below[distance])], names=["right_id", "below"])
        mine = t.take(pa.array(own))
        return pa.table([*(mine[g] for g in group), mine["_id"], pa.ListArray.from_arrays(pa.array(upto, pa.int32()), items)], names=[*group, "left_id", "items"])

    types = dict(placed.dtypes)
    fields = [*(f"{g} {types[g]}" for g in group), f"left_id {types[id_col]}", f"items array<struct<right_id: {types[id_col]}, below: double>>"]
    return dealt.repartition(partitions(df.sparkSession), "_b").groupBy("_b").applyInArrow(near, ", ".join(fields))

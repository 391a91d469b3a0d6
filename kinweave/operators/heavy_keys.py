"""Per-key results when a few keys hold most rows.

Rows are range-partitioned on (key, secondary, tie) with sampled quantiles, so
a heavy key spreads over as many partitions as its share of rows asks for. Each
partition is read once in sorted order and leaves one partial state per key it
holds; the states of neighbouring partitions are then stitched. A partition
border may fall inside a key or inside one (key, secondary) pair: the states
carry their first and last secondary value so that no distinct value counts twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinweave.session import cut, partitions

PARTIAL = "part int, key string, n_rows long, n_distinct long, n_null long, first_value string, last_value string"


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One state per key of this sorted partition; only the open key's state is held between batches."""
    state: list | None = None
    part = None
    done: list[list] = []

    def flush() -> pa.RecordBatch:
        cols = list(zip(*done, strict=True))
        types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["part", "key", "n_rows", "n_distinct", "n_null", "first_value", "last_value"])

    for batch in batches:
        if not batch.num_rows:
            continue
        key, val, part = batch.column("key"), batch.column("secondary"), batch.column("part")[0].as_py()
        runs = pc.run_end_encode(key)
        ends = runs.run_ends.to_pylist()
        start = 0
        for k, end in zip(runs.values.to_pylist(), ends, strict=True):
            v = val.slice(start, end - start)
            v_set = v.drop_null()
            n = len(v_set)
            changes = 1 + pc.sum(pc.not_equal(v_set.slice(1), v_set.slice(0, n - 1)), min_count=0).as_py() if n else 0
            first, last = (v_set[0].as_py(), v_set[n - 1].as_py()) if n else (None, None)
            if state is not None and state[1] == k:
                state[3] += changes - (n > 0 and state[6] == first)
                state[2] += end - start
                state[4] += end - start - n
                state[5] = state[5] if state[5] is not None else first
                state[6] = last if n else state[6]
            else:
                if state is not None:
                    done.append(state)
                state = [part, k, end - start, changes, end - start - n, first, last]
            start = end
        if len(done) >= 4096:
            yield flush()
            done = []
    if state is not None:
        done.append(state)
    if done:
        yield flush()


def profile_by_key(df: DataFrame, key: Column, secondary: Column, tie: Column | None = None, n_parts: int | None = None) -> DataFrame:
    """Rows, distinct secondary values and null secondary values of every key: (key, n_rows, n_distinct, n_null).

    Key and secondary are compared as strings. A null key is a key of its own (null in the result); null
    secondary values count in n_null and n_rows only. Repeated rows all count in n_rows. An empty table gives
    no rows. Other columns of df, whatever their names, play no part. tie breaks up a (key, secondary) pair that is
    itself heavy; the hash of the whole row by default.
    """
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) if tie is None else tie
    n = n_parts or partitions(df.sparkSession)
    rows = df.select(key.cast("string").alias("key"), secondary.cast("string").alias("secondary"), tie.alias("tie"))
    spread = rows.repartitionByRange(n, "key", "secondary", "tie").sortWithinPartitions("key", "secondary").select(F.spark_partition_id().alias("part"), "key", "secondary")
    # at most (partitions + keys) states; cut because the sampled borders must not be drawn twice
    states = cut(spread.mapInArrow(_partials, PARTIAL))
    border = W.partitionBy("key").orderBy("part")
    # the last value seen before this partition, over states that hold a value
    before = F.last("last_value", ignorenulls=True).over(border.rowsBetween(W.unboundedPreceding, -1))
    return (
        states.withColumn("again", F.coalesce((before == F.col("first_value")).cast("long"), F.lit(0).cast("long")))
        .groupBy("key")
        .agg(F.sum("n_rows").alias("n_rows"), F.sum(F.col("n_distinct") - F.col("again")).alias("n_distinct"), F.sum("n_null").alias("n_null"))
    )


def with_share(profile: DataFrame) -> DataFrame:
    """Adds share, the key's part of all rows. The total is summed over the profile (one row per key), not the table."""
    total = profile.agg(F.sum("n_rows").alias("total_rows"))
    return profile.crossJoin(F.broadcast(total)).withColumn("share", F.col("n_rows") / F.col("total_rows")).drop("total_rows")


def heavy_keys(df: DataFrame, key: Column, secondary: Column, share: float, n_parts: int | None = None) -> DataFrame:
    """The non-blank keys that hold more than share of all rows, with their profile. Blank and null keys count in the total only."""
    return with_share(profile_by_key(df, key, secondary, n_parts=n_parts)).where((F.col("share") > share) & (F.col("key") != ""))

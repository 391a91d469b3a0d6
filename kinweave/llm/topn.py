"""The N best items of every group, with one tie rule, however large a group is.

Two-stage salted ranking: a group's items are spread over subgroups by a hash of
the item, each subgroup keeps its N best, and the survivors (at most N a
subgroup) are ranked once more. The one shuffle that moves all rows is keyed by
(group, subgroup); repeated items of a group meet in the same subgroup, so they
are merged there without another shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group: Column, item: Column, score: Column, n: int, subgroups: int = 32, names: tuple[str, str, str] = ("group", "item", "score")) -> DataFrame:
    """(group, item, score, rank) of the n best distinct items of every group.

    Rows whose group or item is null or blank, or whose score is null or NaN, don't count. An item that occurs
    several times in a group counts once, with its highest score. Higher scores come first; equal scores go by
    the smaller item. An empty table gives no rows; n < 1 gives no rows. Columns of df are never carried, so clashing names don't matter.
    """
    g, i, s = (F.col(c) for c in ("_group", "_item", "_score"))
    rows = df.select(group.alias("_group"), item.alias("_item"), score.cast("double").alias("_score"))
    rows = rows.where(g.isNotNull() & i.isNotNull() & (g.cast("string") != "") & (i.cast("string") != "") & s.isNotNull() & ~F.isnan(s))
    salted = rows.withColumn("_sub", F.pmod(F.xxhash64(i), F.lit(subgroups)).cast("int")).repartition("_group", "_sub")
    merged = salted.groupBy("_group", "_sub", "_item").agg(F.max("_score").alias("_score"))
    best = (s.desc(), i.asc())
    kept = merged.withColumn("_rank", F.row_number().over(W.partitionBy("_group", "_sub").orderBy(*best))).where(F.col("_rank") <= n)
    final = kept.withColumn("_rank", F.row_number().over(W.partitionBy("_group").orderBy(*best))).where(F.col("_rank") <= n)
    return final.select(g.alias(names[0]), i.alias(names[1]), s.alias(names[2]), F.col("_rank").alias("rank"))

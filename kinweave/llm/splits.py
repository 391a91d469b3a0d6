"""Splits that keep related records together.

Records that share a value of any key column are related, directly or through
others. The values are the nodes of a graph, the records its edges; hash-to-min
finds the components: every node keeps a cluster of nodes it knows, sends the
whole cluster to the cluster's smallest node and that smallest node to all
others, until nothing changes. Weighted rendezvous hashing then draws a split
for every component; components that hold a marked share of all rows are dealt
out first, largest first, to the split that lacks most rows, so that one huge
component cannot upset the shares. What they take of a split's share is rounded to
fiftieths before the others' weights are set, so that some rows more or less move
no other component.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinweave.session import cut


def hash_to_min(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges (a, b); component is its smallest node.

    Clusters are rows (owner, member), not arrays, so a large component is never one value. Only the smallest
    node of a component comes to own the whole cluster; its rows meet its one least member in a join on owner, whose large
    partitions adaptive execution splits, and are spread by (owner, member) elsewhere.
    Null ends are ignored; loops and repeated edges are harmless; no edges give no rows.
    """
    e = edges.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull())
    nodes = e.select(F.explode(F.array("a", "b")).alias("node"))
    known = cut(
        e.select(F.explode(F.array(F.struct(F.col("a").alias("owner"), F.col("b").alias("member")), F.struct(F.col("b").alias("owner"), F.col("a").alias("member")))).alias("p"))
        .select("p.*")
        .union(nodes.select("node", F.col("node").alias("member")))
        .distinct()
    )
    before = None
    for _ in range(max_rounds):
        least = known.groupBy("owner").agg(F.min("member").alias("least"))
        told = known.join(least, "owner").select("least", "member")
        known = cut(
            told.select(F.col("least").alias("owner"), "member")
            .union(told.select(F.col("member").alias("owner"), F.col("least").alias("member")))
            .distinct()
        )
        # stable when the clusters are stars: as many rows, over the same (owner, member) pairs
        state = known.agg(F.count("*").alias("n"), F.sum(F.xxhash64("owner", "member").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components were not stable after {max_rounds} rounds")
    return known.groupBy(F.col("owner").alias("node")).agg(F.min("member").alias("component"))


def rendezvous(component: Column, weights: Mapping[str, float], seed: int = 0) -> Column:
    """The name of the split with the highest -weight/ln(u), u uniform by a hash of (split, component): each wins in proportion to its weight."""
    live = sorted((k, float(w)) for k, w in weights.items() if w > 0)
    if not live:
        raise ValueError("no split has a positive weight")

    def draw(name: str, w: float) -> Column:
        u = (F.pmod(F.xxhash64(F.lit(name), component, F.lit(seed)), F.lit(1 << 40)).cast("double") + 0.5) / float(1 << 40)
        return F.struct((-F.lit(w) / F.log(u)).alias("score"), F.lit(name).alias("name"))

    return F.array_max(F.array(*[draw(k, w) for k, w in live]))["name"]


def assign_splits(df: DataFrame, keys: Mapping[str, Column], targets: Mapping[str, float], heavy_share: float = 0.002, seed: int = 0, out: str = "split") -> DataFrame:
    """df with a column named by out: the split of every row, in shares near targets (any positive numbers; they are scaled to 1).

    Rows that share a non-null value of any key go to one split, also through chains of rows. A key's values are its
    own (the same text in two keys links nothing); keys compare exactly, so pass normalised expressions. A row whose
    keys are all null is related to nothing and drawn by the hash of its content: its exact copies stay with it.
    A component that holds more than heavy_share of all rows is dealt out before the draw; there are at most
    1 / heavy_share of them, which bounds what the driver sees. Splits without rows left to fill take no part in
    the draw. Empty df: no rows. A column of df named like out is replaced; working columns are prefixed _sp_.
    """
    total_w = sum(w for w in targets.values() if w and w > 0)
    if total_w <= 0:
        raise ValueError("targets need a positive share")
    shares = {k: max(0.0, w or 0.0) / total_w for k, w in targets.items()}
    names = list(keys)
    tagged = df.withColumns({f"_sp_{i}": F.when(keys[k].isNotNull(), F.concat(F.lit(f"{i}:"), keys[k].cast("string"))) for i, k in enumerate(names)})
    cols = [f"_sp_{i}" for i in range(len(names))]
    # the first non-null key anchors a row; every other non-null key is an edge to it
    tagged = tagged.withColumn("_sp_anchor", F.coalesce(*[F.col(c) for c in cols], F.concat(F.lit("row:"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("string"))))
    if len(cols) > 1:
        links = tagged.select("_sp_anchor", F.explode(F.array(*cols[1:])).alias("b")).where(F.col("b").isNotNull() & (F.col("b") != F.col("_sp_anchor"))).select(F.col("_sp_anchor").alias("a"), "b").distinct()
        comp = hash_to_min(links)
        anchors = tagged.groupBy("_sp_anchor").agg(F.count("*").alias("_sp_rows")).join(comp.select(F.col("node").alias("_sp_anchor"), "component"), "_sp_anchor", "left")
        sizes = anchors.select("_sp_anchor", "_sp_rows", F.coalesce("component", "_sp_anchor").alias("_sp_component"))
    else:
        sizes = tagged.groupBy("_sp_anchor").agg(F.count("*").alias("_sp_rows")).withColumn("_sp_component", F.col("_sp_anchor"))
    sizes = cut(sizes)
    per = sizes.groupBy("_sp_component").agg(F.sum("_sp_rows").alias("rows"))
    total = per.agg(F.sum("rows")).first()[0] or 0
    heavy = per.where(F.col("rows") > heavy_share * total).orderBy(F.desc("rows"), "_sp_component").collect() if total else []  # at most 1 / heavy_share rows
    lacking = {k: s * total for k, s in shares.items()}
    dealt = {}
    for r in heavy:
        k = max(sorted(lacking), key=lambda x: lacking[x])
        dealt[r["_sp_component"]] = k
        lacking[k] -= r["rows"]
    # of the light components: stable under small changes of the heavy ones
    taken = {k: round(50 * (s - lacking[k] / total)) / 50 if total else 0.0 for k, s in shares.items()}
    weights = {k: max(0.0, s - taken[k]) for k, s in shares.items()}
    drawn = rendezvous(F.col("_sp_component"), weights if sum(weights.values()) > 0 else shares, seed)
    if dealt:
        fixed = F.create_map(*[F.lit(x) for kv in dealt.items() for x in kv])
        drawn = F.coalesce(F.try_element_at(fixed, F.col("_sp_component")), drawn)
    chosen = sizes.select("_sp_anchor", drawn.alias(out))
    # a hot anchor: salt the rows' side, so that no task reads a third of the table
    return _salted_lookup(tagged.drop(*cols, *([out] if out in df.columns else [])), chosen, "_sp_anchor", heavy_anchors=sizes.where(F.col("_sp_rows") > heavy_share * total) if total else None).drop("_sp_anchor")


def _salted_lookup(rows: DataFrame, lookup: DataFrame, on: str, heavy_anchors: DataFrame | None, salts: int = 32) -> DataFrame:
    """rows joined with lookup (unique by on). Heavy keys, a bounded list, join by broadcast; all others by shuffle."""
    if heavy_anchors is None:
        return rows.join(lookup, on)
    names = heavy_anchors.select(on)
    hot = lookup.join(F.broadcast(names), on, "left_semi")
    rest = rows.join(F.broadcast(names), on, "left_anti").join(lookup, on)
    return rest.unionByName(rows.join(F.broadcast(hot), on).select(rest.columns))


def split_shares(split_rows: DataFrame, split: str = "split") -> DataFrame:
    """(split, n_rows, share) as reached."""
    n = split_rows.groupBy(split).agg(F.count("*").alias("n_rows"))
    return n.withColumn("share", F.col("n_rows") / F.sum("n_rows").over(W.partitionBy(F.lit(0))))

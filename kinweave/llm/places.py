"""Which address records denote the same building.

Multi-pass sorted neighbourhoods: the distinct readings of all addresses are
sorted several times, each time by other components first, and every reading is
compared with the next ones in each order. The passes are one sort, of a key that
begins with the number of the pass. A pair must agree in house number, and in
street type where both have one; street names may differ by typing errors and
transpositions; towns and postal codes must not contradict. An address without a
town can be that of any town's, however many share number and street: those are
joined with all of their number and street skeleton, so that no window cuts them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.records import osa, with_fields, within
from kinweave.operators.neighbours import in_blocks
from kinweave.session import cut

PARTS = ["number", "kind", "street", "town", "postal", "area"]
TOWN = ["town_rows", "town_low", "town_high", "town_area"]
SLACK = 120  # codes this near to those seen in a town may still be the town's
RARE = 5  # a town spelled like another that is so many times as frequent is a misspelling of it


def same_street(a: str, b: str) -> bool:
    """Equal but for typing errors, or for left-out vowels."""
    return within(a, b) or (len(min(a, b, key=len)) >= 4 and a[0] == b[0] and bare(a) == bare(b))


def bare(w: str) -> str:
    return w[:1] + "".join(c for c in w[1:] if c not in "aeiou")


def same_place(a: tuple, b: tuple) -> bool:
    """Two readings (PARTS, then TOWN) of the same building."""
    if a[0] != b[0] or not a[0] or (a[1] and b[1] and a[1] != b[1]):
        return False
    exact_post = bool(a[4]) and a[4] == b[4]
    if not same_street(a[2], b[2]) and not (exact_post and min(len(a[2]), len(b[2])) >= 5 and osa(a[2], b[2], 2) <= 2):
        return False
    if a[4] and b[4] and not exact_post and osa(a[4], b[4], 1) > 1:
        return False
    if a[3] and b[3]:
        if a[3] == b[3]:
            return True
        near = osa(a[3], b[3], 3)
        if exact_post:
            return near <= 3 or same_street(a[3], b[3])
        if not same_street(a[3], b[3]):
            return False
        few, many = sorted((a[6] or 1, b[6] or 1))
        return many >= RARE * few
    if exact_post:
        return True
    # a town or code is missing: what goes with the other one's town must not contradict
    for x, y in ((a, b), (b, a)):
        if x[4].isdigit() and not y[4] and y[8] >= y[7] > 0 and len(x[4]) == len(str(y[8])):
            return y[7] - SLACK <= int(x[4]) <= y[8] + SLACK
    left, right = a[5] or a[9], b[5] or b[9]
    return not left or not right or left == right


def compare(rows: pd.DataFrame, n_own: int, window: int) -> pd.DataFrame:
    """Pairs of reading ids at most window rows apart that are the same place."""
    n = len(rows)
    number = pd.factorize(rows["number"])[0]
    kind = pd.factorize(rows["kind"])[0].copy()
    kind[(rows["kind"] == "").to_numpy()] = -1
    letters = np.array([sum(1 << (ord(c) - 97) for c in set(s) if "a" <= c <= "z") for s in rows["street"]], np.int64)
    readings = list(zip(*[rows[c] for c in [*PARTS, *TOWN]], strict=True))
    ids, out = rows["rid"].tolist(), []
    for d in range(1, window + 1):
        first = np.arange(min(n_own, n - d)) if n > d else np.zeros(0, np.int64)
        if not len(first):
            break
        second = first + d
        fit = (number[first] == number[second]) & ((kind[first] == kind[second]) | (kind[first] < 0) | (kind[second] < 0))
        fit &= np.bitwise_count(letters[first] ^ letters[second]) <= 6
        for i in first[fit].tolist():
            if same_place(readings[i], readings[i + d]):
                out.append((ids[i], ids[i + d]))
    return pd.DataFrame(out, columns=["a", "b"])


def readings_of(fields: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members: rid, id; readings: rid, PARTS and TOWN), one reading for each distinct address read."""
    known = fields.where((F.col("number") != "") & (F.col("street") != ""))
    members = known.select("id", F.xxhash64(*PARTS).alias("rid"), *PARTS)
    distinct = members.groupBy("rid", *PARTS).agg(F.count("*").alias("n"))
    towns = distinct.where("town <> ''").withColumn("code", F.when(F.col("postal").rlike("^[0-9]{5,6}$"), F.col("postal").cast("long"))).groupBy("town", "area").agg(F.sum("n").alias("n"), F.min("code").alias("low"), F.max("code").alias("high"))
    seen = towns.groupBy("town").agg(F.max("n").alias("most"))
    fair = F.when(F.col("n") * 5 >= F.col("most"), True)
    towns = towns.join(seen, "town").withColumns({"low": F.when(fair, F.col("low")), "high": F.when(fair, F.col("high"))})
    towns = towns.groupBy("town").agg(F.sum("n").alias("town_rows"), F.max(F.when(F.col("area") != "", F.struct("n", "area"))).alias("top"), F.sum(F.when(F.col("area") != "", F.col("n"))).alias("coded"), F.min("low").alias("low"), F.max("high").alias("high"))
    # a town's usual area counts only if most of its codes lie there
    towns = towns.select("town", "town_rows", "low", "high", F.when(F.col("top.n") * 2 > F.col("coded"), F.col("top.area")).otherwise(F.lit("")).alias("town_area"))
    readings = distinct.join(towns, "town", "left").select("rid", *PARTS, *[F.coalesce(c, F.lit(0).cast("long")).alias(k) for k, c in (("town_rows", "town_rows"), ("town_low", "low"), ("town_high", "high"))], F.coalesce("town_area", F.lit("")).alias("town_area"))
    return members.select("id", "rid"), readings


def townless(readings: DataFrame) -> DataFrame:
    """(a, b): readings without a town with all readings of the same number and street skeleton that are the same place."""
    cols = ["rid", *PARTS, *TOWN]
    keyed = readings.withColumn("_bare", F.regexp_replace("street", "(?<!^)[aeiou]", ""))
    side = lambda df, s: df.select(F.col("number").alias("_number"), "_bare", F.struct(*cols).alias(s))
    met = side(keyed.where("town = ''"), "x").join(side(keyed, "y"), ["_number", "_bare"]).where("x.rid <> y.rid AND (x.kind = '' OR y.kind = '' OR x.kind = y.kind)")

    rows = ", ".join(f"{s}.{c} AS {s}_{c}" for s in "xy" for c in cols).split(", ")

    def flat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x, y = (list(zip(*[pdf[f"{s}_{c}"] for c in cols], strict=True)) for s in "xy")
            yield pd.DataFrame([(p[0], q[0]) for p, q in zip(x, y, strict=True) if same_place(p[1:], q[1:])], columns=["a", "b"])

    return met.selectExpr(*rows).mapInPandas(flat, "a long, b long")


def same_building(fields: DataFrame, window: int = 12) -> DataFrame:
    """(a, b), a < b: ids of two records of with_fields at the same building, each pair once.

    Records without a house number or street (placeholders, blanks) match nothing. All pairs within one reading are given:
    they are exact copies. An empty table gives no rows.
    """
    members, readings = readings_of(fields)
    members, readings = cut(members), cut(readings)
    near = F.coalesce(F.nullif("area", F.lit("")), F.col("town_area"))
    orders = [("street", "town", "postal"), ("town", "street", "postal"), ("postal", "street", "town"), ("turned", "town", "postal"), ("bare", "town", "postal"), ("near", "street", "town")]
    keyed = readings.withColumns({"turned": F.reverse("street"), "bare": F.regexp_replace("street", "(?<!^)[aeiou]", ""), "near": near})
    key = F.array(*[F.concat_ws("|", F.lit(str(i)), "number", *o) for i, o in enumerate(orders)])
    passes = keyed.withColumn("key", F.explode(key)).drop("turned", "bare", "near")
    links = cut(in_blocks(passes, ["key", "rid"], window, lambda rows, n: compare(rows, n, window), "a long, b long").union(townless(readings)).distinct())
    both = links.where("a <> b").select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct()
    m, k = members.select(F.col("rid").alias("x"), F.col("id").alias("i")), members.select(F.col("rid").alias("y"), F.col("id").alias("j"))
    across = both.join(m, "x").join(k, "y").select("i", "j")
    inside = members.select("rid", F.col("id").alias("i")).join(members.select("rid", F.col("id").alias("j")), "rid").where("i < j").select("i", "j")
    return across.union(inside).select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b")).where("a < b").distinct()


def same_building_records(df: DataFrame, window: int = 12, **columns: str) -> DataFrame:
    return same_building(cut(with_fields(df, **columns)), window)

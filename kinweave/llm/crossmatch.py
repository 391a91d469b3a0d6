"""Matching the records of two tables that share no key, with a confidence for each match.

The q-grams of a record's fields are encoded as fixed bit vectors. Pairs within a
Hamming radius are found exactly by multi-index hashing (grams.chunk_keys): names
by their letters within a line of business and country (grams.BLOCKS), streets
within a house number. Only keys, ids and 64-bit folds of the vectors are
shuffled; whole vectors join the distinct pairs. Dice scores of the fields'
vectors, weighted by a logistic model fitted on labelled pairs, are the
confidence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.llm import grams as G
from kinweave.session import cut, cut_and_release, in_slices, union_all

RADIUS, LOOSE_RADIUS, STREET_RADIUS = 5, 10, 4
SLICE = 3_000_000  # pairs whose records are shuffled at once
# field, bits, grams: by letters (searched), loosely (searched, folded), by bigrams
VECTORS = {"letters": 128, "loose": 256, "name": 256, "street": 128, "town": 128, "initials": 64}
PLAIN = ["lines", "country", "acronym", "number", "kind", "street", "town", "postal", "area"]
FEATURES = ["name", "loose", "name_square", "place", "elsewhere", "name_at_place", "initials_at_place", "line_known", "country_known", "by_initials"]
# The prior of the calibration, in the order of FEATURES after the intercept: it alone decides where there are no labels.
PRIOR = np.array([-12.0, 8.0, 2.0, 8.0, 3.0, -3.0, 4.0, 12.0, 2.0, 1.0, 0.0])


def forms_of(fields: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(members: id, rid; forms: rid and columns), one form for each distinct reading of records with a name."""
    named = fields.where("core <> ''").withColumn("rid", F.xxhash64(*columns))
    return named.select("id", "rid"), named.select("rid", *columns).distinct()


def encoded(forms: DataFrame) -> DataFrame:
    """rid, PLAIN and an array of 64-bit words for each of VECTORS."""
    read = {
        "letters": ("core", G.letters),
        "loose": ("core", G.loose),
        "name": ("core", lambda t: G.runs(t, 2)),
        "street": ("street", G.loose),
        "town": ("town", lambda t: G.runs(t, 2)),
        "initials": ("initials", set),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = {c: b.column(c) for c in ["rid", *PLAIN]}
            for field, bits in VECTORS.items():
                source, grams = read[field]
                words = G.bit_rows([grams(t) for t in b.column(source).to_pylist()], bits)
                cols[f"{field}_bits"] = G.lists(G.signed(words).ravel(), np.full(len(words), bits // 64), pa.int64())
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    schema = "rid long, " + ", ".join(f"{c} string" for c in PLAIN) + ", " + ", ".join(f"{f}_bits array<long>" for f in VECTORS)
    initials = F.when(F.col("acronym") != "", F.col("acronym")).otherwise(F.col("initials"))
    return forms.select("rid", *PLAIN, "core", initials.alias("initials")).mapInArrow(run, schema)


def key_rows(forms: DataFrame, fields: str, keep: Broadcast | None = None) -> DataFrame:
    """(key, rid, fold, loose): the keys of encoded forms, of names within the blocks of fields, or with fields = 'n' of streets within the house number; only those in keep."""
    vector, radius = ("street", STREET_RADIUS) if fields == "n" else ("letters", RADIUS)
    used = ["rid", "lines", "country", "number", f"{vector}_bits", "loose_bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            words = lambda c: b.column(c).flatten().to_numpy().view(np.uint64).reshape(b.num_rows, -1)  # noqa: B023, E731
            bits, loose = words(f"{vector}_bits"), G.folded(words("loose_bits"))
            if fields == "n":
                row, block = np.arange(b.num_rows), np.array([G.number_of(x) for x in b.column("number").to_pylist()], np.uint64)
            else:
                row, block = G.spread(b.column("lines").to_pylist(), b.column("country").to_pylist(), fields)
            at, key = G.chunk_keys(bits[row], radius)
            key = G.stir(key ^ block[at])
            kept = G.passes(keep, key)
            at, key = at[kept], key[kept]
            rid = b.column("rid").to_numpy()
            whole = row[at]
            for lo in range(0, len(at), 1 << 17):
                part = slice(lo, lo + (1 << 17))
                w = whole[part]
                yield pa.RecordBatch.from_arrays([pa.array(G.signed(key[part])), pa.array(rid[w]), pa.array(G.signed(G.folded(bits)[w])), pa.array(G.signed(loose[w]))], ["key", "rid", "fold", "loose"])

    return forms.select(*used).mapInArrow(run, "key long, rid long, fold long, loose long")


def differ(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def hamming(field: str) -> Column:
    return sum((differ(F.col(f"a.{field}_bits")[k], F.col(f"b.{field}_bits")[k]) for k in range(VECTORS[field] // 64)), F.lit(0))


def dice(field: str) -> Column:
    both = sum((F.bit_count(F.col(f"a.{field}_bits")[k].bitwiseAND(F.col(f"b.{field}_bits")[k])) for k in range(VECTORS[field] // 64)), F.lit(0))
    each = sum((F.bit_count(F.col(f"{s}.{field}_bits")[k]) for s in "ab" for k in range(VECTORS[field] // 64)), F.lit(0))
    return F.when(each > 0, 2.0 * both / each).otherwise(0.0)


def meet(x: DataFrame, y: DataFrame, radius: int, loose_radius: int | None) -> DataFrame:
    """(a, b) of key rows with a key in common whose folds are within the radius. The planner doesn't see that keys are many to a row, so it may not broadcast them."""
    p = x.withColumnsRenamed({"rid": "a", "fold": "fold_a", "loose": "loose_a"})
    q = y.withColumnsRenamed({"rid": "b", "fold": "fold_b", "loose": "loose_b"})
    near = differ(F.col("fold_a"), F.col("fold_b")) <= radius
    if loose_radius is not None:
        near &= differ(F.col("loose_a"), F.col("loose_b")) <= loose_radius
    return p.hint("merge").join(q.hint("merge"), "key").where(near).select("a", "b")


def close_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b), distinct: encoded forms that may be one business by name or stand at one house number of like streets, before the whole vectors are compared. The keys of one block at a time are on disk."""
    placed, named = "number <> '' AND street <> ''", "acronym = ''"
    parts = [cut_and_release(meet(key_rows(left.where(placed), "n"), key_rows(right.where(placed), "n"), STREET_RADIUS, None).distinct())]
    parts += [cut_and_release(meet(x, y, RADIUS, LOOSE_RADIUS).distinct()) for x, y in G.block_rows(left.where(named), right.where(named), key_rows)]
    return cut_and_release(union_all(parts).distinct())


def fit_together(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """pairs with both forms as structs a and b: those within a radius whose lines of business and countries don't contradict."""
    side = lambda f, s: f.select(F.col("rid").alias(f"_{s}"), F.struct(*f.columns).alias(s))
    met = pairs.select(F.col("a").alias("_a"), F.col("b").alias("_b")).hint("merge").join(side(left, "a").hint("merge"), "_a").hint("merge").join(side(right, "b").hint("merge"), "_b")
    agree = lambda c, sep: (F.col(f"a.{c}") == "") | (F.col(f"b.{c}") == "") | F.arrays_overlap(F.split(f"a.{c}", sep), F.split(f"b.{c}", sep))
    names = (F.col("a.acronym") == "") & (F.col("b.acronym") == "") & (hamming("letters") <= RADIUS)
    streets = (F.col("a.number") != "") & (F.col("a.number") == F.col("b.number")) & (F.col("a.street") != "") & (F.col("b.street") != "") & (hamming("street") <= STREET_RADIUS)
    return met.where(agree("lines", "[|,]") & agree("country", "[|]") & (names | streets))


def features(met: DataFrame) -> DataFrame:
    """(a, b, FEATURES) of pairs of structs: Dice scores of the fields and what they say together."""
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    known = lambda c: (a(c) != "") & (b(c) != "")
    scores = met.select(
        F.col("_a").alias("a"),
        F.col("_b").alias("b"),
        dice("name").alias("name"),
        dice("loose").alias("loose"),
        dice("street").alias("street"),
        dice("initials").alias("initials"),
        F.when(known("town"), dice("town")).alias("town"),
        F.when(known("postal"), F.when(a("postal") == b("postal"), 1.0).when(a("area") == b("area"), 0.5).otherwise(0.0)).alias("postal"),
        (known("number") & known("street")).alias("placed"),
        ((a("number") == b("number")) & ((a("kind") == "") | (b("kind") == "") | (a("kind") == b("kind")))).alias("same_number"),
        known("lines").cast("double").alias("line_known"),
        known("country").cast("double").alias("country_known"),
        ((a("acronym") != "") | (b("acronym") != "")).cast("double").alias("by_initials"),
    )
    near = F.coalesce(F.greatest("town", "postal"), F.lit(0.8))
    placed = scores.withColumn("place", F.when(F.col("placed") & F.col("same_number"), F.col("street") * near).otherwise(0.0))
    name = F.greatest("name", "loose")
    return placed.select(
        "a",
        "b",
        "name",
        "loose",
        (name * name).alias("name_square"),
        "place",
        F.when(F.col("placed"), 1.0 - F.col("place")).otherwise(0.0).alias("elsewhere"),
        ((1.0 - F.col("by_initials")) * name * F.col("place")).alias("name_at_place"),
        (F.col("by_initials") * F.col("initials") * F.col("place")).alias("initials_at_place"),
        "line_known",
        "country_known",
        "by_initials",
    )


def fit_confidence(x: np.ndarray, y: np.ndarray, strength: float = 20.0) -> np.ndarray:
    """Logistic weights (intercept first) by Newton's method, drawn towards PRIOR as by strength observations."""
    w = PRIOR.copy()
    if not len(y):
        return w
    xs = np.column_stack([np.ones(len(y)), x])

    def loss(v: np.ndarray) -> float:
        z = xs @ v
        return float((np.logaddexp(0, z) - y * z).sum() + ((v - PRIOR) ** 2).sum() / (2 * strength))

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(xs @ w, -30, 30)))
        grad = xs.T @ (p - y) + (w - PRIOR) / strength
        hess = (xs * (p * (1 - p))[:, None]).T @ xs + np.eye(len(w)) / strength
        step = np.linalg.solve(hess, grad)
        size, now = 1.0, loss(w)
        while loss(w - size * step) > now and size > 1e-10:  # a full step may overshoot far from the optimum
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def confidence(w: np.ndarray) -> Column:
    z = F.lit(float(w[0])) + sum((F.lit(float(v)) * F.col(c) for v, c in zip(w[1:], FEATURES, strict=True)), F.lit(0.0))
    return 1 / (1 + F.exp(-z))


COLUMNS = ["core", "lines", "acronym", "initials", "number", "kind", "street", "town", "postal", "area", "country"]


def match(left: DataFrame, right: DataFrame, truth: DataFrame | None = None, labelled: DataFrame | None = None, sample_size: int = 20_000) -> DataFrame:
    """(a, b, confidence, name, place) for candidate pairs of records, ids of left and right, both made by with_fields.

    Candidates are all pairs within RADIUS by name letters and LOOSE_RADIUS by folded loose grams, or within STREET_RADIUS by
    street at one house number, that don't contradict in line of business or country. truth (a, b) holds the known matches
    of the left ids in labelled (a): their candidate pairs, at most sample_size of them by hash, calibrate the confidence;
    without them PRIOR does. name and place are Dice scores. Records without a name match nothing. Records that read alike
    are scored once. Empty tables give no rows.
    """
    m_left, f_left = forms_of(left, COLUMNS)
    m_right, f_right = forms_of(right, COLUMNS)
    m_left, m_right = cut(m_left), cut(m_right)
    f_left, f_right = cut(encoded(f_left)), cut(encoded(f_right))
    pairs = in_slices(close_pairs(f_left, f_right), ["a", "b"], SLICE, lambda met: features(fit_together(met, f_left, f_right)))
    w = PRIOR
    if truth is not None and labelled is not None:
        known = m_left.join(labelled.select(F.col("a").alias("id")).distinct(), "id").select(F.col("rid").alias("a"), F.col("id").alias("ia"))
        yes = truth.select(F.col("a").alias("ia"), F.col("b").alias("ib")).distinct().withColumn("y", F.lit(1.0))
        cand = pairs.join(known, "a").join(m_right.select(F.col("rid").alias("b"), F.col("id").alias("ib")), "b").join(yes, ["ia", "ib"], "left")
        rows = cand.orderBy(F.xxhash64("ia", "ib"), "ia", "ib").limit(sample_size).select(*FEATURES, F.coalesce("y", F.lit(0.0)).alias("y")).toPandas()
        w = fit_confidence(rows[FEATURES].to_numpy(float), rows["y"].to_numpy(float))
    out = pairs.withColumn("confidence", confidence(w)).select("a", "b", "confidence", "name", "place")
    ids = lambda m, s: m.select(F.col("rid").alias(s), F.col("id").alias(f"i{s}"))
    return out.join(ids(m_left, "a"), "a").join(ids(m_right, "b"), "b").select(F.col("ia").alias("a"), F.col("ib").alias("b"), "confidence", "name", "place")

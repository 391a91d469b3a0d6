"""Character n-grams of names and streets, as bit vectors and as hashes, and the blocks in which records are compared.

Two records can be one business only if their lines of business share one or one
is unknown, and likewise their countries. So records that know both meet within
(line, country); pairs of which one lacks the country meet within the line, pairs
of which one lacks the line within the country, and the few pairs that have no
known field in common meet across all. No block is an all-to-all comparison: the
keys below are joined within each.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame

from kinweave.session import union_all

VOWELS = re.compile("[aeiou]")
LINE, PLACE = "lines <> ''", "country <> ''"
# condition of the left rows, condition of the right rows, fields in the key (l for lines, c for country), the side whose rows are few because they lack a field
BLOCKS = [
    (f"{LINE} AND {PLACE}", f"{LINE} AND {PLACE}", "lc", ""),
    (f"{LINE} AND NOT {PLACE}", LINE, "l", "left"),
    (f"{LINE} AND {PLACE}", f"{LINE} AND NOT {PLACE}", "l", "right"),
    (f"NOT {LINE} AND {PLACE}", PLACE, "c", "left"),
    (f"{LINE} AND {PLACE}", f"NOT {LINE} AND {PLACE}", "c", "right"),
    (f"NOT {LINE} AND NOT {PLACE}", "true", "", "left"),
    (f"{LINE} OR {PLACE}", f"NOT {LINE} AND NOT {PLACE}", "", "right"),
    (f"{LINE} AND NOT {PLACE}", f"NOT {LINE} AND {PLACE}", "", "left"),
    (f"NOT {LINE} AND {PLACE}", f"{LINE} AND NOT {PLACE}", "", "left"),
]
# of a table with itself, where every pair need be met in one direction only
OWN_BLOCKS = [BLOCKS[k] for k in (0, 1, 3, 5, 7)]
FILTER_BITS = 24
C1, C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@lru_cache(1 << 16)
def skeleton(word: str) -> str:
    """A word without its vowels but for the first letter."""
    return word[:1] + VOWELS.sub("", word[1:])


def runs(text: str, n: int) -> set[str]:
    """The n-grams of each word between marks; a shorter word is one gram."""
    out: set[str] = set()
    for w in text.split():
        p = f"^{w}$"
        out.update(p[i : i + n] for i in range(max(1, len(p) - n + 1)))
    return out


def anchored(text: str) -> set[str]:
    """Each word's first letter with each of its other consonants: stays whole under typed-over vowels and swapped letters."""
    return {f"{w[0]}~{c}" for w in text.split() for c in VOWELS.sub("", w[1:])}


def letters(text: str) -> set[str]:
    """Letters, first letters and last letters of words, in no order."""
    words = text.split()
    return set("".join(words)) | {f"^{w[0]}" for w in words} | {f"{w[-1]}$" for w in words}


def loose(text: str) -> set[str]:
    """Letters and anchored consonants."""
    return {f"~{c}" for c in text if c != " "} | {f"{w[0]}~{c}" for w in text.split() for c in VOWELS.sub("", w)}


@lru_cache(1 << 18)
def number_of(gram: str) -> int:
    return xxhash.xxh64_intdigest(gram)


def bit_rows(sets: list[set[str]], bits: int) -> np.ndarray:
    """(rows, bits / 64) bit vectors of gram sets."""
    out = []
    for grams in sets:
        m = 0
        for g in grams:
            m |= 1 << (number_of(g) % bits)
        out.append(m.to_bytes(bits // 8, "little"))
    return np.frombuffer(b"".join(out), "<u8").reshape(len(sets), bits // 64)


@lru_cache(1 << 16)
def block_numbers(lines: str, country: str, fields: str) -> tuple[int, ...]:
    """One number for each combination of the values that the fields in the key can stand for."""
    ls = [x for x in re.split(r"[|,]", lines) if x] if "l" in fields else [""]
    cs = [x for x in country.split("|") if x] if "c" in fields else [""]
    return tuple(xxhash.xxh64_intdigest(f"{fields}|{x}|{y}") for x in sorted(set(ls)) for y in sorted(set(cs)))


def spread(lines: list[str], country: list[str], fields: str) -> tuple[np.ndarray, np.ndarray]:
    """(row, block number) of every block each row is in."""
    got = [block_numbers(x or "", y or "", fields) for x, y in zip(lines, country, strict=True)]
    row = np.repeat(np.arange(len(got)), [len(g) for g in got])
    return row, np.array([b for g in got for b in g], np.uint64)


def stir(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * C2
    return h ^ (h >> np.uint64(27))


def chunk_keys(bits: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) such that any two rows at most radius bits apart, and with a bit in common, have a key in common.

    The bits are dealt to radius + 2 chunks, of which such rows agree in two: every two chunks give a key. Two empty chunks say
    nothing; they are joined with each of the row's first radius + 1 bits in one order of all bits, of which two such rows share one.
    """
    n, width = len(bits), bits.shape[1] * 64
    chunks = radius + 2
    place = np.arange(width) % chunks
    hashed, empty = [], []
    for k in range(chunks):
        mask = np.packbits(place == k, bitorder="little").view("<u8")
        held = bits & mask
        h = np.full(n, k + 1, np.uint64) * C1
        for w in range(bits.shape[1]):
            h = stir(h ^ held[:, w])
        hashed.append(h)
        empty.append(~held.any(axis=1))
    order = np.random.default_rng(5).permutation(width)  # any order will do if all rows use the same
    on = np.unpackbits(np.ascontiguousarray(bits).view(np.uint8).reshape(n, -1), axis=1, bitorder="little").astype(bool)[:, order]
    who, bit = np.nonzero(on & (np.cumsum(on, axis=1) <= radius + 1))
    bit = (bit + 1).astype(np.uint64) * C1
    rows, keys = [], []
    every = np.arange(n)
    for i in range(chunks):
        for j in range(i + 1, chunks):
            h = stir(hashed[i] * C2 ^ hashed[j] ^ np.uint64(i * chunks + j))
            blank = empty[i] & empty[j]
            rows.append(every[~blank])
            keys.append(h[~blank])
            more = blank[who]
            rows.append(who[more])
            keys.append(stir(h[who[more]] ^ bit[more]))
    return np.concatenate(rows), np.concatenate(keys)


def folded(bits: np.ndarray) -> np.ndarray:
    """64 bits that differ in at most as many places as the whole vectors do."""
    return np.bitwise_xor.reduce(bits, axis=1)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values, kind))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def key_filter(rows: DataFrame) -> Broadcast:
    """A bit map of the keys of rows, 2 MB whatever their number: rows of the other side whose key is not in it can meet none of them and need not be shuffled."""
    size = (1 << FILTER_BITS) // 64

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(b.column("key").to_numpy() & ((1 << FILTER_BITS) - 1))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 12), pa.array(at & 4095)], ["page", "at"])

    def page(table: pa.Table) -> pa.Table:
        on = np.zeros(4096, bool)
        on[table.column("at").to_numpy()] = True
        return pa.table({"page": table.column("page").slice(0, 1), "bits": pa.array([np.packbits(on, bitorder="little").tobytes()], pa.binary())})

    found = rows.select("key").mapInArrow(places, "page long, at long").distinct().groupBy("page").applyInArrow(page, "page long, bits binary")
    held = np.zeros((size // 64, 512), np.uint8)
    for r in found.collect():  # at most 4096 rows of 512 bytes
        held[r["page"]] = np.frombuffer(r["bits"], np.uint8)
    return rows.sparkSession.sparkContext.broadcast(held.ravel())


def passes(filter: Broadcast | None, key: np.ndarray) -> np.ndarray:
    """Which keys may be in the filter; all without one."""
    if filter is None:
        return np.ones(len(key), bool)
    at = key & np.uint64((1 << FILTER_BITS) - 1)
    return (filter.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def block_rows(left: DataFrame, right: DataFrame | None, rows: Callable[[DataFrame, str, Broadcast | None], DataFrame]) -> Iterator[tuple[DataFrame, DataFrame]]:
    """The key rows (of rows(table, fields, filter)) of both sides of every block, without those that the few rows of the other side rule out. right None stands for left itself."""
    blocks = OWN_BLOCKS if right is None else BLOCKS
    other = left if right is None else right
    few = {s: [(t.where(x if s == "left" else y), f) for x, y, f, lack in blocks if lack == s] for s, t in (("left", left), ("right", other))}
    filters = {s: key_filter(union_all([rows(t, f, None).select("key") for t, f in parts])) for s, parts in few.items() if parts}
    for x, y, fields, lack in blocks:
        yield rows(left.where(x), fields, filters["right"] if lack == "right" else None), rows(other.where(y), fields, filters["left"] if lack == "left" else None)

"""Sequence similarities of two strings, exact, as Arrow-batched functions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _masks(a: str) -> dict[str, int]:
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | (1 << i)
    return where


def _common(where: dict[str, int], n: int, b: str) -> int:
    full = free = (1 << n) - 1
    for c in b:
        met = free & where.get(c, 0)
        if met:
            free = ((free + met) | (free - met)) & full
    return n - free.bit_count()


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one bit for each letter of a (Hyyro's recurrence on Python integers)."""
    return _common(_masks(a), len(a), b) if a and b else 0


def ratio(a: str, b: str) -> float:
    """Twice the common subsequence over the total length; 1 for two blanks."""
    n = len(a) + len(b)
    return 1.0 if n == 0 else 2.0 * lcs_length(a, b) / n


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """Best of three comparisons of the shared words and the words of each side; 0 if either side has no words."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    common, only_x, only_y = sorted(x & y), sorted(x - y), sorted(y - x)
    if common and (not only_x or not only_y):
        return 1.0
    s = len(" ".join(common))
    dx, dy = " ".join(only_x), " ".join(only_y)
    gap = 1 if common else 0
    nx, ny = s + gap + len(dx), s + gap + len(dy)
    total = nx + ny
    best = 1.0 - (len(dx) + len(dy) - 2 * lcs_length(dx, dy)) / total if total else 0.0
    if common:
        best = max(best, 1.0 - (gap + len(dx)) / (s + nx), 1.0 - (gap + len(dy)) / (s + ny))
    return best


def _best_window(short: str, long: str) -> float:
    n, m = len(short), len(long)
    letters = _masks(short)
    best = 0.0
    for start in range(1 - n, m):
        w = long[max(0, start) : start + n]
        # a window whose outer letter matches nothing is no better than its neighbour without it
        if (w[0] if start + n > m else w[-1]) not in letters:
            continue
        if 2.0 * min(n, len(w)) / (n + len(w)) > best:
            best = max(best, 2.0 * _common(letters, n, w) / (n + len(w)))
        if best == 1.0:
            break
    return best


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string with any window of the longer one of its length, also clipped at the ends; strings of equal length are tried both ways."""
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    best = _best_window(short, long)
    return max(best, _best_window(long, short)) if len(a) == len(b) and best < 1.0 else best


# Whole batches at a time, for strings of at most 64 letters: one 64-bit word holds a row of the recurrence.

WORD = 64


def _padded(texts: list[str], fill: int) -> tuple[np.ndarray, np.ndarray]:
    """(letters, lengths): one row of code points for each text, filled up behind its end."""
    n = np.array([len(t) for t in texts])
    out = np.full((len(texts), int(n.max(initial=1)) or 1), fill, np.int32)
    out[np.arange(out.shape[1]) < n[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<i4")
    return out, n


def _places(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each letter of the rows of b, the places of that letter in the row of a, as bits."""
    out = np.zeros(b.shape, np.uint64)
    for i in range(a.shape[1]):
        out |= (a[:, i : i + 1] == b).astype(np.uint64) << np.uint64(i)
    return out


def _step(free: np.ndarray, places: np.ndarray) -> np.ndarray:
    met = free & places
    return (free + met) | (free - met)


def _chunks(x: list[str], y: list[str], size: int) -> Iterator[np.ndarray]:
    """Row numbers in pieces of like lengths."""
    order = np.array(sorted(range(len(x)), key=lambda i: (len(x[i]), len(y[i]))), np.int64)
    for lo in range(0, len(order), size):
        yield order[lo : lo + size]


def _full(n: np.ndarray) -> np.ndarray:
    return np.where(n >= WORD, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << np.minimum(n, WORD - 1).astype(np.uint64)) - np.uint64(1))


def lcs_lengths(x: list[str], y: list[str]) -> np.ndarray:
    """lcs_length of every pair."""
    out = np.zeros(len(x), np.int64)
    short, long = zip(*[(p, q) if len(p) <= len(q) else (q, p) for p, q in zip(x, y, strict=True)], strict=True) if x else ((), ())
    for rows in _chunks(short, long, 4096):
        if len(short[rows[-1]]) > WORD:
            out[rows] = [lcs_length(short[i], long[i]) for i in rows]
            continue
        a, n = _padded([short[i] for i in rows], -1)
        b, _ = _padded([long[i] for i in rows], -2)
        places, full = _places(a, b), _full(n)
        free = full.copy()
        for j in range(b.shape[1]):
            free = _step(free, places[:, j])
        out[rows] = n - np.bitwise_count(free & full)
    return out


def ratios(x: list[str], y: list[str]) -> np.ndarray:
    total = np.array([len(p) + len(q) for p, q in zip(x, y, strict=True)])
    return np.where(total > 0, 2.0 * lcs_lengths(x, y) / np.maximum(total, 1), 1.0)


def token_set_ratios(x: list[str], y: list[str]) -> np.ndarray:
    """token_set_ratio of every pair."""
    sets = [(set(p.split()), set(q.split())) for p, q in zip(x, y, strict=True)]
    common = [p & q for p, q in sets]
    dx, dy = ([" ".join(sorted(s[k] - c)) for s, c in zip(sets, common, strict=True)] for k in (0, 1))
    shared = np.array([sum(map(len, c)) + max(0, len(c) - 1) for c in common])
    nx, ny = np.array([len(t) for t in dx]), np.array([len(t) for t in dy])
    gap = (shared > 0).astype(int)
    sx, sy = shared + gap + nx, shared + gap + ny
    best = 1.0 - (nx + ny - 2 * lcs_lengths(dx, dy)) / np.maximum(sx + sy, 1)
    for own, size in ((nx, sx), (ny, sy)):
        best = np.where(gap > 0, np.maximum(best, 1.0 - (gap + own) / np.maximum(shared + size, 1)), best)
    best = np.where((gap > 0) & ((nx == 0) | (ny == 0)), 1.0, best)
    return np.where([bool(p) and bool(q) for p, q in sets], best, 0.0)


def _best_windows(short: list[str], long: list[str]) -> np.ndarray:
    """The best ratio of each short string with the windows of the long one, all windows of all pairs at once."""
    a, n = _padded(short, -1)
    b, m = _padded(long, -2)
    most, wide = a.shape[1], b.shape[1]
    # a border of empty places on both sides stands for what windows lack at the ends
    places = np.pad(_places(a, b), ((0, 0), (most, most)))
    windows = most + wide - 1
    start = np.arange(windows)[None] - (n - 1)[:, None]
    rows = np.arange(len(n))[:, None]
    full = np.broadcast_to(_full(n)[:, None], start.shape)
    free = full.copy()
    for k in range(most):
        at = np.minimum(start + k + most, places.shape[1] - 1)
        free = np.where(k < n[:, None], _step(free, places[rows, at]), free)
    size = np.minimum(start + n[:, None], m[:, None]) - np.maximum(start, 0)
    kept = n[:, None] - np.bitwise_count(free & full).astype(np.int64)
    return np.where(size > 0, 2.0 * kept / np.maximum(n[:, None] + size, 1), 0.0).max(axis=1)


def partial_ratios(x: list[str], y: list[str]) -> np.ndarray:
    """partial_ratio of every pair."""
    out = np.array([1.0 if not p and not q else 0.0 for p, q in zip(x, y, strict=True)])
    some = [i for i, (p, q) in enumerate(zip(x, y, strict=True)) if p and q]
    short, long = [min(x[i], y[i], key=len) for i in some], [y[i] if len(x[i]) <= len(y[i]) else x[i] for i in some]
    for rows in _chunks(short, long, 512):
        s, t = [short[i] for i in rows], [long[i] for i in rows]
        if len(s[-1]) > WORD:
            got = np.array([partial_ratio(p, q) for p, q in zip(s, t, strict=True)])
        else:
            got = _best_windows(s, t)
            even = np.array([len(p) == len(q) for p, q in zip(s, t, strict=True)])
            if even.any():
                at = np.flatnonzero(even)
                got[at] = np.maximum(got[at], _best_windows([t[i] for i in at], [s[i] for i in at]))
        out[np.array(some)[rows]] = got
    return out


FUZZY = ["name_levenshtein", "name_token_sort", "name_token_set", "name_partial", "addr_levenshtein", "addr_token_sort", "addr_token_set"]


def _distinct(x: pd.Series, y: pd.Series) -> tuple[list[str], list[str], np.ndarray]:
    """The distinct pairs of strings of a batch and which of them each row is."""
    seen: dict[tuple[str, str], int] = {}
    at = np.array([seen.setdefault(p, len(seen)) for p in zip(x, y, strict=True)], np.int64)
    return [p for p, _ in seen], [q for _, q in seen], at


@F.pandas_udf(T.StructType([T.StructField(f, T.DoubleType()) for f in FUZZY]))
def _fuzzy(n1: pd.Series, n2: pd.Series, a1: pd.Series, a2: pd.Series) -> pd.DataFrame:
    out = []
    for x, y, partial in ((n1, n2, True), (a1, a2, False)):
        p, q, at = _distinct(x, y)
        ordered = [[" ".join(sorted(t.split())) for t in side] for side in (p, q)]
        scores = [ratios(p, q), ratios(*ordered), token_set_ratios(p, q), *([partial_ratios(p, q)] if partial else [])]
        out += [s[at] for s in scores]
    return pd.DataFrame(dict(zip(FUZZY, out, strict=True)))


def fuzzy_scores(n1: Column, n2: Column, a1: Column, a2: Column) -> Column:
    """The seven scores as one struct, so that a pair crosses to Python once."""
    return _fuzzy(n1, n2, a1, a2)

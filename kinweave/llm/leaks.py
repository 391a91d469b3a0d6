"""Evaluation passages that stand, whole or in part, in a corpus.

Q-gram lemma filtering. Texts are folded to letters and digits. A run of L
passage words with e edited words keeps at least

    chars(run) - q + 1 - e * (q - 1) - (letters of the e longest words)

of the passage's character q-grams. The words between two edits lie on one diagonal
(text position less passage position), so those q-grams lie on at most e + 1
diagonals, however long an added word is. For every item the least such number
over all runs that count is its bound, and q is the largest length whose bound
stays positive. Every document is scanned once: its rolling q-gram hashes are
looked up in the items' index and hits are counted in overlapping diagonal bands.
Where the e + 1 fullest bands of an item and a text meet the item's bound, the hits
are parted where the text has none for longer than any run could bear, and the same
bound is asked of every single run of passage words, with each passage q-gram
counted once. What is left is verified by an alignment of words in bands around
the diagonals of the hits.

The item index is broadcast in blocks of a stated size (block_chars); a larger
item set takes more passes over the corpus, each against all documents.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEADER = re.compile(r"^#%% (?:text|code|output)\b[^\n]*$", re.M)
TAG = re.compile(r"</?[A-Za-z][^<>\n]{0,200}>|<!--.{0,200}?-->")
ESCAPE = re.compile(r"\\(?:u([0-9a-fA-F]{4})|[ntrbfav\"'\\/])")
ANSI = re.compile(r"\x1b?\[[0-9;]{1,8}m")
NUMBERED = re.compile(r"^[ \t]*\[?\d{1,6}\]?[:|)][ \t]+", re.M)
WIDTHS = (12, 10, 8, 6, 5, 4, 3, 2)
FLAG_BITS = 22
STRETCH = 1_000_000  # letters hashed at a time
PIECE = 4_000_000  # characters of one text read at a time
GONE = 0xFFFFFFFF
ONE = np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)

_table: np.ndarray | None = None


def _fold_table() -> np.ndarray:
    """Code point to folded code point; 0 separates words, GONE vanishes. By rule: letters, digits and spacing marks stay, combining marks vanish."""
    global _table
    if _table is None:
        t = np.zeros(0x110000, np.uint32)
        for cp in range(0x20000):
            cat = unicodedata.category(chr(cp))
            if cat[0] in "LN" or cat == "Mc":
                t[cp] = cp
            elif cat in ("Mn", "Cf"):
                t[cp] = GONE
        t[0x20000:0x40000] = np.arange(0x20000, 0x40000)
        _table = t
    return _table


def strip_markup(text: str) -> str:
    """Takes out what stands between words without being one: cell borders, tags, escapes, line numbers."""
    if "#%%" in text:
        text = HEADER.sub(" ", text)
    if "\\" in text:
        text = ESCAPE.sub(lambda m: chr(int(m[1], 16)) if m[1] else " ", text)
    if "<" in text:
        text = TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if "[" in text or "\x1b" in text:
        text = ANSI.sub(" ", text)
    text = NUMBERED.sub(" ", text)
    return text.casefold() if text.isascii() else unicodedata.normalize("NFKD", text).casefold()


class Folded:
    """Several texts as one array of letters, with word numbers and the bounds of each text."""

    def __init__(self, texts: list[str]):
        raw = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "replace"), np.uint32)
        table = _fold_table()
        codes = table[np.minimum(raw, 0x10FFFF)]
        letters = (codes != 0) & (codes != GONE)
        ends = np.cumsum([len(t) + 1 for t in texts])
        upto = np.cumsum(letters, dtype=np.int64)
        self.bounds = np.concatenate([[0], upto[ends - 1]]) if len(texts) else np.zeros(1, np.int64)
        stay = codes[codes != GONE]
        inside = stay != 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        self.codes = stay[inside]
        starts = first[inside]
        self.word_of = (np.cumsum(starts, dtype=np.int64) - 1).astype(np.int32)
        self.word_at = np.append(np.flatnonzero(starts), len(self.codes))

    def words(self, lo: int, hi: int) -> list[str]:
        """The words that have a letter in [lo, hi)."""
        if lo >= hi:
            return []
        a, b = self.word_of[lo], self.word_of[hi - 1] + 1
        cut = self.word_at[a : b + 1]
        s = self.codes[cut[0] : cut[-1]].astype("<u4").tobytes().decode("utf-32-le", "replace")
        cut = (cut - cut[0]).tolist()
        return [s[i:j] for i, j in zip(cut, cut[1:], strict=False)]


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all q-grams, by doubling: a gram of length a+b from grams of length a and b."""
    if len(codes) < q:
        return np.zeros(0, np.uint64)
    power, size = codes.astype(np.uint64) * BASE, 1
    power ^= power >> np.uint64(29)
    made, done = None, 0
    while True:
        if q & size:
            if made is None:
                made, done = power, size
            else:
                n = len(codes) - done - size + 1
                made = (made[:n] * np.uint64(pow(int(BASE), size, 1 << 64) | 1)) + power[done : done + n]
                done += size
        if size * 2 > q:
            break
        n = len(codes) - 2 * size + 1
        power = power[:n] * np.uint64(pow(int(BASE), size + 7, 1 << 64) | 1) + power[size : size + n]
        power ^= power >> np.uint64(31)
        size *= 2
    return made * np.uint64(0xD6E8FEB86659FD93)


def runs_of(lengths: list[int], share: float, rate: float) -> Iterator[tuple[int, int, int]]:
    """(words, edits, letters that the edits can take) for every length of a run that counts."""
    m = len(lengths)
    longest = np.concatenate([[0], np.cumsum(sorted(lengths, reverse=True))]).tolist()
    for n in range(max(1, math.ceil(m * share - 1e-9)), m + 1):
        e = int(n * rate + 1e-9)
        yield n, e, longest[e]


def needs_of(lengths: list[int], share: float, rate: float, q: int) -> Iterator[tuple[int, np.ndarray]]:
    """(n, need) for every length n of a run that counts: q-grams that the run of n words from each word keeps at least."""
    sums = np.concatenate([[0], np.cumsum(lengths)])
    for n, e, lost in runs_of(lengths, share, rate):
        yield n, sums[n:] - sums[:-n] - q + 1 - e * (q - 1) - lost


def bounds_of(lengths: list[int], share: float, rate: float) -> tuple[int, int]:
    """(q, bound) of an item whose words have these lengths: the largest q that asks for some shared q-grams of every run, and how many."""
    for q in WIDTHS:
        bound = min(int(need.min()) for _, need in needs_of(lengths, share, rate, q))
        if bound >= 8:
            return q, bound
    return (1 if sum(lengths) < 4 else 2), 1


class Index:
    """The q-grams of a block of items, by q."""

    def __init__(self, items: list[tuple[int, str]], share: float, rate: float):
        self.share, self.rate = share, rate
        self.ids: list[int] = []
        self.words: list[list[str]] = []
        self.q: list[int] = []
        self.word_at: list[np.ndarray] = []
        self.lack: list[np.ndarray] = []
        found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        bound, width, size, edits = [], [], [], []
        for item, text in items:
            f = Folded([strip_markup(text)])
            w = f.words(0, len(f.codes))
            if not w:
                continue
            q, least = bounds_of([len(x) for x in w], share, rate)
            k = len(self.ids)
            self.ids.append(item)
            self.words.append(w)
            self.q.append(q)
            self.word_at.append(f.word_at)
            lack = np.full(len(w) + 1, 1 << 40, np.int64)
            for n, e, lost in runs_of([len(x) for x in w], share, rate):
                lack[n] = 1 - q - e * (q - 1) - lost
            self.lack.append(lack)
            bound.append(least)
            edits.append(int(len(w) * rate + 1e-9))
            width.append(max(64, 16 * math.ceil(len(w) * rate)))
            size.append(len(f.codes))
            h = gram_hashes(f.codes, q)
            found.setdefault(q, []).append((h, np.full(len(h), k), np.arange(len(h))))
        self.bound, self.width, self.size, self.edits = (np.array(x, np.int64) for x in (bound, width, size, edits))
        self.bare = (self.edits + 1) * (np.array(self.q, np.int64) + 1)
        self.grams = {}
        for q, parts in found.items():
            h, k, p = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            h, k, p = h[order], k[order].astype(np.int64), p[order].astype(np.int64)
            keys, first, count = np.unique(h, return_index=True, return_counts=True)
            flags = np.zeros(1 << FLAG_BITS, bool)
            flags[keys >> np.uint64(64 - FLAG_BITS)] = True
            self.grams[q] = (keys, first, count, k, p, flags)

    def scan(self, texts: list[str]) -> Iterator[tuple[int, int, int, int]]:
        """(item number, text number, words of the longest run, its edits) for every pair that counts."""
        f = Folded(texts)
        most = int(self.size.max()) if len(self.size) else 0
        hits: dict[str, list[np.ndarray]] = {"pair": [], "place": [], "at": []}
        for q, (keys, first, count, items, places, flags) in self.grams.items():
            for lo in range(0, max(1, len(f.codes)), STRETCH):
                h = gram_hashes(f.codes[lo : lo + STRETCH + q - 1], q)
                at = np.flatnonzero(flags[h >> np.uint64(64 - FLAG_BITS)])
                where = np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)
                same = keys[where] == h[at]
                at, where = at[same] + lo, where[same]
                text = np.searchsorted(f.bounds, at, side="right") - 1
                whole = at + q <= f.bounds[text + 1]
                at, where, text = at[whole], where[whole], text[whole]
                n = count[where]
                within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                post = np.repeat(first[where], n) + within
                hits["pair"].append(items[post] * len(texts) + np.repeat(text, n))
                hits["place"].append(places[post])
                hits["at"].append(np.repeat(at, n))
        pair, place, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in hits.values())
        # most pairs share too few q-grams whatever their order: these are never sorted
        enough = self.met_often(pair, len(texts))
        pair, place, at = pair[enough], place[enough], at[enough]
        if not len(pair):
            return
        order = np.argsort(pair * (len(f.codes) + 1) + at)
        pair, place, at = pair[order], place[order], at[order]
        item = pair // len(texts)
        # hits of one pair are parted where a run could not hold so many words without one: its edits, each with a rest of fewer than q letters beside it
        word = f.word_of[at].astype(np.int64)
        apart = np.ones(len(pair), bool)
        apart[1:] = (pair[1:] != pair[:-1]) | (word[1:] - word[:-1] > self.bare[item[1:]])
        start = np.flatnonzero(apart)
        end = np.append(start[1:], len(pair))
        cluster, item = np.cumsum(apart) - 1, item[start]
        # a passage q-gram that comes again counts once
        once = np.sort(cluster * (most + 1) + place)
        distinct = np.add.reduceat(np.append(True, once[1:] != once[:-1]), start, dtype=np.int64)
        some = np.flatnonzero((distinct >= self.bound[item])[cluster])
        if not len(some):
            return
        band = (at[some] - f.bounds[pair[some] % len(texts)] - place[some] + most) // self.width[item[cluster[some]]]
        by = np.lexsort((band, cluster[some]))
        of, band = cluster[some][by], band[by]
        new = np.ones(len(by), bool)
        new[1:] = (of[1:] != of[:-1]) | (band[1:] != band[:-1])
        head = np.flatnonzero(new)
        n = np.diff(np.append(head, len(by)))
        banded, number = of[head], band[head]
        # overlapping bands: each counts its own hits and the next band's
        beside = np.zeros(len(n), np.int64)
        follows = (banded[1:] == banded[:-1]) & (number[1:] == number[:-1] + 1)
        beside[:-1][follows] = n[1:][follows]
        # the fullest bands of each cluster, one more than there may be edits
        fullest = np.lexsort((-(n + beside), banded))
        banded, total = banded[fullest], (n + beside)[fullest]
        first = np.flatnonzero(np.append(True, banded[1:] != banded[:-1]))
        rank = np.arange(len(banded)) - np.repeat(first, np.diff(np.append(first, len(banded))))
        held = np.add.reduceat(np.where(rank <= self.edits[item[banded]], total, 0), first)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        likely = banded[first][held >= self.bound[item[banded[first]]]]
        for c in likely[self.may_hold(item[likely], [place[start[c] : end[c]] for c in likely.tolist()])].tolist():
            k, t = divmod(int(pair[start[c]]), len(texts))
            got = self.verify(f, k, int(f.bounds[t]), int(f.bounds[t + 1]), at[start[c] : end[c]], place[start[c] : end[c]])
            if got and got > best.get((k, t), (0, 0)):
                best[k, t] = got
        for (k, t), got in best.items():
            yield k, t, *got

    def verify(self, f: Folded, k: int, start: int, end: int, at: np.ndarray, place: np.ndarray) -> tuple[int, int] | None:
        """(words, edits) of the longest run of item k among hits (text and passage positions, in text order) of the text of letters start to end."""
        first, last = int(f.word_of[at[0]]), int(f.word_of[at[-1]])
        bare = int(self.bare[k])
        lo = max(start, int(f.word_at[max(0, first - bare)]))
        hi = min(end, int(f.word_at[min(len(f.word_at) - 1, last + self.q[k] + bare)]))
        return run_in(self.words[k], f.words(lo, hi), self.share, self.rate, (at - lo, np.searchsorted(self.word_at[k], place, side="right") - 1), int(self.bound[k]))

    def met_often(self, pair: np.ndarray, n_texts: int) -> np.ndarray:
        """Numbers of the hits whose pair (item number times n_texts plus text number) has as many hits as its item's bound; of pairs counted together by the same low bits, all."""
        low = pair & ((1 << FLAG_BITS) - 1)
        n = np.bincount(low, minlength=1)
        some = np.flatnonzero((n >= self.bound.min())[low])
        return some[n[low[some]] >= self.bound[pair[some] // n_texts]]

    def may_hold(self, items: np.ndarray, places: list[np.ndarray]) -> np.ndarray:
        """Of each item number, whether the passage positions hit leave some run of that item that can count."""
        out = np.zeros(len(items), bool)
        for k in np.unique(items).tolist():
            mine = np.flatnonzero(items == k)
            # so many at once that their tables have about a million cells
            step = max(1, 1_000_000 // (len(self.words[k]) + 1) ** 2)
            for lo in range(0, len(mine), step):
                some = mine[lo : lo + step]
                out[some] = self.may_hold_one(k, [places[c] for c in some.tolist()])
        return out

    def may_hold_one(self, k: int, places: list[np.ndarray]) -> np.ndarray:
        """may_hold of clusters of one item."""
        q, word_at, least = self.q[k], self.word_at[k], self.lack[k]
        seen = np.zeros((len(places), int(word_at[-1]) + 1), np.int32)
        seen[np.repeat(np.arange(len(places)), [len(p) for p in places]), np.concatenate(places) + 1] = 1
        upto = np.cumsum(seen, axis=1)
        start, end = upto[:, word_at[:-1]], upto[:, np.maximum(word_at - q + 1, 0)]
        m = start.shape[1]
        # what a run from word i to word j keeps, less its letters, against what its length allows it to lack
        head, tail = start - word_at[:-1], end - word_at
        if m <= 512 and self.bound[k] > 1:
            padded = np.concatenate([tail, np.full((len(places), m), -(1 << 40))], axis=1)
            table = np.lib.stride_tricks.sliding_window_view(padded, m + 1, axis=1)[:, :m]
            return (table - head[:, :, None] >= least).any(axis=(1, 2))
        out = np.zeros(len(places), bool)
        for n in range(1, m + 1):
            if least[n] < 1 << 40:
                out |= ((tail[:, n:] - head[:, : m - n + 1] >= least[n]) & (end[:, n:] > start[:, : m - n + 1])).any(axis=1)
        return out


def regrouped(passage: list[str], text: list[str]) -> tuple[list[str], np.ndarray]:
    """(words, first letter of each) of a text, with words joined or parted where that makes words of the passage: spacing does not count."""
    known = set(passage)
    pairs = {a + b: (a, b) for a, b in zip(passage, passage[1:], strict=False)}
    words: list[str] = []
    for w in text:
        if w not in known and w in pairs:
            words += pairs[w]
        elif words and w not in known and words[-1] + w in known:
            words[-1] += w
        else:
            words.append(w)
    return words, np.cumsum([0, *map(len, words)])[:-1]


def run_in(passage: list[str], text: list[str], share: float, rate: float, hits: tuple[np.ndarray, np.ndarray] | None = None, needed: int = 1) -> tuple[int, int] | None:
    """(words, edits) of the longest run of passage words that the text holds in order within the edit budget, or None if it is shorter than share.

    hits (letters of the text, words of the passage) say where to look: each word added or dropped moves the alignment by one
    diagonal, so bands of so many diagonals around those of the hits hold every run; a band must hold the needed number of them. Without hits all diagonals are searched.
    """
    m = len(passage)
    if not text:
        return None
    words, first = regrouped(passage, text)
    edits = math.ceil(m * rate - 1e-9)
    if hits is None:
        bands = [(-m, len(words))]
    else:
        bands = []
        diagonals = np.sort(np.searchsorted(first, hits[0], side="right") - 1 - hits[1])
        for d in np.unique(diagonals).tolist():
            if not bands or d > bands[-1][0] + 2 * edits + 2:  # the hits of a run span at most as many diagonals as it has edits, and one for words joined otherwise
                bands.append((d - edits - 1, d + 3 * edits + 3))
        bands = [(lo, hi) for lo, hi in bands if np.searchsorted(diagonals, hi, side="right") - np.searchsorted(diagonals, lo) >= needed]
    number = {w: i for i, w in enumerate(dict.fromkeys(passage))}
    a = np.array([number[w] for w in passage])
    b = np.array([number.get(w, -1) for w in words])
    found = [aligned(a, b, lo, hi, share, rate) for lo, hi in bands]
    return max((x for x in found if x), key=lambda x: (x[0], -x[1]), default=None)


def aligned(a: np.ndarray, b: np.ndarray, low: int, high: int, share: float, rate: float) -> tuple[int, int] | None:
    """run_in of word numbers a in b, on the diagonals (place in b less place in a) low to high."""
    m, n = len(a), len(b)
    width = high - low + 1
    least = max(1, math.ceil(m * share - 1e-9))
    # cell d of row i stands for the first i words of a and the first i + low + d of b
    padded = np.concatenate([np.full(m + abs(low) + 2, -2), b, np.full(m + abs(high) + 2, -2)])
    zero = m + abs(low) + 2
    step = np.arange(width, dtype=np.int32)
    score = np.zeros((m + 1, width), np.int32)
    for i in range(1, m + 1):
        prev, row = score[i - 1], score[i]
        at = zero + i - 1 + low
        here = padded[at : at + width] if 0 <= at and at + width <= len(padded) else np.array([padded[x] if 0 <= x < len(padded) else -2 for x in range(at, at + width)])
        row[:] = prev + np.where(here == a[i - 1], 1, -1)
        row[:-1] = np.maximum(row[:-1], prev[1:] - 1)
        np.maximum(row, 0, out=row)
        outside = i + low + step
        row[(outside < 0) | (outside > n)] = 0
        row[:] = np.maximum.accumulate(row + step) - step
    i, d = (int(x) for x in np.unravel_index(int(score.argmax()), score.shape))
    trail: list[tuple[int, int]] = []  # of each step from the end: passage words, edits
    while i >= 0 and score[i, d] > 0:
        s, j = score[i, d], i + low + d
        if i and 0 < j <= n and s == score[i - 1, d] + (1 if a[i - 1] == b[j - 1] else -1):
            trail.append((1, int(a[i - 1] != b[j - 1])))
            i -= 1
        elif i and d + 1 < width and s == score[i - 1, d + 1] - 1:
            trail.append((1, 1))
            i, d = i - 1, d + 1
        elif d and s == score[i, d - 1] - 1:
            trail.append((0, 1))
            d -= 1
        else:
            break
    w = np.concatenate([[0], np.cumsum([x for x, _ in trail])])
    e = np.concatenate([[0], np.cumsum([x for _, x in trail])])
    best = None
    for x in range(len(w)):
        n_words, n_edits = w[x:] - w[x], e[x:] - e[x]
        fits = np.flatnonzero((n_words >= least) & (n_edits <= np.ceil(n_words * rate - 1e-9)))
        if len(fits):
            y = fits[-1]
            if best is None or n_words[y] > best[0]:
                best = (int(n_words[y]), int(n_edits[y]))
    return best


def pieces(text: str, overlap: int) -> Iterator[str]:
    """A text in overlapping pieces, so that memory does not grow with its length."""
    if len(text) <= PIECE:
        yield text
        return
    for lo in range(0, len(text), PIECE - overlap):
        yield text[lo : lo + PIECE]
        if lo + PIECE >= len(text):
            break


_index: tuple[str, Index] | None = None


def index_of(name: str, items: list[tuple[int, str]], share: float, rate: float) -> Index:
    """The index of a block of items, made once in each Python worker."""
    global _index
    if _index is None or _index[0] != name:
        _index = name, Index(items, share, rate)
    return _index[1]


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    passage: str = "passage",
    share: float = 0.4,
    edit_rate: float = 0.1,
    block_chars: int = 8_000_000,
) -> DataFrame:
    """(item_id, doc_id, run_words, passage_words, edits), one row for each pair of an item and a document that holds at least share of the passage's words in one run.

    Case, accents, punctuation, spacing, markup, line prefixes, escapes and cell borders are ignored; up to edit_rate of
    the run's words, rounded up, may be altered, added or dropped. Texts are read whole. Null ids, texts and
    passages, and passages without letters or digits, give no rows; repeated documents or items give one row for each
    distinct pair of ids, that of the longest run. No items or no documents: no rows. Ids keep their types; other
    columns, whatever their names, play no part.
    """
    spark = docs.sparkSession
    queries = items.select(F.col(item_id).alias("i"), F.col(passage).alias("p")).where("i IS NOT NULL AND p IS NOT NULL").distinct()
    chars = queries.agg(F.sum(F.length("p")), F.max(F.length("p"))).first()
    blocks = max(1, math.ceil((chars[0] or 0) / block_chars))
    overlap = max(65_536, 8 * (chars[1] or 0))
    of_block = F.pmod(F.xxhash64("p"), F.lit(blocks))
    id_type, item_type = docs.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    corpus = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).where("d IS NOT NULL AND t IS NOT NULL")
    found = None
    for block in range(blocks):
        some = [(r["i"], r["p"]) for r in queries.where(of_block == block).toLocalIterator()]
        given = spark.sparkContext.broadcast((uuid.uuid4().hex, some, share, edit_rate))

        def leaks(batches: Iterator[pa.RecordBatch], given=given, id_type=id_type, item_type=item_type) -> Iterator[pa.RecordBatch]:
            index = index_of(*given.value)

            def of(ids: list, texts: list[str]) -> pa.RecordBatch:
                rows = [(index.ids[k], ids[t], n, len(index.words[k]), e) for k, t, n, e in index.scan(texts)]
                return pa.RecordBatch.from_pylist([dict(zip(("item_id", "doc_id", "run_words", "passage_words", "edits"), r, strict=True)) for r in rows], schema)

            schema = None
            for batch in batches:
                if schema is None:
                    schema = pa.schema([("item_id", pa_item), ("doc_id", batch.schema.field("d").type), ("run_words", pa.int32()), ("passage_words", pa.int32()), ("edits", pa.int32())])
                if not index.ids:
                    continue
                ids, texts, n = [], [], 0
                for d, t in zip(batch.column("d").to_pylist(), batch.column("t"), strict=True):
                    for piece in pieces(t.as_py(), overlap):
                        s = strip_markup(piece)
                        ids.append(d)
                        texts.append(s)
                        n += len(s)
                        if n >= STRETCH:
                            yield of(ids, texts)
                            ids, texts, n = [], [], 0
                if ids:
                    yield of(ids, texts)

        pa_item = _arrow_type(item_type)
        part = corpus.mapInArrow(leaks, f"item_id {item_type}, doc_id {id_type}, run_words int, passage_words int, edits int")
        found = part if found is None else found.union(part)
    best = F.max(F.struct("run_words", -F.col("edits"), "passage_words")).alias("b")
    return found.groupBy("item_id", "doc_id").agg(best).select("item_id", "doc_id", "b.run_words", "b.passage_words", (-F.col("b.col2")).alias("edits"))


def _arrow_type(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[name]

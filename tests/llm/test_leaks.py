"""Leaked passages against a plain search, and in corner cases."""

from __future__ import annotations

import random

import numpy as np

from kinweave.llm import leaks as L

WORDS = [a + b + c for a in ("ka", "lo", "mi", "tre", "stu", "vo") for b in ("ran", "lus", "mer", "pid") for c in ("", "den", "ova", "ist")]


def passage(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def found(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    i = spark.createDataFrame(items, "item_id long, passage string, text string")
    return {(r["item_id"], r["doc_id"]): r for r in L.find_leaks(d, i, **kw).collect()}


def test_planted_runs(spark):
    rng = random.Random(1)
    items, docs, want = [], [], set()
    for k in range(30):
        p = passage(rng, rng.randrange(40, 90))
        items.append((k, " ".join(p), "clash"))
        for share in (1.0, 0.6, 0.45, 0.25):
            n = int(len(p) * share)
            at = rng.randrange(len(p) - n + 1)
            run = p[at : at + n]
            for e in range(int(n * 0.1) if share < 1 else 0):
                run[10 * e + rng.randrange(2, 8)] = rng.choice(["changed", "other", ""])
            words = passage(rng, 60) + [w.upper() if rng.random() < 0.3 else f"**{w}**" for w in run if w] + passage(rng, 60)
            docs.append((len(docs), "#%% text\n" + "".join(w + rng.choice([" ", "\n| ", ", "]) for w in words), "clash"))
            if share > 0.4:
                want.add((k, len(docs) - 1))
    got = found(spark, docs, items)
    assert want <= set(got)
    # nothing that holds a quarter only
    assert all(d % 4 != 3 for _, d in got)
    # the same in small blocks of items and in single documents' pieces
    assert set(found(spark, docs, items, block_chars=500)) == set(got)


def test_forms_that_do_not_count(spark):
    rng = random.Random(2)
    p = passage(rng, 50)
    text = " ".join(p)
    forms = [
        text.replace(" ", "\\n", 20),
        "# " + text.replace(" ", "\n# "),
        "<td>" + text.replace(" ", "</td><td>") + "</td>",
        '{"context": "' + text + '"}',
        " ".join(p[:25]) + "\n#%% code [3]\n" + " ".join(p[25:]),
        text.replace("o", "ó").replace("u", "ü"),
        "".join(w + (" " if i % 9 else "") for i, w in enumerate(p)),
    ]
    got = found(spark, [(i, f, "") for i, f in enumerate(forms)], [(7, text, "")])
    assert set(got) == {(7, i) for i in range(len(forms))}


def test_corners(spark):
    rng = random.Random(3)
    p = " ".join(passage(rng, 45))
    long_text = " ".join(passage(rng, 200_000)) + " " + p + " " + " ".join(passage(rng, 1000))
    docs = [(1, None, ""), (2, "", ""), (None, p, ""), (3, long_text, ""), (3, long_text, ""), (4, p, ""), (5, "... !!! ---", "")]
    items = [(1, p, ""), (1, p, ""), (2, None, ""), (3, "", ""), (4, "--- !!", ""), (None, p, "")]
    got = found(spark, docs, items)
    assert set(got) == {(1, 3), (1, 4)}
    assert got[1, 4]["run_words"] == 45 and got[1, 4]["edits"] == 0 and got[1, 4]["passage_words"] == 45
    assert found(spark, [], items) == {} and found(spark, docs, []) == {}


def test_short_passages(spark):
    got = found(spark, [(1, "say it with alphabetical flowers today", ""), (2, "nothing here", "")], [(1, "alphabetical flowers", ""), (2, "x", "")])
    assert set(got) == {(1, 1)}


def test_pieces_cover_a_long_text():
    t = "".join(str(i % 10) for i in range(9_000_000))
    parts = list(L.pieces(t, 100_000))
    assert len(parts) == 3 and all(len(x) <= L.PIECE for x in parts) and parts[0][-100_000:] == parts[1][:100_000]


def test_hashes_depend_on_all_letters():
    codes = np.frombuffer("abcabcabcabd".encode("utf-32-le"), np.uint32)
    for q in (1, 2, 3, 5, 7, 8, 11):
        h = L.gram_hashes(codes, q)
        grams = ["abcabcabcabd"[i : i + q] for i in range(12 - q + 1)]
        assert len(h) == len(grams)
        assert all((h[i] == h[j]) == (grams[i] == grams[j]) for i in range(len(grams)) for j in range(len(grams)))


def words_kept(p, words, share, rate):
    """Longest run of p that words hold within the budget, by trying every run against every place (edit distance of words)."""
    best = 0
    for i in range(len(p)):
        for n in range(len(p) - i, max(1, -(-int(len(p) * share * 1000) // 1000)) - 1, -1):
            if n <= best or n < share * len(p) - 1e-9:
                break
            row = [0] * (len(words) + 1)  # may begin anywhere
            for x in p[i : i + n]:
                before, row[0], diag = row[0], row[0] + 1, row[0]
                for j, y in enumerate(words, 1):
                    diag, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diag + (x != y))
            if min(row) <= int(n * rate + 1e-9):
                best = n
    return best


def test_long_added_words():
    rng = random.Random(9)
    for m in (20, 40, 100):
        for x in (1, 15, 60, 120, 200, 400, 2000):
            for many in (1, 2, int(0.4 * m * 0.1) + 1):
                p = passage(rng, m)
                n = int(0.4 * m) + 2 + 10 * (many - 1)
                if n > m or many > int(n * 0.1):
                    continue
                at = rng.randrange(m - n + 1)
                run = p[at : at + n]
                for k in range(many):  # apart, so that each parts the run
                    run.insert(5 + 9 * k, "".join(rng.choice("qxzw0123") for _ in range(x)))
                text = passage(rng, 30) + run + passage(rng, 30)
                assert words_kept(p, text, 0.4, 0.1)
                got = list(L.Index([(1, " ".join(p))], 0.4, 0.1).scan([" ".join(text)]))
                assert got and got[0][2] >= 0.4 * m, (m, x, many)


def test_random_edits_against_brute_force():
    rng = random.Random(10)
    n_true = 0
    for trial in range(60):
        p = passage(rng, rng.randrange(12, 40))
        n = rng.randrange(int(0.3 * len(p)), len(p) + 1)
        at = rng.randrange(len(p) - n + 1)
        run = []
        for w in p[at : at + n]:
            r = rng.random()
            run += [] if r < 0.03 else [w, "y" * rng.randrange(1, 300)] if r < 0.06 else ["changed"] if r < 0.09 else [w]
        text = passage(rng, 20) + run + passage(rng, 20)
        if words_kept(p, text, 0.4, 0.1):
            n_true += 1
            assert list(L.Index([(1, " ".join(p))], 0.4, 0.1).scan([" ".join(text)])), trial
    assert n_true > 20


def test_letters_above_the_first_plane_and_long_passages():
    assert L.Folded(["\U00010400\U0001d7d8 \U00020000"]).codes.tolist() == [0x10400, 0x1D7D8, 0x20000]
    rng = random.Random(11)
    p = passage(rng, 6000)
    text = passage(rng, 100) + p[1000:4000] + passage(rng, 100)
    got = list(L.Index([(1, " ".join(p))], 0.4, 0.1).scan([" ".join(text)]))
    assert got and got[0][2] >= 3000


def test_pairs_that_share_too_little_are_not_sorted(monkeypatch):
    rng = random.Random(12)
    # items that share a stock phrase with every text, which alone is no case for any
    stock = passage(rng, 6)
    items = [(k, " ".join(passage(rng, 30) + stock + passage(rng, 20))) for k in range(40)]
    texts = [" ".join(passage(rng, 50) + stock + passage(rng, 50)) for _ in range(30)]
    texts.append(" ".join(passage(rng, 20) + items[7][1].split()[5:40] + passage(rng, 20)))
    index = L.Index(items, 0.4, 0.1)
    asked = []
    may_hold = L.Index.may_hold
    monkeypatch.setattr(L.Index, "may_hold", lambda self, k, places: asked.append(len(k)) or may_hold(self, k, places))
    sizes = []
    sort = np.argsort
    monkeypatch.setattr(L.np, "argsort", lambda x, *a, **kw: sizes.append(len(x)) or sort(x, *a, **kw))
    assert [(k, t, n) for k, t, n, _ in index.scan(texts)] == [(7, 30, 35)]
    # of the hits of the stock phrase in 40 x 31 pairs next to none is put in order
    assert sizes and max(sizes) < 40 * 31 and sum(asked) < 40
    # the clusters of one item are asked at once and each on its own
    places = [rng.sample(range(150), n) for n in (2, 40, 150, 149)] + [list(range(60, 200)), list(range(0, 120, 3))]
    places = [np.sort(np.array(p)) for p in places]
    both = index.may_hold(np.full(len(places), 7), places)
    assert both.tolist() == [bool(index.may_hold(np.array([7]), [p])[0]) for p in places] and both.any() and not both.all()

"""Held-out accuracy on the test tables, gradients, and corner cases."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pytest

from kinweave.llm import bytegru as G
from kinweave.llm import languages as LA

SENTENCES = {
    "en": "the learning rate shows the distance between the stations because the sample is small and we will see that later",
    "de": "die lernrate zeigt den abstand zwischen den stationen weil die stichprobe klein ist und wir das später sehen werden",
    "fr": "le taux montre la distance entre les stations parce que cet échantillon est petit et nous le verrons plus tard",
    "es": "la tasa muestra la distancia entre las estaciones porque la muestra es pequeña y lo veremos más adelante",
    "pt": "a taxa mostra a distância entre as estações porque a amostra é pequena e nós veremos isso mais tarde",
    "it": "il tasso mostra la distanza tra le stazioni perché il campione è piccolo e lo vedremo più avanti",
    "nl": "de leersnelheid toont de afstand tussen de stations omdat de steekproef klein is en dat zien we later",
    "hi": "सीखने की दर स्टेशनों के बीच की दूरी दिखाती है क्योंकि नमूना छोटा है और हम इसे बाद में देखेंगे",
}


def sentence(rng, lang, n=14):
    w = SENTENCES[lang].split()
    return " ".join(rng.choice(w) for _ in range(n))


@pytest.fixture(scope="module")
def net():
    rng = random.Random(0)
    return LA.fit([(sentence(rng, lang), lang) for lang in SENTENCES for _ in range(150)], hidden=16, epochs=(6, 6))


def test_gradients_are_right():
    net = G.fresh(5, 3, 1)
    for a in net.arrays():
        a *= 0.5
    net = G.Net(*[a.astype(np.float64) for a in net.arrays()])
    texts, y = [b"abcab", b"b", b"", b"cab"], np.array([0, 1, 2, 2])
    loss, grads = G.gradients(net, texts, y)
    rng = np.random.default_rng(0)
    for a, g in zip(net.arrays(), grads, strict=True):
        flat = [np.unravel_index(i, a.shape) for i in rng.choice(a.size, 6)] + [np.unravel_index(np.abs(g).argmax(), a.shape)]
        for i in flat:
            old = a[i]
            a[i] = old + 1e-3
            up = G.gradients(net, texts, y)[0]
            a[i] = old - 1e-3
            down = G.gradients(net, texts, y)[0]
            a[i] = old
            assert abs((up - down) / 2e-3 - g[i]) < 2e-3 + 0.02 * abs(g[i])


def test_every_byte_gets_probabilities(net):
    texts = [b"the small sample", b"", b"x"]
    p = G.label_bytes(net, texts)
    assert [len(x) for x in p] == [len(t) for t in texts]
    assert np.allclose(np.concatenate(p).sum(axis=1), 1, atol=1e-4)
    assert np.allclose(G.pool_bytes(net, texts)[0], p[0].sum(axis=0), atol=1e-3)


def test_held_out_accuracy(net):
    rng = random.Random(99)
    test = [(sentence(rng, lang), lang) for lang in SENTENCES for _ in range(25)]
    p = LA.label_all(net, [t for t, _ in test])
    right = sum(LA.LANGUAGES[k] == lang for k, (_, lang) in zip(p.argmax(axis=1), test, strict=True))
    assert right >= 0.95 * len(test)
    assert np.allclose(p.sum(axis=1), 1)


def tables(spark, docs):
    """docs: id -> list of (type, content)."""
    d, c = [], []
    for i, (lang, cells) in docs.items():
        text = ""
        for k, (kind, content) in enumerate(cells):
            text += f"#%% {kind}\n"
            c.append((i, k, kind, len(text), len(text) + len(content)))
            text += content + "\n"
        d.append((i, text, lang, "clash"))
    return spark.createDataFrame(d, "doc_id long, text string, lang string, confidence string"), spark.createDataFrame(c, "doc_id long, cell_no int, cell_type string, char_start int, char_end int")


def test_documents_and_paragraphs(spark, net):
    rng = random.Random(5)
    s = lambda lang, n=14: sentence(rng, lang, n)
    docs = {
        1: ("EN", [("text", s("en") + "\n\n" + s("de") + "\n \n\n" + s("en")), ("code", s("fr", 40)), ("text", s("en", 30))]),
        2: (None, [("text", s("nl", 30))]),
        3: ("und", [("text", s("hi", 30))]),
        4: ("fr", [("text", s("es", 6))]),  # too few words
        5: ("de-AT", [("text", s("de", 9000))]),  # a long paragraph
        6: ("it", [("code", s("it", 50))]),  # no text cell
        7: ("pt", [("text", "1 2 3 ... 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21")]),  # no letters
        8: ("", [("text", "")]),
    }
    d, c = tables(spark, docs)
    d, c = d.union(d.limit(2)), c.union(c.limit(3))
    got = {(r["doc_id"], r["cell_no"], r["para_no"]): r for r in LA.language_rows(d.distinct(), c, net).collect()}
    assert {k: v["lang"] for k, v in got.items()} == {(1, -1, -1): "en", (1, 0, 1): "de", (2, -1, -1): "nl", (3, -1, -1): "hi", (5, -1, -1): "de"}
    assert all(0 < r["confidence"] <= 1.0001 for r in got.values())
    wrong = LA.wrong_or_foreign(d, LA.language_rows(d.distinct(), c, net)).distinct().collect()
    assert {(r["doc_id"], r["cell_no"], r["lang"]) for r in wrong} == {(1, 0, "de"), (2, -1, "nl"), (3, -1, "hi")}
    assert LA.language_rows(d.limit(0), c, net).count() == 0 and LA.language_rows(d, c.limit(0), net).count() == 0


def test_nulls(spark, net):
    d = spark.createDataFrame([(None, "x"), (1, None), (2, "tekst")], "doc_id long, text string")
    c = spark.createDataFrame([(1, 0, "text", 0, 5), (2, 0, "text", None, 5), (2, 1, None, 0, 5), (2, 2, "text", 3, 999)], "doc_id long, cell_no int, cell_type string, char_start int, char_end int")
    assert LA.language_rows(d, c, net, min_doc_words=1).count() <= 1


def test_no_labels_no_rows(spark):
    d = spark.createDataFrame([(1, "some text without a label at all here", None)], "doc_id long, text string, lang string")
    c = spark.createDataFrame([(1, 0, "text", 0, 37)], "doc_id long, cell_no int, cell_type string, char_start int, char_end int")
    assert LA.languages(d, c).count() == 0


def test_stretches_keep_all_bytes():
    data = LA.reading("wörter " * 900 + "x" * 1000)
    parts = LA.stretches(data)
    assert b"".join(parts) == data and max(map(len, parts)) <= LA.PIECE
    assert LA.paragraphs("a\n\n\nb\n \t\nc\nd") == ["a", "b", "c\nd"] and LA.paragraphs(" \n\n ") == []


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no test tables")
def test_sample_is_bounded(spark):
    d = "/root/testdata/sf0.001"
    s = LA.training_sample(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/notebook_cells.parquet"), 50, 5)
    assert 50 <= len(s) <= 50 + 8 * 5 and {lang for _, lang in s} <= set(LA.LANGUAGES)

from __future__ import annotations

import os

import pytest

from kinweave.llm.mixing import budgets, count_tokens, mix
from kinweave.llm.plans_mixing import TOKENIZER

TARGETS = "source string, target_share double, max_repeats int"


def test_budgets():
    t = {"a": 0.5, "b": 0.3, "c": 0.2}
    got = budgets({"a": 100, "b": 100, "c": 10}, t, {"a": 1, "b": 1, "c": 3})
    # c may give 30, which is a fifth of 150
    assert {k: round(v) for k, v in got.items()} == {"a": 75, "b": 45, "c": 30}
    short = budgets({"a": 100, "b": 100, "c": 10}, t, {"a": 1, "b": 1, "c": 1}, size=150)
    assert short["c"] == 10 and round(short["a"], 6) == 87.5 and round(short["b"], 6) == 52.5
    assert budgets({}, t, dict.fromkeys(t, 1)) == dict.fromkeys(t, 0.0)
    assert sum(budgets({"a": 5, "b": 5, "c": 5}, t, dict.fromkeys(t, 1), size=10**9).values()) == 15


@pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no tokenizer file")
def test_mix(spark):
    docs = [(i, f"word{i} " * (5 + i % 40), ["big", "BIG ", "small", None, "", "other"][i % 6], float(i % 5), 1) for i in range(1200)]
    docs += [(5, "again", "big", 1.0, 1), (None, "no id", "big", 1.0, 1), (9999, "", "small", 1.0, 1), (9998, None, "small", 1.0, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, quality double, repeats int")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 2), ("absent", 0.0, 3)], TARGETS)
    chosen, report = mix(df, targets, TOKENIZER, weight=df["quality"])
    rows = chosen.collect()
    rep = {r["source"]: r for r in report.collect()}
    assert abs(rep["big"]["share"] - 0.5) < 0.01 and abs(rep["small"]["share"] - 0.5) < 0.01 and rep["absent"]["tokens"] == 0
    for s, r in rep.items():
        mine = [x for x in rows if x["source"] == s]
        assert sum(x["n_tokens"] * x["repeats"] for x in mine) == r["tokens"]
        assert all(x["repeats"] <= r["max_repeats"] for x in mine)
        assert abs(r["tokens"] - r["budget"]) <= max([x["n_tokens"] for x in mine], default=0)
    ids = [x["doc_id"] for x in rows]
    assert len(ids) == len(set(ids)) and 9999 not in ids and 9998 not in ids
    # the same input gives the same mixture
    assert sorted(map(tuple, mix(df, targets, TOKENIZER, weight=df["quality"])[0].collect())) == sorted(map(tuple, rows))
    # heavier documents are the likelier ones in a partly used source
    q = {d[0]: d[3] for d in docs}
    kept = [q[i] for i, s in ((x["doc_id"], x["source"]) for x in rows) if s == "big"]
    everyone = [d[3] for d in docs if (d[2] or "").strip().lower() == "big"]
    assert sum(kept) / len(kept) > sum(everyone) / len(everyone)
    empty, rep = mix(df.limit(0), targets, TOKENIZER)
    assert empty.count() == 0 and {r["tokens"] for r in rep.collect()} == {0}


@pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no tokenizer file")
def test_long_texts_are_counted_whole():
    line = "several words in a line\n"
    n = count_tokens([line], TOKENIZER)[0]
    many = count_tokens([line * 60_000, None, ""], TOKENIZER)
    assert many[1:] == [0, 0] and abs(many[0] - 60_000 * n) <= 60_000 * 0.01 * n + 4

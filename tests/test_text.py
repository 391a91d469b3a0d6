"""Normal forms against a plain Python statement of the rules."""

from __future__ import annotations

import re
import unicodedata

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinweave.functions import text as T
from kinweave.operators.blocking import prepared_tables, token_pairs

# Normal forms worked out by hand.
KNOWN = [
    ("Acme Corporation", "123 Main St, Springfield", "acme corp", "acme", "acme", "123 main street springfield", ""),
    ("Globex Pvt Ltd", "45 Nehru Road, Mumbai 400001", "globex pvt ltd", "globex", "globex", "45 nehru road mumbai 400001", "400001"),
    ("Standalone Widgets Inc", "9 Lonely Ave", "standalone widgets inc", "standalone widgets", "standalonewidg", "9 lonely avenue", ""),
    ("Cafe de Paris SARL", "10 Rue de Rivoli, Paris 75001", "cafe de paris sarl", "cafe de paris", "cafedeparis", "10 rue de rivoli paris 75001", "75001"),
    ("Ltd.", None, "ltd", "ltd", "ltd", "", ""),
    (" NaN ", "nan", "", "", "", "", ""),
    (None, "", "", "", "", "", ""),
    ("Müller & Söhne GmbH", "Hauptstraße 5", "muller sohne gmbh", "muller sohne", "mullersohne", "hauptstrasse 5", ""),
]


def test_known_forms(spark):
    df = spark.createDataFrame([(str(i), n, a, None) for i, (n, a, *_) in enumerate(KNOWN)], "entity_id string, business_name string, business_address string, country string")
    got = {r["entity_id"]: r for r in T.prepare(df).collect()}
    for i, (_, _, norm, core, key, addr, postal) in enumerate(KNOWN):
        r = got[str(i)]
        assert (r["name_norm"], r["name_core"], r["block_key"], r["addr_norm"], r["postal"], r["country"]) == (norm, core, key, addr, postal, "")
        assert r["name_core_rev"] == core[::-1]


def plain_romanize(t: str) -> str:
    """Letter by letter, without the tables' two steps."""
    if not re.search(T.OTHER_SCRIPTS, t):
        return t
    out, all_letters = [], T.CONSONANTS | T.VOWELS | T.VOWEL_SIGNS | T.CYRILLIC | T.GREEK
    t = "".join(c for c in t.lower().translate(str.maketrans(*T.OTHER_STEPS[0])) if c != "़")
    for i, c in enumerate(t):
        out.append(all_letters.get(c, c) + ("a" if c in T.CONSONANTS and t[i + 1 : i + 2] not in T.VOWEL_SIGNS else ""))
    return "".join(out)


def plain_clean(t: str | None) -> str:
    if t is None or re.sub(r"^[ \t\n\x0b\f\r]+|[ \t\n\x0b\f\r]+$", "", t).lower() == "nan":
        return ""
    t = plain_romanize(t)
    for a, b in T.WHOLE_LETTERS.items():
        t = t.replace(a, b)
    t = "".join(c for c in t.translate(str.maketrans(T.ACCENTED, T.BASE)) if not "\u0300" <= c <= "\u036f").lower()
    t = "".join(c if c in "_ \t\n\x0b\f\r" or unicodedata.category(c)[0] in "LM" or unicodedata.category(c) == "Nd" else " " for c in t)
    return re.sub(r"[ \t\n\x0b\f\r]+", " ", t).strip(" ")


def plain_ngrams(t: str) -> set[str]:
    s = t.replace(" ", "")
    return ({s} if s else set()) if len(s) < 3 else {s[i : i + 3] for i in range(len(s) - 2)}


def test_against_plain_python(spark):
    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.text(alphabet="abcÀéß_-. ltdno19नाक्षகிЖя東Ωύ\t", max_size=24), min_size=1, max_size=40))
    def check(texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("c", T.basic_clean(F.col("t")))
        out = df.select("t", "c", T.char_ngrams(F.col("c")).alias("g"), T.tokens(F.col("c")).alias("k"), T.block_key(F.col("c")).alias("b"), T.postal_code(F.col("c")).alias("p")).collect()
        for r in out:
            c = plain_clean(r["t"])
            assert r["c"] == c
            assert set(r["g"]) == plain_ngrams(c)
            assert r["k"] == list(dict.fromkeys(c.split()))
            assert r["b"] == "".join(sorted(c.split(" ")))[:14]
            found = re.findall(r"\b\d{4,6}\b", c, re.ASCII)
            assert r["p"] == (found[-1] if found else "")

    check()


def test_id_lists(spark):
    df = spark.createDataFrame([(1, " a , b,,a"), (2, None), (3, "nan"), (4, ""), (5, " ,")], "i int, s string")
    got = {r["i"]: r["x"] for r in df.select("i", T.parse_id_list(F.col("s")).alias("x")).collect()}
    assert got == {1: ["a", "b"], 2: [], 3: [], 4: [], 5: []}


def test_other_scripts(spark):
    same = [
        ("प्राइवेट लिमिटेड", "praiveta limiteda"),
        ("প্রাইভেট", "praibheta"),
        ("ਰਾਮ", "rama"),
        ("રામ", "rama"),
        ("ରାମ", "rama"),
        ("ராம்", "ram"),
        ("రామ్", "ram"),
        ("ರಾಮ್", "ram"),
        ("രാമ്", "ram"),
        ("ООО Жёлтый Ёж", "ooo zheltyi ezh"),
        ("ΟΔΌΣ Ψυχή", "odos psukhe"),
        ("१२३ Road", "123 road"),
        ("東京 株式会社", "東京 株式会社"),
        ("Cafe\u0301", "cafe"),
        ("plain", "plain"),
        (None, ""),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(same)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(T.basic_clean(F.col("t"))).collect()] == [w for _, w in same]
    con = duckdb.connect()
    con.execute("CREATE TABLE x (i INT, t VARCHAR)")
    con.executemany("INSERT INTO x VALUES (?, ?)", [(i, t) for i, (t, _) in enumerate(same)])
    assert [r[0] for r in con.execute(f"SELECT {T.sql_clean('t')} FROM x ORDER BY i").fetchall()] == [w for _, w in same]


def test_names_in_several_scripts_are_candidates(spark):
    schema = "entity_id string, business_name string, business_address string, country string"
    left = spark.createDataFrame([("S1-1", "राम Foods", None, "IN"), ("S1-2", "Жёлтый", None, "IN"), ("S1-3", "東京", None, "IN")], schema)
    right = spark.createDataFrame([("S2-1", "રામ", None, "IN"), ("S2-2", "Zheltyi", None, "IN"), ("S2-3", "東京", None, "IN"), ("S2-4", "Other", None, "IN")], schema)
    s1, ref = prepared_tables(left, {"S2": right}, T.prepare)
    got = {(r["source1_entity_id"], r["candidate_entity_id"]) for r in token_pairs(s1, ref, min_len=2).collect()}
    assert got == {("S1-1", "S2-1"), ("S1-2", "S2-2"), ("S1-3", "S2-3")}


def test_prefixes():
    assert T.default_prefixes("intfloat/multilingual-e5-small") == ("query: ", "passage: ")
    assert T.default_prefixes("LaBSE") == ("", "")


def test_accent_table_is_by_rule():
    for a, b in zip(T.ACCENTED, T.BASE, strict=True):
        base = "".join(c for c in unicodedata.normalize("NFKD", a) if not unicodedata.combining(c))
        assert b == T.PLAIN_LETTERS.get(a, base)


def test_prepare_text(spark):
    df = spark.createDataFrame([("1", "A", " ", "x"), ("2", "B", "C", None), ("3", None, None, None)], "entity_id string, business_name string, business_address string, country string")
    got = {r["entity_id"]: (r["country"], r["text"]) for r in T.prepare_text(df, "name_address").collect()}
    assert got == {"1": ("x", "A"), "2": ("", "B -- C"), "3": ("", "")}
    try:
        T.prepare_text(df, "phone")
    except ValueError:
        return
    raise AssertionError("an unknown field must raise")

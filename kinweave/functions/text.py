"""Normal forms of names and addresses as column expressions.

All run inside the JVM. The same rules are given as DuckDB SQL (sql_* functions),
from the same tables, for the queries' checks.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Legal forms and their common form.
LEGAL_FORMS = {
    "inc": "inc", "incorporated": "inc", "corp": "corp", "corporation": "corp", "co": "co", "company": "co", "ltd": "ltd", "limited": "ltd", "llc": "llc", "llp": "llp",
    "pvt": "pvt", "private": "pvt", "plc": "plc", "gmbh": "gmbh", "sa": "sa", "sarl": "sarl", "spa": "spa", "pte": "pte", "bv": "bv", "nv": "nv", "ag": "ag", "sas": "sas", "eurl": "eurl",
    "praiveta": "pvt", "praibheta": "pvt", "limiteda": "ltd", "elaelapi": "llp",
}
# Street words and their common form.
STREET_WORDS = {
    "st": "street", "str": "street", "rd": "road", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "bd": "boulevard", "dr": "drive", "ln": "lane", "hwy": "highway",
    "apt": "apartment", "fl": "floor", "bldg": "building", "sq": "square", "ct": "court", "pl": "place", "ter": "terrace", "pkwy": "parkway", "rue": "rue", "sec": "sector",
    "no": "number", "num": "number",
}
# Latin letters that do not decompose into a base letter and a mark.
WHOLE_LETTERS = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "TH"}
PLAIN_LETTERS = {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "ı": "i", "ð": "d", "Ð": "D"}
KEY_WIDTH = 14


def _letters() -> tuple[str, str]:
    """Accented Latin letters and their base letters, by decomposition."""
    pairs = dict(PLAIN_LETTERS)
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFKD", chr(cp))
        kept = "".join(c for c in base if not unicodedata.combining(c))
        if chr(cp) not in pairs and len(kept) == 1 and kept.isascii() and kept.isalpha():
            pairs[chr(cp)] = kept
    return "".join(pairs), "".join(pairs.values())


ACCENTED, BASE = _letters()
Transliterator = Callable[[Column], Column]

# Devanagari in Latin letters. A consonant is followed by a unless a vowel sign or the virama follows.
CONSONANTS = {
    "क": "k", "ख": "kh", "ग": "g", "घ": "gh", "ङ": "n", "च": "ch", "छ": "ch", "ज": "j", "झ": "jh", "ञ": "n", "ट": "t", "ठ": "th", "ड": "d", "ढ": "dh", "ण": "n", "त": "t", "थ": "th", "द": "d", "ध": "dh",
    "न": "n", "ऩ": "n", "प": "p", "फ": "ph", "ब": "b", "भ": "bh", "म": "m", "य": "y", "र": "r", "ऱ": "r", "ल": "l", "ळ": "l", "ऴ": "l", "व": "v", "श": "sh", "ष": "sh", "स": "s", "ह": "h",
}
VOWELS = {"अ": "a", "आ": "a", "इ": "i", "ई": "i", "उ": "u", "ऊ": "u", "ऋ": "ri", "ऍ": "e", "ऎ": "e", "ए": "e", "ऐ": "ai", "ऑ": "o", "ऒ": "o", "ओ": "o", "औ": "au", "ं": "m", "ँ": "n", "ः": "h"}
VOWEL_SIGNS = {"ा": "a", "ि": "i", "ी": "i", "ु": "u", "ू": "u", "ृ": "ri", "ॅ": "e", "ॆ": "e", "े": "e", "ै": "ai", "ॉ": "o", "ॊ": "o", "ो": "o", "ौ": "au", "्": ""}
# Cyrillic and Greek small letters in Latin letters.
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e", "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u",
    "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya", "і": "i", "ї": "i", "є": "e", "ґ": "g",
}
GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u",
    "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o",
}
# Bengali, Gurmukhi, Gujarati, Oriya, Tamil, Telugu, Kannada and Malayalam: Unicode lays them out as it does Devanagari.
DEVANAGARI, INDIC_STARTS = 0x900, range(0x980, 0xD80, 0x80)
OTHER_SCRIPTS = "[\u0370-\u03ff\u0400-\u04ff\u0900-\u0d7f\u1f00-\u1fff]"
INHERENT = "\u0001"


def _other_letters() -> tuple[list[tuple[str, str]], dict[str, str]]:
    """([(letters, their one-letter forms)] in two steps, {letter: longer form}): first all Indic scripts to Devanagari and accented letters to plain ones, then those to Latin."""
    whole = CONSONANTS | VOWELS | VOWEL_SIGNS | CYRILLIC | GREEK
    same: dict[str, str] = {}
    for start in INDIC_STARTS:
        for offset in range(0x80):
            if unicodedata.name(chr(start + offset), "") and unicodedata.name(chr(DEVANAGARI + offset), "") and unicodedata.category(chr(start + offset))[0] in "LM":
                same[chr(start + offset)] = chr(DEVANAGARI + offset)
    for cp in [*range(0x370, 0x500), *range(DEVANAGARI, 0xD80), *range(0x1F00, 0x2000)]:
        base = unicodedata.normalize("NFD", chr(cp))[0]
        if unicodedata.category(chr(cp)) == "Nd":
            same[chr(cp)] = str(unicodedata.digit(chr(cp)))
        elif chr(cp) not in whole and chr(cp) not in same and base in whole:
            same[chr(cp)] = base
    single = {k: v for k, v in whole.items() if len(v) == 1} | {INHERENT: "a"}
    gone = [k for k, v in whole.items() if not v] + ["़"]
    steps = [("".join(same), "".join(same.values())), ("".join(single) + "".join(gone), "".join(single.values()))]
    return steps, {k: v for k, v in whole.items() if len(v) > 1}


OTHER_STEPS, OTHER_LONG = _other_letters()
INHERENT_RULES = [(f"([{''.join(CONSONANTS)}]़?)", rf"\1{INHERENT}"), (f"{INHERENT}([{''.join(VOWEL_SIGNS)}])", r"\1")]


def romanize(c: Column) -> Column:
    """Text in nine Indic scripts, Cyrillic or Greek in small Latin letters; texts without such letters unchanged."""
    out = F.translate(F.lower(c), *OTHER_STEPS[0])
    for pattern, to in INHERENT_RULES:
        out = F.regexp_replace(out, pattern, to.replace("\\", "$"))
    for letter, latin in OTHER_LONG.items():
        out = F.replace(out, F.lit(letter), F.lit(latin))
    return F.when(c.rlike(OTHER_SCRIPTS), F.translate(out, *OTHER_STEPS[1])).otherwise(c)


def ascii_fold(c: Column) -> Column:
    """Latin letters without accents, and those of the scripts that romanize knows; letters of other scripts stay."""
    c = romanize(c)
    for whole, plain in WHOLE_LETTERS.items():
        c = F.replace(c, F.lit(whole), F.lit(plain))
    return F.regexp_replace(F.translate(c, ACCENTED, BASE), ACCENTS, "")


ACCENTS = "[\u0300-\u036f]"  # marks written after their letter
STRANGE = r"[^\p{L}\p{M}\p{Nd}_\s]"


def basic_clean(c: Column, transliterate: Transliterator | None = None) -> Column:
    """Lower case, no accents, letters, digits and underscores only, single blanks; letters of scripts that can't be romanized stay. Null, blank and 'nan' give ''. transliterate is applied before."""
    folded = ascii_fold(transliterate(c) if transliterate else c)
    clean = F.trim(F.regexp_replace(F.regexp_replace(F.lower(folded), STRANGE, " "), r"\s+", " "))
    empty = c.isNull() | (F.lower(F.regexp_replace(c, r"^\s+|\s+$", "")) == "nan")
    return F.when(empty, F.lit("")).otherwise(clean)


def _mapped(clean: Column, table: dict[str, str]) -> Column:
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.array_join(F.transform(F.split(clean, " "), lambda t: F.coalesce(F.try_element_at(m, t), t)), " ")


def name_norm(clean: Column) -> Column:
    return _mapped(clean, LEGAL_FORMS)


def name_core(clean: Column) -> Column:
    """Without legal forms; a name of nothing else stays as it is."""
    core = F.array_join(F.filter(F.split(clean, " "), lambda t: ~F.array_contains(F.array(*map(F.lit, LEGAL_FORMS)), t)), " ")
    return F.when(core == "", clean).otherwise(core)


def addr_norm(clean: Column) -> Column:
    return _mapped(clean, STREET_WORDS)


def postal_code(clean: Column) -> Column:
    """The last run of four to six digits that stands alone, or ''."""
    return F.coalesce(F.try_element_at(F.regexp_extract_all(clean, F.lit(r"\b\d{4,6}\b"), F.lit(0)), F.lit(-1)), F.lit(""))


def block_key(core: Column, width: int = KEY_WIDTH) -> Column:
    return F.substring(F.array_join(F.array_sort(F.split(core, " ")), ""), 1, width)


def tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, " "), lambda t: t != ""))


def char_ngrams(c: Column, n: int = 3) -> Column:
    """Distinct n-grams without blanks; a shorter text is one gram, a blank one none."""
    s = F.replace(c, F.lit(" "), F.lit(""))
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(s) - (n - 1)), lambda i: F.substring(s, i, F.lit(n))))
    return F.when(F.length(s) >= n, grams).when(s != "", F.array(s)).otherwise(F.array().cast("array<string>"))


def parse_id_list(c: Column) -> Column:
    """The distinct ids of a comma list in order; null, blank and 'nan' give none."""
    items = F.array_distinct(F.filter(F.transform(F.split(c, ","), lambda e: F.regexp_replace(e, r"^\s+|\s+$", "")), lambda e: e != ""))
    return F.when(c.isNull() | F.lower(F.regexp_replace(c, r"^\s+|\s+$", "")).isin("", "nan"), F.array().cast("array<string>")).otherwise(items)


def source_of(candidate_id: Column) -> Column:
    return F.substring(candidate_id, 1, 2)


def prepare(df: DataFrame, transliterate: Transliterator | None = None) -> DataFrame:
    """Records with entity_id, country ('' for null) and the six normal forms; exact repetitions of a record count once."""
    raw = df.select("entity_id", "business_name", "business_address", F.coalesce("country", F.lit("")).alias("country")).distinct()
    c = raw.select("entity_id", "country", basic_clean(F.col("business_name"), transliterate).alias("n"), basic_clean(F.col("business_address"), transliterate).alias("a"))
    c = c.select("entity_id", "country", name_norm(F.col("n")).alias("name_norm"), name_core(F.col("n")).alias("name_core"), addr_norm(F.col("a")).alias("addr_norm"), postal_code(F.col("a")).alias("postal"))
    return c.withColumns({"name_core_rev": F.reverse("name_core"), "block_key": block_key(F.col("name_core"))})


def prepare_text(df: DataFrame, field: str = "name") -> DataFrame:
    """(entity_id, country, text) for embedding, from the raw columns: name, address or name_address."""
    n, a = F.coalesce("business_name", F.lit("")), F.coalesce("business_address", F.lit(""))
    forms = {"name": n, "address": a, "name_address": F.when(F.trim(a) == "", n).otherwise(F.concat(n, F.lit(" -- "), a))}
    if field not in forms:
        raise ValueError(f"unknown field {field!r}; choose from {sorted(forms)}")
    return df.select("entity_id", F.coalesce("country", F.lit("")).alias("country"), forms[field].alias("text")).distinct()


def default_prefixes(model_name: str) -> tuple[str, str]:
    """(query, passage) prefixes that a sentence model expects: those of the E5 family, else none."""
    return ("query: ", "passage: ") if "e5" in model_name.lower().rsplit("/", 1)[-1].split("-") else ("", "")


# The same rules as DuckDB SQL.


def sql_romanize(x: str) -> str:
    out = f"translate(lower({x}), '{OTHER_STEPS[0][0]}', '{OTHER_STEPS[0][1]}')"
    for pattern, to in INHERENT_RULES:
        out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
    for letter, latin in OTHER_LONG.items():
        out = f"replace({out}, '{letter}', '{latin}')"
    return f"(CASE WHEN regexp_matches({x}, '{OTHER_SCRIPTS}') THEN translate({out}, '{OTHER_STEPS[1][0]}', '{OTHER_STEPS[1][1]}') ELSE {x} END)"


def sql_fold(x: str) -> str:
    x = sql_romanize(x)
    for whole, plain in WHOLE_LETTERS.items():
        x = f"replace({x}, '{whole}', '{plain}')"
    return f"regexp_replace(translate({x}, '{ACCENTED}', '{BASE}'), '{ACCENTS}', '', 'g')"


def sql_clean(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR lower(regexp_replace({x}, '^\\s+|\\s+$', '', 'g')) = 'nan' THEN '' ELSE trim(regexp_replace(regexp_replace(lower({sql_fold(x)}), '{STRANGE}', ' ', 'g'), '\\s+', ' ', 'g')) END)"


def _sql_map(table: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in table.items()) + "}"


def sql_mapped(c: str, table: dict[str, str]) -> str:
    return f"array_to_string(list_transform(string_split({c}, ' '), lambda t: coalesce({_sql_map(table)}[t], t)), ' ')"


def sql_core(c: str) -> str:
    core = f"array_to_string(list_filter(string_split({c}, ' '), lambda t: NOT list_contains({sorted(LEGAL_FORMS)}, t)), ' ')"
    return f"(CASE WHEN {core} = '' THEN {c} ELSE {core} END)"


def sql_postal(c: str) -> str:
    return f"coalesce(regexp_extract_all({c}, '\\b\\d{{4,6}}\\b')[-1], '')"


def sql_block_key(core: str) -> str:
    return f"left(array_to_string(list_sort(string_split({core}, ' ')), ''), {KEY_WIDTH})"


def sql_tokens(c: str) -> str:
    return f"list_filter(string_split({c}, ' '), lambda t: t <> '')"


def sql_ngrams(c: str, n: int = 3) -> str:
    s = f"replace({c}, ' ', '')"
    return f"(CASE WHEN length({s}) >= {n} THEN list_distinct(list_transform(range(1, length({s}) - {n - 2}), lambda i: substring({s}, i, {n}))) WHEN {s} <> '' THEN [{s}] ELSE [] END)"


def sql_id_list(c: str) -> str:
    items = f"list_filter(list_transform(string_split({c}, ','), lambda e: regexp_replace(e, '^\\s+|\\s+$', '', 'g')), lambda e: e <> '')"
    return f"(CASE WHEN {c} IS NULL OR lower(regexp_replace({c}, '^\\s+|\\s+$', '', 'g')) IN ('', 'nan') THEN [] ELSE list_distinct({items}) END)"


def sql_prepared(tables: dict[str, str]) -> str:
    """CTEs rec (all prepared records with src) over the given source tables."""
    parts = " UNION ALL ".join(f"SELECT DISTINCT '{src}' AS src, entity_id, business_name, business_address, coalesce(country, '') AS country FROM {t}" for src, t in tables.items())
    return f"""raw AS ({parts}),
cl AS (SELECT src, entity_id, country, {sql_clean("business_name")} AS n, {sql_clean("business_address")} AS a FROM raw),
nf AS (SELECT src, entity_id, country, {sql_mapped("n", LEGAL_FORMS)} AS name_norm, {sql_core("n")} AS name_core, {sql_mapped("a", STREET_WORDS)} AS addr_norm, {sql_postal("a")} AS postal FROM cl),
rec AS MATERIALIZED (SELECT *, reverse(name_core) AS name_core_rev, {sql_block_key("name_core")} AS block_key FROM nf)"""

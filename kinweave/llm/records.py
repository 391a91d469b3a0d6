"""Reading business names, postal addresses and countries written by people.

Pure functions on one value at a time, and with_fields, which applies them to a
table in Arrow batches. Nothing here depends on the country of a record.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.session import partitions

# Word lists and lookup tables.
PLACEHOLDERS = frozenset(["", "-", "--", ".", "n/a", "na", "nan", "none", "null", "nil", "not available", "unknown", "tbd"])
LEGAL = frozenset(
    "inc incorporated corp corporation co company ltd limited lmtd llc llp pvt private prvt praivet elaelapi plc gmbh sa sarl spa sas eurl ag aktiengesellschaft kg bv nv sl slu srl ltda limitada pte lp se oy ab".split()
)
LEGAL_LONG = ("incorporated", "corporation", "company", "limited", "private", "limitada", "aktiengesellschaft")
LINES = (
    "services manufacturing pharmaceuticals optics packaging chemicals ceramics travels furniture exports technologies electronics systems engineering enterprises industries constructions "
    "trading logistics media marine plastics jewellers consulting international motors hardware laboratories bakery software textiles holdings foods printing energy timber"
).split()
IDLE = frozenset("and n et und y e the ms hq regd old m".split())
NICKNAMES = {
    "william": "will bill billy", "alexander": "alex sascha sasha", "james": "jim jimmy jamie", "johannes": "hans joh johann", "giovanni": "gianni vanni gio",
    "elizabeth": "liz betty beth eliza", "rajesh": "raj raju", "nicolas": "nico nick", "mohammed": "mohd md mohammad muhammad", "jose": "pepe", "thomas": "tom tommy",
    "katherine": "kathy kate katie", "dorothea": "dora thea", "robert": "rob bob bobby", "lakshmi": "laxmi", "margaret": "maggie peggy meg", "michael": "mike mick",
    "friedrich": "fredrik fritz friedel", "richard": "rick dick richie", "susan": "sue suzy susie", "francesco": "franco cesco", "charles": "charlie chuck", "antonio": "anton toni tony", "edward": "ted ned eddie ed",
}
FORMAL = {nick: name for name, nicks in NICKNAMES.items() for nick in nicks.split()}
STREET_TYPES = {
    "street": "street st str", "road": "road rd", "avenue": "avenue ave av", "boulevard": "boulevard blvd boul bd", "drive": "drive dr", "lane": "lane ln la gali",
    "nagar": "nagar ngr nagr", "marg": "marg mg mrg", "colony": "colony col clny", "rue": "rue r", "allee": "allee all", "chemin": "chemin chem ch", "place": "place pl",
    "calle": "calle c", "avenida": "avenida avda avd", "plaza": "plaza pza plz", "paseo": "paseo po pso", "camino": "camino cno cam", "ronda": "ronda rda", "rua": "rua",
    "praca": "praca pca", "alameda": "alameda al", "travessa": "travessa trav tv", "largo": "largo lgo lg", "via": "via v", "viale": "viale vle", "corso": "corso cso", "piazza": "piazza pzza",
    "vicolo": "vicolo vic vlo", "court": "court ct", "square": "square sq", "terrace": "terrace ter", "highway": "highway hwy", "strasse": "strasse", "platz": "platz", "weg": "weg", "ring": "ring rg",
    "gasse": "gasse", "laan": "laan", "gracht": "gracht gr", "straat": "straat", "plein": "plein", "kade": "kade",
}
TYPE_OF = {w: t for t, ws in STREET_TYPES.items() for w in ws.split()}
SAME_TYPE = {"strasse": "street", "straat": "street", "plein": "platz", "rua": "rue", "avenida": "avenue", "alameda": "allee", "piazza": "plaza", "praca": "plaza"}  # one abbreviation stands for both
FUSED = {"strasse": "strasse", "straat": "straat", "platz": "platz", "allee": "allee", "gracht": "gracht", "gasse": "gasse", "plein": "plein", "laan": "laan", "ring": "ring", "weg": "weg", "kade": "kade", "str": "strasse", "rg": "ring", "pl": "platz", "gr": "gracht", "wg": "weg"}
NAME_AFTER = frozenset("rue allee chemin place calle avenida plaza paseo camino ronda rua praca alameda travessa largo via viale corso piazza vicolo".split())
ARTICLES = frozenset("de du des la le les da do dos del della di d l".split())
COUNTRIES = {
    "india": "in ind bharat bhaarat", "united states": "us usa america", "france": "fr fra", "united kingdom": "uk gb gbr great britain england", "italy": "it ita italia", "germany": "de ger deu deutschland",
    "spain": "es esp espana", "brazil": "br bra brasil", "netherlands": "nl nld nederland holland ne", "malta": "mt ma", "australia": "au aus", "singapore": "sg si sgp", "canada": "ca can",
    "kenya": "ke ken", "belize": "bz be", "new zealand": "nz ne nzl", "jamaica": "jm ja jam", "ghana": "gh gha", "ireland": "ie ir irl",
}
ALIASES: dict[str, set[str]] = {}
for _name, _short in COUNTRIES.items():
    for _w in [_name, *_short.split()]:
        ALIASES.setdefault(_w, set()).add(_name)
CONSONANTS = dict(zip("कखगघङचछजझञटठडढणतथदधनपफबभमयरलळवशषसह", "k kh g gh n ch chh j jh n t th d dh n t th d dh n p f b bh m y r l l v sh sh s h".split(), strict=True))
VOWELS = dict(zip("अआइईउऊऋएऐओऔऑ", "a a i i u u ri e ai o au o".split(), strict=True))
SIGNS = dict(zip("ािीुूृेैोौॉ", "a i i u u ri e ai o au o".split(), strict=True)) | {"्": "", "ं": "n", "ँ": "n", "ः": "h", "़": ""}


def romanize(text: str) -> str:
    """Devanagari to Latin letters; a consonant's own vowel is written only where another letter follows."""
    out = []
    for i, c in enumerate(text):
        if c in CONSONANTS:
            out.append(CONSONANTS[c])
            after = text[i + 1 : i + 2]
            if after in CONSONANTS or after in VOWELS:
                out.append("a")
        else:
            out.append(VOWELS.get(c, SIGNS.get(c, c)))
    return "".join(out)


def fold(text: str) -> str:
    """Lower-case text without accents, Devanagari in Latin letters."""
    if not text.isascii():
        if any("ऀ" <= c <= "ॿ" for c in text):
            text = romanize(unicodedata.normalize("NFC", text))
        text = "".join(c for c in unicodedata.normalize("NFKD", text.casefold()) if not unicodedata.combining(c))
    return text.casefold()


LEET = str.maketrans("0135", "oles")


def word(token: str) -> str:
    """Figures typed for letters inside a word are turned back."""
    return token.translate(LEET) if not token.isdigit() and not token.isalpha() else token


@lru_cache(1 << 16)
def osa(a: str, b: str, most: int = 3) -> int:
    """Edit distance with transpositions (optimal string alignment), or most + 1 if it is larger."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            now.append(d)
        if min(now) > most:
            return most + 1
        before, row = row, now
    return min(row[-1], most + 1)


def within(a: str, b: str) -> bool:
    """Same word but for typing errors: one for words of at least four letters, two from eight letters on."""
    n = min(len(a), len(b))
    return a == b or (n >= 4 and osa(a, b, 2) <= (2 if n >= 8 else 1))


def is_subsequence(a: str, b: str) -> bool:
    it = iter(b)
    return all(c in it for c in a)


@lru_cache(1 << 16)
def lines_of(token: str) -> frozenset[str]:
    """The lines of business that a word can stand for: whole, abbreviated, inflected or mistyped."""
    if len(token) < 3:
        return frozenset()
    got = set()
    for line in LINES:
        if token == line:
            return frozenset([line])
        same = 0
        while same < min(len(token), len(line)) and token[same] == line[same]:
            same += 1
        short = token[0] == line[0] and len(token) < len(line) and is_subsequence(token, line) and (same >= 3 or (len(token) <= 6 and len(re.findall("[aeiou]", token)) <= 1))
        if short or (same >= 4 and same >= 0.6 * len(token) and abs(len(token) - len(line)) <= 4) or (len(token) >= 5 and osa(token, line, 1) <= 1):
            got.add(line)
    return frozenset(got)


DOTTED = re.compile(r"\b((?:[a-z][./]\s?){1,}[a-z]\b\.?|(?:[a-z]\.){2,})")
NAME_MARKS = re.compile(r"\(\s*(?:regd|old|new)\.?\s*\)|-\s*hq\b|^m\s*/\s*s\.?\s|^the\s")
PIECES = re.compile(r"[^\W_]+")


def read_name(name: str | None) -> tuple[list[str], list[str], str] | None:
    """(core words, lines of business, acronym) of a business name, or None if there is none.

    The core leaves out legal forms, lines of business and idle words; nicknames become formal names. acronym is set
    where the name is only initials (KMS Ltd, B.B.E).
    """
    if name is None or name.strip().casefold() in PLACEHOLDERS:
        return None
    t = NAME_MARKS.sub(" ", fold(name).replace("'", "").replace("’", "").strip())
    t = re.sub(r"\(\s*p\s*\)", " pvt ", t)
    t = DOTTED.sub(lambda m: " " + re.sub(r"[./\s]", "", m[0]) + " " if len(re.sub(r"[./\s]", "", m[0])) > 1 else m[0], t)
    core, lines = [], []
    tokens = [word(w) for w in PIECES.findall(t)]
    for w in tokens:
        if w in LEGAL or any(osa(w, x, 2) <= (2 if len(x) > 9 else 1) for x in LEGAL_LONG if len(w) > 5 and w[0] == x[0]):
            continue
        if w in IDLE and len(tokens) > 1:
            if w not in "m":
                continue
        got = lines_of(w) if w not in FORMAL and w not in NICKNAMES else frozenset()
        if got:
            lines.append("|".join(sorted(got)))
        else:
            core.append(FORMAL.get(w, w))
    if not core and lines:
        core, lines = [w for w in tokens if w not in LEGAL], []
    if not core:
        return None
    acronym = core[0] if len(core) == 1 and not lines and 2 <= len(core[0]) <= 6 and not re.search("[aeiou][^aeiou]+[aeiou]|[^aeiou][aeiou][^aeiou]", core[0]) else ""
    return core, lines, acronym


def initials(core: list[str], lines: list[str]) -> str:
    return "".join(w[0] for w in core) + "".join(x[0] for x in lines)


@lru_cache(1 << 14)
def country_set(country: str) -> frozenset[str]:
    c = re.sub(r"[^a-z ]", "", fold(country)).strip()
    return frozenset() if c in PLACEHOLDERS else frozenset(ALIASES.get(c, {c}))


LANDMARK = re.compile(r"\b(?:opp|opposite|behind|near|beside|next to|adjacent to)\b\.?\s+(?:the\s+)?[^\W\d_]+\s+[^\W\d_]+")
UNIT = re.compile(r"\b(?:shop|unit|suite|ste|apt|apartment|flat|office|room|floor|fl|level|bldg|building|block)\b[.\s]*(?:(?:no|nr|n|number)\b)?[.\s°]*#?\s*(\d+[a-z]?)\b|\b\d+\s*(?:st|nd|rd|th)\s+floor\b|\b\d{1,3}f\b")
UK = re.compile(r"\b([a-z]{1,2})(\d{1,2}[a-z]?)\s*(\d[a-z]{2})\b")
NL = re.compile(r"\b(\d{4})\s?([a-z]{2})\b(?!\s*\d)")
LONG = re.compile(r"\b\d{5,6}\b")
NUMBER = re.compile(r"(?:#|\bn(?:o|r)?\b[.°]*|°)\s*(?=\d)")


SHORT = re.compile(r"\b([plcv])\.\s?(?=(?:zza|go|so|le)\b)")
LAST = re.compile(r"[\s,.-]+(?:%s)[\s,.]*$" % "|".join(sorted((re.escape(w) for w in ALIASES if len(w) > 3 or w in ("us", "uk", "usa")), key=len, reverse=True)))


def read_address(address: str | None) -> tuple[str, str, str, str, str, str] | None:
    """(number, street type, street, town, postal code, area) of an address, blank where missing, or None for placeholders.

    Landmarks, floors, units and a country are dropped. area is the leading part of the postal code, which
    neighbouring addresses of a town share.
    """
    if address is None or address.strip().casefold() in PLACEHOLDERS:
        return None
    t = fold(address).replace("'", "")
    t = LAST.sub(" ", LANDMARK.sub(" , ", t))
    t = SHORT.sub(r"\1", t)
    t = UNIT.sub(" , ", t)
    postal = area = ""
    if m := UK.search(t):
        postal, area = m[1] + m[2] + m[3], m[1]
        t = t[: m.start()] + " , " + t[m.end() :]
    elif m := LONG.search(t):
        postal, area = m[0], m[0][: 3 if len(m[0]) == 6 else 2]
        t = t[: m.start()] + " , " + t[m.end() :]
    elif (m := NL.search(t)) and m[2] not in TYPE_OF:
        postal, area = m[1] + m[2], m[1][:2]
        t = t[: m.start()] + " , " + t[m.end() :]
    t = NUMBER.sub(" # ", t)
    segments = [[word(w) if w != "#" else w for w in re.findall(r"#|[^\W_]+", s)] for s in re.split(r"[,;|]|\s-\s|\s-|-\s", re.sub(r"(?<=\w)-(?=\w)", "", t))]
    segments = [s for s in segments if s]
    for k, s in enumerate(segments):  # a country by itself, or at the very end
        if k and " ".join(s) in ALIASES and len(" ".join(s)) != 2 or " ".join(s) in ("us", "uk"):
            segments[k] = []
    segments = [s for s in segments if s]
    # one list of words with breaks between segments
    words: list[str] = []
    for s in segments:
        words += [*s, ","]
    marks = [i for i, w in enumerate(words) if w == "#"]
    found = _street(words)
    if found is None:
        return "", "", "", " ".join(w for w in words if w.isalpha()), postal, area
    kind, name, used, at = found
    numbers = [i for i, w in enumerate(words) if w.isdigit() and len(w) <= 4]
    number = ""
    if numbers:
        # the number next to the street; a number marked # that stands apart is a unit
        near = sorted(numbers, key=lambda i: (min(abs(i - at[0]), abs(i - at[1])), (i - 1) in marks))
        number = words[near[0]]
    town = "".join(w for i, w in enumerate(words) if w.isalpha() and i not in used and w not in ARTICLES)
    return number.lstrip("0"), SAME_TYPE.get(kind, kind), name, town, postal, area


def _street(words: list[str]) -> tuple[str, str, set[int], tuple[int, int]] | None:
    """(type, name, word positions used, first and last position) of the street among words."""
    best = None
    for i, w in enumerate(words):
        kind = TYPE_OF.get(w)
        left = words[i - 1] if i else ","
        if kind and not (len(w) == 1 and not (left in ",#" or left.isdigit())):
            if kind in NAME_AFTER or not left.isalpha():
                j = i + 1
                while j < len(words) and words[j] in ARTICLES:
                    j += 1
                if j < len(words) and words[j].isalpha():
                    best = best or (kind, words[j], set(range(i, j + 1)), (i, j))
                    continue
            if left.isalpha() and left not in TYPE_OF:
                cand = (kind, left, {i - 1, i}, (i - 1, i))
                if i >= 2 and (words[i - 2].isdigit() or words[i - 2] in ",#"):
                    return cand
                best = best or cand
    if best:
        return best
    for i, w in enumerate(words):  # name and type in one word
        for end, kind in FUSED.items():
            if w.endswith(end) and len(w) - len(end) >= 3:
                beside = [words[k] for k in (i - 1, i + 1) if 0 <= k < len(words)]
                if any(x.isdigit() or x == "#" for x in beside) or len(end) > 3:
                    return kind, w[: -len(end)], {i}, (i, i)
    for i, w in enumerate(words):  # a mistyped type
        if len(w) >= 4 and w.isalpha():
            for kind in STREET_TYPES:
                if len(kind) >= 4 and osa(w, kind, 1) <= 1 and i and words[i - 1].isalpha():
                    return kind, words[i - 1], {i - 1, i}, (i - 1, i)
    for i, w in enumerate(words):  # no type: the word after the number
        if w.isdigit() and i + 1 < len(words) and words[i + 1].isalpha():
            return "", words[i + 1], {i + 1}, (i + 1, i + 1)
    return None


def with_fields(df: DataFrame, id_col: str = "entity_id", name: str = "business_name", address: str = "business_address", country: str = "country") -> DataFrame:
    """One row for each id with what can be read of its record.

    Columns: id, core (words joined by blanks), lines (joined by commas), acronym, initials, number, kind, street, town,
    postal, area, country (known names joined by |); blank where missing. Null ids are dropped. A repeated id counts
    once, by its latest content in the order (name, address, country).
    """
    c = {k: F.col(v).cast("string").alias(k) for k, v in (("n", name), ("a", address), ("c", country))}
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), *c.values()).repartition(4 * partitions(df.sparkSession), "id")
    rows = rows.groupBy("id").agg(F.max(F.struct("n", "a", "c")).alias("r")).select("id", "r.n", "r.a", "r.c")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, n, a, ctry in zip(b["id"], b["n"], b["a"], b["c"], strict=True):
                core, lines, acronym = read_name(n) or ([], [], "")
                number, kind, street, town, postal, area = read_address(a) or ("",) * 6
                out.append((i, " ".join(core), ",".join(lines), acronym, initials(core, lines), number, kind, street, town, postal, area, "|".join(sorted(country_set(ctry or "")))))
            yield pd.DataFrame(out, columns=FIELDS)

    return rows.mapInPandas(read, ", ".join(f"{f} string" for f in FIELDS))


FIELDS = ["id", "core", "lines", "acronym", "initials", "number", "kind", "street", "town", "postal", "area", "country"]

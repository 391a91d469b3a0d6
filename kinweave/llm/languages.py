"""The language of documents and of single paragraphs, with a confidence.

A bidirectional gated recurrent network over bytes (bytegru) is trained on
paragraphs of labelled documents and then labels every byte of every text cell;
bytes are pooled to paragraphs, paragraphs, by their words, to documents. The
uploaders' labels are partly wrong and documents mix languages, so training runs
twice: where the first net is sure that a paragraph has another language than its
label, that replaces the label, and paragraphs in doubt are left out of the second
training. Paragraphs are read whole, in stretches of at most PIECE bytes that end
at blanks, each with a fresh state.

The training sample is bounded: the sample_size labelled paragraphs with the
smallest hashes (3600 by default), and of every language at least floor (240)
where there are as many; labelling covers all texts, whole.

A document's own language is the prior of its paragraphs: a paragraph counts as
foreign only if its language is ODDS times as probable as the document's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinweave.llm import bytegru

LANGUAGES = ("en", "de", "fr", "es", "pt", "it", "nl", "hi")
GAP = re.compile(r"\n[^\S\n]*\n\s*")
NOISE = re.compile(r"https?://\S+|`[^`\n]*`")
APART = re.compile(r"[\s\d_!-/:-@\[-`{-~]+")
WORD = re.compile(r"\S*[^\W_]\S*")
PIECE = 192  # bytes run through the net at a stretch; longer paragraphs are read in several
CHUNK = 400_000  # bytes labelled at a time
ODDS = 8.0


def paragraphs(cell: str) -> list[str]:
    """The pieces of a cell between blank lines."""
    return [p for p in GAP.split(cell.strip()) if p.strip()]


def n_words(text: str) -> int:
    return len(WORD.findall(text))


def reading(text: str) -> bytes:
    """What the net reads of a paragraph: case, figures and ASCII punctuation don't count, nor do code spans and addresses."""
    return APART.sub(" ", NOISE.sub(" ", text).casefold()).strip().encode("utf-8", "replace")


def stretches(data: bytes) -> list[bytes]:
    """Pieces of at most PIECE bytes, cut at blanks where there are any."""
    out = []
    while len(data) > PIECE:
        cut = data.rfind(b" ", PIECE // 2, PIECE)
        cut = cut if cut > 0 else PIECE
        out.append(data[:cut])
        data = data[cut:]
    return [*out, data]


def fit(samples: list[tuple[str, str]], hidden: int = 16, epochs: tuple[int, int] = (4, 10), keep: float = 0.3, turn: float = 0.85) -> bytegru.Net:
    """A net trained on whole (text, language) samples, in stretches, after one cleaning by its own judgement.

    A sample stays as labelled if the first net gives its label at least the share keep, takes the net's language if that has at least
    the share turn, and is left out of the second training otherwise.
    """
    pieces = [(piece, k) for k, (t, _) in enumerate(samples) for piece in stretches(reading(t)) if len(piece) >= 8]
    if not pieces:
        return bytegru.fresh(hidden, len(LANGUAGES), 7)
    texts, owner = [t for t, _ in pieces], np.array([k for _, k in pieces])
    labels = np.array([LANGUAGES.index(lang) for _, lang in samples])
    net = bytegru.train(texts, labels[owner].tolist(), len(LANGUAGES), hidden, epochs[0], batch=32)
    p = np.zeros((len(samples), len(LANGUAGES)))
    np.add.at(p, owner, bytegru.pool_bytes(net, texts))
    p /= np.maximum(p.sum(axis=1, keepdims=True), 1e-9)
    top = p.argmax(axis=1)
    stays = p[np.arange(len(p)), labels] >= keep
    turns = ~stays & (p.max(axis=1) >= turn)
    labels = np.where(turns, top, labels)
    some = np.flatnonzero((stays | turns)[owner])
    return bytegru.train([texts[i] for i in some], labels[owner[some]].tolist(), len(LANGUAGES), hidden, epochs[1], batch=32, rate=0.012, net=net)


def label_all(net: bytegru.Net, texts: list[str]) -> np.ndarray:
    """(texts, languages): pooled probabilities, each row summing to 1, or all 0 where there is nothing to read. A text that occurs again is read once."""
    out = np.zeros((len(texts), len(LANGUAGES)))
    index: dict[str, list[int]] = {}
    for i, t in enumerate(texts):
        index.setdefault(t, []).append(i)
    todo: list[bytes] = []
    owner: list[list[int]] = []
    size = 0

    def flush() -> None:
        for at, p in zip(owner, bytegru.pool_bytes(net, todo), strict=True):
            out[at] += p

    for t, at in index.items():
        for piece in stretches(reading(t)):
            if not piece:
                continue
            todo.append(piece)
            owner.append(at)
            size += len(piece)
            if size >= CHUNK:
                flush()
                todo, owner, size = [], [], 0
    if todo:
        flush()
    total = out.sum(axis=1, keepdims=True)
    return np.divide(out, total, out=np.zeros_like(out), where=total > 0)


def training_sample(docs: DataFrame, cells: DataFrame, sample_size: int, floor: int) -> list[tuple[str, str]]:
    """Paragraphs of at least eight words with the label of their document: the sample_size with the smallest hashes, and of every language the floor with the smallest."""
    lang = label_code(F.col("lang"))
    labelled = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", lang.alias("code")).where(F.col("code").isin(*LANGUAGES))
    # the documents that supply them are bounded likewise, so that only those are cut into paragraphs
    h = F.xxhash64(F.col("doc_id").cast("string"))
    some = labelled.select("doc_id", "code").withColumn("_n", F.row_number().over(W.partitionBy("code").orderBy(h, "doc_id"))).where(F.col("_n") <= floor)
    wide = labelled.select("doc_id", "code").orderBy(h, "doc_id").limit(sample_size)
    chosen = some.select("doc_id").union(wide.select("doc_id")).distinct()
    spans = cells.where(F.col("cell_type") == "text").select("doc_id", "char_start", "char_end").distinct()
    cut = F.expr("substring(text, char_start + 1, char_end - char_start)")
    picked = labelled.join(F.broadcast(chosen), "doc_id").join(spans.join(F.broadcast(chosen), "doc_id", "left_semi"), "doc_id")
    pieces = picked.select("code", F.explode(F.split(F.trim(cut), r"\n[ \t]*\n")).alias("p")).where(F.size(F.split(F.trim("p"), r"\s+")) >= 8).distinct()
    pieces = pieces.withColumn("_h", F.xxhash64("p"))
    least = pieces.withColumn("_n", F.row_number().over(W.partitionBy("code").orderBy("_h", "p"))).where(F.col("_n") <= floor).select("code", "p", "_h")
    best = pieces.select("code", "p", "_h").orderBy("_h", "p").limit(sample_size).union(least).distinct()
    return [(r["p"], r["code"]) for r in best.orderBy("_h", "p", "code").collect()]  # at most sample_size + 8 * floor rows


def label_code(lang: Column) -> Column:
    return F.lower(F.substring(F.trim(lang), 1, 2))


SCHEMA = "doc_id {t}, cell_no int, para_no int, lang string, confidence double, n_words int, main boolean"


def language_rows(docs: DataFrame, cells: DataFrame, net: bytegru.Net, min_doc_words: int = 20, min_words: int = 8) -> DataFrame:
    """One row with cell_no = para_no = -1 for each document that has min_doc_words words in text cells, and one for each of its paragraphs of at least min_words words in another language.

    Columns: doc_id, cell_no, para_no, lang, confidence, n_words, main. docs needs doc_id and text; cells doc_id, cell_no,
    cell_type, char_start and char_end. A document's language is that of most words of its text cells; its confidence is
    the word-weighted mean probability, a paragraph's the mean probability over its bytes. Null ids or texts and
    documents without text cells give no rows; spans beyond the text are cut at its end, null spans are skipped;
    repeated rows of either table count once. Paragraphs without letters (figures, links) have no language. Ties go to
    the language that comes first in LANGUAGES.
    """
    t = docs.schema["doc_id"].dataType.simpleString()
    spans = (
        cells.where((F.col("cell_type") == "text") & F.col("cell_no").isNotNull() & F.col("char_start").isNotNull() & F.col("char_end").isNotNull())
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_set(F.struct("cell_no", "char_start", "char_end"))).alias("spans"))
    )
    held = spans.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = held.value
        for batch in batches:
            ids, texts, spans = batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("spans")
            lo = 0
            while lo < len(ids):
                # a bounded amount of text at a time
                rows, paras, size, start = [], [], 0, lo
                while lo < len(ids) and (size < 2_000_000 or lo == start):
                    text = texts[lo].as_py()
                    size += len(text)
                    for s in spans[lo].as_py():
                        for k, p in enumerate(paragraphs(text[max(0, s["char_start"]) : max(0, s["char_end"])])):
                            rows.append((lo, s["cell_no"], k, n_words(p)))
                            paras.append(p)
                    lo += 1
                p = label_all(net, paras)
                yield found_in(ids, rows, p, batch.schema.field("doc_id").type)

    def found_in(ids: list, rows: list, p: np.ndarray, id_type: pa.DataType) -> pa.RecordBatch:
        out: list[tuple] = []
        top = p.argmax(axis=1) if len(p) else []
        i = 0
        while i < len(rows):
            j = i
            votes, weight = np.zeros(len(LANGUAGES)), np.zeros(len(LANGUAGES))
            while j < len(rows) and rows[j][0] == rows[i][0]:
                if p[j].any():
                    votes[top[j]] += rows[j][3]
                    weight += rows[j][3] * p[j]
                j += 1
            words = int(votes.sum())
            if words >= min_doc_words:
                main = int(votes.argmax())
                d = ids[rows[i][0]]
                out.append((d, -1, -1, LANGUAGES[main], float(weight[main] / words), words, True))
                out += [(d, rows[k][1], rows[k][2], LANGUAGES[top[k]], float(p[k][top[k]]), rows[k][3], False) for k in range(i, j) if rows[k][3] >= min_words and p[k][top[k]] > ODDS * p[k][main]]
            i = j
        types = [id_type, pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.bool_()]
        names = ["doc_id", "cell_no", "para_no", "lang", "confidence", "n_words", "main"]
        cols = list(zip(*out, strict=True)) if out else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), ty) for c, ty in zip(cols, types, strict=True)], names)

    read = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text").join(spans, "doc_id")
    return read.mapInArrow(run, SCHEMA.format(t=t))


def languages(docs: DataFrame, cells: DataFrame, sample_size: int = 3600, floor: int = 240, hidden: int = 16) -> DataFrame:
    """language_rows of a net fitted on the documents' own labels. Without a single labelled paragraph the labels mean nothing: no rows."""
    samples = training_sample(docs, cells, sample_size, floor)
    rows = language_rows(docs, cells, fit(samples, hidden))
    return rows if samples else rows.limit(0)


def wrong_or_foreign(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, cell_no, para_no, lang, confidence): documents whose label is missing or not the language found, and all foreign paragraphs."""
    given = docs.select("doc_id", F.coalesce(label_code(F.col("lang")), F.lit("")).alias("code")).where("doc_id IS NOT NULL").distinct()
    main = rows.where("main").join(given, "doc_id").where(F.col("code") != F.col("lang"))
    cols = ["doc_id", "cell_no", "para_no", "lang", "confidence"]
    return main.select(cols).union(rows.where("NOT main").select(cols))

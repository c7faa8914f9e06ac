"""Language ID: scripts narrow the candidates, Viterbi over words labels spans.

``train`` counts letter trigrams per language in a sample and notes which scripts each
language is written in. ``identify`` scores every word (a maximal run of letters) under
each language written in the word's script, and finds per text the best path of languages
over its words, where each change of language costs ``penalty``. Runs of one language are
the spans; the language with most letters is the text's, its share of letters the score.

Defined results: texts that are NULL, empty or without letters are ``und`` with score 0.
Letters of words in scripts that no learned language uses count for no language; a text of
such words only gets the first learned language with score 0. Equal letter counts go to
the language first in the alphabet, equal paths to staying. Without training rows all is
``und``. Rows are labelled one by one, so repeated rows and NULL ids need no care; an empty
table gives no rows. Columns besides the named ones are not read.

The model is fitted on about ``max_docs`` documents per language and is a table of
``2**17`` numbers per language, whatever the corpus. Labelling is one pass without a
shuffle; a task works on ``CHUNK`` letters at a time, or on one text if it is longer.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, table

BUCKETS = 1 << 17
CHUNK = 1_000_000
# Code point ranges of scripts; other letters share the last number.
SCRIPTS = (
    ("latin", ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F))),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF),)),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFC))),
    ("devanagari", ((0x900, 0x97F),)),
    ("bengali", ((0x980, 0x9FF),)),
    ("thai", ((0xE00, 0xE7F),)),
    ("georgian", ((0x10A0, 0x10FF), (0x1C90, 0x1CBF))),
    ("hangul", ((0x1100, 0x11FF), (0xAC00, 0xD7AF))),
    ("kana", ((0x3040, 0x30FF), (0x31F0, 0x31FF))),
    ("han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF))),
)
OTHER = len(SCRIPTS) + 1


class Model(NamedTuple):
    languages: list[str]
    scores: np.ndarray  # language x bucket, log chances
    uses: np.ndarray  # script x language, true where the language is written in the script


_tables: list[np.ndarray] = []


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Script number (0: no letter) and lower case of each code point, made once a worker."""
    if not _tables:
        script = np.zeros(0x110000, dtype=np.uint8)
        lower = np.arange(0x110000, dtype=np.uint32)
        of = np.full(0x110000, OTHER, dtype=np.uint8)
        for number, (_, ranges) in enumerate(SCRIPTS, 1):
            for first, last in ranges:
                of[first : last + 1] = number
        for code in range(0x110000):
            c = chr(code)
            if c.isalpha():
                script[code] = of[code]
                small = c.lower()
                if len(small) == 1:
                    lower[code] = ord(small)
        _tables.extend([script, lower])
    return _tables[0], _tables[1]


class Words(NamedTuple):
    """Words of a chunk of texts: first letter and end in the chunk, text, script, buckets."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    script: np.ndarray
    buckets: np.ndarray  # one per letter
    first: np.ndarray  # each word's first letter in buckets
    offset: np.ndarray  # each text's place in the chunk


def read_words(texts: list[str]) -> Words:
    script_of, lower = _letters()
    offset = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le"), dtype="<u4")
    script = script_of[codes]
    is_letter = script > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], is_letter.view(np.int8), [0]])))
    start, end = edge[::2], edge[1::2]
    small = np.where(is_letter, lower[codes], 0).astype(np.uint32)
    mixed = small * np.uint32(0x9E3779B1)
    mixed[1:] += small[:-1] * np.uint32(0x85EBCA6B)
    mixed[:-1] += small[1:] * np.uint32(0xC2B2AE35)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    buckets = (mixed >> np.uint32(15))[is_letter].astype(np.int32)
    first = np.concatenate([[0], np.cumsum(end - start)])[:-1]
    text = np.searchsorted(offset, start, side="right") - 1
    return Words(start, end, text, script[start], buckets, first, offset)


def _chunks(values: list[str | None]):
    """Texts in runs of at most ``CHUNK`` code points, or one longer text."""
    run, size = [], 0
    for value in values:
        text = value or ""
        if run and size + len(text) > CHUNK:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text) + 1
    if run:
        yield run


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_docs: int = 2_000,
) -> Model:
    """The model of ``docs`` with a language; about ``max_docs`` of each language are read."""
    own = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).filter(F.col("lang").isNotNull())
    found = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(found)
    if not languages:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.zeros((OTHER + 1, 0), bool))
    share = F.lit(0)
    for lang, n in found.items():
        most = 1_000_000 if n <= max_docs else int(1_000_000 * max_docs / n)
        share = F.when(F.col("lang") == lang, most).otherwise(share)
    place = F.pmod(F.xxhash64(F.lit(17), "id", "text"), F.lit(1_000_000))
    sample = own.filter(place < share).dropDuplicates(["lang", "text"])
    number = {lang: i for i, lang in enumerate(languages)}

    def count(batches):
        width = BUCKETS + OTHER + 1
        seen = np.zeros((len(languages), width), dtype=np.int64)
        for batch in batches:
            frame = batch.to_pandas()
            for lang, part in frame.groupby("lang"):
                row = seen[number[lang]]
                for texts in _chunks(part["text"].tolist()):
                    words = read_words(texts)
                    row[:BUCKETS] += np.bincount(words.buckets, minlength=BUCKETS)
                    row[BUCKETS:] += np.bincount(
                        words.script, weights=words.end - words.start, minlength=OTHER + 1
                    ).astype(np.int64)
        lang, at = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(seen[lang, at])],
            ["lang", "at", "n"],
        )

    counted = mapped(sample.select("text", "lang"), count, "lang int, at int, n long")
    return _model(languages, counted.groupBy("lang", "at").agg(F.sum("n").alias("n")).toPandas())


def _model(languages: list[str], rows: pd.DataFrame, least: float = 0.01) -> Model:
    """Smoothed log chances; a language uses a script that holds ``least`` of its letters."""
    seen = np.zeros((len(languages), BUCKETS + OTHER + 1))
    seen[rows["lang"].to_numpy(int), rows["at"].to_numpy(int)] = rows["n"].to_numpy(float)
    grams, scripts = seen[:, :BUCKETS] + 0.05, seen[:, BUCKETS:]
    scores = np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32)
    uses = scripts >= np.maximum(scripts.sum(axis=1, keepdims=True) * least, 1)
    return Model(languages, scores, uses.T)


def word_scores(words: Words, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Word x language scores, and which words have a candidate at all."""
    allowed = model.uses[words.script]
    known = allowed.any(axis=1)
    scores = np.empty((len(words.start), len(model.languages)), dtype=np.float32)
    for i, row in enumerate(model.scores):
        scores[:, i] = np.add.reduceat(row[words.buckets], words.first) if len(words.first) else 0
    scores[~allowed] = -1e9
    scores[~known] = 0
    return scores, known


def best_path(scores: np.ndarray, text: np.ndarray, n_texts: int, penalty: float) -> np.ndarray:
    """The language of each word; all texts advance together, a word at a step."""
    n_words, n_langs = scores.shape
    path = np.zeros(n_words, dtype=np.int32)
    if not n_words:
        return path
    counts = np.bincount(text, minlength=n_texts)
    firsts = np.concatenate([[0], np.cumsum(counts)])[:-1]
    order = np.argsort(-counts, kind="stable")
    counts, firsts = counts[order], firsts[order]
    come = np.zeros((n_words, n_langs), dtype=np.int16)
    here = np.arange(n_langs, dtype=np.int16)
    alive = int(np.count_nonzero(counts))
    total = scores[firsts[:alive]].astype(np.float64)
    last = np.zeros(len(counts), dtype=np.int32)
    for step in range(1, counts[0] + 1):
        still = int(np.searchsorted(-counts, -step, side="left"))  # texts with more words
        last[still:alive] = total[still:].argmax(axis=1)
        alive = still
        if not alive:
            break
        total = total[:alive]
        top = total.argmax(axis=1)
        jump = total[np.arange(alive), top][:, None] - penalty
        at = firsts[:alive] + step
        come[at] = np.where(total >= jump, here, top[:, None])
        total = np.maximum(total, jump) + scores[at]
    alive = 0
    state = np.zeros(len(counts), dtype=np.int32)
    for step in range(counts[0] - 1, -1, -1):
        now = int(np.searchsorted(-counts, -step, side="left"))
        state[alive:now] = last[alive:now]
        alive = now
        at = firsts[:alive] + step
        path[at] = state[:alive]
        state[:alive] = come[at, state[:alive]]
    return path


PENALTY = 12.0


def label_texts(texts: list[str], model: Model, penalty: float):
    """Language, score and spans (text, start, end, language) of each text of a chunk."""
    n, n_langs = len(texts), len(model.languages)
    words = read_words(texts)
    if not n_langs or not len(words.start):
        none = np.zeros(0, dtype=np.int64)
        return np.full(n, -1), np.zeros(n), (none, none, none, none)
    scores, known = word_scores(words, model)
    path = best_path(scores, words.text, n, penalty)
    length = (words.end - words.start).astype(float)
    of = np.bincount(
        words.text[known] * n_langs + path[known], weights=length[known], minlength=n * n_langs
    ).reshape(n, n_langs)
    letters = np.bincount(words.text, weights=length, minlength=n)
    best = of.argmax(axis=1)
    share = of[np.arange(n), best] / np.maximum(letters, 1)
    best = np.where(letters > 0, best, -1)
    new = np.ones(len(path), dtype=bool)
    new[1:] = (words.text[1:] != words.text[:-1]) | (path[1:] != path[:-1])
    begins = np.flatnonzero(new)
    ends = np.concatenate([begins[1:], [len(path)]]) - 1
    of_text = words.text[begins]
    shift = words.offset[of_text]
    return best, share, (of_text, words.start[begins] - shift, words.end[ends] - shift, path[begins])


SPANS = "array<struct<start:int,end:int,lang:string>>"


def identify(
    docs: DataFrame,
    model: Model,
    penalty: float = PENALTY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: id, ``lang_pred``, ``score`` and ``spans`` (code points, end exclusive)."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = pa.array([*model.languages, "und"])

    def run(batches):
        for batch in batches:
            langs, shares, spans, n = [], [], [], 0
            for texts in _chunks(batch.column(1).to_pylist()):
                best, share, (of, start, end, lang) = label_texts(texts, model, penalty)
                langs.append(best)
                shares.append(share)
                spans.append((of + n, start, end, lang))
                n += len(texts)
            if not n:
                continue
            of, start, end, lang = (np.concatenate(x) for x in zip(*spans))
            offsets = np.searchsorted(of, np.arange(n + 1), side="left").astype(np.int32)
            found = pa.StructArray.from_arrays(
                [pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), names.take(pa.array(lang))],
                ["start", "end", "lang"],
            )
            best = np.concatenate(langs)
            best = np.where(best < 0, len(model.languages), best)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), names.take(pa.array(best)), pa.array(np.concatenate(shares)),
                 pa.ListArray.from_arrays(pa.array(offsets), found)],
                [id_col, "lang_pred", "score", "spans"],
            )

    schema = f"`{id_col}` {kind}, lang_pred string, score double, spans {SPANS}"
    return mapped(docs.select(id_col, text_col), run, schema)


def keep_identified(
    docs: DataFrame, model: Model, least: float, penalty: float = PENALTY, text_col: str = "text"
) -> DataFrame:
    """The rows, with all columns, whose language has a share of ``least`` of the letters."""
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            stays = []
            for texts in _chunks(batch.column(place).to_pylist()):
                best, share, _ = label_texts(texts, model, penalty)
                stays.append((best >= 0) & (share >= least))
            if stays:
                yield batch.filter(pa.array(np.concatenate(stays)))

    return mapped(docs, run, docs.schema)


def query(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    made = identify(docs, train(docs.filter(~held_out)))
    return made.select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score",
        F.size("spans").cast("long").alias("n_spans"),
    )

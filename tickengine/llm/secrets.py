r"""Secret scans: fixed patterns plus two character Markov models.

``train`` labels character runs of a sample of documents - values that the fixed patterns
find are random strings, all other runs are ordinary identifiers - and counts character
transitions of both classes. ``scan`` returns the spans of the fixed patterns and, as kind
``markov``, further runs of 20 characters or more whose log-likelihood ratio between the
two models is at least ``threshold`` per character. Of a run that fixed patterns cover in
part, each piece they leave is such a run. ``redact`` replaces spans.

Fixed patterns, leftmost and without overlap per kind: ``assign`` (a key word, a sign and
a value of 6 or more characters), ``access`` (AKIA, 20 or more in all) and ``hex`` (24 or
more lower-case hex digits). A ``markov`` span never overlaps one of these.

Defined results: NULL and empty texts have no spans. Rows are scanned one by one, so
repeated rows and NULL ids need no care; an empty table gives no rows, and models without
samples are uniform, so that no run is added. Columns besides the named ones are not read
by ``scan`` and are kept by ``redact``. Texts are scanned whole, in linear time.

The models are fitted on a sample of ``max_docs`` documents (expected number); they are
tables of 2 x 67 x 66 numbers, whatever the corpus. Scanning is one pass, no shuffle.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, sampled, table

# Fixed patterns of the contract.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

KEY_PARTS = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "markov")
# All hex and access matches that count lie inside such a run.
LONG_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{20,}")
IDENTIFIER = re.compile(r"[A-Za-z0-9+/_-]{4,}")
LEAST_RUN = 20
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST_RUN},}}")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=."
_N = len(ALPHABET)
_INDEX = np.full(128, 0, dtype=np.int64)
_INDEX[[ord(c) for c in ALPHABET]] = np.arange(_N)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, in order; kinds by their place in KINDS."""
    found = []
    low = text.lower()
    if any(part in low for part in KEY_PARTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    for run in LONG_RUN.finditer(text):
        at = run.span()
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text, *at) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text, *at)]
    return sorted(found)


def _overlaps(start: int, end: int, spans: list[tuple[int, int, int]]) -> bool:
    return any(s < end and start < e for s, _, e in spans)


def _left(start: int, end: int, covered: list[list[int]], at: int) -> list[tuple[int, int]]:
    """The pieces of ``LEAST_RUN`` characters or more that ``covered`` from ``at`` on leaves of a run."""
    made = []
    while at < len(covered) and covered[at][0] < end:
        made.append((start, covered[at][0]))
        start = covered[at][1]
        at += 1
    return [(a, b) for a, b in [*made, (start, end)] if b - a >= LEAST_RUN]


def _covered(spans: list[tuple[int, int, int]]) -> list[list[int]]:
    """What the spans, in order of their starts, cover: places that do not overlap."""
    made: list[list[int]] = []
    for start, _, end in spans:
        if made and start <= made[-1][1]:
            made[-1][1] = max(made[-1][1], end)
        else:
            made.append([start, end])
    return made


def _steps(run: str) -> np.ndarray:
    """Transitions of a run as numbers; row ``_N`` stands for the start."""
    at = _INDEX[np.frombuffer(run.encode(), dtype=np.uint8)]
    return np.concatenate([[_N], at[:-1]]) * _N + at


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_docs: int = 5_000
) -> np.ndarray:
    """The log-likelihood ratio random : ordinary of each transition, as a flat table."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = sampled(own.filter(F.col("text").isNotNull()), max_docs, "id", "text")

    def count(batches):
        seen = np.zeros((2, (_N + 1) * _N), dtype=np.int64)
        for batch in batches:
            for value in batch.column(0):
                text = value.as_py() or ""
                spans = base_spans(text)
                for start, kind, end in spans:
                    value_run = re.search(r"[A-Za-z0-9+/_.=-]+$", text[start:end])[0]
                    if len(value_run) >= 16 or kind:
                        np.add.at(seen[1], _steps(value_run), 1)
                plain = [
                    m[0] for m in IDENTIFIER.finditer(text) if not _overlaps(*m.span(), spans)
                ]
                if plain:
                    steps = np.concatenate([_steps(run) for run in plain])
                    seen[0] += np.bincount(steps, minlength=seen.shape[1])
        kind, step = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind.astype(np.int32)), pa.array(step.astype(np.int32)), pa.array(seen[kind, step])],
            ["kind", "step", "n"],
        )

    counted = mapped(sample.select("text"), count, "kind int, step int, n long")
    rows = counted.groupBy("kind", "step").agg(F.sum("n").alias("n")).toPandas()
    return ratio(rows)


def ratio(rows: pd.DataFrame, weight: float = 5.0) -> np.ndarray:
    """Log-likelihood ratios from counts.

    A character's chance after another one is smoothed by ``weight`` times its chance
    anywhere in the class, and that by half a character of each kind.
    """
    seen = np.zeros((2, _N + 1, _N))
    seen.reshape(2, -1)[rows["kind"].to_numpy(int), rows["step"].to_numpy(int)] += rows["n"].to_numpy(float)
    anywhere = seen.sum(axis=1, keepdims=True) + 0.5
    anywhere /= anywhere.sum(axis=2, keepdims=True)
    chance = np.log((seen + weight * anywhere) / (seen.sum(axis=2, keepdims=True) + weight))
    return (chance[1] - chance[0]).reshape(-1)


def text_spans(text: str, model: np.ndarray, threshold: float) -> list[tuple[int, int, int, float]]:
    """``(start, kind, end, score)`` of all spans, by start and kind."""
    base = base_spans(text)
    found = [(s, k, e, 1.0) for s, k, e in base]
    covered, at = _covered(base), 0
    for m in CANDIDATE.finditer(text):
        while at < len(covered) and covered[at][1] <= m.start():
            at += 1
        for start, end in _left(*m.span(), covered, at):
            score = float(model[_steps(text[start:end])].mean())
            if score >= threshold:
                found.append((start, 3, end, score))
    return sorted(found)


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
)
THRESHOLD = 0.75


def scan(
    docs: DataFrame,
    model: np.ndarray,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: the id and ``spans`` (code points, end exclusive)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            spans = [
                [dict(kind=KINDS[k], start=s, end=e, score=x) for s, k, e, x in
                 text_spans(value.as_py() or "", model, threshold)]
                for value in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, _SPANS)], [id_col, "spans"]
            )

    return mapped(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, spans {SPANS}")


def redact(
    docs: DataFrame,
    model: np.ndarray,
    threshold: float = THRESHOLD,
    text_col: str = "text",
    mark: str = "[secret]",
) -> DataFrame:
    """All columns, with every span of the text replaced by ``mark``; NULL stays NULL."""
    place = docs.columns.index(text_col)

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        made, at = [], 0
        for start, _, end, _ in text_spans(text, model, threshold):
            if end > at:
                made += [text[at:start], mark] if start >= at else []
                at = end
        return "".join([*made, text[at:]])

    def run(batches):
        for batch in batches:
            columns = list(batch.columns)
            columns[place] = pa.array([clean(v.as_py()) for v in columns[place]], pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return mapped(docs, run, docs.schema)


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end`` with commas between."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def query(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scan(docs, train(docs))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return found.select(
        "doc_id", number("assign").alias("n_assign"), number("access").alias("n_access"),
        number("hex").alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )

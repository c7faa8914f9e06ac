"""Held-out accuracy, the best path against all paths, and edge rows."""

import random
from itertools import product
from zlib import crc32

import numpy as np
import pytest

from tickengine.llm import language_id as l


@pytest.mark.parametrize("seed", range(6))
def test_best_path_is_the_best_of_all(seed):
    draw = np.random.default_rng(seed)
    counts = [3, 0, 6, 1, 4]
    text = np.repeat(np.arange(len(counts)), counts)
    scores = draw.normal(0, 3, (len(text), 3)).astype(np.float32)
    path = l.best_path(scores, text, len(counts), 2.0)
    for number, n in enumerate(counts):
        own, got = scores[text == number], path[text == number]

        def value(way):
            changes = sum(a != b for a, b in zip(way, way[1:]))
            return sum(float(own[i, w]) for i, w in enumerate(way)) - 2.0 * changes

        best = max((value(w) for w in product(range(3), repeat=n)), default=0)
        assert value(tuple(got)) == pytest.approx(best, abs=1e-4)


ENGLISH, RUSSIAN, GREEK = "the and that with have this", "это как так его что для", "και του την από στο για"


@pytest.fixture(scope="module")
def trained(spark):
    pick = random.Random(1)
    rows = [(i, " ".join(pick.choices(words.split(), k=30)), lang) for i, (words, lang) in
            enumerate([(ENGLISH, "en"), (RUSSIAN, "ru"), (GREEK, "el"), ("das und nicht eine der mit", "de")] * 20)]
    rows += [(99, None, "en"), (98, "", "ru"), (97, "unlabelled", None)]
    return l.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_scripts_narrow_candidates(trained):
    number = {name: i for i, (name, _) in enumerate(l.SCRIPTS, 1)}
    uses = {s: {trained.languages[i] for i in np.flatnonzero(trained.uses[number[s]])} for s in number}
    assert uses["latin"] == {"en", "de"} and uses["cyrillic"] == {"ru"} and uses["greek"] == {"el"}
    assert uses["han"] == set()


def test_spans_of_mixed_texts(docs_of, trained):
    mixed = f"  {ENGLISH} {ENGLISH}, {RUSSIAN} {RUSSIAN}! {ENGLISH}"
    found = l.identify(docs_of([(1, mixed)]), trained).first()
    spans = [(mixed[s["start"] : s["end"]], s["lang"]) for s in found["spans"]]
    assert spans == [(f"{ENGLISH} {ENGLISH}", "en"), (f"{RUSSIAN} {RUSSIAN}", "ru"), (ENGLISH, "en")]
    assert found["lang_pred"] == "en"
    letters = [len(x.replace(" ", "")) for x, _ in spans]
    assert found["score"] == pytest.approx((letters[0] + letters[2]) / sum(letters))


def test_edge_rows(docs_of, trained):
    long_ = (GREEK + " ") * 20_000
    rows = [(1, None), (2, ""), (3, "12 !? \n"), (None, ENGLISH), (4, "漢字かな"), (5, long_), (6, RUSSIAN), (6, RUSSIAN)]
    found = l.identify(docs_of(rows), trained).collect()
    assert len(found) == len(rows)
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found}
    assert by == {1: ("und", 0), 2: ("und", 0), 3: ("und", 0), None: ("en", 1), 4: ("de", 0), 5: ("el", 1), 6: ("ru", 1)}


def test_without_training_rows(docs_of):
    model = l.train(docs_of([(1, "no label")]))
    assert [r["lang_pred"] for r in l.identify(docs_of([(1, "abc"), (2, None)]), model).collect()] == ["und"] * 2


def test_empty_table(docs_of, trained):
    assert l.identify(docs_of([]), trained).count() == 0
    assert l.keep_identified(docs_of([]), trained, 0.5).count() == 0


def test_held_out_accuracy(spark, sf_dir, rows_of):
    truth = dict(rows_of("documents", "doc_id, lang"))
    texts = dict(rows_of("documents", "doc_id, text"))
    found = l.query(spark, sf_dir).collect()
    assert len(found) == len(truth)
    for row in found:
        assert row["held_out"] == (crc32(str(row["doc_id"]).encode()) % 4 == 2)
        assert 0 <= row["score"] <= 1
        assert (row["lang_pred"] == "und") == (not any(map(str.isalpha, texts[row["doc_id"]] or "")))
    held = [r for r in found if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) >= 0.95

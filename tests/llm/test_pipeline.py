"""Every stage against what its operator must do, and the whole over edge rows."""

import corpus_pipeline as p

from tickengine.llm import decontaminate, minhash, secrets
from tickengine.llm.bpe import Codec, vocabulary


def leaked(text, items, least=0.8):
    """Whether a window of an item's size is similar to it, by comparing all windows."""
    words = decontaminate.lower_words(text)[0]
    own = set(decontaminate.weighted(words, decontaminate.SIZE))
    for item in items:
        asked = decontaminate.lower_words(item)[0]
        if not asked:
            continue
        shingles = decontaminate.weighted(asked, min(len(asked), decontaminate.SIZE))
        if len(asked) < decontaminate.SIZE:
            if any(words[i : i + len(asked)] == asked for i in range(len(words))):
                return True
        elif sum(n for s, n in shingles.items() if s in own) >= least * sum(shingles.values()):
            for at in range(max(1, len(words) - len(asked) + 1)):
                window = decontaminate.weighted(words[at : at + len(asked)], decontaminate.SIZE)
                if decontaminate.similarity(window, shingles) >= least:
                    return True
    return False


def test_stages_and_their_columns(spark, sf_dir, rows_of):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = docs.columns
    n = docs.count()
    for name, stage in p.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).toPandas(), docs.schema)
        after = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        assert docs.columns == given and set(after) <= set(before)
        if name == "language ID":
            assert len(after) >= 0.97 * n
        if name == "near copies":
            sets = {i: minhash.shingle_set(t, 5) for i, t in after.items()}
            for i, a in sets.items():
                for j, b in sets.items():
                    assert i >= j or not a or 100 * len(a & b) < 80 * len(a | b)
            gone = {i: minhash.shingle_set(t, 5) for i, t in before.items() if i not in after}
            every = {i: minhash.shingle_set(t, 5) for i, t in before.items()}
            for i, a in gone.items():
                assert any(j != i and 100 * len(a & b) >= 80 * len(a | b) for j, b in every.items())
        if name == "benchmark leaks":
            items = [t for _, t in rows_of("benchmark", "item_id, text")]
            leaks = {i for i, text in before.items() if leaked(text, items)}
            assert leaks and set(after) == set(before) - leaks
        if name == "secrets":
            assert set(after) == set(before)
            for i, text in before.items():
                assert not secrets.base_spans(after[i])
                # What stands around the replaced spans is as it was, in its order.
                kept, at = (after[i] or "").split("[secret]"), 0
                for part in kept:
                    assert (text or "").find(part, at) >= 0
                    at = text.find(part, at) + len(part) if part else at
                assert (len(kept) > 1) >= bool(secrets.base_spans(text))
    codec = Codec(vocabulary())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    made = p.encode(spark, docs, sf_dir).collect()
    assert {r["doc_id"]: r["ids"] for r in made} == {i: list(codec.encode(t)) for i, t in texts.items()}


def test_edge_rows(spark, docs_of, prose, sf_dir):
    text = prose(80, 1)
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 34", None), (4, text, "en"), (4, text, "en"), (None, text, None),
            (5, prose(30_000, 2), "en"), (6, prose(40, 3) + " password: hunter22", "en")]
    docs = docs_of(rows)
    names = docs.columns
    for _, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == names
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(left) == {4, 5, 6} and docs.count() == 3
    assert left[6].endswith(" [secret]")
    assert p.encode(spark, docs, sf_dir).count() == 3


def test_empty_table(spark, docs_of, sf_dir):
    docs = docs_of([])
    for _, stage in p.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_run(spark, sf_dir):
    made = p.run(spark, sf_dir)
    assert made.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert made.count() > 0
    assert 4 <= len(p.STAGES) <= 5

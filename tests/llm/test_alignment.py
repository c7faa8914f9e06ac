"""Token groups and links against a walk over both token sequences."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from tickengine.llm import alignment

FILES = alignment.vocabulary_files()


@pytest.fixture(scope="module")
def tok():
    return alignment.Tokenizers(*FILES)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(FILES[0])
    made.encode_special_tokens = True
    return made


def brute(texts, library, tok):
    """Per text: groups as id lists, by cutting at ends that both sides have."""
    made = []
    for text in texts:
        raw = (" " + (text or "")).encode()
        a = library.encode(raw.decode(), add_special_tokens=False).ids if text else []
        b = tok.pieces.encode(text) if text else []
        spelt = [b"".join(t[i] for i in ids) for ids, t in ((a, tok.a_bytes), (b, tok.b_bytes))]
        if not text or spelt != [raw, raw]:
            made.append(([], 0, 0))
            continue
        ends = []
        for ids, t in ((a, tok.a_bytes), (b, tok.b_bytes)):
            at, own = 0, []
            for i in ids:
                at += len(t[i])
                own.append(at)
            ends.append(own)
        groups, i, j = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            ga, gb = [], []
            while i < len(a) and ends[0][i] <= cut:
                ga.append(a[i])
                i += 1
            while j < len(b) and ends[1][j] <= cut:
                gb.append(b[j])
                j += 1
            groups.append((ga, gb))
        made.append((groups, len(a), len(b)))
    return made


def expected(ids, texts, library, tok):
    made = brute(texts, library, tok)
    counts = Counter((ga[-1], gb[-1]) for groups, _, _ in made for ga, gb in groups)
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    rows = []
    for key, (groups, n_a, n_b) in zip(ids, made):
        links = [(ga[-1], gb[-1]) for ga, gb in groups]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        rows.append((key, n_a, n_b, len(groups), len(links), sum(counts[x] == top[x[1]] for x in links),
                     sum(counts[x] for x in links),
                     hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(rows, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_whole_table_equals_walk(spark, sf_dir, rows_of, library, tok):
    rows = rows_of("documents", "doc_id, text")
    made = [tuple(r) for r in alignment.query(spark, sf_dir).select(*COLUMNS).collect()]
    assert sorted(made, key=str) == expected([r[0] for r in rows], [r[1] for r in rows], library, tok)


def test_odd_texts(spark, docs_of, prose, library, tok):
    texts = [
        None, "", " ", "   ", "a", "▁x", "<|endoftext|> and <s></s><0x41>", "tab\tand\nline\r\n", "\x00\x7f",
        "日本語のテキスト 🙂🙂 é ﬁne", "x" * 30_000, " " * 30_000 + "end", "ab " * 40_000,
        "ﬁ ½ ａ wide", prose(3_000, 1), prose(3_000, 1),
    ]
    ids = [None, 1, 1, *range(3, len(texts))]
    docs = docs_of(list(zip(ids, texts))).repartition(3)
    made = alignment.alignments(docs, *FILES).selectExpr(
        "id", "n_a", "n_b", "n_groups", "n_groups AS n_links", "n_best", "count_sum", "groups_sha256"
    )
    assert sorted((tuple(r) for r in made.collect()), key=str) == expected(ids, texts, library, tok)


def test_empty_table(spark, docs_of):
    assert alignment.alignments(docs_of([]), *FILES).count() == 0


def test_encoder_equals_library(library, tok, prose):
    texts = [prose(500, 5), "it's we'll DON'T 12345 67\t\t x", "ünï ñandú çà", "  lead", "trail  ", "　\xa0 wide"]
    for text in texts:
        for long in (False, True):
            assert tok.encode_a(text, long) == library.encode(text, add_special_tokens=False).ids


def test_runs_of_blanks_and_letters_are_long():
    raws = [b"a" * 5_000, b"a b", b"x " * 5_000, b"c" + b" " * 5_000 + b"c", b"", b"ab" * 900]
    assert alignment.long_runs(raws, 2_000).tolist() == [True, False, False, True, False, False]


def test_terminals_of_random_tilings():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        a, b = (np.append(np.sort(rng.choice(np.arange(1, n), rng.integers(0, n), False)), n) for _ in range(2))
        label_a, label_b, terminal = alignment.groups_of(a, b)
        common = np.intersect1d(a, b)
        assert b[terminal].tolist() == common.tolist()
        assert b[label_a].tolist() == common[np.searchsorted(common, a)].tolist()
        assert b[label_b].tolist() == common[np.searchsorted(common, b)].tolist()

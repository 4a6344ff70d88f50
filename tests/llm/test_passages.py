"""Removal of passages against counting every window."""

import random
from collections import Counter

import numpy as np
import pytest

from riskstream.llm import passages

CHANCE = random.Random(11)


def brute_force(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((len(w), len(gone), b" ".join(kept).decode()))
    return out


def prose(n, vocabulary=5000):
    return [f"w{CHANCE.randrange(vocabulary)}" for _ in range(n)]


def corpus():
    shared = [prose(n) for n in (34, 35, 36, 50, 90, 200)]
    texts = ["", None, " \n", "one", " ".join(prose(34)), "the " * 40, "the " * 34, "a b " * 60, "x" * 5000, "The the " * 30]
    for n in range(60):
        parts = [prose(CHANCE.randrange(60)), CHANCE.choice(shared), prose(CHANCE.randrange(60))]
        if n % 3 == 0:
            part = CHANCE.choice(shared)
            parts += [part[CHANCE.randrange(30) :], prose(3), CHANCE.choice(shared)[: CHANCE.randrange(20, 90)]]
        texts.append(CHANCE.choice([" ", "  ", "\n"]).join(w for p in parts for w in p))
    texts += [" ".join(prose(80))] * 3
    own = prose(40)
    texts.append(" ".join(own + prose(5) + own))
    texts.append(" ".join(prose(3000, 3)))
    return texts


def check(spark, documents, window):
    texts = corpus()
    docs = documents(texts, ("key", "own", "at", "windows", "spans", "k1", "wanted", "n"))
    rows = passages.remove_passages(docs, ["doc_id"], window).collect()
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in rows}
    assert found == dict(enumerate(brute_force(texts, window)))


@pytest.mark.parametrize("window", [35, 20, 8, 3])
def test_against_all_windows(spark, documents, window):
    check(spark, documents, window)


def test_hot_anchors_give_the_same(spark, documents, monkeypatch):
    monkeypatch.setattr(passages, "HOT", 2)
    monkeypatch.setattr(passages, "HOT_SHARE", 10**9)
    monkeypatch.setattr(passages, "CHUNK", 5)
    check(spark, documents, 35)


def test_repeated_rows_and_untouched_texts(spark, documents):
    text = " ".join(prose(50))
    docs = documents([(1, text), (1, text), (2, "a  b\nc"), (None, "d"), (None, None)])
    rows = passages.remove_passages(docs, ["doc_id"], joined=False).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept_text) for r in rows) == [
        (0, 0, 0, ""), (0, 1, 0, "d"), (1, 50, 50, ""), (1, 50, 50, ""), (2, 3, 0, "a  b\nc"),
    ]
    assert passages.remove_passages(docs.limit(0), ["doc_id"]).count() == 0


def test_phrases_are_located_wherever_they_lie():
    a, b = [f"a{i}" for i in range(12)], [f"b{i}" for i in range(12)]
    rows = [(1, 1, 1, " ".join(a).encode()), (1, 2, 1, " ".join(a[:8] + b).encode()), (2, 3, 2, " ".join(b).encode()), (3, 4, 1, " ".join(b[3:]).encode())]
    found = list(passages.locate(rows, 5))
    assert found == [(1, 1, 0, 8), (1, 2, 0, 20), (2, 3, 0, 12)] or found == [(1, 1, 0, 8), (1, 2, 0, 8), (1, 2, 8, 20), (2, 3, 0, 12)]


def test_two_characters_for_a_word(spark, documents, monkeypatch):
    monkeypatch.setattr(passages, "ONE_CHARACTER", 0)
    check(spark, documents, 8)
    words = " ".join(map(str, range(100_000)))
    assert passages._spelled([words.encode()])[1] == 2
    assert list(passages.locate([(1, 1, 2, words.encode())], 35)) == [(1, 1, 0, 100_000)]


def test_more_words_than_fit_below_the_surrogates():
    words = [str(i) for i in range(60_000)]
    text = " ".join(words).encode()
    assert list(passages.locate([(1, 1, 2, text)], 35)) == [(1, 1, 0, 60_000)]
    assert np.uint64(int(passages._BASE) * int(passages._INVERSE) % (1 << 64)) == 1


def test_more_words_than_places(spark, documents, monkeypatch):
    monkeypatch.setattr(passages, "PLACE_BITS", 6)
    check(spark, documents, 35)

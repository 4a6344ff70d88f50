"""Suffix arrays against sorting, and removal of bytes against counting every window."""

import random
from collections import Counter
from itertools import groupby

import numpy as np
import pyarrow as pa
import pytest

from riskstream.llm import suffixes

CHANCE = random.Random(17)


def words(n, letters=4):
    return " ".join("".join(CHANCE.choice("abcdé"[:letters]) for _ in range(CHANCE.randrange(1, 6))) for _ in range(n))


BODIES = [b"", b"a", b"banana", b"a" * 300, b"ab" * 100, b"\x00\x00\xff\x00" * 9, b"abc" * 40 + b"abd" * 40, bytes(range(256)) + bytes(range(255, -1, -1)), b"ba" + b"a" * 50, *(words(200, n).encode() for n in (1, 2, 3, 5))]


@pytest.mark.parametrize("body", BODIES)
def test_all_suffixes_in_order(body):
    got = suffixes.suffix_array(np.frombuffer(body, np.uint8), np.ones(len(body), bool), max(len(body), 1))
    assert got.tolist() == sorted(range(len(body)), key=lambda at: body[at:])


@pytest.mark.parametrize("body", BODIES)
@pytest.mark.parametrize("depth", [1, 3, 20])
def test_wanted_suffixes_to_a_depth(body, depth):
    wanted = np.array([CHANCE.random() < 0.5 for _ in body], bool)
    got = suffixes.suffix_array(np.frombuffer(body, np.uint8), wanted, depth).tolist()
    assert sorted(got) == np.flatnonzero(wanted).tolist()
    inside = [body[at : at + depth] for at in got if at + depth <= len(body)]
    assert inside == sorted(inside)


@pytest.mark.parametrize("body", BODIES)
def test_only_suffixes_smaller_than_their_successors_are_sorted(body, monkeypatch):
    seen, direct = [], suffixes._sorted_directly
    monkeypatch.setattr(suffixes, "_sorted_directly", lambda places, *rest: seen.extend(places.tolist()) or direct(places, *rest))
    suffixes.suffix_array(np.frombuffer(body, np.uint8), np.ones(len(body), bool), 20)
    assert seen == [at for at in range(len(body)) if body[at:] < body[at + 1 :]]


@pytest.mark.parametrize("body", BODIES)
def test_common_prefixes(body):
    data = np.frombuffer(body, np.uint8)
    order = suffixes.suffix_array(data, np.ones(len(body), bool), max(len(body), 1))

    def common(a, b):
        n = 0
        while n < 37 and max(a, b) + n < len(body) and body[a + n] == body[b + n]:
            n += 1
        return n

    assert suffixes.common_prefixes(data, order, 37).tolist() == [common(a, b) for a, b in zip(order.tolist(), order[1:].tolist())]


@pytest.mark.parametrize("window", [3, 16, 40])
def test_recurring_windows(window):
    bodies = list({words(CHANCE.randrange(20, 60), 3).encode() for _ in range(30)} | {b"x" * 90, b"ab" * 60})
    held = [(CHANCE.choice([1, 1, 2]), body) for body in bodies if len(body) >= window]
    seen = Counter()
    for n, body in held:
        for at in range(len(body) - window + 1):
            seen[body[at : at + window]] += n
    for (_, body), found in zip(held, suffixes.recurring(held, window)):
        assert found.tolist() == [seen[body[at : at + window]] > 1 for at in range(len(body) - window + 1)]


def brute_force(texts, window):
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(body[i : i + window] for body in bodies for i in range(len(body) - window + 1))
    out = []
    for body in bodies:
        gone = bytearray(len(body))
        for i in range(len(body) - window + 1):
            if seen[body[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        spans, at = [], 0
        for removed, run in groupby(gone):
            n = len(list(run))
            if removed:
                spans.append((at, at + n))
            at += n
        out.append((len(body), sum(gone), spans, bytes(b for b, g in zip(body, gone) if not g)))
    return out


def corpus(window):
    shared = [words(n, 5) for n in (40, 50, 60, 90, 200)]
    line = words(30, 5)[: window - 2]
    texts = ["", None, "é" * 10, "x" * (window - 1), "x" * window, "y" * 3 * window, "ab" * window, "日本" * window]
    for _ in range(40):
        parts = [words(CHANCE.randrange(60), 5), CHANCE.choice(shared), words(CHANCE.randrange(60), 5), line, words(9, 5)]
        if CHANCE.random() < 0.4:
            parts += [CHANCE.choice(shared)[CHANCE.randrange(40) :], CHANCE.choice(shared)[: CHANCE.randrange(30, 300)]]
        texts.append("".join(parts))
    texts += [words(100, 5)] * 3
    return texts


NAMES = ("row", "k1", "k2", "key", "own", "at", "windows", "n", "spans", "kept", "n_bytes", "wanted", "since")


def result(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in df.collect())


@pytest.mark.parametrize("window", [200, 64, 8])
@pytest.mark.parametrize("hot", [suffixes.HOT, 1])
def test_against_all_windows(spark, documents, window, hot):
    texts = corpus(window)
    got = suffixes.remove_recurring(documents(texts, NAMES), ["doc_id"], window, hot=hot)
    assert result(got) == [(i, *row) for i, row in enumerate(brute_force(texts, window))]


def test_repeated_rows_and_null_ids(spark, documents):
    texts = corpus(64)
    docs = documents([(7, words(50, 5))] * 2 + [(None, texts[10]), (8, texts[11])], NAMES)
    got = {(r.doc_id, r.n_bytes - r.n_removed) for r in suffixes.remove_recurring(docs, ["doc_id"], 64).collect()}
    assert (7, 0) in got and len(got) == 3


def test_pieces_of_long_texts(monkeypatch, spark, documents):
    long, window = words(3000, 5), 50
    data = pa.array(["short", long, None, "tail " * 30])
    want = {(t, at) for t, body in enumerate(data.to_pylist()) for at in range(len((body or "").encode()) - window + 1)}
    for size in (60, 1000, 1 << 20):
        got = []
        for first, piece, offsets, base in suffixes._pieces(data, window, size):
            for at in suffixes.Stretches._inside(offsets, len(piece), window).tolist():
                local = int(np.searchsorted(offsets, at, "right")) - 1
                got.append((first + local, at - int(offsets[local]) + base))
        assert len(got) == len(want) and set(got) == want


def test_equal_windows_have_equal_anchors():
    passage = words(80, 5).encode()
    found = []
    for before in (b"", b"zz", words(40, 5).encode()):
        data = np.frombuffer(before + passage, np.uint8)
        stretches = suffixes.Stretches(data, np.array([0, len(data)]), 16, 64)
        anchors = np.repeat(stretches.anchor, stretches.windows)
        found.append(anchors[len(before) :].tolist())
    assert found[0] == found[1] == found[2]


def test_nothing(spark, documents):
    assert suffixes.remove_recurring(documents([]), ["doc_id"]).count() == 0


def test_a_kept_name_gives_way(spark, documents):
    out = suffixes.remove_recurring(documents(["abc"], NAMES), ["doc_id", "row", "k1", "spans", "kept", "text"])
    assert out.columns == ["doc_id", "row", "k1", "text", "n_bytes", "n_removed", "spans", "kept"]
    assert tuple(out.first())[:6] == (0, "row", "k1", "abc", 3, 0)

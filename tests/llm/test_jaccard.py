"""The join against all pairs, and what signatures must never miss."""

import random

import numpy as np
import pyarrow as pa
import pytest

from riskstream.llm import jaccard
from riskstream.llm.components import components
from riskstream.llm.words import U64, Words, runs

CHANCE = random.Random(3)


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if len(words) >= n:
        return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def brute_force(rows, similarity):
    sets = [shingles(t, similarity.words) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and similarity.similar(len(a & b), len(a) + len(b)):
                up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return [(doc, len(s), least[root(i)]) for i, ((doc, _), s) in enumerate(zip(rows, sets))]


def changed(words, n):
    words = list(words)
    for _ in range(n):
        words[CHANCE.randrange(len(words))] = f"w{CHANCE.randrange(10_000)}"
    return words


def corpus():
    texts = ["", None, " \t\n", "one", "One", "one two", "a b c d", "A  b\nc d", "a b c d e", "the " * 200, "the " * 300, " x y"]
    for size in (8, 12, 20, 45, 120, 400):
        for _ in range(4):
            base = [f"w{CHANCE.randrange(10_000)}" for _ in range(size)]
            for k in range(8):
                texts.append(" ".join(changed(base, CHANCE.randrange(1 + size // 12 * (k % 3)) if k % 3 else 0)))
            texts.append(" ".join(base + changed(base, size // 2)[: size // 9]))
    return [(i * 7 % 1009, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("words", "share"), [(4, (85, 100)), (5, (4, 5)), (1, (1, 2))])
def test_against_all_pairs(spark, documents, words, share):
    similarity, rows = jaccard.Similarity(words, share), corpus()
    docs = documents(rows + rows[:20], ("key", "signature", "member", "centre", "set_key", "n"))
    found = jaccard.similar_documents(docs, similarity, ["doc_id"]).collect()
    want = brute_force(rows, similarity)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(want + want[:20])


def test_blocks_find_the_same(spark, documents, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    rows = corpus()
    found = jaccard.similar_documents(documents(rows), jaccard.Similarity(), ["doc_id"]).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(brute_force(rows, jaccard.Similarity()))


@pytest.mark.parametrize("share", [(85, 100), (4, 5), (1, 2)])
def test_similar_sets_share_a_signature(share):
    similarity, chance = jaccard.Similarity(4, share), np.random.default_rng(1)
    for size in [1, 2, 3, 5, 6, 7, 8, 11, 13, 20, 40, 60, 100, 300]:
        for _ in range(30):
            a = np.unique(chance.integers(0, 1 << 63, size).astype(U64))
            most = similarity.differences(2 * len(a))
            gone = chance.integers(0, most + 1)
            b = np.unique(np.concatenate([a[gone:], chance.integers(0, 1 << 63, chance.integers(0, most + 1)).astype(U64)]))
            common = len(np.intersect1d(a, b))
            if len(b) and common < len(np.union1d(a, b)) and similarity.similar(common, len(a) + len(b)):
                assert np.intersect1d(jaccard.signatures(a, similarity), jaccard.signatures(b, similarity)).size


def test_crowded_groups_still_share_a_signature():
    """Sets whose hashes all fall into few parts run out of groups, and meet all the same."""
    similarity = jaccard.Similarity(4, (85, 100))
    a = np.arange(40).astype(U64) + (U64(7) << U64(40))
    b = a[1:]
    assert np.intersect1d(jaccard.signatures(a, similarity), jaccard.signatures(b, similarity)).size


def test_empty_table(spark, documents):
    assert jaccard.similar_documents(documents([(1, "a")]).limit(0), jaccard.Similarity(), ["doc_id"]).count() == 0


def test_components(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (102, 103), (200, 200)] + [(300, 301 + i) for i in range(50)]
    CHANCE.shuffle(pairs)
    links = spark.createDataFrame(pairs, "a long, b long")
    found = {r.node: r.component for r in components(links).collect()}
    assert {found[i] for i in range(61)} == {0} and {found[i] for i in range(100, 104)} == {100}
    assert {found[i] for i in range(300, 351)} == {300} and 200 not in found
    assert components(links.limit(0)).count() == 0


def test_words_of_a_batch():
    texts = ["a b", None, "", "  lead", "trail ", "x y é\tz\x0bq\x1cr", "w" * 500 + " " + "w" * 499, "ab", "a b"]
    words = Words(pa.array(["skipped", *texts]).slice(1))
    data = words.data.tobytes()
    got = [[data[words.start[k] : words.end[k]] for k in range(*words.first[i : i + 2])] for i in range(len(texts))]
    assert got == [(t or "").encode().split() for t in texts]
    hashes, flat = words.hashes(), [w for t in got for w in t]
    assert all((a == b) == (x == y) for a, x in zip(flat, hashes) for b, y in zip(flat, hashes))
    assert len(runs(hashes, 3)) == len(flat) - 2 and len(runs(hashes[:2], 3)) == 0
    assert len(Words(pa.array([], pa.string()))) == 0


@pytest.mark.parametrize("block", [jaccard.BLOCK, 3])
def test_all_links(spark, documents, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = corpus()
    rows += [(2000 + i, t) for i, (_, t) in enumerate(rows[:60])]
    sets = [shingles(t, 5) for _, t in rows]
    linked = [[bool(a and b) and jaccard.Similarity().similar(len(a & b), len(a) + len(b)) for b in sets] for a in sets]
    want = sorted((doc, sum(row) - row[i]) for i, ((doc, _), row) in enumerate(zip(rows, linked)))
    found = jaccard.similar_documents(documents(rows), jaccard.Similarity(), ["doc_id"], links=True)
    assert sorted((r.doc_id, r.n_links) for r in found.collect()) == want and max(n for _, n in want) > 5
    distinct = set(sets) - {frozenset()}
    pairs = jaccard.similar_pairs(documents(rows), jaccard.Similarity()).collect()
    alike = sum(jaccard.Similarity().similar(len(a & b), len(a) + len(b)) for a in distinct for b in distinct if a != b) // 2
    assert len({frozenset(p) for p in pairs}) == len(pairs) == alike

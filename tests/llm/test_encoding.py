"""Byte-level BPE against the libraries that define it, on texts that are awkward to cut."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from riskstream.llm import counts, encode
from riskstream.llm.pretokens import pretokens

CHANCE = random.Random(5)
WORDS = "the a token’s Übung naïve 12345 don't we'll  \n\n\t … 日本語 🙂🙂 <|endoftext|> x".split(" ")
LONG = " ".join(CHANCE.choice(WORDS) for _ in range(4000))
TEXTS = [
    "", None, " ", "\n\n  x", "a", "it's we'll don't", "  two  spaces ", "Übung 日本語 🙂", "x" * 3000, " " * 3000, "ab" * 40 + "\t" * 30,
    LONG, LONG, "<|endoftext|>a<|endoftext|><|endoftext|> b", "\x1c\x1d՘࢏", "the " * 2000, "5" * 2500, "\n" * 700 + "y",
]


@pytest.fixture(scope="module")
def reference():
    lines = map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))
    ranks = {base64.b64decode(a): int(b) for a, b in lines}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize(("chunk", "overlap"), [(1 << 16, 1 << 10), (1000, 100), (64, 16), (7, 3)])
def test_ids_and_round_trip(spark, documents, reference, chunk, overlap):
    vocabulary = encode.public_vocabulary("byte_bpe_50k.tiktoken")
    texts = TEXTS if chunk > 10 else [t[:300] if t else t for t in TEXTS]
    docs = documents(texts, ("ids", "chunk", "last", "key"))
    rows = encode.encode(docs, vocabulary, ["doc_id"], chunk=chunk, overlap=overlap)
    found = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows.collect()}
    assert found == {i: reference.encode_ordinary(t or "") for i, t in enumerate(texts)}
    back = {r.doc_id: r.decoded.decode() for r in encode.decode(rows, vocabulary, ["doc_id"]).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}
    digests = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode.digests(docs, vocabulary, ["doc_id"], chunk=chunk, overlap=overlap).collect()}
    sha = lambda data: hashlib.sha256(data).hexdigest()
    assert digests == {i: (len(x), sha(np.array(x, "<u4").tobytes()), sha(back[i].encode())) for i, x in found.items()}


def test_a_broken_seam_leaves_the_rest_in_pieces(spark, documents, reference, monkeypatch):
    """A run of letters over two seams is one piece with what it takes to stitch; all other chunks stay pieces of their own."""
    text = " ".join(CHANCE.choice(WORDS) for _ in range(12000))
    text = text[:4900] + "q" * 1500 + text[4900:30000] + "z" * 300 + text[30000:]
    pieces, whole = [], encode._substrings
    monkeypatch.setattr(encode, "_substrings", lambda rows, since, until, name: pieces.append((name, whole(rows, since, until, name))) or pieces[-1][1])
    rows = encode.encode(documents([text]), encode.public_vocabulary("byte_bpe_50k.tiktoken"), ["doc_id"], chunk=1000, overlap=100)
    assert np.frombuffer(rows.first().ids, "<u4").tolist() == reference.encode_ordinary(text)
    sizes = sorted(r[0] for r in [found for name, found in pieces if name == "piece"][-1].selectExpr("length(piece)").collect())
    assert len(sizes) > 50 and sizes[-1] < 4000 and sizes[-3] < 1300


def test_kept_columns_of_any_name(spark, documents):
    docs = documents([(1, "a b"), (2, LONG)], ("ids", "key", "__row", "__text", "decoded", "n_tokens", "at", "piece"))
    keep = [c for c in docs.columns if c != "n_chars"]
    vocabulary = encode.public_vocabulary("byte_bpe_50k.tiktoken")
    rows = encode.encode(docs, vocabulary, keep, chunk=500, overlap=50, decoded=True)
    assert rows.columns == [*(c for c in keep if c not in ("ids", "decoded")), "ids", "decoded"]
    assert [(r.doc_id, r.key, r.at, r.text == bytes(r.decoded).decode()) for r in rows.orderBy("doc_id").collect()] == [(1, "key", "at", True), (2, "key", "at", True)]
    found = encode.digests(docs, vocabulary, keep, chunk=500, overlap=50)
    assert found.columns == [*(c for c in keep if c != "n_tokens"), "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {r.ids for r in found.collect()} == {"ids"}


def test_repeated_rows_and_empty_table(spark, documents):
    vocabulary = encode.public_vocabulary("byte_bpe_50k.tiktoken")
    docs = documents([(1, LONG), (1, LONG), (2, "a"), (2, "a"), (None, "b")])
    rows = encode.encode(docs, vocabulary, ["doc_id"], chunk=500, overlap=50).collect()
    assert sorted((r.doc_id or 0, len(r.ids) > 100) for r in rows) == [(0, False), (1, True), (1, True), (2, False), (2, False)]
    assert encode.digests(documents([(1, "x")]).limit(0), vocabulary, ["doc_id"]).count() == 0


@pytest.mark.parametrize("stretch", [1, 5, 50])
def test_pretokens_in_stretches(stretch):
    find = regex.compile(P.PATTERN).findall
    for text in filter(None, TEXTS[:11] + [LONG[:2000]]):
        assert [x for some in pretokens(find, text, stretch) for x in some] == find(text)


def test_counts(spark, documents):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = [len(library.encode(t or "", add_special_tokens=False).ids) for t in TEXTS]
    rows = counts.token_counts(documents(TEXTS, ("n_bytes_", "key", "score", "__texts")), counts.public_merges("byte_bpe_50k.json"), ["doc_id"])
    found = {r.doc_id: (r.n_bytes, r.n_tokens) for r in rows.collect()}
    assert found == {i: (len((t or "").encode()), n) for i, (t, n) in enumerate(zip(TEXTS, want))}
    merges = counts.public_merges("byte_bpe_50k.json")
    assert counts.token_counts(documents([(1, "a")]).limit(0), merges, ["doc_id"]).count() == 0
    assert [r.n_tokens for r in counts.token_counts(documents([(3, "aa"), (3, "aa")]), merges, ["doc_id"]).collect()] == [1, 1]


def test_merging_random_bytes():
    """The heap against merging the lowest-ranked, leftmost pair again and again."""
    merges = counts.public_merges("byte_bpe_50k.json")
    counter = counts.Counter(merges.content, merges.pattern)
    for n in range(300):
        word = "".join(CHANCE.choice("aehinorst") for _ in range(n % 40))
        symbols = [counter.first[b] for b in word.encode()]
        while True:
            pairs = [(counter.merged[a << 20 | b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a << 20 | b in counter.merged]
            if not pairs:
                break
            (_, symbol), at = min(pairs)
            symbols[at : at + 2] = [symbol]
        assert counter.merge(word) == len(symbols)

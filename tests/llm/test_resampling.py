"""Importance resampling against sorting all scores."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskstream.llm import resampling
from riskstream.session import stored

CHANCE = random.Random(5)
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def runs(text, longest=1):
    words = WORD.findall((text or "").encode().translate(LOWER))
    return [b" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute_force(docs, target, share=(10, 100), least=20, longest=1, buckets=10_000, seed=2024):
    bucket = lambda x: zlib.crc32(x) % buckets
    own, wanted = (Counter(bucket(x) for t in texts for x in runs(t, longest)) for texts in ([t for _, t in docs], target))
    all_own, all_wanted = sum(own.values()) + buckets, sum(wanted.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * all_own / ((own[b] + 1) * all_wanted)))
    out = []
    for i, t in docs:
        weight = sum(gain(bucket(x)) for x in runs(t, longest))
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(runs(t, longest)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(runs(t))))
    able = sorted((o for o in out if o[4] >= least), key=lambda o: (-o[3], o[0] is None, o[0] or 0))
    drawn = len(able) * share[0] // share[1]
    rank = {id(o): n for n, o in enumerate(able[:drawn], 1)}
    return sorted((repr((*o[:4], rank.get(id(o)))) for o in out))


def prose(n, vocabulary=300):
    return CHANCE.choice([" ", "  ", "\n", ", "]).join(f"{CHANCE.choice(['w', 'É', 'the', 'X9'])}{CHANCE.randrange(vocabulary)}" for _ in range(n))


def texts():
    out = ["", None, " ,.;[]{}", "one", "x" * 3000, "the " * 25, "É" * 40, "a\x00b\x7fc`d{e " * 9, "日本語 " * 30, "A-b_C3" * 10]
    return out + [prose(CHANCE.randrange(60)) for _ in range(150)] + [prose(4000)]


NAMES = ("row", "id", "noise", "down", "row_number", "score", "weight", "rank", "n_words", "n_features", "text_crc32")


def check(spark, documents, docs, target, keep=("doc_id",), **settings):
    df = documents([(i, t) for i, t in docs], NAMES)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(df, wanted, list(keep), **settings).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(repr(tuple(r)) for r in got) == brute_force(docs, target, **settings)


def test_against_sorting(spark, documents):
    check(spark, documents, list(enumerate(texts())), texts()[-40:])


@pytest.mark.parametrize("settings", [{"longest": 3, "buckets": 97, "least": 5}, {"share": (1, 1), "least": 0}, {"share": (0, 100)}, {"share": (1, 3), "seed": 7, "longest": 2}])
def test_other_settings(spark, documents, settings):
    check(spark, documents, list(enumerate(texts())), texts()[-40:], **settings)


def test_ties_nulls_and_repeated_rows(spark, documents):
    docs = [(i, "the " * 25) for i in range(40)] + [(7, "the " * 25)] * 30 + [(None, "the " * 25)] * 5 + [(None, None)]
    check(spark, documents, docs, ["the", None, ""], share=(1, 2))
    check(spark, documents, docs, [], share=(1, 2))


def test_nothing(spark, documents):
    check(spark, documents, [], ["a"])
    check(spark, documents, [(1, "one two")], ["one"])


def test_a_kept_name_gives_way(spark, documents):
    df = documents([(1, "one two")], NAMES)
    out = resampling.resample(df, df, ["doc_id", "row", "id", "noise", "down", "score", "rank", "text"])
    assert out.columns == ["doc_id", "row", "id", "noise", "down", "text", "n_features", "weight", "score", "rank"]
    assert tuple(out.first())[:7] == (1, "row", "id", "noise", "down", "one two", 2)


@pytest.mark.parametrize("longest", [1, 2, 4])
@pytest.mark.parametrize("size", [7, 64, 1000])
def test_pieces_of_long_texts(longest, size):
    held = pa.array(texts())
    found = Counter()
    for which, bucket, _ in resampling.features(held, longest, 1 << 20, size):
        found.update(zip(which.tolist(), bucket.tolist()))
    want = Counter((i, zlib.crc32(x) % (1 << 20)) for i, t in enumerate(held.to_pylist()) for x in runs(t, longest))
    assert found == want


@pytest.mark.parametrize("nth", [1, 2, 17, 500, 999, 1000])
def test_cutoff(spark, nth):
    # few values of the first column, so that the others decide; one value fills a third
    keys = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 7).alias("down"), (F.col("id") % 11).alias("id"), F.col("id").alias("row"))
    keys = stored(keys.repartition(9, "row").sortWithinPartitions("down"), "keys")
    ordered = sorted(map(tuple, keys.collect()))
    assert resampling.cutoff(keys, nth) == ordered[nth - 1]


def test_a_round_discards_a_quarter():
    rng = np.random.default_rng(1)
    for _ in range(200):
        parts = [np.sort(rng.integers(0, 1000, rng.integers(1, 50))) for _ in range(rng.integers(1, 12))]
        pivot = resampling.weighted_median([(int(p[(len(p) - 1) // 2]),) for p in parts], [len(p) for p in parts])[0]
        left = np.concatenate(parts)
        assert (left <= pivot).sum() >= len(left) / 4 and (left >= pivot).sum() >= len(left) / 4


def test_ranks_follow_the_order_over_partitions(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = spark.range(5000).select((-F.col("id") % 50).alias("down"), "id", F.col("id").alias("row"))
    got = resampling.ranked(rows, ("down", "id", "row")).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 5001))
    assert [(r.down, r.id) for r in got] == sorted((r.down, r.id) for r in got)

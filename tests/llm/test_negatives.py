"""Hard negatives against scoring every pair."""

import random

import pytest

from riskstream.llm.negatives import MOST, NEGATIVE, POSITIVE, Mining, hard_negatives, mined, packed, unpacked

CHANCE = random.Random(3)
SCHEMA = "vec_id long, label int, embedding array<double>, score string, rank string, dim string, id string, key string"


def brute_force(rows, anchors, mining):
    import math

    alive = {}
    for i, label, v in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            v = [math.floor(256 * x) for x in v]
            alive[i] = min(alive.get(i, (label, v)), (label, v))
    out = []
    for a in sorted(set(anchors) & alive.keys()):
        label, v = alive[a]
        scored = sorted((-max(-MOST, min(MOST, sum(x * y for x, y in zip(v, w)))), i, other) for i, (other, w) in alive.items() if i != a and len(w) == len(v))
        for p, positive, _ in [s for s in scored if s[2] == label][: mining.positives]:
            inside = [(n, -s) for s, n, other in scored if other != label and mining.low * -p <= 100 * -s <= mining.high * -p]
            out += [(a, positive, rank, n, -p, s) for rank, (n, s) in enumerate(inside[: mining.negatives], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*row, "a", "b", "c", "d", "e") for row in rows], SCHEMA).repartition(3)


def check(spark, rows, mining=Mining(), every=5, block=7):
    df = frame(spark, rows)
    got = hard_negatives(df, df.where(f"vec_id % {every} = 0"), mining, block=block)
    assert sorted(map(tuple, got.collect())) == brute_force(rows, [r[0] for r in rows if r[0] is not None and r[0] % every == 0], mining)


def vectors(n, dim=4, labels=3):
    return [(i, CHANCE.randrange(labels), [CHANCE.uniform(-1, 1) for _ in range(dim)]) for i in range(n)]


def test_all_pairs(spark):
    check(spark, vectors(120))
    check(spark, vectors(90), Mining(2, 1, 0, 100), every=3, block=1000)


def test_ties_and_hot_labels(spark):
    rows = [(i, int(i % 9 == 0), [1.0, 0.5]) for i in range(40)] + [(100 + i, 2, [0.6, 0.5]) for i in range(30)]
    rows += [(200 + i, 1, [0.0, 0.0]) for i in range(5)] + [(300 + i, 0, [-1.0, -0.5]) for i in range(8)]
    check(spark, rows)


def test_rows_that_take_no_part(spark):
    rows = vectors(40) + [(50, None, [1.0] * 4), (55, 1, None), (60, 1, [1.0, None, 0.0, 0.0]), (65, 1, [float("nan")] * 4), (70, 1, [float("inf")] * 4), (None, 1, [1.0] * 4), (75, 1, [])]
    rows += [(80, 1, [1.0, 1.0]), (81, 1, [1.0, 0.9]), (82, 2, [0.7, 0.7])]  # another dimension
    rows += [rows[0], (5, 2, [0.3, 0.2, 0.1, 0.9]), (90, 9, [0.5] * 4)]  # repeated ids, and one alone in its label
    check(spark, rows)


def test_large_components(spark):
    check(spark, [(i, i % 2, [CHANCE.uniform(-1, 1) * 10.0 ** CHANCE.choice([0, 9, 40]) for _ in range(3)]) for i in range(40)])


def test_nothing(spark):
    df = frame(spark, vectors(3)).limit(0)
    assert hard_negatives(df, df).count() == 0
    df = frame(spark, vectors(9))
    assert hard_negatives(df, df.limit(0)).count() == 0


def test_keys_sort_by_anchor_and_descending_score():
    pairs = [(CHANCE.choice([-(1 << 63), -5, 0, 7, MOST]), CHANCE.choice([-MOST, -3, 0, 9, MOST]), CHANCE.choice([0, 1]), CHANCE.randrange(-9, 9)) for _ in range(300)]
    assert [unpacked(k) for k in sorted(packed(*p) for p in pairs)] == sorted(pairs, key=lambda p: (p[0], -p[1], *p[2:]))


def test_only_open_windows_are_held():
    def stream():
        yield 0, 1000, POSITIVE, 1
        for n in range(100_000):
            yield 0, 940 - n % 2, NEGATIVE, n

    assert [m[3] for m in mined(stream(), Mining())] == [0, 1, 2]


@pytest.mark.parametrize("positive", [-100, -1, 0, 1, 2, 99, 100, 20001])
def test_windows(positive):
    least, most = Mining().window(positive)
    assert [s for s in range(-300, 21000) if 50 * positive <= 100 * s <= 95 * positive] == list(range(least, most + 1))

"""Quantiles by rank against brute force."""

import numpy as np
import pandas as pd
import pytest

from riskstream.operators import quantiles as q
from riskstream.operators.locations import amount_outliers, box_stats, top_location_box
from riskstream.operators.measures import summary

PROBABILITIES = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)


def frame(spark, groups):
    rows = pd.concat(pd.DataFrame({"g": g, "amount": np.asarray(v, dtype=float)}) for g, v in groups.items())
    return spark.createDataFrame(rows.sample(frac=1, random_state=1)).repartition(8)


def values(df):
    return {r.g: (r.n, r.low, r.high, *r.quantiles) for r in df.collect()}


def brute_force(groups):
    return {
        g: (len(v), min(v), max(v), *np.quantile(v, PROBABILITIES))
        for g, v in ((g, np.asarray(v, dtype=float)) for g, v in groups.items())
    }


def compare(got, want):
    assert got.keys() == want.keys()
    for group in want:
        np.testing.assert_allclose(got[group], want[group], rtol=1e-12)


GROUPS = {
    # One group is most of the table and a third of it is a single value.
    "hot": np.concatenate([np.random.default_rng(1).normal(500, 100, 40_000), np.full(20_000, 510.0)]),
    "ties": [1.0] * 10 + [2.0] * 10,
    "skewed": np.random.default_rng(2).lognormal(3, 2, 5_000),
    "negative": -np.arange(1, 1001.0),
    "one": [7.0],
    "two": [1.0, 2.0],
}


def test_exact(spark):
    got = q.quantiles(frame(spark, GROUPS), ["g"], "amount", PROBABILITIES)
    compare(values(got), brute_force(GROUPS))


def test_missed_brackets_are_noticed(spark):
    """Brackets that hold no value at all: the ranks are found all the same."""
    rows = frame(spark, GROUPS).withColumnRenamed("amount", "v")
    groups = rows.groupBy("g").agg(*q._extremes())
    nowhere = groups.withColumn("brackets", q.F.expr("array_repeat(struct(1e12D AS low, 1e12D AS high, array(1e12D) AS cuts), 6)"))
    missed = q._select(rows, nowhere, ["g"], PROBABILITIES)
    assert missed.where("exists(quantiles, x -> x is null)").count() == len(GROUPS)
    whole = groups.withColumn("brackets", q.F.expr("array_repeat(struct(low, high, array(0D, 1D, 100D, 505D, 510D) AS cuts), 6)"))
    compare(values(q._select(rows, whole, ["g"], PROBABILITIES)), brute_force(GROUPS))


@pytest.mark.parametrize("size", [8, 20])
def test_small_sketches(spark, monkeypatch, size):
    """Sketches far too coarse for their brackets: what they miss is found all the same."""
    monkeypatch.setattr(q, "SKETCH_SIZE", size)
    compare(values(q.quantiles(frame(spark, GROUPS), ["g"], "amount", PROBABILITIES)), brute_force(GROUPS))


@pytest.mark.parametrize("n", [1, 2, 3, 10, 100, 3000])
def test_brackets_hold_their_ranks(spark, monkeypatch, n):
    """Small groups are not looked at twice."""
    rounds, whole = [], q._select
    monkeypatch.setattr(q, "_select", lambda *a: rounds.append(1) or whole(*a))
    groups = {g: np.random.default_rng(g).normal(0, 9, n) for g in range(20)}
    compare(values(q.quantiles(frame(spark, groups), ["g"], "amount", PROBABILITIES)), brute_force(groups))
    assert rounds == [1]


def test_join_without_broadcast(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    got = q.quantiles(frame(spark, GROUPS), ["g"], "amount", PROBABILITIES)
    compare(values(got), brute_force(GROUPS))


def test_two_keys_nulls_and_nan(spark):
    rows = spark.createDataFrame(
        [("a", True, 1.0), ("a", True, float("nan")), ("a", True, None), ("a", False, 3.0),
         ("a", True, 2.0), (None, True, 9.0), ("b", None, 4.0)],
        "location string, is_suspicious boolean, amount double",
    )
    box = {(r.location, r.is_suspicious): (r.transactions, r.median) for r in box_stats(rows).collect()}
    assert box == {("a", True): (2, 1.5), ("a", False): (1, 3.0), ("b", False): (1, 4.0)}


def test_only_bounded_rows_reach_the_last_step(spark, monkeypatch):
    """Between brackets, rows are counted rather than shuffled."""
    rows = frame(spark, {"hot": np.random.default_rng(3).normal(0, 1, 100_000)}).withColumnRenamed("amount", "v")
    seen, whole = [], q._counted
    monkeypatch.setattr(q, "_counted", lambda *a: seen.append(whole(*a)) or seen[-1])
    q.quantiles(rows.withColumnRenamed("v", "amount"), ["g"], "amount", (0.25, 0.5, 0.75))
    (counted,) = seen
    assert counted.agg({"copies": "sum"}).first()[0] == 100_000
    by_slot = {r.slot: r["count"] for r in counted.groupBy("slot").count().collect()}
    assert sum(by_slot.values()) < 3 * 3 * q.MARGIN * 100_000
    assert len(by_slot) > 80 and max(by_slot.values()) < 200, "and no part of a bracket holds many of them"


def test_outliers(spark):
    rows = frame(spark, {"a": [*range(1, 101), 1000.0, -1000.0], "b": [5.0, 5.0, 5.0, 5.0, 6.0]})
    found = sorted((r.g, r.amount) for r in amount_outliers(rows, ["g"]).collect())
    assert found == [("a", -1000.0), ("a", 1000.0), ("b", 6.0)]


def test_approximate(spark):
    got = values(q.quantiles(frame(spark, GROUPS), ["g"], "amount", (0.5,), accuracy=10_000))
    assert got["hot"][3] == pytest.approx(np.median(GROUPS["hot"]), rel=1e-2)


def test_a_summary_of_sketches(spark):
    """Approximate boxes from a summary, without the rows; merged over months and other facets."""
    rows = spark.range(60_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'A' WHEN id % 3 = 1 THEN 'B' END AS location", "id % 2 = 0 AS is_suspicious", "CAST(id % 1000 AS DOUBLE) AS amount",
        "CAST(timestamp_seconds(id * 300) AS TIMESTAMP_NTZ) AS timestamp", "CAST(id % 5 AS STRING) AS status", "'x' AS card_type",
    )
    groups = summary(rows, grain="month", sketch=1024)
    assert groups.count() > 100
    exact = {(r.location, r.is_suspicious): r for r in box_stats(rows).collect()}
    boxes = {(r.location, r.is_suspicious): r for r in box_stats(groups).collect()}
    assert boxes.keys() == exact.keys() and len(boxes) == 4
    for key, box in boxes.items():
        assert (box.transactions, box.min_amount, box.max_amount) == (exact[key].transactions, exact[key].min_amount, exact[key].max_amount)
        assert all(abs(box[c] - exact[key][c]) < 10 for c in ("q1", "median", "q3"))
    assert sorted(r.location for r in top_location_box(groups, 1).collect()) == ["A", "A"]

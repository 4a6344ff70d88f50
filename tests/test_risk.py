"""The risk score: what it may know, what it finds, batch and stream."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from rows import lines, message, stored_rows
from riskstream.operators import patterns, risk
from riskstream.schema import KEY
from riskstream.sources.messages import file_messages
from riskstream.streaming import profiles
from riskstream.streaming.jobs import start_judged

START = datetime(2025, 1, 1, 8)


def planted(n=4000, seed=1):
    """A few customers and one merchant fail often, all others hardly ever."""
    chance = random.Random(seed)
    rows = []
    for i in range(n):
        customer, merchant = 1000 + chance.randrange(40), chance.choice(["A", "B", "C", "bad"])
        fails = 0.02 + 0.5 * (customer < 1005) + 0.3 * (merchant == "bad")
        rows.append({
            "transaction_id": str(i), "customer_id": customer, "merchant": merchant, "amount": float(chance.randrange(100, 5000)),
            "timestamp": START + timedelta(minutes=i * 20), "status": "FAILED" if chance.random() < fails else "SUCCESS",
        })
    return rows


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("planted") / "rows")
    stored_rows(spark, planted()).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


SPLIT = date(2025, 2, 10)


@pytest.fixture(scope="module")
def model(table, tmp_path_factory):
    """Fitted on the early transactions, saved and read again."""
    path = str(tmp_path_factory.mktemp("model") / "m")
    risk.fit(risk.past_features(table).where(F.col("day") < F.lit(SPLIT))).save(path)
    return PipelineModel.load(path)


def late(rows):
    return rows.where(F.col("day") >= F.lit(SPLIT))


def test_it_beats_the_base_rate(table, model):
    scored = risk.score(late(risk.past_features(table)), model).withColumn("label", (F.col("status") == "FAILED").cast("double")).cache()
    assert scored.where("risk < 0 OR risk > 1 OR risk IS NULL").isEmpty()
    area = BinaryClassificationEvaluator(rawPredictionCol="risk").evaluate(scored)
    assert area > 0.75
    base = scored.agg(F.avg("label")).first()[0]
    n = scored.count()
    top = scored.orderBy(F.desc("risk")).limit(n // 10).agg(F.avg("label")).first()[0]
    assert top > 3 * base


def test_only_the_past_counts(spark, table, model):
    """Whatever becomes of later transactions, and of others of the day, a score stays as it is."""
    day = date(2025, 2, 15)
    changed = table.withColumn("status", F.when(F.col("timestamp") < F.lit(day), F.col("status")).otherwise("FAILED"))
    changed = changed.withColumn("merchant", F.when(F.col("timestamp") < F.lit(day) + F.expr("INTERVAL 1 DAY"), F.col("merchant")).otherwise("A"))
    found = [{r[KEY]: r.risk for r in risk.score(risk.past_features(rows).where(F.col("day") == F.lit(day)), model).collect()} for rows in (table, changed)]
    assert len(found[0]) == 72 and found[0] == found[1]


def test_features_of_edge_rows(spark):
    rows = stored_rows(spark, [
        {"transaction_id": "first", "customer_id": 1, "merchant": "M", "amount": 100.0, "timestamp": START},
        {"transaction_id": "same day", "customer_id": 1, "merchant": "M", "status": "FAILED", "timestamp": START + timedelta(hours=1)},
        {"transaction_id": "next", "customer_id": 1, "merchant": None, "amount": 210.0, "timestamp": START + timedelta(days=1)},
        {"transaction_id": "no amount", "customer_id": 1, "merchant": "M", "amount": float("nan"), "timestamp": START + timedelta(days=40)},
        {"transaction_id": "nobody", "customer_id": None, "merchant": "M", "amount": None, "timestamp": START + timedelta(days=40)},
        {"transaction_id": "no time", "customer_id": 1, "timestamp": None},
    ])
    found = {r[KEY]: [name for name in risk.INDICATORS if r[name]] for r in risk.past_features(rows).collect()}
    assert found == {
        "first": ["customer_failures_0", "merchant_failures_0", "customer_count_0", "amount_to_mean_0", "days_since_0"],
        "same day": ["customer_failures_0", "merchant_failures_0", "customer_count_0", "amount_to_mean_0", "days_since_0"],
        "next": ["customer_failures_4", "merchant_failures_0", "customer_count_1", "amount_to_mean_4", "days_since_1"],
        "no amount": ["customer_failures_3", "merchant_failures_4", "customer_count_1", "amount_to_mean_0", "days_since_4"],
        "nobody": ["customer_failures_0", "merchant_failures_4", "customer_count_0", "amount_to_mean_0", "days_since_0"],
    }


def test_one_class_only(spark):
    rows = risk.past_features(stored_rows(spark, [{"transaction_id": str(i)} for i in range(3)]))
    assert {r.risk for r in risk.score(rows, risk.fit(rows)).collect()} == {0.0}


def test_a_hot_customer_is_summed_before_the_shuffle(spark):
    rows = stored_rows(spark, [{}]).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(1000)))).repartition(4)
    totals = risk.daily_totals(rows, "customer_id")
    assert [tuple(r)[2:] for r in totals.collect()] == [(1000, 0, 10_000_000, 1000)]
    assert "partial_count" in totals._jdf.queryExecution().executedPlan().toString()


def deliver(folder, name, rows):
    lines(folder / "in", name, [message(**{**r, "timestamp": r["timestamp"].isoformat()}) for r in rows])


def test_stream_scores_equal_batch_scores(spark, tmp_path, table, model):
    days = [date(2025, 2, 12), date(2025, 2, 13)]
    for day in days:
        profiles.write_profiles(table, str(tmp_path / "profiles"), day)
    # delivered in two files, and not in order
    asked = [r for r in planted() if r["timestamp"].date() in days]
    deliver(tmp_path, "1.json", asked[1::2])
    deliver(tmp_path, "2.json", asked[::2])
    messages = file_messages(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    start_judged(messages, lambda batch: profiles.with_risk(batch, str(tmp_path / "profiles"), model), str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    streamed = {r[KEY]: r.risk for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = risk.score(risk.past_features(table).where(F.col("day").isin(days)), model)
    assert len(streamed) == 144 and streamed == {r[KEY]: r.risk for r in batch.collect()}


def test_a_running_stream_picks_up_newer_profiles(spark, tmp_path):
    nine, night = START + timedelta(hours=1), START + timedelta(hours=18)
    seen = [{"transaction_id": f"d{i}", "customer_id": 1, "timestamp": nine + timedelta(days=i)} for i in range(60)]
    seen += [{"transaction_id": f"n{i}", "customer_id": 1, "timestamp": night + timedelta(days=30 + i)} for i in range(20)]
    known = stored_rows(spark, seen)
    path = str(tmp_path / "profiles")
    profiles.write_profiles(known, path, date(2025, 1, 31), "FAILED")

    def run(name, at):
        deliver(tmp_path, name, [{"transaction_id": name, "customer_id": 1, "timestamp": at}])
        messages = file_messages(spark, str(tmp_path / "in"))
        start_judged(messages, lambda batch: profiles.at_unusual_hours(batch, path, 0.02, 20), str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
        return {r[KEY]: (r.transactions, r.of) for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    assert run("a", night + timedelta(days=60)) == {"a": (0, 30)}
    profiles.write_profiles(known, path, date(2025, 3, 1), "FAILED")
    assert run("b", night + timedelta(days=61)) == {"a": (0, 30)}, "by now the hour is a usual one"
    assert run("c", datetime(2025, 1, 1, 3)) == {"a": (0, 30)}, "before all profiles nothing is known"


def test_hour_profiles(spark):
    rows = stored_rows(spark, [{"customer_id": 1, "timestamp": START}, {"customer_id": 1, "timestamp": START}, {"customer_id": 1, "timestamp": START + timedelta(hours=2)}, {"customer_id": None}, {"customer_id": 2, "timestamp": None}])
    assert [(r.customer_id, r.of, r.hours) for r in patterns.hour_profiles(rows).collect()] == [(1, 3, {8: 2, 10: 1})]

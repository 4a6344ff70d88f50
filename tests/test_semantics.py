"""Edge rows: what the rules do with null, NaN, ties and broken messages."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rows import message, stored_rows
from riskstream.functions import iso_text, parsed_timestamp
from riskstream.operators import breakdown, filters, locations, ranking, trends, upsert, validate
from riskstream.operators.decode import decode, encode, encode_whole, with_flag
from riskstream.operators.sample import monthly_sample


def messages(spark, *values):
    text = [v if v is None or isinstance(v, str) else json.dumps(v) for v in values]
    return spark.createDataFrame([(i, t) for i, t in enumerate(text)], "n int, value string")


def checked(spark, *values):
    """(flag, reason) of each message."""
    rows = validate.with_reason(with_flag(decode(messages(spark, *values)))).orderBy("n").collect()
    return [(r.is_suspicious, r.reason) for r in rows]


@pytest.mark.parametrize(
    ("amount", "flag", "reason"),
    [
        (3000.0, False, None),
        (3000.01, True, None),
        (3001, True, None),
        (None, False, "missing:amount"),
        (float("nan"), False, "missing:amount"),
        (float("inf"), True, None),
        ("4000", False, "missing:amount"),
    ],
)
def test_amounts(spark, amount, flag, reason):
    assert checked(spark, message(amount=amount)) == [(flag, reason)]


@pytest.mark.parametrize(
    ("changes", "reason"),
    [
        ({"customer_id": "x"}, "missing:customer_id"),
        ({"customer_id": 1.5}, "missing:customer_id"),
        ({"transaction_id": 5}, None),
        ({"unknown": {"a": 1}}, None),
        ({"card_type": None}, None),
        ({"timestamp": "bad"}, "unreadable:timestamp"),
        ({"timestamp": "2025-02-30T00:00:00"}, "unreadable:timestamp"),
        ({"timestamp": "2025"}, "unreadable:timestamp"),
        ({"customer_name": "x" * 100}, None),
        ({"customer_name": "x" * 101}, "too_long:customer_name"),
        ({"customer_name": "é" * 100}, None),
        ({"currency": "x" * 11, "status": None}, "missing:status,too_long:currency"),
    ],
)
def test_reasons(spark, changes, reason):
    assert checked(spark, message(**changes))[0][1] == reason


def test_not_an_object(spark):
    everything = ",".join(f"missing:{c}" for c in validate.REQUIRED)
    values = ("not json", "[1, 2]", None, json.dumps([message()]))
    assert checked(spark, *values) == [(False, everything)] * 4
    raw = decode(messages(spark, *values)).orderBy("n").select("raw").collect()
    assert [r.raw for r in raw] == list(values)


def test_partial_message(spark):
    partial = {"transaction_id": "1", "amount": 250, "status": "success"}
    _, reason = checked(spark, partial)[0]
    assert reason.count("missing:") == 6


def test_unknown_field_is_dropped_and_number_becomes_text(spark):
    row = decode(messages(spark, message(transaction_id=5, extra=1))).first()
    assert row.transaction_id == "5" and "extra" not in row


def test_split_is_complete(spark):
    rows = decode(messages(spark, message(), message(amount=None), "junk"))
    accepted, rejected = validate.split(rows)
    assert (accepted.count(), rejected.count()) == (1, 2)
    assert "reason" not in accepted.columns


def test_encode_leaves_out_nulls(spark):
    row = encode(with_flag(decode(messages(spark, message(amount=5000.5, card_type=None))))).first()
    assert row.key == "a"
    assert json.loads(row.value) == message(amount=5000.5, card_type=None) | {"is_suspicious": True}


def test_whole_message_is_forwarded(spark):
    odd = message(amount=5000.5, extra={"b": [1, None, "é"]}, is_suspicious=False) | {"note": None}
    row = encode_whole(with_flag(decode(messages(spark, odd)))).first()
    assert row.key is None and json.loads(row.value) == odd | {"is_suspicious": True}


@pytest.mark.parametrize(
    ("text", "parsed"),
    [
        ("2025-01-02T03:04:05", datetime(2025, 1, 2, 3, 4, 5)),
        ("2025-01-02T03:04:05.000007", datetime(2025, 1, 2, 3, 4, 5, 7)),
        ("2025-01-02", datetime(2025, 1, 2)),
        ("03:04:05", None),
        ("", None),
        (None, None),
    ],
)
def test_timestamps(spark, text, parsed):
    df = spark.createDataFrame([(text,)], "timestamp string")
    assert df.select(parsed_timestamp().alias("t")).first().t == parsed


def test_iso_text_round_trip(spark):
    moments = [datetime(2025, 3, 30, 2, 30), datetime(2024, 2, 29, 23, 59, 59, 999999)]
    df = spark.createDataFrame([(m,) for m in moments], "timestamp timestamp_ntz")
    texts = [r.t for r in df.select(iso_text().alias("t")).collect()]
    assert texts == [m.isoformat() for m in moments]


def test_flag_default(spark):
    rows = stored_rows(spark, [{"is_suspicious": f} for f in (True, False, None)])
    assert [r.is_suspicious for r in filters.with_flag_default(rows).collect()] == [True, False, False]
    assert filters.only_suspicious(rows).count() == 1
    assert breakdown.kpis(rows).first().normal == 2


def test_kpis_of_nothing(spark):
    assert tuple(breakdown.kpis(stored_rows(spark, [])).first()) == (0, 0, 0, 0.0, 0.0)
    split = breakdown.suspicious_split(stored_rows(spark, [])).collect()
    assert [tuple(r) for r in split] == [("suspicious", 0), ("normal", 0)]
    assert trends.volume(stored_rows(spark, [])).count() == 0
    assert trends.average_amount(stored_rows(spark, [])).count() == 0


def test_nan_does_not_spoil_averages(spark):
    rows = stored_rows(spark, [{"amount": 1.0}, {"amount": float("nan")}, {"amount": 2.0}])
    assert breakdown.kpis(rows).first().avg_amount == 1.5
    assert breakdown.avg_amount_by_status(rows).first().avg_amount == 1.5


def test_null_groups_are_left_out(spark):
    rows = stored_rows(spark, [{"card_type": None}, {"card_type": "VISA"}, {"status": None}])
    cards = breakdown.card_type_distribution(rows).collect()
    assert [(r.card_type, r.transactions) for r in cards] == [("VISA", 2)]
    assert breakdown.status_counts(rows).first().transactions == 2


def test_counts_break_ties_by_name(spark):
    rows = stored_rows(spark, [{"status": s} for s in ("B", "A", "C", "C")])
    assert [r.status for r in breakdown.status_counts(rows).collect()] == ["C", "A", "B"]


@pytest.mark.parametrize(
    ("choice", "kept"),
    [
        ({}, 3),
        ({"card_type": ["VISA"]}, 1),
        ({"card_type": ["VISA", None]}, 2),
        ({"card_type": [None]}, 1),
        ({"card_type": []}, 0),
        ({"status": []}, 0),
        ({"status": ["SUCCESS"], "card_type": ["VISA", "AMEX", None]}, 3),
    ],
)
def test_facets(spark, choice, kept):
    rows = stored_rows(spark, [{"card_type": c} for c in ("VISA", "AMEX", None)])
    assert filters.facet_filter(rows, **choice).count() == kept


def test_facet_values_include_missing(spark):
    rows = stored_rows(spark, [{"card_type": c} for c in ("VISA", "VISA", None)])
    values = filters.facet_values(rows).collect()
    assert [(r.facet, r.value) for r in values] == [
        ("card_type", None), ("card_type", "VISA"), ("location", "Town"), ("status", "SUCCESS"),
    ]


def at(*days):
    return [{"timestamp": datetime.fromisoformat(d)} for d in days]


def test_series_fill_gaps(spark):
    rows = stored_rows(spark, at("2024-11-30T23:59:59", "2025-02-01", "2025-02-28") + [{"timestamp": None}])
    months = [tuple(r) for r in trends.volume(rows).collect()]
    assert months == [
        (date(2024, 11, 1), "Nov 2024", 1), (date(2024, 12, 1), "Dec 2024", 0),
        (date(2025, 1, 1), "Jan 2025", 0), (date(2025, 2, 1), "Feb 2025", 2),
    ]
    averages = [r.avg_amount for r in trends.average_amount(rows).collect()]
    assert averages == [100.0, None, None, 100.0]
    days = trends.volume(rows, "day").collect()
    assert len(days) == 91 and sum(r.transactions for r in days) == 3


def test_single_month(spark):
    rows = stored_rows(spark, at("2025-01-31", "2025-01-01"))
    assert [tuple(r) for r in trends.volume(rows).collect()] == [(date(2025, 1, 1), "Jan 2025", 2)]
    with pytest.raises(ValueError, match="grain"):
        trends.volume(rows, "week")


@pytest.mark.parametrize("zone", ["America/Sao_Paulo", "Asia/Kolkata", "UTC"])
def test_session_zone_does_not_matter(spark, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    rows = stored_rows(spark, at("2018-11-04T00:00:00", "2018-10-31T23:59:59"))
    assert [r.month for r in trends.volume(rows).collect()] == [date(2018, 10, 1), date(2018, 11, 1)]


def test_suspicious_by_month_has_no_gaps_filled(spark):
    rows = stored_rows(spark, [r | {"is_suspicious": True} for r in at("2025-01-01", "2025-03-01", "2025-03-02")])
    assert [(r.month_label, r.transactions) for r in trends.suspicious_by_month(rows).collect()] == [
        ("Mar 2025", 2), ("Jan 2025", 1),
    ]


def test_leaderboard_goes_by_total_and_keeps_names_apart(spark):
    def sale(customer, name, amount, **more):
        return {"customer_id": customer, "customer_name": name, "amount": amount, "is_suspicious": True} | more

    rows = stored_rows(spark, [
        sale(1, "Ann", 4000.0), sale(1, "Anna", 9000.0), sale(2, "Bob", 5000.0), sale(2, "Bob", 3500.0),
        sale(3, "Cid", 90000.0, is_suspicious=False), sale(4, None, 99999.0), sale(5, "Eve", float("nan")),
    ])
    board = ranking.suspicious_leaderboard(rows, 3).collect()
    assert [(r.customer_id, r.customer_name, r.suspicious_count) for r in board] == [
        (1, "Anna", 1), (2, "Bob", 2), (1, "Ann", 1),
    ]
    with pytest.raises(ValueError, match="customer_name"):
        ranking.suspicious_leaderboard(rows.drop("customer_name"))


def test_newest_first_breaks_ties_by_id(spark):
    rows = stored_rows(spark, [{"transaction_id": i, "is_suspicious": True} for i in ("9", "10", "2")])
    assert [r.transaction_id for r in ranking.recent_transactions(rows, 2).collect()] == ["10", "9"]
    assert [r.transaction_id for r in ranking.suspicious_preview(rows, 2).collect()] == ["2", "9"]
    assert ranking.latest_suspicious(rows).columns == ["timestamp", "customer_id", "amount", "location"]


def test_top_locations(spark):
    rows = stored_rows(spark, [{"location": x} for x in "aabbcd"] + [{"location": None}] * 3)
    assert [r.location for r in locations.top_locations(rows, 3).collect()] == ["a", "b", "c"]
    assert locations.top_location_rows(rows, 3).count() == 5
    assert locations.top_location_histogram(rows, 3).count() == 3


def test_sample_sizes(spark):
    days = ["2025-01-01"] * 50 + ["2025-02-01"] * 7
    rows = stored_rows(spark, [{"transaction_id": str(i)} | d for i, d in enumerate(at(*days))])

    def ids(seed):
        return {r.transaction_id for r in monthly_sample(rows.repartition(5), seed=seed).collect()}

    assert len(ids(42)) == 37 and ids(42) == ids(42) and ids(42) != ids(43)
    assert monthly_sample(rows, 0).count() == 0


def test_sample_of_copies_and_of_missing_ids(spark):
    """One id may be most of a month, or missing: the size stays exact."""
    copies = [{"transaction_id": "hot"}] * 500 + [{"transaction_id": str(i)} for i in range(40)]
    rows = stored_rows(spark, copies + [{"transaction_id": None} | d for d in at("2025-05-01", "2025-05-02")])
    for size in (1, 30, 200, 1000):
        months = monthly_sample(rows, size).groupBy(F.month("timestamp").alias("m")).count().collect()
        assert {r.m: r["count"] for r in months} == {1: min(size, 540), 5: min(size, 2)}


def test_sample_is_the_head_of_the_hash_order(spark):
    import hashlib

    rows = stored_rows(spark, [{"transaction_id": str(i)} for i in range(3000)])
    ordered = sorted((hashlib.md5(f"{i}:42".encode()).hexdigest(), str(i)) for i in range(3000))
    for size in (1, 7, 30, 300, 2999):
        got = {r.transaction_id for r in monthly_sample(rows, size).collect()}
        assert got == {i for _, i in ordered[:size]}


def test_upsert_rules(spark):
    rows = [
        (2, "k", 10.0, "b", True), (1, "k", 9000.0, None, False), (3, "k", 5.0, "c", None),
        (1, "m", 1.0, "x", True), (1, None, 1.0, "x", True),
    ]
    df = spark.createDataFrame(rows, "o int, transaction_id string, amount double, card_type string, is_suspicious boolean")
    first = {r.transaction_id: tuple(r)[1:] for r in upsert.insert_ignore(df, ("o",)).collect()}
    assert first == {"k": (9000.0, None, False), "m": (1.0, "x", True)}
    last = {r.transaction_id: tuple(r)[1:] for r in upsert.flag_upsert(df, ("o",)).collect()}
    assert last == {"k": (9000.0, None, None), "m": (1.0, "x", True)}


def test_merge_into_table(spark):
    table = stored_rows(spark, [{"transaction_id": "a", "card_type": None}, {"transaction_id": "b"}])
    batch = stored_rows(spark, [
        {"transaction_id": "a", "amount": 7.0, "is_suspicious": True}, {"transaction_id": "c"},
    ])

    def result(merge):
        rows = merge(table, batch).orderBy("transaction_id").collect()
        return [(r.transaction_id, r.amount, r.card_type, r.is_suspicious) for r in rows]

    assert result(upsert.insert_ignore_into) == [
        ("a", 100.0, None, False), ("b", 100.0, "VISA", False), ("c", 100.0, "VISA", False),
    ]
    assert result(upsert.flag_upsert_into) == [
        ("a", 100.0, None, True), ("b", 100.0, "VISA", False), ("c", 100.0, "VISA", False),
    ]
    assert upsert.flag_upsert_into(table, batch).schema.names == table.schema.names


def test_duplicate_ids(spark):
    rows = stored_rows(spark, [{"transaction_id": i} for i in ("a", "b", "a", None, None)])
    assert [tuple(r) for r in validate.duplicate_ids(rows).collect()] == [("a", 2)]

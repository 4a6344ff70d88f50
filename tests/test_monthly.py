"""The merged table by month."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rows import lines, message
from riskstream.operators import breakdown, locations
from riskstream.operators.measures import summary
from riskstream.operators.upsert import RULES, combined, merge_ordered, ordered
from riskstream.schema import STORED_COLUMNS
from riskstream.sources.messages import file_messages
from riskstream.sources.tables import parquet_table
from riskstream.streaming import log, monthly
from riskstream.streaming.jobs import start_store


class Store:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.log, self.table = spark, folder, str(folder / "log"), str(folder / "table")

    def deliver(self, *messages, job="job"):
        source = self.folder / f"in-{job}"
        n = len(list(source.iterdir())) if source.exists() else 0
        lines(source, f"{n}.json", [message(**m) for m in messages])
        start_store(file_messages(self.spark, str(source)), self.log, str(self.folder / job)).awaitTermination()

    def merge(self, rule="flag_upsert", **more):
        return monthly.merge_batches(self.spark, self.log, rule, self.table, **more)

    def rows(self):
        return sorted((r.transaction_id, r.timestamp.month, r.merchant, r.is_suspicious) for r in parquet_table(self.spark, self.table).collect())

    def files(self):
        return {str(f.relative_to(self.folder)): f.stat().st_mtime_ns for top in ("table", "table.keys", "table.summary") for f in (self.folder / top).rglob("*.parquet")}


def at(month):
    return f"2025-{month:02}-10T00:00:00"


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, tmp_path)


def months(files):
    return {part.split("=")[1] for name in files for part in name.split("/") if part.startswith("month=")}


def test_only_the_months_it_touches_are_rewritten(store):
    store.deliver(*({"transaction_id": f"{m}-{n}", "timestamp": at(m)} for m in range(1, 7) for n in range(3)))
    assert store.merge() == [f"2025-0{m}" for m in range(1, 7)]
    before = store.files()
    # new in March, and a later delivery with another time of an id that is in May
    store.deliver({"transaction_id": "new", "timestamp": at(3)}, {"transaction_id": "5-1", "timestamp": at(4), "amount": 9000.0})
    assert store.merge() == ["2025-03", "2025-04", "2025-05"]
    after = store.files()
    kept = {name for name in before if after.get(name) == before[name]}
    assert months(kept) == {"2025-01", "2025-02", "2025-06"} and len(kept) == 9
    assert months(before.keys() - kept) == {"2025-03", "2025-04", "2025-05"}
    assert ("5-1", 5, "Shop", True) in store.rows() and ("new", 3, "Shop", False) in store.rows() and len(store.rows()) == 19
    assert store.merge() == [] and store.files() == after


@pytest.mark.parametrize("rule", sorted(RULES))
def test_steps_equal_the_whole_log(store, spark, rule):
    for n in range(4):
        store.deliver(*({"transaction_id": str((7 * n + k) % 11), "timestamp": at(1 + (n + k) % 5), "merchant": f"{n}-{k}", "amount": 1000.0 * ((n + 3 * k) % 6)} for k in range(9)), job="one" if n % 2 else "two")
        if n != 1:
            store.merge(rule)
    whole = log.current_table(spark, store.log, rule)
    read = parquet_table(spark, store.table)
    assert read.exceptAll(whole).isEmpty() and whole.exceptAll(read).isEmpty()
    assert read.columns == list(STORED_COLUMNS)
    figures = [sorted(map(repr, breakdown.kpis(x).collect())) for x in (read, monthly.merged_summary(spark, store.table))]
    assert figures[0] == figures[1]


def test_the_summary_is_kept_up_without_reading_the_table(store, spark, monkeypatch):
    store.deliver(*({"transaction_id": f"{m}-{n}", "timestamp": at(m), "amount": 100.0 * n} for m in range(1, 4) for n in range(3)))
    store.merge()
    store.deliver({"transaction_id": "1-1", "timestamp": at(1), "amount": 9000.0}, {"transaction_id": "new", "timestamp": at(3), "amount": 1.0})
    read, whole = [], monthly._read
    monkeypatch.setattr(monthly, "_read", lambda spark, path, wanted: read.append(wanted) or whole(spark, path, wanted))
    store.merge()
    assert read == [["2025-01", "2025-03"]], "the months that are rewritten, once"
    kept = monthly.merged_summary(spark, store.table)
    want = summary(parquet_table(spark, store.table))
    assert sorted(map(repr, kept.drop("amount_sketch").collect())) == sorted(map(repr, want.collect()))
    assert breakdown.kpis(kept).first().suspicious == 1
    assert locations.box_stats(kept, ("is_suspicious",)).where("is_suspicious").first().median == 100.0


def test_only_months_that_are_there_are_merged_with(store, spark, monkeypatch):
    """The first rows of a table go to their months without a copy; those of new months aren't grouped again."""
    copies, merges = [], []
    whole_copy, whole_merge = monthly.stored, monthly.merge_ordered
    monkeypatch.setattr(monthly, "stored", lambda df, purpose: copies.append(purpose) or whole_copy(df, purpose))
    monkeypatch.setattr(monthly, "merge_ordered", lambda *arguments: merges.append(1) or whole_merge(*arguments))
    store.deliver(*({"transaction_id": f"{m}-{n}", "timestamp": at(m), "amount": 100.0 * n} for m in (1, 2) for n in range(3)), {"transaction_id": "1-1", "timestamp": at(2), "amount": 9000.0})
    assert store.merge() == ["2025-01", "2025-02"] and (copies, merges) == ([], [])
    assert ("1-1", 1, "Shop", True) in store.rows() and len(store.rows()) == 6
    store.deliver({"transaction_id": "new", "timestamp": at(3)})
    assert store.merge() == ["2025-03"] and (copies, merges) == (["tail"], [])
    store.deliver({"transaction_id": "new", "timestamp": at(3), "amount": 9000.0}, {"transaction_id": "newer", "timestamp": at(4)})
    assert store.merge() == ["2025-03", "2025-04"] and (copies, merges) == (["tail", "tail", "months"], [1])
    assert {("new", 3, "Shop", True), ("newer", 4, "Shop", False)} < set(store.rows()) and len(store.rows()) == 8
    kept = monthly.merged_summary(spark, store.table).drop("amount_sketch")
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, summary(parquet_table(spark, store.table)).collect()))


@pytest.mark.parametrize("step", ["_describe", "hold"])
def test_a_first_merge_that_fails_can_be_run_again(store, spark, monkeypatch, step):
    store.deliver({"transaction_id": "x", "timestamp": at(2)}, {"transaction_id": "y", "timestamp": at(3)})
    module = log if step == "hold" else monthly
    whole = getattr(module, step)

    def fails(*arguments):
        raise OSError("no space left")

    monkeypatch.setattr(module, step, fails)
    with pytest.raises(OSError):
        store.merge()
    monkeypatch.setattr(module, step, whole)
    store.deliver({"transaction_id": "x", "timestamp": at(4), "amount": 9000.0})
    assert store.merge() == ["2025-02", "2025-03"] and store.merge() == []
    assert store.rows() == [("x", 2, "Shop", True), ("y", 3, "Shop", False)]
    assert monthly.merged_summary(spark, store.table).count() == 2


def test_a_batch_that_is_merged_late(store):
    """An earlier job's batch is merged after that of a later one: its row is the first all the same, and moves the id to its month."""
    store.deliver({"transaction_id": "x", "timestamp": at(2), "merchant": "FIRST"}, job="a")
    store.deliver({"transaction_id": "x", "timestamp": at(7), "merchant": "SECOND", "amount": 9000.0}, job="b")
    entries = sorted(log.batches(store.spark, store.log), key=lambda e: log.manifest(store.spark, store.log).where(F.col("job") == e[0]).first().written_at)
    log.hold(store.spark, store.table, {entries[0]})  # as if A's weren't there yet
    assert store.merge() == ["2025-07"] and store.rows() == [("x", 7, "SECOND", True)]
    (store.folder / "table.batches").rename(store.folder / "forgotten")
    assert store.merge() == ["2025-02", "2025-07"]
    assert store.rows() == [("x", 2, "FIRST", True)]
    assert months(store.files()) == {"2025-02"}, "a month without rows is gone"


@pytest.mark.parametrize("step", ["_replace", "_drop_emptied", "hold"])
def test_a_merge_that_fails_can_be_run_again(store, monkeypatch, step):
    store.deliver({"transaction_id": "x", "timestamp": at(2)}, {"transaction_id": "y", "timestamp": at(2)})
    store.merge()
    store.deliver({"transaction_id": "x", "timestamp": at(3), "amount": 9000.0}, {"transaction_id": "z", "timestamp": at(3)})
    module = log if step == "hold" else monthly
    whole, calls = getattr(module, step), []

    def fails(*arguments):
        calls.append(1)
        if step != "_replace" or len(calls) == 2:  # the second replacement is that of the index
            raise OSError("no space left")
        return whole(*arguments)

    monkeypatch.setattr(module, step, fails)
    with pytest.raises(OSError):
        store.merge()
    monkeypatch.setattr(module, step, whole)
    store.merge()
    assert store.rows() == [("x", 2, "Shop", True), ("y", 2, "Shop", False), ("z", 3, "Shop", False)]


def test_an_id_left_in_two_months_is_merged_into_one(store):
    """Replacing the month it moves to succeeded, the one it leaves did not."""
    store.deliver({"transaction_id": "x", "timestamp": at(2), "merchant": "FIRST"}, job="a")
    store.deliver({"transaction_id": "x", "timestamp": at(7), "merchant": "SECOND"}, {"transaction_id": "y", "timestamp": at(7)}, job="b")
    entries = sorted(log.batches(store.spark, store.log), key=lambda e: log.manifest(store.spark, store.log).where(F.col("job") == e[0]).first().written_at)
    log.hold(store.spark, store.table, {entries[0]})
    store.merge()
    saved = store.folder / "saved"
    (store.folder / "table" / "month=2025-07").rename(saved)
    (store.folder / "table.batches").rename(store.folder / "forgotten")
    new = log.reduced(store.spark, store.log, "flag_upsert", {entries[0]})
    monthly._replace(monthly._with_month(new), store.table)
    saved.rename(store.folder / "table" / "month=2025-07")
    assert [r[0] for r in store.rows()] == ["x", "x", "y"]
    store.merge()
    assert store.rows() == [("x", 2, "FIRST", False), ("y", 7, "Shop", False)]


def test_empty_batches(store):
    store.deliver({"transaction_id": "bad", "timestamp": "no time"})
    assert store.merge() == []
    assert len(log.held(store.spark, store.table)) == 1


@pytest.mark.parametrize("rule", sorted(RULES))
def test_merging_is_in_any_order_and_any_number_of_times(spark, rule):
    schema = "transaction_id string, merchant string, is_suspicious boolean, o long"
    rows = spark.createDataFrame([(str(n % 5), f"m{n}" if n % 3 else None, n % 2 == 0, n) for n in range(40)], schema)
    parts = [ordered(rows.where(F.col("o") % 3 == k), rule, ("o",)) for k in range(3)]
    want = sorted(map(repr, ordered(rows, rule, ("o",)).collect()))
    for first, second, third in ((0, 1, 2), (2, 0, 1), (1, 2, 0)):
        out = merge_ordered(merge_ordered(merge_ordered(parts[first], parts[second], rule), parts[third], rule), parts[second], rule)
        assert sorted(map(repr, out.collect())) == want
    assert sorted(map(repr, combined(parts[0].unionByName(parts[1]).unionByName(parts[2]), rule).collect())) == want


def test_new_rows_are_merged_without_shuffling_the_months(spark, store):
    store.deliver(*({"transaction_id": str(n), "timestamp": at(1)} for n in range(50)))
    store.merge()
    batch = log.reduced(spark, store.log, "flag_upsert", log.batches(spark, store.log)).limit(2).cache()
    batch.count()
    plan = merge_ordered(log.merged_table(spark, store.table), batch, "flag_upsert")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2


def test_months_of_distant_times(store):
    assert datetime(2025, 1, 10)  # a month's name sorts like its time
    store.deliver({"transaction_id": "a", "timestamp": "1900-01-01T00:00:00"}, {"transaction_id": "b", "timestamp": "2199-12-31T23:59:59"})
    assert store.merge() == ["1900-01", "2199-12"]

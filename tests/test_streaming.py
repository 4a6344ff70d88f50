"""The jobs: stream equals batch, restarts, replays, routing, sinks."""

import json
import pickle
import random
import sqlite3
import time

import pytest
from pyspark.sql import functions as F

from rows import lines, message
from riskstream.operators import upsert
from riskstream.operators.decode import decode
from riskstream.options import JobOptions
from riskstream.schema import STORED_COLUMNS
from riskstream.sources.fixtures import event_messages
from riskstream.sources.messages import file_messages, kafka_settings
from riskstream.streaming import log
from riskstream.streaming.database import batches_statement, database_writer, merge_statements, staging_name, table_statement
from riskstream.streaming.jobs import run_backfill, run_stream, start_fan_out, start_route, start_store
from riskstream.streaming.metrics import BatchMetrics, read_metrics
from riskstream.streaming.route import flagged_messages

FIRST = [
    message(transaction_id="a", amount=10.0, merchant="old"),
    message(transaction_id="b", amount=5000.0),
    message(transaction_id="a", amount=4000.0, merchant="new"),
    message(transaction_id="c", timestamp="bad", amount=9000.0),
    "junk",
]
SECOND = [message(transaction_id="b", amount=1.0), message(transaction_id="d", card_type=None)]


def store(spark, folder):
    messages = file_messages(spark, str(folder / "in"))
    start_store(messages, str(folder / "log"), str(folder / "checkpoint")).awaitTermination()
    return log.read_log(spark, str(folder / "log"))


def table(rows, rule="flag_upsert"):
    resolved = log.resolved(rows, rule).orderBy("transaction_id").collect()
    return [(r.transaction_id, r.amount, r.merchant, r.is_suspicious) for r in resolved]


def uncommit(checkpoint, batch):
    """As if the job had failed after the batch was written and before its commit."""
    for name in (str(batch), f".{batch}.crc"):
        (checkpoint / "commits" / name).unlink(missing_ok=True)


def test_drops_restarts_and_replays(spark, tmp_path):
    lines(tmp_path / "in", "1.json", FIRST)
    rows = store(spark, tmp_path)
    after_first = [("a", 10.0, "old", True), ("b", 5000.0, "Shop", True)]
    assert table(rows) == after_first
    assert table(rows, "insert_ignore") == [("a", 10.0, "old", False), ("b", 5000.0, "Shop", True)]
    rejected = rows.where("outcome = 'rejected'").select("reason", "raw", "is_suspicious").collect()
    assert {r.reason for r in rejected if r.is_suspicious} == {"unreadable:timestamp"}
    assert "junk" in {r.raw for r in rejected}
    assert rows.where("outcome = 'stored' AND raw IS NOT NULL").isEmpty()

    assert store(spark, tmp_path).count() == 5, "a restart adds nothing"

    lines(tmp_path / "in", "2.json", SECOND)
    rows = store(spark, tmp_path)
    final = [("a", 10.0, "old", True), ("b", 5000.0, "Shop", False), ("d", 100.0, "Shop", False)]
    assert table(rows) == final
    counts = log.batch_counts(rows).orderBy("batch_id").collect()
    assert [tuple(r) for r in counts] == [(0, 5, 3, 2), (1, 2, 0, 0)]

    # Without the commit of the last batch, the batch runs again.
    uncommit(tmp_path / "checkpoint", 1)
    rows = store(spark, tmp_path)
    assert (tmp_path / "checkpoint" / "commits" / "1").exists() and rows.count() == 7 and table(rows) == final


def test_empty_batch(spark, tmp_path):
    """A file without a line makes a batch without a row."""
    lines(tmp_path / "in", "1.json", FIRST)
    store(spark, tmp_path)
    (tmp_path / "in" / "2.json").write_text("")
    assert store(spark, tmp_path).count() == 5
    lines(tmp_path / "in", "3.json", SECOND)
    assert store(spark, tmp_path).count() == 7
    messages = file_messages(spark, str(tmp_path / "in"))
    start_route(messages, str(tmp_path / "out"), str(tmp_path / "other")).awaitTermination()


def test_only_empty_batches(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text("")
    rows = store(spark, tmp_path)
    assert rows.count() == 0 and log.resolved(rows, "flag_upsert").count() == 0


@pytest.mark.parametrize("mode", ["static", "dynamic"])
@pytest.mark.parametrize("outcome", ["stored", "other"])
def test_half_written_batch_is_replaced(spark, tmp_path, conf, mode, outcome):
    conf(spark__sql__sources__partitionOverwriteMode=mode)
    lines(tmp_path / "in", "1.json", FIRST)
    (tmp_path / "checkpoint").mkdir()
    (tmp_path / "checkpoint" / "metadata").write_text('{"id":"0b6f2f7c-58a5-4c6e-9d3e-0d8f6f0f4a11"}')
    job = tmp_path / "log" / "job=0b6f2f7c-58a5-4c6e-9d3e-0d8f6f0f4a11"
    left = job / "batch_id=0" / f"outcome={outcome}"
    left.mkdir(parents=True)
    spark.range(5).selectExpr("'zz' AS transaction_id").write.mode("overwrite").parquet(str(left))
    rows = store(spark, tmp_path)
    assert rows.count() == 5 and rows.where("transaction_id = 'zz'").isEmpty()


def test_stream_equals_batch(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.01"
    stream = event_messages(spark, sf_dir, streaming=True)
    start_store(stream, str(tmp_path / "log"), str(tmp_path / "checkpoint"), JobOptions(threshold=45)).awaitTermination()
    streamed = log.read_log(spark, str(tmp_path / "log")).drop("batch_id", "job", "written_at")
    batch = log.log_rows(event_messages(spark, sf_dir), 45).select(*streamed.columns)
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()
    assert streamed.count() == 10_000


def test_stream_reads_a_folder_of_files(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    stream = event_messages(spark, str(tmp_path), streaming=True)
    start_store(stream, str(tmp_path / "log"), str(tmp_path / "checkpoint")).awaitTermination()
    assert log.read_log(spark, str(tmp_path / "log")).count() == 1000


def test_delivery_order_within_large_files(spark, tmp_path, conf):
    """Position follows the order of lines even when a file is read in pieces."""
    conf(spark__sql__files__maxPartitionBytes="4096")
    lines(tmp_path / "in", "1.json", [message(transaction_id="k", amount=float(i)) for i in range(1000)])
    rows = log.log_rows(file_messages(spark, str(tmp_path / "in"), streaming=False))
    assert rows.rdd.getNumPartitions() > 8
    assert log.resolved(rows, "insert_ignore", ("position",)).first().amount == 0.0
    ordered = [r.amount for r in rows.orderBy("position").collect()]
    assert ordered == sorted(ordered)


def test_route_is_independent_of_validity(spark, tmp_path):
    lines(tmp_path / "in", "1.json", FIRST)
    messages = file_messages(spark, str(tmp_path / "in"))
    start_route(messages, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    routed = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.key for r in routed) == ["a", "b", "c"]
    assert all(json.loads(r.value)["is_suspicious"] is True for r in routed)
    assert {json.loads(r.value)["timestamp"] for r in routed} == {"bad", "2025-01-02T03:04:05"}


def test_route_of_whole_messages(spark, tmp_path):
    lines(tmp_path / "in", "1.json", [message(amount=4000.0, extra=7), "junk", message(amount=1.0)])
    messages = file_messages(spark, str(tmp_path / "in"))
    start_route(messages, str(tmp_path / "out"), str(tmp_path / "checkpoint"), whole=True).awaitTermination()
    routed = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [json.loads(r.value)["extra"] for r in routed] == [7]


@pytest.mark.parametrize("apart", [False, True])
def test_both_outputs_run_until_done(spark, tmp_path, apart):
    lines(tmp_path / "in", "1.json", FIRST)
    run_stream(
        spark, file_messages(spark, str(tmp_path / "in")), writer=str(tmp_path / "log"),
        checkpoint=str(tmp_path / "checkpoint"), route_path=str(tmp_path / "out"), every=None, apart=apart,
    )
    assert log.read_log(spark, str(tmp_path / "log"), "stored").count() == 3
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert not spark.streams.active


@pytest.mark.parametrize("whole", [False, True])
def test_fan_out_reads_the_source_once(spark, tmp_path, whole):
    lines(tmp_path / "in", "1.json", FIRST)
    lines(tmp_path / "in", "2.json", SECOND)
    messages = file_messages(spark, str(tmp_path / "in"), max_files_per_trigger=1)

    def run():
        query = start_fan_out(messages, str(tmp_path / "log"), str(tmp_path / "out"), str(tmp_path / "checkpoint"), whole=whole)
        query.awaitTermination()
        return [p.numInputRows for p in query.recentProgress if p.numInputRows]

    def outputs():
        out = spark.read.parquet(str(tmp_path / "out"))
        return table(log.read_log(spark, str(tmp_path / "log"))), sorted(r.value for r in out.collect())

    assert sorted(run()) == [2, 5], "each message is read once"
    expected = start_store(messages, str(tmp_path / "log2"), str(tmp_path / "checkpoint2")), start_route(messages, str(tmp_path / "out2"), str(tmp_path / "checkpoint3"), whole=whole)
    for query in expected:
        query.awaitTermination()
    found = outputs()
    assert found == (table(log.read_log(spark, str(tmp_path / "log2"))), sorted(r.value for r in spark.read.parquet(str(tmp_path / "out2")).collect()))
    uncommit(tmp_path / "checkpoint", 1)
    run()
    assert outputs() == found, "a replay changes neither output"


@pytest.mark.parametrize("apart", [False, True])
def test_failure_of_one_output_ends_the_job(spark, tmp_path, apart):
    lines(tmp_path / "in", "1.json", FIRST)

    def broken(batch, batch_id):
        raise RuntimeError("no space left")

    with pytest.raises(Exception, match="no space left"):
        run_stream(
            spark, file_messages(spark, str(tmp_path / "in")), writer=broken,
            checkpoint=str(tmp_path / "checkpoint"), route_path=str(tmp_path / "out"), every="1 second", apart=apart,
        )
    assert not spark.streams.active


def test_backfill_replays_without_effect(spark, tmp_path):
    lines(tmp_path / "in", "1.json", FIRST + SECOND)
    messages = file_messages(spark, str(tmp_path / "in"))
    for run in ("one", "two"):
        run_backfill(messages, str(tmp_path / "log"), str(tmp_path / run))
    rows = log.read_log(spark, str(tmp_path / "log"))
    assert rows.count() == 14, "both deliveries are in the log"
    assert len(log.batches(spark, str(tmp_path / "log"))) == 2
    assert table(rows, "insert_ignore") == [
        ("a", 10.0, "old", False), ("b", 5000.0, "Shop", True), ("d", 100.0, "Shop", False),
    ]


@pytest.mark.parametrize("rule", sorted(upsert.RULES))
def test_compaction_in_steps_equals_whole_log(spark, tmp_path, rule):
    chance = random.Random(7)
    for n in range(4):
        drop = [
            message(transaction_id=str(chance.randrange(12)), amount=float(chance.randrange(6000)),
                    card_type=chance.choice(["VISA", None]))
            for _ in range(30)
        ]
        lines(tmp_path / "in", f"{n}.json", drop)
        rows = store(spark, tmp_path)
    path = str(tmp_path / "log")
    whole = log.resolved(rows, rule)
    base = log.compact(spark, path, rule, str(tmp_path / "t1"), through_batch=1)
    assert 0 < base.count() <= whole.count()
    merged = log.compact(
        spark, path, rule, str(tmp_path / "t3"), base_path=str(tmp_path / "t1"), through_batch=3,
    )
    assert merged.exceptAll(whole).isEmpty() and whole.exceptAll(merged).isEmpty()
    read = log.current_table(spark, path, rule, base_path=str(tmp_path / "t1"))
    assert read.exceptAll(whole).isEmpty() and whole.exceptAll(read).isEmpty()
    # What a table holds may leave the log; nothing is merged twice.
    assert sorted(n for _, n in log.held(spark, str(tmp_path / "t1"))) == [0, 1]
    expected = sorted(map(repr, whole.collect()))
    assert log.prune(spark, path, str(tmp_path / "t1")) == 2
    read = log.current_table(spark, path, rule, base_path=str(tmp_path / "t1"))
    assert sorted(map(repr, read.collect())) == expected
    again = log.compact(spark, path, rule, str(tmp_path / "t4"), base_path=str(tmp_path / "t3"))
    assert sorted(map(repr, again.collect())) == expected
    assert len(log.held(spark, str(tmp_path / "t4"))) == 4


@pytest.mark.parametrize("seed", range(4))
def test_rules_equal_one_row_after_the_other(spark, seed):
    """The rules against a table that takes one row at a time."""
    chance = random.Random(seed)
    deliveries = [
        (n, chance.choice("abcdefgh"), chance.choice([None, "VISA", "AMEX"]), chance.choice([True, False]))
        for n in range(200)
    ]
    ignored, upserted = {}, {}
    for _, key, card, flag in deliveries:
        ignored.setdefault(key, (card, flag))
        upserted[key] = (upserted[key][0] if key in upserted else card, flag)
    shuffled = chance.sample(deliveries, len(deliveries))
    schema = "o int, transaction_id string, card_type string, is_suspicious boolean"
    df = spark.createDataFrame(shuffled, schema).repartition(7)
    for rule, expected in (("insert_ignore", ignored), ("flag_upsert", upserted)):
        rows = upsert.RULES[rule](df, ("o",)).collect()
        assert {r.transaction_id: (r.card_type, r.is_suspicious) for r in rows} == expected
        # In two steps: a table of the first half, then the rest as a batch.
        halves = [upsert.RULES[rule](df.where(side), ("o",)) for side in ("o < 100", "o >= 100")]
        merged = upsert.MERGES[rule](*halves).collect()
        assert {r.transaction_id: (r.card_type, r.is_suspicious) for r in merged} == expected


def test_a_hot_key_leaves_one_row_per_task(spark):
    """A third of all deliveries have one id; the shuffle carries a row per task and id."""
    rows = spark.range(90_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("transaction_id"),
        F.col("id").alias("o"), F.lit(1.0).alias("amount"), (F.col("id") > 80_000).alias("is_suspicious"),
    )
    out = upsert.flag_upsert(rows, ("o",))
    assert out.count() == 60_001
    hot = out.where("transaction_id = 'hot'").first()
    assert hot.is_suspicious
    assert upsert.insert_ignore(rows, ("o",)).where("transaction_id = 'hot'").first().is_suspicious is False


@pytest.mark.parametrize("rule", sorted(upsert.RULES))
def test_database_writer(spark, tmp_path, rule):
    """A batch is staged whole, then merged by one statement; only the calls are checked here."""
    calls = []

    class Connection:
        def cursor(self):
            return self

        def execute(self, statement):
            calls.append(statement)

        def commit(self):
            calls.append("commit")

        def close(self):
            calls.append("close")

    def stage(rows, name):
        calls.append(name)
        rows.write.mode("overwrite").parquet(str(tmp_path / name))

    writer = database_writer(Connection, stage, "transactions", rule, str(tmp_path / "checkpoint"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.json").write_text("")
    messages = file_messages(spark, str(tmp_path / "in"))
    run_backfill(messages, writer, str(tmp_path / "checkpoint"))
    assert calls == [], "a batch without rows opens no connection"
    lines(tmp_path / "in", "1.json", FIRST)
    run_backfill(messages, writer, str(tmp_path / "checkpoint"))
    job = log.job_id(spark, str(tmp_path / "checkpoint"))
    staging = staging_name("transactions", job, 1)
    assert calls == [
        table_statement("transactions"), batches_statement("transactions"), "commit", "close", staging,
        *merge_statements("transactions", staging, rule, job, 1), "commit", "close",
    ]
    rows = {r.transaction_id: r for r in spark.read.parquet(str(tmp_path / staging)).collect()}
    assert rows.keys() == {"a", "b"}, "one row per id, valid rows only"
    assert rows["a"].merchant == "old"
    assert rows["a"].is_suspicious is (rule == "flag_upsert")


def test_two_jobs_on_one_database(spark, tmp_path):
    """Both stage before either merges; then the first job's batch runs again. In a database file of this process."""
    path = str(tmp_path / "database")

    def staged(rows, name):
        with sqlite3.connect(path) as database:
            database.execute(f"DROP TABLE IF EXISTS {name}")
            database.execute(f"CREATE TABLE {name} ({', '.join(STORED_COLUMNS)})")
            values = [tuple(str(v) if k == "timestamp" else v for k, v in r.asDict().items()) for r in rows.collect()]
            database.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(STORED_COLUMNS))})", values)

    def kept():
        with sqlite3.connect(path) as database:
            names = [row[0] for row in database.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name")]
            return names, database.execute("SELECT transaction_id, merchant, is_suspicious FROM t ORDER BY 1").fetchall()

    drops = {"a": [message(transaction_id="x", merchant="A"), message(transaction_id="y")], "b": [message(transaction_id="x", merchant="B", amount=9000.0), message(transaction_id="z")]}
    for name, drop in drops.items():
        lines(tmp_path / name, "1.json", drop)

    def run(name, stage):
        checkpoint = str(tmp_path / f"checkpoint-{name}")
        writer = database_writer(lambda: sqlite3.connect(path), stage, "t", "flag_upsert", checkpoint)
        run_backfill(file_messages(spark, str(tmp_path / name)), writer, checkpoint)

    def stage_and_let_the_other_run(rows, name):
        staged(rows, name)
        run("b", staged)

    run("a", stage_and_let_the_other_run)
    # A has merged last: all rows are there, the flag is A's
    tables = ["t", "t_batches"]
    assert kept() == (tables, [("x", "B", 0), ("y", "Shop", 0), ("z", "Shop", 0)])
    uncommit(tmp_path / "checkpoint-b", 0)
    run("b", staged)
    assert kept() == (tables, [("x", "B", 0), ("y", "Shop", 0), ("z", "Shop", 0)]), "a replay changes nothing"


def test_table_statement():
    text = table_statement("t")
    assert "transaction_id VARCHAR(50) UNIQUE NOT NULL, timestamp TIMESTAMP NOT NULL" in text
    assert "card_type VARCHAR(20), is_suspicious BOOLEAN DEFAULT FALSE" in text
    assert text.count("NOT NULL") == 9


def test_merge_statements():
    merge, note, drop = merge_statements("t", "s", "insert_ignore", "j", 3)
    assert merge.startswith("INSERT INTO t (transaction_id, ") and " FROM s WHERE NOT EXISTS (" in merge
    assert merge.endswith("ON CONFLICT (transaction_id) DO NOTHING")
    assert merge_statements("t", "s", "flag_upsert", "j", 3)[0].endswith(
        "ON CONFLICT (transaction_id) DO UPDATE SET is_suspicious = EXCLUDED.is_suspicious"
    )
    assert (note, drop) == ("INSERT INTO t_batches VALUES ('j', 3) ON CONFLICT DO NOTHING", "DROP TABLE s")


def test_a_replay_keeps_its_place(spark, tmp_path):
    """A's batch is written, not committed; B writes; A starts again."""
    lines(tmp_path / "a", "1.json", [message(transaction_id="x", merchant="FIRST", amount=100.0)])
    lines(tmp_path / "b", "1.json", [message(transaction_id="x", merchant="SECOND", amount=9999.0)])

    def run(name):
        start_store(file_messages(spark, str(tmp_path / name)), str(tmp_path / "log"), str(tmp_path / f"checkpoint-{name}")).awaitTermination()
        return log.read_log(spark, str(tmp_path / "log"))

    run("a")
    uncommit(tmp_path / "checkpoint-a", 0)
    before = run("b")
    assert table(before) == [("x", 100.0, "FIRST", True)]
    places = sorted(map(repr, before.select("job", "batch_id", "written_at").collect()))
    after = run("a")
    assert (tmp_path / "checkpoint-a" / "commits" / "0").exists()
    assert table(after) == [("x", 100.0, "FIRST", True)]
    assert sorted(map(repr, after.select("job", "batch_id", "written_at").collect())) == places


def test_a_batch_is_never_before_the_one_before(spark, tmp_path):
    """Even if the driver's clock is set back between them."""
    lines(tmp_path / "in", "1.json", FIRST)
    store(spark, tmp_path)
    job = log.job_id(spark, str(tmp_path / "checkpoint"))
    entry = tmp_path / "log" / "_batches" / job / "0.json"
    noted = json.loads(entry.read_text())
    assert noted == {"job": job, "batch_id": 0, "written_at": noted["written_at"], "total": 5, "suspicious": 3, "rejected": 2}
    later = noted["written_at"] + 10**12
    entry.write_text(json.dumps({**noted, "written_at": later}))
    entry.with_name(".0.json.crc").unlink(missing_ok=True)
    lines(tmp_path / "in", "2.json", SECOND)
    store(spark, tmp_path)
    assert [r[0] for r in log.manifest(spark, str(tmp_path / "log")).selectExpr("unix_micros(written_at)").collect()] == [later, later]


def test_a_merge_reads_only_the_batches_it_lacks(spark, tmp_path):
    path = str(tmp_path / "log")
    for n in range(3):
        lines(tmp_path / "in", f"{n}.json", [message(transaction_id=str(n))])
        store(spark, tmp_path)
    log.compact(spark, path, "flag_upsert", str(tmp_path / "t"), through_batch=1)
    wanted = log.lacking(spark, path, str(tmp_path / "t"))
    assert [n for _, n in wanted] == [2]
    read = log.read_batches(spark, path, wanted).inputFiles()
    assert read and all("batch_id=2" in name for name in read)
    assert [tuple(r) for r in log.manifest(spark, path).select("batch_id", "total").orderBy("batch_id").collect()] == [(0, 1), (1, 1), (2, 1)]


def test_a_batch_without_an_entry_is_not_merged(spark, tmp_path):
    lines(tmp_path / "in", "1.json", FIRST)
    store(spark, tmp_path)
    left = tmp_path / "log" / "job=broken" / "batch_id=0" / "outcome=stored"
    left.mkdir(parents=True)
    (left / "part-0.parquet").write_bytes(b"half of a file")
    assert log.current_table(spark, str(tmp_path / "log"), "flag_upsert").count() == 2


def test_jobs_share_a_log(spark, tmp_path):
    """A stream, a backfill and the stream with a new checkpoint fill one log, in this order."""
    lines(tmp_path / "in", "1.json", [message(transaction_id="a"), message(transaction_id="b", amount=4000.0)])
    store(spark, tmp_path)
    lines(tmp_path / "in", "2.json", [message(transaction_id="c")])
    store(spark, tmp_path)
    lines(tmp_path / "other", "1.json", [message(transaction_id="x"), message(transaction_id="b", amount=1.0, merchant="late")])
    messages = file_messages(spark, str(tmp_path / "other"))
    run_backfill(messages, str(tmp_path / "log"), str(tmp_path / "backfill"))
    rows = log.read_log(spark, str(tmp_path / "log"))
    assert [r[0] for r in table(rows)] == ["a", "b", "c", "x"]
    assert table(rows)[1] == ("b", 4000.0, "Shop", False), "the first row, the last flag"
    assert log.batch_counts(rows, ("job", "batch_id")).count() == 3
    # the same input once more, without the old checkpoint: nothing is lost or overwritten
    start_store(file_messages(spark, str(tmp_path / "in")), str(tmp_path / "log"), str(tmp_path / "new")).awaitTermination()
    rows = log.read_log(spark, str(tmp_path / "log"))
    assert rows.count() == 8
    assert table(rows)[1] == ("b", 4000.0, "Shop", True)


@pytest.mark.parametrize("fan_out", [False, True])
def test_a_listener_counts_the_batches(spark, tmp_path, fan_out):
    """Equal to the counts of the log, which isn't read for them; a batch that runs again is counted once."""
    listener = BatchMetrics(spark, str(tmp_path / "metrics"))
    spark.streams.addListener(listener)

    def run():
        messages, checkpoint = file_messages(spark, str(tmp_path / "in")), str(tmp_path / "checkpoint")
        query = start_fan_out(messages, str(tmp_path / "log"), str(tmp_path / "out"), checkpoint) if fan_out else start_store(messages, str(tmp_path / "log"), checkpoint)
        query.awaitTermination()
        return log.read_log(spark, str(tmp_path / "log"))

    try:
        for n, drop in enumerate((FIRST, SECOND)):
            lines(tmp_path / "in", f"{n}.json", drop)
            rows = run()
        uncommit(tmp_path / "checkpoint", 1)
        rows = run()
        want = sorted(tuple(r) for r in log.batch_counts(rows, ("job", "batch_id")).collect())
        for _ in range(100):  # listeners hear of a batch a little later
            found = read_metrics(spark, str(tmp_path / "metrics")).orderBy("batch_id").collect()
            if len(found) == 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert [tuple(r)[:5] for r in found] == want and [r.total for r in found] == [5, 2]


def test_jobs_share_a_route(spark, tmp_path):
    lines(tmp_path / "in", "1.json", FIRST)
    messages = file_messages(spark, str(tmp_path / "in"))
    for checkpoint in ("one", "two"):
        start_route(messages, str(tmp_path / "out"), str(tmp_path / checkpoint)).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6


def test_whole_messages_that_break_rules(spark, tmp_path):
    """Repeated names, a flag of its own, NaN, blanks: forwarded, and read like any other."""
    texts = [
        '{"amount":5000,"amount":6000,"transaction_id":"a"}',
        '{"amount": 7000, "is_suspicious": false, "transaction_id": "b", "extra": NaN}  ',
        '{"transaction_id":"c","merchant":"a } b","amount":8000\t}',
    ]
    lines(tmp_path / "in", "1.json", texts)
    messages = file_messages(spark, str(tmp_path / "in"))
    start_route(messages, str(tmp_path / "out"), str(tmp_path / "routed"), whole=True).awaitTermination()
    routed = sorted((json.loads(r.value) for r in spark.read.parquet(str(tmp_path / "out")).collect()), key=lambda m: m["transaction_id"])
    assert [m["amount"] for m in routed] == [6000, 7000, 8000]
    assert all(m["is_suspicious"] is True for m in routed)
    assert routed[1]["extra"] != routed[1]["extra"] and routed[2]["merchant"] == "a } b"
    assert store(spark, tmp_path).where("outcome = 'rejected'").count() == 3


def test_years_out_of_range(spark, tmp_path):
    lines(tmp_path / "in", "1.json", [
        message(transaction_id=str(i), timestamp=f"{year}-01-02T03:04:05") for i, year in enumerate(("1899", "1900", "2199", "2200", "20250"))
    ])
    rows = store(spark, tmp_path).orderBy("transaction_id").collect()
    assert [r.reason for r in rows] == ["out_of_range:timestamp", None, None, "out_of_range:timestamp", "out_of_range:timestamp"]
    assert [r.timestamp is None for r in rows] == [True, False, False, True, True]


def test_dedup_within_delay(spark, tmp_path):
    lines(tmp_path / "in", "1.json", FIRST)
    lines(tmp_path / "in", "2.json", SECOND)
    messages = file_messages(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    rows = decode(messages).select("*", "position.delivered_at").where("transaction_id IS NOT NULL")
    query = (
        upsert.dedup_within(rows, "1 hour").writeStream.format("memory").queryName("deduplicated")
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r.transaction_id for r in spark.table("deduplicated").collect()) == ["a", "b", "c", "d"]


def test_starting_offsets():
    options = JobOptions(broker="host:1", topic="t", max_offsets_per_trigger=5, min_partitions=64)
    stream = kafka_settings(options, "latest", streaming=True)
    assert stream["startingOffsets"] == "latest" and stream["maxOffsetsPerTrigger"] == "5"
    batch = kafka_settings(options, "earliest", streaming=False)
    assert batch == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "t", "startingOffsets": "earliest",
        "minPartitions": "64",
    }


def test_flagged_rows_equal_routed_rows(spark):
    messages = event_messages(spark, "/root/testdata/sf0.01")
    flagged = log.log_rows(messages, 45).where("is_suspicious").count()
    assert flagged_messages(messages, 45).count() == flagged == 4039

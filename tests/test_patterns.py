"""Unusual behaviour: edge rows, and streams."""

from datetime import datetime, timedelta

from pyspark.sql import Window, functions as F

from rows import stored_rows
from riskstream.operators import patterns
from riskstream.sources.fixtures import transaction_events

SF_DIR = "/root/testdata/sf0.01"
START = datetime(2025, 1, 1, 10)


def sales(spark, *rows):
    return stored_rows(spark, [{"transaction_id": str(i), **row} for i, row in enumerate(rows)])


def test_windows_of_time(spark):
    rows = sales(
        spark, *({"customer_id": 1, "timestamp": START + timedelta(minutes=m)} for m in (0, 59, 60)),
        {"customer_id": None, "timestamp": START}, {"customer_id": 1, "timestamp": None},
    )
    found = [(r.customer_id, r.since, r.until, r.transactions) for r in patterns.frequent(rows, 2).collect()]
    assert found == [(1, START, START + timedelta(hours=1), 2)]
    assert patterns.repeated_failures(rows, 1).count() == 0


def test_a_stream_finds_the_same(spark, tmp_path):
    events = transaction_events(spark, SF_DIR).select("customer_id", "timestamp", "status")
    events.repartition(3).write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "events"))
    found = patterns.repeated_failures(stream, 2, failed="error", watermark="60 days")
    found.writeStream.format("memory").queryName("failures").outputMode("complete").option(
        "checkpointLocation", str(tmp_path / "checkpoint")
    ).trigger(availableNow=True).start().awaitTermination()
    batch = patterns.repeated_failures(events, 2, failed="error")
    assert batch.count() > 0
    assert sorted(map(repr, spark.table("failures").collect())) == sorted(map(repr, batch.collect()))


def test_new_locations(spark):
    rows = sales(
        spark, {"customer_id": 1, "location": "B", "timestamp": START}, {"customer_id": 1, "location": "A", "timestamp": START},
        {"customer_id": 1, "location": "B", "timestamp": START + timedelta(days=1)}, {"customer_id": 1, "location": None},
        {"customer_id": 2, "location": "C"},
    )
    assert [(r.customer_id, r.location, r.nth) for r in patterns.new_locations(rows).collect()] == [(1, "B", 2)]


def test_unusual_hours(spark):
    rows = sales(spark, *({"customer_id": 1, "timestamp": START + timedelta(days=n, hours=9 * (n == 7))} for n in range(60)))
    assert [(r.hour, r.transactions, r.of) for r in patterns.unusual_hours(rows).collect()] == [(19, 1, 60)]
    assert patterns.unusual_hours(rows, seen=61).count() == 0


def test_suspicious_merchants(spark):
    rows = sales(spark, *({"merchant": "A" if n % 2 else "B", "is_suspicious": n % 4 == 1} for n in range(400)), {"merchant": None, "is_suspicious": True})
    assert [tuple(r) for r in patterns.suspicious_merchants(rows).collect()] == [("A", 200, 100)]
    assert patterns.suspicious_merchants(rows, times=2.0).count() == 0
    assert patterns.suspicious_merchants(rows.where(F.lit(False))).count() == 0


def test_bursts_across_the_hour(spark, tmp_path):
    rows = sales(spark, *({"customer_id": 1, "status": "FAILED", "timestamp": START + timedelta(minutes=m)} for m in (58, 59, 61, 180, 240, 299)))
    got = [(r.since, r.until) for r in patterns.failure_bursts(rows, 3).collect()]
    assert got == [(START + timedelta(minutes=58), START + timedelta(minutes=61))]
    assert [r.until for r in patterns.failure_bursts(rows, 2).orderBy("until").collect()] == [START + timedelta(minutes=m) for m in (59, 61, 299)]
    events = transaction_events(spark, SF_DIR).select("customer_id", "timestamp", "status")
    events.repartition(3).write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "events"))
    patterns.bursts(stream, 3, watermark="60 days").writeStream.format("memory").queryName("bursts").option(
        "checkpointLocation", str(tmp_path / "checkpoint")
    ).trigger(availableNow=True).start().awaitTermination()
    batch = patterns.bursts(events, 3)
    assert batch.count() > 0
    assert sorted(map(repr, spark.table("bursts").collect())) == sorted(map(repr, batch.collect()))


class Line:
    """A stream of (customer, location, minutes after the start), a batch for each call."""

    def __init__(self, spark, folder, found):
        self.spark, self.folder, self.found, self.drops = spark, folder, found, 0

    def deliver(self, *rows):
        made = [(c, location, START + timedelta(minutes=m)) for c, location, m in rows]
        drop = self.spark.createDataFrame(made, "customer_id long, location string, timestamp timestamp_ntz")
        drop.coalesce(1).write.parquet(str(self.folder / "in" / f"drop={self.drops}"))
        self.drops += 1
        stream = self.spark.readStream.schema(drop.schema).parquet(str(self.folder / "in" / "drop=*"))
        writer = self.found(stream).writeStream.format("parquet").option("path", str(self.folder / "out"))
        writer.option("checkpointLocation", str(self.folder / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
        return sorted(tuple(r) for r in self.spark.read.parquet(str(self.folder / "out")).collect())

    def state(self):
        return self.spark.read.format("statestore").load(str(self.folder / "checkpoint"))


def minute(m):
    return START + timedelta(minutes=m)


def test_the_state_of_bursts_is_bounded(spark, tmp_path):
    line = Line(spark, tmp_path, lambda rows: patterns.bursts(rows, 4, "1 hour", watermark="1 minute"))
    found = line.deliver(*((7, "A", m / 100) for m in range(5000)), (8, "A", 0), (8, "A", 1))
    assert len(found) == 4997 and found[0] == (7, minute(0), minute(0.03))
    sizes = [r[0] for r in line.state().selectExpr("size(value.groupState.times)").collect()]
    assert sorted(sizes) == [2, 3], "of 5,000 times the last three"
    # a customer's transactions are counted over batches, and one that is late by those before it
    assert (8, minute(0), minute(55)) in line.deliver((8, "A", 55), (8, "A", 52))
    assert len(line.deliver((9, "A", 900))) == 4998
    line.deliver((9, "A", 901))
    assert line.state().count() == 1, "who is long silent is forgotten"


def test_bursts_of_one(spark, tmp_path):
    line = Line(spark, tmp_path, lambda rows: patterns.bursts(rows, 1, watermark="1 minute"))
    assert line.deliver((1, "A", 0), (1, "A", 0)) == [(1, minute(0), minute(0))] * 2


def test_moves(spark):
    rows = sales(
        spark, *({"customer_id": 1, "location": place, "timestamp": minute(m)} for m, place in ((0, "A"), (10, "A"), (59, "B"), (61, "A"), (61, "C"), (500, "C"), (900, "A"))),
        {"customer_id": 1, "location": None, "timestamp": minute(30)}, {"customer_id": 2, "location": "Z", "timestamp": minute(5)}, {"customer_id": None}, {"timestamp": None},
    )
    want = [(1, "A", minute(10), "B", minute(59)), (1, "B", minute(59), "A", minute(61)), (1, "A", minute(61), "C", minute(61)), (1, "C", minute(500), "A", minute(900))]
    for stretch in ("1 second", "1 hour", "9 days"):
        assert sorted(tuple(r) for r in patterns.moves(rows, stretch=stretch).collect()) == sorted(want)
    assert len(patterns.moves(rows, "2 hours").collect()) == 3


def test_moves_of_a_hot_customer_are_split(spark, conf):
    """Two thirds of all rows are one customer's; no task gets them all."""
    conf(spark__sql__shuffle__partitions="32", spark__sql__adaptive__enabled="false")
    rows = spark.range(60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("customer_id"), F.concat(F.lit("L"), F.pmod(F.hash("id"), F.lit(5))).alias("location"),
        F.timestamp_seconds(F.col("id") * 60).alias("timestamp"),
    )
    found = patterns.moves(rows)
    sizes = found.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 0.2 * sum(r["count"] for r in sizes)
    line = Window.partitionBy("customer_id").orderBy("timestamp")
    assert found.count() == rows.withColumn("b", F.lag("location").over(line)).where("b <> location").count()


def test_moves_on_a_stream(spark, tmp_path):
    line = Line(spark, tmp_path, lambda rows: patterns.moves(rows, "2 hours", watermark="1 hour"))
    line.deliver((1, "A", 0), (1, "B", 30), (2, "A", 10))
    found = line.deliver((1, "B", 40), (1, "C", 50), (2, "B", 15), (3, None, 20))
    assert found == [(1, "A", minute(0), "B", minute(30)), (1, "B", minute(40), "C", minute(50)), (2, "A", minute(10), "B", minute(15))]
    line.deliver((3, "A", 900))
    found = line.deliver((1, "X", 901))
    assert len(found) == 3, "too long ago"
    assert sorted(r[0] for r in line.state().selectExpr("value.groupState.location").collect()) == ["A", "X"]

"""What the plans must look like to hold at scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from riskstream.operators import breakdown, upsert
from riskstream.operators.decode import decode, with_flag
from riskstream.operators.filters import only_suspicious
from riskstream.operators.sample import monthly_sample
from riskstream.sources.fixtures import event_messages, transactions
from riskstream.streaming.log import log_rows

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def query_plan(spark, name):
    return plan(entry.queries()[name](spark, SF_DIR))


#: Queries that run streams; what is left of their plans is a scan of what the streams wrote.
STREAMED = {
    "backfill_ingest", "batch_counts", "flag_upsert", "manifest_counts", "merged_by_month", "one_read_fan_out", "replayed_log_upsert", "restarted_stream",
    "shared_log_batches", "shared_log_ignore", "shared_log_upsert", "stream_ingest", "streamed_failure_bursts", "streamed_location_moves",
    "streamed_unusual_hours", "summary_after_batches", "suspicious_route",
}


@pytest.mark.parametrize("name", sorted(entry.CORE - STREAMED))
def test_no_pairs_and_no_python(spark, name):
    text = query_plan(spark, name)
    for bad in ("CartesianProduct", "NestedLoop", "Python", "InPandas"):
        assert bad not in text
    assert "FileScan" in text, "every query reads its tables"


def test_filters_and_columns_reach_the_scan(spark):
    text = query_plan(spark, "suspicious_leaderboard")
    assert "GreaterThan(o_totalprice,300000.0)" in text
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in text


def test_lookups_are_left_out_when_not_needed(spark):
    text = query_plan(spark, "status_counts")
    assert "Join" not in text and "ReadSchema: struct<o_orderstatus:string>" in text
    assert "Join" not in query_plan(spark, "daily_volume")


def test_top_k_and_samples_shrink_before_the_shuffle(spark):
    for name in ("suspicious_leaderboard", "latest_suspicious", "recent_transactions", "top_locations"):
        assert "TakeOrderedAndProject" in query_plan(spark, name)
    text = plan(monthly_sample(transactions(spark, SF_DIR, ("transaction_id", "timestamp", "amount"))))
    assert "WindowGroupLimit" in text and "Partial" in text
    limited, pruned = text.index("Partial"), text.index("length(ltrim(")
    assert text.index("Final") < text.index("Exchange hashpartitioning") < limited < pruned


def test_ranking_precedes_the_lookup(spark, conf):
    """Even where the customers are too many to broadcast, ten rows are not."""
    conf(spark__sql__autoBroadcastJoinThreshold="4000")
    recent = entry.queries()["recent_transactions"](spark, SF_DIR)
    recent.collect()
    final = plan(recent).split("Initial Plan")[0]
    assert final.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in final
    # Ids without a name go before the cut, which takes the ids of the names; the names follow it.
    board = query_plan(spark, "suspicious_leaderboard")
    assert board.rindex("TakeOrderedAndProject") > board.index("BroadcastHashJoin")
    assert "LeftSemi" in board
    assert board.count("ReadSchema: struct<c_custkey:bigint,c_name:string>") == 2


@pytest.mark.parametrize("name", ["location_counts", "top_locations", "top_location_histogram", "location_hotspots"])
def test_orders_are_counted_before_they_are_looked_up(spark, conf, name):
    without_broadcast(conf)
    text = query_plan(spark, name)
    assert text.rindex("partial_sum") > text.index("SortMergeJoin")


def test_customers_are_picked_before_orders_are_looked_up(spark):
    text = query_plan(spark, "top_location_rows")
    assert text.count("FileScan parquet [o_") == 1 and "LeftSemi" in text


def test_small_batches_leave_the_table_in_place(spark, tmp_path):
    from rows import stored_rows

    table, batch = str(tmp_path / "table"), str(tmp_path / "batch")
    stored_rows(spark, [{"transaction_id": str(i)} for i in range(100)]).write.parquet(table)
    stored_rows(spark, [{"transaction_id": str(i)} for i in (5, 200)]).write.parquet(batch)
    merged = upsert.flag_upsert_into(spark.read.parquet(table), spark.read.parquet(batch))
    assert merged.count() == 101
    assert "Exchange hashpartitioning" not in plan(merged)


def test_conflict_rules_combine_before_their_only_shuffle(spark):
    rows = spark.range(10).selectExpr("id AS o", "'k' AS transaction_id", "true AS is_suspicious")
    text = plan(upsert.flag_upsert(rows, ("o",)))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_min_by" in text and "partial_max_by" in text


def test_series_read_the_table_once(spark):
    assert query_plan(spark, "monthly_volume").count("FileScan") == 1
    assert query_plan(spark, "top_location_histogram").count("FileScan parquet [o_") == 1


def test_messages_are_parsed_once(spark):
    rows = only_suspicious(with_flag(decode(event_messages(spark, SF_DIR))))
    assert plan(rows.select("transaction_id", "amount")).count("from_json") == 1


def test_times_are_read_once_a_step(spark):
    """Once for the checks and once for the row, however many conditions look at them."""
    assert plan(log_rows(event_messages(spark, SF_DIR))).count("RLIKE") == 2


def test_places_are_sorted_once(spark):
    """A row goes into the shuffle with the place of its values and that of its flag, no copies."""
    rows = spark.range(10).selectExpr("id AS o", "'k' AS transaction_id", "true AS is_suspicious")
    for rule, places in (("flag_upsert", 2), ("insert_ignore", 1)):
        text = plan(upsert.ordered(rows, rule, ("o",)))
        assert "min_by" not in text and "max_by" not in text
        partial = next(line for line in text.splitlines() if "partial_min" in line)
        assert partial.count("partial_m") == places


def ordered_events(spark, path, rows=400):
    """An events table in the order of its ids."""
    events = spark.range(rows, numPartitions=4).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id) AS ts", "id % 60 AS user_id",
        "element_at(array('view', 'error', 'signup'), int(id % 3) + 1) AS event_type", "double(id % 90) AS value", "concat('{\"k\": ', id % 50, '}') AS props",
    )
    events.write.parquet(f"{path}/events.parquet")
    return str(path)


def test_a_range_of_events_is_dealt_out(spark, conf, tmp_path):
    """The ids of a quarter are next to each other; all tasks work on it all the same, and no other ids are shuffled."""
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    sf_dir = ordered_events(spark, tmp_path)
    quarter = F.col("position.offset").between(100, 199)
    dealt = event_messages(spark, sf_dir, dealt=True).where(quarter)
    whole = event_messages(spark, sf_dir).where(quarter)
    assert sorted(map(repr, dealt.collect())) == sorted(map(repr, whole.collect()))
    tasks = [df.groupBy(F.spark_partition_id()).count().count() for df in (whole, dealt)]
    assert tasks[0] == 1 and tasks[1] >= 6
    below = plan(dealt).split("Exchange")[1]
    assert "GreaterThanOrEqual(event_id,100)" in below


def test_parts_of_a_shared_log_are_written_by_all_tasks(spark, conf, tmp_path, monkeypatch):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    monkeypatch.setattr(entry, "shared_folder", lambda spark, purpose: f"{tmp_path}/{purpose}")
    sf_dir = ordered_events(spark, tmp_path)
    rows = entry.shared_log(spark, sf_dir)
    assert rows.count() == 800
    for n in range(4):
        assert len(list((tmp_path / "shared" / "in" / f"part={n}").glob("*.parquet"))) >= 6


@pytest.fixture
def hot_tables(spark, tmp_path):
    """A third of the orders belong to one customer."""
    orders = spark.range(300_000, numPartitions=8).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.hash("id") % 500 + 500).cast("long").alias("o_custkey"),
        F.lit("F").alias("o_orderstatus"),
        (F.abs(F.hash("id")) % 1_000_000).cast("double").alias("o_totalprice"),
        F.lit("2000-01-01").cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("5-LOW").alias("o_orderpriority"),
    )
    customers = spark.range(1_000).selectExpr(
        "id AS c_custkey", "concat('c', id) AS c_name", "int(id % 25) AS c_nationkey",
        "0D AS c_acctbal", "'X' AS c_mktsegment",
    )
    nations = spark.range(25).selectExpr("int(id) AS n_nationkey", "concat('n', id) AS n_name", "0 AS n_regionkey")
    for name, df in (("orders", orders), ("customer", customers), ("nation", nations)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def without_broadcast(conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
    )


def test_a_hot_customer_is_split(spark, conf, hot_tables):
    expected = entry.suspicious_leaderboard_by_name(spark, hot_tables).collect()
    assert expected[0].customer_name == "c7"
    without_broadcast(conf)
    conf(spark__sql__shuffle__partitions="64")
    board = entry.suspicious_leaderboard_by_name(spark, hot_tables)
    assert board.collect() == expected
    assert "skew=true" in plan(board)


def test_results_do_not_depend_on_the_join_strategy(spark, conf):
    names = ("facet_filter", "top_location_rows", "top_location_box", "amount_outliers", "monthly_sample")
    run = entry.queries()
    expected = {n: sorted(map(repr, run[n](spark, SF_DIR).collect())) for n in names}
    without_broadcast(conf)
    assert {n: sorted(map(repr, run[n](spark, SF_DIR).collect())) for n in names} == expected


def test_kpis_of_the_view_need_no_shuffle_of_rows(spark):
    text = plan(breakdown.kpis(transactions(spark, SF_DIR, ("amount", "is_suspicious"))))
    assert "partial_sum" in text and "Exchange SinglePartition" in text

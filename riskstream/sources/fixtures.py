"""The provided star-schema tables, seen as transactions and as messages."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskstream.functions import iso_text, over_threshold
from riskstream.operators.measures import AMOUNT, AMOUNTS, ROWS, measured
from riskstream.schema import FLAG, KEY, STORED_COLUMNS, WIRE_COLUMNS
from riskstream.session import stored
from riskstream.sources.messages import position

ORDER_THRESHOLD = 300_000.0
EVENT_THRESHOLD = 45.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(
    spark: SparkSession,
    sf_dir: str,
    columns: Iterable[str] = STORED_COLUMNS,
    *,
    narrow: Callable[[DataFrame], DataFrame] | None = None,
    among: DataFrame | None = None,
) -> DataFrame:
    """Orders as transactions, with the asked-for columns only.

    An order whose customer or nation is missing stays, without their columns. So
    looking them up neither adds nor loses rows: it is left out when none of their
    columns is wanted, and ``narrow``, an operator that picks few rows by the columns of
    the order itself, may run before it; they are stored, so that the planner knows how few. ``among``, a short list of locations, keeps only
    orders from there: it is applied to the customers before they meet the orders. No
    other side is hinted: the planner broadcasts by size, and AQE splits a customer
    with very many orders.
    """
    columns = list(columns)
    own = {
        KEY: F.col("o_orderkey").cast("string"),
        "timestamp": F.col("o_orderdate"),
        # Computed rather than renamed: a grouping by customer then shuffles its
        # partial results instead of relying on the partitioning of the join,
        # which would keep AQE from splitting a hot customer.
        "customer_id": F.col("o_custkey").bitwiseOR(F.lit(0).cast("long")),
        "amount": F.col("o_totalprice"),
        "currency": F.lit("USD"),
        "status": F.when(F.col("o_orderstatus") == "F", "SUCCESS")
        .when(F.col("o_orderstatus") == "O", "PENDING")
        .when(F.col("o_orderstatus") == "P", "FAILED"),
        "card_type": F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")),
        FLAG: over_threshold(ORDER_THRESHOLD, "o_totalprice"),
    }
    looked_up = {"customer_name": "c_name", "merchant": "c_mktsegment", "location": "n_name"}
    orders = table(spark, sf_dir, "orders")
    rows = orders.select("o_custkey", *(value.alias(name) for name, value in own.items()))
    if narrow is not None:
        rows = stored(narrow(rows), "picked")
    if looked_up.keys() & set(columns) or among is not None:
        customers = _customers(spark, sf_dir, "location" in columns or among is not None, among)
        if narrow is not None:  # look for the few picked, not for all
            picked = rows.select(F.col("o_custkey").alias("c_custkey"))
            customers = customers.join(picked, "c_custkey", "left_semi")
        how = "left" if among is None else "inner"
        rows = rows.join(customers, F.col("o_custkey") == F.col("c_custkey"), how)
    return rows.select(*(F.col(looked_up.get(c, c)).alias(c) for c in columns))


def _customers(spark: SparkSession, sf_dir: str, located: bool, among: DataFrame | None = None) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    if not located:
        return customers
    nations = table(spark, sf_dir, "nation")
    if among is not None:
        names = F.broadcast(among.select(F.col("location").alias("n_name")))
        nations = nations.join(names, "n_name", "left_semi")
    how = "left" if among is None else "inner"
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), how)


def by_customer(spark: SparkSession, sf_dir: str, columns: Iterable[str]) -> DataFrame:
    """A summary of the transactions by ``location``, and by the flag if asked for.

    Orders are counted for each customer first, and only the counts meet the customers.
    """
    columns = list(columns)
    own = [c for c in columns if c != "location"]
    rows = measured(transactions(spark, sf_dir, ("customer_id", "amount", *own)))
    counts = rows.groupBy("customer_id", *own).agg(*(F.sum(c).alias(c) for c in (ROWS, AMOUNT, AMOUNTS)))
    customers = _customers(spark, sf_dir, True).select(F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("location"))
    return counts.join(customers, "customer_id", "left").drop("customer_id")


def customer_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name of each customer id."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name")
    )


def _event_columns() -> dict[str, Column]:
    user = F.col("user_id")
    return {
        KEY: F.concat_ws("-", user.cast("string"), "event_type"),
        "timestamp": F.col("ts"),
        "customer_id": user.cast("int"),
        "customer_name": F.concat(F.lit("user "), user.cast("string")),
        "amount": F.col("value"),
        "currency": F.lit("USD"),
        "merchant": F.col("event_type"),
        "location": F.concat(F.lit("site "), F.get_json_object("props", "$.k")),
        "status": F.col("event_type"),
        "card_type": F.when(F.col("event_type") != "signup", F.col("event_type")),
    }


def _select(rows: DataFrame, columns: dict[str, Column], *extra: Column) -> DataFrame:
    return rows.select(*extra, *(value.alias(name) for name, value in columns.items()))


def transaction_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as transactions that are delivered many times; ``event_id`` is the order."""
    columns = _event_columns() | {FLAG: over_threshold(EVENT_THRESHOLD, "value")}
    return _select(table(spark, sf_dir, "events"), columns, F.col("event_id"))


def _packed(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    # The id alone is the order of delivery.
    place = position(F.lit(None), F.lit("events"), F.lit(0), F.col("event_id"))
    wire = _select(rows, columns, place, F.col("event_id"))
    return wire.select("position", "event_id", F.to_json(F.struct(*WIRE_COLUMNS)).alias("value"))


def event_messages(spark: SparkSession, sf_dir: str, *, streaming: bool = False, dealt: bool = False) -> DataFrame:
    """Events as JSON messages, as a batch or as a stream of files.

    The table may lie in the order of the ids, so that some range of them is read by few tasks. A batch that is ``dealt``
    out goes on in as many tasks as the session has for a shuffle; filters by position run before that.
    """
    if streaming:
        schema = table(spark, sf_dir, "events").schema
        # A pattern, as the stream takes no single file; it fits a folder as well.
        rows = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    else:
        rows = table(spark, sf_dir, "events")
        rows = rows.repartition("event_id") if dealt else rows
    columns = _event_columns() | {"timestamp": iso_text("ts")}
    return _packed(rows, columns).select("position", "value")


def order_messages(spark: SparkSession, sf_dir: str, since: date | None = None) -> DataFrame:
    """Orders as JSON messages; with ``since``, those from that day on, delivered later and at twice the amount."""
    rows = transactions(spark, sf_dir)
    again = since is not None
    if again:
        rows = rows.where(F.col("timestamp") >= F.lit(since)).withColumn("amount", F.col("amount") * 2)
    place = position(F.lit(None), F.lit("orders"), F.lit(int(again)), F.col(KEY))
    wire = rows.withColumn("timestamp", iso_text("timestamp")).select(place, F.to_json(F.struct(*WIRE_COLUMNS)).alias("value"))
    return wire.select("position", "value")


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event messages with every kind of fault, decided by the event itself.

    Errors are cut off after three characters; small ``k`` leave out the
    merchant, middle ones carry no readable time or one of a far year; values above 100
    are left out;
    names repeat the event type ``k`` times and may grow too long.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    columns = _event_columns() | {
        "timestamp": F.when(k.between(40, 44), F.lit("not a time"))
        .when(k.between(35, 37), F.concat(iso_text("ts").substr(1, 4), F.lit("0"), F.substring(iso_text("ts"), 5, 40)))
        .otherwise(iso_text("ts")),
        "customer_name": F.expr(
            "repeat(event_type, cast(get_json_object(props, '$.k') as int))"
        ),
        "merchant": F.when(k >= 5, F.col("event_type")),
        "amount": F.when(F.col("value") <= 100, F.col("value")),
    }
    packed = _packed(table(spark, sf_dir, "events"), columns)
    cut = F.when(F.col("value").contains('"status":"error"'), F.substring("value", 1, 3))
    return packed.withColumn("value", F.coalesce(cut, F.col("value")))

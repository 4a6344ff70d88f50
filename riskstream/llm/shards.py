"""Shards by best-fit-decreasing bin packing of indivisible groups.

Rows with equal texts form a group, which stays together. Groups are packed in order
of size, largest first, each into the tightest bin that still has room for it, found
in a balanced tree of remaining capacities. Either the number of shards is given, and the
smallest capacity for which that many suffice is searched for, or the capacity of a shard is, and bins are opened as they are needed, which keeps them few.

Groups of one size are interchangeable, so the packing is of sizes with the numbers of
groups that have them, counted by Spark: a bin that is the tightest for one group of a size is the tightest for the next one too, until
it is full, so as many as fit go there at once. The driver sees the different sizes, not the groups. The groups are
sorted by size over partitions and numbered; the packing says which numbers go to which shard.

Defined results: a null text has no bytes and forms a group of its own; repeated rows
each get a place; an empty table gives an empty result; with fewer groups than shards
some shards stay empty; a group larger than the given capacity has a shard to itself. A column to keep that has the name of a result gives way to it;
other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from riskstream.llm.kept import ROW, carried, restored
from riskstream.llm.resampling import ranked
from riskstream.session import stored

#: Bytes that each row takes besides its text.
ROW_BYTES = 8
#: Rows that are numbered by one task at a time, about.
STRETCH = 50_000


class Rooms:
    """Bins by the room they have left: a balanced tree (a treap, whose priorities are fixed by a multiplier).

    A node is [(room, bin), priority, nodes before, nodes after].
    """

    def __init__(self, bins: int, capacity: int):
        self.top = None
        for b in range(bins):
            self.add(capacity, b)

    def add(self, room: int, b: int) -> None:
        node = [(room, b), (b + 1) * 2654435761 % (1 << 32), None, None]
        before, after = self._split(self.top, node[0])
        self.top = self._merge(self._merge(before, node), after)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove the bin with the least room that is enough, the first of equal ones."""
        before, enough = self._split(self.top, (size, -1))
        if enough is None:
            self.top = before
            return None
        found = enough
        while found[2] is not None:
            found = found[2]
        _, after = self._split(enough, (found[0][0], found[0][1] + 1))
        self.top = self._merge(before, after)
        return found[0]

    def _split(self, node, key):
        """The nodes below a key, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            node[3] = low
            return node, high
        low, high = self._split(node[2], key)
        node[2] = high
        return low, node

    def _merge(self, low, high):
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            low[3] = self._merge(low[3], high)
            return low
        high[2] = self._merge(low, high[2])
        return high


#: How many groups of a size go to a bin: (size, groups, bin).
Placed = list[tuple[int, int, int]]


def best_fit_decreasing(sizes: list[tuple[int, int]], bins: int | None, capacity: int) -> Placed | None:
    """Where (size, groups), largest size first, go; None if so many bins don't suffice. Without a number, bins are opened as they are needed."""
    rooms, opened, out = Rooms(bins or 0, capacity), bins or 0, []
    for size, left in sizes:
        while left:
            found = rooms.take_tightest(size)
            if found is None:
                if bins is not None:
                    return None
                found, opened = (max(capacity, size), opened), opened + 1
            room, b = found
            taken = min(left, room // size)
            rooms.add(room - taken * size, b)
            out.append((size, taken, b))
            left -= taken
    return out


def pack(sizes: list[tuple[int, int]], bins: int) -> Placed:
    """Best fit decreasing with the smallest capacity for which the bins suffice."""
    total, largest = sum(size * n for size, n in sizes), max((size for size, _ in sizes), default=0)
    low = max(-(-total // bins), largest)
    high = low
    while (best := best_fit_decreasing(sizes, bins, high)) is None:
        low, high = high + 1, high + max(1, high // 64)
    while low < high:
        middle = (low + high) // 2
        found = best_fit_decreasing(sizes, bins, middle)
        low, high, best = (low, middle, found) if found else (middle + 1, high, best)
    return best


def assign_shards(df: DataFrame, shards: int | None, keep: list[str], text: str = "text", capacity: int | None = None) -> DataFrame:
    """size, text_crc32, shard and slot of each row next to the columns to keep.

    Give the number of shards, or None and the capacity of each in bytes.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give the number of shards or their capacity")
    spark = df.sparkSession
    results = ["size", "text_crc32", "shard", "slot"]
    kept, row = carried(keep, results)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        row,
        (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col(text).isNull(), body).alias("hash"),
        F.monotonically_increasing_id().alias("number"),
    )
    rows = stored(rows, "shard-rows")
    group = ["hash", "text_crc32", "size"]
    groups = stored(rows.groupBy(*group).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-groups")
    # as many rows as there are different sizes
    sizes = [tuple(r) for r in groups.groupBy("bytes").count().collect()]
    sizes.sort(reverse=True)
    placed = pack(sizes, shards) if shards is not None else best_fit_decreasing(sizes, None, capacity)
    spans, at = [], 0
    for size, n, b in placed:
        spans.append((size, at + 1, at + n, b))
        at += n
    spans = spark.createDataFrame(spans, "bytes long, since long, until long, shard int")
    numbered = ranked(groups.withColumn("down", -F.col("bytes")), ("down", *group))
    of_group = numbered.join(spans, "bytes").where("rank BETWEEN since AND until").select(*group, "shard", "n")
    rows = rows.join(of_group.drop("n"), group)

    # Slots: stretches of a shard are numbered side by side, each from where those before it end.
    n = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    stretches = max(1, n // (max(1, len({b for _, _, b in placed})) * STRETCH))
    rows = rows.withColumn("stretch", F.pmod(F.xxhash64("number"), F.lit(stretches)))
    before = Window.partitionBy("shard").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    since = rows.groupBy("shard", "stretch").agg(F.count(F.lit(1)).alias("there"))
    since = since.select("shard", "stretch", F.coalesce(F.sum("there").over(before), F.lit(0)).alias("since"))
    within = Window.partitionBy("shard", "stretch").orderBy("number")
    slot = (F.col("since") + F.row_number().over(within) - 1).cast("long")
    return restored(rows.join(since, ["shard", "stretch"]).withColumn("slot", slot), kept, results)

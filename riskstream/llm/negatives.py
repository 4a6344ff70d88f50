"""Hard negatives by a secondary sort of scored pairs.

An anchor's positives are the rows of its own label that score highest with it; a hard negative of a
positive is a row of another label whose score lies in a window below that of the positive. A score is the inner
product of two vectors whose components are scaled and floored to whole numbers, so it is exact.

Pairs are scored in blocks: rows and anchors are split by hash into parts of about BLOCK, every
part of rows meets every part of anchors, and a block lets only those pairs through that can still count: first each anchor's best rows of its
own label, then, once the positives are known, the first rows of each positive's window. What
a block lets through is packed into keys of (anchor, descending score, kind, id) and dealt by
anchor with ``repartitionAndSortWithinPartitions``. A task then reads its anchors' pairs as
one stream: a positive opens a window, and a negative is emitted for each open window it lies
in. Nothing but the open windows is held, however many pairs an anchor has.

Defined results: rows whose label, id or vector is null, or whose vector is empty or holds a null, NaN or infinity,
take no part; of rows that repeat an id the one with the smallest label, then vector, counts; only vectors of one
dimension meet; ties go to the smaller id; an anchor with fewer rows of its label has fewer
positives, one alone in its label none; a positive below 0 has an empty window; a score beyond
64 bits counts as the largest or smallest there is; an empty table gives an empty result.
Further columns of the table are not looked at, whatever their names.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame, functions as F

from riskstream.llm.workers import small_batches
from riskstream.session import stored

#: Rows or anchors in a block.
BLOCK = 4096
#: Components are multiplied by this before they are floored.
SCALE = 256
#: Whole numbers that doubles hold exactly, and the largest score.
EXACT, MOST = 1 << 53, (1 << 63) - 1
#: Kinds of pairs, in the order in which equal scores come.
POSITIVE, NEGATIVE = 0, 1
_KEY = struct.Struct(">QQBQ")
_SHIFT = 1 << 63


@dataclass(frozen=True)
class Mining:
    """How many positives an anchor has, how many negatives a positive, and the window: negatives score from ``low`` to ``high`` hundredths of the positive."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95

    def window(self, positive: int) -> tuple[int, int]:
        """The least and largest score of a negative; an empty window's least exceeds its largest."""
        return -(-self.low * positive // 100), self.high * positive // 100


def packed(anchor: int, score: int, kind: int, row: int) -> bytes:
    """A key whose bytes sort by anchor, descending score, kind and id."""
    return _KEY.pack(anchor + _SHIFT, MOST - score, kind, row + _SHIFT)


def unpacked(key: bytes) -> tuple[int, int, int, int]:
    anchor, score, kind, row = _KEY.unpack(key)
    return anchor - _SHIFT, MOST - score, kind, row - _SHIFT


def _floored(df: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """(id, label, dim, v) of the rows that take part, once for each id; v: floored components as doubles."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, vectors, dims = [], [], []
            for i, v in enumerate(batch.column("v")):
                if len(v.values) and not v.values.null_count:
                    x = np.floor(v.values.to_numpy().astype(np.float64) * SCALE)
                    if np.isfinite(x).all():
                        kept.append(i)
                        vectors.append((x + 0.0).tobytes())
                        dims.append(len(x))
            rows = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("label"), pa.array(dims, pa.int32()), pa.array(vectors, pa.binary())], ["id", "label", "dim", "v"])

    rows = df.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v")).dropna()
    found = rows.mapInArrow(clean, "id long, label long, dim int, v binary")
    first = found.groupBy("id").agg(F.min(F.struct("label", "v", "dim")).alias("first"))
    return first.select("id", "first.label", "first.dim", "first.v")


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The inner products of whole numbers, exactly; 64-bit."""
    bound = np.abs(anchors).max(initial=0) * np.abs(rows).max(initial=0) * anchors.shape[1]
    if bound < EXACT:
        return (anchors @ rows.T).astype(np.int64)
    exact = [[int(x) for x in row] for row in rows.tolist()]
    found = [[sum(a * b for a, b in zip(anchor, row)) for row in exact] for anchor in ([int(x) for x in a] for a in anchors.tolist())]
    return np.array([[max(-MOST, min(MOST, s)) for s in line] for line in found], np.int64).reshape(len(anchors), len(rows))


def _in_blocks(rows: DataFrame, anchors: DataFrame, pairs, block: int) -> RDD:
    """The keys of what ``pairs`` lets through in the blocks of rows and anchors.

    ``pairs(ids, labels, vectors, anchors)`` gets the rows as arrays, by id, and the anchors with their columns.
    """
    # as many rows as there are dimensions
    sizes = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / block).alias("np"))
    asked = anchors.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / block).alias("nq"))
    grid = stored(sizes.join(asked, "dim"), "grid")

    def dealt(side: DataFrame, own: str, other: str, number: int) -> DataFrame:
        placed = side.join(grid, "dim").withColumn(own, F.pmod(F.xxhash64("id"), F.col(f"n{own}")))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"n{other}") - 1))).withColumn("side", F.lit(number))

    columns = ["dim", "p", "q", "side", "id", "label", "v", "windows"]
    left = dealt(rows.withColumn("windows", F.lit(None).cast("array<bigint>")), "p", "q", 0)
    together = left.select(*columns).unionByName(dealt(anchors, "q", "p", 1).select(*columns))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sides = None, ([], [])

        def found() -> pa.RecordBatch:
            out: list[bytes] = []
            if sides[0] and sides[1]:
                ids, labels = (np.array([r[k] for r in sides[0]], np.int64) for k in (0, 1))
                vectors = np.frombuffer(b"".join(r[2] for r in sides[0]), np.float64).reshape(len(ids), -1)
                out = list(pairs(ids, labels, vectors, sides[1]))
            return pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["key"])

        for batch in batches:
            for *where, side, i, label, v, windows in zip(*(batch.column(c).to_pylist() for c in columns)):
                if where != at:
                    yield found()
                    at, sides = where, ([], [])
                sides[side].append((i, label, v, windows))
        yield found()

    met = together.repartition("dim", "p", "q").sortWithinPartitions("dim", "p", "q", "side", "id")
    return met.mapInArrow(search, "key binary").rdd.map(lambda row: bytes(row.key))


def _scored(anchors: list, vectors: np.ndarray, at_once: int = 256) -> Iterator[tuple]:
    """Each anchor with its scores."""
    for i in range(0, len(anchors), at_once):
        part = anchors[i : i + at_once]
        x = np.frombuffer(b"".join(a[2] for a in part), np.float64).reshape(len(part), -1)
        yield from zip(part, scores(x, vectors))


def _best(score: np.ndarray, places: np.ndarray, most: int) -> np.ndarray:
    """Of the places, in order of id, those with the highest scores; ties go to the first."""
    if len(places) > most:
        least = np.partition(score[places], len(places) - most)[len(places) - most]
        above = places[score[places] > least]
        places = np.concatenate([above, places[score[places] == least][: most - len(above)]])
    return places


def _positives(mining: Mining):
    def pairs(ids, labels, vectors, anchors):
        for (anchor, label, _, _), score in _scored(anchors, vectors):
            for i in _best(score, np.flatnonzero((labels == label) & (ids != anchor)), mining.positives).tolist():
                yield packed(anchor, int(score[i]), POSITIVE, int(ids[i]))

    return pairs


def _negatives(mining: Mining):
    def pairs(ids, labels, vectors, anchors):
        for (anchor, label, _, windows), score in _scored(anchors, vectors):
            other, found = labels != label, set()
            for positive in set(windows):
                least, most = mining.window(positive)
                if least <= most:
                    found.update(_best(score, np.flatnonzero(other & (score >= least) & (score <= most)), mining.negatives).tolist())
            for i in found:
                yield packed(anchor, int(score[i]), NEGATIVE, int(ids[i]))

    return pairs


def _sorted_pairs(keys: RDD, partitions: int) -> RDD:
    """The pairs of keys, an anchor's in one partition and in order."""
    # anchors may be multiples of a number: their bits are spread first
    dealt = keys.map(lambda key: (key, None)).repartitionAndSortWithinPartitions(partitions, lambda key: int.from_bytes(key[:8], "big") * 0x9E3779B97F4A7C15 >> 32 & 0x7FFFFFFF)
    return dealt.map(lambda pair: unpacked(pair[0]))


def first_positives(stream: Iterable[tuple[int, int, int, int]], mining: Mining) -> Iterator[tuple[int, int, int]]:
    """(anchor, positive, score) of the first positives in each anchor's pairs."""
    at, left = None, 0
    for anchor, score, _, row in stream:
        if anchor != at:
            at, left = anchor, mining.positives
        if left:
            left -= 1
            yield anchor, row, score


def mined(stream: Iterable[tuple[int, int, int, int]], mining: Mining) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(anchor, positive, rank, negative, positive's score, negative's score) from pairs in order; only open windows are held."""
    at, opened = None, []
    for anchor, score, kind, row in stream:
        if anchor != at:
            at, opened = anchor, []
        if kind == POSITIVE:
            least, most = mining.window(score)
            if least <= most:
                opened.append([row, score, least, most, 0])
            continue
        for window in opened:
            positive, positive_score, least, most, emitted = window
            if least <= score <= most and emitted < mining.negatives:
                window[4] = emitted + 1
                yield anchor, positive, emitted + 1, row, positive_score, score
        opened = [w for w in opened if score >= w[2] and w[4] < mining.negatives]


def hard_negatives(df: DataFrame, anchors: DataFrame, mining: Mining = Mining(), key: str = "vec_id", label: str = "label", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. ``anchors`` has the key of the rows to take as anchors."""
    spark = small_batches(df.sparkSession)
    rows = stored(_floored(df, key, label, vector), "vectors")
    chosen = anchors.select(F.col(key).cast("long").alias("id")).distinct()
    asked = stored(rows.join(chosen, "id", "left_semi"), "anchors")
    bare = asked.withColumn("windows", F.lit(None).cast("array<bigint>"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    same = _in_blocks(rows, bare, _positives(mining), block)
    best = _sorted_pairs(same, partitions).mapPartitions(lambda stream: first_positives(stream, mining))
    positives = stored(spark.createDataFrame(best, "anchor long, positive long, score long"), "positives")
    windows = positives.groupBy(F.col("anchor").alias("id")).agg(F.collect_list("score").alias("windows"))
    near = _in_blocks(rows, asked.join(windows, "id"), _negatives(mining), block)
    opening = positives.rdd.map(lambda row: packed(row.anchor, row.score, POSITIVE, row.positive))
    found = _sorted_pairs(near.union(opening), partitions).mapPartitions(lambda stream: mined(stream, mining))
    return spark.createDataFrame(found, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")

"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables.

A table turns directions by a fast pseudo-rotation, three rounds of random signs and a
Hadamard transform, and assigns each to its nearest signed axis. A query looks in the bins of the
axes nearest to it, in each table, and what it finds is ranked by the exact
inner product. Vectors are cut into bands of length, so that in
a band the nearest in angle has about the largest inner product.

How many tables a band has and how many bins of each a query looks in is measured: the neighbours of a sample of queries are found exactly
first, and of 1, 2, 4 and up to TABLES tables those are taken of which the fewest bins hold RECALL of the neighbours. Every vector is in every table of
its band. A query that finds fewer vectors than were asked for and there are is searched whole in all bands, and only such a query is.

A bin is searched in blocks: its vectors and its queries are split by hash into parts of
about BLOCK, every part of queries meets every part of vectors, and a block gives each query's best.
Of equal vectors only as many as can be asked for go into the tables, those with the lowest ids,
and equal queries are searched once, so a vector that fills a third of the table costs no more.

Defined results: vectors that are null, of length 0, or hold a null, NaN or infinity take no part; of
rows that repeat an id one counts; only vectors of one dimension are compared; ties go to the
smaller id; with fewer candidates than asked for, there are fewer ranks; an
empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from riskstream.llm.workers import BATCH_BYTES, small_batches
from riskstream.session import stored

#: The most tables of a band.
TABLES = 8
#: Probes are raised until so many of the neighbours of SAMPLE queries of a dimension are in their bins.
RECALL, SAMPLE = 0.97, 64
#: Lengths of a band are up to so many times its shortest.
BAND = 1.25
#: Vectors or queries in a block.
BLOCK = 4096
#: Lengths that differ less than this don't count as different.
SAME_LENGTH = 1e-3
#: Scores are compared to so many digits, beyond the rounding errors of a sum.
DIGITS = 12


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Hadamard transform of each row, whose length is a power of two."""
    n, half = x.shape[1], 1
    while half < n:
        pairs = x.reshape(len(x), -1, 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        half *= 2
    return x / np.sqrt(n)


def rotated(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Rows padded to a power of two and turned as the table does."""
    n = 1 << max(1, (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, n - x.shape[1])))
    signs = np.random.default_rng([seed, table]).choice([-1.0, 1.0], (3, n))
    for row in signs:
        x = hadamard(x * row)
    return x


def axes(dim: int) -> int:
    """The number of signed axes of a table."""
    return 2 << max(1, (dim - 1).bit_length())


def nearest_axes(x: np.ndarray, probes: int) -> np.ndarray:
    """For each row the nearest signed axes, nearest first: 2 * axis, and 1 more for its negative end."""
    both = np.stack([x, -x], axis=2).reshape(len(x), -1)
    if probes == 1:
        return both.argmax(axis=1)[:, None]
    return np.argsort(-both, axis=1, kind="stable")[:, :probes]


def _vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v, dim, length): vectors that take part, as 64-bit numbers."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors, lengths = [], [], []
            for i, v in zip(batch.column("id"), batch.column("v")):
                if i.is_valid and v.is_valid and not v.values.null_count:
                    x = v.values.to_numpy().astype(np.float64)
                    if (length := float(np.linalg.norm(x))) > 0 and np.isfinite(x).all():
                        ids.append(i.as_py())
                        vectors.append(x.tobytes())
                        lengths.append(length)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vectors, pa.binary()), pa.array(lengths, pa.float64())], ["id", "v", "length"])

    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    found = rows.mapInArrow(clean, "id long, v binary, length double").dropDuplicates(["id"])
    return found.withColumn("dim", (F.octet_length("v") / 8).cast("int"))


def _whole(rows: DataFrame) -> DataFrame:
    """Rows in the one bin of their dimension in which everything meets."""
    return rows.select("dim", F.lit(-1).alias("band"), F.lit(0).alias("bin_table"), F.lit(0).alias("axis"), "id", "v")


def _binned(rows: DataFrame, seed: int) -> DataFrame:
    """(dim, band, bin_table, axis, id, v): each vector in the bins of its ``probes`` nearest axes of each of ``tables`` tables."""

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = np.column_stack([batch.column(c).to_numpy() for c in ("dim", "tables", "probes")])
            for dim, tables, probes in np.unique(kinds, axis=0).tolist():
                taken = batch.take(pa.array(np.flatnonzero((kinds == (dim, tables, probes)).all(axis=1))))
                x = np.frombuffer(b"".join(taken.column("v").to_pylist()), np.float64).reshape(-1, dim)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                step = max(1, BATCH_BYTES // (8 * dim * probes))  # a vector goes out once for each probe
                for table, at in itertools.product(range(tables), range(0, len(x), step)):
                    axes = nearest_axes(rotated(x[at : at + step], table, seed), probes)
                    each = taken.take(pa.array(np.repeat(np.arange(at, at + len(axes)), axes.shape[1])))
                    columns = [each.column("dim"), each.column("band"), pa.array(np.full(each.num_rows, table, np.int32)), pa.array(axes.ravel().astype(np.int32)), each.column("id"), each.column("v")]
                    yield pa.RecordBatch.from_arrays(columns, ["dim", "band", "bin_table", "axis", "id", "v"])

    return rows.select("dim", "band", "tables", "probes", "id", "v").mapInArrow(hash_all, "dim int, band int, bin_table int, axis int, id long, v binary")


def _best(ids: np.ndarray, points: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query the k best points: query, point's id, score; ``ids`` ascend."""
    score = np.round(queries @ points.T, DIGITS)
    if score.shape[1] > k:
        # all that reach the k-th best, then the smaller ids of those equal to it
        least = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k, None]
        above = score > least
        room = k - above.sum(axis=1, keepdims=True)
        equal = score == least
        chosen = above | (equal & (np.cumsum(equal, axis=1) <= room))
    else:
        chosen = np.ones(score.shape, bool)
    query, point = np.nonzero(chosen)
    return query, ids[point], np.einsum("ij,ij->i", queries[query], points[point])


def _hits(points: DataFrame, searched: DataFrame, k: int) -> DataFrame:
    """asked, vec_id and score: the best k of what the bins of each query hold, at least."""
    bins = ["dim", "band", "bin_table", "axis"]
    # as many rows as there are bands, tables and axes
    parts = points.groupBy(*bins).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("np"))
    asked = searched.groupBy(*bins).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("nq"))
    grid = stored(parts.join(asked, bins), "bins")

    def spread(side: DataFrame, own: str, other: str, query: bool) -> DataFrame:
        placed = side.join(F.broadcast(grid), bins).withColumn(own, F.pmod(F.xxhash64("id", "bin_table"), F.col(f"n{own}")))
        placed = placed.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"n{other}") - 1)))
        return placed.select(*bins, "p", "q", F.lit(query).alias("query"), "id", "v")

    block = [*bins, "p", "q"]
    together = spread(points, "p", "q", False).unionByName(spread(searched, "q", "p", True))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sides = None, ([], [])

        def found() -> pa.RecordBatch:
            query = id_ = score = np.zeros(0, np.int64)
            if sides[0] and sides[1]:
                (pids, points), (qids, asked) = ((np.array([i for i, _ in s]), np.frombuffer(b"".join(v for _, v in s), np.float64).reshape(len(s), -1)) for s in sides)
                which, id_, score = _best(pids, points, asked, k)
                query = qids[which]
            return pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(id_, pa.int64()), pa.array(score, pa.float64())], ["asked", "vec_id", "score"])

        for batch in batches:
            for *where, query, i, v in zip(*(batch.column(c).to_pylist() for c in (*block, "query", "id", "v"))):
                if where != at:
                    yield found()
                    at, sides = where, ([], [])
                sides[query].append((i, v))
        yield found()

    return together.repartition(*block).sortWithinPartitions(*block, "query", "id").mapInArrow(search, "asked long, vec_id long, score double")


def _order() -> list:
    return [F.desc(F.round("score", DIGITS)), "vec_id"]


def _first(hits: DataFrame, k: int) -> DataFrame:
    """The best k of each query."""
    hits = hits.groupBy("asked", "vec_id").agg(F.max("score").alias("score"))
    return hits.withColumn("at", F.row_number().over(Window.partitionBy("asked").orderBy(*_order()))).where(F.col("at") <= k).drop("at")


def _some_tables(tables: int) -> list[int]:
    """1, 2, 4 and so on, up to all."""
    return [*(1 << i for i in range((tables - 1).bit_length())), tables]


def _needs(points: DataFrame, distinct: DataFrame, k: int, tables: int, seed: int) -> DataFrame:
    """dim, band, tables, need and count: probes that find a neighbour in so many tables, of the exact neighbours of a sample of queries."""
    nth = F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("id"), "id"))
    some = distinct.withColumn("nth", nth).where(F.col("nth") <= SAMPLE)
    some = stored(some.select("dim", "id", "v"), "sample")
    exact = _first(_hits(_whole(points), _whole(some), k + 1), k + 1).where("asked <> vec_id")
    pairs = exact.join(some.select(F.col("id").alias("asked"), F.col("v").alias("query")), "asked")
    pairs = pairs.join(points.withColumnRenamed("id", "vec_id"), "vec_id").select("dim", "band", "query", "v")
    counts = _some_tables(tables)

    def need(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                taken = batch.take(pa.array(np.flatnonzero(dims == dim)))
                query, point = (np.frombuffer(b"".join(taken.column(c).to_pylist()), np.float64).reshape(-1, dim) for c in ("query", "v"))
                least = np.full(len(query), axes(dim), np.int64)
                for table in range(tables):
                    at = nearest_axes(rotated(point / np.linalg.norm(point, axis=1, keepdims=True), table, seed), 1)
                    turned = rotated(query / np.linalg.norm(query, axis=1, keepdims=True), table, seed)
                    both = np.stack([turned, -turned], axis=2).reshape(len(turned), -1)
                    least = np.minimum(least, (both >= np.take_along_axis(both, at, 1)).sum(axis=1))
                    if table + 1 in counts:
                        columns = [taken.column("dim"), taken.column("band"), pa.array(np.full(len(least), table + 1, np.int32)), pa.array(least)]
                        yield pa.RecordBatch.from_arrays(columns, ["dim", "band", "tables", "need"])

    return pairs.mapInArrow(need, "dim int, band int, tables int, need long").groupBy("dim", "band", "tables", "need").count()


def _planned(needs: dict[int, list[int]], dim: int, tables: int) -> tuple[int, int]:
    """Tables and probes of a band: those with the fewest bins that hold RECALL of the neighbours in the sample."""
    if not needs:  # none is in this band: an eighth of the bins of all tables
        return tables, max(1, axes(dim) // 8)
    return min(((n, int(np.quantile(x, RECALL, method="higher"))) for n, x in needs.items()), key=lambda plan: (plan[0] * plan[1], plan[0]))


def plan_bands(points: DataFrame, distinct: DataFrame, k: int, tables: int, probes: int | None, seed: int) -> dict[tuple[int, int], tuple[int, int]]:
    """Tables and probes of each band (dim, band) of the dimensions there are queries of."""
    # as many rows as there are dimensions and bands
    cells = [tuple(r) for r in points.join(distinct.select("dim").distinct(), "dim", "left_semi").select("dim", "band").distinct().collect()]
    if probes is not None:
        return {(dim, band): (tables, min(probes, axes(dim))) for dim, band in cells}
    needs: dict[tuple[int, int], dict[int, list[int]]] = {cell: {} for cell in cells}
    for r in _needs(points, distinct, k, tables, seed).collect() if cells else []:
        needs[r.dim, r.band].setdefault(r.tables, []).extend([r.need] * r["count"])
    return {cell: _planned(found, cell[0], tables) for cell, found in needs.items()}


def nearest(df: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding", tables: int = TABLES, probes: int | None = None, seed: int = 11) -> DataFrame:
    """query_id, rank, vec_id and score: each query's nearest k other vectors. ``queries`` has the key of the rows to search for.

    Probes that are given hold for all bands, each with all tables.
    """
    spark = small_batches(df.sparkSession)
    chosen = queries.select(F.col(key).cast("long").alias("id")).distinct().withColumn("is_query", F.lit(True))
    rows = stored(_vectors(df, key, vector).join(chosen, "id", "left").fillna(False, ["is_query"]), "vectors")
    # of equal vectors the first k and the query's own can be asked for
    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    points = rows.select("dim", "id", "v", "length", nth.alias("nth")).where(F.col("nth") <= k + 1)
    longest = rows.groupBy("dim").agg(F.max(F.log("length")).alias("most"))
    shorter = F.greatest(F.col("most") - F.log("length") - SAME_LENGTH, F.lit(0.0))
    points = points.join(F.broadcast(longest), "dim").select("dim", F.floor(shorter / float(np.log(BAND))).cast("int").alias("band"), "id", "v")
    points = stored(points, "points")
    distinct = stored(rows.where("is_query").groupBy("dim", "v").agg(F.min("id").alias("id")), "queries")
    plan = plan_bands(points, distinct, k, tables, probes, seed)
    planned = spark.createDataFrame([(*cell, *bins) for cell, bins in plan.items()], "dim int, band int, tables int, probes int")
    in_bins = points.join(F.broadcast(planned.drop("probes")), ["dim", "band"]).withColumn("probes", F.lit(1))
    asked = distinct.join(F.broadcast(planned), "dim")
    hits = stored(_first(_hits(_binned(in_bins, seed), _binned(asked, seed), k + 1), k + 1), "hits")
    # the exact way for those that found too little
    there = points.groupBy("dim").agg(F.least(F.count(F.lit(1)), F.lit(k + 1)).alias("there"))
    found = hits.groupBy(F.col("asked").alias("id")).agg(F.count(F.lit(1)).alias("found"))
    short = distinct.join(F.broadcast(there), "dim").join(found, "id", "left").where("coalesce(found, 0) < there")
    hits = _first(hits.unionByName(_hits(_whole(points), _whole(stored(short.select("dim", "id", "v"), "short")), k + 1)), k + 1)
    people = rows.where("is_query").select(F.col("id").alias("query_id"), "v").join(distinct.select("v", F.col("id").alias("asked")), "v").drop("v")
    others = people.join(hits, "asked").where("vec_id <> query_id")
    ranked = others.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*_order())))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

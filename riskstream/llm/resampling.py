"""Importance resampling towards a target's distribution.

Words and runs of words are features, and a feature's checksum picks one of a fixed number of
buckets. How much more often a bucket is met in the target than in the rows is its gain; the gains
are one array, sent to all tasks, and a text's weight is the sum of its features' gains. A noise that
depends on the row's id alone is added, and the rows with the highest scores are drawn.

The last score that is drawn is found by weighted median-of-medians selection. Scores are made
unique keys by the id and the row's number, and written down, sorted within each
partition. In a round, each partition gives the size and the median of the keys it has left; the median of these
medians, weighted by the sizes, is the pivot, and as at least a quarter of all that is left lies on either side of
it, so much is discarded each round, until the cutoff key is found. The driver sees a row a partition a round, and a round
reads only what the statistics of the written keys can't exclude. Then the winners alone are sorted.

Defined results: a null or empty text has no features and weight 0; a null id makes its noise from the empty text
and comes after all others in ties; repeated rows each have a place of their own, in any order; an empty target has no features, an
empty table gives an empty result. A column to keep that has the name of a result gives way to it; other columns
may have any name.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from riskstream.llm.words import text_bytes
from riskstream.llm.workers import small_batches
from riskstream.session import stored

#: Buckets of features, so the size of the array of gains.
BUCKETS = 10_000
#: Bytes of text that are looked at together, about.
PIECE = 1 << 20

#: Bytes of words: digits, letters (after A-Z became a-z) and everything outside ASCII.
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_RUN = re.compile(rb"[\x30-\x39\x61-\x7A\x80-\xFF]+")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _checksum_steps() -> np.ndarray:
    """What a byte does to the checksum (the reflected polynomial of zlib's)."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(0xEDB88320), steps >> 1)
    return steps


_STEPS = _checksum_steps()


def checksums(state: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The checksums of ``data[start:end]`` each, continued from those in ``state``."""
    out = ~state
    left, where = np.flatnonzero(end > start), start[end > start]
    while len(left) >= 64:  # a round for each position in a word, over ever fewer words
        now = out[left]
        out[left] = _STEPS[(now ^ data[where]) & 0xFF] ^ (now >> 8)
        where = where + 1
        more = where < end[left]
        left, where = left[more], where[more]
    out = ~out
    for i, at in zip(left.tolist(), where.tolist()):
        out[i] = zlib.crc32(data[at : end[i]], int(out[i]))
    return out


def _pieces(texts: pa.Array, longest: int, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """First text, bytes (in lower case), where its texts begin and end, and from where on no run may start.

    Texts are taken together up to ``size`` bytes. A longer one is cut between words; a piece goes on
    for ``longest - 1`` words behind the cut, for the runs that start before it.
    """
    data, offsets = text_bytes(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        whole = _LOWER[data[offsets[at] : offsets[to]]]
        if to > at + 1 or len(whole) <= size:
            yield at, whole, offsets[at : to + 1] - offsets[at], len(whole)
        else:
            since, buffer = 0, memoryview(whole)
            while since < len(whole):
                cut = since + size
                if cut < len(whole) and _WORD[whole[cut]]:
                    cut = _RUN.match(buffer, cut).end()
                cut = until = min(cut, len(whole))
                for _ in range(longest - 1):
                    found = _RUN.search(buffer, until)
                    until = found.end() if found else len(whole)
                yield at, whole[since:until], np.array([0, until - since]), cut - since
                since = cut
        at = to


def features(texts: pa.Array, longest: int, buckets: int, size: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """The text and bucket of each run of 1 to ``longest`` words, some texts at a time, and whether the runs are single words."""
    for first, data, offsets, limit in _pieces(texts, longest, size):
        word = _WORD[data]
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
        begins[inner], ends[inner - 1] = word[inner], word[inner - 1]  # a text's words end with it
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        text = np.searchsorted(offsets, start, "right") - 1
        state = checksums(np.zeros(len(start), np.uint32), data, start, end)
        for n in range(1, longest + 1):
            if n > 1:
                there = np.flatnonzero(text[: len(text) - n + 1] == text[n - 1 :]) if len(text) >= n else np.zeros(0, np.int64)
                there = there[np.isin(there, rows, assume_unique=True)]
                state = state[np.searchsorted(rows, there)]
                space = np.full(1, 0x20, np.uint8)
                state = checksums(state, space, np.zeros(len(there), np.int64), np.ones(len(there), np.int64))
                state = checksums(state, data, start[there + n - 1], end[there + n - 1])
                rows = there
            else:
                rows = np.arange(len(start))
            counted = start[rows] < limit
            yield first + text[rows[counted]], (state[counted] % np.uint32(buckets)).astype(np.int64), n == 1


def bucket_counts(df: DataFrame, text: str, longest: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket; counted in each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, found, _ in features(batch.column(0), longest, buckets):
                total += np.bincount(found, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], ["bucket", "n"])

    counted = df.select(F.col(text).alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.collect():  # as many rows as there are buckets
        out[bucket] = n
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much more often a bucket is met in the target, each count one higher; floored."""
    all_own, all_target = float(own.sum() + len(own)), float(target.sum() + len(own))
    return np.array([math.floor(1000 * math.log((t + 1) * all_own / ((s + 1) * all_target))) for s, t in zip(own.tolist(), target.tolist())], np.int64)


def weighted_median(keys: list[tuple], sizes: list[int]) -> tuple:
    """The key up to which half of the sizes lie, in order of the keys."""
    half, seen = sum(sizes) / 2, 0
    for key, size in sorted(zip(keys, sizes)):
        seen += size
        if seen >= half:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, nth: int, columns: tuple[str, ...] = ("down", "id", "row")) -> tuple:
    """The ``nth`` smallest of the keys: whole numbers, without repeats. ``keys`` should be a written table."""
    since = until = None

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sizes and medians of a partition's keys up to the pivot and behind it."""
        parts = [np.column_stack([batch.column(c).to_numpy() for c in columns]) for batch in batches]
        left = np.concatenate(parts) if parts else np.zeros((0, len(columns)), np.int64)
        left = left[np.lexsort(left.T[::-1])]
        for side in (False, True):
            if pivot is None:
                part = left if not side else left[:0]
            else:
                up_to = _up_to(left, pivot)
                part = left[~up_to if side else up_to]
            if len(part):
                middle = part[(len(part) - 1) // 2]
                yield pa.RecordBatch.from_arrays([pa.array([side]), pa.array([len(part)], pa.int64()), *(pa.array([x], pa.int64()) for x in middle.tolist())], ["behind", "size", *columns])

    pivot = None
    schema = ", ".join(["behind boolean", "size long", *(f"{c} long" for c in columns)])
    while True:
        rows = keys.select(*columns)
        for bound, inside in ((since, _behind), (until, _not_behind)):
            rows = rows if bound is None else rows.where(inside(columns, bound))
        found: tuple[list, list] = ([], [])
        for behind, size, *median in rows.mapInArrow(halves, schema).collect():  # two rows a partition
            found[behind].append((tuple(median), size))
        below = sum(size for _, size in found[0])
        if pivot is not None and nth == below:
            return pivot
        if pivot is not None and nth > below:
            nth, since, left = nth - below, pivot, found[1]
        else:
            until, left = pivot or until, found[0]
        if sum(size for _, size in left) < nth:
            raise ValueError("there are not as many keys")
        pivot = weighted_median([key for key, _ in left], [size for _, size in left])


def _up_to(keys: np.ndarray, bound: tuple) -> np.ndarray:
    less, equal = np.zeros(len(keys), bool), np.ones(len(keys), bool)
    for column, value in zip(keys.T, bound):
        less |= equal & (column < value)
        equal &= column == value
    return less | equal


def _behind(columns: tuple[str, ...], bound: tuple):
    """Keys above a bound. The first column is compared by itself as well, for the statistics of the files."""
    return (F.col(columns[0]) >= bound[0]) & (F.struct(*columns) > F.struct(*(F.lit(x).cast("long").alias(c) for c, x in zip(columns, bound))))


def _not_behind(columns: tuple[str, ...], bound: tuple):
    return (F.col(columns[0]) <= bound[0]) & (F.struct(*columns) <= F.struct(*(F.lit(x).cast("long").alias(c) for c, x in zip(columns, bound))))


def ranked(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows with their rank, from 1, in order of the columns: sorted over partitions by range, numbered in each."""
    placed = rows.repartitionByRange(*columns).sortWithinPartitions(*columns).withColumn("__at", F.monotonically_increasing_id())
    placed = stored(placed, "winners")
    part = F.shiftright("__at", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()  # a row a partition
    before = np.cumsum([0, *(n for _, n in counts)]).tolist()
    starts = rows.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], "__part long, __before long")
    numbered = placed.withColumn("__part", part).join(F.broadcast(starts), "__part")
    rank = F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1
    return numbered.withColumn("rank", rank).drop("__part", "__before", "__at")


def resample(df: DataFrame, target: DataFrame, keep: list[str], share: tuple[int, int] = (10, 100), least: int = 20, longest: int = 1, buckets: int = BUCKETS, seed: int = 2024, text: str = "text", order: str = "doc_id") -> DataFrame:
    """n_features, weight, score and rank of each row next to the columns to keep.

    Of the rows with ``least`` words, ``share`` (a fraction) is drawn; the others have no rank. ``target`` has
    texts in a column of the same name. Runs have up to ``longest`` words.
    """
    spark = small_batches(df.sparkSession)
    results = ["n_features", "weight", "score", "rank"]
    keep = [c for c in keep if c not in results]
    gain = spark.sparkContext.broadcast(gains(*(bucket_counts(x, text, longest, buckets) for x in (df, target))))

    # an id that is no number stands behind all others in ties, like a null
    number = F.coalesce(F.col(order).try_cast("long"), F.lit((1 << 63) - 1))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(order).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))
    own = F.struct(*(F.col(c) for c in keep)) if keep else F.struct(F.lit(None).cast("int").alias("none"))
    rows = df.select(own.alias("row"), F.col(text).alias("text"), number.alias("id"), noise.alias("noise"))
    made = ("n_words", "n_features", "weight")
    schema = StructType([*(rows.schema[c] for c in ("row", "id", "noise")), *(StructField(c, LongType()) for c in made)])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = {c: np.zeros(batch.num_rows, np.int64) for c in made}
            for which, found, single in features(batch.column("text"), longest, buckets):
                n = np.bincount(which, minlength=batch.num_rows)
                sums["n_features"] += n
                sums["n_words"] += n * single
                np.add.at(sums["weight"], which, gain.value[found])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "id", "noise")), *(pa.array(sums[c]) for c in made)], ["row", "id", "noise", *made])

    key = ("down", "id", "row_number")
    scored = rows.mapInArrow(weigh, schema).withColumn("score", F.col("weight") + F.col("noise"))
    scored = scored.withColumns({"down": -F.col("score"), "row_number": F.monotonically_increasing_id()})
    scored = stored(scored.drop("noise").sortWithinPartitions("down", "id"), "scores")
    able = scored.where(F.col("n_words") >= least)
    drawn = able.count() * share[0] // share[1]
    kept = [*(F.col("row")[c].alias(c) for c in keep), *results]
    if not drawn:
        return scored.withColumn("rank", F.lit(None).cast("long")).select(*kept)
    last = cutoff(able, drawn, key)
    winners = ranked(able.where(_not_behind(key, last)), key)
    others = scored.where((F.col("n_words") < least) | _behind(key, last)).withColumn("rank", F.lit(None).cast("long"))
    return winners.select(*kept).unionByName(others.select(*kept))

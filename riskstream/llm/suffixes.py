"""Removal of byte strings that recur, by suffix arrays sorted in two stages.

A window is WINDOW consecutive bytes of one text. Every byte is removed that a window covers
whose bytes also start anywhere else, in the same text or another.

**Sorting.** A suffix that is smaller than its successor is of the second kind, the others of the
first. Only those of the second kind are sorted directly. Of all suffixes that begin with one byte those of the first kind come
first, and each of them stands behind its successor: so one scan over the buckets of first bytes, smallest first, puts
every suffix of the first kind in its place when its successor is met. Common prefixes of neighbours in the finished
array tell which windows are met twice. As a window is all that matters, suffixes are compared to its length.

**Distribution.** Each window has an anchor, the run of GRAM bytes in it with the lowest hash, so equal
windows have equal anchors. Consecutive windows with one anchor form a stretch, and only stretches whose anchor
occurs twice can hold a recurring window. Each distinct stretch is sent once, with its number of occurrences, to the shard
of its anchor, and a shard sorts the suffixes of its stretches. A suffix recurs if its stretch does, or if a neighbour in the array shares a
window with it. What recurs goes back to all texts that have the stretch.

An anchor with more than HOT distinct stretches is taken apart by longer anchors: its stretches are
cut again into those of anchors of half a window, and what is still hot then into single windows, of which equal ones are combined.

Defined results: a null text is an empty one; a text shorter than a window loses nothing; repeated rows are
occurrences like any other, so that a repeated text of a window or more is removed whole; long texts are worked on in
pieces of PIECE bytes that overlap; an empty table gives an empty result. A column to keep that has the name of a result gives way to it;
other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from riskstream.llm.filters import bloom_filter, may_contain
from riskstream.llm.words import U64, mix, powers, slices, text_bytes
from riskstream.llm.workers import small_batches
from riskstream.session import stored

#: Bytes of a window and of a first anchor.
WINDOW, GRAM = 200, 32
#: Distinct stretches from which on an anchor is hot.
HOT = 1 << 13
#: Bytes of text that are hashed at a time, and that a suffix array is made of, about.
PIECE, CHUNK = 1 << 19, 1 << 20
#: Bits that tell apart the places in a piece.
PLACE_BITS = 24

_BASE = U64(0x9E3779B97F4A7C15)
_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))
_BYTES = mix(np.arange(1, 257, dtype=U64) * _BASE)
_POWERS = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        _POWERS[:] = [powers(base, n + PIECE) for base in (_BASE, _INVERSE)]
    return _POWERS


# --- suffix arrays ---------------------------------------------------------------


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as numbers that sort like them; zeros behind the end."""
    out = np.concatenate([data, np.zeros(8, np.uint8)]).astype(U64)
    for width in (1, 2, 4):
        out[:-width] = (out[:-width] << U64(8 * width)) | out[width:]
    return out


def _sorted_directly(places: np.ndarray, eights: np.ndarray, text: str, depth: int) -> np.ndarray:
    """Places in the order of their suffixes, compared to ``depth`` characters: by 16 bytes at once, and equal ones by the rest."""
    last = len(eights) - 1
    keys = eights[places], eights[np.minimum(places + 8, last)]
    order = np.lexsort(keys[::-1])
    places = places[order]
    same = np.ones(max(len(places) - 1, 0), bool)
    for key in keys:
        same &= key[order[1:]] == key[order[:-1]]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
    for since, until in edges.reshape(-1, 2).tolist():
        group = places[since : until + 1].tolist()
        group.sort(key=lambda at: text[at + 16 : at + depth])
        places[since : until + 1] = group
    return places


def suffix_array(data: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted places of ``data`` (a mask) in the order of their suffixes, compared to ``depth`` bytes at least."""
    n = len(data)
    if not wanted.any():
        return np.zeros(0, np.int64)
    # a run of one byte is decided by what follows it; the end is smaller than everything
    decided = np.append(data[:-1] != data[1:], True)
    smaller = np.append(data[:-1] < data[1:], False)
    at = np.where(decided, np.arange(n), n)
    smaller = smaller[np.minimum.accumulate(at[::-1])[::-1]]
    # with a suffix of the first kind, its successors up to one of the second kind, or the end
    second = np.append(np.where(smaller, np.arange(n), n - 1), n - 1)
    next_second = np.minimum.accumulate(second[::-1])[::-1][:n]
    change = np.zeros(n + 1, np.int32)
    places = np.flatnonzero(wanted)
    np.add.at(change, places, 1)
    np.add.at(change, next_second[places] + 1, -1)
    present = np.cumsum(change[:n]) > 0
    first_kind = np.append(present & ~smaller, False)  # place -1 is none

    direct = _sorted_directly(np.flatnonzero(present & smaller), _eights(data), data.tobytes().decode("latin-1"), depth)
    bounds = np.searchsorted(data[direct], np.arange(257))
    heads: list[list[np.ndarray]] = [[] for _ in range(256)]
    if present[n - 1]:
        heads[data[n - 1]].append(np.array([n - 1]))

    def induce(met: np.ndarray, c: int) -> None:
        """Put the predecessors of suffixes just met, where they are of the first kind, behind their buckets' heads."""
        before = met - 1
        before = before[first_kind[before]]
        keys = data[before]
        if len(before) < 2:
            for key, place in zip(keys.tolist(), before):
                heads[key].append(place[None])
            return
        order = np.argsort(keys, kind="stable")
        before, keys = before[order], keys[order]
        edges = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        for key, part in zip(keys[edges].tolist(), np.split(before, edges[1:])):
            heads[key].append(part)

    out = []
    for c in range(256):
        while heads[c]:  # a bucket grows while it is scanned, by runs of its byte
            now = np.concatenate(heads[c])
            heads[c] = []
            out.append(now)
            induce(now, c)
        same = direct[bounds[c] : bounds[c + 1]]
        out.append(same)
        induce(same, c)
    order = np.concatenate(out)
    return order[wanted[order]]


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """How many bytes neighbours in a suffix array have in common, up to ``most``."""
    eights, n = _eights(data), len(data)
    a, b = order[:-1], order[1:]
    room = np.minimum(n - np.maximum(a, b), most)
    out = np.zeros(len(a), np.int64)
    left = np.arange(len(a))
    while len(left):
        x = eights[a[left] + out[left]] ^ eights[b[left] + out[left]]
        equal = np.full(len(x), 8, np.int64)
        for bytes_ in range(7, -1, -1):
            equal[x >> U64(8 * (7 - bytes_)) != 0] = bytes_
        out[left] += equal
        left = left[(equal == 8) & (out[left] < room[left])]
    return np.minimum(out, room)


def recurring(stretches: list[tuple[int, bytes]], window: int) -> list[np.ndarray]:
    """Of each distinct stretch, (occurrences, bytes), which of its windows recur."""
    data = np.frombuffer(b"".join(text for _, text in stretches), np.uint8)
    lengths = np.array([len(text) for _, text in stretches])
    end = np.cumsum(lengths)
    begin = end - lengths
    starts = np.ones(len(data), bool)
    for last in range(len(stretches)):
        starts[max(begin[last], end[last] - window + 1) : end[last]] = False
    order = suffix_array(data, starts, window)
    twice = common_prefixes(data, order, window) >= window
    found = np.zeros(len(data), bool)
    found[order[:-1][twice]] = True
    found[order[1:][twice]] = True
    windows = (found[b:e] for b, e in zip(begin.tolist(), (end - window + 1).tolist()))
    return [of | (n > 1) for (n, _), of in zip(stretches, windows)]


# --- stretches -------------------------------------------------------------------


def _grams(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each byte, and of each run of ``length`` bytes."""
    single = hashes = _BYTES[data]
    width = 1
    while width * 2 <= length:
        hashes = hashes[:-width] * U64(pow(int(_BASE), width, 1 << 64)) + hashes[width:]
        width *= 2
    if width < length:
        hashes = hashes[: len(hashes) - (length - width)] * _BASE + hashes[length - width :]
    return single, mix(hashes ^ U64(length))  # runs of another length are others


class Stretches:
    """The stretches of texts that lie one after another: first byte (its place in ``data``), windows, anchor's hash and own hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, gram: int, window: int):
        n = len(data)
        self.begin = self.windows = np.zeros(0, np.int64)
        self.anchor = self.own = np.zeros(0, U64)
        valid = self._inside(offsets, n, window)
        if not len(valid):
            return
        single, grams = _grams(data, gram)
        places, span = U64((1 << PLACE_BITS) - 1), window - gram + 1
        # the lowest hash, and of equal ones the first
        least, width = (grams & ~places) | np.arange(len(grams), dtype=U64), 1
        while width * 2 <= span:
            least, width = np.minimum(least[:-width], least[width:]), width * 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        anchor = (least[valid] & places).astype(np.int64)
        first = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (np.diff(valid) != 1)))
        self.windows = np.diff(np.append(first, len(valid)))
        self.begin = valid[first]
        self.anchor = grams[anchor[first]]
        self._single, self._window = single, window

    @staticmethod
    def _inside(offsets: np.ndarray, n: int, window: int) -> np.ndarray:
        """The windows that lie in one text."""
        if n < window:
            return np.zeros(0, np.int64)
        change = np.zeros(n + 2, np.int32)
        edges = offsets[1:-1]
        np.add.at(change, np.maximum(edges - window + 1, 0), 1)
        np.add.at(change, edges, -1)
        return np.flatnonzero(np.cumsum(change[: n - window + 1]) == 0)

    def hashed(self) -> Stretches:
        if len(self.begin):
            power, inverse = _powers(len(self._single) + 1)
            total = np.append(U64(0), np.cumsum((self._single + U64(1)) * power[: len(self._single)], dtype=U64))
            end = self.begin + self.windows + self._window - 1
            self.own = mix((total[end] - total[self.begin]) * inverse[self.begin] + self.windows.astype(U64))
        return self


def _pieces(texts: pa.Array, window: int, size: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """First text, bytes, where its texts begin and end, and the place of the first byte in its text. Long texts are cut into pieces that overlap."""
    data, offsets = text_bytes(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        since, until = int(offsets[at]), int(offsets[to])
        if until - since <= size + window or to > at + 1:
            yield at, data[since:until], offsets[at : to + 1] - since, 0
        else:
            for cut in range(since, max(since + 1, until - window + 1), size):
                end = min(cut + size + window - 1, until)
                yield at, data[cut:end], np.array([0, end - cut]), cut - since
        at = to


def _each(texts: pa.Array, gram: int, window: int) -> Iterator[tuple[Stretches, np.ndarray, np.ndarray]]:
    """The stretches of a batch of texts, a piece at a time, with the text and the place in it of each."""
    for first, data, offsets, base in _pieces(texts, window):
        found = Stretches(data, offsets, gram, window)
        local = np.searchsorted(offsets, found.begin, "right") - 1
        yield found, first + local, found.begin - offsets[local] + base


def _int64(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _occurrences(docs: DataFrame, gram: int, window: int) -> DataFrame:
    """(key, own, k1, k2, at, windows) of every stretch whose anchor occurs twice."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, _, _ in _each(batch.column("text"), gram, window):
                keys, n = np.unique(found.anchor, return_counts=True)
                yield pa.RecordBatch.from_arrays([_int64(keys), pa.array(n.astype(np.int64))], ["key", "n"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, text, at in _each(batch.column("text"), gram, window):
                found.hashed()
                ids = [batch.column(c).take(pa.array(text)) for c in ("k1", "k2")]
                columns = [_int64(found.anchor), _int64(found.own), *ids, pa.array(at.astype(np.int32)), pa.array(found.windows.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "own", "k1", "k2", "at", "windows"])

    counted = docs.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    twice = stored(counted.where("n > 1").select("key"), "anchors")
    found = docs.mapInArrow(emit, "key long, own long, k1 long, k2 long, at int, windows int")
    # The filter is of a fixed size; whatever it lets pass, the join decides.
    asked = found.withColumn("__hash", F.xxhash64("key"))
    likely = may_contain(asked, bloom_filter(twice.select(F.xxhash64("key").alias("key"))), "__hash").drop("__hash")
    return likely.join(twice, "key", "left_semi")


def _texts(docs: DataFrame, distinct: DataFrame, window: int) -> DataFrame:
    """(key, own, n, text) of each distinct stretch, cut from one of the texts that have it."""
    wanted = distinct.groupBy("k1", "k2").agg(F.collect_list(F.struct("key", "own", "n", "at", "windows")).alias("wanted"))
    wanted = stored(wanted, "stretches")
    asked = docs.withColumn("__hash", F.xxhash64("k1", "k2"))
    held = may_contain(asked, bloom_filter(wanted.select(F.xxhash64("k1", "k2").alias("key"))), "__hash").drop("__hash")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            for part in slices(batch):
                data, offsets = text_bytes(part.column("text"))
                ids = np.column_stack([part.column(c).to_numpy() for c in ("k1", "k2")])
                for row, found in enumerate(part.column("wanted")):
                    if last is not None and (ids[row] == last).all():
                        continue  # a repeated row
                    last, entries = ids[row], found.values
                    since = offsets[row] + entries.field("at").to_numpy()
                    until = since + entries.field("windows").to_numpy() + window - 1
                    texts = pa.array([data[a:b].tobytes() for a, b in zip(since.tolist(), until.tolist())], pa.binary())
                    yield pa.RecordBatch.from_arrays([*(entries.field(c) for c in ("key", "own", "n")), texts], ["key", "own", "n", "text"])

    return held.join(wanted, ["k1", "k2"]).select("k1", "k2", "text", "wanted").mapInArrow(cut, "key long, own long, n long, text binary")


def _taken_apart(texts: DataFrame, gram: int, window: int) -> DataFrame:
    """(key, own, n, parent_key, parent_own, at, text): stretches of longer anchors in (key, own, n, text)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, text, at in _each(batch.column("text"), gram, window):
                found.hashed()
                source = [batch.column(c).take(pa.array(text)) for c in ("n", "key", "own")]
                bodies = batch.column("text").take(pa.array(text)).to_pylist()
                cut = [body[a : a + w + window - 1] for body, a, w in zip(bodies, at.tolist(), found.windows.tolist())]
                columns = [_int64(found.anchor), _int64(found.own), *source, pa.array(at.astype(np.int32)), pa.array(cut, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "own", "n", "parent_key", "parent_own", "at", "text"])

    return texts.mapInArrow(emit, "key long, own long, n long, parent_key long, parent_own long, at int, text binary")


def _searched(texts: DataFrame, window: int) -> DataFrame:
    """(key, own, since, until): the bytes of each distinct stretch that recurring windows cover."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        size = 0

        def found() -> pa.RecordBatch:
            keys, owns, spans = [], [], []
            for (key, own, _, _), windows in zip(held, recurring([x[2:] for x in held], window)):
                edges = np.flatnonzero(np.diff(np.concatenate([[False], windows, [False]]).astype(np.int8))).reshape(-1, 2)
                keys += [key] * len(edges)
                owns += [own] * len(edges)
                spans.append(edges + [0, window - 1])
            both = np.concatenate(spans).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(owns, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1])], ["key", "own", "since", "until"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "own", "n", "text"))):
                if held and held[-1][:2] == row[:2]:
                    continue  # of a row that is repeated
                if size >= CHUNK and held[-1][0] != row[0]:
                    yield found()
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield found()

    sorted_ = texts.repartition("key").sortWithinPartitions("key", "own")
    return sorted_.select("key", "own", "n", "text").mapInArrow(search, "key long, own long, since int, until int")


def _located(texts: DataFrame, sizes: DataFrame, grams: list[int], window: int, hot: int) -> DataFrame:
    """(key, own, since, until) of (key, own, n, text). ``sizes`` has key and own of them."""
    large = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > hot).select("key") if grams else None
    if large is None or (large := stored(large, "hot")).isEmpty():
        return _searched(texts, window)
    texts = stored(texts, "texts")
    parts = stored(_taken_apart(texts.join(large, "key", "left_semi"), grams[0], window), "parts")
    twice = parts.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")
    body = F.first("text").alias("text")  # equal ones
    distinct = parts.join(twice, "key", "left_semi").groupBy("key", "own").agg(F.sum("n").alias("n"), body)
    distinct = stored(distinct, "distinct-parts")
    inner = _located(distinct, distinct.select("key", "own"), grams[1:], window, hot)
    links = parts.select("key", "own", "parent_key", "parent_own", "at")
    places = (F.col("at") + F.col(c) for c in ("since", "until"))
    back = inner.join(links, ["key", "own"]).select(F.col("parent_key").alias("key"), F.col("parent_own").alias("own"), *(p.alias(c) for p, c in zip(places, ("since", "until"))))
    return _searched(texts.join(large, "key", "left_anti"), window).unionByName(back)


SPANS = ArrayType(StructType([StructField("since", IntegerType()), StructField("until", IntegerType())]))


def remove_recurring(df: DataFrame, keep: list[str], window: int = WINDOW, gram: int = GRAM, hot: int = HOT, text: str = "text", order: str = "doc_id") -> DataFrame:
    """n_bytes, n_removed, spans and kept of each text next to the columns to keep.

    ``spans`` are the longest runs of removed bytes, in order; ``kept`` are the bytes left, which need not be text any more.
    """
    small_batches(df.sparkSession)
    results = ("n_bytes", "n_removed", "spans", "kept")
    keep = [c for c in keep if c not in results]
    own = F.struct(*keep) if keep else F.struct(F.lit(None).cast("int").alias("none"))
    # 128 bits that stand for a row: equal rows share them
    rows = df.select(own.alias("row"), F.xxhash64(text).alias("k1"), F.xxhash64(order, text).alias("k2"), F.col(text).alias("text"))
    docs = rows.select("k1", "k2", "text")
    gram = min(gram, window)
    occurrences = stored(_occurrences(docs, gram, window), "occurrences")
    one = [F.first(c).alias(c) for c in ("k1", "k2", "at", "windows")]
    distinct = stored(occurrences.groupBy("key", "own").agg(F.count(F.lit(1)).alias("n"), *one), "distinct")
    deeper = sorted({(gram + window) // 2, window} - {gram})
    located = _located(_texts(docs, distinct, window), distinct.select("key", "own"), deeper, window, hot)
    places = [(F.col("at") + F.col(c)).alias(c) for c in ("since", "until")]
    spans = occurrences.join(located, ["key", "own"]).select("k1", "k2", *places)
    spans = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("since", "until")).alias("spans"))
    schema = StructType([rows.schema["row"], StructField("n_bytes", LongType()), StructField("n_removed", LongType()), StructField("spans", SPANS), StructField("kept", BinaryType())])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, offsets = text_bytes(part.column("text"))
                gone, runs, left = [], [], []
                for a, b, found in zip(offsets[:-1].tolist(), offsets[1:].tolist(), part.column("spans")):
                    body = data[a:b]
                    if not found.is_valid:
                        gone.append(0), runs.append([]), left.append(body.tobytes())
                        continue
                    change = np.zeros(len(body) + 1, np.int32)
                    np.add.at(change, found.values.field("since").to_numpy(), 1)
                    np.add.at(change, found.values.field("until").to_numpy(), -1)
                    removed = np.cumsum(change[:-1]) > 0
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], removed, [False]]).astype(np.int8))).reshape(-1, 2)
                    gone.append(int(removed.sum()))
                    runs.append([{"since": s, "until": u} for s, u in edges.tolist()])
                    left.append(body[~removed].tobytes())
                columns = [pa.array(np.diff(offsets)), pa.array(gone, pa.int64()), pa.array(runs, ARROW_SPANS), pa.array(left, pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column("row"), *columns], ["row", *results])

    removed = rows.join(spans, ["k1", "k2"], "left").select("row", "text", "spans").mapInArrow(remove, schema)
    return removed.select(*(F.col("row")[c].alias(c) for c in keep), *results)


ARROW_SPANS = pa.list_(pa.struct([("since", pa.int32()), ("until", pa.int32())]))

"""Join of similar documents by the Jaccard similarity of their word shingles, with PartEnum signatures.

Sets that are similar enough differ in a bounded number of shingles. Sizes are cut into
bands; a pair meets in the band of its larger set, so a set takes part in its own band and in
those above that a similar set may lie in. For a band that allows for k differences, the
domain of shingle hashes is partitioned into groups, and each group into parts. At most
k / 2 groups hold two differences or more, so among the first k / 2 + 1 groups one has one
difference at most, and all its parts but one agree. A signature is a group's content without
one part: all subsets of parts but one are enumerated. So any similar pair shares a signature.

That counts only groups that are not all but empty, as nothing agrees with nothing: a set goes
on to further groups until it has passed k / 2 + 1 in which two parts have content. A set that runs
out of groups also gives its empty subsets, and meets any other such set.

Sets with a common signature form groups around the smallest set of each signature. Each member
goes there once, with its shingles, and the members of a group are compared in blocks; a block
gives the links of a spanning forest only. Equal sets are one class throughout. So the links
found have the same connected components as all links, and no list of pairs is made. Where the number of
links is asked for, or the pairs themselves, a pair belongs to the smallest centre that both sets have, and there to
one block; a block then counts the links of each member, or gives its pairs.

Defined results: A-Z are lower-cased; a text with fewer words than a shingle has its
whole sequence as its one shingle; a null text or one without words has none and is linked with
nothing; rows with equal sets are linked; repeated rows each give a row. A component is named by its
smallest id. A column to keep that has the name
of a result gives way to it; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from riskstream.llm.components import components
from riskstream.llm.filters import bloom_filter, may_contain
from riskstream.llm.kept import ROW, carried, restored
from riskstream.llm.words import U64, Words, mix, runs, slices
from riskstream.llm.workers import small_batches
from riskstream.session import stored

#: Sizes of a band are up to so many times its smallest.
BAND = 1.5
#: Parts of a group; more where sets are small, whose groups would say little otherwise.
PARTS, PARTS_SMALL, SMALL = 3, 6, 8
#: Members compared with each other at a time.
BLOCK = 1024
#: Texts that a task remembers, to skip exact copies.
REMEMBERED = 1 << 17


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``words`` words; similar from an intersection of ``share[0] / share[1]`` of the union on."""

    words: int = 5
    share: tuple[int, int] = (4, 5)

    def differences(self, sizes: int) -> int:
        """The most shingles in which two similar sets with ``sizes`` shingles together differ."""
        least, of = self.share
        return sizes * (of - least) // (of + least)

    def similar(self, common, sizes):
        least, of = self.share
        return common * of >= least * (sizes - common)

    def largest(self, size: int) -> int:
        """The size of the largest set that one of this size can be similar to."""
        return size * self.share[1] // self.share[0]

    def bands(self, size: int) -> list[tuple[int, int, int]]:
        """The bands a set takes part in: number, sizes from, up to."""
        out, number, low = [], 0, 1
        while low <= self.largest(size):
            high = max(low, int(low * BAND) - 1)
            if size <= high:
                out.append((number, low, high))
            number, low = number + 1, high + 1
        return out


class Shingles:
    """Distinct shingle hashes of each text of a batch, sorted."""

    def __init__(self, texts: pa.Array, length: int):
        words = Words(texts, lower=True)
        self.hashes, self.first, self.length = words.hashes(), words.first, length
        self.whole = runs(self.hashes, length)

    def __iter__(self) -> Iterator[np.ndarray]:
        for begin, end in zip(self.first[:-1].tolist(), self.first[1:].tolist()):
            if end - begin >= self.length:
                yield np.unique(self.whole[begin : end - self.length + 1])
            else:
                yield runs(self.hashes[begin:end], end - begin) if end > begin else np.zeros(0, U64)


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return np.array([mix(shingles + U64(1)).sum(dtype=U64), mix(shingles ^ U64(0x6A09E667F3BCC909)).sum(dtype=U64)], "<u8").tobytes()


def signatures(shingles: np.ndarray, similarity: Similarity) -> np.ndarray:
    """The signatures of a set (sorted hashes)."""
    size, out = len(shingles), []
    spread = np.concatenate([np.zeros(1, U64), np.cumsum(mix(shingles), dtype=U64)])
    for number, low, high in similarity.bands(size) if size else []:
        own = similarity.differences(size + min(high, similarity.largest(size)))
        if not own:
            continue  # only equal sets are similar
        most = similarity.differences(2 * high) // 2
        groups = most + 2
        parts = PARTS if most >= SMALL else PARTS_SMALL
        n = groups * parts
        place = ((shingles >> U64(32)) * U64(n)) >> U64(32)  # in order, as the hashes are
        edges = np.searchsorted(place, np.arange(n + 1).astype(U64))
        count = np.diff(edges).reshape(groups, parts)
        content = (spread[edges[1:]] - spread[edges[:-1]]).reshape(groups, parts)
        without, left = content.sum(axis=1, keepdims=True, dtype=U64) - content, count.sum(axis=1, keepdims=True) - count
        usable = np.cumsum((left > 0).all(axis=1))
        enough = usable[-1] > own // 2
        last = int(np.searchsorted(usable, own // 2 + 1)) + 1 if enough else groups
        name = np.arange(n, dtype=np.int64).reshape(groups, parts) + (number << 40)
        found = mix(mix(without + left.astype(U64)) ^ (name.astype(U64) * U64(0x9E3779B97F4A7C15)))[:last]
        out.append(found[left[:last] > 0] if enough else found.ravel())
    return np.unique(np.concatenate(out)) if out else np.zeros(0, U64)


def _signature_rows(df: DataFrame, similarity: Similarity) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for part in slices(batch):
                found, names = [], []
                for shingles in Shingles(part.column("text"), similarity.words):
                    key = set_key(shingles)
                    if not len(shingles) or key in seen:
                        continue
                    if len(seen) < REMEMBERED:
                        seen.add(key)
                    found.append(signatures(shingles, similarity))
                    names.append(key[:8])
                sets = np.repeat(np.frombuffer(b"".join(names), "<i8"), [len(x) for x in found])
                signed = np.concatenate([np.zeros(0, U64), *found]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(signed), pa.array(sets, pa.int64())], ["signature", "member"])

    return df.mapInArrow(sign, "signature long, member long")


def _sets(df: DataFrame, similarity: Similarity) -> DataFrame:
    """(member, key, shingles) of each set, once in a task."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for part in slices(batch):
                keys, sets = [], []
                for shingles in Shingles(part.column("text"), similarity.words):
                    key = set_key(shingles)
                    if len(shingles) and key not in seen:
                        if len(seen) < REMEMBERED:
                            seen.add(key)
                        keys.append(key)
                        sets.append(shingles.tobytes())
                member = np.frombuffer(b"".join(k[:8] for k in keys), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(member, pa.int64()), pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], ["key", "set_key", "shingles"])

    return df.mapInArrow(emit, "key long, set_key binary, shingles binary")


class Forest:
    """Union of members by their place."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, at: int) -> int:
        while self.up[at] != at:
            self.up[at] = at = self.up[self.up[at]]
        return at

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def in_common(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of these sets have in common."""
    sizes = np.array([len(s) for s in sets])
    hashes, which = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    hashes, column, times = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = times > 1
    which, column = which[shared[column]], (np.cumsum(shared) - 1)[column[shared[column]]]
    order = np.argsort(column, kind="stable")
    which, column = which[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for since in range(0, int(shared.sum()), 4096):
        some = slice(*np.searchsorted(column, [since, since + 4096]))
        holds = np.zeros((len(sets), 4096), np.float32)
        holds[which[some], column[some] - since] = 1
        common += holds @ holds.T
    return common.astype(np.int64)


def all_similar(sets: list[np.ndarray], similarity: Similarity) -> np.ndarray:
    """Which two of these sets are similar, as a matrix with the smaller place first."""
    sizes = np.array([len(s) for s in sets])
    return np.triu(similarity.similar(in_common(sets), sizes[:, None] + sizes[None, :]), 1)


def forest_links(sets: list[np.ndarray], similarity: Similarity) -> list[tuple[int, int]]:
    """Links of a spanning forest of the similar sets among these."""
    if len(sets) == 2:
        common = len(np.intersect1d(*sets, assume_unique=True))
        return [(0, 1)] if similarity.similar(common, len(sets[0]) + len(sets[1])) else []
    similar = all_similar(sets, similarity)
    forest = Forest(len(sets))
    return [(a, b) for a, b in np.argwhere(similar).tolist() if forest.join(a, b)]


def candidates(df: DataFrame, similarity: Similarity) -> DataFrame:
    """(member, centre): each set that shares a signature with a smaller one, and the smallest of that signature. ``df``: text."""
    signed = _signature_rows(df.select("text"), similarity)
    # The smallest member of a signature is its centre; a running minimum needs no group in memory.
    by_signature = Window.partitionBy("signature").orderBy("member").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    centred = signed.select("member", F.first("member").over(by_signature).alias("centre"))
    return stored(centred.where("member <> centre").distinct(), "candidates")


def _grouped(df: DataFrame, similarity: Similarity, pairs: DataFrame, copies: DataFrame | None = None) -> DataFrame:
    """(centre, x, y, set_key, shingles): the blocks of all groups of candidates. With copies (set_key, copies) also own, copies and centres, all those of the set."""
    # Few centres have more members than a block: stored, so that they are broadcast if they are few
    # enough, and else join in a way that splits a centre with very many.
    crowded = stored(pairs.groupBy("centre").agg((F.count(F.lit(1)) + 1).alias("n")).where(F.col("n") > BLOCK), "crowded")
    centres = pairs.select(F.col("centre").alias("member"), "centre").distinct()
    members = pairs.unionByName(centres).join(crowded, "centre", "left")
    blocks = F.coalesce(F.ceil(F.col("n") / BLOCK), F.lit(1))
    own = F.pmod(F.xxhash64("member", "centre"), blocks)
    other = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    members = members.withColumn("own", own).withColumn("other", other)
    members = members.select(F.col("member").alias("key"), "centre", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own")

    wanted = pairs.select("member").unionByName(pairs.select(F.col("centre").alias("member"))).select(F.xxhash64("member").alias("key"))
    # The filter is of a fixed size; whatever it lets pass, the join decides.
    sets = may_contain(_sets(df.select("text"), similarity).withColumn("__hash", F.xxhash64("key")), bloom_filter(wanted), "__hash")
    sets = sets.select("key", "set_key", "shingles")
    if copies is None:
        return members.join(sets, "key").select("centre", "x", "y", "set_key", "shingles")
    # as many as a set has signatures, at most
    lists = pairs.select("member", "centre").unionByName(centres).groupBy(F.col("member").alias("key")).agg(F.sort_array(F.collect_set("centre")).alias("centres"))
    sets = sets.join(copies, "set_key").join(lists, "key")
    return members.join(sets, "key").select("centre", "x", "y", "own", "set_key", "shingles", "copies", "centres")


def similar_links(df: DataFrame, similarity: Similarity, pairs: DataFrame | None = None) -> DataFrame:
    """Links (a, b) between set keys, with the same connected components as all links. ``df``: text; ``pairs``: its candidates, if they are there already."""
    grouped = _grouped(df, similarity, candidates(df, similarity) if pairs is None else pairs)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, keys, sets = None, [], []

        def links() -> pa.RecordBatch:
            found = forest_links(sets, similarity) if len(sets) > 1 else []
            return pa.RecordBatch.from_pydict({"a": [keys[a] for a, _ in found], "b": [keys[b] for _, b in found]}, LINKS)

        for batch in batches:
            for centre, x, y, key, data in zip(*(batch.column(c).to_pylist() for c in ("centre", "x", "y", "set_key", "shingles"))):
                if (centre, x, y) != at:
                    yield links()
                    at, keys, sets = (centre, x, y), [], []
                if not keys or keys[-1] != key:  # copies that several tasks have sent
                    keys.append(key)
                    sets.append(np.frombuffer(data, "<u8"))
        yield links()

    return grouped.repartition("centre", "x", "y").sortWithinPartitions("centre", "x", "y", "set_key").mapInArrow(compare, LINK_SCHEMA)


def _owned(block: list[tuple], centre: int, x: int, y: int, similarity: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """Places of the similar pairs of a block that belong to it: in no smaller centre, and in no other block of this one."""
    if len(block) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    own, _, sets, _, centres = zip(*block)
    similar = all_similar(list(sets), similarity)
    similar &= in_common([c[c < centre] for c in centres]) == 0
    if x != y:
        similar &= np.array(own)[:, None] != np.array(own)[None, :]
    return np.nonzero(similar)


def _owned_pairs(df: DataFrame, similarity: Similarity, copies: DataFrame, schema: str, give, pairs: DataFrame | None = None) -> DataFrame:
    """What ``give`` makes of each block and its pairs."""
    grouped = _grouped(df, similarity, candidates(df, similarity) if pairs is None else pairs, copies)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block = (0, 0, 0), []
        for batch in batches:
            for *where, own, key, data, n, centres in zip(*(batch.column(c).to_pylist() for c in ("centre", "x", "y", "own", "set_key", "shingles", "copies", "centres"))):
                if tuple(where) != at:
                    yield give(block, *_owned(block, *at, similarity))
                    at, block = tuple(where), []
                if not block or block[-1][1] != key:  # copies that several tasks have sent
                    block.append((own, key, np.frombuffer(data, "<u8"), n, np.array(centres, np.int64)))
        yield give(block, *_owned(block, *at, similarity))

    return grouped.repartition("centre", "x", "y").sortWithinPartitions("centre", "x", "y", "set_key").mapInArrow(compare, schema)


def _copies(df: DataFrame, similarity: Similarity) -> DataFrame:
    return _measured(df.select("text"), [], similarity).where("set_key IS NOT NULL").groupBy("set_key").agg(F.count(F.lit(1)).alias("copies"))


def similar_pairs(df: DataFrame, similarity: Similarity) -> DataFrame:
    """All similar pairs (a, b) of different sets, by their keys, a before b, each once. ``df``: text.

    Their number grows with the square of a group of near copies; :func:`link_counts` needs no such list.
    """

    small_batches(df.sparkSession)

    def give(block, a, b) -> pa.RecordBatch:
        keys = [row[1] for row in block]
        return pa.RecordBatch.from_pydict({"a": [keys[i] for i in a], "b": [keys[i] for i in b]}, LINKS)

    return _owned_pairs(df, similarity, stored(_copies(df, similarity), "copies"), LINK_SCHEMA, give)


def link_counts(df: DataFrame, similarity: Similarity, copies: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """set_key and links: the rows with another, similar set. ``copies``: set_key and the rows that have it."""

    def give(block, a, b) -> pa.RecordBatch:
        copies, links = np.array([row[3] for row in block], np.int64), np.zeros(len(block), np.int64)
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        some = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array([block[i][1] for i in some], pa.binary()), pa.array(links[some])], ["set_key", "links"])

    return _owned_pairs(df, similarity, copies, "set_key binary, links long", give, pairs).groupBy("set_key").agg(F.sum("links").alias("links"))


LINKS = pa.schema([("a", pa.binary()), ("b", pa.binary())])
LINK_SCHEMA = "a binary, b binary"


def _measured(rows: DataFrame, kept: list[str], similarity: Similarity) -> DataFrame:
    """The columns kept, n_shingles and set_key (null without shingles) of each text."""
    schema = StructType([*(rows.schema[c] for c in kept), StructField("n_shingles", LongType()), StructField("set_key", BinaryType())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                n, keys = [], []
                for shingles in Shingles(part.column("text"), similarity.words):
                    n.append(len(shingles))
                    keys.append(set_key(shingles) if len(shingles) else None)
                columns = [pa.array(n, pa.int64()), pa.array(keys, pa.binary())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *columns], [*kept, "n_shingles", "set_key"])

    return rows.mapInArrow(measure, schema)


def similar_documents(df: DataFrame, similarity: Similarity, keep: list[str], text: str = "text", order: str = "doc_id", links: bool = False) -> DataFrame:
    """n_shingles, component_id and component (a key that only its rows have; null without shingles) of each text next to the columns to keep.

    With ``links`` also n_links, the number of other rows whose sets are equal or similar.
    """
    small_batches(df.sparkSession)
    results = ["n_shingles", "component_id", "component", *(["n_links"] if links else [])]
    kept, row = carried(keep, results)
    rows = df.select(row, F.col(order).alias("__order"), F.col(text).alias("text"))
    measured = stored(_measured(rows, [ROW, "__order"], similarity), "shingle-sets")
    of_class = [F.min("__order").alias("first"), *([F.count(F.lit(1)).alias("copies")] if links else [])]
    classes = stored(measured.where("set_key IS NOT NULL").groupBy("set_key").agg(*of_class), "shingle-classes")
    pairs = candidates(rows, similarity)  # signed once, for components and counts
    joined = components(similar_links(rows, similarity, pairs))
    named = classes.join(joined.withColumnRenamed("node", "set_key"), "set_key", "left").withColumn("component", F.coalesce("component", "set_key"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    ids = named.join(least, "component").select("set_key", "component", "component_id", *(["copies"] if links else []))
    more = []
    if links:
        counts = link_counts(rows, similarity, classes.select("set_key", "copies"), pairs)
        ids = ids.join(counts, "set_key", "left").withColumn("n_links", F.col("copies") - 1 + F.coalesce("links", F.lit(0)))
        more = [F.coalesce("n_links", F.lit(0)).alias("n_links")]
    found = measured.join(ids, "set_key", "left")
    found = found.select(ROW, "n_shingles", F.coalesce("component_id", "__order").alias("component_id"), "component", *more)
    return restored(found, kept, results)

"""Byte-level BPE encoding and decoding of whole texts, by overlapping chunks.

Texts are cut into chunks that overlap. Every chunk is pre-tokenised by itself, from
wherever it begins; two neighbours are stitched at the first pre-token boundary that
both have inside their overlap: from there they agree for good, as a match depends
only on what follows it. The pieces between two stitches are encoded, and the ids of
a text put in order. Decoding concatenates the bytes of the ids. So one very long
text is the work of many tasks; a text of one chunk has nothing to stitch and is
encoded where it is read.

Defined results: a null text counts as empty; an empty text has no ids; repeated rows
each give a row; an empty table gives an empty result. Rows keep the columns asked
for, under their names; one that has the name of a result gives way to it.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from riskstream.llm.kept import ROW, carried, restored
from riskstream.llm.pretokens import boundaries, pretokens
from riskstream.llm.workers import held, small_batches
from riskstream.session import stored

#: Characters of a chunk, and how many of the next chunk it also covers.
CHUNK, OVERLAP = 1 << 16, 1 << 10
#: Pre-tokens whose ids a Python worker keeps.
REMEMBERED = 200_000


class Vocabulary:
    """Ranks of byte sequences (lines of base64 and rank) and the pattern of pre-tokens.

    It travels to the executors as its file's content, a fixed size, and is built once in each Python worker.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.content = file.read()
        self.pattern = pattern

    def built(self) -> Codec:
        return held(self, Vocabulary._codec)

    def _codec(self) -> Codec:
        lines = map(bytes.split, self.content.splitlines())
        return Codec({base64.b64decode(token): int(rank) for token, rank in lines}, self.pattern)


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import tiktoken

        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("own", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.known: dict[str, bytes] = {}

    def _ids(self, pretoken: str) -> bytes:
        found = np.array(self.encoding.encode_ordinary(pretoken), "<u4").tobytes()
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        if len(pretoken) < 100:
            self.known[pretoken] = found
        return found

    def encode(self, piece: str) -> bytes:
        """The ids of a piece that begins and ends at boundaries, as little-endian unsigned 32-bit integers."""
        known, own, out = self.known.get, self._ids, []
        for found in pretokens(self.pattern.findall, piece):
            out.append(b"".join([known(x) or own(x) for x in found]))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def boundaries(self, chunk: str, last: bool) -> np.ndarray:
        """Where matches surely end."""
        return np.fromiter(boundaries(self.pattern.findall, chunk, last), np.int64)


def public_vocabulary(name: str) -> Vocabulary:
    """A vocabulary of the installed package of public tokenizers."""
    import public_tokenizers

    return Vocabulary(public_tokenizers.path(name), public_tokenizers.PATTERN)


def encode(df: DataFrame, vocabulary: Vocabulary, keep: list[str], text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP, decoded: bool = False) -> DataFrame:
    """The ids of each text (``ids``, little-endian unsigned 32-bit integers) next to the columns to keep.

    With ``decoded``, also the bytes that the ids stand for, as :func:`decode` gives them, from
    the same Python workers instead of a second set of them.
    """
    sent = small_batches(df.sparkSession).sparkContext.broadcast(vocabulary)
    made = ["ids", "decoded"] if decoded else ["ids"]
    kept, row = carried(keep, made)
    rows = df.select(row, F.coalesce(F.col(text), F.lit("")).alias("text"))
    long = F.length("text") > chunk
    schema = StructType([rows.schema[ROW], *(StructField(c, BinaryType()) for c in made)])

    def encode_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = sent.value.built()
        for batch in batches:
            ids = pa.array((codec.encode(x.as_py()) for x in batch.column("text")), pa.binary())
            columns = [ids, pa.array((codec.decode(x.as_py()) for x in ids), pa.binary())][: len(made)]
            yield pa.RecordBatch.from_arrays([batch.column(ROW), *columns], [ROW, *made])

    short = rows.where(~long).mapInArrow(encode_whole, schema)
    keyed = rows.where(long).withColumn("key", F.sha2("text", 256))
    ids = _encode_long(keyed.select("key", "text").dropDuplicates(["key"]), sent, chunk, overlap)
    if decoded:
        ids = decode(ids, vocabulary, ["key", "ids"], of="ids")
    return restored(short.unionByName(keyed.drop("text").join(ids, "key").select(ROW, *made)), kept, made)


def _seams(chunks: DataFrame, sent, overlap: int) -> DataFrame:
    """(key, at, size, since, until) of chunks (key, at, size, last, text): where the piece of each begins and ends.

    ``until`` is null where a chunk and the next one share no boundary.
    """

    def pretokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The boundaries of each chunk that its neighbours may share, as places in the text."""
        codec = sent.value.built()
        for batch in batches:
            head, tail = [], []
            for x, at, size, last in zip(*(batch.column(c).to_pylist() for c in ("text", "at", "size", "last"))):
                ends = codec.boundaries(x, last)
                head.append(ends[ends < overlap] + at)
                tail.append(ends[ends >= size] + at)
            found = [pa.array(side, pa.list_(pa.int64())) for side in (head, tail)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "at", "size", "last")), *found], ["key", "at", "size", "last", "head", "tail"])

    ends = chunks.mapInArrow(pretokenise, "key string, at long, size long, last boolean, head array<long>, tail array<long>")
    order = Window.partitionBy("key").orderBy("at")
    shared = F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
    until = F.when(F.col("last"), F.col("at") + F.col("size")).otherwise(shared)
    stitched = ends.select("key", "at", "size", "last", until.alias("until"))
    return stitched.withColumn("since", F.coalesce(F.lag("until").over(order), "at"))


def _encode_long(texts: DataFrame, sent, size: int, overlap: int) -> DataFrame:
    """(key, ids) of long texts, by chunks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, x in zip(batch.column("key").to_pylist(), batch.column("text")):
                x = x.as_py()
                for at in range(0, len(x), size):
                    row = {"key": [key], "at": [at], "size": [min(size, len(x) - at)], "last": [at + size >= len(x)], "text": [x[at : at + size + overlap]]}
                    yield pa.RecordBatch.from_pydict(row, ARROW_CHUNK)

    def encode_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = sent.value.built()
        for batch in batches:
            ids = pa.array((codec.encode(x.as_py()) for x in batch.column("piece")), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("since"), ids], ["key", "since", "ids"])

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pieces of a text come one after another."""
        key, parts = None, []
        for batch in batches:
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids")):
                if k != key:
                    if key is not None:
                        yield pa.RecordBatch.from_pydict({"key": [key], "ids": [b"".join(parts)]}, ARROW_IDS)
                    key, parts = k, []
                parts.append(ids.as_py())
        if key is not None:
            yield pa.RecordBatch.from_pydict({"key": [key], "ids": [b"".join(parts)]}, ARROW_IDS)

    chunks = texts.mapInArrow(cut, "key string, at long, size long, last boolean, text string").repartition("key", "at")
    seams = stored(_seams(chunks, sent, overlap), "seams")
    while not seams.where("until IS NULL").isEmpty():
        # chunks that share no boundary become one; a row a chunk, without texts
        order = Window.partitionBy("key").orderBy("at")
        begins = F.coalesce(F.lag(F.col("until").isNotNull()).over(order), F.lit(True))
        first = F.max(F.when(F.col("begins"), F.col("at"))).over(order)
        merged = seams.withColumn("begins", begins).withColumn("first", first).groupBy("key", F.col("first").alias("at")).agg(F.sum("size").alias("size"), F.bool_or("last").alias("last"))
        chunks = _substrings(merged.join(texts, "key"), F.col("at"), F.col("at") + F.col("size") + overlap, "text").select("key", "at", "size", "last", "text")
        seams = stored(_seams(chunks.repartition("key", "at"), sent, overlap), "seams")
    pieces = seams.where("until > since").select("key", "since", "until").join(texts, "key")
    pieces = _substrings(pieces, F.col("since"), F.col("until"), "piece").select("key", "since", "piece").repartition("key", "since")
    ids = pieces.mapInArrow(encode_pieces, "key string, since long, ids binary")
    return ids.repartition("key").sortWithinPartitions("key", "since").mapInArrow(in_order, "key string, ids binary")


def _substrings(rows: DataFrame, since: Column, until: Column, name: str) -> DataFrame:
    return rows.withColumn(name, F.substring("text", (since + 1).cast("int"), (until - since).cast("int")))


ARROW_CHUNK = pa.schema([("key", pa.string()), ("at", pa.int64()), ("size", pa.int64()), ("last", pa.bool_()), ("text", pa.string())])
ARROW_IDS = pa.schema([("key", pa.string()), ("ids", pa.binary())])


def decode(df: DataFrame, vocabulary: Vocabulary, keep: list[str], of: str = "ids") -> DataFrame:
    """The bytes that ids stand for (``decoded``) next to the columns to keep. Null ids stand for nothing."""
    sent = small_batches(df.sparkSession).sparkContext.broadcast(vocabulary)
    kept, row = carried(keep, ["decoded"])
    rows = df.select(row, F.coalesce(F.col(of), F.lit(b"")).alias("ids"))
    schema = StructType([rows.schema[ROW], StructField("decoded", BinaryType())])

    def decode_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = sent.value.built()
        for batch in batches:
            out = pa.array((codec.decode(x.as_py()) for x in batch.column("ids")), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(ROW), out], [ROW, "decoded"])

    return restored(rows.mapInArrow(decode_all, schema), kept, ["decoded"])


def digests(df: DataFrame, vocabulary: Vocabulary, keep: list[str], text: str = "text", **more) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of texts, next to the columns to keep; ``more`` is for :func:`encode`."""
    made = ["n_tokens", "ids_sha256", "decoded_sha256"]
    kept, row = carried(keep, made)
    rows = encode(df.select(row, F.col(text).alias("text")), vocabulary, [ROW], decoded=True, **more)
    n = (F.octet_length("ids") / 4).cast("long")
    columns = [n.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")]
    return restored(rows.select(ROW, *columns), kept, made)

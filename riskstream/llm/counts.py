"""Token counts of whole texts by merging byte pairs with a heap and a linked list.

A pre-token starts as its bytes. The lowest-ranked adjacent pair is popped and
merged until no pair has a rank; the count is the number of first symbols less the
number of merges, so that no ids are made. Special strings inside a text count as
one token each and split it.

Defined results: a null text counts as empty and has 0 tokens; repeated rows each
give a row; an empty table gives an empty result. A column to keep that has the name
of a result gives way to it; other columns may have any name.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from riskstream.llm.kept import ROW, carried, restored
from riskstream.llm.pretokens import pretokens
from riskstream.llm.workers import held, small_batches

#: Pre-tokens whose counts a Python worker keeps.
REMEMBERED = 400_000
#: Up to here, the pattern's letters and numbers are the same in all Unicode versions.
SETTLED = "԰"


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if it can be seen, else the next one from 256 on."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(hidden)) for b in range(256)]


class Merges:
    """The merges of a tokenizer file (its content, of fixed size), built once in each Python worker."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            self.content = file.read()
        self.pattern = pattern

    def built(self) -> Counter:
        return held(self, lambda merges: Counter(merges.content, merges.pattern))


class Counter:
    def __init__(self, content: str, pattern: str):
        from tokenizers import Tokenizer

        parts = json.loads(content)
        ids: dict[str, int] = parts["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in parts["model"]["merges"]]
        #: pair of symbols, as one number -> (rank, merged symbol)
        self.merged = {ids[a] << 20 | ids[b]: (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.first = [ids[symbol] for symbol in byte_symbols()]
        special = [regex.escape(t["content"]) for t in parts["added_tokens"]]
        self.special = regex.compile("|".join(special)) if special else None
        self.find = regex.compile(pattern).findall
        self.library = Tokenizer.from_str(content).pre_tokenizer
        self.known: dict[str, int] = {}

    def merge(self, pretoken: str) -> int:
        """The number of tokens of a pre-token."""
        symbols = [self.first[b] for b in pretoken.encode()]
        n, merged = len(symbols), self.merged.get
        if n < 2:
            return n
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for at in range(n - 1):
            if found := merged(symbols[at] << 20 | symbols[at + 1]):
                heap.append((found[0], at, found[1]))
        heapify(heap)
        left = n
        while heap:
            rank, at, symbol = heappop(heap)
            right = after[at]
            # a pair of which a side has been merged meanwhile is no more
            if right >= n or symbols[at] < 0 or merged(symbols[at] << 20 | symbols[right], (-1,))[0] != rank:
                continue
            symbols[at], symbols[right] = symbol, -1
            behind = after[at] = after[right]
            left -= 1
            if behind < n:
                before[behind] = at
                if found := merged(symbol << 20 | symbols[behind]):
                    heappush(heap, (found[0], at, found[1]))
            if (ahead := before[at]) >= 0 and (found := merged(symbols[ahead] << 20 | symbol)):
                heappush(heap, (found[0], ahead, found[1]))
        return left

    def _count(self, pretoken: str) -> int:
        n = self.merge(pretoken)
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        if len(pretoken) < 100:
            self.known[pretoken] = n
        return n

    def _pretokens(self, text: str) -> Iterator[list[str]]:
        if max(text, default="") < SETTLED:
            return pretokens(self.find, text)
        return pretokens(lambda x: [x[a:b] for _, (a, b) in self.library.pre_tokenize_str(x)], text)

    def count(self, text: str) -> int:
        known, own, total = self.known.get, self._count, 0
        parts = [text]
        if self.special:
            parts = self.special.split(text)
            total = len(parts) - 1
        for part in parts:
            for found in self._pretokens(part):
                total += sum([known(x) or own(x) for x in found])
        return total


def public_merges(name: str) -> Merges:
    """The merges of a file of the installed package of public tokenizers."""
    import public_tokenizers

    return Merges(public_tokenizers.path(name), public_tokenizers.PATTERN)


def token_counts(df: DataFrame, merges: Merges, keep: list[str], text: str = "text") -> DataFrame:
    """n_bytes and n_tokens of each text next to the columns to keep."""
    sent = small_batches(df.sparkSession).sparkContext.broadcast(merges)
    body = F.coalesce(F.col(text), F.lit(""))
    results = ["n_bytes", "n_tokens"]
    kept, row = carried(keep, results)
    rows = df.select(row, F.octet_length(body).cast("long").alias("n_bytes"), body.alias("text"))
    schema = StructType([rows.schema[ROW], *(StructField(c, LongType()) for c in results)])

    def count_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = sent.value.built()
        for batch in batches:
            n = pa.array((counter.count(x.as_py()) for x in batch.column("text")), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(ROW), batch.column("n_bytes"), n], [ROW, *results])

    return restored(rows.mapInArrow(count_all, schema), kept, results)

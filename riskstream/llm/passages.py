"""Removal of passages that recur, by automata of the recurring phrases.

A window is WINDOW consecutive words of one text. Every word is removed that a window
covers whose words also start anywhere else, in the same text or another.

Each window has an anchor, the run of GRAM words in it with the lowest hash, so equal
windows have equal anchors. Consecutive windows with one anchor form a stretch, and only
stretches whose anchor occurs twice can hold a recurring window. Of these, each
distinct stretch is sent once, as text, to the shard of its anchor. A shard confirms which
windows recur by comparing words, compiles the recurring phrases (maximal
runs of such windows) to Aho-Corasick automata over words, and streams its stretches through
them to locate every occurrence; located phrases go back to all documents that have
the stretch. Texts are read whole at each step.

An anchor that holds more than a fixed share of all stretches is hot: there are few such,
as a share bounds their number, and their stretches are sent window by window under
the window's own hash, so that equal windows are combined and different ones spread.

Defined results: words are kept as they are; a null text has no words; a text shorter than
a window loses nothing; repeated rows are occurrences like any other, so that a repeated text
of a window or more is removed whole; an empty table gives an empty result. A column to keep that has the name
of a result gives way to it; other columns may have any name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from riskstream.llm.filters import bloom_filter, may_contain
from riskstream.llm.kept import ROW, carried, restored
from riskstream.llm.words import U64, Words, mix, powers, runs, slices
from riskstream.llm.workers import small_batches
from riskstream.session import stored

#: Words of a window and of an anchor.
WINDOW, GRAM = 35, 8
#: An anchor is hot from this many stretches on, and from this share of all: one in HOT_SHARE.
HOT, HOT_SHARE = 4096, 10_000_000
#: Bits that tell apart the places of a window's anchors; more places than a window has, however long the text.
PLACE_BITS = 24
#: Stretches in one automaton, about.
CHUNK = 4096

#: Different words for which one character each is enough.
ONE_CHARACTER = 1_000_000

_BASE = U64(0x9E3779B97F4A7C15)
_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))


class Stretches:
    """The stretches of a batch of texts: text, first window (its first word's place in the text), number of windows, anchor hash and own hash."""

    def __init__(self, texts: pa.Array, window: int):
        words = Words(texts)
        hashes, n = words.hashes(), len(words)
        gram = min(GRAM, window)
        span = window - gram + 1
        text_of = np.repeat(np.arange(len(texts)), np.diff(words.first))
        grams = runs(hashes, gram)
        self.hashes, self.window = hashes, window
        if n < window:
            valid = np.zeros(0, np.int64)
        else:
            valid = np.flatnonzero(text_of[: n - window + 1] == text_of[window - 1 :])
        places = U64((1 << PLACE_BITS) - 1)
        # the lowest hash, and of equal ones the first: the place takes the low bits, and begins anew when they are full
        least, width = (grams & ~places) | (np.arange(len(grams)).astype(U64) & places), 1
        while width * 2 <= span:
            least, width = np.minimum(least[:-width], least[width:]), width * 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        anchor = valid + (((least[valid] & places).astype(np.int64) - valid) & int(places))
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text_of[valid[1:]] != text_of[valid[:-1]])]) if len(valid) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        self.windows = np.diff(np.concatenate([first, [len(valid)]]))
        self.begin = valid[first]  # place in the batch
        self.text = text_of[self.begin]
        self.at = self.begin - words.first[self.text]
        self.anchor = grams[anchor[first]]
        power = powers(_BASE, n + 1)
        total = np.concatenate([np.zeros(1, U64), np.cumsum((hashes + U64(1)) * power[:n], dtype=U64)])
        inverse = powers(_INVERSE, n + 1)
        end = self.begin + self.windows + window - 1
        self.own = mix((total[end] - total[self.begin]) * inverse[self.begin] + self.windows.astype(U64))

    def spread(self, hot: np.ndarray) -> tuple[np.ndarray, ...]:
        """text, at, windows, key, own and whether a window stands by itself; the stretches of hot anchors by window."""
        at = np.minimum(np.searchsorted(hot, self.anchor), max(len(hot) - 1, 0))
        is_hot = hot[at] == self.anchor if len(hot) else np.zeros(len(at), bool)
        times = np.where(is_hot, self.windows, 1)
        which = np.repeat(np.arange(len(times)), times)
        step = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
        alone = is_hot[which]
        key, own, windows = self.anchor[which], self.own[which], np.where(alone, 1, self.windows[which])
        if alone.any():
            by_window = mix(runs(self.hashes, self.window)[(self.begin[which] + step)[alone]])
            key[alone], own[alone] = by_window, by_window
        return self.text[which], (self.at[which] + step), windows, key, own, alone


def _key(text: str, order: str) -> list:
    """128 bits that stand for a row: equal rows share them."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(order, text).alias("k2")]


def _anchors(docs: DataFrame, window: int) -> tuple[DataFrame, np.ndarray]:
    """(key) of the anchors that occur twice, and the hot ones, sorted: HOT_SHARE numbers at most, 80 MB."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                keys, n = np.unique(Stretches(part.column("text"), window).anchor, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])

    counted = docs.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    twice = stored(counted.where("n > 1"), "anchors")
    total = twice.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = twice.where((F.col("n") > HOT) & (F.col("n") * HOT_SHARE > total)).select("key").toArrow()
    return twice.select("key"), np.sort(hot.column("key").to_numpy().view(np.uint64))


def _occurrences(docs: DataFrame, window: int) -> DataFrame:
    """(key, own, k1, k2, at, windows) of every stretch that may hold a recurring window."""
    twice, hot = _anchors(docs, window)
    sent = docs.sparkSession.sparkContext.broadcast(hot)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                text, at, windows, key, own, alone = Stretches(part.column("text"), window).spread(sent.value)
                ids = [part.column(c).take(pa.array(text)) for c in ("k1", "k2")]
                columns = [pa.array(key.view(np.int64)), pa.array(own.view(np.int64)), *ids, pa.array(at.astype(np.int32)), pa.array(windows.astype(np.int32)), pa.array(alone)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "own", "k1", "k2", "at", "windows", "alone"])

    found = docs.mapInArrow(emit, "key long, own long, k1 long, k2 long, at int, windows int, alone boolean")
    # The filter is of a fixed size; whatever it lets pass, the join decides.
    blocks = bloom_filter(twice.select(F.xxhash64("key").alias("key")))
    asked = found.withColumn("__hash", F.xxhash64("key"))
    likely = may_contain(asked.where("NOT alone"), blocks, "__hash").drop("__hash")
    anchored = likely.join(twice, "key", "left_semi")
    return anchored.unionByName(found.where("alone")).drop("alone")


def _texts(docs: DataFrame, occurrences: DataFrame, window: int) -> DataFrame:
    """(key, own, n, text) of each distinct stretch: how often it occurs, and its words."""
    one = F.min(F.struct("k1", "k2", "at", "windows")).alias("one")
    distinct = occurrences.groupBy("key", "own").agg(F.count(F.lit(1)).alias("n"), one).select("key", "own", "n", "one.*")
    wanted = stored(distinct.groupBy("k1", "k2").agg(F.collect_list(F.struct("key", "own", "n", "at", "windows")).alias("wanted")), "stretches")
    held = may_contain(docs.withColumn("__hash", F.xxhash64("k1", "k2")), bloom_filter(wanted.select(F.xxhash64("k1", "k2").alias("key"))), "__hash").drop("__hash")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"))
                lists = part.column("wanted")
                entries = lists.flatten()
                which = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                at = words.first[which] + entries.field("at").to_numpy()
                end = at + entries.field("windows").to_numpy() + window - 2
                since, until = words.start[at].tolist(), words.end[end].tolist()
                data = words.data.tobytes()
                texts = pa.array([data[a:b] for a, b in zip(since, until)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(entries.field(c) for c in ("key", "own", "n")), texts], ["key", "own", "n", "text"])

    # repeated rows send their stretches more than once; a shard takes equal ones as one
    return held.join(wanted, ["k1", "k2"]).select("text", "wanted").mapInArrow(cut, "key long, own long, n long, text binary")


def recurring_runs(stretches: list[tuple[int, str]], window: int, step: int = 1) -> Iterator[str]:
    """The maximal runs of windows that occur twice or more in (times, words) with one anchor.

    ``window`` and ``step``, that of a word, are in characters.
    """
    if len(stretches) == 1:
        times, words = stretches[0]
        if times > 1:
            yield words
            return
    seen: Counter = Counter()
    for times, words in stretches:
        for i in range(0, len(words) - window + 1, step):
            seen[words[i : i + window]] += times
    for _, words in stretches:
        since = None
        for i in range(0, len(words) - window + step + 1, step):
            if i + window <= len(words) and seen[words[i : i + window]] > 1:
                since = i if since is None else since
            elif since is not None:
                yield words[since : i + window - step]
                since = None


def _spelled(texts: list[bytes]) -> tuple[list[str], int]:
    """Texts with a character for each word, or two from different ranges if one can't tell them all apart."""
    numbers: dict[bytes, int] = {}
    numbered = [[numbers.setdefault(word, len(numbers)) for word in text.split()] for text in texts]
    free = 0x100  # no surrogates: numbers from 0xD700 on are moved behind them
    if len(numbers) <= ONE_CHARACTER:
        return ["".join([chr(n + (free if n < 0xD700 else 0x900)) for n in text]) for text in numbered], 1
    return ["".join([chr(free + (n >> 14)) + chr(0x20000 + (n & 0x3FFF)) for n in text]) for text in numbered], 2


def locate(stretches: list[tuple[int, int, int, bytes]], window: int) -> Iterator[tuple[int, int, int, int]]:
    """Where recurring phrases lie in (key, own, n, text), whole anchors in order: (key, own, from, to) in words."""
    texts, step = _spelled([text for _, _, _, text in stretches])
    automaton, known, group = ahocorasick.Automaton(), set(), []
    for i, (key, _, n, _) in enumerate(stretches):
        group.append((n, texts[i]))
        if i + 1 == len(stretches) or stretches[i + 1][0] != key:
            for phrase in recurring_runs(group, window * step, step):
                if phrase not in known:
                    known.add(phrase)
                    automaton.add_word(phrase, len(phrase))
            group = []
    if not known:
        return
    automaton.make_automaton()
    for (key, own, _, _), text in zip(stretches, texts):
        spans = sorted((end + 1 - length, end + 1) for end, length in automaton.iter(text))
        since = until = -1
        for a, b in spans:
            if a > until:
                if until > 0:
                    yield key, own, since // step, until // step
                since, until = a, b
            until = max(until, b)
        if until > 0:
            yield key, own, since // step, until // step


def _located(texts: DataFrame, window: int) -> DataFrame:
    """(key, own, since, until): where phrases lie in each distinct stretch."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []

        def found() -> pa.RecordBatch:
            columns = list(zip(*locate(held, window))) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "own", "since", "until"])

        for batch in batches:
            for key, own, n, text in zip(*(batch.column(c).to_pylist() for c in ("key", "own", "n", "text"))):
                if held and held[-1][:2] == (key, own):
                    continue
                if len(held) >= CHUNK and held[-1][0] != key:
                    yield found()
                    held = []
                held.append((key, own, n, text))
        if held:
            yield found()

    return texts.repartition("key").sortWithinPartitions("key", "own").mapInArrow(search, "key long, own long, since int, until int")


def remove_passages(df: DataFrame, keep: list[str], window: int = WINDOW, text: str = "text", order: str = "doc_id", joined: bool = True) -> DataFrame:
    """n_words, n_removed and kept_text of each text next to the columns to keep.

    What is left is joined by blanks; unless ``joined``, a text that loses nothing is left as it is.
    """
    small_batches(df.sparkSession)
    results = ["n_words", "n_removed", "kept_text"]
    kept, row = carried(keep, results)
    rows = df.select(row, *_key(text, order), F.col(text).alias("text"))
    docs = rows.select("k1", "k2", "text")
    occurrences = stored(_occurrences(docs, window), "occurrences")
    located = _located(_texts(docs, occurrences, window), window)
    spans = occurrences.join(located, ["key", "own"]).select("k1", "k2", (F.col("at") + F.col("since")).alias("since"), (F.col("at") + F.col("until")).alias("until"))
    spans = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("since", "until")).alias("spans"))
    schema = StructType([rows.schema[ROW], StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_text", StringType())])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                n, gone, left = [], [], []
                for body, found in zip(part.column("text"), part.column("spans")):
                    words = (body.as_py() or "").encode().split()
                    n.append(len(words))
                    if found.is_valid:
                        change = np.zeros(len(words) + 1, np.int32)
                        np.add.at(change, found.values.field("since").to_numpy(), 1)
                        np.add.at(change, found.values.field("until").to_numpy(), -1)
                        keep_word = np.cumsum(change[:-1]) == 0
                        words = list(compress(words, keep_word.tolist()))
                    gone.append(n[-1] - len(words))
                    left.append(b" ".join(words) if joined or gone[-1] else (body.as_py() or "").encode())
                columns = [pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(left, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([part.column(ROW), *columns], [ROW, *results])

    left = rows.join(spans, ["k1", "k2"], "left").select(ROW, "text", "spans").mapInArrow(remove, schema)
    return restored(left, kept, results)

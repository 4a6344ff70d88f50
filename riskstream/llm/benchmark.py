"""Benchmark decontamination by q-gram filtering in diagonal bands and banded alignment.

Benchmark items are cut into overlapping regions. A text holds a region if a stretch
of it differs by at most the region's edit budget, a share of its length. By the
q-gram lemma such a stretch shares at least n - q + 1 - q * budget character q-grams
with a region of n characters, on diagonals (place in the text less place in the
region) no further apart than the budget. So shared q-grams are counted in overlapping
bands of diagonals, each twice as wide as the budget; bands that reach the bound are kept
and verified by an alignment inside the band. Characters are UTF-8 bytes, A-Z as a-z
and all white space as blanks.

Of a text that holds no region of an item, every passage of PASSAGE characters of the item, at whatever
place it begins, is searched by the same lemma: q-grams are indexed once at their places in the item, and
where enough of a band lie within the length of a passage, the passages there are aligned. So an
excerpt that covers no whole region is found, and an item of which a word in the middle is replaced. The
pair of text and item then has one row, the passage with the fewest edits.

Texts are read once and whole, next to an index of the benchmark, which is sent to the
executors in blocks of bounded size: a larger benchmark takes one pass a block.

Defined results: null and empty texts hold nothing; an item shorter than SHORTEST
characters is held by nothing, unless ``short`` items are asked for: then by a text that holds all of it, between
the ends of words and without edits, and by nothing if it is blank; items with equal regions
are all found; a null item is left out; repeated rows each give their rows; with an empty
benchmark nothing is found. A column to keep that has the name
of a result gives way to it; other columns may have any name.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from riskstream.llm.kept import ROW, carried, restored
from riskstream.llm.words import U64, mix, slices, text_bytes
from riskstream.llm.workers import held, small_batches

#: Characters of a region, and from one to the next of an item.
REGION, STRIDE = 96, 48
#: Characters of the shortest excerpt that is found.
PASSAGE = 44
#: Length of a q-gram, edits allowed as a share of a region's length, characters of the shortest item.
Q, EDITS, SHORTEST = 12, 0.05, 32
#: Characters of benchmark text in one block of the index.
BLOCK = 4 << 20
#: Bits of an address in the table that tells quickly that a q-gram isn't in the index.
TABLE_BITS = 22
#: Alignments done side by side.
SIDE_BY_SIDE = 4096

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[0x09:0x0E] = 0x20
_OUTSIDE = 255  # no byte of UTF-8
#: Bytes of words, after folding, and a random number for each byte.
_WORD = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
_SPREAD = mix(np.arange(1, 257, dtype=U64))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the Q bytes from each place on."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, U64)
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    eight = np.empty(len(data) + 8, U64)
    for k in range(8):
        part = np.frombuffer(padded[k : k + (len(padded) - k) // 8 * 8].tobytes(), "<u8")
        eight[k::8] = part[: len(eight[k::8])]
    return eight[:n] * U64(0x9E3779B97F4A7C15) + (eight[Q - 8 : Q - 8 + n] ^ U64(0x5851F42D4C957F2D)) * U64(0xC2B2AE3D27D4EB4F)


def align(regions: np.ndarray, texts: np.ndarray, lengths: np.ndarray, anchored: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The least edits between each region and a stretch of its text along a band, and the diagonal on which the stretch ends.

    ``texts`` holds for each pair the text from the band's lowest diagonal on, as many characters wider
    than the regions as the band is wide. A stretch may begin on any diagonal, or on ``anchored``.
    """
    pairs, longest = regions.shape
    width = texts.shape[1] - longest + 1
    across = np.arange(width)
    cost = np.zeros((pairs, width), np.int32)
    if anchored is not None:
        cost = np.abs(across - anchored[:, None]).astype(np.int32) + np.where(across < anchored[:, None], 1 << 20, 0)
    best, where = np.full(pairs, 1 << 20, np.int32), np.zeros(pairs, np.int64)
    for row in range(longest + 1):
        if row:
            step = cost + (regions[:, row - 1 : row] != texts[:, row - 1 : row - 1 + width])
            step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
            cost = np.minimum.accumulate(step - across, axis=1) + across
        if (done := lengths == row).any():
            where[done] = cost[done].argmin(axis=1)
            best[done] = cost[done].min(axis=1)
    return best, where


class Index:
    """The q-grams of the regions of some items."""

    def __init__(self, items: list[tuple[int, str]]):
        regions: defaultdict[bytes, list[int]] = defaultdict(list)
        whole: defaultdict[bytes, list[int]] = defaultdict(list)
        short: defaultdict[bytes, list[int]] = defaultdict(list)
        for item, text in items:
            data = _FOLD[np.frombuffer(text.encode(), np.uint8)].tobytes()
            if len(data) < SHORTEST:
                if data.strip(b" "):
                    short[data.strip(b" ")].append(item)
                continue
            whole[data].append(item)
            last = max(0, len(data) - REGION)
            for at in sorted({*range(0, last + 1, STRIDE), last}):
                regions[data[at : at + REGION]].append(item)
        self.short = dict(short)
        sums: defaultdict[int, list[int]] = defaultdict(list)
        for data in short:
            sums[len(data)].append(sum(_SPREAD[list(data)].tolist()) & (2**64 - 1))
        self.short_sums = {length: np.array(x, U64) for length, x in sums.items()}
        self.items = list(regions.values())
        self.lengths = np.array([len(r) for r in regions], np.int64)
        self.budgets = (self.lengths * EDITS).astype(np.int64)
        self.bounds = self.lengths - Q + 1 - Q * self.budgets
        self.bytes = np.full((len(regions), REGION), _OUTSIDE - 1, np.uint8)
        for k, data in enumerate(regions):
            self.bytes[k, : len(data)] = np.frombuffer(data, np.uint8)
        self.hashes, self.region, self.place = self._grams(regions)
        # items long enough to have passages, one after another
        long = [data for data in whole if len(data) >= PASSAGE]
        self.whole = [whole[data] for data in long]
        self.text = np.frombuffer(b"".join(long), np.uint8)
        self.begin = np.concatenate([[0], np.cumsum([len(data) for data in long])]).astype(np.int64)
        self.item_hashes, self.item, self.item_place = self._grams(long)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self._address(self.hashes)] = True

    @staticmethod
    def _grams(texts) -> tuple[np.ndarray, ...]:
        """The q-grams of some texts in order: hash, text, place."""
        grams = [gram_hashes(np.frombuffer(data, np.uint8)) for data in texts]
        hashes = np.concatenate([np.zeros(0, U64), *grams])
        which = np.repeat(np.arange(len(grams)), [len(g) for g in grams]).astype(np.int64)
        place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(g)) for g in grams)])
        order = np.argsort(hashes, kind="stable")
        return hashes[order], which[order], place[order]

    @staticmethod
    def _address(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> U64(64 - TABLE_BITS)).astype(np.int64)

    def find(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """Of each region that a text holds: text, region, start, end, edits."""
        return self._find(*self._shared(texts))

    def find_all(self, texts: pa.Array, short: bool = True) -> tuple[list[int], list, list[int], list[int], list[int]]:
        """Of each region that a text holds, and of excerpts, and of short items if asked for: text, item, start, end, edits."""
        shared = self._shared(texts)
        found = list(zip(*(x.tolist() for x in self._find(*shared))))
        rows = [(t, item, *place) for t, r, *place in found for item in self.items[r]]
        pairs = {row[:2] for row in rows}
        for t, w, *place in zip(*(x.tolist() for x in self._excerpts(*shared, pairs))):
            rows += [(t, item, *place) for item in self.whole[w]]
        if short and self.short:
            rows += self._short(*shared[:2])
        return tuple(map(list, zip(*rows))) if rows else ([],) * 5

    def _short(self, data, offsets) -> list[tuple]:
        """Of each short item that stands in a text: text, item, start, end, 0."""
        word = _WORD[data]
        edge = np.ones(len(data) + 1, bool)  # no word goes on across it
        edge[1:-1] = ~(word[1:] & word[:-1])
        edge[offsets] = True
        begins = np.flatnonzero(edge[:-1])
        text = np.searchsorted(offsets, begins, "right") - 1
        left = offsets[text + 1] - begins
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(_SPREAD[data], dtype=U64)])
        rows = []
        for length, wanted in self.short_sums.items():
            fits = np.flatnonzero(left >= length)
            fits = fits[edge[begins[fits] + length]]
            # sums of bytes in any order: what agrees is compared
            agree = np.isin(sums[begins[fits] + length] - sums[begins[fits]], wanted)
            for at, t in zip(begins[fits[agree]].tolist(), text[fits[agree]].tolist()):
                since = at - int(offsets[t])
                rows += [(t, item, since, since + length, 0) for item in self.short.get(data[at : at + length].tobytes(), ())]
        return rows

    def _shared(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """The folded texts, where each begins, and hash, place and text of the q-grams that may be in the index."""
        data, offsets = text_bytes(texts)
        data = _FOLD[data]
        hashes = gram_hashes(data)
        at = np.flatnonzero(self.table[self._address(hashes)])
        text = np.searchsorted(offsets, at, "right") - 1
        inside = at + Q <= offsets[text + 1]
        at, text = at[inside], text[inside]
        return data, offsets, hashes[at], at, text

    def _find(self, data, offsets, hashes, at, text) -> tuple[np.ndarray, ...]:
        low, high = (np.searchsorted(self.hashes, hashes, side) for side in ("left", "right"))
        found = [self._bands(at[s], text[s], low[s], high[s]) for s in self._parts(text, high - low)]
        text, region, lowest = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        return self._verify(data, offsets, text, region, lowest, self.bytes, self.lengths, self.budgets)

    def _excerpts(self, data, offsets, hashes, at, text, known: set[tuple]) -> tuple[np.ndarray, ...]:
        """Of each item of which a text holds a passage, if not known: text, whole item, start, end, edits."""
        low, high = (np.searchsorted(self.item_hashes, hashes, side) for side in ("left", "right"))
        budget = int(PASSAGE * EDITS)
        found = [np.zeros((0, 5), np.int64)]
        for s in self._parts(text, high - low):
            t, w, band, first, last = self._runs(at[s], text[s], low[s], high[s], budget)
            pairs, which = np.unique(np.column_stack([t, w]), axis=0, return_inverse=True)
            new = np.array([any((a, item) not in known for item in self.whole[b]) for a, b in pairs.tolist()], bool)[which.ravel()]
            t, w, band, first, last = (x[new] for x in (t, w, band, first, last))
            first, last = np.maximum(first, 0), np.minimum(last, self.begin[w + 1] - self.begin[w] - PASSAGE)
            some = np.concatenate([[0], np.cumsum(np.maximum(last - first + 1, 0))])
            for k in range(0, int(some[-1]), 1 << 16):  # passages, numbered through
                number = np.arange(k, min(k + (1 << 16), int(some[-1])))
                run = np.searchsorted(some, number, "right") - 1
                since = self.begin[w[run]] + first[run] + number - some[run]
                passages = np.unique(np.column_stack([t[run], w[run], since, band[run] + since - self.begin[w[run]]]), axis=0)
                since, n = passages[:, 2], len(passages)
                rows = self.text[since[:, None] + np.arange(PASSAGE)]
                # rows take the place of regions, a band's lowest diagonal is that of the passage
                r, *place = self._verify(data, offsets, passages[:, 0], np.arange(n), passages[:, 3], rows, np.full(n, PASSAGE), np.full(n, budget))[1:]
                found.append(np.column_stack([passages[r, 0], passages[r, 1], *place]))
        found = np.concatenate(found)
        found = found[np.lexsort((found[:, 3], found[:, 2], found[:, 4], found[:, 1], found[:, 0]))]  # fewest edits, then the first
        once = np.concatenate([[True], (found[1:, :2] != found[:-1, :2]).any(axis=1)])[: len(found)]
        return tuple(found[once].T)

    def _runs(self, at, text, low, high, budget) -> tuple[np.ndarray, ...]:
        """Text, whole item and lowest diagonal of bands, with the first and the last passage that may share enough q-grams there."""
        counts = high - low
        start = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) if len(counts) else counts
        posting = start + np.arange(counts.sum())
        item, place, at, text = self.item[posting], self.item_place[posting], np.repeat(at, counts), np.repeat(text, counts)
        shift, longest = budget + 1, int(self.begin[-1])
        band = (at - place + longest) // shift
        text, item, place, band = (np.concatenate([x, x]) for x in (text, item, place, band))
        band[len(band) // 2 :] -= 1
        order = np.lexsort((place, band, item, text))
        text, item, place, band = (x[order] for x in (text, item, place, band))
        bound = PASSAGE - Q + 1 - Q * budget
        ends = slice(bound - 1, None), slice(None, len(text) - bound + 1 if len(text) >= bound else 0)
        near = place[ends[0]] - place[ends[1]] <= PASSAGE - Q
        for x in (text, item, band):
            near &= x[ends[0]] == x[ends[1]]
        to, since = np.flatnonzero(near) + bound - 1, np.flatnonzero(near)
        return text[since], item[since], band[since] * shift - longest, place[to] - (PASSAGE - Q), place[since]

    @staticmethod
    def _parts(text: np.ndarray, counts: np.ndarray, most: int = 2_000_000) -> Iterator[slice]:
        """Slices of the places, whole texts each, with about so many shared q-grams."""
        total, begin = np.concatenate([[0], np.cumsum(counts)]), 0
        edges = np.concatenate([np.flatnonzero(np.diff(text)) + 1, [len(text)]])
        for edge, after in zip(edges, [*edges[1:], None]):
            if edge > begin and (after is None or total[after] - total[begin] > most):
                yield slice(begin, edge)
                begin = edge

    def _bands(self, at, text, low, high) -> tuple[np.ndarray, ...]:
        """Text, region and lowest diagonal of the bands that share enough q-grams."""
        counts = high - low
        start = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) if len(counts) else counts
        posting = start + np.arange(counts.sum())
        region, at, text = self.region[posting], np.repeat(at, counts), np.repeat(text, counts)
        shift = self.budgets[region] + 1  # bands are two shifts wide and begin at each shift
        band = (at - self.place[posting] + REGION) // shift
        keys = np.rec.fromarrays([np.concatenate([text, text]), np.concatenate([region, region]), np.concatenate([band, band - 1])], names="text,region,band")
        order = np.lexsort((keys.band, keys.region, keys.text))
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        shared = np.diff(np.concatenate([first, [len(keys)]]))
        kept = keys[first][shared >= self.bounds[keys.region[first]]]
        return kept.text, kept.region, kept.band * (self.budgets[kept.region] + 1) - REGION

    def _verify(self, data, offsets, text, region, lowest, regions, lengths, budgets) -> tuple[np.ndarray, ...]:
        found = []
        longest, widest = regions.shape[1], int(budgets.max(initial=0))
        width = 2 * (widest + 1) + 2 * widest
        for k in range(0, len(text), SIDE_BY_SIDE):
            t, r, low = (x[k : k + SIDE_BY_SIDE] for x in (text, region, lowest))
            low = low - widest
            edits, diagonal = align(regions[r], self._around(data, offsets, t, low, longest + width - 1), lengths[r])
            good = np.flatnonzero(edits <= budgets[r])
            t, r, low, edits, end = t[good], r[good], low[good], edits[good], (low + lengths[r] + diagonal)[good]
            # from its end backwards, the same alignment tells where the stretch begins
            back = np.take_along_axis(regions[r], np.maximum(lengths[r, None] - 1 - np.arange(longest), 0), 1)
            before = self._around(data, offsets, t, end - longest - 2 * widest, longest + 4 * widest)[:, ::-1]
            _, diagonal = align(back, before, lengths[r], np.full(len(t), 2 * widest))
            start = end - lengths[r] - (diagonal - 2 * widest)
            found.append((t, r, start - offsets[t], end - offsets[t], edits.astype(np.int64)))
        if not found:
            return (np.zeros(0, np.int64),) * 5
        found = np.column_stack([np.concatenate(x) for x in zip(*found)])
        return tuple(np.unique(found, axis=0).T)  # overlapping bands find a stretch twice

    @staticmethod
    def _around(data, offsets, text, since, length) -> np.ndarray:
        """The characters of each text from a place on; those outside of it match nothing."""
        at = since[:, None] + np.arange(length)
        inside = (at >= offsets[text, None]) & (at < offsets[text + 1, None])
        return np.where(inside, data[np.clip(at, 0, max(len(data) - 1, 0))], _OUTSIDE) if len(data) else np.full(at.shape, _OUTSIDE, np.uint8)


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator:
    """The benchmark in broadcast blocks of bounded size."""
    items = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // BLOCK)
    for block in range(n):
        some = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == block).orderBy("item", "text").collect()
        yield small_batches(benchmark.sparkSession).sparkContext.broadcast([tuple(x) for x in some])


def find_leaks(df: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", item: str = "item_id", item_text: str = "text", short: bool = True) -> DataFrame:
    """Stretches of texts that hold regions or passages of items: item, start, end (in bytes) and edits, next to the columns to keep."""
    names = [item, "start", "end", "edits"]
    kept, row = carried(keep, names)
    rows = df.select(row, F.col(text).alias("text"))
    schema = StructType([rows.schema[ROW], StructField(item, benchmark.schema[item].dataType), *(StructField(c, LongType()) for c in names[1:])])
    taken_type = to_arrow_type(benchmark.schema[item].dataType)
    found = df.sparkSession.createDataFrame([], schema)
    for sent in _blocks(benchmark, item, item_text):

        def find(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = held(sent.value, Index)
            for batch in batches:
                for part in slices(batch):
                    at, items, *place = index.find_all(part.column("text"), short)
                    taken = part.take(pa.array(at, pa.int64()))
                    columns = [pa.array(items, taken_type), *(pa.array(x, pa.int64()) for x in place)]
                    yield pa.RecordBatch.from_arrays([taken.column(ROW), *columns], [ROW, *names])

        found = found.unionByName(rows.mapInArrow(find, schema))
    return restored(found, kept, names)


def drop_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", short: bool = True) -> DataFrame:
    """The rows whose text holds no region or passage of an item."""
    for sent in _blocks(benchmark, item, item_text):

        def clean(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = held(sent.value, Index)
            for batch in batches:
                for part in slices(batch, text):
                    keep = np.ones(part.num_rows, bool)
                    keep[index.find_all(part.column(text), short)[0]] = False
                    yield part.filter(pa.array(keep))

        df = df.mapInArrow(clean, df.schema)
    return df

"""Words and their hashes for whole Arrow batches of texts.

A word is a run of bytes other than space and 0x09-0x0D. Bytes are worked on with
numpy for all texts of a batch at once, so no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE, _ADD = U64(0x9E3779B97F4A7C15), U64(0xD1B54A32D192ED03)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (an invertible mapping)."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def powers(base: U64, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(n, base, dtype=U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins and the last ends. Null is empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of a batch of texts: where they begin and end in ``data``, and which text has them.

    ``first[i]:first[i + 1]`` are the words of text i.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        self.data, self.offsets = text_bytes(texts)
        if lower:
            self.data = _LOWER[self.data]
        space = _SPACE[self.data]
        begins = ~space
        inside = begins.copy()
        begins[1:] &= space[:-1]
        edges = self.offsets[:-1][self.offsets[:-1] < len(self.data)]
        begins[edges] = inside[edges]  # a text begins a word even right after another text
        ends = inside
        ends[:-1] &= space[1:] | begins[1:]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.offsets)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word; equal words have equal hashes."""
        out = np.zeros(len(self), U64)
        length = self.end - self.start
        for at in range(int(length.max(initial=0))):  # one round for each position in a word, over ever fewer words
            if at == 0:
                left, where = np.arange(len(self)), self.start
            else:
                keep = length[left] > at
                left, where = left[keep], where[keep] + 1
                if len(left) < 64:  # the few very long words
                    for i in left.tolist():
                        tail = self.data[self.start[i] + at : self.end[i]].astype(U64)
                        p = powers(_BASE, len(tail) + 1)
                        out[i : i + 1] = out[i : i + 1] * p[-1:] + ((tail + _ADD) * p[-2::-1]).sum(dtype=U64, keepdims=True)
                    break
            out[left] = out[left] * _BASE + (self.data[where].astype(U64) + _ADD)
        return mix(out)


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """The hash of each run of ``length`` consecutive hashes, in order (n - length + 1 of them)."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for at in range(length):
        out = out * _BASE + hashes[at : at + n]
    return mix(out)


def slices(batch: pa.RecordBatch, column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of text (one text at least)."""
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
    pa.default_memory_pool().release_unused()

"""Texts of Arrow batches as flat byte arrays, and hashes of their words.

Tasks work on slices of a few megabytes, so their memory does not follow the batch size. One document is never split over
slices; a document longer than a slice is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15
SPACE = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
#: ASCII bytes that are neither letter nor digit. Bytes from 128 on belong to words.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


class Slice(NamedTuple):
    """Rows of a batch with their texts: text ``i`` is ``data[starts[i]:starts[i + 1]]``; a null text is empty."""

    rows: pa.RecordBatch
    data: np.ndarray
    starts: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i + 1]].tobytes()


def folded(texts: pa.LargeStringArray) -> pa.LargeStringArray:
    """Texts by Unicode case folding, with a blank for characters beyond ASCII that are neither letter, mark nor number."""
    plain = [t.decode("utf-8", "replace").casefold() for t in texts.cast(pa.large_binary()).to_pylist()]
    return pc.replace_substring_regex(pa.array(plain, pa.large_string()), pattern=r"[^\pL\pM\pN\x00-\x7f]+", replacement=" ")


def _flat(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each starts (one more at the end)."""
    _, offsets, payload = texts.buffers()
    starts = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    return np.frombuffer(payload, np.uint8) if payload is not None and payload.size else np.zeros(0, np.uint8), starts


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES, fold: bool = False) -> Iterator[Slice]:
    """Cut batches into slices of about ``size`` bytes of text; ``fold`` takes the texts as ``folded``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()), "")
        data, starts = _flat(texts)
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(starts, starts[first] + size, "right")) - 1)
            low, high = starts[first], starts[last]
            rows = batch.slice(first, last - first)
            if fold:
                yield Slice(rows, *_flat(folded(texts.slice(first, last - first))))
            else:
                yield Slice(rows, data[low:high], starts[first : last + 1] - low)
            first = last


def released(results: Iterator) -> Iterator:
    """The results of a task. At its end what Arrow keeps of the memory it no longer needs goes back to the system: Python
    workers outlive their tasks."""
    yield from results
    pa.default_memory_pool().release_unused()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a fixed bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_values(lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
    if lower:
        values[65:91] = values[97:123]
    return values


class WordHasher:
    """64-bit hashes of words (runs without separators); ``lower`` folds A-Z first."""

    def __init__(self, lower: bool = True, separators: np.ndarray = SPACE) -> None:
        self.values, self.separators = _byte_values(lower), separators
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _reserve(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, SLICE_BYTES + 1)
            self.powers, self.inverses = (self._table(b, n) for b in (BASE, pow(BASE, -1, 1 << 64)))

    @staticmethod
    def _table(base: int, n: int) -> np.ndarray:
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    def spans(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last-plus-one byte of every word."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        inside = ~self.separators[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[starts] = True
        after_gap = np.ones(len(data), bool)
        after_gap[1:] = ~inside[:-1]
        before_gap = np.ones(len(data), bool)
        before_gap[:-1] = ~inside[1:]
        return np.flatnonzero(inside & (after_gap | edge[:-1])), np.flatnonzero(inside & (before_gap | edge[1:])) + 1

    def hashes(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each span: a polynomial in the byte values, then mixed."""
        if not len(begin):
            return np.zeros(0, np.uint64)
        self._reserve(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=sums[1:])
        return mix((sums[end] - sums[begin]) * self.inverses[begin] + (end - begin).astype(np.uint64))

    def words(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the slice's words, and for each text the index of its first word (one more at the end)."""
        begin, end = self.spans(part.data, part.starts)
        return self.hashes(part.data, begin, end), np.searchsorted(begin, part.starts)


class HashTable:
    """Position of 64-bit hashes in a list without repeats; -1 where they are missing."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(hashes >> np.uint64(44)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> np.ndarray:
        found = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.seen[(hashes >> np.uint64(44)).astype(np.int64)])
        if len(maybe) and len(self.sorted):
            at = np.searchsorted(self.sorted, hashes[maybe]).clip(max=len(self.sorted) - 1)
            found[maybe] = np.where(self.sorted[at] == hashes[maybe], self.order[at], -1)
        return found

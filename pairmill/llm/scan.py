"""Vectorised reading of Arrow text columns: slices, words, lines and 64-bit hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

# Bytes of text that one numpy pass works on; a longer text is a slice of its own.
SLICE_BYTES = 1 << 19

# The white space of the word rule, and hash multipliers (any odd numbers would do).
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
BYTE_STEP = np.uint64(0x9E3779B97F4A7C15)
WORD_STEP = np.uint64(0xD6E8FEB86659FD93)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


try:
    _LIBC = ctypes.CDLL("libc.so.6")
except OSError:
    _LIBC = None


# What a worker keeps from task to task of one stage: (stage, value) by name.
_kept: dict = {}


def _stage() -> int:
    context = TaskContext.get()
    return -1 if context is None else context.stageId()


def kept(name: str, make: Callable, fits: Callable = lambda value: True):
    """A large object that the tasks of a stage share in one worker; made anew if it does not fit."""
    stage, value = _kept.get(name, (None, None))
    if value is None or not fits(value):
        _kept.pop(name, None)
        value = make()
    _kept[name] = (_stage(), value)
    return value


def release() -> None:
    """Gives freed memory back to the system, with what earlier stages kept. Workers outlive their
    tasks, and the memory that one operator leaves behind would be missing to the next."""
    stage = _stage()
    for name in [n for n, (of, _) in _kept.items() if of != stage]:
        del _kept[name]
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (one to one)."""
    x = x.astype(np.uint64, copy=True)
    for shift, step in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(step)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUE = mix(np.arange(1, 257))


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as were asked for."""

    def __init__(self, base: np.uint64):
        inverse = pow(int(base), -1, 1 << 64)
        self.base, self.inverse = np.uint64(base), np.uint64(inverse)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) >= n:
            return self.up[:n], self.down[:n]
        tables = []
        for step in (self.base, self.inverse):
            steps = np.full(n, step, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        if n <= 2 * SLICE_BYTES:
            self.up, self.down = tables
        return tables[0], tables[1]


BYTE_POWERS, WORD_POWERS = Powers(BYTE_STEP), Powers(WORD_STEP)


class Spans:
    """Polynomial hashes of values[start:end]; equal spans have equal hashes wherever they stand."""

    def __init__(self, values: np.ndarray, powers: Powers):
        up, self.down = powers.upto(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[: len(values)], dtype=np.uint64, out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        found = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(found + (ends - starts).astype(np.uint64))


def span_hashes(values: np.ndarray, starts, ends, powers: Powers) -> np.ndarray:
    return Spans(values, powers).hashes(starts, ends)


class Slice:
    """Some whole texts: their bytes end to end, and where each begins and ends."""

    def __init__(self, first: int, data: np.ndarray, bounds: np.ndarray):
        self.first, self.data, self.bounds = first, data, bounds
        self.size = len(bounds) - 1
        self._words = None

    def words(self):
        """Starts, ends and text numbers of the words."""
        if self._words is None:
            solid = ~SPACE[self.data]
            before = np.empty_like(solid)
            before[1:] = solid[:-1]
            inner = self.bounds[:-1][self.bounds[:-1] < len(solid)]
            before[inner] = False
            begins = solid & ~before
            starts = np.flatnonzero(begins)
            after = np.empty_like(solid)
            after[:-1] = solid[1:] & ~begins[1:]
            if len(after):
                after[-1] = False
            ends = np.flatnonzero(solid & ~after) + 1
            owner = np.searchsorted(self.bounds, starts, side="right") - 1
            self._words = starts, ends, owner
        return self._words

    def pieces(self, most: int = SLICE_BYTES) -> Iterator[Slice]:
        """Slices of this slice, of about ``most`` bytes."""
        return _cut(self.data, self.bounds, most)

    def per_text(self, owner: np.ndarray, weights=None) -> np.ndarray:
        return np.bincount(owner, weights, minlength=self.size)

    def per_text_bytes(self, flags: np.ndarray) -> np.ndarray:
        """How many flagged bytes each text has."""
        sums = np.zeros(len(flags) + 1, dtype=np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string array; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return content[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(texts: pa.Array, most: int = SLICE_BYTES, tidy: bool = True) -> Iterator[Slice]:
    """Cuts a batch into slices of about ``most`` bytes between texts, never inside one.

    Unless ``tidy`` is false, memory is given back after the batch; else the caller does so.
    """
    yield from _cut(*text_buffers(texts), most)
    if tidy:
        release()


def _cut(data: np.ndarray, bounds: np.ndarray, most: int) -> Iterator[Slice]:
    first, rows = 0, len(bounds) - 1
    while first < rows:
        last = int(np.searchsorted(bounds, bounds[first] + most, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield Slice(
            first, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        )
        first = last


def word_hashes(part: Slice, lower: bool = False) -> np.ndarray:
    starts, ends, _ = part.words()
    data = LOWER[part.data] if lower else part.data
    return span_hashes(BYTE_VALUE[data], starts, ends, BYTE_POWERS)


def window_hashes(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows inside one text, and the place of each window's first word."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :])
    return span_hashes(hashes, first, first + n, WORD_POWERS), first

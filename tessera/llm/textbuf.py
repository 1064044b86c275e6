"""Whole texts as one byte buffer: the vectorised view that the Python operators share.

An Arrow string column already stores its texts back to back.  ``TextBuf`` exposes that
buffer to numpy (null texts are empty), finds words in it and hashes any byte ranges of it
by one cumulative sum, so no operator loops over characters in Python.  ``slices`` cuts a
batch into runs of whole texts of bounded size, which bounds the numpy arrays; a single
text is never cut, so the bound is max(limit, longest text).
"""
from __future__ import annotations

import ctypes
import functools
import weakref
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text that an operator's numpy arrays hold at a time: some take 50 bytes for each byte of it.
SLICE_BYTES = 1 << 19
SPACES = b" \t\n\x0b\x0c\r"

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[list(SPACES)] = False
#: Letters, digits and every byte of a non-ASCII character (texts already lower-cased).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

_HASHERS: "weakref.WeakSet[RangeHasher]" = weakref.WeakSet()


def give_back() -> None:
    """Return freed memory to the machine at the end of a task.  Python workers live on into
    other stages, and allocators and the hashers' tables would keep a stage's peak for them."""
    for hasher in _HASHERS:
        hasher.forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` for ``mapInArrow``, with ``give_back`` once it and its last batch are gone."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class RangeHasher:
    """64-bit polynomial hash of any byte range through prefix sums modulo 2**64.

    Bytes pass through a table of random words first, so that single-bit differences
    never cancel; ``lane`` picks an independent table and base.
    """

    def __init__(self, lane: int = 0, lower: bool = False):
        rng = np.random.default_rng(20_240_601 + lane)
        self.table = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if lower:
            self.table = self.table[LOWER]
        self.base = int(rng.integers(1, 1 << 61, dtype=np.uint64)) * 8 + 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.forget()
        _HASHERS.add(self)

    def forget(self) -> None:
        """Drop the powers, 16 bytes for each byte of the longest text seen; they grow again when needed."""
        self._pow = np.ones(1, dtype=np.uint64)
        self._inv = np.ones(1, dtype=np.uint64)

    @staticmethod
    def _grown(have: np.ndarray, step: int, n: int) -> np.ndarray:
        while len(have) < n:
            factor = np.uint64(pow(step, len(have), 1 << 64))
            have = np.concatenate([have, have[:n - len(have)] * factor])
        return have

    def prefix(self, data: np.ndarray) -> np.ndarray:
        n = len(data) + 1
        self._pow = self._grown(self._pow, self.base, n)
        self._inv = self._grown(self._inv, self.inverse, n)
        out = np.zeros(n, dtype=np.uint64)
        terms = out[1:]
        np.take(self.table, data, out=terms)
        terms *= self._pow[:n - 1]
        np.cumsum(terms, out=terms)
        return out

    def ranges(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((prefix[ends] - prefix[starts]) * self._inv[starts])


class TextBuf:
    """Texts ``data[offs[i]:offs[i + 1]]`` of one slice of an Arrow string array."""

    def __init__(self, arr: pa.Array):
        if pa.types.is_binary(arr.type) or pa.types.is_string(arr.type):
            kind, fill = np.int32, "" if pa.types.is_string(arr.type) else b""
        else:
            kind, fill = np.int64, "" if pa.types.is_large_string(arr.type) else b""
        if arr.null_count:
            arr = pc.fill_null(arr, fill)
        n = len(arr)
        _, offsets, values = arr.buffers()
        if n == 0 or offsets is None:
            offs = np.zeros(n + 1, dtype=np.int64)
        else:
            offs = np.frombuffer(offsets, dtype=kind)[arr.offset:arr.offset + n + 1].astype(np.int64)
        whole = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, np.uint8)
        self.data = whole[offs[0]:offs[-1]]
        self.offs = offs - offs[0]
        self.n = n

    def words(self, is_word: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of word bytes, and each text's first word
        number (``n + 1`` entries).  Words never cross texts."""
        w = is_word[self.data]
        before = np.empty_like(w)
        after = np.empty_like(w)
        if len(w):
            before[0], before[1:] = False, w[:-1]
            after[-1], after[:-1] = False, w[1:]
            cuts = self.offs[1:-1]
            before[cuts[cuts < len(w)]] = False
            after[cuts[cuts > 0] - 1] = False
        starts = np.flatnonzero(w & ~before)
        ends = np.flatnonzero(w & ~after) + 1
        return starts, ends, np.searchsorted(starts, self.offs)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts hold at most ``limit`` bytes (one text at least)."""
    k = batch.schema.get_field_index(column)
    offs = TextBuf(batch.column(k)).offs
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def segment_sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sum of ``values[firsts[i]:firsts[i + 1]]`` for every i (empty runs give 0)."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[firsts[1:]] - total[firsts[:-1]]


def doc_of(firsts: np.ndarray) -> np.ndarray:
    """Text number of every word, from each text's first word number."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))

"""Words of many texts at once: positions and 64-bit hashes straight from Arrow buffers, without Python strings."""

from __future__ import annotations

import ctypes
import functools
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_RANDOM = np.random.default_rng(20240607)
#: A random odd base and its inverse modulo 2**64; a random value for every byte.
_BASE = int(_RANDOM.integers(1 << 62, 1 << 63)) * 2 + 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_powers: dict[int, np.ndarray] = {}

#: Bytes 9-13 and the blank separate words.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def forget() -> None:
    """Drop the tokenizer tables that an earlier stage has left in this worker."""
    for name, tables in (("tokens", "_encoders"), ("transducer", "_transducers")):
        module = sys.modules.get(f"granary.llm.{name}")
        if module is not None:
            getattr(module, tables).clear()


def lean(work: Callable, tokens: bool = False) -> Callable:
    """A function over the batches of a task that hands its memory back at the end, as the worker lives on.

    Unless it makes ``tokens``, what an earlier stage needed for that goes first.
    """

    @functools.wraps(work)
    def run(batches: Iterator) -> Iterator:
        if not tokens:
            forget()
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):
                pass  # another C library keeps what it likes

    return run


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: int, size: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < size:
        have = np.full(max(size, 1 << 16), base, np.uint64)
        have[0] = 1
        with np.errstate(over="ignore"):
            _powers[base] = have = np.multiply.accumulate(have)
    return have[:size]


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of a run of texts.

    ``start``/``end``: byte places in ``data``; ``first[d] : first[d + 1]``: the words of text ``d``;
    ``hash``: 64 bits per word. Different words share a hash with a chance of about 2**-58.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SPACE, lower: bool = True, alone: np.ndarray | None = None):
        """``alone`` marks the first bytes of three-byte characters that are words by themselves."""
        self.offsets = offsets
        self.data = data = _LOWER[data] if lower else data
        inside = ~separator[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.empty(len(data), bool)
        before[1:] = inside[:-1]
        before[:1] = False
        fresh = inside & (~before | edge[:-1])
        if alone is not None:
            fresh |= alone
            fresh[3:] |= inside[3:] & alone[:-3]
            edge[:-1] |= fresh
        self.start = np.flatnonzero(fresh)
        after = np.empty(len(data), bool)
        after[:-1] = inside[1:]
        after[-1:] = False
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.hash = self.hashes(self.end)

    def hashes(self, end: np.ndarray) -> np.ndarray:
        """64 bits of every word up to the byte ``end``."""
        out = np.empty(len(self.start), np.uint64)
        step = 1 << 17
        with np.errstate(over="ignore"):
            for a in range(0, len(out), step):  # a bounded piece of the text at a time
                s, e = self.start[a : a + step], end[a : a + step]
                low = int(s[0])
                part = self.data[low : int(e[-1])]
                sums = np.zeros(len(part) + 1, np.uint64)
                np.cumsum(_BYTE[part] * powers(_BASE, len(part)), out=sums[1:])
                out[a : a + step] = mixed((sums[e - low] - sums[s - low]) * powers(_INVERSE, len(part))[s - low])
        return out

    def text(self, i: int, j: int) -> str:
        """The text from word ``i`` to before word ``j``."""
        return self.data[self.start[i] : self.end[j - 1]].tobytes().decode("utf-8", "replace")


def pieces(batch: pa.RecordBatch, text: str = "text", limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows of ``batch`` with at most ``limit`` bytes of text each, one row at least."""
    _, offsets = utf8_buffers(batch.column(batch.schema.get_field_index(text)))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield batch.slice(a, b - a)
        a = b

"""Text columns as byte arrays: words, hashes and ragged lists without a Python object for each word.

The Python tasks of this package get Arrow batches. ``byte_blocks`` cuts them into blocks of about a
megabyte and of ``BLOCK_ROWS`` rows at most (a longer text is a block of its own), so that what a task holds depends on the longest text and
not on how many rows a batch has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

SENT_BYTES = 4 << 20
_SENT = "spark.sql.execution.arrow.maxBytesPerBatch"
BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 2048
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_U64 = np.uint64

ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True


@dataclass
class Block:
    """Some texts: their UTF-8 bytes, where each starts (one more entry at the end), and the rows they came from."""

    data: np.ndarray
    offsets: np.ndarray
    rows: slice

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> str:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().decode("utf-8", "replace")

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """The text each byte position lies in."""
        return np.searchsorted(self.offsets, positions, "right") - 1


def bound_batches(spark: SparkSession) -> None:
    """Have Spark cut what it sends to Python tasks at about ``SENT_BYTES``, unless the session has a bound of its own.

    By rows alone, ten thousand long texts or sets are one batch, held in the JVM, in its transfer buffers and in the worker at once.
    """
    if _SENT not in spark.conf.getAll:
        spark.conf.set(_SENT, SENT_BYTES)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a string or binary column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    data, offsets = column_bytes(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, min(first + BLOCK_ROWS, int(np.searchsorted(offsets, offsets[first] + block_bytes, "right")) - 1))
        yield Block(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], slice(first, last))
        first = last


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2**64, as far as the longest block needs them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, BLOCK_BYTES + 1)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up, self.down


_POWERS = _Powers()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes have equal hashes wherever they stand."""
    up, down = _POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U64(1)) * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def runs(kept: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of kept bytes; no run crosses from one text to the next."""
    if not len(kept):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after = np.ones(len(kept), bool), np.ones(len(kept), bool)
    before[1:] = ~kept[:-1]
    after[:-1] = ~kept[1:]
    inner = offsets[1:-1]
    before[inner[inner < len(kept)]] = True
    after[inner[inner > 0] - 1] = True
    return np.flatnonzero(kept & before), np.flatnonzero(kept & after) + 1


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def different(x: np.ndarray) -> np.ndarray:
    """The different values in order."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[0], starts[0]+1, ... of each list, one list after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)


def list_offsets(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def binary_column(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column whose i-th entry is the bytes of values[offsets[i]:offsets[i+1]]."""
    at = (offsets * values.dtype.itemsize).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(values))]
    ).cast(pa.binary())

"""Helpers the operators share: shared-folder paths, Arrow batches, and vectorised word hashing.

The hashing works on the UTF-8 bytes of a whole Arrow batch at once.  A word's hash is a polynomial
over its bytes modulo 2**64, taken from prefix sums, and a window of words is hashed the same way over
the mixed word hashes, so the cost is a few vector operations per byte and per word.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text worked on at once inside a task; longer single texts are taken whole.
SLICE_BYTES = 4 << 20
_PIECE = 512 << 10
_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers: dict[int, np.ndarray] = {}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor can reach.

    The setting is read from the session.  Only where it is unset, as on one machine in tests, a folder
    below the warehouse is used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet in the shared folder and reads it back: lineage is cut, work is not redone."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def group_bytes(total: int, factor: int = 256, least: int = 8 << 20, most: int = 32 << 20) -> int:
    """Bytes of text in a group: they grow with the root of all text, so that groups and what each sends to each shard stay few."""
    return min(most, max(least, int(factor * total**0.5)))


def width_of(spark: SparkSession, groups: int, most: int = 20_000) -> int:
    """Partitions for so many groups; beyond ``most`` a partition has several, one after the other."""
    return max(1, min(groups, max(most, shuffle_width(spark))))


#: What operators keep in a worker between tasks: how to let go of it, by operator.
caches: dict[str, Callable[[], None]] = {}


def release() -> None:
    """Returns freed memory to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library returns it by itself or not at all
        pass


def begin(operator: str) -> None:
    """At a task's start: lets go of what other operators keep in this worker, and returns freed memory to the machine."""
    for name, clear in caches.items():
        if name != operator:
            clear()
    release()


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES):
    """Cuts a record batch into runs of rows with about ``limit`` bytes in a string column, one row at least."""
    text = batch.column(column)
    if len(text) == 0:
        return
    lengths = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    block = np.cumsum(lengths) // limit
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(text)]))
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(a, b - a)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and each row's offsets in them; a null is an empty text."""
    if pa.types.is_large_string(column.type) is False:
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if buffers[2] is None or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def byte_table(separators) -> np.ndarray:
    """True for bytes that belong to words."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


#: Words are runs of anything but space and the control characters 9 to 13.
BLANK_SEPARATED = byte_table([0x20, *range(0x09, 0x0E)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """Starts and ends of words in ``data``, and where each row's words begin in that list."""
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = table[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    first[heads] = inside[heads]
    last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base & (2**64 - 1), np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 4 * _PIECE:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the value of a polynomial at ``base``, an odd number."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    inverse = pow(base, -1, 2**64)
    while i < len(starts):
        j = max(int(np.searchsorted(ends, starts[i] + _PIECE, side="right")), i + 1)
        low = starts[i]
        piece = data[low : ends[j - 1]]
        sums = np.empty(len(piece) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE_CODES[piece] * _power(base, len(piece)), dtype=np.uint64, out=sums[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        h = (sums[e] - sums[s]) * _power(inverse, len(piece))[s]
        out[i:j] = mix(h + (e - s).astype(np.uint64) * np.uint64(_WORD_BASE))
        i = j
    return out


def window_hashes(words: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive entries of ``words``; runs may cross rows, callers mask those."""
    n = len(words)
    if n < size:
        return np.empty(0, np.uint64)
    base, out = (_WORD_BASE + 2 * seed) | 1, np.empty(n - size + 1, np.uint64)
    inverse, step = pow(base, -1, 2**64), 1 << 18
    for low in range(0, len(out), step):
        part = words[low : min(low + step, len(out)) + size - 1]
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(part * _power(base, len(part)), dtype=np.uint64, out=sums[1:])
        m = len(part) - size + 1
        out[low : low + m] = mix((sums[size:] - sums[:m]) * _power(inverse, m))
    return out


def member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each value is among the sorted ones."""
    if not len(of):
        return np.zeros(len(values), bool)
    at = np.searchsorted(of, values)
    at[at == len(of)] = 0
    return of[at] == values


def row_of(bounds: np.ndarray) -> np.ndarray:
    """For bounds of consecutive runs, the run each element is in."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def list_array(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def binary_array(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Rows of raw bytes: row i has ``values[bounds[i]:bounds[i + 1]]`` as they lie in memory."""
    size = values.dtype.itemsize
    if bounds[-1] * size >= 2**31:
        raise ValueError("an Arrow batch of binary values may not pass 2 GB; use smaller slices")
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * size).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])

"""Shared pieces of the corpus operators: table access, written stages, word kernels.

The kernels work on whole Arrow string columns: one NumPy pass over the bytes of
many documents at a time, in slices of bounded size, so memory does not grow with
the batch and no Python loop runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

# The contract's word is a run of anything but these characters.
WORD = r"[^\x20\x09-\x0D]+"
SEPARATOR = r"[\x20\x09-\x0D]+"

#: Bytes of text that one NumPy pass handles (temporaries take about 40 times that).
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a stage to the shared checkpoint folder and read it back.

    The result has no lineage: a lost executor never recomputes what came before,
    and non-deterministic partition bounds are fixed once.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def id_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (a null id counts as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def _mix_table() -> np.ndarray:
    """256 odd 64-bit values from a fixed splitmix sequence (one per byte value)."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix64(x) | np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = _mix_table()
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BASE = 0xD1342543DE82EF95
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n-1 modulo 2**64, grown on demand."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        p = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        p[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(p)
    return have[:n]


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, offsets, bytes) of row ranges of about ``limit`` bytes.

    Offsets start at 0 and have one more entry than there are rows; a null text has
    no bytes. One text longer than the limit is a range of its own.
    """
    if not (pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    if column.null_count:
        column = column.fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64, count=column.offset + n + 1)[column.offset:]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, offsets[row:end + 1] - offsets[row], data[offsets[row]:offsets[end]]
        row = end


def word_hashes(offsets: np.ndarray, data: np.ndarray, lower: bool = True):
    """64-bit hashes of all words of a slice: (hashes, first word of each row, ends).

    ``first`` has rows + 1 entries, so row i has words first[i]:first[i + 1]. Equal
    words have equal hashes in every process; ``lower`` folds A-Z only.
    """
    rows = len(offsets) - 1
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    inside = ~_IS_SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    starts[cuts] = inside[cuts]  # a row's first byte starts a word of its own
    ends[cuts - 1] = inside[cuts - 1]
    start = np.flatnonzero(starts)
    end = np.flatnonzero(ends) + 1
    value = _BYTE_VALUE[_LOWER[data] if lower else data]
    # Prefix sums of value * base**position; a word's share of them, divided by
    # base**start, no longer depends on where the word stands.
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(value * _powers(_BASE, n), out=total[1:])
    sums = (total[end] - total[start]) * _powers(pow(_BASE, -1, 1 << 64), n)[start]
    first = np.searchsorted(start, offsets)
    return mix64(sums ^ (end - start).astype(np.uint64)), first

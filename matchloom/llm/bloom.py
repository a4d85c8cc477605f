"""A Bloom filter over a column of ids, built distributed.

Only its bits come to the driver: 16 to 32 an id, 8 MB at most, since a filter is copied several times on its way to the tasks. With more ids than that is made for the
filter lets more rows through to the exact join that follows, and never loses one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import U, mix
from .workers import trimmed

MOST_BITS, BLOCK = 1 << 26, 1 << 15


def _places(ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        h = mix(ids.view(U) + U(0x51ED270B7A1F3C5D))
    return (h & U(bits - 1)).astype(np.int64), ((h >> U(32)) & U(bits - 1)).astype(np.int64)


def _rows(bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    blocks = bits.reshape(-1, BLOCK // 8)
    have = np.flatnonzero(blocks.any(1))
    if len(have):
        yield pa.RecordBatch.from_arrays([pa.array(have.astype(np.int32)), pa.array([blocks[b].tobytes() for b in have], pa.binary())], ["block", "bits"])


def _mark(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size // 8, np.uint8)
        for batch in batches:
            for at in _places(batch.column(0).to_numpy(zero_copy_only=False), size):
                np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        yield from _rows(bits)

    return run


def _merge(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros((size // BLOCK, BLOCK // 8), np.uint8)
        for batch in batches:
            for b, x in zip(batch.column("block").to_pylist(), batch.column("bits"), strict=True):
                bits[b] |= np.frombuffer(x.as_py(), np.uint8)
        yield from _rows(bits.ravel())

    return run


def build(ids: DataFrame) -> np.ndarray:
    """The filter's bytes over a one-column frame of non-null bigints, which is counted first."""
    count = ids.count()
    size = min(MOST_BITS, max(BLOCK, 1 << (16 * count).bit_length()))
    schema = "block int, bits binary"
    # a task marks some 2^20 ids, so that few filters meet
    marked = ids.coalesce(max(1, count >> 20)).mapInArrow(trimmed(_mark(size)), schema)
    if count >> 20:
        marked = marked.repartition(max(1, size // BLOCK // 64), "block").mapInArrow(trimmed(_merge(size)), schema)
    bits = np.zeros((size // BLOCK, BLOCK // 8), np.uint8)
    for b, x in marked.collect():  # at most MOST_BITS / 8 bytes
        bits[b] |= np.frombuffer(x, np.uint8)
    return bits.ravel()


def contains(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    a, b = _places(np.ascontiguousarray(ids, np.int64), 8 * len(bits))
    return ((bits[a >> 3] >> (a & 7).astype(np.uint8)) & (bits[b >> 3] >> (b & 7).astype(np.uint8)) & 1).astype(bool)


def marked(df: DataFrame, column: str, bits: np.ndarray, name: str) -> DataFrame:
    """``df`` with a boolean ``name`` (new): the bigint ``column`` may be in the filter; false for a null."""
    out = df.withColumn(name, F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.names.index(column))
            got = contains(bits, pa.compute.fill_null(ids.cast(pa.int64()), 0).to_numpy(zero_copy_only=False))
            got &= ids.is_valid().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(got)], names=batch.schema.names)

    return out.mapInArrow(trimmed(run), out.schema)


def filtered(df: DataFrame, column: str, bits: np.ndarray) -> DataFrame:
    """Rows of ``df`` whose bigint ``column`` may be in the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.names.index(column)).cast(pa.int64())
            got = contains(bits, pa.compute.fill_null(ids, 0).to_numpy(zero_copy_only=False)) & ids.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(got))

    return df.mapInArrow(trimmed(run), df.schema)

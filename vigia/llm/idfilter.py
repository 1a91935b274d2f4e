"""A Bloom filter of 64-bit numbers, built by tasks and merged segment by segment.

It only spares rows a shuffle: what passes is joined exactly afterwards. Its size follows the number of
values up to a stated bound; beyond that more rows pass and results stay the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm.textkit import mixed

_SEGMENT = 1 << 16  # bytes
MOST_BYTES = 16 << 20
_HASHES = 3


def _positions(values: np.ndarray, bits: int) -> np.ndarray:
    scrambled = mixed(values.astype(np.uint64))
    a, b = scrambled & np.uint64(0xFFFFFFFF), (scrambled >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(_HASHES, dtype=np.uint64)[:, None]
    return ((a + steps * b) % np.uint64(bits)).astype(np.int64)


def contains(filter_bytes: bytes, values: np.ndarray) -> np.ndarray:
    """Whether each value may be in the filter."""
    bits = np.frombuffer(filter_bytes, dtype=np.uint8)
    if not len(bits):
        return np.zeros(len(values), dtype=bool)
    at = _positions(values, 8 * len(bits))
    return ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)


def build(values: DataFrame, most_bytes: int = MOST_BYTES) -> bytes:
    """The filter of the one bigint column of `values`, with some 12 bits a value; empty if there is none.

    At most `most_bytes` reach the driver and, as a broadcast, each worker.
    """
    name = values.columns[0]
    n = values.count()
    if not n:
        return b""
    size = min(most_bytes, max(_SEGMENT, 1 << int(np.ceil(np.log2(1.5 * n)))))
    schema = pa.schema([("part", pa.int32()), ("bits", pa.binary())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(size, dtype=np.uint8)
        for batch in batches:
            at = _positions(batch.column(0).to_numpy(zero_copy_only=False), 8 * size).ravel()
            np.bitwise_or.at(own, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
        for part in range(0, size, _SEGMENT):
            piece = own[part : part + _SEGMENT]
            if piece.any():
                yield pa.RecordBatch.from_arrays([pa.array([part // _SEGMENT], pa.int32()), pa.array([piece.tobytes()], pa.binary())], schema=schema)

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SEGMENT, dtype=np.uint8)
        for batch in batches:
            for piece in batch.column(batch.schema.get_field_index("bits")).to_pylist():
                total |= np.frombuffer(piece, dtype=np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], schema=schema)

    parts = values.where(F.col(name).isNotNull()).mapInArrow(mark, "part int, bits binary")
    out = bytearray(size)
    for row in parts.groupBy("part").applyInArrow(merge, "part int, bits binary").collect():
        out[row["part"] * _SEGMENT : (row["part"] + 1) * _SEGMENT] = row["bits"]
    return bytes(out)

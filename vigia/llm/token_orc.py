"""Token ids as ORC: run-length encoded integers, row indexes, Bloom filters on the document id.

`write_tokens` brings the documents into ascending order of their id by ranges,
encodes each whole text and writes one ORC file for each range. ORC stores
integer columns run-length encoded, keeps minimum and maximum of each run of
`row_index_stride` rows, and here a Bloom filter on `doc_id` beside them, so
that a reader splits files at stripes and skips stripes by id.

Columns of a file: doc_id; shard (the range's number, ascending with the ids);
shard_start (ids of the shard before the document); n_tokens; ids.

Cases: a null text is empty and has the end id alone; a null doc_id is kept and
comes first; repeated rows are written each; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigia.llm.textkit import chunks, tasks_for, tokenizer


@dataclass(frozen=True)
class TokenFile:
    tokenizer_path: str
    keep_blank: bool = True
    end_id: int = 0
    stripe_bytes: int = 16 << 20
    row_index_stride: int = 1000
    bloom_fpp: float = 0.01
    chunk_bytes: int = 6 << 20


SCHEMA = "doc_id bigint, shard int, shard_start bigint, n_tokens int, ids array<int>"
_ARROW = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("shard_start", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.list_(pa.int32()))])


def _encode(spec: TokenFile):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(spec.tokenizer_path, spec.keep_blank)
        shard, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows, texts in chunks(batch, limit=spec.chunk_bytes):
                ids, ends = coder.encode(texts)
                closed = np.insert(ids, ends[1:], spec.end_id)
                ends = ends + np.arange(len(ends))
                sizes = np.diff(ends)
                yield pa.RecordBatch.from_arrays([
                    rows.column(0).cast(pa.int64()),
                    pa.array(np.full(len(sizes), shard, dtype=np.int32)),
                    pa.array(before + ends[:-1]),
                    pa.array(sizes.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(closed.astype(np.int32))),
                ], schema=_ARROW)
                before += int(ends[-1])

    return run


def write_tokens(docs: DataFrame, path: str, spec: TokenFile) -> None:
    """Encode all documents and write them to the new folder `path`."""
    ordered = (
        docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
        .repartitionByRange(tasks_for(docs.sparkSession), "doc_id")
        .sortWithinPartitions("doc_id")
    )
    (
        ordered.mapInArrow(_encode(spec), SCHEMA).write
        .option("compression", "zstd")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", spec.row_index_stride)
        .option("orc.stripe.size", spec.stripe_bytes)
        .option("orc.rows.between.memory.checks", 256)  # long rows: look at the stripe's size more often
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", spec.bloom_fpp)
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows; a filter on doc_id reaches the files' indexes and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path)


def shard_starts(stored: DataFrame) -> DataFrame:
    """shard, first: the number of ids in all shards before it. Reads the two counting columns only."""
    totals = stored.groupBy("shard").agg(F.sum(F.col("n_tokens").cast("bigint")).alias("total"))
    # One row for each file: a running sum over the shards' numbers.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(F.col("shard").alias("of_shard"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("first"))


def with_checksum(stored: DataFrame) -> DataFrame:
    """doc_id, shard, shard_start, n_tokens, ids_crc32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(4)
            ends = ids.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False).astype("<u4"))).cast("B")
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sums, pa.int64())], names=["doc_id", "shard", "shard_start", "n_tokens", "ids_crc32"])

    return stored.select("doc_id", "shard", "shard_start", "n_tokens", "ids").mapInArrow(run, "doc_id bigint, shard int, shard_start bigint, n_tokens int, ids_crc32 bigint")


def token_digest(stored: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, shard."""
    rows = with_checksum(stored)
    return rows.join(shard_starts(stored), F.col("shard") == F.col("of_shard")).select(
        "doc_id",
        (F.col("first") + F.col("shard_start")).alias("start"),
        F.col("n_tokens").cast("bigint").alias("n_tokens"),
        "ids_crc32",
        "shard",
    )

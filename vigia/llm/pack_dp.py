"""Order-preserving packing of documents into token windows by dynamic programming.

Documents are brought into ascending order of their id by ranges; a range is
cut, at document ends, into blocks of about `block_tokens` ids, and each block
is packed by itself. Within a block the ids stay in order and the programme
chooses where windows end. Window ends are document ends (free), sentence ends
(`sentence_penalty`) and, where a sentence is longer than `max_gap`, points
inside it (`inner_penalty`). The cost of a window is its padding, in ids, plus
the penalty of its end; a window whose length is a power of two, from
`least_exact` up, needs no padding.

With f(j) the least cost of the ids before j,
    f(j) = penalty(j) + min(min over j-L <= i < j of f(i) + L - (j - i),
                            f(j - 2**k)).
The inner minimum is that of f(i) + i over a sliding range: a monotone queue
holds its candidates, so each candidate enters and leaves once.

Cases: a null text is empty and its document is the end id alone; a document
longer than a window lies in several pieces; null and repeated ids are packed
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm.textkit import chunks, tasks_for, tokenizer


@dataclass(frozen=True)
class Packing:
    tokenizer_path: str
    keep_blank: bool = False
    end_id: int = 1
    window: int = 2048
    sentence_penalty: int = 8
    inner_penalty: int = 64
    max_gap: int = 256
    least_exact: int = 256
    block_tokens: int = 1 << 20
    chunk_bytes: int = 4 << 20


SCHEMA = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])


def candidates(doc_ends: np.ndarray, sentence_ends: np.ndarray, spec: Packing) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a window may end, ascending and without 0, and the penalty of each."""
    cost = np.full(int(doc_ends[-1]) + 1, -1, dtype=np.int32)
    cost[0] = 0
    cost[sentence_ends] = spec.sentence_penalty
    cost[doc_ends] = 0
    at = np.flatnonzero(cost >= 0)
    gaps = np.diff(at)
    for base, size in zip(at[:-1][gaps > spec.max_gap].tolist(), gaps[gaps > spec.max_gap].tolist(), strict=True):
        parts = -(-size // spec.max_gap)
        cost[base + np.arange(1, parts) * size // parts] = spec.inner_penalty
    at = np.flatnonzero(cost >= 0)[1:]
    return at, cost[at]


def window_ends(at: np.ndarray, penalty: np.ndarray, spec: Packing) -> np.ndarray:
    """The ends of the windows of least cost; the last candidate is the last end."""
    total = int(at[-1])
    index = np.full(total + 1, -1, dtype=np.int64)
    index[0] = 0
    index[at] = np.arange(1, len(at) + 1)
    exact: dict[int, list[int]] = {}
    size = spec.least_exact
    while size <= min(spec.window, total):
        later = at[at >= size]
        source = index[later - size]
        for j, i in zip(index[later[source >= 0]].tolist(), source[source >= 0].tolist(), strict=True):
            exact.setdefault(j, []).append(i)
        size *= 2
    places, costs = [0, *at.tolist()], [0, *penalty.tolist()]
    best, back = [0] * len(places), [0] * len(places)
    queue = deque([0])
    window, never = spec.window, ()
    for j in range(1, len(places)):
        here = places[j]
        while places[queue[0]] < here - window:
            queue.popleft()
        i = queue[0]
        least = best[i] + window - here + places[i]
        for k in exact.get(j, never):
            if best[k] < least:
                least, i = best[k], k
        best[j], back[j] = least + costs[j], i
        worth = best[j] + here
        while queue and best[queue[-1]] + places[queue[-1]] >= worth:
            queue.pop()
        queue.append(j)
    ends, j = [], len(places) - 1
    while j:
        ends.append(places[j])
        j = back[j]
    return np.array(ends[::-1], dtype=np.int64)


def _pieces(doc_ids: list, ids: np.ndarray, doc_ends: np.ndarray, sentence_ends: np.ndarray, first: int, spec: Packing) -> tuple[pa.RecordBatch, int]:
    cuts = window_ends(*candidates(doc_ends, sentence_ends, spec), spec)
    ends = np.union1d(cuts, doc_ends)
    begins = np.concatenate([[0], ends[:-1]])
    doc = np.searchsorted(doc_ends, begins, side="right")
    window = np.searchsorted(cuts, begins, side="right")
    doc_begin, window_begin = np.concatenate([[0], doc_ends[:-1]]), np.concatenate([[0], cuts[:-1]])
    offsets = np.concatenate([[0], ends * 4]).astype(np.int32)
    payload = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u4").tobytes())])
    return pa.RecordBatch.from_arrays([
        pa.array(doc_ids, pa.int64()).take(pa.array(doc)),
        pa.array(begins - doc_begin[doc]),
        pa.array(ends - begins),
        pa.array((doc_ends - doc_begin)[doc]),
        pa.array(first + window),
        pa.array(begins - window_begin[window]),
        payload,
    ], schema=_ARROW), len(cuts)


def _pack(spec: Packing):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(spec.tokenizer_path, spec.keep_blank)
        sequence = TaskContext.get().partitionId() << 40
        doc_ids: list = []
        held: list[np.ndarray] = []
        ends: list[np.ndarray] = []
        tokens = 0
        for batch in batches:
            for rows, texts in chunks(batch, limit=spec.chunk_bytes):
                ids, bounds = coder.encode(texts)
                closed = np.insert(ids, bounds[1:], spec.end_id)
                doc_ids += rows.column(0).to_pylist()
                held.append(closed)
                ends.append(tokens + bounds[1:] + np.arange(1, len(bounds)))
                tokens += len(closed)
                if tokens >= spec.block_tokens:
                    out, used = packed(coder, doc_ids, held, ends, sequence)
                    yield out
                    sequence, doc_ids, held, ends, tokens = sequence + used, [], [], [], 0
        if tokens:
            yield packed(coder, doc_ids, held, ends, sequence)[0]

    def packed(coder, doc_ids, held, ends, sequence):
        ids, doc_ends = np.concatenate(held), np.concatenate(ends)
        sentence_ends = np.flatnonzero(coder.ends_sentence[ids]) + 1
        return _pieces(doc_ids, ids, doc_ends, sentence_ends, sequence, spec)

    return run


def pack_documents(docs: DataFrame, spec: Packing) -> DataFrame:
    """One row for each piece; ids holds its ids as little-endian unsigned 32-bit integers."""
    ordered = (
        docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
        .repartitionByRange(tasks_for(docs.sparkSession), "doc_id")
        .sortWithinPartitions("doc_id")
    )
    return ordered.mapInArrow(_pack(spec), SCHEMA)


def piece_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

"""Repeated lines found with two Bloom filters, confirmed exactly.

1. Each builder task sets, for the key of every line, bits in a filter of keys
   met once or, if they were set already, in a filter of keys met twice. Filters
   merge by OR, and what two "once" filters share goes to "twice". Within one
   document a key counts once.
2. Lines whose key is in the merged "twice" filter are suspects; only they are
   stored and shuffled. Every key of two or more documents is among them.
3. Suspects are counted exactly by key, and the first occurrence is chosen.
4. The lines to drop go back to their documents.

A filter has `bits` bits at every input size: beyond its capacity more lines
become suspects, and the result stays the same.

Cases: a null or empty text is one empty line; keys shorter than
`min_key_chars` never repeat; a repeated row is a document of its own; a null
doc_id is kept; an empty table gives no rows; other columns stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.durable import stored
from vigia.llm.textkit import SPACES, chunks, fresh


@dataclass(frozen=True)
class LineRule:
    min_docs: int = 10
    min_key_chars: int = 1
    keep_first: bool = False
    bits: int = 1 << 26
    hashes: int = 4
    builders_per_core: int = 2


def line_keys(text: bytes) -> list[bytes]:
    """The key of each line: stripped of ASCII white space, A-Z lower-cased."""
    return [line.strip(SPACES).lower() for line in text.split(b"\n")]


def _usable(key: bytes, rule: LineRule) -> bool:
    return len(key) >= rule.min_key_chars and (rule.min_key_chars <= 1 or len(key.decode()) >= rule.min_key_chars)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    at = 0
    for rows, texts in chunks(batch):
        for text in texts.cast(pa.large_binary()).to_pylist():
            yield at, text
            at += 1


def positions(digests: np.ndarray, rule: LineRule) -> np.ndarray:
    """The bits of each digest, one row for each hash."""
    a, b = digests & np.uint64(0xFFFFFFFF), (digests >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(rule.hashes, dtype=np.uint64)[:, None]
    return ((a + steps * b) % np.uint64(rule.bits)).astype(np.int64)


def _has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)


def _set(bits: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(bits, at.ravel() >> 3, np.uint8(1) << (at.ravel() & 7).astype(np.uint8))


class TwoFilters:
    def __init__(self, rule: LineRule):
        self.rule = rule
        self.once = np.zeros(rule.bits // 8, dtype=np.uint8)
        self.twice = np.zeros(rule.bits // 8, dtype=np.uint8)

    def add(self, digests: np.ndarray) -> None:
        """Count each of the digests once more."""
        values, counts = np.unique(digests, return_counts=True)
        at = positions(values, self.rule)
        again = _has(self.once, at) | (counts > 1)
        _set(self.twice, at[:, again])
        _set(self.once, at)


def _merge(a: tuple[bytes, bytes], b: tuple[bytes, bytes]) -> tuple[bytes, bytes]:
    a1, a2, b1, b2 = (np.frombuffer(x, dtype=np.uint8) for x in (*a, *b))
    return (a1 | b1).tobytes(), (a2 | b2 | (a1 & b1)).tobytes()


def twice_filter(docs: DataFrame, rule: LineRule) -> bytes:
    """The filter that holds every key of two or more documents; rule.bits / 8 bytes reach the driver."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = TwoFilters(rule)
        for batch in batches:
            found: list[int] = []
            for _, text in _texts(batch):
                found += [xxhash.xxh3_64_intdigest(key) for key in set(line_keys(text)) if _usable(key, rule)]
                if len(found) > 200_000:
                    both.add(np.array(found, dtype=np.uint64))
                    found = []
            both.add(np.array(found, dtype=np.uint64))
        segment = 1 << 16
        for i in range(0, rule.bits // 8, segment):
            once, twice = both.once[i : i + segment].tobytes(), both.twice[i : i + segment].tobytes()
            if any(once):
                yield pa.RecordBatch.from_pylist([{"part": i // segment, "once": once, "twice": twice}], schema=pa.schema([("part", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())]))

    def merge(key: tuple, table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: tuple[bytes, bytes] | None = None
        for batch in table:
            for row in batch.to_pylist():
                pair = (row["once"], row["twice"])
                total = pair if total is None else _merge(total, pair)
        yield pa.RecordBatch.from_pylist([{"part": key[0].as_py(), "twice": total[1]}], schema=pa.schema([("part", pa.int32()), ("twice", pa.binary())]))

    spark = docs.sparkSession
    tasks = rule.builders_per_core * spark.sparkContext.defaultParallelism
    parts = docs.select(F.col("text").cast("string")).coalesce(tasks).mapInArrow(build, "part int, once binary, twice binary")
    merged = parts.groupBy("part").applyInArrow(merge, "part int, twice binary").collect()
    out = bytearray(rule.bits // 8)
    for row in merged:
        out[row["part"] << 16 : (row["part"] << 16) + len(row["twice"])] = row["twice"]
    return bytes(out)


def suspects(docs: DataFrame, rule: LineRule) -> DataFrame:
    """doc_id, text_digest, line_key, lines: for each document, the suspected keys and where they stand."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(twice_filter(docs, rule))
    schema = pa.schema([("doc_id", pa.int64()), ("text_digest", pa.string()), ("line_key", pa.binary()), ("lines", pa.list_(pa.int32()))])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, dtype=np.uint8)
        for batch in batches:
            for rows, texts in chunks(batch):
                names = rows.column(0).to_pylist()
                keys: list[bytes] = []
                owner: list[int] = []
                where: list[list[int]] = []
                digest: list[str] = []
                for i, text in enumerate(texts.cast(pa.large_binary()).to_pylist()):
                    digest.append(hashlib.md5(text).hexdigest())
                    own: dict[bytes, list[int]] = {}
                    for n, key in enumerate(line_keys(text)):
                        if _usable(key, rule):
                            own.setdefault(key, []).append(n)
                    keys += own
                    where += own.values()
                    owner += [i] * len(own)
                at = positions(np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys)), rule)
                hit = np.flatnonzero(_has(bits, at)).tolist()
                yield pa.RecordBatch.from_arrays([
                    pa.array([names[owner[h]] for h in hit], pa.int64()),
                    pa.array([digest[owner[h]] for h in hit], pa.string()),
                    pa.array([keys[h] for h in hit], pa.binary()),
                    pa.array([where[h] for h in hit], pa.list_(pa.int32())),
                ], schema=schema)

    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return source.mapInArrow(probe, "doc_id bigint, text_digest string, line_key binary, lines array<int>")


def repeated_keys(found: DataFrame, rule: LineRule) -> DataFrame:
    """line_key, n_docs, first: the keys of at least min_docs documents, and the first place of each."""
    return (
        found.groupBy("line_key")
        .agg(F.count("*").alias("n_docs"), F.min(F.struct("doc_id", "text_digest", F.element_at("lines", 1).alias("line"))).alias("first"))
        .where(F.col("n_docs") >= rule.min_docs)
    )


def drop_repeated_lines(docs: DataFrame, rule: LineRule = LineRule()) -> tuple[DataFrame, list[str]]:
    """The documents with the columns n_lines, n_dropped and kept text added; the names of these three.

    With `keep_first` the first occurrence, by doc_id, stays; copies of one row with one id keep it each.
    """
    found = stored(suspects(docs, rule), "line-suspects")
    keys = stored(repeated_keys(found, rule), "line-keys")
    hits = found.join(keys, "line_key")
    lines = F.col("lines")
    if rule.keep_first:
        is_first = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.text_digest") == F.col("text_digest"))
        lines = F.when(is_first, F.slice("lines", 2, F.size("lines"))).otherwise(lines)
    of_id, of_text, drop, n_lines, n_dropped, kept, own = fresh(docs, "of_id", "of_text", "drop_lines", "n_lines", "n_dropped", "kept_text", "own_text")
    drops = hits.groupBy(F.col("doc_id").alias(of_id), F.col("text_digest").alias(of_text)).agg(
        F.array_distinct(F.flatten(F.collect_set(lines))).alias(drop)  # a set: copies of a row add nothing
    )
    return _without(docs, drops, of_id, of_text, drop, n_lines, n_dropped, kept), [n_lines, n_dropped, kept]


def _without(docs: DataFrame, drops: DataFrame, of_id: str, of_text: str, drop: str, n_lines: str, n_dropped: str, kept: str) -> DataFrame:
    whole = F.coalesce(F.col("text").cast("string"), F.lit(""))
    same = docs["doc_id"].cast("bigint").eqNullSafe(drops[of_id]) & (F.md5(F.coalesce(docs["text"].cast("string"), F.lit(""))) == drops[of_text])
    parts = F.split(whole, "\n", -1)
    numbers = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(drop))
    text = F.when(F.col(drop).isNull(), whole).otherwise(F.array_join(F.transform(numbers, lambda i: F.get(parts, i)), "\n"))
    return docs.join(drops, same, "left").select(
        *[docs[c] for c in docs.columns],
        F.size(parts).cast("bigint").alias(n_lines),
        F.coalesce(F.size(F.col(drop)), F.lit(0)).cast("bigint").alias(n_dropped),
        text.alias(kept),
    )


def line_digest(docs: DataFrame, rule: LineRule) -> DataFrame:
    out, (n_lines, n_dropped, kept) = drop_repeated_lines(docs.select("doc_id", "text"), rule)
    return out.select("doc_id", F.col(n_lines).alias("n_lines"), F.col(n_dropped).alias("n_dropped"), F.sha2(F.col(kept), 256).alias("kept_sha256"))

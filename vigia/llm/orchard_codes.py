"""Short codes for vectors: one small codebook for each part of the vector, searched by Orchard's method.

A component x becomes the integer floor(scale * x), so every figure is exact. A vector is cut into equal
consecutive parts; each part position has a codebook that starts as that part of the vectors of least id
and is refined in rounds: every part is assigned to its nearest entry, and an entry becomes the mean
(rounded down) of the parts assigned to it.

Search: every entry keeps the list of all entries of its codebook, nearest first. A query goes down the
list of its best entry so far, measures the entries it has not visited yet, and jumps to the list of an
entry that is nearer (or as near, with a lower index). By the triangle inequality nothing is left to find
once the list is beyond twice the distance of the best entry. All queries of a batch walk together in numpy.

Spark deals out the vectors; a task hands on one sum per component of the codebooks, and the codebooks
(parts x entries vectors of one part each) are all that passes through the driver.

Defined results: vectors that are missing or hold a missing or non-finite component are dropped, and so
are those that cannot be cut (length 0 or no multiple of `parts`) or whose length differs from that of the
kept vector of least id. Missing ids come after all others, equal ids are ordered by their vectors, repeated rows count each.
Components beyond +-2^24 after scaling are taken at that bound, so that all sums fit 64 bits. With fewer kept vectors than
entries the codebooks are smaller. An empty table gives an empty result. Other columns stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigia.durable import stored
from vigia.llm.textkit import fresh
from vigia.operators.lookup import lookup

_MOST = 1 << 24


@dataclass(frozen=True)
class CodeRule:
    parts: int = 16
    entries: int = 64  # at most 256: two hex digits
    rounds: int = 2
    scale: int = 256
    batch_parts: int = 1 << 16  # parts that walk together


@dataclass(frozen=True)
class Codebooks:
    """The entries of all parts, one below the other: shape (parts * size, width)."""

    entries: np.ndarray
    parts: int

    @property
    def size(self) -> int:
        return len(self.entries) // self.parts

    @property
    def width(self) -> int:
        return self.entries.shape[1]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


class OrchardSearch:
    """Neighbour lists of all codebooks; entries carry their number over all parts."""

    def __init__(self, books: Codebooks):
        self.books = books
        parts, size = books.parts, books.size
        cut = books.entries.reshape(parts, size, books.width)
        gaps = ((cut[:, :, None, :] - cut[:, None, :, :]) ** 2).sum(axis=3)
        order = np.argsort(gaps, axis=2, kind="stable")
        self.gap = np.take_along_axis(gaps, order, axis=2).reshape(parts * size, size)
        self.near = (order + (np.arange(parts) * size)[:, None, None]).reshape(parts * size, size)

    def nearest(self, points: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each point's codebook, ties to the lower index, and its squared distance."""
        entries, size = self.books.entries, self.books.size
        best = part * size
        distance = ((points - entries[best]) ** 2).sum(axis=1)
        visited = np.zeros((len(points), size), dtype=bool)
        visited[:, 0] = True
        place = np.zeros(len(points), dtype=np.int64)
        live = np.arange(len(points))
        while len(live):
            within = self.gap[best[live], place[live]] <= 4 * distance[live]
            live = live[within]
            entry = self.near[best[live], place[live]]
            place[live] += 1
            new = ~visited[live, entry % size]
            at, entry = live[new], entry[new]
            visited[at, entry % size] = True
            found = ((points[at] - entries[entry]) ** 2).sum(axis=1)
            nearer = (found < distance[at]) | ((found == distance[at]) & (entry < best[at]))
            at, entry = at[nearer], entry[nearer]
            best[at], distance[at], place[at] = entry, found[nearer], 0
            live = live[place[live] < size]
        return best, distance


def usable(vectors: DataFrame, rule: CodeRule) -> DataFrame:
    """The rows whose vector can be coded."""
    vector = F.col("embedding").cast("array<double>")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & (F.size("embedding") % rule.parts == 0) & F.coalesce(sound, F.lit(False)))


def _integers(values: np.ndarray, rule: CodeRule) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * rule.scale), -_MOST, _MOST).astype(np.int64)


def _points(batch: pa.RecordBatch, column: int, rule: CodeRule, width: int) -> np.ndarray:
    flat = batch.column(column).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return _integers(flat, rule).reshape(-1, width)


def first_entries(kept: DataFrame, rule: CodeRule) -> Codebooks | None:
    """The parts of the kept vectors of least id; None if nothing is kept."""
    vector = F.col("embedding").cast("array<double>").alias("vector")
    least = kept.select("vec_id", vector).orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(rule.entries).collect()
    if not least:
        return None
    rows = [r.vector for r in least]
    while any(len(v) != len(rows[0]) for v in rows):  # other lengths are not kept, so others move up
        alike = kept.where(F.size("embedding") == len(rows[0]))
        rows = [r.vector for r in alike.select("vec_id", vector).orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(rule.entries).collect()]
    whole = _integers(np.array(rows), rule)
    cut = whole.reshape(len(rows), rule.parts, -1).transpose(1, 0, 2)
    return Codebooks(np.ascontiguousarray(cut.reshape(rule.parts * len(rows), -1)), rule.parts)


def _of_width(kept: DataFrame, books: Codebooks) -> DataFrame:
    return kept.where(F.size("embedding") == books.parts * books.width)


def refined(kept: DataFrame, books: Codebooks, rule: CodeRule) -> Codebooks:
    """One round: entries become the means of the parts nearest to them; unused entries stay."""
    shared = kept.sparkSession.sparkContext.broadcast(books)
    schema = pa.schema([("cell", pa.int32()), ("total", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        search = OrchardSearch(own)
        totals = np.zeros((len(own.entries), own.width + 1), dtype=np.int64)  # the last column counts
        rows = max(1, rule.batch_parts // own.parts)
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                points = _points(batch.slice(i, rows), 0, rule, own.width)
                entry, _ = search.nearest(points, np.tile(np.arange(own.parts), len(points) // own.parts))
                order = np.argsort(entry, kind="stable")
                used, starts = np.unique(entry[order], return_index=True)
                totals[used, :-1] += np.add.reduceat(points[order], starts, axis=0)
                totals[used, -1] += np.diff(np.append(starts, len(entry)))
        flat = totals.ravel()
        cells = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(flat[cells], pa.int64())], schema=schema)

    partial = _of_width(kept, books).select("embedding").mapInArrow(run, "cell int, total bigint")
    totals = np.zeros((len(books.entries), books.width + 1), dtype=np.int64)
    for cell, total in partial.groupBy("cell").agg(F.sum("total").alias("total")).collect():  # one row per component of the codebooks
        totals.flat[cell] = total
    counts = totals[:, -1:]
    return Codebooks(np.where(counts > 0, totals[:, :-1] // np.maximum(counts, 1), books.entries), books.parts)


def fit(vectors: DataFrame, rule: CodeRule = CodeRule()) -> Codebooks | None:
    """Codebooks from all usable vectors; None if there are none."""
    kept = usable(vectors, rule)
    books = first_entries(kept, rule)
    for _ in range(rule.rounds if books else 0):
        books = refined(kept, books, rule)
    return books


def encode(vectors: DataFrame, books: Codebooks, rule: CodeRule = CodeRule()) -> tuple[DataFrame, list[str]]:
    """The usable rows with their code (hex) and squared error added, and the names of these two columns."""
    names = fresh(vectors, "code", "error")
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        search = OrchardSearch(own)
        rows = max(1, rule.batch_parts // own.parts)
        for batch in batches:
            column = batch.schema.get_field_index("embedding")
            for i in range(0, batch.num_rows, rows):
                some = batch.slice(i, rows)
                points = _points(some, column, rule, own.width)
                entry, error = search.nearest(points, np.tile(np.arange(own.parts), len(points) // own.parts))
                code = (entry % own.size).astype(np.uint8).reshape(-1, own.parts)
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(error.reshape(-1, own.parts).sum(axis=1), pa.int64())],
                    names=[*some.schema.names, *names])

    schema = T.StructType([*vectors.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.LongType())])
    return _of_width(usable(vectors, rule), books).mapInArrow(run, schema), names


def code_digest(vectors: DataFrame, rule: CodeRule = CodeRule()) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every usable row."""
    vectors = vectors.select("vec_id", "embedding", "label")
    books = fit(vectors, rule)
    if books is None:
        return vectors.where(F.lit(False)).select(
            "vec_id", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"), F.lit(0).cast("bigint").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded, _ = encode(vectors, books, rule)
    rows = stored(coded.select("vec_id", F.struct("label").alias("of"), "code", "error"), "vector-codes")
    by_label = stored(rows.groupBy("of").agg(F.sum("error").alias("label_error"), F.count("*").alias("n_rows")), "label-errors")
    # A label may hold any share of the rows; the lookup takes popular ones apart.
    return lookup(rows, by_label, ["of"], "n_rows").select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))

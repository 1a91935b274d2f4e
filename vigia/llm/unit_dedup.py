"""Repeated passages by hashing of units: the earliest occurrence stays, later ones are cut with their offsets.

A unit is a line cut further at sentence ends, because passages recur inside
lines. Its key is the sequence of its lower-cased words, as two 64-bit digests.
A unit of fewer than `min_unit_words` words has the unit before it in its key: such
a word is a repeat only where both recur together. Every unit with a word is
numbered, so that a fresh one ends a run and stays.
A unit of more than `max_unit_words` words is cut after words whose digest is
the least of the seven around them, within the unit: a passage inside a longer
sentence has the same cuts in each document.
The earliest occurrence of a key, by doc_id, then copy, then place, keeps its
unit. Other occurrences are repeats. Neighbouring
repeats of a document form a run, and runs of at least `min_run_words` words
are reported: single short sentences that happen to recur stay. A whole line of
at least `min_line_words` words that repeats an earlier whole line is reported
whatever its length.

How the keys of all documents are grouped:

1. Documents are ranged by their id and stored as one row each, units in arrays.
   The keys of a partition are counted up, so one 64-bit number (`place`) ranks
   every occurrence of every key.
2. Keys are counted by their first digest; nothing else moves. A Bloom filter
   of the digests met twice or more then lets pass the occurrences that may be repeats.
3. What passes is grouped by both digests and read in the order of `place`: the
   first occurrence stays. Digests above 1/`hot_keys` of all occurrences are kept
   apart; their firsts, fewer than `hot_keys` digests, are found by a partial aggregation and broadcast,
   and the document's own row marks their repeats, so popular keys never move.
4. Other repeats return to the row of their document, where runs are formed.

Cases: null, empty and wordless texts have no units; rows with equal ids are
told apart by a number of their own (`copy`, in an order by text), the first of equal rows keeps its
units; a null doc_id ranks first; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigia.durable import Workspace
from vigia.llm import idfilter
from vigia.llm.textkit import IN_LINE, IN_TERM, Pieces, byte_table, chunks, code_points, mixed, pieces, raw_bytes, terms


@dataclass(frozen=True)
class UnitRule:
    min_run_words: int = 20
    min_line_words: int = 3
    min_unit_words: int = 2
    max_unit_words: int = 14
    hot_keys: int = 10_000


_IN_UNIT = ~byte_table(b".!?\n")
_FACTORS = (0xD6E8FEB86659FD93, 0xA5A3564E27F88691)


def sequence_digests(words: Pieces, begin: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Two digests of the words in each range of word numbers."""
    out, n = [], len(words.digest)
    with np.errstate(over="ignore"):
        for factor in _FACTORS:
            powers = np.full(n + 1, factor, dtype=np.uint64)
            powers[0] = 1
            powers = np.cumprod(powers, dtype=np.uint64)
            inverse = np.full(n + 1, pow(factor, -1, 1 << 64), dtype=np.uint64)
            inverse[0] = 1
            inverse = np.cumprod(inverse, dtype=np.uint64)
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(words.digest + np.uint64(factor)) * powers[:n], dtype=np.uint64)])
            out.append(mixed((total[end] - total[begin]) * inverse[begin]))
    return out


def inner_cuts(words: Pieces, begin: np.ndarray, end: np.ndarray, most: int, reach: int = 3) -> np.ndarray:
    """Numbers of the words after which a range of more than `most` words is cut; the ranges cover all words."""
    size = end - begin
    unit = np.repeat(np.arange(len(begin)), size)
    place = np.arange(len(unit)) - begin[unit]
    least = (size[unit] > most) & (place >= 1) & (place <= size[unit] - 3)
    value = mixed(words.digest)
    for d in range(1, reach + 1):
        same = unit[d:] == unit[:-d]
        least[d:] &= ~(same & (value[:-d] <= value[d:]))
        least[:-d] &= ~(same & (value[d:] < value[:-d]))
    return np.flatnonzero(least)


_MARK = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("from_id", T.LongType())])
_LINE_KEYS = np.uint64(0xC2B2AE3D27D4EB4F)
_UNIT_ROWS = (
    "base bigint, doc_id bigint, a array<bigint>, b array<bigint>, gap array<int>, size array<int>, "
    "words array<int>, line_head array<int>, line_units array<int>"
)


def _lists(values: np.ndarray, per_row: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list for each row, of the given lengths."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_row)]), pa.int32()), pa.array(values).cast(kind))


def unit_rows(docs: DataFrame, rule: UnitRule) -> DataFrame:
    """One row for each text with a unit, in ranges of doc_id; `place` of its key i is base + i.

    `a` and `b` hold the keys of the units and then of the whole lines; `gap` the characters between a unit and the
    one before it, `size` its characters, `words` its words; `line_head` and `line_units` the number of a line's
    first unit and how many it has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            for rows, texts in chunks(batch):
                # The words are found in the lower-cased text, the places in the text itself.
                lower, lower_offsets, words = terms(texts)
                data, offsets = raw_bytes(texts)
                where = pieces(data, offsets, _IN_UNIT, hashed=False)
                mine = pieces(lower, lower_offsets, _IN_UNIT, hashed=False)
                begin, end = np.searchsorted(words.start, mine.start), np.searchsorted(words.start, mine.end)
                kept = np.flatnonzero(end > begin)
                begin, end, raw_start, raw_end = begin[kept], end[kept], where.start[kept], where.end[kept]
                cuts = inner_cuts(words, begin, end, rule.max_unit_words)
                raw_words = pieces(data, offsets, IN_TERM, hashed=False)
                begin, end = np.sort(np.concatenate([begin, cuts + 1])), np.sort(np.concatenate([end, cuts + 1]))
                raw_start, raw_end = (np.sort(np.concatenate([x, raw_words.end[cuts]])) for x in (raw_start, raw_end))
                chars, doc = code_points(data), words.doc[begin]
                keyed = begin.copy()
                after = np.flatnonzero((end - begin)[1:] < rule.min_unit_words) + 1
                after = after[doc[after] == doc[after - 1]]
                keyed[after] = begin[after - 1]
                a, b = sequence_digests(words, keyed, end)
                lines = pieces(lower, lower_offsets, IN_LINE, hashed=False)
                line_begin, line_end = np.searchsorted(words.start, lines.start), np.searchsorted(words.start, lines.end)
                head, stop = np.searchsorted(begin, line_begin), np.searchsorted(begin, line_end)
                whole = np.flatnonzero((line_end - line_begin >= rule.min_line_words) & (stop > head))
                head, stop = head[whole], stop[whole]
                # Keys of lines are a kind of their own.
                line_a, line_b = (mixed(x ^ _LINE_KEYS) for x in sequence_digests(words, line_begin[whole], line_end[whole]))
                first = np.searchsorted(doc, np.arange(rows.num_rows))
                has = np.flatnonzero(np.diff(np.append(first, len(doc))) > 0)
                n_units = np.diff(np.append(first, len(doc)))[has]
                n_lines = np.bincount(doc[head], minlength=rows.num_rows)[has]
                start, close = chars(raw_start), chars(raw_end)
                before = np.concatenate([[0], close[:-1]])[: len(close)]
                before[first[has]] = chars(offsets[has])
                order = np.argsort(np.concatenate([doc, doc[head]]), kind="stable")
                total = np.cumsum(n_units + n_lines)
                yield pa.RecordBatch.from_arrays([
                    pa.array(base + np.concatenate([[0], total[:-1]])[: len(total)], pa.int64()), rows.column(0).cast(pa.int64()).take(pa.array(has)),
                    *(_lists(np.concatenate(k)[order].view(np.int64), n_units + n_lines, pa.int64()) for k in ((a, line_a), (b, line_b))),
                    *(_lists(v, n_units, pa.int32()) for v in (start - before, close - start, end - begin)),
                    _lists(head - first[doc[head]], n_lines, pa.int32()), _lists(stop - head, n_lines, pa.int32()),
                ], names=["base", "doc_id", "a", "b", "gap", "size", "words", "line_head", "line_units"])
                base += int(total[-1]) if len(total) else 0

    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    # Rows of one id, or without one, are ranged by their text and then by their position.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    ranked = source.select("doc_id", "text", order[1].alias("by_text"), order[2].alias("by_row"))
    keys = [order[0], "by_text", "by_row"]
    return ranked.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text").mapInArrow(run, _UNIT_ROWS)


def _occurrences(rows: DataFrame, repeated: Broadcast, hot: Broadcast, popular: bool) -> DataFrame:
    """a, b, place, i, doc_id of the keys that may be repeats and are, or are not, among the popular ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, doc_id, a, b = batch.columns
            per_row = pc.list_value_length(a).to_numpy(zero_copy_only=False)
            a, b = a.flatten().to_numpy(zero_copy_only=False), b.flatten().to_numpy(zero_copy_only=False)
            number = np.arange(len(a)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
            at = np.flatnonzero(np.isin(a, hot.value) == popular)
            at = at[idfilter.contains(repeated.value, a[at].view(np.uint64))]
            row = np.repeat(np.arange(len(per_row)), per_row)[at]
            place = base.to_numpy(zero_copy_only=False)[row] + number[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[at]), pa.array(b[at]), pa.array(place), pa.array(number[at], pa.int32()), doc_id.take(pa.array(row))], names=["a", "b", "place", "i", "doc_id"])

    return rows.select("base", "doc_id", "a", "b").mapInArrow(run, "a bigint, b bigint, place bigint, i int, doc_id bigint")


def _with_popular(rows: DataFrame, firsts: Broadcast) -> DataFrame:
    """The rows without keys, with the repeats of popular keys in `popular` (i, from_id)."""
    kept = ["base", "doc_id", "gap", "size", "words", "line_head", "line_units"]
    mark = pa.list_(pa.struct([("i", pa.int32()), ("from_id", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_a, first_b, first_place, from_id = firsts.value
        for batch in batches:
            base, a, b = (batch.column(batch.schema.get_field_index(c)) for c in ("base", "a", "b"))
            per_row = pc.list_value_length(a).to_numpy(zero_copy_only=False)
            a, b = a.flatten().to_numpy(zero_copy_only=False), b.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(per_row)), per_row)
            number = np.arange(len(a)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
            low, high = np.searchsorted(first_a, a), np.searchsorted(first_a, a, side="right")
            found = np.full(len(a), -1)
            for step in range(int((high - low).max(initial=0))):  # firsts of one digest a differ in b
                at = np.flatnonzero(low + step < high)
                at = at[first_b[low[at] + step] == b[at]]
                found[at] = low[at] + step
            at = np.flatnonzero(found >= 0)
            at = at[base.to_numpy()[row[at]] + number[at] > first_place[found[at]]]
            marks = pa.StructArray.from_arrays([pa.array(number[at], pa.int32()), from_id.take(pa.array(found[at]))], fields=list(mark.value_type))
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[at], minlength=len(per_row)))]), pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.ListArray.from_arrays(offsets, marks)], names=[*kept, "popular"])

    schema = [rows.schema[c] for c in kept]
    return rows.mapInArrow(run, T.StructType([*schema, T.StructField("popular", T.ArrayType(_MARK))]))


def _runs(rows: DataFrame, rule: UnitRule) -> DataFrame:
    """The spans of rows that have their repeats in `marks` (i, from_id)."""

    def numbers(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, base, *lists, marks = batch.columns
            gap, size, words, line_head, line_units = map(numbers, lists)
            n_units, n_lines, n_marks = (pc.list_value_length(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in (lists[0], lists[3], marks))
            first_unit, first_line = (np.cumsum(x) - x for x in (n_units, n_lines))
            doc, found = np.repeat(np.arange(len(n_units)), n_units), marks.flatten()
            of, i = np.repeat(np.arange(len(n_marks)), n_marks), pc.struct_field(found, [0]).to_numpy(zero_copy_only=False).astype(np.int64)
            is_line = i >= n_units[of]
            own, source = np.zeros(len(doc), bool), np.zeros(len(doc), np.int64)
            at = (first_unit[of] + i)[~is_line]
            own[at], source[at] = True, np.flatnonzero(~is_line)
            # A line gives a mark to each of its units; a first word of a line may be no repeat by itself.
            line, of_line = (first_line[of] + i - n_units[of])[is_line], of[is_line]
            covered = np.zeros(len(doc) + 1, np.int64)
            np.add.at(covered, first_unit[of_line] + line_head[line], 1)
            np.add.at(covered, first_unit[of_line] + line_head[line] + line_units[line], -1)
            whole = np.cumsum(covered[:-1]) > 0

            def run_numbers(some: np.ndarray) -> np.ndarray:
                begins = some.copy()
                begins[1:] &= ~(some[:-1] & (doc[1:] == doc[:-1]))
                return np.cumsum(begins) - 1

            number = run_numbers(own)
            long = np.bincount(number[own], weights=words[own]) >= rule.min_run_words
            kept = own.copy()
            kept[own] = long[number[own]] | whole[own]
            number, at = run_numbers(kept)[kept], np.flatnonzero(kept)
            n_runs = int(number[-1]) + 1 if len(number) else 0
            head, stop = np.searchsorted(number, np.arange(n_runs)), np.searchsorted(number, np.arange(n_runs), side="right")
            end = np.cumsum(gap + size)
            end -= np.concatenate([[0], end])[first_unit[doc]]
            start = end - size
            from_id = pc.struct_field(found, [1]).take(pa.array(source[at]))
            known = from_id.is_valid().to_numpy(zero_copy_only=False)
            pairs = np.unique(np.stack([number[known], from_id.drop_null().to_numpy(zero_copy_only=False)]), axis=1)
            row = doc[at[head]]
            yield pa.RecordBatch.from_arrays([
                doc_id.take(pa.array(row)), base.take(pa.array(row)), pa.array(start[at[head]], pa.int32()), pa.array(end[at[stop - 1]], pa.int32()),
                pa.array(stop - head, pa.int64()), pa.array(np.bincount(number, weights=words[at], minlength=n_runs).astype(np.int64)),
                _lists(pairs[1], np.bincount(pairs[0], minlength=n_runs), pa.int64()),
            ], names=["doc_id", "copy", "start", "end", "n_units", "n_words", "first_doc_ids"])

    columns = ["doc_id", "base", "gap", "size", "words", "line_head", "line_units", "marks"]
    return rows.select(*columns).mapInArrow(run, "doc_id bigint, copy bigint, start int, end int, n_units bigint, n_words bigint, first_doc_ids array<bigint>")


def repeats(docs: DataFrame, rule: UnitRule = UnitRule()) -> DataFrame:
    """The spans to cut: doc_id, copy, start, end (characters), n_units, n_words, first_doc_ids.

    `first_doc_ids` lists the documents that keep the units of the span.
    """
    spark = docs.sparkSession
    with Workspace(spark) as work:
        rows = work.stored(unit_rows(docs, rule), "unit-rows")
        counts = rows.select(F.explode("a").alias("a")).groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
        repeated = work.stored(counts, "repeated-digests")
        total = rows.agg(F.coalesce(F.sum(F.size("a")), F.lit(0)).alias("n")).head().n
        hot = [r.a for r in repeated.where(F.col("n") * rule.hot_keys > total).select("a").collect()]
        hot = spark.sparkContext.broadcast(np.array(hot, dtype=np.int64))
        suspected = spark.sparkContext.broadcast(idfilter.build(repeated.select("a")))
        popular = _occurrences(rows, suspected, hot, True)
        found = popular.groupBy("a", "b").agg(F.min("place").alias("first"), F.min_by("doc_id", "place").alias("from_id"))
        found = sorted((tuple(r) for r in found.collect()), key=lambda r: r[:2])
        numbers = [np.array([r[c] for r in found], dtype=np.int64) for c in range(3)]
        firsts = spark.sparkContext.broadcast((*numbers, pa.array([r[3] for r in found], pa.int64())))
        by_key = Window.partitionBy("a", "b").orderBy("place")
        others = _occurrences(rows, suspected, hot, False).select(
            "place", "i", F.row_number().over(by_key).alias("nth"), F.first("doc_id").over(by_key).alias("from_id")).where("nth > 1")
        marks = others.groupBy((F.col("place") - F.col("i")).alias("base")).agg(F.collect_list(F.struct("i", "from_id")).alias("others"))
        marked = _with_popular(rows, firsts).join(marks, "base", "left")
        marked = marked.withColumn("marks", F.concat("popular", F.coalesce("others", F.array().cast(T.ArrayType(_MARK))))).where(F.size("marks") > 0)
        return work.kept(_runs(marked, rule), "repeats")


def kept_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, kept: what stays of each document with repeats, as start, end and text of the pieces between the cuts.

    Offsets are those of the original text. Rows with equal ids share their cuts; with unique ids nothing is shared.
    """
    cuts = spans.groupBy(F.col("doc_id").alias("of_id")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("whole"))
    joined = rows.join(cuts, F.col("doc_id").cast("bigint").eqNullSafe(F.col("of_id")))
    begins = F.concat(F.array(F.lit(0)), F.transform("cuts", lambda c: c["end"]))
    ends = F.concat(F.transform("cuts", lambda c: c["start"]), F.array(F.length("whole")))
    parts = F.filter(F.arrays_zip(begins.alias("start"), ends.alias("end")), lambda p: p["end"] > p["start"])
    return joined.select("doc_id", F.transform(parts, lambda p: F.struct(
        p["start"].alias("start"), p["end"].alias("end"), F.substring(F.col("whole"), p["start"] + 1, p["end"] - p["start"]).alias("text"),
    )).alias("kept"))

"""How far the sources of a language diverge in their words, with strings materialised late.

Terms are counted by 64-bit digest: what is shuffled for the counts is a group and a fixed-width number,
never a string. When the kept vocabulary is known, a second pass over the texts brings, for digests of
that vocabulary only, the least and the greatest string met. Where they differ, terms collide: their digests are counted
again by string and split. Strings join the result at the end, for the rows that are put out.

The divergence of two sources is the sum over the kept terms of the differences of their smoothed shares.
Terms are dealt into blocks; a task holds the shares of one block for all sources of the language, and
its sums for each pair of sources are added up.

Defined results: missing text, language and source are empty strings. A document's language and source
form a group even without terms; a language without kept terms has divergences of 0 and no term rows.
Repeated rows and ids count as documents of their own. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigia.durable import stored
from vigia.llm import idfilter
from vigia.llm.textkit import byte_table, chunks, digests, pieces, raw_bytes
from vigia.operators.lookup import lookup

#: ASCII letters and every byte of a character beyond ASCII.
IN_AUDIT_TERM = byte_table([*range(65, 91), *range(97, 123), *range(128, 256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class AuditRule:
    min_docs: int = 30
    smoothing: int = 5
    scale: int = 1_000_000_000
    top_terms: int = 50
    digest_bits: int = 64  # fewer bits in tests, so that terms collide
    block_cells: int = 1 << 17  # shares that one task holds
    held_rows: int = 1 << 20  # counts that one task gathers before it hands them on


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


@dataclass
class Terms:
    """The terms of a chunk: the text and the dictionary place of each occurrence; strings and digests of the dictionary."""

    doc: np.ndarray
    code: np.ndarray
    strings: pa.Array
    digest: np.ndarray


def chunk_terms(texts: pa.Array, bits: int = 64) -> Terms:
    data, offsets = raw_bytes(texts)
    data = _LOWER[data]
    found = pieces(data, offsets, IN_AUDIT_TERM, hashed=False)
    ends = np.concatenate([[0], np.cumsum(found.end - found.start)]).astype(np.int64)
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(found.start), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data[IN_AUDIT_TERM[data]]))])
    coded = whole.dictionary_encode()
    held, starts = raw_bytes(coded.dictionary)
    digest = digests(held, starts[:-1], starts[1:]) if len(coded.dictionary) else np.zeros(0, dtype=np.uint64)
    if bits < 64:
        digest = digest & np.uint64((1 << bits) - 1)
    return Terms(found.doc, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, digest)


def _added(keys: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order with the sums of their weights."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], *[np.add.reduceat(w[order], starts) if len(starts) else w[:0] for w in weights]


class GroupCounts:
    """Documents and occurrences by group and term of one task; terms are digests, or numbers of strings."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.group, self.term = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        self.docs, self.uses = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, langs: list[str], sources: list[str], doc: np.ndarray, code: np.ndarray, term: np.ndarray) -> None:
        """Add occurrences; `term` is what the codes of the dictionary stand for."""
        owner = np.fromiter((self.groups.setdefault(g, len(self.groups)) for g in zip(langs, sources, strict=True)), np.int64, len(langs))
        distinct_terms, place = np.unique(term, return_inverse=True)  # colliding strings are one term
        width = max(1, len(distinct_terms))
        per_doc, uses = _added(doc * width + place[code], np.ones(len(doc), np.int64))
        per_group, docs, uses = _added(owner[per_doc // width] * width + per_doc % width, np.ones(len(per_doc), np.int64), uses)
        group = np.concatenate([self.group, per_group // width])
        both = np.concatenate([self.term, distinct_terms[per_group % width] if len(per_group) else np.zeros(0, np.uint64)])
        order = np.lexsort((both, group))
        group, both = group[order], both[order]
        first = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (both[1:] != both[:-1])])) if len(group) else np.zeros(0, np.int64)
        sums = [np.add.reduceat(np.concatenate(x)[order], first) if len(first) else x[0] for x in ((self.docs, docs), (self.uses, uses))]
        self.group, self.term, (self.docs, self.uses) = group[first], both[first], sums

    def take(self) -> tuple[list[pa.Array], np.ndarray]:
        """Group, documents and occurrences as columns, and the terms; the counts begin anew."""
        names = list(self.groups)
        columns = [pa.array([names[g][i] for g in self.group], pa.string()) for i in (0, 1)]
        columns += [pa.array(self.docs, pa.int64()), pa.array(self.uses, pa.int64())]
        term = self.term
        self.__init__()
        return columns, term


def term_counts(docs: DataFrame, rule: AuditRule) -> DataFrame:
    """lang, source, digest, n_docs, n_uses: one row for each group and digest."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("digest", pa.int64()), ("n_docs", pa.int64()), ("n_uses", pa.int64())])

    def hand_on(counts: GroupCounts) -> pa.RecordBatch:
        (lang, source, n_docs, n_uses), term = counts.take()
        return pa.RecordBatch.from_arrays([lang, source, pa.array(term.view(np.int64)), n_docs, n_uses], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = GroupCounts()
        for batch in batches:
            for rows, texts in chunks(batch):
                t = chunk_terms(texts, rule.digest_bits)
                counts.add(rows.column(0).to_pylist(), rows.column(1).to_pylist(), t.doc, t.code, t.digest)
                if len(counts.term) > rule.held_rows:
                    yield hand_on(counts)
        yield hand_on(counts)

    partial = _source(docs).mapInArrow(run, "lang string, source string, digest bigint, n_docs bigint, n_uses bigint")
    return partial.groupBy("lang", "source", "digest").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_uses").alias("n_uses"))


def term_strings(docs: DataFrame, wanted: DataFrame, rule: AuditRule) -> DataFrame:
    """digest, low, high: the least and the greatest string of each digest of `wanted` that stands in a text."""
    shared = docs.sparkSession.sparkContext.broadcast(idfilter.build(wanted.select("digest")))
    schema = pa.schema([("digest", pa.int64()), ("term", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[bytes] = set()
        for batch in batches:
            for _, texts in chunks(batch):
                t = chunk_terms(texts, rule.digest_bits)
                at = np.flatnonzero(idfilter.contains(shared.value, t.digest))
                strings = t.strings.take(pa.array(at)).to_pylist()
                new = [i for i, s in enumerate(strings) if s not in told]
                if len(told) > rule.held_rows:
                    told.clear()
                told.update(strings[i] for i in new)
                yield pa.RecordBatch.from_arrays([pa.array(t.digest[at[new]].view(np.int64)), pa.array([strings[i].decode() for i in new], pa.string())], schema=schema)

    found = _source(docs).select("text").mapInArrow(run, "digest bigint, term string")
    return found.groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high"))


def counts_by_string(docs: DataFrame, colliding: DataFrame, rule: AuditRule) -> DataFrame:
    """lang, source, digest, term, n_docs, n_uses: the colliding digests counted again by string."""
    shared = docs.sparkSession.sparkContext.broadcast(idfilter.build(colliding.select("digest")))
    names = ["lang", "source", "digest", "term", "n_docs", "n_uses"]

    def hand_on(counts: GroupCounts, strings: list[bytes], digest: list[int]) -> pa.RecordBatch:
        (lang, source, n_docs, n_uses), term = counts.take()
        at = term.astype(np.int64)
        return pa.RecordBatch.from_arrays([
            lang, source, pa.array(np.array(digest, np.uint64)[at].view(np.int64) if len(at) else [], pa.int64()),
            pa.array([strings[i].decode() for i in at], pa.string()), n_docs, n_uses], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, number, digest = GroupCounts(), {}, []
        for batch in batches:
            for rows, texts in chunks(batch):
                t = chunk_terms(texts, rule.digest_bits)
                hit = idfilter.contains(shared.value, t.digest)
                place = np.zeros(len(t.digest), dtype=np.uint64)
                for i in np.flatnonzero(hit).tolist():
                    place[i] = own = number.setdefault(t.strings[i].as_py(), len(number))
                    if own == len(digest):
                        digest.append(int(t.digest[i]))
                kept = hit[t.code]
                counts.add(rows.column(0).to_pylist(), rows.column(1).to_pylist(), t.doc[kept], t.code[kept], place)
                if len(counts.term) > rule.held_rows:
                    yield hand_on(counts, list(number), digest)
                    number, digest = {}, []
        yield hand_on(counts, list(number), digest)

    partial = _source(docs).mapInArrow(run, "lang string, source string, digest bigint, term string, n_docs bigint, n_uses bigint")
    exact = partial.join(colliding.select("digest"), "digest", "left_semi")
    return exact.groupBy("lang", "source", "digest", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_uses").alias("n_uses"))


def _vocabulary(counts: DataFrame, rule: AuditRule) -> DataFrame:
    """The terms of each language that are in enough of its documents, with their uses there."""
    keys = [c for c in ("lang", "digest", "term") if c in counts.columns]
    total = counts.groupBy(*keys).agg(F.sum("n_docs").alias("docs"), F.sum("n_uses").alias("lang_uses"))
    return total.where(F.col("docs") >= rule.min_docs).drop("docs")


def kept_counts(docs: DataFrame, rule: AuditRule) -> tuple[DataFrame, DataFrame]:
    """The counts of kept terms by group, and the string of each digest that stands for one.

    First: lang, source, digest, term, n_uses, lang_uses; `term` is filled for terms whose digests collide.
    Second: digest, low.
    """
    counts = stored(term_counts(docs, rule), "audit-counts")
    vocabulary = stored(_vocabulary(counts, rule), "audit-vocabulary")
    strings = stored(term_strings(docs, vocabulary.select("digest").distinct(), rule), "audit-strings")
    colliding = strings.where("low <> high")
    none = F.lit(None).cast("string")
    counts = counts.drop("n_docs").join(vocabulary, ["lang", "digest"]).withColumn("term", none)
    if not colliding.isEmpty():
        again = stored(counts_by_string(docs, colliding, rule), "audit-collisions")
        split = again.drop("n_docs").join(_vocabulary(again, rule), ["lang", "digest", "term"])
        counts = counts.join(colliding, "digest", "left_anti").unionByName(split)
    return stored(counts, "audit-kept"), strings


def _share(uses: Column, total: Column, terms: Column, rule: AuditRule) -> Column:
    """1 + floor(scale * (uses + smoothing) / (total + smoothing * terms)); decimals, as the product may leave 64 bits."""
    wide = [c.cast("decimal(20,0)") for c in (uses, total, terms)]
    whole = F.greatest(wide[1] + F.lit(rule.smoothing) * wide[2], F.lit(1))  # no term, no share
    return F.call_function("div", F.lit(rule.scale).cast("decimal(11,0)") * (wide[0] + F.lit(rule.smoothing)), whole) + 1


def audit(docs: DataFrame, rule: AuditRule = AuditRule()) -> DataFrame:
    """lang, source, part, item, value, rank: divergence from each other source, and the terms that mark the source."""
    kept, strings = kept_counts(docs, rule)
    groups = _source(docs).select("lang", "source").distinct()
    of_lang = (
        groups.groupBy("lang").agg(F.count("*").alias("n_sources"))
        .join(kept.select("lang", "digest", "term", "lang_uses").distinct().groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("lang_uses").alias("lang_total")), "lang", "left")
        .fillna(0, ["n_terms", "lang_total"])
    )
    of_group = kept.groupBy("lang", "source").agg(F.sum("n_uses").alias("total"), F.count("*").alias("n_rows"))
    groups = stored(groups.join(of_lang, "lang").join(of_group, ["lang", "source"], "left").fillna(0, ["total", "n_rows"]), "audit-groups")
    shares = lookup(kept, groups, ["lang", "source"], "n_rows").withColumn("p", _share(F.col("n_uses"), F.col("total"), F.col("n_terms"), rule))
    shares = stored(shares.withColumn("q", _share(F.col("lang_uses"), F.col("lang_total"), F.col("n_terms"), rule)), "audit-shares")
    result = ["lang", "source", "part", "item", "value", "rank"]
    own = Window.partitionBy("lang", "source")

    values = shares.where("p > q").withColumn("value", F.col("p") - F.col("q"))
    high = values.withColumn("_at", F.rank().over(own.orderBy(F.desc("value")))).where(F.col("_at") <= rule.top_terms)
    named = high.select("lang", "source", "digest", "term", "value").join(strings.select("digest", "low"), "digest").withColumn("item", F.coalesce("term", "low"))
    top = named.withColumns({"part": F.lit("term"), "rank": F.row_number().over(own.orderBy(F.desc("value"), "item"))}).where(F.col("rank") <= rule.top_terms)

    pairs = divergences(shares, groups, rule).withColumns({"part": F.lit("pair"), "rank": F.row_number().over(own.orderBy(F.desc("value"), "item"))})
    return pairs.select(*result).unionByName(top.select(*result))


def divergences(shares: DataFrame, groups: DataFrame, rule: AuditRule) -> DataFrame:
    """lang, source, item, value: the sum of |p - q| over all kept terms, for each two sources of a language."""
    most = F.greatest(F.lit(1).cast("bigint"), F.expr(f"{rule.block_cells} div n_sources"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n_terms") / most)).cast("int")
    # A share that a source has for every term it does not use; each block has one such row for each source.
    unused = groups.withColumns({"p": _share(F.lit(0), F.col("total"), F.col("n_terms"), rule), "block": F.explode(F.sequence(F.lit(0), blocks - 1))})
    none = F.lit(None)
    rows = unused.select("lang", "block", "source", none.cast("bigint").alias("digest"), none.cast("string").alias("term"), "p").unionByName(
        shares.withColumn("block", F.pmod(F.xxhash64("digest", "term"), blocks).cast("int")).select("lang", "block", "source", "digest", "term", "p"))
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        zero = pc.is_null(table["digest"])
        bases = table.filter(zero)
        sources = bases["source"].to_pylist()
        number = {s: i for i, s in enumerate(sources)}
        used = table.filter(pc.invert(zero))
        names = list(zip(used["digest"].to_pylist(), used["term"].to_pylist(), strict=True))
        column = {t: i for i, t in enumerate(dict.fromkeys(names))}
        p = np.repeat(bases["p"].to_numpy()[:, None], len(column), axis=1)
        p[[number[s] for s in used["source"].to_pylist()], [column[t] for t in names]] = used["p"].to_numpy()
        for i, source in enumerate(sources):
            value = np.delete(np.abs(p - p[i]).sum(axis=1), i)
            others = sources[:i] + sources[i + 1 :]
            yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()] * len(others), pa.string()), pa.array([source] * len(others), pa.string()), pa.array(others, pa.string()), pa.array(value, pa.int64())], schema=schema)

    partial = rows.groupBy("lang", "block").applyInArrow(run, "lang string, source string, item string, value bigint")
    return partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

"""Benchmark passages in training documents: BM25 over test items with block-max pruning, then overlap.

The index holds the items, cut into entries of at most `entry_words` words.
The weight of a term in an entry is its BM25 weight divided by the entry's
score for itself, so that 1 is a full match and `threshold` holds alike for
short and long entries. For each entry the rarest terms that make up
`essential_share` of its weight are essential; a passage without enough weight
among them cannot reach the threshold. Postings of essential terms are grouped
into blocks of `block_entries` entries with the largest weight of each block.

Every passage (a window of `passage_words` words, half overlapping the next) is
a query. As in block-max WAND, the block maxima of its terms, plus what the
block's other terms can add at most, bound the score of every entry of a block;
only blocks whose bound reaches the threshold are opened, and their entries
scored in full. All passages of a chunk advance together in numpy.

An item is confirmed for a document when at least `overlap` of the five-word
shingles of its question (first line) and of its answer (other lines) occur there,
or, since a changed word takes up to five of them, when a stretch of the document is
that side but for word edits of at most a share of 1 - `aligned` of its words. A side
passes either way; its overlap is the larger of the two shares.

Items are indexed in panels of at most `panel_bytes` of text, which bounds what
reaches the executors; all documents are read once for each panel.

Cases: null, empty and wordless texts match nothing, as documents and as items;
parts of fewer than five words are one shingle; repeated rows match each; null
ids are kept; equal items match each; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm.textkit import Pieces, chunks, distinct, grams, terms, text_array


@dataclass(frozen=True)
class BenchRule:
    threshold: float = 0.6
    overlap: float = 0.8
    aligned: float = 0.7
    shingle: int = 5
    entry_words: int = 64
    passage_words: int = 128
    essential_share: float = 0.7
    block_entries: int = 8
    k1: float = 1.2
    b: float = 0.75
    panel_bytes: int = 16 << 20


def _of_text(words: Pieces, i: int) -> Pieces:
    a, b = words.first[i], words.first[i + 1]
    return Pieces(words.doc[a:b], words.start[a:b], words.end[a:b], words.digest[a:b], words.first)


def shingles(words: Pieces, size: int) -> list[tuple[int, np.ndarray]]:
    """Size and distinct digests of the shingles of each text; fewer words than `size` are one shingle."""
    out = []
    for i in range(len(words.first) - 1):
        own = _of_text(words, i)
        n = min(size, len(own.doc))
        out.append((n, np.unique(grams(own, n)[1]) if n else np.zeros(0, np.uint64)))
    return out


@dataclass
class Postings:
    """Rows of (key, weight) for each term, all in one array."""

    first: np.ndarray
    key: np.ndarray
    weight: np.ndarray

    @staticmethod
    def of(n_terms: int, term: np.ndarray, key: np.ndarray, weight: np.ndarray) -> Postings:
        order = np.lexsort((key, term))
        return Postings(np.searchsorted(term[order], np.arange(n_terms + 1)), key[order], weight[order])

    def expand(self, owner: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Owner, key and weight of every posting of the terms."""
        count = self.first[term + 1] - self.first[term]
        at = np.repeat(self.first[term] - np.concatenate([[0], np.cumsum(count)[:-1]]) if len(count) else count, count) + np.arange(count.sum())
        return np.repeat(owner, count), self.key[at], self.weight[at]


class BenchIndex:
    def __init__(self, items: list[tuple[int | None, str]], rule: BenchRule):
        self.rule = rule
        self.item_ids = [i for i, _ in items]
        texts = text_array(pa.array([t for _, t in items], pa.string()))
        _, _, words = terms(texts)
        parts = [((t or "").split("\n", 1) + [""])[:2] for t in texts.to_pylist()]
        sides = [shingles(terms(text_array(pa.array([p[k] for p in parts], pa.string())))[2], rule.shingle) for k in (0, 1)]
        self.question, self.answer = sides
        self.sides = [terms(text_array(pa.array([p[k] for p in parts], pa.string())))[2] for k in (0, 1)]
        entries = [(i, a, min(a + rule.entry_words, int(words.first[i + 1]))) for i in range(len(items)) for a in range(int(words.first[i]), int(words.first[i + 1]), rule.entry_words)]
        self.item_of = np.array([e[0] for e in entries], dtype=np.int64)
        self.vocabulary = np.unique(words.digest)
        n_terms, n = len(self.vocabulary), len(entries)
        rows = [(np.full(b - a, k), np.searchsorted(self.vocabulary, words.digest[a:b])) for k, (_, a, b) in enumerate(entries)]
        entry, term = (np.concatenate([r[j] for r in rows]) if rows else np.zeros(0, np.int64) for j in (0, 1))
        pair, tf = np.unique(entry * max(n_terms, 1) + term, return_counts=True)
        entry, term = pair // max(n_terms, 1), pair % max(n_terms, 1)
        length = np.bincount(entry, tf, minlength=n)
        df = np.bincount(term, minlength=n_terms)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        norm = rule.k1 * (1 - rule.b + rule.b * length / max(length.mean() if n else 1.0, 1e-9))
        weight = idf[term] * tf * (rule.k1 + 1) / (tf + norm[entry])
        weight = weight / np.maximum(np.bincount(entry, weight, minlength=n), 1e-12)[entry]
        order = np.lexsort((df[term], entry))
        entry, term, weight = entry[order], term[order], weight[order]
        total = np.cumsum(weight)
        begin = np.searchsorted(entry, np.arange(n))
        before = total - weight - (total - weight)[begin][entry]
        essential = before < rule.essential_share
        rest = np.bincount(entry[~essential], weight[~essential], minlength=n)
        block = entry // rule.block_entries
        n_blocks = -(-n // rule.block_entries)
        self.rest_of_block = np.zeros(n_blocks)
        np.maximum.at(self.rest_of_block, np.arange(n) // rule.block_entries, rest)
        key, inverse = np.unique(term[essential] * max(n_blocks, 1) + block[essential], return_inverse=True)
        most = np.zeros(len(key))
        np.maximum.at(most, inverse, weight[essential])
        self.blocks = Postings.of(n_terms, key // max(n_blocks, 1), key % max(n_blocks, 1), most)
        self.entries = Postings.of(n_terms, term, entry, weight)
        self.sieve = np.zeros(1 << 20, dtype=bool)
        self.sieve[(self.vocabulary >> np.uint64(44)).astype(np.int64)] = True

    def search(self, words: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, item and best score of each pair above the threshold in some passage of the text."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if not len(self.vocabulary):
            return none
        known = np.flatnonzero(self.sieve[(words.digest >> np.uint64(44)).astype(np.int64)])
        term = np.minimum(np.searchsorted(self.vocabulary, words.digest[known]), len(self.vocabulary) - 1)
        right = self.vocabulary[term] == words.digest[known]
        known, term = known[right], term[right]
        if not len(known):
            return none
        # A passage is two neighbouring halves; a text with h of them has h + 1 passages, the outer ones half empty.
        half = self.rule.passage_words // 2
        halves = -(-np.diff(words.first) // half) + 1
        base = np.concatenate([[0], np.cumsum(halves)])
        doc = words.doc[known]
        at = base[doc] + (known - words.first[doc]) // half
        n_terms = len(self.vocabulary)
        query = distinct(np.concatenate([at, at + 1]) * n_terms + np.concatenate([term, term]))
        passage, term = query // n_terms, query % n_terms
        owner, block, weight = self.blocks.expand(passage, term)
        n_blocks = len(self.rest_of_block)
        pair, inverse = np.unique(owner * n_blocks + block, return_inverse=True)
        bound = np.bincount(inverse, weight, minlength=len(pair)) + self.rest_of_block[pair % n_blocks]
        open_pairs = pair[bound >= self.rule.threshold - 1e-9]
        if not len(open_pairs):
            return none
        mine = np.isin(passage, open_pairs // n_blocks)
        owner, entry, weight = self.entries.expand(passage[mine], term[mine])
        opened = np.isin(owner * n_blocks + entry // self.rule.block_entries, open_pairs)
        n = len(self.item_of)
        pair, inverse = np.unique(owner[opened] * n + entry[opened], return_inverse=True)
        score = np.bincount(inverse, weight[opened], minlength=len(pair))
        hit = score >= self.rule.threshold - 1e-9
        doc = np.searchsorted(base, pair[hit] // n, side="right") - 1
        key, inverse = np.unique(doc * len(self.item_ids) + self.item_of[pair[hit] % n], return_inverse=True)
        best = np.zeros(len(key))
        np.maximum.at(best, inverse, score[hit])
        return key // len(self.item_ids), key % len(self.item_ids), best


def _overlap(side: tuple[int, np.ndarray], text: Pieces, found: dict[int, np.ndarray]) -> float:
    """The share of a side's shingles that the text has; 1 for a side without words."""
    size, digests = side
    if not size:
        return 1.0
    if size not in found:
        found[size] = np.unique(grams(text, size)[1])
    return float(np.isin(digests, found[size]).mean())


def aligned_share(side: np.ndarray, text: np.ndarray) -> float:
    """1 less the word edits, as a share of the side, that turn the side into the stretch of the text most like it."""
    if not len(side):
        return 1.0
    row, steps = np.zeros(len(text) + 1, dtype=np.int64), np.arange(len(text) + 1)
    for i, word in enumerate(side.tolist(), 1):
        best = row + 1
        best[1:] = np.minimum(best[1:], row[:-1] + (text != np.uint64(word)))
        best[0] = i
        row = np.minimum.accumulate(best - steps) + steps
    return 1.0 - float(row.min()) / len(side)


def confirmed(index: BenchIndex, texts: pa.Array) -> Iterator[tuple[int, int, float, float, float]]:
    """Number of the text and of the item, score, and both overlaps, of the pairs that overlap confirms."""
    _, _, words = terms(texts)
    last, text, found = -1, None, {}
    for doc, item, score in zip(*(x.tolist() for x in index.search(words)), strict=True):
        if doc != last:
            last, text, found = doc, _of_text(words, doc), {}
        overlaps, passed = [], True
        for side, own in zip((index.question, index.answer), index.sides, strict=True):
            share = _overlap(side[item], text, found)
            near = aligned_share(_of_text(own, item).digest, text.digest) if share < index.rule.overlap else 0.0
            passed = passed and (share >= index.rule.overlap or near >= index.rule.aligned - 1e-9)
            overlaps.append(max(share, near))
        if passed:
            yield doc, item, min(score, 1.0), *overlaps


def panels(items: DataFrame, rule: BenchRule) -> Iterator[BenchIndex]:
    """The index of each panel of items; a panel holds about `panel_bytes` of text."""
    tests = items.select(F.col("item_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = tests.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, math.ceil(size / rule.panel_bytes))
    of = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for panel in range(n):
        rows = [(r["item_id"], r["text"]) for r in tests.where(of == panel).collect()]
        yield BenchIndex(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])), rule)


def contaminated(docs: DataFrame, items: DataFrame, rule: BenchRule = BenchRule()) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap of every confirmed pair."""
    return reduce(DataFrame.unionAll, [_pairs(docs, index) for index in panels(items, rule)])


def _pairs(docs: DataFrame, index: BenchIndex) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            for rows, texts in chunks(batch):
                ids = rows.column(0)
                out = [(ids[doc].as_py(), held.item_ids[item], *rest) for doc, item, *rest in confirmed(held, texts)]
                columns = zip(*out, strict=True) if out else [[]] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return source.mapInArrow(run, "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double")


def clean(docs: DataFrame, items: DataFrame, rule: BenchRule = BenchRule()) -> DataFrame:
    """The rows of the documents, as they are, in which no item is confirmed: each batch is searched and filtered."""

    def without(index: BenchIndex):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows, texts in chunks(batch):
                    keep = np.ones(rows.num_rows, dtype=bool)
                    keep[[doc for doc, *_ in confirmed(shared.value, texts)]] = False
                    yield rows.filter(pa.array(keep))

        return run

    for index in panels(items, rule):
        docs = docs.mapInArrow(without(index), docs.schema)
    return docs

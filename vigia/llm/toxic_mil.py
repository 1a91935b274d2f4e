"""Toxic documents by multiple-instance learning: a document is toxic if any of its sentences is.

A sentence's score is p = sigmoid(bias + sum of the weights of its distinct
features); a document's is the noisy-or 1 - prod(1 - p). Features are words and
the beginnings of longer words, which compounds and endings leave as they are. Labels exist for
documents only; the gradient of the document's loss reaches each sentence by
its share in the noisy-or, and weights that labels do not steadily support are
shrunk to zero. Sentences with p at or above `locate_at`, and the likeliest ones
of a document that scores one half or more, are reported with their place.

Training reads at most `max_training_docs` labelled documents (those with the
smallest hash of their id), and of their features those that at least
`min_support` toxic ones have, `min_lift` times as often as documents at large;
all else reads every document.

Cases: a null, empty or wordless text has no sentence and scores 0; without a
label of either kind everything scores 0; repeated rows are scored each; a null
doc_id is scored and never trained on; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigia.durable import stored
from vigia.llm.fit import Adam, labelled, repeat_until
from vigia.llm.textkit import byte_table, chunks, code_points, digests, distinct, mixed, pieces, raw_bytes, terms


@dataclass(frozen=True)
class ToxicRule:
    max_training_docs: int = 6000
    width_bits: int = 22
    beginnings: tuple[int, ...] = (5, 6, 7, 8)
    min_support: int = 3
    min_lift: float = 2.0
    rounds: int = 200
    rate: float = 0.1
    shrink: float = 1.5
    locate_at: float = 0.5


@dataclass(frozen=True)
class ToxicModel:
    """Weights of the features that have any, by ascending bucket."""

    bias: float
    buckets: np.ndarray
    weights: np.ndarray
    rule: ToxicRule

    def table(self) -> np.ndarray:
        """The weight of every bucket."""
        out = np.zeros(1 << self.rule.width_bits, dtype=np.float32)
        out[self.buckets] = self.weights
        return out


_IN_SENTENCE = ~byte_table(b".!?\n")


@dataclass
class Sentences:
    """The sentences with a word, of a chunk, and the features found in them (with repeats)."""

    doc: np.ndarray
    number: np.ndarray  # among all sentences of the chunk
    of: np.ndarray  # feature -> index of its sentence
    bucket: np.ndarray


def sentences(texts: pa.Array, rule: ToxicRule) -> Sentences:
    data, offsets, words = terms(texts)
    every = pieces(data, offsets, _IN_SENTENCE, hashed=False)
    at = np.searchsorted(every.start, words.start, side="right") - 1
    head = np.concatenate([[True], at[1:] != at[:-1]]) if len(at) else np.zeros(0, bool)
    of = np.cumsum(head) - 1
    shift = np.uint64(64 - rule.width_bits)
    owners, buckets = [of], [words.digest >> shift]
    for size in rule.beginnings:
        longer = np.flatnonzero(words.end - words.start > size)
        start = words.start[longer]
        owners.append(of[longer])
        buckets.append(mixed(digests(data, start, start + size) ^ np.uint64(size)) >> shift)
    return Sentences(every.doc[at[head]], at[head], np.concatenate(owners), np.concatenate(buckets).astype(np.int64))


def _training_rows(sample: DataFrame, rule: ToxicRule) -> DataFrame:
    """label, n (sentences), sentence, bucket (their distinct pairs) of each document."""
    schema = pa.schema([("label", pa.int32()), ("n", pa.int32()), ("sentence", pa.list_(pa.int32())), ("bucket", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch):
                found = sentences(texts, rule)
                key = distinct((found.of << rule.width_bits) | found.bucket)
                of, bucket = key >> rule.width_bits, key & ((1 << rule.width_bits) - 1)
                first = np.searchsorted(found.doc, np.arange(len(texts) + 1))
                doc = found.doc[of]
                cut = pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cut, pa.array(v.astype(np.int32))) for v in (of - first[doc], bucket)]
                yield pa.RecordBatch.from_arrays([rows.column(1).cast(pa.int32()), pa.array(np.diff(first).astype(np.int32)), *lists], schema=schema)

    return sample.select("text", "label").mapInArrow(run, "label int, n int, sentence array<int>, bucket array<int>")


def _supported(rows: DataFrame, rule: ToxicRule) -> np.ndarray:
    """Buckets that enough toxic documents have, and more often than documents at large."""
    share = rows.agg(F.avg("label")).first()[0] or 0.0
    counts = rows.select("label", F.explode(F.array_distinct("bucket")).alias("bucket")).groupBy("bucket").agg(F.sum("label").alias("t"), F.count("*").alias("n"))
    kept = counts.where((F.col("t") >= rule.min_support) & (F.col("t") >= rule.min_lift * share * F.col("n"))).select("bucket")
    return np.sort(kept.toArrow()["bucket"].to_numpy().astype(np.int64))


def _only(rows: DataFrame, buckets: np.ndarray) -> pa.Table:
    """The same rows with the features of these buckets alone."""
    schema = pa.schema([("label", pa.int32()), ("n", pa.int32()), ("sentence", pa.list_(pa.int32())), ("bucket", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(i) for i in (2, 3)]
            ends = lists[0].offsets.to_numpy()
            sentence, bucket = (x.values.to_numpy()[ends[0] : ends[-1]] for x in lists)
            keep = np.isin(bucket, buckets)
            total = np.concatenate([[0], np.cumsum(keep)])[ends - ends[0]].astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.ListArray.from_arrays(pa.array(total), pa.array(v[keep])) for v in (sentence, bucket))], schema=schema)

    return rows.mapInArrow(run, rows.schema).toArrow()


def train(docs: DataFrame, labels: DataFrame, rule: ToxicRule = ToxicRule(), allowed: Column | None = None) -> ToxicModel:
    """A model from the labels' column `toxic`; `allowed` says which label rows may be used."""
    sample = labelled(docs, labels, "toxic", rule.max_training_docs, F.lit(True) if allowed is None else allowed)
    rows = stored(_training_rows(sample, rule), "toxic-sample")
    known = _supported(rows, rule)
    table = _only(rows, known)
    y = table["label"].to_numpy() > 0
    if not y.any() or y.all():
        return ToxicModel(-50.0, np.zeros(0, np.int64), np.zeros(0), rule)
    lists = [table[name].combine_chunks() for name in ("sentence", "bucket")]
    doc = np.repeat(np.arange(len(y)), pc.list_value_length(lists[0]).to_numpy(zero_copy_only=False))
    sentence, word = (x.flatten().to_numpy().astype(np.int64) for x in lists)
    word = np.searchsorted(known, word)
    key, sentence = np.unique((doc.astype(np.int64) << 32) | sentence, return_inverse=True)
    of_doc = key >> 32
    plain = table["n"].to_numpy() - np.bincount(of_doc, minlength=len(y))  # sentences without any feature
    weights, bias = np.zeros(len(known)), np.array([-5.0])
    by_word, by_bias = Adam(weights, rule.rate), Adam(bias, rule.rate)

    def step() -> float:
        z = bias[0] + np.bincount(sentence, weights[word], minlength=len(of_doc))
        total = np.bincount(of_doc, np.logaddexp(0, z), minlength=len(y)) + plain * np.logaddexp(0, bias[0])
        total = np.maximum(total, 1e-12)
        clear = np.exp(-total)
        # d loss / d total: 1 for a clean document, -clear / (1 - clear) for a toxic one
        of_total = np.where(y, -clear / np.maximum(1 - clear, 1e-12), 1.0)
        slope = of_total[of_doc] / (1 + np.exp(-z))
        by_word.take(np.bincount(word, slope[sentence], minlength=len(known)), rule.shrink)
        by_bias.take(np.array([slope.sum() + (of_total * plain).sum() / (1 + np.exp(-bias[0]))]))
        return float((np.where(y, -np.log(np.maximum(1 - clear, 1e-12)), total).sum() + rule.shrink * np.abs(weights).sum()) / len(y))

    repeat_until(step, rule.rounds)
    used = np.flatnonzero(np.abs(weights) > 1e-6)
    return ToxicModel(float(bias[0]), known[used], weights[used], rule)


def _scores(texts: pa.Array, model: ToxicModel, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, Sentences]:
    """The score of each text, and of each of its sentences."""
    found = sentences(texts, model.rule)
    hit = np.flatnonzero(table[found.bucket])
    key = distinct((found.of[hit] << model.rule.width_bits) | found.bucket[hit])
    of, bucket = key >> model.rule.width_bits, key & ((1 << model.rule.width_bits) - 1)
    z = model.bias + np.bincount(of, table[bucket], minlength=len(found.doc))
    total = np.bincount(found.doc, np.logaddexp(0, z), minlength=len(texts))
    return -np.expm1(-total), 1 / (1 + np.exp(-z)), found


def score(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """doc_id, score, offending: the sentences to blame, as start and end in characters, and score."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("score", pa.float64()),
        ("offending", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in batches:
            for rows, texts in chunks(batch):
                total, p, found = _scores(texts, model, table)
                of_doc = found.doc
                most = np.zeros(len(texts))
                np.maximum.at(most, of_doc, p)
                hit = np.flatnonzero((p >= model.rule.locate_at) | ((p == most[of_doc]) & (total[of_doc] >= 0.5)))
                spans: list[list[dict]] = [[] for _ in range(len(texts))]
                if len(hit):
                    data, offsets = raw_bytes(texts)
                    lines, chars = pieces(data, offsets, _IN_SENTENCE, hashed=False), code_points(data)
                    at = found.number[hit]
                    zero = chars(offsets[of_doc[hit]])
                    for d, a, b, s in zip(of_doc[hit].tolist(), (chars(lines.start[at]) - zero).tolist(), (chars(lines.end[at]) - zero).tolist(), p[hit].tolist(), strict=True):
                        spans[d].append({"start": a, "end": b, "score": s})
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(total), pa.array(spans, schema.field(2).type)], schema=schema)

    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return source.mapInArrow(run, "doc_id bigint, score double, offending array<struct<start:bigint,end:bigint,score:double>>")


def clean(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """The rows of the documents, as they are, that score below one half: no join, each batch is scored and filtered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in batches:
            for rows, texts in chunks(batch):
                yield rows.filter(pa.array(_scores(texts, model, table)[0] < 0.5))

    return docs.mapInArrow(run, docs.schema)

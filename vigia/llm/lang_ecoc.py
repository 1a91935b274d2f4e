"""Language of a text by error-correcting output codes over character n-grams.

Every learned language has a codeword of bits; one binary classifier on hashed
byte 1- to 3-grams predicts each bit. Up to seven languages get the exhaustive
code, more get random codewords of `long_code_bits` bits that differ from one
another. Decoding adds, over the bits, the logistic loss of the classifier's
margin against the codeword's bit, weighted by how well the classifier did in
training; the language of least loss wins, and `score` is the softmax of the
negative losses. A text whose two best losses differ by less than
`ambiguous_below` is flagged.

Training reads at most `max_training_docs` documents (smallest hashes, the
same number of each language at most); every document is predicted from its whole text.

Cases: a null text or one without a letter is `und` with score 0; nothing to
learn from makes all `und`; one language only is predicted for every text with
letters; repeated rows and null ids are predicted each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigia.llm.fit import Adam, repeat_until
from vigia.llm.textkit import chunks, mixed, raw_bytes


@dataclass(frozen=True)
class LanguageRule:
    max_training_docs: int = 4000
    width: int = 2048
    rounds: int = 300
    rate: float = 0.05
    decay: float = 1e-4
    long_code_bits: int = 40
    ambiguous_below: float = 0.5
    chunk_bytes: int = 1 << 20


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    code: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # languages x bits, -1 or 1
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # features x bits
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))
    trust: np.ndarray = field(default_factory=lambda: np.zeros(0))


def codewords(n: int, long_bits: int) -> np.ndarray:
    """A row for each language; columns that do not split the languages are left out."""
    if n <= 7:  # every split of the languages once
        columns = [[1 if row == 0 or (mask >> (row - 1)) & 1 else -1 for row in range(n)] for mask in range((1 << (n - 1)) - 1)]
        return np.array(columns, dtype=np.float64).reshape(-1, n).T
    draw = np.random.default_rng(n)
    best, least = None, -1
    for _ in range(200):
        code = draw.choice([-1.0, 1.0], size=(n, max(long_bits, 4 * n.bit_length())))
        apart = ((code[:, None, :] != code[None, :, :]).sum(axis=2) + np.eye(n, dtype=int) * 1000).min()
        if apart > least and (np.abs(code.sum(axis=0)) < n).all():
            best, least = code, apart
    return best


def features(texts: pa.Array, width: int) -> np.ndarray:
    """Square roots of the shares of hashed byte 1- to 3-grams, one row for each text."""
    data, offsets = raw_bytes(pc.utf8_lower(texts))
    out = np.zeros((len(texts), width), dtype=np.float32)
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(offsets))
    code = data.astype(np.int64)
    for size in (1, 2, 3):
        n = len(data) - size + 1
        if n <= 0:
            break
        gram = np.zeros(n, dtype=np.int64)
        for j in range(size):
            gram = (gram << 8) | code[j : j + n]
        table = (mixed(np.arange(1 << 8 * size, dtype=np.uint64) + np.uint64(size << 32)) % np.uint64(width)).astype(np.int64) if size < 3 else None
        at = table[gram] if table is not None else _trigram_table(width)[gram]
        inside = doc[:n] == doc[size - 1 :]
        out += np.bincount(doc[:n][inside] * width + at[inside], minlength=out.size).reshape(out.shape)
    return np.sqrt(out / np.maximum(out.sum(axis=1, keepdims=True), 1))


_tables: dict[int, np.ndarray] = {}


def _trigram_table(width: int) -> np.ndarray:
    if width not in _tables:
        parts = [mixed(np.arange(i, i + (1 << 20), dtype=np.uint64) + np.uint64(3 << 32)) % np.uint64(width) for i in range(0, 1 << 24, 1 << 20)]
        _tables[width] = np.concatenate([p.astype(np.uint16 if width <= 1 << 16 else np.uint32) for p in parts])
    return _tables[width]


_LETTER = r"\p{L}"


def train(docs: DataFrame, rule: LanguageRule = LanguageRule(), allowed: Column | None = None) -> LanguageModel:
    """Learn from text and lang of the rows that `allowed` admits."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (F.lit(True) if allowed is None else allowed))
    ids = usable.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    rows_of = ids.groupBy("lang").count().collect()  # one row for each language
    share = rule.max_training_docs // max(1, len(rows_of))
    # Thinned by hash to about four times the share before the window, so that no language is gathered whole.
    parts = 1 << 20
    limit = F.lit(0)
    for row in rows_of:
        limit = F.when(F.col("lang") == row["lang"], F.lit(min(parts, -(-4 * share * parts // row["count"])))).otherwise(limit)
    few = ids.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(parts)) < limit)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = few.distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= share).drop("place")
    texts = usable.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sample = texts.join(F.broadcast(chosen), ["doc_id", "lang"]).select("text", "lang")  # at most max_training_docs rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, some in chunks(batch, limit=rule.chunk_bytes, most_rows=1024):
                values = features(some, rule.width)
                yield pa.RecordBatch.from_arrays([rows.column(1).cast(pa.string()), pa.array([v.astype("<f2").tobytes() for v in values], pa.binary())], names=["lang", "row"])

    table = sample.mapInArrow(run, "lang string, row binary").toArrow()
    labels = table["lang"].to_pylist()
    languages = sorted(set(labels))
    if len(languages) < 2:
        return LanguageModel(languages)
    x = np.frombuffer(b"".join(table["row"].to_pylist()), dtype="<f2").reshape(len(labels), rule.width).astype(np.float32)
    code = codewords(len(languages), rule.long_code_bits)
    y = code[np.searchsorted(np.array(languages), np.array(labels))].astype(np.float32)
    weights, bias = np.zeros((rule.width, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    by_weight, by_bias = Adam(weights, rule.rate), Adam(bias, rule.rate)

    def step() -> float:
        margin = y * (x @ weights + bias)
        slope = -y / (1 + np.exp(np.clip(margin, -30, 30))) / len(y)
        by_weight.take(x.T @ slope + rule.decay * weights)
        by_bias.take(slope.sum(axis=0))
        return float(np.logaddexp(0, -margin).mean())

    repeat_until(step, rule.rounds)
    right = (y * (x @ weights + bias) > 0).mean(axis=0)
    trust = np.log(np.clip(right, 0.51, 0.999) / (1 - np.clip(right, 0.51, 0.999)))
    return LanguageModel(languages, code, weights, bias, trust / trust.sum())


def decode(model: LanguageModel, x: np.ndarray, ambiguous_below: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of features: the language's number, its score, and whether the choice is ambiguous."""
    if len(model.languages) < 2:
        return np.zeros(len(x), int), np.ones(len(x)), np.zeros(len(x), bool)
    margin = x @ model.weights + model.bias
    loss = np.einsum("nb,nkb->nk", np.broadcast_to(model.trust, margin.shape), np.logaddexp(0, -margin[:, None, :] * model.code[None])) * model.code.shape[1]
    best = loss.argmin(axis=1)
    two = np.partition(loss, 1, axis=1)[:, :2]
    share = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
    return best, (share[np.arange(len(x)), best] / share.sum(axis=1)), two[:, 1] - two[:, 0] < ambiguous_below


def predict(docs: DataFrame, model: LanguageModel, rule: LanguageRule = LanguageRule()) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch, limit=rule.chunk_bytes, most_rows=1024):
                spoken = pc.match_substring_regex(texts, _LETTER).to_numpy(zero_copy_only=False).astype(bool)
                if not model.languages:
                    spoken[:] = False
                best, score, ambiguous = decode(model, features(texts, rule.width) if len(model.languages) > 1 else np.zeros((len(texts), 1)), rule.ambiguous_below)
                names = [model.languages[b] if s else "und" for b, s in zip(best.tolist(), spoken.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(names, pa.string()), pa.array(np.where(spoken, score, 0.0)), pa.array(ambiguous & spoken)], schema=schema)

    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return source.mapInArrow(run, "doc_id bigint, lang_pred string, score double, ambiguous boolean")

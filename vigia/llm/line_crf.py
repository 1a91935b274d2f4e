"""Content or boilerplate, line by line: Viterbi decoding of a linear-chain conditional random field.

Each line that has a word is described by some twenty yes/no features of its own
bytes, words and place. The field has a weight for each feature and state, one
for each pair of neighbouring states and one for the first state. It is trained
by conditional likelihood from documents with a quality label: the lines of a
document of quality 0 count as boilerplate, those of quality 1 as content, and
the field generalises over that noise. The share of words in lines decoded as
content decides whether a document is kept.

Base rules come first: too few words, or too large a share of words in repeated
runs of eight words, fail a document whatever its lines say.

Training reads at most `max_training_docs` labelled documents (smallest hashes
of their id); every document is decoded whole.

Cases: a null or wordless text has no words and fails the base rule; lines
without a word are not decoded; without labels of both kinds every line is
content; repeated rows and null ids are judged each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigia.llm.fit import Adam, labelled, repeat_until
from vigia.llm.textkit import IN_LINE, IN_WORD, STARTS_CHAR, Pieces, byte_table, chunks, distinct, grams, mixed, pieces, raw_bytes, sums


@dataclass(frozen=True)
class LineCrfRule:
    max_training_docs: int = 3000
    rounds: int = 150
    rate: float = 0.1
    decay: float = 1e-3
    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    min_content_share: float = 0.5


SYMBOLS = byte_table(b"#*$%&|<>")
_DIGIT, _UPPER, _PUNCT = byte_table(range(48, 58)), byte_table(range(65, 91)), byte_table(b"!?.,;:")
_LETTER = byte_table([*range(65, 91), *range(97, 123), *range(128, 256)])
_ENDS = byte_table(b".!?:;\"')")


@dataclass(frozen=True)
class LineField:
    """States: 0 content, 1 boilerplate."""

    emit: np.ndarray  # features x 2
    step: np.ndarray  # 2 x 2
    first: np.ndarray  # 2


@dataclass
class Lines:
    """The lines with a word, of a chunk."""

    doc: np.ndarray
    words: np.ndarray
    features: np.ndarray
    repeated: np.ndarray  # equal to an earlier line of its text


def earlier_equal(doc: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Whether an entry equals an earlier one of its document."""
    with np.errstate(over="ignore"):
        key = digest ^ mixed(doc.astype(np.uint64) + np.uint64(1))
    _, first = np.unique(key, return_index=True)
    out = np.ones(len(key), dtype=bool)
    out[first] = False
    return out


def covered_words(words: Pieces, window: int) -> np.ndarray:
    """Whether a word lies in a run of `window` words that its text has twice or more."""
    at, digest = grams(words, window)
    with np.errstate(over="ignore"):
        key = digest ^ mixed(words.doc[at].astype(np.uint64) + np.uint64(1))
    ordered = np.sort(key)
    twice = distinct(ordered[1:][ordered[1:] == ordered[:-1]])
    change = np.zeros(len(words.doc) + 1, dtype=np.int32)
    if len(twice):
        place = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
        hit = at[twice[place] == key]
        change[hit] += 1
        change[hit + window] -= 1
    return np.cumsum(change)[:-1] > 0


def _bins(value: np.ndarray, *limits: float) -> list[np.ndarray]:
    return [value > limit for limit in limits]


def describe(data: np.ndarray, offsets: np.ndarray, words: Pieces) -> Lines:
    rows = pieces(data, offsets, IN_LINE)
    begin, end = np.searchsorted(words.start, rows.start), np.searchsorted(words.start, rows.end)
    some = end > begin
    doc, start, stop = rows.doc[some], rows.start[some], rows.end[some]
    begin, end, digest = begin[some], end[some], rows.digest[some]
    n = len(doc)
    if not n:
        return Lines(doc, begin, np.zeros((0, N_FEATURES), bool), np.zeros(0, bool))
    count = end - begin

    def share(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[data])])
        return (total[stop] - total[start]) / (stop - start)

    with np.errstate(over="ignore"):
        line_of = np.repeat(np.arange(n, dtype=np.uint64), count)
        inside = np.concatenate([[0], np.cumsum(count)])
        index = np.repeat(begin - inside[:-1], count) + np.arange(inside[-1])
        fresh_word = ~earlier_equal(line_of, words.digest[index])
        with_symbol = np.concatenate([[0], np.cumsum(SYMBOLS[data[words.end - 1]])]) if len(words.end) else np.zeros(1)
    distinct = np.add.reduceat(fresh_word, inside[:-1]) / count
    repeated = earlier_equal(doc, digest)
    head = np.concatenate([[True], doc[1:] != doc[:-1]])
    tail = np.concatenate([doc[1:] != doc[:-1], [True]])
    columns = [
        np.ones(n, bool), repeated, head, tail, _ENDS[data[stop - 1]],
        *_bins(count, 1.5, 4.5, 12.5, 40.5),
        *_bins(share(SYMBOLS), 0.0, 0.03, 0.1),
        *_bins(share(_DIGIT), 0.05, 0.3),
        *_bins(share(_UPPER), 0.1, 0.5),
        *_bins(1 - share(_LETTER), 0.3, 0.5),
        *_bins(share(_PUNCT), 0.08, 0.2),
        *_bins(distinct, 0.15, 0.4, 0.7),
        (with_symbol[end] - with_symbol[begin]) / count > 0.2,
    ]
    return Lines(doc, count, np.stack(columns, axis=1), repeated)


N_FEATURES = 24


def _padded(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each line in a table with a row for each sequence."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    return row, np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def train(docs: DataFrame, labels: DataFrame, rule: LineCrfRule = LineCrfRule(), allowed: Column | None = None) -> LineField:
    sample = labelled(docs, labels, "quality", rule.max_training_docs, F.lit(True) if allowed is None else allowed)
    schema = pa.schema([("label", pa.int32()), ("lines", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch):
                data, offsets = raw_bytes(texts)
                lines = describe(data, offsets, pieces(data, offsets, IN_WORD))
                first = np.searchsorted(lines.doc, np.arange(len(texts) + 1))
                packed = [lines.features[a:b].astype(np.uint8).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column(1).cast(pa.int32()), pa.array(packed, pa.binary())], schema=schema)

    table = sample.select("text", "label").mapInArrow(run, "label int, lines binary").toArrow()
    x = [np.frombuffer(v, dtype=np.uint8).reshape(-1, N_FEATURES) for v in table["lines"].to_pylist()]
    return fit([v for v in x if len(v)], [1 - y for y, v in zip(table["label"].to_pylist(), x, strict=True) if len(v)], rule)


def fit(sequences: list[np.ndarray], states: list[int], rule: LineCrfRule) -> LineField:
    """Maximum conditional likelihood by forward-backward; all lines of a sequence have its state."""
    emit, step_w, first = np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), np.zeros(2)
    if len(set(states)) < 2:
        emit[0, 0] = 1.0
        return LineField(emit, step_w, first)
    order = np.argsort([len(s) for s in sequences])
    groups = []  # of sequences of about the same length
    for part in np.array_split(order, max(1, len(order) // 200)):
        some = [sequences[i] for i in part]
        lengths = np.array([len(s) for s in some])
        row, column = _padded(lengths)
        groups.append((np.concatenate(some).astype(np.float64), lengths, row, column, np.array([states[i] for i in part])))
    total = sum(len(s) for s in sequences)
    by = [Adam(w, rule.rate) for w in (emit, step_w, first)]

    def once() -> float:
        loss, g_emit, g_step, g_first = 0.0, rule.decay * emit, rule.decay * step_w, rule.decay * first
        for x, lengths, row, column, state in groups:
            n, m = len(lengths), int(lengths.max())
            e = np.zeros((n, m, 2))
            e[row, column] = x @ emit
            alpha, beta = np.full((n, m, 2), -np.inf), np.zeros((n, m, 2))
            alpha[:, 0] = first + e[:, 0]
            for t in range(1, m):
                alpha[:, t] = np.logaddexp.reduce(alpha[:, t - 1, :, None] + step_w, axis=1) + e[:, t]
            live = np.arange(m)[None, :] < lengths[:, None]
            for t in range(m - 2, -1, -1):
                back = np.logaddexp.reduce(step_w + (e[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
                beta[:, t] = np.where(live[:, t + 1, None], back, 0.0)
            log_z = np.logaddexp.reduce(alpha[np.arange(n), lengths - 1], axis=1)
            own = (np.arange(2) == state[:, None]).astype(np.float64)
            path = first[state] + step_w[state, state] * (lengths - 1) + np.bincount(row, e[row, column, state[row]], minlength=n)
            loss += float((log_z - path).sum())
            p = np.exp(alpha + beta - log_z[:, None, None])
            g_emit = g_emit + x.T @ (p[row, column] - own[row]) / total
            g_first = g_first + (p[:, 0] - own).sum(axis=0) / total
            for t in range(1, m):
                on = live[:, t]
                pair = np.exp(alpha[on, t - 1, :, None] + step_w + (e[on, t] + beta[on, t])[:, None, :] - log_z[on, None, None])
                g_step = g_step + pair.sum(axis=0) / total
            g_step = g_step - np.einsum("n,ni,nj->ij", lengths - 1.0, own, own) / total
        for adam, gradient in zip(by, (g_emit, g_step, g_first), strict=True):
            adam.take(gradient)
        return loss / total

    repeat_until(once, rule.rounds)
    return LineField(emit, step_w, first)


def viterbi(field: LineField, features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The likeliest state of every line; `lengths` lines to a sequence, none of them 0.

    Sequences advance together, longest first, so that each step is one operation over those still running.
    """
    out = np.zeros(len(features), dtype=np.int8)
    if not len(lengths):
        return out
    order = np.argsort(-lengths, kind="stable")
    begin, size = (np.cumsum(lengths) - lengths)[order], lengths[order]
    emit = features @ field.emit
    best = field.first + emit[begin]
    choice = np.zeros((len(features), 2), dtype=np.int8)
    for t in range(1, int(size[0])):
        n = int(np.searchsorted(-size, -t, side="left"))  # sequences longer than t
        both = best[:n, :, None] + field.step
        choice[begin[:n] + t] = both.argmax(axis=1)
        best[:n] = both.max(axis=1) + emit[begin[:n] + t]
    state = best.argmax(axis=1).astype(np.int8)
    out[begin + size - 1] = state
    for t in range(int(size[0]) - 1, 0, -1):
        n = int(np.searchsorted(-size, -t, side="left"))
        state[:n] = choice[begin[:n] + t, state[:n]]
        out[begin[:n] + t - 1] = state[:n]
    return out


def judge(docs: DataFrame, field: LineField, rule: LineCrfRule = LineCrfRule()) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share, states.

    `states` has a letter for each line with a word: c for content, b for boilerplate.
    """
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in counts), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("content_share", pa.float64()), ("states", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch):
                data, offsets = raw_bytes(texts)
                words = pieces(data, offsets, IN_WORD)
                lines = describe(data, offsets, words)
                n = len(texts)
                first = np.searchsorted(lines.doc, np.arange(n + 1))
                lengths = np.diff(first)
                state = viterbi(field, lines.features, lengths[lengths > 0])
                n_words = np.diff(words.first)
                content = np.bincount(lines.doc, lines.words * (state == 0), minlength=n) / np.maximum(n_words, 1)
                repeat = sums(covered_words(words, rule.window), words.first)
                failed = (n_words < rule.min_words) | (100 * repeat > rule.max_repeat_percent * n_words)
                letters = np.array([b"c", b"b"])[state].tobytes().decode()
                values = (
                    n_words, sums(STARTS_CHAR[data] & IN_WORD[data], offsets), sums(SYMBOLS[data], offsets),
                    np.bincount(lines.doc[lines.repeated], minlength=n), repeat, failed, ~failed & (content >= rule.min_content_share), content,
                    [letters[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)],
                )
                yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(v, f.type) for v, f in zip(values, list(schema)[1:], strict=True))], schema=schema)

    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return source.mapInArrow(run, "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, content_share double, states string")

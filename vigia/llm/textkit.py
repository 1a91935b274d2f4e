"""Shared helpers of the text operators: bounded chunks, word streams and memoised tokenizers.

Text reaches Python in Arrow batches. A chunk is a slice of a batch whose text
stays below a byte limit (one longer text is a chunk of its own), and numpy
works on the UTF-8 bytes of a whole chunk at once. Words are identified by
64-bit digests.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 2 << 20
_SEGMENT = 1 << 20
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)

SPACES = b" \t\n\x0b\x0c\r"


def byte_table(members: Iterable[int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


IN_WORD = ~byte_table(SPACES)
IN_LINE = ~byte_table(b"\n")
#: Letters and digits; every byte of a character beyond ASCII counts as a letter.
IN_TERM = byte_table([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])
STARTS_CHAR = ~byte_table(range(0x80, 0xC0))


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """Column names like `names` that no column of the frame has, whatever the case."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id as text; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def tasks_for(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_array(column: pa.Array) -> pa.Array:
    """Null texts become empty; offsets are 64-bit."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES, most_rows: int = 1 << 30) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of the batch with their texts, each of at most `most_rows` rows and `limit` bytes of text, or one row."""
    if not batch.num_rows:
        return
    texts = text_array(batch.column(batch.schema.get_field_index(column)))
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        base = ends[at - 1] if at else 0
        to = max(at + 1, min(at + most_rows, int(np.searchsorted(ends, base + limit, side="right"))))
        yield batch.slice(at, to - at), texts.slice(at, to - at)
        at = to
    # Workers are kept between stages; what Arrow has freed but holds would be added to the next stage's memory.
    del texts
    pa.default_memory_pool().release_unused()


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offset at which each begins (one more than texts)."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    with np.errstate(over="ignore"):
        v = values.astype(np.uint64, copy=True)
        v ^= v >> np.uint64(30)
        v *= np.uint64(0xBF58476D1CE4E5B9)
        v ^= v >> np.uint64(27)
        v *= np.uint64(0x94D049BB133111EB)
        v ^= v >> np.uint64(31)
    return v


_powers: dict[str, np.ndarray] = {}


def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["p"]) < size:
        size = max(size, _SEGMENT + 1)
        with np.errstate(over="ignore"):
            for key, base in (("p", _P), ("q", _PINV)):
                table = np.full(size, base & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
                table[0] = 1
                _powers[key] = np.cumprod(table, dtype=np.uint64)
    return _powers["p"], _powers["q"]


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each byte range; ranges ascend and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + _SEGMENT, side="right")))
        span = int(ends[to - 1]) - base
        p, q = _power_table(span + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(span + 1, dtype=np.uint64)
            np.multiply(data[base : base + span], p[:span], out=total[1:], dtype=np.uint64, casting="unsafe")
            total[1:] += p[:span]
            np.cumsum(total, out=total)
            s = starts[at:to] - base
            out[at:to] = (total[ends[at:to] - base] - total[s]) * q[s]
        at = to
    return mixed(out)


@dataclass
class Pieces:
    """Ranges of bytes of a chunk's texts: words, terms or lines, in text order."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    digest: np.ndarray
    first: np.ndarray  # index of each text's first piece; one more than texts


def pieces(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, hashed: bool = True) -> Pieces:
    """Maximal runs of bytes for which the table `inside` holds, within each text."""
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Pieces(none, none, none, none.astype(np.uint64), np.zeros(len(offsets), dtype=np.int64))
    at = inside[data]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = at[:-1]
    cuts = offsets[offsets < n]
    before[cuts] = False
    starts = np.flatnonzero(at & ~before)
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = at[1:]
    after[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(at & ~after) + 1
    first = np.searchsorted(starts, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Pieces(doc, starts, ends, digests(data, starts, ends) if hashed else np.zeros(0, np.uint64), first)


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, Pieces]:
    """Lower-cased runs of letters and digits, with the lower-cased bytes they lie in."""
    data, offsets = raw_bytes(pc.utf8_lower(texts))
    return data, offsets, pieces(data, offsets, IN_TERM)


def grams(p: Pieces, size: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first piece, and digest, of each run of `size` pieces within a text."""
    n = len(p.doc) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    factors = mixed(np.arange(1, size + 1, dtype=np.uint64) + np.uint64(seed * 1000)) | np.uint64(1)
    at = np.flatnonzero(p.doc[:n] == p.doc[size - 1 :])
    total = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            total += p.digest[j : j + n] * factors[j]
    return at, mixed(total[at])


def sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the flags between neighbouring offsets."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offsets])


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorting beats hashing for the many rare values of texts."""
    ordered = np.sort(values)
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered


def code_points(data: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Turns byte positions of the chunk into numbers of characters before them."""
    total = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(STARTS_CHAR[data], out=total[1:])
    return lambda at: total[at]


class MemoTokenizer:
    """Ids of whole texts, with each distinct word encoded once.

    Both kinds of vocabulary file cut the text at a blank before merging, so
    the ids of a text are those of its blank-separated parts. A part keeps its
    blank (`keep_blank`, byte-level files) or blanks and case are dropped (word files).
    New parts are encoded together, many to a call, with a marker between them.
    """

    LIMIT, KEPT = 500_000, 250_000  # parts held; those learned first, the frequent ones, outlive the limit
    _RUN, _CALL = 256, 32  # parts to a text, texts to a call

    def __init__(self, path: str, keep_blank: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.keep_blank = keep_blank
        vocabulary = self.library.get_vocab()
        size = 1 + max(vocabulary.values())
        self.opens = np.zeros(size, dtype=bool)
        self.ends_sentence = np.zeros(size, dtype=bool)
        for token, i in vocabulary.items():
            self.opens[i] = token.startswith("Ġ")
            self.ends_sentence[i] = token.removesuffix("</w>").endswith((".", "!", "?"))
        # A character of its own id marks where one part ends and the next begins.
        self.mark, self.mark_id = next((c, ids[0]) for c in "^~|@`" if len(ids := self._flat([c])[0]) == 1)
        self.memo: dict[str, int] = {}  # part -> its place in begin
        self.firsts: dict[str, int] = {}  # the same for parts that open a text, without a blank
        self.begin = np.zeros(1, dtype=np.int64)
        self.pool = np.zeros(0, dtype=np.int32)

    def _shrink(self) -> None:
        self.memo = {part: i for part, i in self.memo.items() if i < self.KEPT}
        self.firsts = {part: i for part, i in self.firsts.items() if i < self.KEPT}
        self.begin = self.begin[: self.KEPT + 1].copy()
        self.pool = self.pool[: self.begin[-1]].copy()

    def _flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the number of each."""
        found = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)] if texts else []
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.int32, int(sizes.sum())), sizes

    def _together(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for parts that are encoded many to a text."""
        flat, sizes = [], []
        step = self._RUN * self._CALL
        for i in range(0, len(parts), step):
            some = parts[i : i + step]
            runs = [some[j : j + self._RUN] for j in range(0, len(some), self._RUN)]
            if self.keep_blank:
                ids, _ = self._flat([" " + " ".join(run) for run in runs])
                size = np.diff(np.append(np.flatnonzero(self.opens[ids]), len(ids)))
            else:
                ids, _ = self._flat([f" {self.mark} ".join([*run, ""]) for run in runs])
                marks = ids == self.mark_id
                size = np.diff(np.concatenate([[-1], np.flatnonzero(marks)])) - 1
                ids = ids[~marks]
            if len(size) != len(some) or int(size.sum()) != len(ids):
                ids, size = self._flat([" " * self.keep_blank + x for x in some])
            flat.append(ids)
            sizes.append(size)
        return (np.concatenate(flat), np.concatenate(sizes)) if flat else self._flat([])

    def _alone(self, part: str) -> bool:
        """Whether a part must not share a text with others."""
        return (not part or part[-1].isspace()) if self.keep_blank else self.mark in part

    def _learn(self, new: list[str]) -> None:
        alone = [w for w in new if self._alone(w)]
        shared = [w for w in new if not self._alone(w)] if alone else new
        for some, (ids, sizes) in (
            (shared, self._together(shared)),
            (alone, self._flat([" " * self.keep_blank + w for w in alone])),
        ):
            self._add(self.memo, some, ids, sizes)

    def _add(self, memo: dict[str, int], parts: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        memo.update(zip(parts, range(len(self.begin) - 1, len(self.begin) - 1 + len(parts)), strict=True))
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])
        self.pool = np.concatenate([self.pool, ids])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one text after another, and where each text begins (one more than texts)."""
        if self.keep_blank and self._blank_runs(texts):
            return self._plain(texts)
        if len(self.memo) > self.LIMIT:
            self._shrink()
        lists = pc.split_pattern(texts, " ") if self.keep_blank else pc.ascii_split_whitespace(pc.ascii_lower(texts))
        coded = lists.flatten().dictionary_encode()
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        words = coded.dictionary.to_pylist()
        self._learn([w for w in words if w not in self.memo])
        where = np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))
        at = where[codes]
        if self.keep_blank:  # a text's first part has no blank before it
            heads = bounds[:-1][np.diff(bounds) > 0]
            firsts = [words[i] for i in codes[heads]]
            new = list(dict.fromkeys(f for f in firsts if f not in self.firsts))
            self._add(self.firsts, new, *self._flat(new))
            at[heads] = [self.firsts[f] for f in firsts]
        begin, pool = self.begin, self.pool
        length = np.diff(begin)[at]
        total = np.concatenate([[0], np.cumsum(length)])
        step = np.arange(total[-1], dtype=np.int32)
        return pool[np.repeat((begin[at] - total[:-1]).astype(np.int32), length) + step], total[bounds]

    @staticmethod
    def _blank_runs(texts: pa.Array) -> bool:
        """Whether white space stands before a blank, where cutting at the blank would change the ids."""
        return bool(pc.any(pc.match_substring_regex(texts, r"[\s\p{Z}\x0b\x1c-\x1f\x{85}] ")).as_py())

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        runs = pc.match_substring_regex(texts, r"[\s\p{Z}\x0b\x1c-\x1f\x{85}] ").to_pylist()
        found = []
        for i, odd in enumerate(runs):
            one = texts.slice(i, 1)
            found.append(self._flat(one.to_pylist())[0] if odd else self.encode(one)[0])
        ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
        return (np.concatenate(found) if found else np.zeros(0, np.int32)), ends


_tokenizers: dict[tuple[str, bool], MemoTokenizer] = {}


def tokenizer(path: str, keep_blank: bool) -> MemoTokenizer:
    """One per worker process, kept between tasks."""
    if (path, keep_blank) not in _tokenizers:
        _tokenizers[path, keep_blank] = MemoTokenizer(path, keep_blank)
    return _tokenizers[path, keep_blank]

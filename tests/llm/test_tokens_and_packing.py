"""Token files and packed windows against the tokenizer itself and a plain programme."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.orc
import public_tokenizers
import pytest
from llm_cases import LONG, ODD_TEXTS, odd, prose, rows, table
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vigia.durable import scratch_path
from vigia.llm import pack_dp, textkit, token_orc

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def library(path: str):
    out = Tokenizer.from_file(path)
    out.encode_special_tokens = True
    return lambda text: out.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path,keep_blank", [(BYTES, True), (WORDS, False)])
def test_memo_gives_the_library_ids(path, keep_blank):
    draw = random.Random(5)
    noise = ["".join(draw.choice(" \n\tabAB.,'§~^é漢🙂  ") for _ in range(draw.randrange(40))) for _ in range(400)]
    texts = ODD_TEXTS + noise + ["<|endoftext|> it's 'S 12 345", "é Å Å"]
    coder, plain = textkit.MemoTokenizer(path, keep_blank), library(path)
    for _ in range(2):  # with an empty memo and with a full one
        ids, ends = coder.encode(textkit.text_array(pa.array(texts)))
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [plain(t) for t in texts]
    coder.LIMIT, coder.KEPT = 10, 5
    ids, ends = coder.encode(textkit.text_array(pa.array(texts)))
    assert ids[ends[0] : ends[-1]].tolist() == [i for t in texts for i in plain(t)]


def test_token_file(spark):
    docs, data = odd(spark, extra=True)
    path = scratch_path(spark, "tokens")
    token_orc.write_tokens(docs, path, token_orc.TokenFile(BYTES, row_index_stride=1000, stripe_bytes=1 << 16))
    stored = token_orc.read_tokens(spark, path)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_orc.token_digest(stored).collect()]
    plain = library(BYTES)
    expected = {}
    for doc_id, text, *_ in data:
        ids = [*plain(text), 0]
        expected.setdefault(doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted((r[0] is not None, r[0] or 0, r[2], r[3]) for r in got) == sorted((d is not None, d or 0, *e) for d, own in expected.items() for e in own)
    # In order of start the documents touch, and their ids ascend with those without an id first.
    got.sort(key=lambda r: r[1])
    assert [r[1] for r in got] == np.concatenate([[0], np.cumsum([r[2] for r in got])[:-1]]).tolist()
    assert [r[0] if r[0] is not None else -1 for r in got] == sorted(r[0] if r[0] is not None else -1 for r in got)


def test_token_file_has_stripes_and_is_pruned_by_id(spark):
    docs = spark.range(0, 6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("doc "), F.expr("repeat(cast(id * 7919 as string), 40)")).alias("text"))
    path = scratch_path(spark, "tokens")
    token_orc.write_tokens(docs.coalesce(1), path, token_orc.TokenFile(BYTES, stripe_bytes=1 << 14, row_index_stride=1000))
    parts = [r.path for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.orc").load(path).select("path").collect()]
    files = [pyarrow.orc.ORCFile(p.removeprefix("file:")) for p in parts]
    assert sum(f.nrows for f in files) == 6000
    assert all(f.row_index_stride == 1000 for f in files)
    assert sum(f.nstripes for f in files) > len(files)
    one = token_orc.read_tokens(spark, path).where("doc_id = 4321")
    assert "EqualTo(doc_id,4321)" in one._jdf.queryExecution().toString()
    assert [r.doc_id for r in one.collect()] == [4321]


def test_empty_table(spark):
    empty = table(spark, [])
    path = scratch_path(spark, "tokens")
    token_orc.write_tokens(empty, path, token_orc.TokenFile(BYTES))
    assert token_orc.token_digest(token_orc.read_tokens(spark, path)).count() == 0
    assert pack_dp.pack_documents(empty, pack_dp.Packing(WORDS)).count() == 0


def plain_cost(at, penalty, spec):
    """The least cost by trying every window."""
    places, costs = [0, *at], [0, *penalty]
    best = [0] + [None] * len(at)
    for j in range(1, len(places)):
        for i in range(j):
            length = places[j] - places[i]
            if best[i] is None or length > spec.window:
                continue
            exact = length & (length - 1) == 0 and length >= spec.least_exact
            value = best[i] + (0 if exact else spec.window - length) + costs[j]
            best[j] = value if best[j] is None else min(best[j], value)
    return best[-1]


def test_windows_have_least_cost():
    draw = random.Random(1)
    spec = pack_dp.Packing(WORDS, window=32, max_gap=9, least_exact=4, sentence_penalty=3, inner_penalty=7)
    for _ in range(60):
        n = draw.randrange(1, 150)
        doc_ends = np.array(sorted({n, *(draw.randrange(1, n + 1) for _ in range(draw.randrange(4)))}))
        sentence_ends = np.array(sorted({draw.randrange(1, n + 1) for _ in range(draw.randrange(12))}), dtype=np.int64)
        at, penalty = pack_dp.candidates(doc_ends, sentence_ends, spec)
        assert np.diff(np.concatenate([[0], at])).max() <= spec.max_gap and at[-1] == n
        ends = pack_dp.window_ends(at, penalty, spec)
        sizes = np.diff(np.concatenate([[0], ends]))
        padding = sum(0 if s & (s - 1) == 0 and s >= spec.least_exact else spec.window - s for s in sizes.tolist())
        assert sizes.max() <= spec.window and ends[-1] == n
        assert padding + penalty[np.searchsorted(at, ends)].sum() == plain_cost(at.tolist(), penalty.tolist(), spec)


def test_packing_keeps_every_id(spark):
    data = rows([prose(i, 1 + i % 40) for i in range(120)] + [LONG, None, "", LONG.replace(".", "")]) + [(7, "seven again", None, None, None), (None, "x", None, None, None)]
    out = pack_dp.pack_documents(table(spark, data, extra=True), pack_dp.Packing(WORDS, block_tokens=40_000)).collect()
    plain = library(WORDS)
    windows = {}
    for r in out:
        assert r.length == len(r.ids) // 4 > 0
        windows.setdefault(r.sequence_id, []).append(r)
    used = 0
    for parts in windows.values():
        parts.sort(key=lambda r: r.offset)
        assert [p.offset for p in parts] == np.concatenate([[0], np.cumsum([p.length for p in parts])[:-1]]).tolist()
        size = sum(p.length for p in parts)
        assert size <= 2048
        used += size if size & (size - 1) == 0 else 2048
    expected = sorted((d is not None, d or 0, np.array([*plain(t), 1], "<u4").tobytes()) for d, t, *_ in data)
    texts = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):  # order of the ids
        texts.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    got = []
    for (doc_id, n), parts in texts.items():
        whole = b"".join(bytes(p.ids) for p in parts)
        got += [(doc_id is not None, doc_id or 0, whole[i : i + 4 * n]) for i in range(0, len(whole), 4 * n)]
    assert sorted(got) == expected
    total = sum(r.length for r in out)
    assert (used - total) / used < 0.05


def test_digest_of_pieces(spark):
    spec = pack_dp.Packing(WORDS)
    whole = pack_dp.pack_documents(table(spark, rows(["one two. three"])), spec)
    (r,) = pack_dp.piece_digest(whole).collect()
    ids = [*library(WORDS)("one two. three"), 1]
    assert (r.doc_id, r.start, r.length, r.doc_tokens, r.offset, r.ids_crc32) == (0, 0, len(ids), len(ids), 0, zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_chunks_give_back_what_arrow_holds(monkeypatch):
    """A worker outlives its stage: memory that Arrow has freed but keeps goes back at the end of each batch."""
    calls = []

    class Pool:
        def release_unused(self):
            calls.append(1)

    monkeypatch.setattr(textkit.pa, "default_memory_pool", Pool)
    batch = pa.RecordBatch.from_pydict({"text": ["a b", None, "c" * 50]})
    assert [rows.num_rows for rows, _ in textkit.chunks(batch, limit=10)] == [2, 1]
    assert calls == [1]

"""Toxic sentences and languages: the formulas, held-out accuracy and odd cases."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import odd, rows, table
from pyspark.sql import functions as F

from vigia.llm import fit, lang_ecoc, textkit, toxic_mil

FOLDER = "/root/testdata/sf0.01"


def bucket(word: str, bits: int) -> int:
    _, _, p = textkit.terms(textkit.text_array(pa.array([word])))
    return int(p.digest[0] >> np.uint64(64 - bits))


def model_of(weights: dict[str, float], bias: float = -4.0, bits: int = 22) -> toxic_mil.ToxicModel:
    pairs = sorted((bucket(w, bits), v) for w, v in weights.items())
    return toxic_mil.ToxicModel(bias, np.array([b for b, _ in pairs]), np.array([v for _, v in pairs]), toxic_mil.ToxicRule())


def test_score_is_the_noisy_or_of_sentences(spark):
    model = model_of({"bad": 5.0, "worse": 3.0, "kind": -2.0})
    text = "A Bad day. Ünï kind, bad\nWORSE bad bad! nothing here"  # the words of a sentence count once
    sigmoid = lambda z: 1 / (1 + np.exp(-z))
    p = [sigmoid(z) for z in (1.0, -1.0, 4.0, -4.0)]
    out = {r.doc_id: r for r in toxic_mil.score(table(spark, rows([text, None, "", "?! \n."])), model).collect()}
    assert out[0].score == pytest.approx(1 - np.prod([1 - v for v in p]))
    assert [(text[s.start : s.end].strip(), pytest.approx(s.score)) for s in out[0].offending] == [("A Bad day", p[0]), ("WORSE bad bad", p[2])]
    assert [out[i].score for i in (1, 2, 3)] == [0.0, 0.0, 0.0]


def test_clean_keeps_rows_as_they_are(spark):
    docs, data = odd(spark, extra=True)
    kept = toxic_mil.clean(docs, model_of({"word": 20.0}, -12.0)).collect()
    assert len(kept) == len(data) - 2  # the row "word" is there twice
    assert kept[0].asDict().keys() == dict.fromkeys(docs.columns).keys()
    assert toxic_mil.clean(table(spark, []), model_of({"word": 20.0}, -12.0)).count() == 0
    assert toxic_mil.score(docs, model_of({"word": 20.0}, -12.0)).count() == len(data)


def test_held_out_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    allowed = textkit.crc_of_id(F.col("doc_id")) % 5 != 0
    model = toxic_mil.train(docs, labels, allowed=allowed)
    out = toxic_mil.score(docs, model).join(labels, "doc_id").where(textkit.crc_of_id(F.col("doc_id")) % 5 == 0).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and 0 <= r.score <= 1 for r in out)
    clean = [r for r in out if not r.toxic]
    toxic = [r for r in out if r.toxic]
    assert sum(r.score >= 0.5 for r in clean) / len(clean) < 0.02
    assert sum(r.score >= 0.5 for r in toxic) / len(toxic) > 0.8
    assert all(r.offending for r in toxic if r.score >= 0.5)


def test_one_kind_of_label_scores_nothing(spark):
    docs = table(spark, rows(["some text", "more text"]))
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 0), (None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")
    model = toxic_mil.train(docs, labels)
    assert [r.score < 1e-9 for r in toxic_mil.score(docs, model).collect()] == [True, True]


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 7, 8, 20):
        code = lang_ecoc.codewords(n, 40)
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= (2 ** (n - 2) if n <= 7 else 10)
        assert (np.abs(code.sum(axis=0)) < n).all() and set(np.unique(code)) <= {-1.0, 1.0}


def test_decoding_takes_the_nearest_codeword():
    code = lang_ecoc.codewords(4, 40)
    model = lang_ecoc.LanguageModel(list("abcd"), code, np.eye(code.shape[1]), np.zeros(code.shape[1]), np.full(code.shape[1], 1 / code.shape[1]))
    x = 4 * code.repeat(code.shape[1], axis=0)
    for row in range(len(x)):  # one wrong bit in each
        x[row, row % code.shape[1]] *= -1
    best, score, ambiguous = lang_ecoc.decode(model, x, 0.5)
    assert best.tolist() == np.repeat(np.arange(4), code.shape[1]).tolist()
    assert (score > 0.5).all() and not ambiguous.any()
    _, score, ambiguous = lang_ecoc.decode(model, np.zeros((1, code.shape[1])), 0.5)
    assert score[0] == pytest.approx(0.25) and ambiguous[0]


def test_features_count_grams():
    (x,) = lang_ecoc.features(textkit.text_array(pa.array(["abab"])), 64)
    assert (x**2).sum() == pytest.approx(1.0, rel=1e-5)
    parts = lang_ecoc.features(textkit.text_array(pa.array(["xy", "abab", ""])), 64)
    assert np.allclose(parts[1], x) and not parts[2].any()


def test_held_out_language(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = textkit.crc_of_id(F.col("doc_id")) % 4 == 2
    model = lang_ecoc.train(docs, allowed=~held)
    out = lang_ecoc.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(held).collect()
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_languages_of_odd_texts(spark):
    docs, data = odd(spark, extra=True)
    model = lang_ecoc.train(docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").otherwise("bb")))
    out = lang_ecoc.predict(docs, model).collect()
    assert len(out) == len(data)
    texts = {}
    for doc_id, text, *_ in data:
        texts.setdefault(doc_id, []).append(text)
    for r in out:
        if len(texts[r.doc_id]) == 1:
            spoken = any(c.isalpha() for c in texts[r.doc_id][0] or "")
            assert (r.lang_pred == "und") == (not spoken) and (spoken or r.score == 0)
    single = lang_ecoc.predict(docs, lang_ecoc.train(docs)).collect()
    assert {r.lang_pred for r in single} == {"und", "en"}
    none = lang_ecoc.train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in lang_ecoc.predict(docs, none).collect()} == {"und"}
    assert lang_ecoc.predict(table(spark, []), model).count() == 0


def test_sample_is_the_same_however_the_table_is_split(spark):
    frame = spark.range(1000).withColumnRenamed("id", "doc_id")
    some = {r.doc_id for r in fit.sample_by_hash(frame.repartition(7), ["doc_id"], 50).collect()}
    assert len(some) == 50 and some == {r.doc_id for r in fit.sample_by_hash(frame.coalesce(1), ["doc_id"], 50).collect()}

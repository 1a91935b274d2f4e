"""From documents to packed windows: the stages in order, each over all that its predecessor kept.

The first four stages return the columns of `documents`; the last returns the pieces of the packed windows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigia.durable import stored
from vigia.llm import bench_wand, line_bloom, order_minhash, pack_dp, toxic_mil
from vigia.llm.textkit import crc_of_id


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose noisy-or score is below one half; the model learns from the labelled ones among them."""
    rule = toxic_mil.ToxicRule()
    model = toxic_mil.train(docs, _table(spark, sf_dir, "labels"), rule, crc_of_id(F.col("doc_id")) % 5 != 0)
    return toxic_mil.clean(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them have."""
    out, (_, n_dropped, kept) = line_bloom.drop_repeated_lines(docs, line_bloom.LineRule())
    dropped = F.col(n_dropped) > 0
    new = {"text": F.when(dropped, F.col(kept)).otherwise(F.col("text")), "n_chars": F.when(dropped, F.length(kept)).otherwise(F.col("n_chars"))}
    return out.select(*[new.get(c, F.col(c)).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of least doc_id."""
    return order_minhash.one_of_each(docs, order_minhash.OrderRule())


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was confirmed."""
    return bench_wand.clean(docs, _table(spark, sf_dir, "benchmark"), bench_wand.BenchRule())


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed windows of all documents, with a checksum of their ids."""
    return pack_dp.piece_digest(pack_dp.pack_documents(docs, pack_dp.Packing(public_tokenizers.path("word_bpe_49k.json"))))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The trained filter, the sketches and the tokenizer have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

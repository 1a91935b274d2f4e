"""Bounded, repeatable training samples, and small numpy optimisers for the trained operators."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigia.llm.textkit import fresh


def sample_by_hash(rows: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """The rows of the `limit` smallest hashes of the keys: the same rows however the table is split.

    Ties of the hash end in the keys, so equal rows beyond them are interchangeable.
    """
    (rank,) = fresh(rows, "sample_rank")
    ranked = rows.withColumn(rank, F.xxhash64(*keys))
    return ranked.orderBy(rank, *keys).limit(limit).drop(rank)


def labelled(docs: DataFrame, labels: DataFrame, label: str, limit: int, allowed: Column) -> DataFrame:
    """doc_id, text, label of at most `limit` labelled documents; the labels are sampled before texts are read."""
    marks = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & allowed)
    marks = marks.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    chosen = sample_by_hash(marks, ["doc_id"], limit)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")  # at most `limit` rows of two numbers


class Adam:
    """Adaptive steps for one array of weights, changed in place."""

    def __init__(self, weights: np.ndarray, rate: float):
        self.weights, self.rate, self.step = weights, rate, 0
        self.mean, self.square = np.zeros_like(weights), np.zeros_like(weights)

    def take(self, gradient: np.ndarray, shrink: float = 0.0) -> None:
        self.step += 1
        self.mean += 0.1 * (gradient - self.mean)
        self.square += 0.01 * (gradient**2 - self.square)
        scale = np.sqrt(self.square / (1 - 0.99**self.step)) + 1e-8
        self.weights -= self.rate * (self.mean / (1 - 0.9**self.step)) / scale
        if shrink:  # soft threshold: weights without steady support stay zero
            np.copyto(self.weights, np.sign(self.weights) * np.maximum(np.abs(self.weights) - self.rate * shrink / scale, 0))


def repeat_until(step: Callable[[], float], rounds: int, tolerance: float = 1e-5) -> float:
    """Run `step`, which returns the loss, until it hardly falls over ten rounds."""
    past: list[float] = []
    for _ in range(rounds):
        past.append(step())
        if len(past) > 20 and past[-11] - past[-1] < tolerance * max(1.0, abs(past[-1])):
            break
    return past[-1] if past else 0.0

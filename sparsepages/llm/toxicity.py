"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, small_batches

BITS = 20  # 2**BITS features: at most 12 MB of weights
SAMPLE_ROWS = 20_000  # labelled documents to learn from, about
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.2
KNOWN_WORDS = 1 << 16
SEED = 7
THRESHOLD = 0.3

_WORD = re.compile(r"\w+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Features:
    """Feature numbers of a text: its words, neighbouring pairs, and pairs with one or two words between."""

    def __init__(self):
        import xxhash

        self.hash, self.known = xxhash.xxh64_intdigest, {}

    def all_of(self, text: str | None) -> np.ndarray:
        """One number per occurrence."""
        known, own = self.known, _WORD.findall((text or "").lower())
        try:
            codes = np.array(list(map(known.__getitem__, own)), np.uint64)
        except KeyError:
            if len(known) > KNOWN_WORDS:
                known.clear()
            for w in own:
                if w not in known:
                    known[w] = self.hash(w)
            codes = np.array(list(map(known.__getitem__, own)), np.uint64)
        parts = [codes * _ODD]
        for gap in (1, 2, 3):
            mixed = (codes[:-gap] * _ODD + np.uint64(gap)) ^ (codes[gap:] >> np.uint64(7))
            parts.append(mixed * _ODD)
        return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int32)


class Learner:
    """FTRL-proximal with a learning rate per coordinate; a feature is present or not."""

    def __init__(self):
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        self.bias_z = self.bias_n = 0.0

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def bias(self) -> float:
        return -self.bias_z / ((BETA + math.sqrt(self.bias_n)) / ALPHA)

    def learn(self, features: np.ndarray, label: int) -> None:
        z, n = self.z[features], self.n[features]
        w = self.weights(z, n)
        bias = self.bias()
        error = 1 / (1 + math.exp(-max(-35.0, min(35.0, bias + w.sum())))) - label
        self.z[features] = z + error - (np.sqrt(n + error * error) - np.sqrt(n)) / ALPHA * w
        self.n[features] = n + error * error
        self.bias_z += error - (math.sqrt(self.bias_n + error * error) - math.sqrt(self.bias_n)) / ALPHA * bias
        self.bias_n += error * error


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: crc32 of the id as text leaves 2 when divided by 4. False for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, epochs: int = EPOCHS) -> list[tuple[int, float]]:
    """Weights as ``(feature, weight)`` without zeros; feature -1 is the bias.

    Learns from about ``rows`` documents that have a label and are not held out,
    chosen by a hash of the id. Labels that are null, and ids without a document,
    teach nothing; an id with several labels counts as toxic if one says so, an
    id with several texts by its smallest text. Each epoch goes through the
    sample in another fixed order, in one task that holds one batch and the
    weights; features are made in parallel. Without labels there are no weights
    and all scores are 0.5.
    """
    small_batches(docs.sparkSession)
    known = (
        labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    known = settle(known)
    share = min(1.0, rows / max(1, known.count()))
    chosen = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 40)) < int(share * (1 << 40))
    sample = known.filter(chosen)
    # The sample is bounded by `rows`, hence the broadcast.
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))

    def extract(batches):
        import pyarrow as pa

        features = Features()
        for batch in batches:
            found = [np.unique(features.all_of(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.string()), batch.column("toxic").cast(pa.int32()), pa.array(found, pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "features"],
            )

    def fit(batches):
        import pyarrow as pa

        learner = Learner()
        for batch in batches:
            for label, features in zip(batch.column("toxic").to_pylist(), batch.column("features"), strict=True):
                learner.learn(features.values.to_numpy(), int(label > 0))
        weights = learner.weights(learner.z, learner.n)
        index = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-1], index]), pa.int32()), pa.array(np.concatenate([[learner.bias()], weights[index]]), pa.float64())], names=["feature", "weight"]
        )

    made = settle(texts.mapInArrow(extract, "doc_id string, toxic int, features array<int>"))
    passes = made.withColumn("epoch", F.explode(F.array(*map(F.lit, range(epochs))))).withColumn("turn", F.xxhash64("doc_id", "epoch"))
    ordered = passes.repartition(1).sortWithinPartitions("epoch", "turn").select("toxic", "features")
    learned = ordered.mapInArrow(fit, "feature int, weight double").collect()  # 2**BITS rows at most
    return [(r[0], r[1]) for r in learned] or [(-1, 0.0)]


def scorer(spark: SparkSession, weights: list[tuple[int, float]]):
    """A function of a text column: the chance, 0 to 1, that the whole text is toxic; null counts as empty."""
    small_batches(spark)
    bias = sum(w for f, w in weights if f < 0)
    index = np.array([f for f, _ in weights if f >= 0], np.int32)
    sent = spark.sparkContext.broadcast((index, np.array([w for f, w in weights if f >= 0], np.float32)))

    @F.pandas_udf("double")
    def chance(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, values = sent.value
        weights = np.zeros(1 << BITS, np.float32)
        weights[index] = values
        features = Features()
        for texts in batches:
            scores = []
            for text in texts:
                found = features.all_of(text)
                found = np.unique(found[weights[found] != 0])
                scores.append(1 / (1 + math.exp(-max(-35.0, min(35.0, bias + float(weights[found].sum()))))))
            yield pd.Series(scores, dtype="float64")

    return chance


def score(docs: DataFrame, weights: list[tuple[int, float]], threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``docs``.

    Whole texts are scored; a null or empty text gets the score of no feature.
    Null and repeated ids stay rows of their own; further columns are not read.
    """
    scored = docs.select("doc_id", scorer(docs.sparkSession, weights)(F.col("text")).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, weights: list[tuple[int, float]], threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    return docs.filter(scorer(docs.sparkSession, weights)(F.col("text")) < threshold)

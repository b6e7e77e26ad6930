"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the words, their stems of a few lengths (inflected and compound words
share them), neighbouring pairs and pairs with one or two words between, hashed into ``2 ** BITS`` slots, each counted once. Training is one online pass per epoch over
a bounded sample of labelled rows, with a learning rate per coordinate; the L1 term leaves few
weights, which go to the tasks that score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilelake.llm.common import ALNUM, arrow_limits, byte_texts, fold

BITS = 20
THRESHOLD = 0.3
#: Labelled rows to learn from at most: those with the least hash of their id.
SAMPLE = 8192
EPOCHS = 4
#: Rate, its offset, and the penalties of the method.
ALPHA, BETA, L1, L2 = 0.7, 1.0, 5.0, 1.0
#: Multipliers that mix two word hashes, one per feature kind (pair, one and two words skipped).
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
#: Lengths of stems in bytes.
STEMS = (5, 6, 7, 8)
#: Word hashes that a task remembers at most.
_MEMORY = 500_000


class Vocabulary:
    """Hashes of the words seen so far, and of their stems: one row of a table per word."""

    def __init__(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.table = np.zeros((1024, 1 + len(STEMS)), np.uint64)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.rows) > _MEMORY:
            self.rows.clear()
        for word in set(words).difference(self.rows):
            at = self.rows[word] = len(self.rows)
            if at == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            stems = [xxhash.xxh64_intdigest(word[:k], k) if len(word) > k else 0 for k in STEMS]
            self.table[at] = [xxhash.xxh64_intdigest(word), *stems]
        return self.table[np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))]


def slots(text: bytes, vocabulary: Vocabulary, bits: int = BITS) -> np.ndarray:
    """Hash slots of all features of a UTF-8 text, repeats included."""
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    known = vocabulary(text.translate(ALNUM).split())
    h, stems = known[:, 0], known[:, 1:]
    made = [h, stems[stems != 0]]
    for gap, mix in enumerate(_MIX, 1):
        if len(h) > gap:
            made.append((h[:-gap] * mix) ^ (h[gap:] + mix))
    found = np.concatenate(made) * _MIX[0]
    return (found >> np.uint64(64 - bits)).astype(np.uint32)


@dataclass
class Ftrl:
    """FTRL-proximal state: z and the sum of squared gradients n per coordinate."""

    size: int = 1 << BITS
    z: np.ndarray = field(init=False)
    n: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.z, self.n = np.zeros(self.size + 1), np.zeros(self.size + 1)  # the last is the bias

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == self.size, 0.0, L1)
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, self.size)
        w, n = self.weights(at), self.n[at]
        gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        squared = n + gradient * gradient
        self.z[at] += gradient - (np.sqrt(squared) - np.sqrt(n)) / ALPHA * w
        self.n[at] = squared


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vocabulary = Vocabulary()
    for batch in batches:
        found = [np.unique(slots(t, vocabulary)).tobytes() for t in byte_texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("turn"), batch.column("toxic"), pa.array(found, pa.binary())],
            names=["turn", "toxic", "slots"],
        )


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = Ftrl()
    rows = [
        (np.frombuffer(s, np.uint32), y)
        for b in batches for s, y in zip(b.column("slots").to_pylist(), b.column("toxic").to_pylist())
    ]
    for _ in range(EPOCHS if rows else 0):
        for at, label in rows:
            model.learn(at, label)
    w = model.weights(np.arange(model.size + 1))
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays(
        [pa.array(at, pa.int32()), pa.array(w[at], pa.float64())], names=["slot", "weight"]
    )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Sparse weights ``(slot, weight)``; slot ``2 ** BITS`` is the bias.

    Learns from at most ``sample`` rows of ``labels (doc_id, toxic)``, in the order of a hash of
    the id. Rows without id or label are passed over; an id labelled twice is toxic if it is so
    once. The sample bounds what is broadcast and what the one training task reads. No labelled
    document: no weights.
    """
    arrow_limits(docs.sparkSession)
    chosen = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .where("doc_id is not null and toxic is not null")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .withColumn("turn", F.xxhash64("doc_id")).orderBy("turn", "doc_id").limit(sample)
    )
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(
        F.broadcast(chosen), "doc_id"  # at most ``sample`` rows of three numbers
    )
    return (
        rows.select("turn", "toxic", "text")
        .mapInArrow(_features, "turn long, toxic int, slots binary")
        .repartition(1).sortWithinPartitions("turn", "slots")
        .mapInArrow(_train, "slot int, weight double")
    )


def _scorer(at: np.ndarray, weight: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros((1 << BITS) + 1)
        dense[at] = weight
        used = dense != 0
        vocabulary = Vocabulary()
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for i, text in enumerate(byte_texts(batch.column("text")) if len(at) else ()):
                found = slots(text, vocabulary)
                total = dense[np.unique(found[used[found]])].sum() + dense[-1]
                scores[i] = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            yield pa.RecordBatch.from_pydict(
                {c: batch.column(c) for c in batch.schema.names} | {"score": pa.array(scores)}
            )

    return run


def score(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """``docs`` with ``score``, 0 to 1, of each text; null and empty texts get the bias alone.

    Without any weight the score is 0. A column named score is replaced. The weights are
    collected: at most ``2 ** BITS`` numbers, and few after the L1 term.
    """
    arrow_limits(docs.sparkSession)
    found = weights.toPandas()
    rows = docs.drop("score")
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(
        _scorer(found["slot"].to_numpy(np.int64), found["weight"].to_numpy(np.float64)), schema
    )


def learned(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Weights from the labelled rows that are not held out (crc32 of the id modulo 4 is 2)."""
    return train(docs, labels.where(fold("doc_id", 4) != 2))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Only the text makes the score. A null id is not held out. Repeated rows stay.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return score(rows, learned(docs, labels)).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    names = docs.columns
    rows = docs.select("text", F.struct(*[docs[c] for c in names if c != "text"]).alias("_row"))
    kept = score(rows, learned(docs, labels)).where(F.col("score") < THRESHOLD)
    return kept.select(*[
        F.col("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in names
    ])

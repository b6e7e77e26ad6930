"""Class-based n-gram scores: exchange clustering, class transitions and word emissions.

The most frequent words are dealt over ``CLASSES`` classes and moved, round by round, to the
class that makes their neighbours most likely; rarer words belong to a class by their shape.
The model's probability of a token is that of its class after the one before, times that of the
word within the class. Counts are taken over all training texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilelake.llm.common import LOWER, arrow_limits, byte_texts, fold, stored

CLASSES = 64
#: Words that exchange classes, and words whose counts go to every task; both by frequency,
#: and of at most LONG bytes, so that what is sent is bounded. All others meet by join.
EXCHANGED = 8192
SENT = 200_000
LONG = 64
ROUNDS = 6
#: Weight of the class frequencies in the transitions.
PRIOR = 1.0
#: Shapes of other words, and the token after the last word.
SHAPES = 8
END = b""
_DIGIT = re.compile(rb"[0-9]")
#: Distinct words and bigrams that a task holds before it passes them on.
_HELD, _PAIRS = 300_000, 4_000_000

N_IDS = EXCHANGED + SHAPES + 1
N_CLASSES = CLASSES + SHAPES + 1


def shape(word: bytes) -> int:
    """0 to 7: ends with a mark, has a digit, has a non-ASCII character."""
    return (not word[-1:].isalnum() and word[-1] < 128) + 2 * bool(_DIGIT.search(word)) + 4 * (
        not word.isascii())


def _words(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out():
        batch = pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())],
            names=["word", "n"])
        held.clear()
        return batch

    for batch in batches:
        for text in byte_texts(batch.column("text")):
            held.update(_words(text))
            held[END] += 1
            if len(held) > _HELD:
                yield out()
    if held:
        yield out()


class _Ids(dict):
    """Ids of words: frequent ones by rank, others by shape; remembers a bounded number."""

    def __init__(self, frequent: list[bytes]) -> None:
        super().__init__({w: i for i, w in enumerate(frequent)})
        self.frequent = frequent
        self[END] = N_IDS - 1

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            frequent = self.frequent
            self.clear()
            self.__init__(frequent)
        value = self[word] = EXCHANGED + shape(word)
        return value


def _pairs(frequent: Broadcast):
    """Counts of neighbouring ids, as ``(pair, n)`` with pair = left id * N_IDS + right id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids(frequent.value)
        held, size = [], 0

        def out():
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n, pa.int64())], names=["pair", "n"])

        for batch in batches:
            tokens = [END]
            for text in byte_texts(batch.column("text")):
                tokens += _words(text)
                tokens.append(END)
            found = np.fromiter(map(ids.__getitem__, tokens), np.int64, len(tokens))
            held.append(found[:-1] * N_IDS + found[1:])
            size += len(tokens)
            if size > _PAIRS:
                yield out()
                size = 0
        if held:
            yield out()

    return run


def _contexts(classes: Broadcast):
    """``(cell, n)``: per word id how often each class comes before it, and after it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = classes.value
        for batch in batches:
            pair, n = batch.column("pair").to_numpy(), batch.column("n").to_numpy()
            left, right = np.divmod(pair, N_IDS)
            cells = np.concatenate([
                (right * 2) * N_CLASSES + of[left], (left * 2 + 1) * N_CLASSES + of[right]])
            cell, at = np.unique(cells, return_inverse=True)
            yield pa.RecordBatch.from_arrays([
                pa.array(cell),
                pa.array(np.bincount(at, np.concatenate([n, n])).astype(np.int64)),
            ], names=["cell", "n"])

    return run


def _context_matrix(pairs: DataFrame, classes: np.ndarray) -> np.ndarray:
    """``(id, 0 before or 1 after, class)`` counts: a bounded matrix, whatever the corpus."""
    sent = pairs.sparkSession.sparkContext.broadcast(classes)
    rows = pairs.mapInArrow(_contexts(sent), "cell long, n long").groupBy("cell").agg(
        F.sum("n").alias("n")).toArrow()
    matrix = np.zeros(N_IDS * 2 * N_CLASSES)
    matrix[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    return matrix.reshape(N_IDS, 2, N_CLASSES)


def transitions(counts: np.ndarray) -> np.ndarray:
    """Smoothed probability of a class (column) after a class (row)."""
    follows = counts.sum(axis=0) + 1
    prior = PRIOR * len(counts) * follows / follows.sum()
    return (counts + prior) / (counts.sum(axis=1, keepdims=True) + prior.sum())


def exchange(contexts: np.ndarray, classes: np.ndarray, turn: int) -> np.ndarray:
    """Classes after every second exchanged word has moved to where its contexts fit best."""
    counts = np.zeros((N_CLASSES, N_CLASSES))
    np.add.at(counts, classes, contexts[:, 1])
    log_t = np.log(transitions(counts))
    uses = contexts[:EXCHANGED, 1].sum(axis=1)
    sizes = np.bincount(classes[:EXCHANGED], uses, CLASSES)
    fit = (
        contexts[:EXCHANGED, 1] @ log_t[:CLASSES].T + contexts[:EXCHANGED, 0] @ log_t[:, :CLASSES]
        - uses[:, None] * np.log(sizes + uses[:, None] + 1)
    )
    moved = classes.copy()
    mine = (np.arange(EXCHANGED) % 2 == turn % 2) & (uses > 0)
    moved[:EXCHANGED][mine] = fit.argmax(axis=1)[mine]
    return moved


@dataclass
class Model:
    classes: np.ndarray
    log_moves: np.ndarray
    log_within: np.ndarray  # of 1 / (tokens + words + 1) per class
    frequent: list[bytes]
    sent: dict[bytes, int]
    tokens: int
    words: int
    ends: int

    @property
    def log_all(self) -> float:
        return -float(np.log10(self.tokens + self.words + 1))


def train(texts: DataFrame) -> tuple[Model, DataFrame]:
    """The model, and all counts ``(word, n)``; the word "" is the end of a text."""
    spark = texts.sparkSession
    arrow_limits(spark)
    counts = stored(texts.select("text").mapInArrow(_counted, "word string, n long").groupBy("word")
                    .agg(F.sum("n").alias("n")), "word-counts")
    tokens, words = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.where(f"word <> '' and octet_length(word) <= {LONG}").orderBy(
        F.desc("n"), "word").limit(SENT).toArrow()
    # the rows of a limit come in its order
    names = byte_texts(top["word"].combine_chunks())
    sent = dict(zip(names, top["n"].to_pylist()))
    frequent = names[:EXCHANGED]

    pairs = stored(texts.select("text").mapInArrow(
        _pairs(spark.sparkContext.broadcast(frequent)), "pair long, n long"
    ).groupBy("pair").agg(F.sum("n").alias("n")), "word-pairs")
    classes = np.concatenate([np.arange(EXCHANGED) % CLASSES, np.arange(CLASSES, N_CLASSES)])
    for turn in range(ROUNDS):
        classes = exchange(_context_matrix(pairs, classes), classes, turn)
    contexts = _context_matrix(pairs, classes)
    moves = np.zeros((N_CLASSES, N_CLASSES))
    np.add.at(moves, classes, contexts[:, 1])

    # tokens and distinct words of each class
    uses = np.zeros(N_CLASSES)
    kinds = np.zeros(N_CLASSES)
    ids = spark.sparkContext.broadcast(frequent)

    def by_id(batches):
        known = _Ids(ids.value)
        for batch in batches:
            at = np.fromiter((known[w] for w in byte_texts(batch.column("word"))), np.int64, batch.num_rows)
            n = batch.column("n").to_numpy()
            here, of = np.unique(at, return_inverse=True)
            yield pa.RecordBatch.from_arrays([
                pa.array(here), pa.array(np.bincount(of, n).astype(np.int64)),
                pa.array(np.bincount(of), pa.int64())], names=["id", "n", "words"])

    for row in counts.mapInArrow(by_id, "id long, n long, words long").groupBy("id").agg(
            F.sum("n").alias("n"), F.sum("words").alias("words")).collect():  # at most N_IDS rows
        uses[classes[row["id"]]] += row["n"]
        kinds[classes[row["id"]]] += row["words"]
    return Model(
        classes, np.log10(transitions(moves)), -np.log10(uses + kinds + 1), frequent, sent,
        int(tokens), int(words), int(uses[-1]),
    ), counts


def _scored(model: Broadcast):
    """Sums per row over the words whose counts are here, and the others to be looked up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        ids = _Ids(m.frequent)
        row = TaskContext.get().partitionId() << 40
        ends = m.ends
        for batch in batches:
            out = []
            for text in byte_texts(batch.column("text")):
                words = _words(text)
                at = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
                of = m.classes[np.concatenate(([N_IDS - 1], at, [N_IDS - 1]))]
                uses = np.fromiter((m.sent.get(w, -1) for w in words), np.int64, len(words))
                here = uses >= 0
                plus = np.log10(uses[here] + 1.0).sum() + np.log10(ends + 1.0)
                n_here = int(here.sum()) + 1
                score = m.log_moves[of[:-1], of[1:]].sum() + m.log_within[of[1:]].sum() + plus
                rare = Counter(words[i] for i in np.flatnonzero(~here))
                out.append((
                    row, len(words) + 1, n_here - 1 + (ends > 0), (len(words) + 1) * m.log_all + plus, score,
                    [{"word": w, "n": n} for w, n in rare.items()],
                ))
                row += 1
            key, n, known, base, score, rare = zip(*out) if out else ((),) * 6
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(key, pa.int64()), pa.array(n, pa.int64()),
                pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64()),
                pa.array(rare, pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))),
            ], names=["doc_id", "row", "n_tokens", "n_known", "base_score", "score", "rare"])

    return run


def report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs (doc_id, text)``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    Learns from the rows whose crc32 of the id modulo 7 is not 2; a null id is not held out.
    Null texts are empty: one token, the end. Repeated rows stay rows of their own and count each
    time. Without training rows all counts are 0 and all classes alike. Other columns are
    ignored. A row's score adds up where its words' counts are; words that are not among those
    sent to the tasks meet the counts by join, once per row and word.
    """
    spark = docs.sparkSession
    arrow_limits(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    model, counts = train(rows.where(fold("doc_id", 7) != 2))
    scored = stored(rows.mapInArrow(
        _scored(spark.sparkContext.broadcast(model)),
        "doc_id long, row long, n_tokens long, n_known long, base_score double, score double,"
        " rare array<struct<word: binary, n: bigint>>"), "scores")
    rare = scored.select("row", F.explode("rare").alias("r")).select(
        "row", F.col("r.word").cast("string").alias("word"), "r.n")
    looked = rare.join(counts.select("word", F.col("n").alias("uses")), "word", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("uses", F.lit(0)) + 1.0)).alias("plus"),
        F.sum(F.when(F.col("uses").isNotNull(), F.col("n")).otherwise(0)).alias("known"))
    return scored.join(looked, "row", "left").select(
        "doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("plus", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("plus", F.lit(0.0))).alias("score"),
    )

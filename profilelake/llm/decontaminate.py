"""Benchmark decontamination: one Aho-Corasick automaton scans every text once.

Patterns are the word windows of the normalised benchmark items. Words of a text, normalised
alike, are joined by single spaces, so a window occurs exactly where its string, with a space
on either side, does. Hits carry word positions, which ``spans`` maps back to the text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilelake.llm.common import ALNUM, arrow_limits, byte_texts, stored

WINDOW = 10
#: Benchmark bytes that one automaton takes (about ten nodes a byte); a larger benchmark is
#: scanned for in blocks.
BLOCK_BYTES = 256 << 10

_RANGES = T.ArrayType(T.StructType().add("start", "long").add("end", "long"))
OWN = (
    T.StructType().add("n_words", "long").add("n_hit", "long").add("hits", _RANGES)
    .add("spans", _RANGES).add("items", T.ArrayType(T.StringType()))
)
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def words(text: bytes) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.translate(ALNUM).split()


def windows(text: bytes, size: int) -> list[bytes]:
    """Windows of ``size`` words, joined by spaces; a shorter text is one window."""
    w = words(text)
    return [b" ".join(w[i: i + size]) for i in range(max(1, len(w) - size + 1))] if w else []


def automaton(items: list[tuple[str, bytes]], size: int = WINDOW) -> ahocorasick.Automaton:
    """Over the windows of all items; a value is (words in the window, ids of its items)."""
    ids: dict[bytes, dict[str, None]] = {}
    for item, text in items:
        for window in windows(text, size):
            ids.setdefault(window, {})[item] = None
    found = ahocorasick.Automaton()
    for window, of in ids.items():
        # bytes as characters of one byte each: the automaton takes strings
        found.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, tuple(of)))
    if ids:
        found.make_automaton()
    return found


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return edges[::2], edges[1::2]


def scan(text: bytes, found: ahocorasick.Automaton) -> tuple[int, np.ndarray, set[str]]:
    """Number of words, which of them are hit, and the items with an occurring window."""
    w = words(text)
    hit, items = np.zeros(len(w), bool), set()
    if w and len(found):
        joined = f" {b' '.join(w).decode('latin-1')} "
        spaces = None
        for end, (length, of) in found.iter(joined):
            if spaces is None:
                spaces = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), np.uint8) == 32)
            last = int(np.searchsorted(spaces, end))
            hit[last - length: last] = True
            items.update(of)
    return len(w), hit, items


def spans(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the original text that word ranges cover, ends exclusive."""
    raw = np.frombuffer(text, np.uint8)
    at, to = _runs(np.frombuffer(text.translate(ALNUM), np.uint8) != 32)
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return points[at[starts]], points[to[ends - 1]]


def _scanner(packed: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pickle.loads(packed)
        for batch in batches:
            out = []
            texts = byte_texts(batch.column("text"))
            before = batch.column("hits").to_pylist() if "hits" in batch.schema.names else None
            known = batch.column("items").to_pylist() if before is not None else None
            for i, text in enumerate(texts):
                n, hit, items = scan(text, found)
                for r in before[i] if before else ():
                    hit[r["start"]: r["end"]] = True
                items.update(known[i] if known else ())
                runs = [[], []]
                if hit.any():
                    runs = _runs(hit)
                    marks = spans(text, *runs)
                else:
                    marks = runs
                out.append((n, int(hit.sum()), *(
                    [{"start": int(a), "end": int(b)} for a, b in zip(*x)] for x in (runs, marks)
                ), sorted(items)))
            n, n_hit, hits, marks, items = zip(*out) if out else ((),) * 5
            columns = {
                "n_words": pa.array(n, pa.int64()),
                "n_hit": pa.array(n_hit, pa.int64()), "hits": pa.array(hits, _RUNS),
                "spans": pa.array(marks, _RUNS), "items": pa.array(items, pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_pydict(columns | {
                k: batch.column(k) for k in batch.schema.names if k not in columns
            })

    return run


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: its columns and n_words, n_hit, hits, spans, items.

    ``hits`` are runs of hit words, ``spans`` the same as code points of the text, ``items`` the
    ids, as sorted strings, of the items of which a window occurs. A window is ``window`` words
    of an item in a row; an item of fewer, but not none, is one window. Null and empty texts
    have no words, on either side; an item without id counts for hits and is called "null".
    Repeated rows are rows of their own. Columns of ``docs`` with these names are replaced.

    The automaton goes to the tasks, so its size is bounded: a benchmark of more than
    ``block_bytes``, rows repeated counting once, is dealt over blocks, and the texts pass through one automaton after the
    other, each adding to the hits of those before.
    """
    spark = docs.sparkSession
    arrow_limits(spark)
    items = stored(benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
        F.col("text").cast("string"),
    ).where("text is not null").distinct(), "benchmark-items")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    rows = docs.drop(*OWN.names).withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*OWN.fields, *rows.schema.fields])
    for k in range(blocks):
        # one block of bounded size at a time
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        packed = pickle.dumps(
            automaton([(r[0], r[1].encode()) for r in part.toLocalIterator()], window)
        )
        rows = rows.mapInArrow(_scanner(packed), schema)
    return rows


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find(docs.select(F.col("doc_id").cast("long"), "text"), benchmark, window)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, with all their columns."""
    marked = docs.select(
        "text", F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("_row")
    )
    kept = find(marked, benchmark, window).where("n_hit = 0")
    return kept.select(*[
        F.col("text") if c == "text" else F.col("_row").getField(c).alias(c)
        for c in docs.columns
    ])

"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints within 3 bits differ in at most one bit (half of 3, rounded down) in
one of their two halves. So every fingerprint emits, for each half, the value of that half and
all variants within one bit; equal variants meet in one shuffle, and a pair that meets is
verified on the whole fingerprint. Balls around whole fingerprints would need radius 2 on at
least one side: 2,081 variants each instead of 68, for the same links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilelake.llm import jaccard
from profilelake.llm.common import arrow_limits, byte_texts, stored
from profilelake.llm.graph import components
from profilelake.llm.jaccard import shingles

SEED = 42
SHINGLE = 3
RADIUS = 3
#: Hashes whose bits are counted at one time.
_BLOCK = 1 << 16


def fingerprint(text: bytes) -> int:
    """64-bit fingerprint of a UTF-8 text; 0 for a text without words."""
    found = shingles(text, SHINGLE)
    if not found:
        return 0
    digest = xxhash.xxh64_digest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(found), _BLOCK):
        hashes = b"".join([digest(s, SEED) for s in found[at: at + _BLOCK]])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(found)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first columns as they are, and in place of the last, the text, its fingerprint."""
    for batch in batches:
        prints = np.array([fingerprint(t) for t in byte_texts(batch.columns[-1])], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(prints.view(np.int64))],
            names=[*batch.schema.names[:-1], "fp"],
        )


def fingerprints(docs: DataFrame, *more: Column) -> DataFrame:
    """``(doc_id, ..., fp)`` per row of ``docs (doc_id, text)``; fp is the fingerprint as a long.

    ``more``: columns of ``docs`` to pass along.
    """
    arrow_limits(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), *more, F.col("text").cast("string"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("fp", T.LongType())])
    return rows.mapInArrow(_fingerprints, schema)


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs ``(u, v)`` of different fingerprints ``fp`` within ``radius`` (at most 3) bits.

    A half emits itself (bit 32) and the variants in which one more bit is set: of two halves
    that differ in one bit, one is such a variant of the other.
    """
    if not 0 <= radius <= 3:
        raise ValueError("halves cover a radius of at most 3")
    halves = distinct.select(
        "fp",
        F.explode(F.array(
            F.struct(F.lit(0).alias("side"), F.expr("fp & 4294967295L").alias("half")),
            F.struct(F.lit(1).alias("side"), F.expr("shiftrightunsigned(fp, 32)").alias("half")),
        )).alias("h"),
    ).select("fp", "h.side", "h.half")
    variants = (
        halves.withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(32))))
        .where("bit = 32 or (shiftrightunsigned(half, bit) & 1) = 0")
        .select("side", F.expr("if(bit = 32, half, half | shiftleft(1L, bit))").alias("half"),
                "bit", F.col("fp").alias("a"))
    )
    centres = halves.select("side", "half", F.col("fp").alias("b"))
    return (
        variants.join(centres, ["side", "half"])
        .where(f"a <> b and (bit < 32 or a < b) and bit_count(a ^ b) <= {radius}")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )


def _grouped(docs: DataFrame, radius: int, *more: Column) -> DataFrame:
    """What ``fingerprints`` returns, with ``root`` (same for linked rows) and ``component_id``."""
    prints = stored(fingerprints(docs, *more), "simhash")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    linked = components(links(nodes.select("fp"), radius), "simhash-links")
    rooted = nodes.join(linked, nodes.fp == linked.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(rooted.join(least, "root").drop("first_id"), "fp")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row of ``docs``.

    Words are runs without white space, A-Z lower-cased; shingles are 3 words, repeats counted;
    fewer words make one shingle. Null and empty texts have the fingerprint zero and link like
    any other. Rows with one fingerprint collapse before the search, so groups of copies of any
    size cost one node. ``component_id`` is the least doc_id among linked rows; null ids are
    passed over, and a component of null ids alone has null. Repeated rows and ids stay rows of
    their own. Other columns are ignored. An empty table gives no rows.
    """
    return _grouped(docs, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As ``_fingerprints``, with the name of the set of longer shingles and its band keys."""
    for batch in batches:
        texts = byte_texts(batch.columns[-1])
        sets = [jaccard.bands(t) for t in texts]
        prints = np.array([fingerprint(t) for t in texts], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(prints.view(np.int64)),
             pa.array([s for s, _ in sets], pa.int64()),
             pa.array([k for _, k in sets], pa.list_(pa.int64()))],
            names=[*batch.schema.names[:-1], "fp", "set_id", "keys"],
        )


def keep_one(docs: DataFrame, radius: int = RADIUS, least: float = jaccard.SIMILARITY) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the least doc_id.

    Rows are near-duplicates if their fingerprints are within ``radius`` bits, or if the sets of
    their shingles of five words have a Jaccard similarity of at least ``least``; the second is
    found for all but 0.0004 of the pairs at 0.8, and no other pair is taken for it.

    Null ids come last; rows of one id are told apart by a hash of their text, and of rows that
    agree in both any one stays. All columns of ``docs`` are kept as they are.
    """
    # the id and a hash of the text name a row; no null, so the join below is a plain one
    row_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    row_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    arrow_limits(docs.sparkSession)
    rows = docs.select(row_id.alias("_id"), row_hash.alias("_hash"), F.col("text").cast("string"))
    prints = stored(rows.mapInArrow(
        _named, "_id long, _hash long, fp long, set_id long, keys array<long>"), "simhash")
    row = F.min(F.struct("_id", "_hash")).alias("row")
    nodes = stored(prints.groupBy("fp").agg(row), "simhash-nodes")
    sets = stored(prints.groupBy("set_id").agg(
        F.min("fp").alias("set_fp"), row, F.first("keys").alias("keys")), "simhash-sets")
    texts = rows.join(sets.select("set_id", "row._id", "row._hash"), ["_id", "_hash"]).dropDuplicates(
        ["set_id"]).select("set_id", "text")
    alike = jaccard.links(sets.select("set_id", "keys"), texts, least)
    # a set stands for its least fingerprint
    named = sets.select("set_id", "set_fp")
    edges = links(nodes.select("fp"), radius).unionByName(
        prints.select("fp", "set_id").distinct().join(named, "set_id").where("fp <> set_fp")
        .select(F.col("fp").alias("u"), F.col("set_fp").alias("v"))
    ).unionByName(
        alike.join(named.select(F.col("set_id").alias("u"), F.col("set_fp").alias("a")), "u")
        .join(named.select(F.col("set_id").alias("v"), F.col("set_fp").alias("b")), "v")
        .select(F.col("a").alias("u"), F.col("b").alias("v"))
    )
    linked = components(edges, "simhash-links")
    kept = (
        nodes.join(linked, nodes.fp == linked.node, "left")
        .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("row").alias("first"))
        .select("first._id", "first._hash")
    )
    return (
        docs.withColumns({"_id": row_id, "_hash": row_hash})
        .join(kept, ["_id", "_hash"], "left_semi")
        .dropDuplicates(["_id", "_hash"]).drop("_id", "_hash")
    )

"""Hard negatives, spelling variants and SentencePiece chunks against plain versions."""

import hashlib
import random

import pytest
from pyspark.sql import types as T

from profilelake.llm import hardneg, pieces, queries, variants

EMB = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()), T.StructField("_row", T.StringType()),
    T.StructField("anchor", T.IntegerType()),
])


def _vectors(n, seed=3, dim=8):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        vec = [rng.uniform(-1, 1) for _ in range(dim)]
        rows.append([i, vec, rng.randrange(3), "x", 1])
    # ties: identical vectors; repeated rows; nulls and non-finite components
    rows[5][1] = list(rows[4][1])
    rows[6][1] = list(rows[4][1])
    rows.append(list(rows[7]))
    rows.append([1000, None, 1, "x", 1])
    rows.append([1001, rows[3][1], None, "x", 1])
    rows.append([1002, [float("nan")] + rows[3][1][1:], 1, "x", 1])
    rows.append([1003, [None] + rows[3][1][1:], 1, "x", 1])
    rows.append([1004, [float("inf")] * 8, 1, "x", 1])
    rows.append([1100, [], 2, "x", 1])
    return [tuple(r) for r in rows]


def _float32(rows):
    """What a float column holds: components rounded to single precision."""
    import struct
    out = []
    for vid, vec, lab, *_ in rows:
        if vec is not None:
            vec = [None if x is None else struct.unpack("f", struct.pack("f", x))[0] for x in vec]
        out.append((vid, vec, lab))
    return out


@pytest.mark.parametrize("n", [0, 10, 350])
def test_hard_negatives_match_brute_force(spark, n):
    rows = _vectors(n) if n else []
    df = spark.createDataFrame(rows, EMB)
    got = sorted(map(tuple, hardneg.mine(df).collect()))
    assert got == sorted(hardneg.brute_force(_float32(rows)))
    if n == 350:
        assert got and all(r[2] <= hardneg.NEGATIVES for r in got)
        assert all(30 * r[4] <= 100 * r[5] <= 90 * r[4] for r in got)


def test_hard_negatives_tiles_split(spark, monkeypatch):
    """Many row and anchor blocks give the same answer as one."""
    monkeypatch.setattr(hardneg, "ROW_BLOCK", 37)
    monkeypatch.setattr(hardneg, "ANCHOR_BLOCK", 2)
    rows = _vectors(400, seed=9)
    got = sorted(map(tuple, hardneg.mine(spark.createDataFrame(rows, EMB)).collect()))
    assert got == sorted(hardneg.brute_force(_float32(rows)))


def test_hard_negatives_of_rows_that_share_or_lack_an_id(spark):
    """Another row of the anchor's id, and a row without one, take part as any other row does."""
    rows = [(0, [1.0, 0.0], 4), (0, [1.0, 0.0], 4), (0, [0.5, 0.25], 7), (1, [0.75, 0.0], 5),
            (None, [0.75, 0.5], 3), (None, [0.625, 0.0], 6), (2, [0.375, 0.0], 8)]
    # id 0 moves to label 5 and 8; each of the first two rows is the other's first positive
    once = [
        (0, 0, 1, None, 65536, 49152), (0, 0, 2, None, 65536, 40960), (0, 0, 3, 0, 65536, 32768),
        (0, 0, 4, 2, 65536, 24576), (0, 1, 1, None, 49152, 40960), (0, 1, 2, 0, 49152, 32768),
        (0, 1, 3, 2, 49152, 24576)]
    got = hardneg.mine(spark.createDataFrame([(*r, "x", 1) for r in rows], EMB)).collect()
    assert sorted(map(tuple, got), key=lambda r: r[:3]) == sorted(once * 2, key=lambda r: r[:3])


def test_hard_negatives_of_large_scores(spark):
    """A hundred times these scores is more than a long holds."""
    rows = [(i, [x * 2.0**22], c) for i, x, c in [
        (100, 1.0, 1), (1, 1.0, 1), (2, 0.875, 2), (3, 0.5, 2), (4, 0.25, 2), (5, 1.0, 2)]]
    got = hardneg.mine(spark.createDataFrame([(*r, "x", 1) for r in rows], EMB)).collect()
    assert sorted(map(tuple, got)) == sorted(hardneg.brute_force(rows))
    assert [r.negative_id for r in sorted(got, key=lambda r: r.rank)] == [2, 3]


def test_hard_negatives_query(spark, sf_dir):
    import pyarrow.parquet as pq
    got = sorted(map(tuple, queries.op11_hard_negatives(spark, sf_dir).collect()))
    rows = [(r["vec_id"], r["embedding"], r["label"])
            for r in pq.read_table(f"{sf_dir}/embeddings.parquet").to_pylist()]
    assert got == sorted(hardneg.brute_force(rows))


def test_one_edit():
    assert variants.one_edit("abcdefg", "abcdefgh")
    assert variants.one_edit("abcdefg", "abxdefg")
    assert variants.one_edit("abcdefg", "bcdefg")
    assert not variants.one_edit("abcdefg", "abcdefg")
    assert not variants.one_edit("abcdefg", "gfedcba")
    assert not variants.one_edit("abcdefg", "abcdefghi")
    assert not variants.one_edit("abcdefg", "bacdefg")


def _variant_docs():
    rng = random.Random(5)
    base = ["relationship", "gouvernement", "ausführlich", "beginning", "Neighbour", "wonderful",
            "straße", "accommodate"]
    rows, i = [], 0
    for w in base:
        for _ in range(rng.randrange(20, 40)):
            rows.append((i, f"The {w} and {w.upper()} were here."))
            i += 1
        for k in range(3):  # variants, each a few times
            j = rng.randrange(len(w))
            v = w[:j] + w[j + 1:] if k == 0 else w[:j] + "x" + w[j:] if k == 1 else w[:j] + "q" + w[j + 1:]
            for _ in range(rng.randrange(1, 4)):
                rows.append((i, f"{v} -- {v}"))
                i += 1
    rows += [(i, None), (None, "relationship relationship"), (i + 1, ""), (i + 2, "relationship " * 30000)]
    rows += [rows[0], rows[0]]
    return rows


def test_variants_match_brute_force(spark, docs_of):
    rows = _variant_docs()
    got = sorted(map(tuple, variants.variants(docs_of(rows).withColumnRenamed("lang", "word")).collect()),
                 key=str)
    want = sorted(variants.brute_force(rows), key=str)
    assert got == want
    assert any(r[1] for r in got) and any(r[2] != r[0] for r in got)


def test_variants_tiles_split(spark, docs_of, monkeypatch):
    monkeypatch.setattr(variants, "TILE", 3)
    rows = _variant_docs()[:400]
    got = sorted(map(tuple, variants.variants(docs_of(rows)).collect()), key=str)
    assert got == sorted(variants.brute_force(rows), key=str)


def test_variants_empty(spark, docs_of):
    assert variants.variants(docs_of([])).count() == 0
    assert variants.variants(docs_of([(1, None), (2, "short")])).count() == 0


def _digests(texts):
    full, _ = pieces.processors()
    out = []
    for doc, text in texts:
        ids = full.encode(text or "")
        out.append((doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(full.decode(ids).encode()).hexdigest()))
    return out


def test_pieces_premise():
    assert not pieces.pieces_cross_markers()


def test_pieces_match_library(spark, docs_of):
    rng = random.Random(2)
    alphabet = [" ", "  ", "\t", "\n", "a", "bc", "▁", "é", "😀", "1", "2023", ".", "中文", "﻿", "x y"]
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 12)))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, " "), (303, "word " * 30000), (304, "a▁▁ b  "), rows[4]]
    df = docs_of(rows).withColumnRenamed("lang", "_row").withColumnRenamed("source", "chunk")
    got = sorted(map(tuple, pieces.report(df).collect()))
    assert got == sorted(_digests(rows))


def test_pieces_empty(spark, docs_of):
    assert pieces.report(docs_of([])).count() == 0


def test_pieces_small_groups(spark, docs_of, monkeypatch):
    """Groups of a few rows, each with its own chunk table, give the same ids as one."""
    monkeypatch.setattr(pieces, "GROUP", 3)
    rows = [(i, "the cat " * (i % 5) + f"word{i}") for i in range(60)]
    assert sorted(map(tuple, pieces.report(docs_of(rows)).collect())) == sorted(_digests(rows))


def test_pieces_query(spark, sf_dir, documents):
    got = sorted(map(tuple, queries.op13_sentencepiece(spark, sf_dir).collect()))
    assert got == sorted(_digests([(r.doc_id, r.text) for r in documents.collect()]))


def test_pieces_shuffle_nothing_and_keep_few_chunks(spark, docs_of, monkeypatch):
    """Groups encode their own chunks: no exchange; a full memory of chunks changes no result."""
    rows = [(i, " ".join(f"w{(i * j) % 97}é" for j in range(i % 40)) + " ▁ x" * (i % 3)) for i in range(300)]
    monkeypatch.setattr(pieces, "GROUP", 7)
    monkeypatch.setattr(pieces, "KNOWN", 5)
    out = pieces.report(docs_of(rows))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, out.collect())) == sorted(_digests(rows))

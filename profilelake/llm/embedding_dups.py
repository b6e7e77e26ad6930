"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

Vectors are turned by rotations that are learned so that the signs lose least (iterative
quantisation); the signs are the code. Of more than 64 dimensions, random parts of the whole
space are turned, each of 64 directions. A code is cut into
substrings of ``KEY_BITS`` bits, one table each. Vectors that share a substring in any table are
compared with their original components. Buckets are cut into blocks of bounded size, and pairs
of blocks are multiplied as matrices: no pair of vectors is ever a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilelake.llm.common import stored
from profilelake.llm.graph import components

COSINE = 0.9
#: So many that 0.9 of the pairs at ``COSINE`` itself meet, with some to spare.
TABLES = 40
KEY_BITS = 16
#: Vectors that the rotations are learned from at most: those with the least hash.
SAMPLE = 8192
STEPS = 40
#: Vectors of a bucket that are compared as one matrix, about.
BLOCK = 256


def rotations(sample: np.ndarray, bits: int, seed: int = 11) -> np.ndarray:
    """Projection ``(dim, bits)``; a rotation per ``min(dim, 64)`` bits.

    Directions are not centred: links are by cosine about the origin, and vectors in a narrow
    cone, told apart by their mean, would hardly share a substring. Of more than 64 dimensions
    the parts of one random basis after the other are taken, so that codes cover all of them.
    """
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    width = min(dim, 64)
    if dim == width:
        _, axes = np.linalg.eigh(sample.T @ sample)
        axes = axes[:, ::-1]
    parts, used = [], dim
    for _ in range(-(-bits // width)):
        if dim > width:
            if used + width > dim:
                basis, used = np.linalg.qr(rng.standard_normal((dim, dim)))[0], 0
            axes = basis[:, used: used + width]
            used += width
        low = sample @ axes
        turn = np.linalg.qr(rng.standard_normal((width, width)))[0]
        for _ in range(STEPS):
            signs = np.where(low @ turn >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(signs.T @ low)
            turn = right.T @ left.T
        parts.append(axes @ turn)
    return np.concatenate(parts, axis=1)[:, :bits]


def _directions(vectors: list[bytes], dtype: str) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that squares neither over- nor underflow."""
    x = np.stack([np.frombuffer(v, dtype) for v in vectors]).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _valid(dtype: str):
    """``(vec_id, vec)`` of the rows whose vectors can be compared, the components as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, kept = [], []
            for vec_id, values in zip(batch.column(0).to_pylist(), batch.column(1)):
                if values.is_valid and len(values) and values.values.null_count == 0:
                    x = np.asarray(values.values.to_numpy(zero_copy_only=False), dtype)
                    if np.isfinite(x).all() and x.any():
                        ids.append(vec_id)
                        kept.append((x + 0).tobytes())  # -0 is 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(kept, pa.binary())], names=["vec_id", "vec"])

    return run


def _keyed(projection: np.ndarray, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim = len(projection)
        for batch in batches:
            if not batch.num_rows:
                continue
            # vectors of another length are cut or filled up for the code alone
            raw = [np.frombuffer(v, dtype)[:dim].astype(np.float64) for v in batch.column("vec").to_pylist()]
            x = np.stack([np.pad(v, (0, dim - len(v))) for v in raw])
            x /= np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
            x /= np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)
            keys = np.packbits(x @ projection >= 0, axis=1).view(">u2").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(keys), pa.list_(pa.int32()))],
                names=[*batch.schema.names, "keys"])

    return run


_OUT = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("n", pa.int64())])


def _compare(least: float, dtype: str):
    """Counts of links ``(u, null, n)``, and edges ``(u, v, 0)`` that join what is linked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            table, a, b = row["table"], row["a"], row["b"] or []
            members = a + b
            side = np.repeat([0, 1], [len(a), len(b)])
            length = np.array([len(m["vec"]) for m in members])
            u, v, n = [], [], []
            for size in np.unique(length):
                at = np.flatnonzero(length == size)
                if len(at) < 2:
                    continue
                mine = [members[i] for i in at]
                x = _directions([m["vec"] for m in mine], dtype)
                ids = np.array([m["id"] for m in mine])
                copies = np.array([m["copies"] for m in mine])
                linked = x @ x.T >= least
                np.fill_diagonal(linked, False)
                if b:  # pairs within a block are compared where it meets itself
                    linked &= side[at][:, None] != side[at][None, :]
                i, j = np.nonzero(linked)
                if not len(i):
                    continue
                keys = np.array([m["keys"] for m in mine])[:, :table]
                # a pair counts in the first table in which it meets
                first = np.ones(len(i), bool)
                for t in range(table):
                    first &= keys[i, t] != keys[j, t]
                total = np.zeros(len(ids), np.int64)
                np.add.at(total, i[first], copies[j[first]])
                some = np.flatnonzero(total)
                u += ids[some].tolist()
                v += [None] * len(some)
                n += total[some].tolist()
                # least linked id, until nothing changes
                label, before = ids.copy(), None
                while before is None or (label != before).any():
                    before = label.copy()
                    np.minimum.at(label, i, before[j])
                joined = np.flatnonzero(label != ids)
                u += ids[joined].tolist()
                v += label[joined].tolist()
                n += [0] * len(joined)
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (u, v, n)], schema=_OUT)

    return run


def near_duplicates(vectors: DataFrame, least: float = COSINE, tables: int = TABLES,
                    sample: int = SAMPLE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``vectors (vec_id, embedding)``.

    Only pairs with a cosine of at least ``least``, in double precision, are links; every link
    reported is real, and of those near ``least`` some may not meet in any table. Vectors that
    are null, empty or zero or hold a null or a non-finite component link with nothing, nor do
    vectors of different length. Equal vectors collapse before the search and count in full.
    Rows of one vec_id are one node; rows without id have no links and stay. Other columns are
    ignored. An empty table gives no rows.

    The rotations are learned on the driver from at most ``sample`` vectors of the most common
    length; everything else covers all vectors.
    """
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    single = vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType())
    dtype = "<f4" if single else "<f8"
    rows = vectors.select(
        F.col("vec_id").cast("long"),
        F.col("embedding").cast("array<float>" if single else "array<double>"),
    )
    valid = stored(rows.mapInArrow(_valid(dtype), "vec_id long, vec binary"), "vectors")
    nodes = valid.where("vec_id is not null").groupBy("vec").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    common = nodes.groupBy(F.octet_length("vec").alias("size")).count().orderBy(
        F.desc("count"), "size").first()
    taken = [] if common is None else [r[0] for r in nodes.where(
        F.octet_length("vec") == common["size"]
    ).orderBy(F.xxhash64("vec"), "id").limit(sample).select("vec").collect()]
    basis = _directions(taken, dtype) if taken else np.eye(2)
    projection = rotations(basis, tables * KEY_BITS)

    keyed = stored(nodes.mapInArrow(
        _keyed(projection, dtype), "vec binary, id long, copies long, keys array<int>"), "codes")
    entries = keyed.select("id", F.posexplode("keys").alias("table", "key"))
    shared = entries.groupBy("table", "key").agg(F.count("*").alias("size")).where("size > 1")
    placed = entries.join(shared, ["table", "key"]).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.expr(f"(size + {BLOCK - 1}) div {BLOCK}")))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    units = stored(
        placed.join(keyed, "id").groupBy("table", "key", "block").agg(
            F.collect_list(F.struct("id", "copies", "vec", "keys")).alias("a")), "buckets")
    other = units.select("table", "key", F.col("block").alias("other"), F.col("a").alias("b"))
    members = "array<struct<id: bigint, copies: bigint, vec: binary, keys: array<int>>>"
    pairs = units.select("table", "a", F.lit(None).cast(members).alias("b")).unionByName(
        units.join(other, ["table", "key"]).where("block < other").select("table", "a", "b"))
    found = stored(pairs.mapInArrow(_compare(least, dtype), "u long, v long, n long"), "links")

    links = found.where("v is null").groupBy("u").agg(F.sum("n").alias("n"))
    roots = components(found.where("v is not null").select("u", "v"), "vector-links")
    per_node = keyed.select("vec", "id", "copies").join(links, F.col("id") == F.col("u"), "left").join(
        roots, F.col("id") == F.col("node"), "left").select(
        "vec", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "id").alias("component_id"))
    linked = valid.where("vec_id is not null").join(per_node, "vec").select(
        "vec_id", "n_links", "component_id")
    # rows that cannot be compared stand for themselves
    alone = rows.select("vec_id").groupBy("vec_id").agg(F.count("*").alias("n")).join(
        valid.groupBy(F.col("vec_id").alias("known")).agg(F.count("*").alias("m")),
        (F.col("vec_id") == F.col("known")), "left",
    ).withColumn("left", F.expr("n - coalesce(m, 0)")).where("left > 0").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
        F.explode(F.expr("sequence(1, cast(left as int))")).alias("_i")).drop("_i")
    return linked.unionByName(alone).withColumn("kept", F.expr("vec_id <=> component_id"))

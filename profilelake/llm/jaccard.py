"""Near copies by the Jaccard similarity of word shingles: banded MinHash, verified exactly.

Sets of shingles meet where they agree in one of ``BANDS`` bands of ``ROWS`` minima: 0.9996 of
the pairs with a similarity of 0.8 do. Those that meet are compared by their texts. In a bucket
all are first compared to its least and its greatest member; what these comparisons link needs
no more, so a large group of near copies costs few rows per member. What is left of a bucket
outside its largest linked part is then compared to all of the bucket, tile by tile inside the
tasks: no pair becomes a row, and only links that join two parts leave a tile.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilelake.llm.common import LOWER, byte_texts, stored
from profilelake.llm.graph import components

SIMILARITY = 0.8
SHINGLE = 5
BANDS, ROWS = 20, 5
_SEED = 77
_FACTORS = np.random.default_rng(_SEED).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * 2 + 1
#: Hashes that are multiplied at one time, and shingles of a tile that are counted at one time.
_BLOCK = 4096
#: Members of a bucket on each side of a tile, about.
TILE = 256


def shingles(text: bytes, width: int) -> list[bytes]:
    """Runs of ``width`` words, A-Z lower-cased; fewer words make one shingle, none make none."""
    words = text.translate(LOWER).split()
    n = len(words)
    joined = b" ".join(words)
    if n < width:
        return [joined] if n else []
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    return [
        joined[a:b]
        for a, b in zip(starts[: n - width + 1].tolist(), (ends[width - 1:] - 1).tolist())
    ]


def hashes(text: bytes) -> np.ndarray:
    """The set of shingles as sorted 64-bit hashes."""
    digest = xxhash.xxh64_digest
    return np.unique(np.frombuffer(b"".join([digest(s, _SEED) for s in shingles(text, SHINGLE)]), np.uint64))


def bands(text: bytes) -> tuple[int, list[int]]:
    """A name of the set of shingles, and a key per band, as signed 64-bit numbers."""
    found = hashes(text)
    least = np.full(len(_FACTORS), 2**64 - 1, np.uint64)
    for at in range(0, len(found), _BLOCK):
        np.minimum(least, (_FACTORS[:, None] * found[None, at: at + _BLOCK]).min(axis=1), out=least)
    keys = [xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(least.reshape(BANDS, ROWS))]
    both = np.array([xxhash.xxh64_intdigest(found.tobytes(), _SEED), *keys], np.uint64).view(np.int64)
    return int(both[0]), both[1:].tolist()


def _alike(least: float):
    """The pairs ``(u, v)`` of ``(u, v, left, right)`` whose texts share enough shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, one = None, set()
        for batch in batches:
            lefts, rights = byte_texts(batch.column("left")), byte_texts(batch.column("right"))
            kept = np.zeros(batch.num_rows, bool)
            for i, (a, b) in enumerate(zip(lefts, rights)):
                if b != last:
                    last, one = b, set(shingles(b, SHINGLE))
                other = set(shingles(a, SHINGLE))
                both = len(one & other)
                kept[i] = both >= least * (len(one) + len(other) - both)
            yield batch.select(["u", "v"]).filter(pa.array(kept))

    return run


def _places(sets: list[np.ndarray], among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the set and place in ``among`` of every hash found there, by place."""
    flat = np.concatenate(sets)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    at = np.minimum(np.searchsorted(among, flat), len(among) - 1)
    found = among[at] == flat
    rows, at = rows[found], at[found]
    order = np.argsort(at, kind="stable")
    return rows[order], at[order]


def common(lefts: list[np.ndarray], rights: list[np.ndarray]) -> np.ndarray:
    """How many hashes each of ``lefts`` shares with each of ``rights``."""
    out = np.zeros((len(lefts), len(rights)))
    among = np.intersect1d(np.concatenate(lefts), np.concatenate(rights))
    if not len(among):
        return out
    sides = [_places(sets, among) for sets in (lefts, rights)]
    for start in range(0, len(among), _BLOCK):
        width = min(_BLOCK, len(among) - start)
        blocks = []
        for (rows, at), count in zip(sides, out.shape):
            a, b = np.searchsorted(at, [start, start + width])
            block = np.zeros((count, width), np.float32)
            block[rows[a:b], at[a:b] - start] = 1
            blocks.append(block)
        out += blocks[0] @ blocks[1].T
    return out


def _tile(least: float):
    """Links between the rows of a tile marked ``part`` and its others, of different ``root``.

    Of links that join the same roots, over others too, one is enough.
    """
    def run(tile: pa.Table) -> pa.Table:
        ids, roots = tile["set_id"].to_numpy(), tile["root"].to_numpy()
        part = tile["part"].to_numpy().astype(bool)
        few, rest = np.flatnonzero(part), np.flatnonzero(~part)
        links: list[tuple[int, int]] = []
        if len(few) and len(rest):
            sets = [hashes(t) for t in byte_texts(tile["text"])]
            sizes = np.array([len(s) for s in sets])
            both = common([sets[i] for i in few], [sets[i] for i in rest])
            close = both >= least * (sizes[few][:, None] + sizes[rest] - both)
            up: dict[int, int] = {}

            def top(x: int) -> int:
                while x in up:
                    x = up[x]
                return x

            for i, j in np.argwhere(close & (roots[few][:, None] != roots[rest])):
                a, b = top(int(roots[few[i]])), top(int(roots[rest[j]]))
                if a != b:
                    up[max(a, b)] = min(a, b)
                    links.append((int(ids[few[i]]), int(ids[rest[j]])))
        return pa.table({"u": pa.array([u for u, _ in links], pa.int64()),
                         "v": pa.array([v for _, v in links], pa.int64())})

    return run


def _tiles(members: DataFrame) -> DataFrame:
    """Rows ``(key, i, j, part, set_id, root)``: what meets in the tiles of the buckets.

    ``members (key, set_id, root)`` are all entries of some buckets. The ``part`` of a bucket is
    what does not have its most frequent root; each of it meets each member in one tile. Buckets
    with one root have no part and make no rows.
    """
    roots = members.groupBy("key", "root").agg(F.count("*").alias("c"))
    whole = roots.groupBy("key").agg(
        F.max(F.struct("c", "root")).alias("most"), F.sum("c").alias("n")
    ).where("most.c < n").select(
        "key", F.col("most.root").alias("main"),
        F.expr(f"cast(ceil(n / {TILE}) as int)").alias("across"),
        F.expr(f"cast(ceil((n - most.c) / {TILE}) as int)").alias("down"),
    )
    placed = members.join(whole, "key").withColumns({
        "i": F.expr("cast(pmod(xxhash64(set_id, 1), down) as int)"),
        "j": F.expr("cast(pmod(xxhash64(set_id, 2), across) as int)"),
    })
    return placed.select("key", "set_id", "root", F.explode(F.expr(
        "concat(transform(sequence(0, down - 1), x -> struct(x as i, j as j, false as part)), "
        "if(root <> main, transform(sequence(0, across - 1), x -> struct(i as i, x as j, true as part)), array()))"
    )).alias("at")).select("key", "at.*", "set_id", "root")


def links(sets: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Pairs ``(u, v)`` that join what is linked by a similarity of at least ``least``.

    ``sets (set_id, keys)`` has a row per set of shingles, ``texts (set_id, text)`` its text.
    The pairs connect the sets as all links among those that meet would.
    """
    entries = sets.select("set_id", F.explode("keys").alias("key"))
    crowded = entries.groupBy("key").agg(
        F.count("*").alias("n"), F.min("set_id").alias("low"), F.max("set_id").alias("high")
    ).where("n > 1")
    entries = stored(entries.join(crowded, "key"), "bands")
    met = entries.select("set_id").distinct()
    # texts are never broadcast: small as files, they can be large in the driver's memory
    bodies = stored(texts.join(met, "set_id"), "band-texts").hint("merge")

    # the pair of both ends comes once
    pairs = stored(entries.select(
        F.col("set_id").alias("u"), "low", F.explode(F.array("low", "high")).alias("v")
    ).where("u <> v and (v = low or u <> low)").select("u", "v").distinct(), "band-pairs")
    both = pairs.join(
        bodies.select(F.col("set_id").alias("u"), F.col("text").alias("left")), "u"
    ).join(bodies.select(F.col("set_id").alias("v"), F.col("text").alias("right")), "v")
    found = stored(both.select("u", "v", "left", "right").mapInArrow(
        _alike(least), "u long, v long"), "alike")

    # up to three members have all met by now
    linked = components(found, "band-links")
    members = stored(entries.where("n > 3").join(linked, entries.set_id == linked.node, "left").select(
        "key", "set_id", F.coalesce("root", "set_id").alias("root")), "band-roots")
    tiles = stored(_tiles(members), "band-tiles").join(bodies, "set_id")
    rest = stored(
        tiles.groupBy("key", "i", "j").applyInArrow(_tile(least), "u long, v long"), "alike")
    return found.unionByName(rest)

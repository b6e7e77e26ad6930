"""Token ids in bit- or byte-plane blocks.

Texts are encoded in ascending doc_id order. The ids of a shard (one range of doc_id, in one
task) form one stream, cut into blocks of a fixed number of ids. A block is transposed into byte
planes (or bit planes), each compressed with zstandard on its own: the high planes of small ids
are nearly constant and all but vanish. The files are Parquet, so that executors can write them
to any store and a lost task leaves nothing behind:

``blocks``  shard, block, n_ids, plane_bytes (length of each compressed plane), payload (the
            planes in turn), first_doc (place in the shard of the first document), doc_ids and
            doc_lens (documents with ids in this block, and how many), opened and ends (whether
            the first began before this block, and the last ends in it)
``index``   shard, block, start (ids of all blocks before), n_ids, plane_bytes: where a range of
            ids is, without reading a payload
"""

from __future__ import annotations

import functools
import itertools
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from profilelake.llm.common import arrow_limits, stored

BLOCK = 1 << 16
END = 2
LEVEL = 3
TOKENIZER = "word_bpe_49k.json"
#: Words whose ids a task remembers at most, and separator between words encoded together.
_MEMORY = 700_000
_MARK = "\x01"
_TOGETHER = 64
#: Marks that end a word and are cut off it whatever comes before.
MARKS = (".", ",")


def _byte_characters() -> dict[int, str]:
    """The characters that byte-level vocabularies write for bytes: printable ones themselves,
    the others in turn from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


BYTE_CHARACTERS = _byte_characters()

BLOCKS = (
    "shard int, block int, n_ids int, plane_bytes array<int>, payload binary, first_doc long,"
    " doc_ids array<long>, doc_lens array<int>, opened boolean, ends boolean"
)
INDEX = "shard int, block int, start long, n_ids int, plane_bytes array<int>"
PIECES = "shard int, block int, doc long, doc_id long, at int, whole boolean, ids binary"
DIGESTS = PIECES.replace("ids binary", "n_tokens long, ids_crc32 long, ids binary")


class Encoder:
    """Ids of texts, as little-endian unsigned 32-bit integers.

    The tokenizer splits at white space before anything else, so the ids of a text are those of
    its words in turn; words seen before are looked up, new ones are encoded many at a time.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.words: dict[str, bytes] = {}
        mark = self._encode(_MARK)
        self.mark = mark[0] if len(mark) == 1 else None
        self.marks = {"": b""} | {
            m: np.array(self._encode(m), np.uint32).tobytes() for m in MARKS
        }
        # whether words may go to the model themselves, tried on some of all kinds
        tried = ["Word", "wordlike.", "ÉTÉ,", "größe", "ñandú."]
        self.plain = True
        self.plain = all(
            self._word(w) == np.array(self._encode(w), np.uint32).tobytes() for w in tried
        )

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _word(self, word: str) -> bytes | None:
        """Ids of a word of Latin-1 letters and at most one mark, straight from the model.

        Such a word is normal already but for its case, and the tokenizer cuts it before the mark.
        """
        stem = word.lower()
        mark = stem[-1:]
        if mark in MARKS:
            stem = stem[:-1]
        else:
            mark = ""
        if not stem.isalpha():
            return None
        shown = stem
        if not stem.isascii():
            if max(stem) > "\xff":
                return None
            shown = stem.encode().decode("latin-1").translate(BYTE_CHARACTERS)
        ids = self.words.get(stem) if mark or stem != word else None
        if ids is None:
            found = self.tokenize(shown)
            ids = self.words[stem] = array("I", [t.id for t in found]).tobytes()
        return ids + self.marks[mark] if mark else ids

    def _learn(self, new: list[str]) -> None:
        rest = []
        for word in new:
            ids = self._word(word) if self.plain else None
            if ids is None:
                rest.append(word)
            else:
                self.words[word] = ids
        for word in rest if self.mark is None else [w for w in rest if _MARK in w]:
            self.words[word] = np.array(self._encode(word), np.uint32).tobytes()
        rest = [w for w in rest if _MARK not in w] if self.mark is not None else []
        groups = [rest[i: i + _TOGETHER] for i in range(0, len(rest), _TOGETHER)]
        joined = self.tokenizer.encode_batch_fast(
            [f" {_MARK} ".join(g) for g in groups], add_special_tokens=False
        )
        for group, found in zip(groups, joined):
            ids = np.array(found.ids, np.uint32)
            cuts = np.flatnonzero(ids == self.mark)
            for word, a, b in zip(group, [0, *(cuts + 1)], [*cuts, len(ids)], strict=True):
                self.words[word] = ids[a:b].tobytes()

    @staticmethod
    @functools.lru_cache(1)
    def of(path: str) -> Encoder:
        """The encoder of this worker process; tasks that follow use its words again."""
        return Encoder(path)

    def __call__(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        if len(self.words) > _MEMORY:
            self.words.clear()
        if new := set(words).difference(self.words):
            self._learn(list(new))
        return b"".join(map(self.words.__getitem__, words))


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """Planes of unsigned 32-bit ids: plane k has byte k, or bit k, of every id."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [raw[:, k].tobytes() for k in range(4)]
    return [p.tobytes() for p in np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1)]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    rows = np.stack([np.frombuffer(p, np.uint8) for p in planes])
    if bits:
        rows = np.packbits(np.unpackbits(rows, axis=1, count=n), axis=0, bitorder="little")
    return np.ascontiguousarray(rows.T).view("<u4").ravel()


class _Writer:
    """Cuts the ids of one shard into blocks."""

    def __init__(self, shard: int, block: int, bits: bool) -> None:
        self.shard, self.size, self.bits = shard, block, bits
        self.compress = zstandard.ZstdCompressor(level=LEVEL).compress
        self.number = self.first = self.filled = 0
        self.opened = False
        self.parts: list[np.ndarray] = []
        self.docs: list[tuple[int | None, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[dict]:
        left = np.append(np.frombuffer(ids, "<u4"), np.uint32(END))
        while len(left):
            part, left = np.split(left, [self.size - self.filled])
            self.parts.append(part)
            self.docs.append((doc_id, len(part)))
            self.filled += len(part)
            if self.filled == self.size:
                yield self.close(ends=not len(left))

    def close(self, ends: bool = True) -> dict:
        planes = [self.compress(p) for p in to_planes(np.concatenate(self.parts), self.bits)]
        out = {
            "shard": self.shard, "block": self.number, "n_ids": self.filled,
            "plane_bytes": [len(p) for p in planes], "payload": b"".join(planes),
            "first_doc": self.first, "doc_ids": [d for d, _ in self.docs],
            "doc_lens": [n for _, n in self.docs], "opened": self.opened, "ends": ends,
        }
        self.opened = not ends
        self.first += len(self.docs) - (not ends)
        self.number, self.filled, self.parts, self.docs = self.number + 1, 0, [], []
        return out


_BLOCK_ROW = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int32()),
    ("plane_bytes", pa.list_(pa.int32())), ("payload", pa.binary()), ("first_doc", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_lens", pa.list_(pa.int32())), ("opened", pa.bool_()),
    ("ends", pa.bool_()),
])


def _encode(tokenizer: str, block: int, bits: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        writer = _Writer(TaskContext.get().partitionId(), block, bits)

        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    yield from writer.add(doc_id, encoder(text or ""))
            if writer.filled:
                yield writer.close()

        for row in rows():
            yield pa.RecordBatch.from_pylist([row], schema=_BLOCK_ROW)

    return run


def write(docs: DataFrame, path: str, tokenizer: str | None = None, block: int = BLOCK,
          bits: bool = False) -> None:
    """Encode ``docs (doc_id, text)`` and write ``path/blocks`` and ``path/index``.

    Each document ends with the id 2; null and empty texts have that alone. Documents come in
    ascending order of doc_id, nulls first, equal ids by a hash of their texts. Other columns
    are ignored. An empty table gives empty files. ``tokenizer``: a file of the tokenizers
    library, by default the public word-level vocabulary of 49,408 ids.
    """
    spark = docs.sparkSession
    arrow_limits(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64(F.coalesce("text", F.lit("")))]
    (
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(_encode(tokenizer or public_tokenizers.path(TOKENIZER), block, bits), BLOCKS)
        .write.parquet(f"{path}/blocks")
    )
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = shards.select(
        "shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("before")
    )
    inside = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_ids")
    blocks.join(before, "shard").select(
        "shard", "block", (F.col("before") + inside).alias("start"), "n_ids", "plane_bytes"
    ).write.parquet(f"{path}/index")


def _decode(bits: bool, digest: bool = False):
    """Pieces of the blocks; with ``digest`` a piece has the number and the crc32 of its ids, and
    the ids themselves only where it is not the whole document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for row in (r for batch in batches for r in batch.to_pylist()):
            cuts = np.cumsum([0, *row["plane_bytes"]])
            planes = [expand(row["payload"][a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
            raw = memoryview(from_planes(planes, row["n_ids"], bits).tobytes())
            at = np.cumsum([0, *row["doc_lens"]])
            n = len(row["doc_lens"])
            whole = np.ones(n, bool)
            whole[0] &= not row["opened"]
            whole[-1] &= row["ends"]
            ids = [raw[a:b] for a, b in itertools.pairwise((4 * at).tolist())]
            columns = {
                "shard": pa.array([row["shard"]] * n, pa.int32()),
                "block": pa.array([row["block"]] * n, pa.int32()),
                "doc": pa.array(range(row["first_doc"], row["first_doc"] + n), pa.int64()),
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "at": pa.array(at[:-1], pa.int32()),
                "whole": pa.array(whole),
            }
            if digest:
                columns |= {
                    "n_tokens": pa.array(np.diff(at), pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                }
                ids = [None if w else x for w, x in zip(whole.tolist(), ids)]
            columns["ids"] = pa.array([x if x is None else bytes(x) for x in ids], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks")


def pieces(spark: SparkSession, path: str, bits: bool = False) -> DataFrame:
    """What each block has of each of its documents: where it begins (``at``), and its ids."""
    return _blocks(spark, path).mapInArrow(_decode(bits), PIECES)


@F.pandas_udf(T.BinaryType())
def _joined(parts: pd.Series) -> pd.Series:
    return parts.map(b"".join)


def _whole(parts: DataFrame) -> DataFrame:
    """Documents from all their pieces: shard, block and at of the first, doc_id, ids."""
    first = F.min(F.struct("block", "at")).alias("first")
    ordered = F.sort_array(F.collect_list(F.struct("block", "ids")))
    return parts.groupBy("shard", "doc").agg(
        first, F.first("doc_id").alias("doc_id"), ordered.alias("p")
    ).select("shard", "first.block", "first.at", "doc_id", _joined("p.ids").alias("ids"))


def _started(docs: DataFrame, path: str) -> DataFrame:
    """``docs (shard, block, at)`` with ``start``, from the index of the files."""
    index = docs.sparkSession.read.schema(INDEX).parquet(f"{path}/index")
    return docs.join(index.select("shard", "block", F.col("start").alias("_s")), ["shard", "block"]
                     ).withColumn("start", F.col("_s") + F.col("at")).drop("_s")


def read(spark: SparkSession, path: str, bits: bool = False) -> DataFrame:
    """The documents of the files: doc_id, start (ids of all before), ids (as bytes)."""
    return _started(_whole(pieces(spark, path, bits)), path).select("doc_id", "start", "ids")


def report(spark: SparkSession, path: str, bits: bool = False) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32.

    Documents within one block are digested where the block is decoded; only the ids of those
    that cross an edge are moved.
    """
    found = stored(_blocks(spark, path).mapInArrow(_decode(bits, digest=True), DIGESTS), "bitplane-pieces")
    crossing = _whole(found.where("not whole").select("shard", "block", "doc", "doc_id", "at", "ids"))
    names = ["shard", "block", "at", "doc_id", "n_tokens", "ids_crc32"]
    all_docs = found.where("whole").select(*names).unionByName(crossing.select(
        "shard", "block", "at", "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    ))
    return _started(all_docs, path).select("doc_id", "start", "n_tokens", "ids_crc32")

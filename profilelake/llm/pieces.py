"""SentencePiece encoding and decoding through a table of distinct chunks.

The model's normaliser is the identity with a leading marker: a non-empty text becomes ``"▁" +
text`` with every space turned into ``"▁"`` (U+2581). No piece of the model holds a marker after
any other character, so no piece crosses the point before a marker that follows another
character. The normalised text is cut there, in Spark, into chunks (a run of markers and the
characters up to the next marker); each distinct chunk of a group of rows is encoded once, by a
processor of the same model that adds no marker of its own, and the ids go back to every
occurrence by position.
The ids of a document are its chunks' ids in order; the library's ``decode`` turns them back into
text.

``pieces_cross_markers`` checks the premise on the model; ``encoded`` refuses a model where it does
not hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilelake.llm.common import arrow_limits

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Consecutive rows of a scan partition that form one group and share one chunk table.
GROUP = 1024
#: Chunks a task keeps from earlier groups, and the length up to which it does.
KNOWN, KNOWN_LENGTH = 100_000, 24


def _path(model: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(model)


@lru_cache(maxsize=4)
def processors(model: str = MODEL):
    """``(full, plain)``: the model as it is, and the same without its leading marker."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    with open(_path(model), "rb") as f:
        data = f.read()
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(data)
    proto.normalizer_spec.add_dummy_prefix = False
    full = sentencepiece.SentencePieceProcessor(model_proto=data)
    plain = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    return full, plain


def pieces_cross_markers(model: str = MODEL) -> bool:
    """True if some piece holds a marker after another character, or the normaliser is not the
    identity: then chunks are not independent and this operator does not apply."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(_path(model), "rb") as f:
        proto.ParseFromString(f.read())
    spec = proto.normalizer_spec
    if spec.name != "identity" or spec.remove_extra_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
        return True
    return any(MARK in p.piece.lstrip(MARK) for p in proto.pieces)


def normalized(text) -> F.Column:
    """The model's normalisation in Spark: null and empty give the empty text."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t == "", F.lit("")).otherwise(F.concat(F.lit(MARK), F.translate(t, " ", MARK)))


def _flat(chunks: pa.Array, known: dict, plain) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a group's chunks in a row, and how many each chunk has.

    The chunks are dictionary-encoded (Arrow); each distinct one is encoded once and its ids are
    gathered by position with NumPy. ``known`` holds short chunks of earlier groups, at most
    ``KNOWN``.
    """
    if not len(chunks):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    table = chunks.dictionary_encode()
    distinct = table.dictionary.to_pylist()
    lists = [known.get(c) for c in distinct]
    new = [i for i, ids in enumerate(lists) if ids is None]
    for i, ids in zip(new, plain.encode([distinct[i] for i in new], num_threads=1) if new else []):
        lists[i] = ids
        if len(known) < KNOWN and len(distinct[i]) <= KNOWN_LENGTH:
            known[distinct[i]] = ids
    widths = np.fromiter(map(len, lists), np.int64, len(lists))
    all_ids = np.fromiter(chain.from_iterable(lists), np.int32, int(widths.sum()))
    offsets = np.cumsum(widths) - widths
    row = table.indices.to_numpy(zero_copy_only=False)
    lengths = widths[row]
    firsts = np.cumsum(lengths) - lengths
    return all_ids[np.repeat(offsets[row] - firsts, lengths) + np.arange(int(lengths.sum()))], lengths


def _groups(model: str):
    """Batches of ``doc_id, chunks``, each a group of its own, to ``doc_id, ids, decoded``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full, plain = processors(model)
        known: dict[str, list[int]] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                docs = batch.slice(at, GROUP)
                chunks = docs.column("chunks")
                flat, lengths = _flat(chunks.flatten(), known, plain)
                per_doc = chunks.value_lengths().to_numpy(zero_copy_only=False)
                ends = np.concatenate(([0], np.cumsum(lengths)))
                bounds = ends[np.concatenate(([0], np.cumsum(per_doc)))].astype(np.int32)
                texts = full.decode([flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])])
                yield pa.RecordBatch.from_arrays(
                    [docs.column("doc_id"), pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)),
                     pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])
    return run


def encoded(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, ids, decoded``: each document row's ids, as the library encodes its whole text,
    and the library's decoding of them.

    Spark normalises and cuts the texts. Documents are grouped where they are read: a group is
    at most ``GROUP`` consecutive rows of one scan partition, less where an Arrow batch is full
    by bytes, and has a table of its distinct chunks, each encoded once. A table of all chunks
    would have to reach every group by a shuffle of the (group, chunk) pairs and of the
    documents, five times the input; a group's own table needs none, and a frequent chunk
    loads no task. Null and empty texts give no ids. Repeated rows are encoded each. Only
    ``doc_id`` and ``text`` are read.
    """
    if pieces_cross_markers(model):
        raise ValueError(f"{model}: pieces cross markers; chunks cannot be encoded apart")
    arrow_limits(documents.sparkSession)
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.split(normalized(F.col("text")), f"(?<=[^{MARK}])(?={MARK})").alias("c"),
    ).select("doc_id", F.filter("c", lambda x: F.length(x) > 0).alias("chunks"))
    return docs.mapInArrow(_groups(model), "doc_id long, ids array<int>, decoded string")


def report(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per document row.

    ``ids_sha256`` digests the decimal ids joined by commas (the empty text for no ids),
    ``decoded_sha256`` the decoded text in UTF-8. One row per input row, repeated rows included.
    """
    return encoded(documents, model).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.transform("ids", lambda i: i.cast("string")), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )

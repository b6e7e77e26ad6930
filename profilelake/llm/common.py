"""Helpers that the corpus operators share."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profilelake.session import work_dir

#: Byte table that lower-cases A-Z and keeps all other bytes, those of UTF-8 sequences too.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: As LOWER, and every ASCII byte that is no letter or digit becomes a space.
ALNUM = bytes(
    LOWER[b] if b >= 128 or bytes([b]).isalnum() else 32 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_limits(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, so that long texts do not pile up in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below the shared working folder and read it back.

    Cuts the lineage: later steps read the written files, which survive lost executors.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/profilelake/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of an Arrow text column; null is the empty text."""
    if isinstance(column.type, pa.DataType) and not pa.types.is_binary(column.type):
        column = column.cast(pa.binary())
    return [t or b"" for t in column.to_pylist()]


def fold(column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % parts

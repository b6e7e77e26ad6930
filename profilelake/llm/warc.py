"""Content-addressed WARC archive.

``payloads``  key (SHA-256 of the bytes), sha1 (base 32), length, payload: each content once
``records``   header (the exact bytes of the record's head, up to and with the empty line), key,
              and record_id, which orders and names the records

A record is its header, the payload of its key, and two line ends; reading joins the two tables
and takes every field from the header bytes. Payloads are named by a strong digest that is
computed again when they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DATE = "2000-01-01T00:00:00Z"
PAYLOADS = "key string, sha1 string, length long, payload binary"
RECORDS = "record_id string, header binary, key string"


def base32_sha1(data: Column) -> Column:
    """SHA-1 in upper-case base 32: 40 hexadecimal digits are four groups of 8 characters."""
    digest = F.sha1(data)
    groups = [
        F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)
    ]
    return F.translate(F.upper(F.concat(*groups)), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value),
                    F.lit("\r\n"))


def write(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Archive ``pages (page_id, url, html)``: one record each, each payload once.

    A null html or url is empty. Of records with equal payloads of at least ``min_bytes`` the
    one with the largest page_id is a response, the others revisit it; null ids come before all
    others. Repeated rows make a record each, and one of them is the response; equal ids with
    different urls go by url. Other columns are ignored; an empty table gives an empty archive.

    Only digests are grouped: a payload that a third of all pages share costs one narrow row per
    task, and its bytes move once.
    """
    rows = pages.select(
        F.col("page_id").cast("long"),
        # line ends in a url would break the header
        F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), r"[\r\n]", " ")
        .alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    digested = rows.select("page_id", "url", F.sha2("payload", 256).alias("key"),
                           base32_sha1(F.col("payload")).alias("sha1"),
                           F.octet_length("payload").cast("long").alias("length"))
    records = digested.groupBy("page_id", "url", "key", "sha1", "length").agg(
        F.count("*").alias("copies")
    ).withColumn("page", F.struct("page_id", "url"))
    first = records.groupBy("key").agg(F.max("page").alias("first"))
    lone = F.col("length") < min_bytes
    numbered = (
        records.join(first, "key")
        .withColumn("copy", F.explode(F.expr("sequence(1, cast(copies as int))")))
        .withColumn("response", lone | (F.col("page").eqNullSafe(F.col("first"))
                                        & (F.col("copy") == 1)))
    )
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    record_id = F.concat(F.lit("<urn:page:"), page, F.lit(":"), F.xxhash64("url").cast("string"),
                         F.lit(":"), F.substring("key", 1, 16), F.lit(":"), F.col("copy"),
                         F.lit(">"))
    target = F.coalesce(F.col("first.page_id").cast("string"), F.lit("null"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(F.col("response"), "response").otherwise("revisit")),
        _line("WARC-Record-ID", record_id),
        _line("WARC-Date", DATE),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Page-ID", page),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(F.col("response"), "").otherwise(F.concat(
            _line("WARC-Refers-To-Page-ID", target),
            _line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        )),
        _line("Content-Length", F.col("length").cast("string")),
        F.lit("\r\n"),
    )
    numbered.select(
        record_id.alias("record_id"), header.cast("binary").alias("header"), "key"
    ).write.parquet(f"{path}/records")

    # the payload of each key is taken from the page that answers for it; copies of that row fall
    # away where the join has put them
    none = F.lit(-(2**63))
    holders = first.select(F.coalesce("first.page_id", none).alias("page"), "first.url", "key")
    same = ["page", "url", "key"]
    (
        rows.select(F.coalesce("page_id", none).alias("page"), "url",
                    F.sha2("payload", 256).alias("key"), "payload")
        .join(holders, same).dropDuplicates(same)
        .select("key", base32_sha1(F.col("payload")).alias("sha1"),
                F.octet_length("payload").cast("long").alias("length"), "payload")
        .write.parquet(f"{path}/payloads")
    )


def _tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return (spark.read.schema(RECORDS).parquet(f"{path}/records"),
            spark.read.schema(PAYLOADS).parquet(f"{path}/payloads"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(record_id, record)``: the bytes of every record as they stand in a WARC file.

    Revisit records carry the payload they refer to, so that each can be read alone.
    """
    records, payloads = _tables(spark, path)
    return records.join(payloads, "key").select(
        "record_id", F.concat("header", "payload", F.lit("\r\n\r\n").cast("binary")).alias("record")
    )


def _field(name: str) -> Column:
    return F.regexp_extract(F.col("header").cast("string"), f"\r\n{name}: ([^\r\n]*)", 1)


def verify(spark: SparkSession, path: str) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Fields come from the header; bytes and digest from the stored payload, whose key and SHA-1
    are computed again. A payload that does not answer to its key, or a header that does not
    answer to its payload, fails the read.
    """
    records, payloads = _tables(spark, path)
    checked = payloads.select(
        "key", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        F.assert_true(F.sha2("payload", 256) == F.col("key"), "payload does not match its key")
        .alias("ok"),
    ).where("ok is null")
    number = lambda name: F.nullif(_field(name), F.lit("null"))
    return records.join(checked, "key").select(
        number("WARC-Page-ID").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        _field("WARC-Type").alias("record_type"),
        F.when(_field("WARC-Type") == "revisit", number("WARC-Refers-To-Page-ID").cast("long"))
        .alias("refers_to"),
        F.assert_true(
            (_field("Content-Length").cast("long") == F.col("payload_bytes"))
            & (_field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), "payload_digest")),
            "header does not match its payload").alias("ok"),
    ).where("ok is null").drop("ok")

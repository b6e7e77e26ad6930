"""Stored tables: numbered Parquet snapshots, keyed merges and physical layout.

A write never touches the snapshot it reads: it makes the next one, and a snapshot counts
once Spark has marked it complete. A snapshot may hold only the partitions that changed and
name the folders of earlier snapshots where the others still lie. Lost executors cost retried tasks only, and a failed
run leaves the last complete snapshot in place.
"""

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilelake.functions.geo import square
from profilelake.session import fresh_path, writing

#: Codec of the stored files; wide rows take some third less of it than of Spark's default.
CODEC = "zstd"
#: Values per row group that a Bloom filter is made for.
BLOOM_VALUES = 20_000
#: Hash buckets of the platform inside each year: a late row rewrites its bucket, not its year.
BUCKETS = 16
#: Keys that rows share are sent to every task if they are no more than this, and than this part
#: of all keys; otherwise all rows meet in a shuffle.
SHARED_KEYS, SHARED_PART = 500_000, 0.1
#: The platform with which a profile id starts (ids are ``platform_cycle[D][_BGC]``).
ID_PLATFORM = r"^(.*)_[0-9]+D?(_BGC)?$"
#: Partition columns of the profile tables, outer first.
PROFILE_PARTITIONS = ["year", "bucket"]


def bucket_of(platform: Column) -> Column:
    """The bucket of a platform number; a null platform counts as the empty text."""
    return F.pmod(F.xxhash64(F.coalesce(platform.cast("string"), F.lit(""))), F.lit(BUCKETS)).cast("int")


def platform_bucket(platform: str | None) -> int:
    """``bucket_of`` on the driver, for literals in look-ups: Spark's xxhash64 is XXH64, seed 42."""
    import xxhash

    h = xxhash.xxh64_intdigest((platform or "").encode("utf-8"), seed=42)
    return (h - (1 << 64) if h >= 1 << 63 else h) % BUCKETS


def id_platform(profile_id: str) -> str:
    """The platform an id starts with, as ``id_bucket`` reads it."""
    import re

    m = re.match(ID_PLATFORM, profile_id)
    return m.group(1) if m else ""


def id_bucket(profile_id: Column) -> Column:
    """The bucket of the platform an id starts with; an id of another form counts as empty."""
    return bucket_of(F.regexp_extract(profile_id, ID_PLATFORM, 1))


def _names(spark: SparkSession, pattern: str, up: int = 0) -> list[str]:
    """Names of the paths that match, or of their parents."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.globStatus(path) or []]
    return [(p.getParent() if up else p).getName() for p in found]


def complete_folders(spark: SparkSession, root: str, name: str) -> list[int]:
    """Numbers of the folders ``name=<number>`` that Spark has marked complete, in order."""
    return sorted(int(n.split("=")[1]) for n in _names(spark, f"{root}/{name}=*/_SUCCESS", up=1))


def _complete_snapshots(spark: SparkSession, root: str) -> list[int]:
    return complete_folders(spark, root, "snapshot")


def table_exists(spark: SparkSession, root: str) -> bool:
    return bool(_complete_snapshots(spark, root))


def _note_file(spark: SparkSession, root: str, kind: str, number: int):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/_{kind}-{number}.json")
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _read_note(spark: SparkSession, root: str, kind: str, number: int):
    """A small JSON note beside a snapshot, None if there is none."""
    path, fs = _note_file(spark, root, kind, number)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(text)


def _write_note(spark: SparkSession, root: str, kind: str, number: int, content) -> None:
    path, fs = _note_file(spark, root, kind, number)
    stream = fs.create(path, True)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()


def _snapshot(spark: SparkSession, root: str, number: int) -> DataFrame:
    """A snapshot by its declared schema, so that one without rows, hence without files, reads too."""
    schema = _read_note(spark, root, "schema", number)
    kept = _read_note(spark, root, "kept", number)
    reader = spark.read
    if schema is not None:
        schema = T.StructType.fromJson(schema)
        reader = reader.schema(schema)
    if not kept:
        return reader.parquet(f"{root}/snapshot={number}")
    rows = reader.option("basePath", root).parquet(
        f"{root}/snapshot={number}", *(f"{root}/{folder}" for folder in kept)
    )
    return rows.select(*schema.names)


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """The newest complete snapshot."""
    snapshots = _complete_snapshots(spark, root)
    if not snapshots:
        raise FileNotFoundError(f"no table at {root}")
    return _snapshot(spark, root, snapshots[-1])


def write_table(
    df: DataFrame, root: str, partition_by: str | list[str] | None = None, kept: list[str] = (),
    bloom: str | None = None, writers: int = 0,
) -> DataFrame:
    """Write ``df`` as the next snapshot and return it as read back, with the partition
    folders ``kept`` of earlier snapshots.

    ``bloom``: a column whose equality filters skip row groups by a Bloom filter. ``writers``:
    partitions that a task writes side by side, for rows without an order.
    """
    spark = df.sparkSession
    snapshots = _complete_snapshots(spark, root)
    number = snapshots[-1] + 1 if snapshots else 1
    _write_note(spark, root, "schema", number, df.schema.jsonValue())
    _write_note(spark, root, "kept", number, list(kept))
    writer = df.write.mode("overwrite").option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{bloom}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{bloom}", str(BLOOM_VALUES))
    with writing(spark, writers):
        writer.parquet(f"{root}/snapshot={number}")
    return _snapshot(spark, root, number)


def _folder(columns: list[str], values: tuple) -> str:
    return "/".join(
        f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(columns, values))


def _partition_folders(spark: SparkSession, root: str, number: int, columns: list[str]) -> list[str]:
    """``snapshot=<number>/<c1>=<v1>/...`` for every partition a snapshot wrote itself."""
    pattern = "/".join(f"{c}=*" for c in columns)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/snapshot={number}/{pattern}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for status in fs.globStatus(path) or []:
        p, parts = status.getPath(), []
        for _ in columns:
            parts.append(p.getName())
            p = p.getParent()
        out.append("/".join([f"snapshot={number}", *reversed(parts)]))
    return out


def replace_partitions(
    df: DataFrame, root: str, column: str | list[str], values: list, bloom: str | None = None,
    writers: int = 0,
) -> DataFrame:
    """Write ``df`` as all rows of the partitions ``values``; the others stay where they lie.

    ``column`` names the partition columns, outer first; ``values`` holds one value, or one
    tuple of values, per partition. The note of kept folders has one entry per partition.
    """
    spark = df.sparkSession
    columns = [column] if isinstance(column, str) else list(column)
    number = _complete_snapshots(spark, root)[-1]
    folders = _partition_folders(spark, root, number, columns)
    folders += _read_note(spark, root, "kept", number) or []
    replaced = {_folder(columns, v if isinstance(v, tuple) else (v,)) for v in values}
    untouched = [f for f in folders if f.split("/", 1)[1] not in replaced]
    return write_table(df, root, columns, untouched, bloom, writers)


def profile_layout(profiles: DataFrame) -> DataFrame:
    """Rows placed for storage: by year and platform bucket, sorted by ten-degree square, float
    and cycle.

    The rebalance lets adaptive execution split big partitions and merge small ones by size.
    Inside a file a box of latitude and longitude skips row groups by their minimum and maximum,
    a float, which stays in few squares, by the dictionary, and a profile id by its Bloom filter.
    A float's profiles share a bucket, so look-ups by float or id read one bucket per year.
    """
    return (
        profiles.withColumn("year", F.year("timestamp"))
        .withColumn("bucket", id_bucket(F.col("profile_id")))
        .hint("rebalance", "year", "bucket")
        .sortWithinPartitions(
            "year", "bucket", F.expr(square("latitude", "longitude")), "platform_number",
            "cycle_number",
        )
    )


def latest_rows(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """The last row of each key by ``order``.

    Spark keeps one row per key in every task before the shuffle, so any number of copies
    of a key stays cheap.
    """
    newest = Window.partitionBy(*key).orderBy(*(F.desc(c) for c in order))
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def fold_shared(df: DataFrame, key: list[str], fold: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``fold`` for wide rows of which few share a key; it must leave alone a row whose key no
    other row has, up to columns it drops.

    A first job counts the keys by their hash and reads no other columns. Rows without a partner
    then pass by without a shuffle or a sort, only the others are folded. Two keys of one hash
    are folded as well, which does no harm. If many keys are shared, ``fold`` gets all rows.
    """
    spark = df.sparkSession
    hashed = df.withColumn("_key", F.xxhash64(*key))
    path = fresh_path(spark, "shared-keys")
    # null stands for all keys of one row; a hash is never null
    counts = hashed.groupBy("_key").agg(F.count("*").alias("n")).selectExpr(
        "if(n > 1, _key, null) as _key"
    ).groupBy("_key").agg(F.count("*").alias("keys"))
    with writing(spark):
        counts.write.parquet(path)
    counted = spark.read.schema("_key long, keys long").parquet(path)
    shared = counted.select("_key").where("_key is not null")
    found, keys = counted.agg(F.count("_key"), F.coalesce(F.sum("keys"), F.lit(0))).first()
    if found > min(SHARED_KEYS, SHARED_PART * keys):
        return fold(df)
    if not found:
        return df.select(*fold(df).columns)
    few = F.broadcast(shared)
    folded = fold(hashed.join(few, "_key", "left_semi").drop("_key"))
    return hashed.join(few, "_key", "left_anti").select(*folded.columns).unionByName(folded)


def merge_rows(
    old: DataFrame, new: DataFrame, key: list[str], optional: list[str] = (),
    derived: dict[str, str] | None = None,
) -> DataFrame:
    """Field-wise upsert of ``new`` into ``old``; both hold a key at most once.

    A matched row takes every new field, nulls included. ``optional`` fields, which a
    source may lack, keep the stored value when the new one is null. The result has the
    columns of both sides: a column the batch lacks keeps its stored values, one the table
    lacks is null for the rows stored before. ``derived`` names columns made from another
    one: if the batch lacks such a column, its stored value goes where that other one changed.
    """
    stored = [c for c in old.columns if c not in key]
    added = [c for c in new.columns if c not in key and c not in stored]
    given = [c for c in new.columns if c not in key]
    joined = old.select(*key, F.struct(*stored).alias("_old")).join(
        new.select(*key, F.struct(*given).alias("_new")), key, "full_outer"
    )
    matched = F.col("_new").isNotNull()

    def merged(c: str) -> Column:
        if c in added:
            return F.col(f"_new.{c}")
        if c not in given:
            source = (derived or {}).get(c)
            if source is None:
                return F.col(f"_old.{c}")
            same = F.col(f"_new.{source}").eqNullSafe(F.col(f"_old.{source}"))
            return F.when(~matched | same, F.col(f"_old.{c}"))
        if c in optional:
            return F.coalesce(f"_new.{c}", f"_old.{c}")
        return F.when(matched, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}"))

    return joined.select(*key, *(merged(c).alias(c) for c in stored + added)).select(
        *old.columns, *added
    )


def few_rows(df: DataFrame) -> bool:
    """Whether a narrow table may go to every task; counts no more rows than it takes to tell."""
    return df.limit(SHARED_KEYS + 1).count() <= SHARED_KEYS


def fill_optional(new: DataFrame, old: DataFrame, key: str, optional: list[str]) -> DataFrame:
    """``new`` with the ``optional`` fields it lacks taken from the row of ``old`` by the same key.

    Of ``old`` only these fields are read, of the rows that have any. ``new`` is shuffled by the
    key if those are many, and not again if it already lies so.
    """
    given = [c for c in optional if c in new.columns and c in old.columns]
    if not given:
        return new
    stored = old.select(key, *(F.col(c).alias(f"_old_{c}") for c in given)).where(
        " or ".join(f"_old_{c} is not null" for c in given)
    )
    joined = new.join(F.broadcast(stored) if few_rows(stored) else stored, key, "left")
    return joined.select(
        *(F.coalesce(c, f"_old_{c}").alias(c) if c in given else F.col(c) for c in new.columns)
    )


def rows_without(old: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Wide rows of ``old`` whose key is not among ``keys``; both hold a key at most once.

    The keys are compared first. The wide rows are shuffled only if many stay and many go.
    """
    path = fresh_path(old.sparkSession, "stored-keys")
    compared = old.select(key).join(keys.select(key).withColumn("_given", F.lit(True)), key, "left")
    with writing(old.sparkSession):
        compared.write.parquet(path)
    compared = old.sparkSession.read.schema(compared.schema).parquet(path)
    kept, gone = (compared.where(t).select(F.col(key).alias("_key")) for t in ("_given is null", "_given"))
    if few_rows(kept):
        return old.join(F.broadcast(kept), F.col(key).eqNullSafe(F.col("_key")), "left_semi")
    if few_rows(gone):
        gone = F.broadcast(gone)
    return old.join(gone, F.col(key) == F.col("_key"), "left_anti")


def replace_rows(
    old: DataFrame, new: DataFrame, key: str, optional: list[str] = (), keys: DataFrame | None = None
) -> DataFrame:
    """``merge_rows`` for wide tables of which ``new`` has all columns, ``optional`` ones maybe null.

    Rows of ``old`` that ``new`` replaces are left out unread, up to their optional fields.
    ``keys`` are those of ``new``, if they are cheaper read elsewhere.
    """
    rest = rows_without(old, new if keys is None else keys, key)
    return rest.unionByName(fill_optional(new, old, key, optional), allowMissingColumns=True)

"""Batch ingest: bronze rows into the profile tables, the float table and the quarantine."""

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilelake.operators import rollup
from profilelake.operators.normalize import (
    ROW_ERROR,
    normalize,
    quarantine,
    with_source,
)
from profilelake.schema import BRONZE, OPTIONAL_COLUMNS
from profilelake.session import writing
from profilelake.sources import tables


PROFILE_TABLES = ["profiles", "bgc_profiles"]
#: The table of a profile.
TABLE_NAME = "if(file_type = 'synthetic_bgc', 'bgc_profiles', 'profiles')"


@dataclass(frozen=True)
class Store:
    """Where the tables of one lake live."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        return tables.read_table(self.spark, self.path(table))

    def exists(self, table: str) -> bool:
        return tables.table_exists(self.spark, self.path(table))


def one_per_id(profiles: DataFrame) -> DataFrame:
    """One row per profile id of a batch: core files win over BGC files, later names over earlier."""
    order = ["_core", "source_file", "profile_index"]
    ranked = profiles.withColumn("_core", F.col("file_type") == "core")
    return tables.fold_shared(
        ranked, ["profile_id"], lambda rows: tables.latest_rows(rows, ["profile_id"], order)
    ).drop("_core")


def collisions(profiles: DataFrame) -> DataFrame:
    """Number of ids that a batch holds more than once, and of the rows set aside for them."""
    counts = profiles.groupBy("profile_id").count().where("count > 1")
    return counts.agg(
        F.count("*").alias("colliding_ids"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("rows_dropped"),
    )


def upsert_profiles(store: Store, table: str, profiles: DataFrame) -> DataFrame:
    """Merge a batch into a profile table; running it twice changes nothing.

    A row without an id gets the plain one of its platform and cycle.
    """
    unnamed = "concat(coalesce(platform_number, 'UNK'), '_', format_string('%03d', coalesce(cycle_number, 0)))"
    named = profiles.withColumn("profile_id", F.expr(f"coalesce(profile_id, {unnamed})"))
    batch = one_per_id(named)
    if store.exists(table):
        # stored first, since its ids and its rows are read apart; where many rows share an id,
        # they lie by it already and meet the stored optional fields without another shuffle
        batch = tables.fill_optional(batch, store.read(table), "profile_id", OPTIONAL_COLUMNS)
        folder = f"{store.path('staged')}/{table}-{uuid.uuid4().hex}"
        with writing(store.spark):
            batch.write.option("compression", tables.CODEC).parquet(folder)
        batch = store.spark.read.schema(batch.schema).parquet(folder)
        return merge_profiles(store, table, batch, filled=True)
    return merge_profiles(store, table, batch)


def merge_profiles(
    store: Store, table: str, batch: DataFrame, sources: DataFrame | None = None,
    filled: bool = False,
) -> DataFrame:
    """Merge rows, one per id, into a profile table; the cost follows the partitions they touch.

    A profile table is partitioned by year and by the bucket of the platform an id starts with.
    Only the (year, bucket) partitions of the new rows and of the stored rows they replace are
    read in full and written: a batch of one float rewrites one bucket in each year it touches.
    Of the other partitions the ids are read. ``sources`` are stored rows that ``batch`` is
    derived from, if it is not itself stored; a ``filled`` batch has its optional fields. A table stored before buckets existed is
    rewritten whole once.
    """
    path = store.path(table)
    layout = tables.PROFILE_PARTITIONS
    if not store.exists(table):
        return tables.write_table(tables.profile_layout(batch), path, layout, bloom="profile_id")
    old = store.read(table)
    if "bucket" not in old.columns:
        merged = tables.merge_rows(old.drop("year"), batch, ["profile_id"], OPTIONAL_COLUMNS)
        return tables.write_table(tables.profile_layout(merged), path, layout, bloom="profile_id")
    new = (batch if sources is None else sources).select(
        "profile_id", F.year("timestamp").alias("year"),
        tables.id_bucket(F.col("profile_id")).alias("bucket"),
    )
    replaced = old.select("profile_id", *layout).join(new.select("profile_id"), "profile_id", "left_semi")
    # at most years x BUCKETS pairs, whatever the batch's size
    parts = [(r.year, r.bucket) for r in new.select(*layout).union(replaced.select(*layout)).distinct().collect()]
    if not parts:
        return old
    touched = F.lit(False)
    for year, bucket in parts:
        same_year = F.col("year").isNull() if year is None else F.col("year") == year
        touched = touched | (same_year & (F.col("bucket") == bucket))
    rows = old.where(touched).drop(*layout)
    if set(rows.columns) <= set(batch.columns):
        optional = [] if filled else OPTIONAL_COLUMNS
        merged = tables.replace_rows(rows, batch, "profile_id", optional, new)
    else:
        merged = tables.merge_rows(rows, batch, ["profile_id"], OPTIONAL_COLUMNS)
    return tables.replace_partitions(
        tables.profile_layout(merged), path, layout, parts, bloom="profile_id"
    )


def write_floats(store: Store, floats: DataFrame) -> DataFrame:
    """Merge float rows by platform."""
    if store.exists("floats"):
        floats = tables.merge_rows(
            store.read("floats"), floats, ["platform_number"], ["bgc_cycles"]
        )
    return tables.write_table(floats, store.path("floats"))


def merge_floats(store: Store, changed: DataFrame) -> DataFrame:
    """Roll up anew the floats that ``changed`` (platform_number) names and merge them."""
    core, bgc = (store.read(t) for t in PROFILE_TABLES)
    if store.exists("floats"):
        names = changed.select("platform_number").distinct()
        core, bgc = (t.join(names, "platform_number", "left_semi") for t in (core, bgc))
    return write_floats(store, rollup.build_floats(core, bgc))


def stage(store: Store, bronze: DataFrame, folder: str, run: str) -> None:
    """Clean a delivery and store it: profiles, one per id, by table, and the rejected rows.

    Ids of the two tables differ by their suffix, so the id alone is the key. The rejected
    rows of every run stay; a run that is repeated overwrites its own.
    """
    profiles = one_per_id(normalize(bronze)).withColumn("table_name", F.expr(TABLE_NAME))
    with writing(profiles.sparkSession, writers=len(PROFILE_TABLES)):
        profiles.write.mode("overwrite").option("compression", tables.CODEC).partitionBy(
            "table_name").parquet(folder)
    write_rejected(store, bronze, run)


def write_rejected(store: Store, bronze: DataFrame, run: str) -> None:
    """Store the rejected rows of a run; a run that is repeated overwrites its own."""
    with writing(bronze.sparkSession):
        quarantine(bronze).write.mode("overwrite").parquet(f"{store.path('quarantine')}/run={run}")


def read_staged(store: Store, base: str, *folders: str) -> DataFrame:
    """Profiles that ``stage`` stored, by their declared schema, with the folder columns."""
    spark = store.spark
    schema = normalize(spark.createDataFrame([], BRONZE)).schema.add("table_name", "string")
    return spark.read.schema(schema).option("basePath", base).parquet(*folders)


def ingest(store: Store, bronze: DataFrame) -> str:
    """Run every stage of a batch; returns the name of the run, for ``run_report``.

    The landing rows are cleaned once, into a folder of the run, and merged from there. While
    there are no tables yet, they are cleaned into these, and the folder names their ids.
    """
    run = uuid.uuid4().hex
    folder = f"{store.path('staged')}/{run}"
    if any(store.exists(table) for table in PROFILE_TABLES):
        stage(store, bronze, folder, run)
        staged = read_staged(store, folder, folder)
        for table in PROFILE_TABLES:
            merge_profiles(store, table, staged.where(F.col("table_name") == table).drop("table_name"))
    else:
        profiles = normalize(bronze)
        for table in PROFILE_TABLES:
            merge_profiles(store, table, one_per_id(profiles.where(F.expr(TABLE_NAME) == table)))
            store.read(table).select("profile_id", "platform_number").write.parquet(
                f"{folder}/table_name={table}")
        write_rejected(store, bronze, run)
        staged = read_staged(store, folder, folder)
    merge_floats(store, staged)
    return run


def run_report(store: Store, run: str) -> DataFrame:
    """What a batch run wrote, rejected and left: (measure, rows)."""
    folder = f"{store.path('staged')}/{run}"
    staged = read_staged(store, folder, folder).agg(
        *(F.count_if(F.col("table_name") == t).alias(f"written_{t}") for t in PROFILE_TABLES)
    )
    rejected = rejected_rows(store, run).agg(
        F.count("*").alias("rejected_rows"),
        F.count_distinct(F.when(F.col("file_failed"), F.col("source_file"))).alias("failed_files"),
    )
    counts = table_counts(store).selectExpr("concat('stored_', table_name) as measure", "rows")
    for measures in (staged, rejected):
        pairs = ", ".join(f"'{c}', {c}" for c in measures.columns)
        counts = counts.unionByName(
            measures.selectExpr(f"stack({len(measures.columns)}, {pairs}) as (measure, rows)")
        )
    return counts


def rejected_rows(store: Store, run: str | None = None) -> DataFrame:
    """The quarantine: rejected rows of one run, or of all with the ``run`` they are from."""
    path = store.path("quarantine")
    schema = quarantine(store.spark.createDataFrame([], BRONZE)).schema
    rows = store.spark.read.schema(schema.add("run", "string")).option("basePath", path)
    return rows.parquet(path if run is None else f"{path}/run={run}")


def ingest_summary(bronze: DataFrame, elapsed_seconds: float | None = None) -> DataFrame:
    """Files discovered, processed and failed, profiles per table; with a time also files/s."""
    rows = with_source(bronze).selectExpr(
        "source_file",
        "parse_error is not null as failed",
        f"({ROW_ERROR}) is null and file_type <> 'synthetic_bgc' as core",
        f"({ROW_ERROR}) is null and file_type = 'synthetic_bgc' as bgc",
    )
    files = rows.groupBy("source_file").agg(
        F.bool_or("failed").alias("failed"),
        F.count_if("core").alias("core"),
        F.count_if("bgc").alias("bgc"),
    )
    summary = files.agg(
        F.count("*").alias("files_discovered"),
        F.count_if(~F.col("failed")).alias("files_processed"),
        F.count_if("failed").alias("files_errored"),
        F.coalesce(F.sum("core"), F.lit(0)).alias("core_profiles"),
        F.coalesce(F.sum("bgc"), F.lit(0)).alias("bgc_profiles"),
    )
    if elapsed_seconds is None:
        return summary
    return summary.withColumns({
        "elapsed_seconds": F.lit(float(elapsed_seconds)),
        "files_per_second": F.try_divide("files_processed", F.lit(float(elapsed_seconds))),
    })


def first_errors(bronze: DataFrame, n: int = 10) -> DataFrame:
    """The first failed files with their messages."""
    return (
        quarantine(bronze)
        .where("file_failed")
        .select("source_file", "error")
        .orderBy("source_file", "error")
        .limit(n)
    )


def table_counts(store: Store) -> DataFrame:
    """Rows per stored table."""
    names = ("profiles", "bgc_profiles", "floats")
    parts = [
        store.read(t).agg(F.count("*").alias("rows")).select(F.lit(t).alias("table_name"), "rows")
        for t in names
        if store.exists(t)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

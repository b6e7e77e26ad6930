"""The landing zone: ``<root>/<float>/profiles/`` folders of raw-profile files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilelake.schema import BRONZE


def scan_raw(
    spark: SparkSession, root: str, pattern: str = "*/profiles", fmt: str = "parquet"
) -> DataFrame:
    """Bronze rows of every file below ``root``; a missing root fails.

    Folders that do not match ``pattern`` are skipped. Spark lists the folders on the
    cluster when there are many. ``source_file`` falls back to the file's own name.
    """
    rows = spark.read.format(fmt).schema(BRONZE).load(f"{root.rstrip('/')}/{pattern}")
    return rows.select(
        F.coalesce("source_file", "_metadata.file_name").alias("source_file"),
        *(c for c in BRONZE.names if c != "source_file"),
        F.col("_metadata.file_path").alias("landing_path"),
    )


def limit_input(bronze: DataFrame, n: int, path: str | None = None) -> DataFrame:
    """Rows of the first ``n`` files in path order: float folder, then file.

    Rows that were not read by ``scan_raw`` have no path and go by file name.
    """
    path = path or ("landing_path" if "landing_path" in bronze.columns else "source_file")
    first = bronze.select(path).distinct().orderBy(path).limit(n)
    return bronze.join(first, path, "left_semi")

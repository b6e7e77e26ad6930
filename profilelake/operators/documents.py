"""Search documents: summary text and metadata per profile and float."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilelake.functions import text as tx
from profilelake.schema import COLLECTIONS

SUMMARY_FIELDS = [
    "profile_id", "platform_number", "cycle_number", "direction", "latitude", "longitude",
    "timestamp", "max_pres", "n_levels", "data_mode", "station_parameters", "contains_bgc",
    "bgc_parameters", "project_name", "pi_name", "file_type", "profile_pres_qc",
    "profile_temp_qc", "profile_psal_qc",
]


def scan_projected(profiles: DataFrame, limit: int | None = None) -> DataFrame:
    """The fields a summary needs; the scan reads no others."""
    fields = profiles.select(*SUMMARY_FIELDS)
    return fields if limit is None else fields.orderBy("profile_id").limit(limit)


def profile_documents(
    profiles: DataFrame, collection: str = "profiles", limit: int | None = None
) -> DataFrame:
    """One document per profile."""
    return scan_projected(profiles, limit).selectExpr(
        f"'{collection}' as collection",
        "profile_id as id",
        f"{tx.profile_summary()} as document",
        f"{tx.profile_metadata()} as metadata",
    )


def float_documents(floats: DataFrame, limit: int | None = None) -> DataFrame:
    """One document per float."""
    rows = floats if limit is None else floats.orderBy("platform_number").limit(limit)
    return rows.selectExpr(
        "'floats' as collection",
        "platform_number as id",
        f"{tx.float_summary()} as document",
        f"{tx.float_metadata()} as metadata",
    )


def build_documents(
    profiles: DataFrame,
    bgc: DataFrame,
    floats: DataFrame,
    collection: str = "all",
    limit: int | None = None,
) -> DataFrame:
    """Documents of one collection or of all three; ``limit`` holds per collection."""
    if collection not in ("all", *COLLECTIONS):
        raise ValueError(f"unknown collection {collection!r}")
    parts = {
        "profiles": lambda: profile_documents(profiles, "profiles", limit),
        "bgc_profiles": lambda: profile_documents(bgc, "bgc_profiles", limit),
        "floats": lambda: float_documents(floats, limit),
    }
    chosen = COLLECTIONS if collection == "all" else [collection]
    return reduce(DataFrame.unionByName, (parts[c]() for c in chosen))


def split_errors(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with text, and the rows for which none could be built."""
    return documents.where(F.col("document").isNotNull()), documents.where("document is null")

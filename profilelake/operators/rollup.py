"""Per-float rollups of the profile tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST_FIELDS = ["project_name", "pi_name", "platform_type", "wmo_inst_type", "data_centre"]


def _box() -> list[Column]:
    return [
        F.min("timestamp").alias("first_date"),
        F.max("timestamp").alias("last_date"),
        F.min("latitude").alias("min_lat"),
        F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"),
        F.max("longitude").alias("max_lon"),
    ]


def float_core_rollup(profiles: DataFrame) -> DataFrame:
    """One row per platform: descriptive fields of its first profile id, counts, extremes."""
    return profiles.groupBy("platform_number").agg(
        F.min_by(F.struct(*FIRST_FIELDS), "profile_id").alias("_first"),
        F.count("*").alias("total_cycles"),
        *_box(),
        F.array_sort(F.collect_set("data_mode")).alias("data_modes_used"),
    ).select("platform_number", "_first.*", "total_cycles", "first_date", "last_date",
             "min_lat", "max_lat", "min_lon", "max_lon", "data_modes_used")


def float_bgc_rollup(bgc: DataFrame, union: bool = False) -> DataFrame:
    """One row per platform of the BGC table.

    The parameter list is that of the first profile id; ``union`` gives every parameter
    the float ever measured.
    """
    if union:
        params = F.array_sort(F.array_distinct(F.flatten(F.collect_set("bgc_parameters"))))
    else:
        params = F.min_by("bgc_parameters", "profile_id")
    return bgc.groupBy("platform_number").agg(
        F.count("*").alias("bgc_cycles"), params.alias("bgc_parameters"), *_box()
    )


def build_floats(profiles: DataFrame, bgc: DataFrame, union: bool = False) -> DataFrame:
    """The float table: both rollups merged by platform.

    A float with core profiles keeps their dates and cycle count; its box covers both
    tables. Both sides are already spread by platform and unique, so the join adds no
    shuffle of its own.
    """
    core = float_core_rollup(profiles).alias("c")
    both = core.join(float_bgc_rollup(bgc, union).alias("b"), "platform_number", "full_outer")
    names = F.array().cast("array<string>")

    def widest(pick, field: str) -> Column:
        return pick(F.col(f"c.{field}"), F.col(f"b.{field}")).alias(field)

    in_core = F.col("c.total_cycles").isNotNull()
    in_bgc = F.col("b.bgc_cycles").isNotNull()
    return both.select(
        "platform_number",
        *(F.col(f"c.{f}").alias(f) for f in FIRST_FIELDS),
        F.coalesce("c.total_cycles", "b.bgc_cycles").alias("total_cycles"),
        in_bgc.alias("has_bgc"),
        F.coalesce("b.bgc_parameters", names).alias("bgc_parameters"),
        F.col("b.bgc_cycles").alias("bgc_cycles"),
        F.when(in_core, F.col("c.first_date")).otherwise(F.col("b.first_date")).alias("first_date"),
        F.when(in_core, F.col("c.last_date")).otherwise(F.col("b.last_date")).alias("last_date"),
        F.struct(
            widest(F.least, "min_lat"),
            widest(F.greatest, "max_lat"),
            widest(F.least, "min_lon"),
            widest(F.greatest, "max_lon"),
        ).alias("geo_bounding_box"),
        F.coalesce("c.data_modes_used", names).alias("data_modes_used"),
    )

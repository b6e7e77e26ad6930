"""Aggregate statistics and counts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilelake.functions.dates import dated
from profilelake.schema import COLLECTIONS, QUERY_BGC_PARAMS, require_param


def _statistics(parameter: str, avg, low, high, count, profiles) -> list[Column]:
    return [
        F.lit(parameter).alias("parameter"),
        F.round(avg, 4).alias("avg"),
        F.round(low, 4).alias("min"),
        F.round(high, 4).alias("max"),
        count.alias("count"),
        profiles.alias("num_profiles"),
    ]


def aggregate_statistics(
    profiles: DataFrame,
    bgc: DataFrame,
    min_depth: float,
    max_depth: float,
    parameter: str = "temp",
    start_date: str | None = None,
    end_date: str | None = None,
) -> DataFrame:
    """Mean, extremes, measurement and profile counts of a parameter in a depth range.

    A BGC parameter reads the BGC table. Each profile is summed where it lies, inside its
    own array, so counting profiles needs no shuffle of profile ids: all that moves is
    one partial row per task. The scan reads two fields of the levels. Without any
    measurement there is no row.
    """
    key = require_param(parameter)
    table = bgc if key in QUERY_BGC_PARAMS else profiles
    fields = ", ".join(f"measurements.{p}" for p in dict.fromkeys(["pres", key]))
    inside = F.expr(
        f"transform(filter(arrays_zip({fields}), m -> m.pres between {float(min_depth)!r}D "
        f"and {float(max_depth)!r}D and m.{key} is not null), m -> m.{key})"
    )
    per_profile = (
        dated(table, start_date, end_date)
        .select(inside.alias("v"))
        .selectExpr(
            "size(v) as n",
            "aggregate(v, 0D, (s, x) -> s + x) as total",
            "array_min(v) as low",
            "array_max(v) as high",
        )
    )
    return per_profile.agg(
        *_statistics(
            key,
            F.try_divide(F.sum("total"), F.sum("n")),
            F.min("low"),
            F.max("high"),
            F.coalesce(F.sum("n"), F.lit(0)),
            F.count_if(F.col("n") > 0),
        )
    ).where("count > 0")


def level_statistics(
    levels: DataFrame,
    min_depth: float,
    max_depth: float,
    parameter: str = "temp",
    start_date: str | None = None,
    end_date: str | None = None,
) -> DataFrame:
    """``aggregate_statistics`` over flat levels: the depth range reaches the scan.

    Profiles are counted by first reducing to one partial row per profile, which Spark
    does in each task before the shuffle.
    """
    key = require_param(parameter)
    per_profile = (
        dated(levels, start_date, end_date)
        .where(F.col("pres").between(min_depth, max_depth) & F.col(key).isNotNull())
        .groupBy("profile_id")
        .agg(
            F.sum(key).alias("total"),
            F.min(key).alias("low"),
            F.max(key).alias("high"),
            F.count("*").alias("n"),
        )
    )
    return per_profile.agg(
        *_statistics(
            key,
            F.try_divide(F.sum("total"), F.sum("n")),
            F.min("low"),
            F.max("high"),
            F.coalesce(F.sum("n"), F.lit(0)),
            F.count("*"),
        )
    ).where("count > 0")


def dataset_metadata(profiles: DataFrame, bgc: DataFrame, floats: DataFrame) -> DataFrame:
    """Table sizes and time coverage in one row, from one pass over narrow columns."""
    none = F.lit(None).cast("timestamp_ntz")
    tagged = (
        profiles.select(F.lit("core").alias("kind"), "timestamp")
        .unionByName(bgc.select(F.lit("bgc").alias("kind"), "timestamp"))
        .unionByName(
            floats.select(
                F.when(F.col("has_bgc"), "bgc_float").otherwise("float").alias("kind"),
                none.alias("timestamp"),
            )
        )
    )
    return tagged.agg(
        F.count_if(F.col("kind").isin("float", "bgc_float")).alias("floats"),
        F.count_if(F.col("kind") == "bgc_float").alias("bgc_floats"),
        F.count_if(F.col("kind") == "core").alias("profiles"),
        F.count_if(F.col("kind") == "bgc").alias("bgc_profiles"),
        F.min("timestamp").alias("first_date"),
        F.max("timestamp").alias("last_date"),
    )


def collection_stats(documents: DataFrame) -> DataFrame:
    """Documents per collection; empty collections show 0."""
    names = F.explode(F.array(*map(F.lit, COLLECTIONS))).alias("collection")
    # one count column per fixed name, then back to rows: nothing but one row is shuffled
    counts = documents.agg(
        *(F.count_if(F.col("collection") == c).alias(c) for c in COLLECTIONS)
    )
    picked = F.coalesce(*(F.when(F.col("collection") == c, F.col(c)) for c in COLLECTIONS))
    return counts.select("*", names).select("collection", picked.alias("documents"))


def embed_run_summary(documents: DataFrame, elapsed_seconds: float | None = None) -> DataFrame:
    """Documents built and failed; with a time also the rate."""
    failed = F.col("document").isNull()
    summary = documents.agg(
        F.count_if(~failed).alias("processed"),
        F.count_if(failed).alias("errors"),
        *(
            F.count_if(~failed & (F.col("collection") == c)).alias(f"{c}_count")
            for c in COLLECTIONS
        ),
    )
    if elapsed_seconds is None:
        return summary
    return summary.withColumns({
        "elapsed_seconds": F.lit(float(elapsed_seconds)),
        "documents_per_second": F.try_divide("processed", F.lit(float(elapsed_seconds))),
    })

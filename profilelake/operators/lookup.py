"""Look-ups by float and by profile id."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from profilelake.functions.cleaning import iso_date
from profilelake.functions.dates import dated
from profilelake.schema import MAX_LEVELS_SHOWN, require_param
from profilelake.sources.tables import id_platform, latest_rows, platform_bucket

# ids of a list up to this long are also written into the scan's filter
LITERAL_IDS = 1_000

# what a profile's data is shown with
PROFILE_FACTS = [
    "platform_number", "cycle_number", "timestamp", "latitude", "longitude",
    "station_parameters", "data_mode", "max_pres",
]


def float_info(floats: DataFrame, platform_number: str | None = None) -> DataFrame:
    """The facts of one float, or of all."""
    rows = floats if platform_number is None else floats.where(
        F.col("platform_number") == platform_number
    )
    return rows.selectExpr(
        "platform_number",
        "platform_type",
        "project_name",
        "pi_name",
        "data_centre",
        "total_cycles",
        "has_bgc",
        "bgc_parameters",
        f"{iso_date('first_date')} as first_date",
        f"{iso_date('last_date')} as last_date",
        "geo_bounding_box",
        "data_modes_used",
    )


def float_profiles(
    profiles: DataFrame,
    bgc: DataFrame,
    platform_number: str | None = None,
    limit: int = 20,
    start_date: str | None = None,
    end_date: str | None = None,
) -> DataFrame:
    """The first profiles of a float by cycle, ``limit`` per table, or of every float.

    The totals count all of the float's profiles, whatever the dates. Each task keeps
    ``limit`` rows per float before the shuffle, so a float with very many profiles does
    not end up in one task.
    """
    both = tagged(profiles, bgc)
    if platform_number is not None:
        both = both.where(F.col("platform_number") == platform_number)
        if "bucket" in both.columns:  # the float's bucket: one folder per year is read
            both = both.where(F.col("bucket") == platform_bucket(platform_number))
    totals = both.groupBy("platform_number").agg(
        F.count_if(F.col("source") == "core").alias("total_core"),
        F.count_if(F.col("source") == "bgc").alias("total_bgc"),
    )
    order = Window.partitionBy("platform_number", "source").orderBy("cycle_number", "profile_id")
    first = (
        dated(both, start_date, end_date)
        .select(
            "source", "platform_number", "profile_id", "cycle_number", "timestamp", "latitude",
            "longitude", "n_levels", "station_parameters", "data_mode",
        )
        .withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= limit)
    )
    return first.join(totals, "platform_number")


def tagged(profiles: DataFrame, bgc: DataFrame) -> DataFrame:
    return profiles.withColumn("source", F.lit("core")).unionByName(
        bgc.withColumn("source", F.lit("bgc")), allowMissingColumns=True
    )


def explode_levels(
    profiles: DataFrame, keep: list[str], fields: list[str], max_levels: int | None = None
) -> DataFrame:
    """One row (``keep`` columns, level, m) per stored level, reading only ``fields`` of it.

    Exploding the zipped fields, not the level structs, prunes the scan to them. The outer
    form with the filter after it keeps Spark from testing the arrays a second time first.
    """
    levels = f"arrays_zip({', '.join(f'measurements.{f}' for f in dict.fromkeys(fields))})"
    if max_levels is not None:
        levels = f"slice({levels}, 1, {max_levels})"
    return profiles.selectExpr(*keep, f"posexplode_outer({levels}) as (level, m)").where(
        "m is not null"
    )


def requests(spark: SparkSession, ids: list[str] | DataFrame) -> DataFrame:
    """Wanted ids as (requested_id, position): places in the list, or the ``position`` column
    of a DataFrame of ids, null where it has none."""
    if isinstance(ids, DataFrame):
        position = "position" if "position" in ids.columns else "null"
        return ids.selectExpr("profile_id as requested_id", f"cast({position} as bigint) as position")
    return spark.createDataFrame(
        [(pid, i) for i, pid in enumerate(ids)], "requested_id string, position bigint"
    )


def _among(profiles: DataFrame, ids: list[str] | DataFrame, suffixed: bool = False) -> DataFrame:
    """Rows that a short list of ids can mean, tested in the scan.

    Stored files are sorted by platform, with which an id starts, so most are skipped.
    """
    if isinstance(ids, DataFrame) or len(ids) > LITERAL_IDS:
        return profiles
    names = {pid for pid in ids if pid is not None}
    if suffixed:
        names |= {f"{pid}_BGC" for pid in names}
    rows = profiles.where(F.col("profile_id").isin(sorted(names)))
    if "bucket" in profiles.columns:  # only the buckets of the ids' platforms are read
        rows = rows.where(F.col("bucket").isin(sorted({platform_bucket(id_platform(p)) for p in names})))
    return rows


def lookup_profiles(
    profiles: DataFrame, bgc: DataFrame, ids: list[str] | DataFrame, columns: list[str]
) -> DataFrame:
    """The profile behind each id: the core table's, else the BGC table's by the same id,
    else the BGC table's by the id with its suffix. Unknown ids give no row.

    Ids are made distinct and joined the way Spark sees fit, which broadcasts few of them;
    a short list also reaches the scan.
    """
    spark = profiles.sparkSession
    wanted = requests(spark, ids)
    distinct = wanted.select("requested_id").distinct()
    keys = distinct.selectExpr(
        "requested_id",
        "inline(if(requested_id like '%\\_BGC', array(struct(requested_id as profile_id, 2 as pref)), "
        "array(struct(requested_id as profile_id, 2 as pref), "
        "struct(concat(requested_id, '_BGC') as profile_id, 1 as pref))))",
    )
    core_keys = distinct.selectExpr("requested_id", "requested_id as profile_id", "3 as pref")
    core, suffixed = _among(profiles, ids), _among(bgc, ids, suffixed=True)
    fields = ["profile_id", *(c for c in columns if c != "profile_id")]
    found = (
        core.select(*fields)
        .join(core_keys, "profile_id")
        .withColumn("source", F.lit("core"))
        .unionByName(
            suffixed.select(*fields).join(keys, "profile_id").withColumn("source", F.lit("bgc"))
        )
    )
    best = latest_rows(found, ["requested_id"], ["pref"]).drop("pref")
    return wanted.join(best, "requested_id")


def _values(parameters: list[str], use_adjusted: bool) -> tuple[list[str], list[str]]:
    """Level fields to read for the parameters, and the output expressions over one level."""
    fields, outputs = ["pres"], ["m.pres as depth_m"]
    for p in dict.fromkeys(parameters):
        if p == "pres":
            continue
        value, flag = f"m.{p}", f"{p}_qc"
        if use_adjusted:
            fields.append(f"{p}_adjusted")
            value = f"if(array_contains(available_vars, '{p}_adjusted'), m.{p}_adjusted, m.{p})"
            flag = f"{p}_adjusted_qc"
        fields += [p, flag]
        outputs += [f"{value} as {p}", f"m.{flag} as {p}_qc"]
    return fields, outputs


def profile_data(
    profiles: DataFrame,
    bgc: DataFrame,
    ids: list[str] | DataFrame,
    parameters: list[str] | str = "temp,psal",
    use_adjusted: bool = False,
    max_levels: int = MAX_LEVELS_SHOWN,
) -> DataFrame:
    """The first levels of each wanted profile: depth, values and quality flags, beside the
    profile's place, date, station parameters, data mode and greatest depth.

    The adjusted value falls back to the raw one only where the profile has no adjusted
    variable at all. Levels without pressure are kept.
    """
    names = parameters.split(",") if isinstance(parameters, str) else parameters
    fields, outputs = _values([require_param(p) for p in names], use_adjusted)
    found = lookup_profiles(
        profiles, bgc, ids,
        [*PROFILE_FACTS, "n_levels", "available_vars", "measurements"],
    )
    facts = ["requested_id", "profile_id", *PROFILE_FACTS]
    shown = ["n_levels as total_levels", f"least({max_levels}, n_levels) as showing_levels"]
    levels = explode_levels(found, [*facts, *shown, "available_vars"], fields, max_levels)
    return levels.selectExpr(*facts, "total_levels", "showing_levels", "level", *outputs)

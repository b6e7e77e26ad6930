"""The data series behind each chart, and the chart specifications."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilelake.functions.cleaning import iso_date
from profilelake.operators.lookup import tagged, explode_levels, lookup_profiles
from profilelake.schema import LEVEL, require_param

# Fixed values below: labels, summary sentences and the names in a specification.
LABEL = "concat(coalesce(platform_number, '?'), '@c', coalesce(cast(cycle_number as string), '?'))"


def trajectory(profiles: DataFrame, platform_number: str | None = None) -> DataFrame:
    """Positions of a float in cycle order, its first and last drawn one marked.

    Without a platform the trajectories of all floats. The ends come from an aggregate per
    float joined back, not from sorting each float in one task.
    """
    points = profiles.where("latitude is not null and longitude is not null")
    if platform_number is not None:
        points = points.where(F.col("platform_number") == platform_number)
    # a null cycle sorts first, as in an ascending sort
    points = points.selectExpr(
        "platform_number", "profile_id", "cycle_number", "latitude as lat", "longitude as lon",
        f"{iso_date('timestamp')} as date",
        "struct(coalesce(cycle_number, -2147483648) as c, profile_id as p) as _at",
    )
    ends = points.groupBy("platform_number").agg(
        F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.count("*").alias("total_points")
    )
    return points.join(ends, "platform_number").select(
        "platform_number", "profile_id", "cycle_number", "lat", "lon", "date", "total_points",
        (F.col("_at") == F.col("_first")).alias("is_start"),
        (F.col("_at") == F.col("_last")).alias("is_end"),
    )


def _found(
    profiles: DataFrame, bgc: DataFrame, ids: list[str] | DataFrame | None, columns: list[str]
) -> DataFrame:
    """Wanted profiles, or with no ids every profile of both tables."""
    if ids is not None:
        return lookup_profiles(profiles, bgc, ids, columns)
    every = tagged(
        profiles.select("profile_id", *columns), bgc.select("profile_id", *columns)
    )
    return every.withColumns({
        "requested_id": F.col("profile_id"), "position": F.lit(None).cast("int")
    })


def level_fields(parameters: list[str] | str) -> list[str]:
    """Lower-cased names of level fields; ValueError for one that no level has."""
    names = parameters.split(",") if isinstance(parameters, str) else parameters
    fields = list(dict.fromkeys(p.strip().lower() for p in names))
    for field in fields:
        if field not in LEVEL.names or field == "others":
            raise ValueError(f"levels have no field {field!r}")
    return fields


def _levels(
    profiles: DataFrame,
    bgc: DataFrame,
    ids: list[str] | DataFrame | None,
    parameters: list[str],
) -> DataFrame:
    """Levels with a pressure, reading only the arrays of the parameters."""
    found = _found(profiles, bgc, ids, ["platform_number", "cycle_number", "measurements"])
    keep = ["requested_id", "position", "profile_id", f"{LABEL} as label"]
    return explode_levels(found, keep, ["pres", *parameters]).where("m.pres is not null")


def depth_series(
    profiles: DataFrame,
    bgc: DataFrame,
    ids: list[str] | DataFrame | None,
    parameters: list[str] | str = "temp",
) -> DataFrame:
    """(profile, parameter, depth, value) rows in stored level order, nulls left out.

    Any field of a level can be drawn, adjusted values and flags too.
    """
    keys = level_fields(parameters)
    pairs = ", ".join(f"'{p}', cast(m.{p} as double)" for p in keys)
    return (
        _levels(profiles, bgc, ids, keys)
        .selectExpr(
            "requested_id", "position", "profile_id", "label", "level", "m.pres as depth",
            f"stack({len(keys)}, {pairs}) as (parameter, value)",
        )
        .where("value is not null")
    )


def compare_series(
    profiles: DataFrame, bgc: DataFrame, ids: list[str] | DataFrame | None, parameter: str = "temp"
) -> DataFrame:
    """One parameter against depth for any number of profiles."""
    return depth_series(profiles, bgc, ids, [parameter])


def scatter_pairs(
    profiles: DataFrame,
    bgc: DataFrame,
    ids: list[str] | DataFrame | None,
    param_x: str = "psal",
    param_y: str = "temp",
) -> DataFrame:
    """Pairs of two parameters at the levels that hold both and a pressure."""
    x, y = require_param(param_x), require_param(param_y)
    return (
        _levels(profiles, bgc, ids, [x, y])
        .where(f"m.{x} is not null and m.{y} is not null")
        .selectExpr(
            "requested_id", "position", "profile_id", "label", "level", f"m.{x} as x",
            f"m.{y} as y",
        )
    )


def ts_pairs(profiles: DataFrame, bgc: DataFrame, ids: list[str] | DataFrame | None) -> DataFrame:
    """Salinity and temperature pairs."""
    return scatter_pairs(profiles, bgc, ids, "psal", "temp").withColumnsRenamed(
        {"x": "salinity", "y": "temperature"}
    )


def markers(profiles: DataFrame, bgc: DataFrame, ids: list[str] | DataFrame | None) -> DataFrame:
    """Positions of profiles; those without a position are listed but not drawable."""
    found = _found(
        profiles, bgc, ids,
        ["platform_number", "cycle_number", "timestamp", "latitude", "longitude"],
    )
    return found.selectExpr(
        "requested_id", "position", "profile_id", "platform_number", "latitude as lat",
        "longitude as lon", f"{iso_date('timestamp')} as date", "cycle_number",
        "latitude is not null and longitude is not null as drawable",
    )


def _intent(kind: str, params: Column) -> Column:
    return F.to_json(
        F.struct(F.lit(kind).alias("type"), params.alias("params")),
        {"ignoreNullFields": "false"},
    ).alias("chart_spec")


def trajectory_spec(profiles: DataFrame, floats: DataFrame, platform_number: str | None = None):
    """Map specification and summary sentence per float."""
    rows = profiles.select("platform_number")
    known = floats
    if platform_number is not None:
        rows = rows.where(F.col("platform_number") == platform_number)
        known = known.where(F.col("platform_number") == platform_number)
    totals = rows.groupBy("platform_number").agg(F.count("*").alias("n"))
    joined = known.join(totals, "platform_number", "left").withColumn(
        "total_points", F.coalesce("n", F.lit(0))
    )
    summary = (
        "concat('Float ', platform_number, ' (', coalesce(platform_type, '?'), '): ', "
        "coalesce(cast(total_cycles as string), '?'), ' cycles from ', "
        f"coalesce({iso_date('first_date')}, 'None'), ' to ', "
        f"coalesce({iso_date('last_date')}, 'None'), '. Trajectory has ', total_points, "
        "' data points.')"
    )
    return joined.select(
        "platform_number",
        F.expr(summary).alias("summary"),
        _intent("map_trajectory", F.struct("platform_number", "total_points")),
    )


def _shown(value: str) -> str:
    """A value inside a summary sentence; a missing one reads None."""
    return f"coalesce(cast({value} as string), 'None')"


def depth_spec(
    profiles: DataFrame,
    bgc: DataFrame,
    ids: list[str] | DataFrame | None,
    parameters: list[str] | str = "temp",
) -> DataFrame:
    """Depth-chart specification and summary sentence per profile."""
    names = parameters.split(",") if isinstance(parameters, str) else parameters
    names = [p.strip().lower() for p in names]
    found = _found(
        profiles, bgc, ids,
        ["platform_number", "cycle_number", "timestamp", "latitude", "longitude"],
    )
    title = F.lit(f"Depth profile chart for {', '.join(p.upper() for p in names)} on profile ")
    facts = F.expr(
        f"concat(profile_id, ' (float ', {_shown('platform_number')}, ', cycle ', "
        f"{_shown('cycle_number')}, ', date: ', {_shown(iso_date('timestamp'))}, ', lat: ', "
        f"{_shown('latitude')}, ', lon: ', {_shown('longitude')}, ').')"
    )
    return found.select(
        "requested_id",
        "profile_id",
        F.concat(title, facts).alias("summary"),
        _intent(
            "chart_depth_profile",
            F.struct("profile_id", F.array(*map(F.lit, names)).alias("parameters")),
        ),
    )


def _one_spec(found: DataFrame, kind: str, entry: Column, params, summary) -> DataFrame:
    """One specification of the profiles found for a list, in the list's order.

    The row holds what the caller listed. Nothing found gives no row.
    """
    rows = F.array_sort(F.collect_list(F.struct("position", entry.alias("entry"))))
    return found.agg(rows.getField("entry").alias("r")).where("size(r) > 0").select(
        summary.alias("summary"), _intent(kind, F.struct(*params))
    )


def list_spec(
    profiles: DataFrame,
    bgc: DataFrame,
    ids: list[str] | DataFrame,
    kind: str,
    title: str,
    named: str = "label",
    count_word: str = "profile(s)",
    **settings: str,
) -> DataFrame:
    """Specification and summary of a chart of several profiles.

    A list of ids gives one row, ids and labels in the order given. A DataFrame of ids, of
    any size, gives a row per profile (position, profile_id, label) beside the kind and
    settings of the chart, so that no row grows with the number of profiles.
    """
    found = lookup_profiles(profiles, bgc, ids, ["platform_number", "cycle_number"])
    fixed = [F.lit(v).alias(k) for k, v in settings.items()]
    if isinstance(ids, DataFrame):
        return found.select(
            "position", "profile_id", F.expr(LABEL).alias("label"),
            _intent(kind, F.struct(*fixed) if fixed else F.lit(None)),
        )
    entry = F.struct("profile_id", F.expr(LABEL).alias("label"))
    summary = F.concat(
        F.lit(f"{title} for "), F.size("r").cast("string"), F.lit(f" {count_word}: "),
        F.array_join(F.col(f"r.{named}"), ", "), F.lit("."),
    )
    params = [F.col("r.profile_id").alias("profile_ids"), *fixed, F.col("r.label").alias("labels")]
    return _one_spec(found, kind, entry, params, summary)


def ts_spec(profiles: DataFrame, bgc: DataFrame, ids: list[str] | DataFrame) -> DataFrame:
    return list_spec(profiles, bgc, ids, "chart_ts_diagram", "T-S Diagram", named="profile_id")


def comparison_spec(
    profiles: DataFrame, bgc: DataFrame, ids: list[str] | DataFrame, parameter: str = "temp"
) -> DataFrame:
    key = parameter.lower()
    return list_spec(
        profiles, bgc, ids, "chart_comparison", f"Comparing {key.upper()} vs depth",
        count_word="profiles", parameter=key,
    )


def scatter_spec(
    profiles: DataFrame, bgc: DataFrame, ids: list[str] | DataFrame, param_x: str = "psal",
    param_y: str = "temp",
) -> DataFrame:
    x, y = require_param(param_x), require_param(param_y)
    return list_spec(
        profiles, bgc, ids, "chart_parameter_scatter", f"{x.upper()} vs {y.upper()} scatter",
        param_x=x, param_y=y,
    )


def markers_spec(profiles: DataFrame, bgc: DataFrame, ids: list[str] | DataFrame) -> DataFrame:
    """Map specification and summary of a list of profiles with their positions.

    A DataFrame of ids gives the markers themselves, a row each.
    """
    found = markers(profiles, bgc, ids)
    if isinstance(ids, DataFrame):
        return found
    place = F.struct("profile_id", "platform_number", "lat", "lon", "date", "cycle_number")
    summary = F.concat(F.lit("Map with "), F.size("r").cast("string"), F.lit(" profile markers."))
    params = [F.col("r.profile_id").alias("profile_ids"), F.col("r").alias("locations")]
    return _one_spec(found, "map_markers", place, params, summary)

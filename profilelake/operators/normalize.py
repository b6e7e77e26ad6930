"""Bronze rows to profiles, the split into core and BGC, and the rejected rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilelake.functions import cleaning as cl
from profilelake.functions import levels as lv
from profilelake.schema import BGC_PROFILE_QC, PARAMS, PROFILE_DATES, PROFILE_TEXT

ROW_ERROR = (
    "case when parse_error is not null then parse_error "
    "when profile_index is null then 'no profiles in file' "
    f"when {cl.clean_text('platform_number')} is null then 'no platform number' end"
)


def with_source(bronze: DataFrame) -> DataFrame:
    """Add ``file_type`` from the file name."""
    return bronze.withColumn("file_type", F.expr(cl.classify_source("source_file")))


def quarantine(bronze: DataFrame) -> DataFrame:
    """Rejected rows with the reason. Only an unreadable file counts as a failed file."""
    return with_source(bronze).selectExpr(
        "source_file",
        "profile_index",
        "file_type",
        f"{ROW_ERROR} as error",
        "parse_error is not null as file_failed",
    ).where("error is not null")


def accepted(bronze: DataFrame) -> DataFrame:
    """Rows that become profiles."""
    return with_source(bronze).where(f"({ROW_ERROR}) is null")


def _replace(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    """Add or replace columns by expression text."""
    return df.withColumns({name: F.expr(text) for name, text in exprs.items()})


def clean_fields(bronze: DataFrame) -> DataFrame:
    """Accepted rows with every scalar and list of names cleaned and typed."""
    texts = [*PROFILE_TEXT, *BGC_PROFILE_QC, "platform_number"]
    return _replace(
        accepted(bronze),
        {c: cl.clean_text(c) for c in texts}
        | {c: cl.parse_datetime14(c) for c in PROFILE_DATES}
        | {c: cl.clean_int(c) for c in ("cycle_number", "config_mission_number")}
        | {c: cl.clean_numeric(c) for c in ("latitude", "longitude")}
        | {
            "timestamp": cl.juld_to_timestamp("juld"),
            "timestamp_qc": cl.decode_qc("juld_qc"),
            "timestamp_location": cl.juld_to_timestamp("juld_location"),
            "position_qc": cl.decode_qc("position_qc"),
            "parameter_data_mode": cl.clean_text_array("parameter_data_mode"),
            "station_parameters": cl.station_parameters("station_parameters"),
        },
    )


def normalize(bronze: DataFrame) -> DataFrame:
    """One cleaned, typed profile per accepted bronze row.

    A projection without a shuffle: a caller who reads few profile columns has the rest
    pruned, down to the scan.
    """
    # parameters the station list does not name are dropped once, before they are read
    listed = _replace(
        clean_fields(bronze),
        {"measured": "transform(station_parameters, t -> upper(t))", "raw_pres": "pres.value"},
    )
    wanted = _replace(
        listed,
        {p.lower(): lv.wanted_param(p, "measured") for p in PARAMS}
        | {"other_params": lv.wanted_others("measured")},
    )
    leveled = _replace(wanted, {"levels": lv.assemble_levels("raw_pres")})
    derived = _replace(leveled, {
        "profile_id": cl.build_profile_id(
            "platform_number", "cycle_number", "direction", "file_type"
        ),
        "geo_location": cl.geo_point("latitude", "longitude"),
        "bgc_parameters": cl.detect_bgc("station_parameters"),
        "available_vars": lv.available_vars(),
        "measurements": lv.filter_levels("levels", "file_type"),
    })
    return derived.selectExpr(
        "profile_id",
        "platform_number",
        "cycle_number",
        *PROFILE_TEXT,
        *PROFILE_DATES,
        "config_mission_number",
        "timestamp",
        "timestamp_qc",
        "timestamp_location",
        "latitude",
        "longitude",
        "position_qc",
        "geo_location",
        *BGC_PROFILE_QC,
        "station_parameters",
        "bgc_parameters is not null as contains_bgc",
        "bgc_parameters",
        "parameter_data_mode",
        "available_vars",
        "measurements",
        "size(measurements) as n_levels",
        f"{lv.max_pres('measurements')} as max_pres",
        f"{lv.flatten_calibration()} as calibration",
        f"{lv.flatten_history()} as history",
        "source_file",
        "profile_index",
        "file_type",
        "current_timestamp() as ingested_at",
    )


def core_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles of the core table: core and plain BGC files."""
    return profiles.where("file_type <> 'synthetic_bgc'")


def bgc_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles of the BGC table: synthetic files."""
    return profiles.where("file_type = 'synthetic_bgc'")

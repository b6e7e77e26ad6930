"""Text features: regions, dates, labels, number formats and the summary sentences."""

from profilelake.schema import (
    DATA_MODE_LABELS,
    DEFAULT_REGION,
    PARAM_LABELS,
    REGIONS,
    UNKNOWN_REGION,
)


def detect_region(lat: str, lon: str) -> str:
    """First region whose box holds the point, borders included."""
    boxes = " ".join(
        f"when {lat} between {south}D and {north}D and {lon} between {west}D and {east}D "
        f"then '{name}'"
        for name, south, north, west, east in REGIONS
    )
    return (
        f"case when {lat} is null or {lon} is null then '{UNKNOWN_REGION}' {boxes} "
        f"else '{DEFAULT_REGION}' end"
    )


def _dated(x: str, pattern: str, missing: str, cut: int) -> tuple[str, str]:
    moment = f"coalesce(date_format({x}, '{pattern}'), '{missing}')"
    parsed = f"if({x} rlike '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}', try_cast({x} as timestamp_ntz), null)"
    text = (
        f"case when coalesce({x}, '') = '' then '{missing}' "
        f"else coalesce(date_format({parsed}, '{pattern}'), left({x}, {cut})) end"
    )
    return moment, text


def format_date(x: str, is_text: bool = False) -> str:
    """``Month dd, yyyy``; text that is no date keeps its first 10 characters."""
    return _dated(x, "MMMM dd, yyyy", "unknown date", 10)[is_text]


def format_month_year(x: str, is_text: bool = False) -> str:
    """``Month yyyy``; text that is no date keeps its first 7 characters."""
    return _dated(x, "MMMM yyyy", "unknown", 7)[is_text]


def data_mode_label(x: str) -> str:
    labels = " ".join(f"when '{code}' then '{label}'" for code, label in DATA_MODE_LABELS.items())
    return (
        f"case when coalesce({x}, '') = '' then 'unknown mode' "
        f"else case {x} {labels} else concat('mode ', {x}) end end"
    )


def param_label(x: str) -> str:
    """Axis label of a parameter, its upper-case name when it has none."""
    labels = " ".join(f"when '{name}' then '{label}'" for name, label in PARAM_LABELS.items())
    return f"case {x} {labels} else upper({x}) end"


def fixed(x: str, digits: int) -> str:
    """The number with ``digits`` decimals, rounded from its exact binary value.

    ``format_string`` alone rounds the shortest decimal text half up. Here the scaled
    number's rounding error is recovered by splitting the factor in two halves, so a
    scaled value that looks like a tie is told from a true one; true ties go to even.
    """
    scale = f"{10 ** digits}D"
    size = f"abs({x})"
    scaled = f"({size} * {scale})"
    high = f"(134217729D * {size} - (134217729D * {size} - {size}))"
    error = f"(({high} * {scale} - {scaled}) + ({size} - {high}) * {scale})"
    whole = f"floor({scaled})"
    rest = f"({scaled} - {whole})"
    up = (
        f"({rest} > 0.5D or ({rest} = 0.5D and "
        f"({error} > 0D or ({error} = 0D and {whole} % 2 = 1))))"
    )
    # from 2^53 on the scaled number has no fraction to round
    rounded = f"if({scaled} < 9007199254740992D, ({whole} + if({up}, 1, 0)) / {scale}, {size})"
    return (
        f"case when {x} is not null then concat(if({x} < 0, '-', ''), "
        f"format_string('%.{digits}f', {rounded})) end"
    )


def degrees(x: str, digits: int, positive: str, negative: str) -> str:
    """Absolute degrees with the hemisphere letter."""
    return f"concat({fixed(f'abs({x})', digits)}, '°', if({x} >= 0, '{positive}', '{negative}'))"


def _sentence(prefix: str, value: str) -> str:
    """``prefix value.`` or null, which ``concat_ws`` leaves out, without a value."""
    return f"concat('{prefix}', nullif({value}, ''), '.')"


def _joined(names: str, default: str) -> str:
    return f"coalesce(nullif(array_join({names}, ', '), ''), '{default}')"


def profile_summary() -> str:
    """The sentences that describe one profile row."""
    location = "concat('Located at ', {}, ', ', {}, ' in the ', {}, '.')".format(
        f"coalesce({degrees('latitude', 2, 'N', 'S')}, 'unknown')",
        f"coalesce({degrees('longitude', 2, 'E', 'W')}, 'unknown')",
        detect_region("latitude", "longitude"),
    )
    depth = (
        "concat('Depth range: ', coalesce(case when max_pres <> 0 then "
        f"concat('0 to ', {fixed('max_pres', 0)}, ' meters') end, 'unknown depth'), "
        "' with ', coalesce(n_levels, 0), ' depth levels.')"
    )
    flags = (
        "concat('Profile quality: ', nullif(concat_ws(', ', "
        "concat('pressure QC=', nullif(profile_pres_qc, '')), "
        "concat('temperature QC=', nullif(profile_temp_qc, '')), "
        "concat('salinity QC=', nullif(profile_psal_qc, ''))), ''), '.')"
    )
    parts = [
        "concat('ARGO float ', coalesce(platform_number, 'Unknown'), ', cycle ', "
        "coalesce(cast(cycle_number as string), '?'), ', ', "
        "if(direction = 'A', 'ascending', 'descending'), ' profile.')",
        location,
        f"concat('Measured on ', {format_date('timestamp')}, "
        f"' (', {format_month_year('timestamp')}, ').')",
        depth,
        f"concat('Parameters measured: ', {_joined('station_parameters', 'PRES, TEMP, PSAL')}, '.')",
        f"concat('Data mode: ', {data_mode_label('data_mode')}, '.')",
        "case when contains_bgc then concat('Contains BGC (biogeochemical) data: ', "
        "nullif(array_join(bgc_parameters, ', '), ''), '.') end",
        _sentence("Project: ", "project_name"),
        _sentence("Principal Investigator: ", "pi_name"),
        flags,
    ]
    return f"concat_ws(' ', {', '.join(parts)})"


def float_summary() -> str:
    """The sentences that describe one float row."""
    box = "geo_bounding_box"
    whole = " and ".join(f"{box}.{f} is not null" for f in ("min_lat", "max_lat", "min_lon", "max_lon"))

    def span(low: str, high: str, positive: str, negative: str) -> str:
        return (
            f"concat({degrees(f'{box}.{low}', 1, positive, negative)}, ' to ', "
            f"{degrees(f'{box}.{high}', 1, positive, negative)})"
        )

    place = (
        f"case when {whole} then concat('Operated in the ', {region_of_box()}, ', latitude ', "
        f"{span('min_lat', 'max_lat', 'N', 'S')}, ', longitude ', "
        f"{span('min_lon', 'max_lon', 'E', 'W')}, '.') "
        f"else 'Operated in the {UNKNOWN_REGION}, latitude unknown, longitude unknown.' end"
    )
    parts = [
        "concat('ARGO float ', coalesce(platform_number, 'Unknown'), ' (', "
        "coalesce(platform_type, 'unknown type'), ').')",
        place,
        "concat('Completed ', coalesce(total_cycles, 0), ' measurement cycles from ', "
        f"{format_date('first_date')}, ' to ', {format_date('last_date')}, ' (', "
        f"{format_month_year('first_date')}, ' to ', {format_month_year('last_date')}, ').')",
        "if(has_bgc, concat('Equipped with BGC sensors measuring ', "
        f"{_joined('bgc_parameters', 'various BGC parameters')}, '. ', "
        "coalesce(bgc_cycles, 0), ' BGC profiles available.'), 'Core float (no BGC sensors).')",
        _sentence("Project: ", "project_name"),
        _sentence("Principal Investigator: ", "pi_name"),
        _sentence("Data centre: ", "data_centre"),
        _sentence("Data modes: ", "array_join(data_modes_used, ', ')"),
    ]
    return f"concat_ws(' ', {', '.join(parts)})"


def box_center(axis: str) -> str:
    """Centre of a float's box on one axis (``lat`` or ``lon``)."""
    return f"((geo_bounding_box.min_{axis} + geo_bounding_box.max_{axis}) / 2)"


def region_of_box() -> str:
    return detect_region(box_center("lat"), box_center("lon"))


# one flat record for both kinds of documents; fields of the other kind stay null
METADATA = [
    "profile_id", "platform_number", "platform_type", "cycle_number", "data_mode", "file_type",
    "contains_bgc", "has_bgc", "region", "n_levels", "total_cycles", "latitude", "longitude",
    "center_lat", "center_lon", "max_pres", "year", "month", "project_name", "pi_name",
    "station_parameters", "bgc_parameters", "data_modes",
]
_TYPES = {
    "cycle_number": "int", "n_levels": "int", "total_cycles": "bigint", "year": "int",
    "month": "int", "contains_bgc": "boolean", "has_bgc": "boolean",
    "station_parameters": "array<string>", "bgc_parameters": "array<string>",
    "data_modes": "array<string>",
} | {c: "double" for c in ("latitude", "longitude", "center_lat", "center_lon", "max_pres")}


def _metadata(values: dict[str, str]) -> str:
    fields = ", ".join(
        f"cast({values.get(f, 'null')} as {_TYPES.get(f, 'string')}) as {f}" for f in METADATA
    )
    return f"struct({fields})"


def profile_metadata() -> str:
    """Filterable facts of one profile row."""
    return _metadata({
        "profile_id": "profile_id",
        "platform_number": "platform_number",
        "cycle_number": "coalesce(cycle_number, 0)",
        "data_mode": "data_mode",
        "file_type": "coalesce(file_type, 'core')",
        "contains_bgc": "coalesce(contains_bgc, false)",
        "region": detect_region("latitude", "longitude"),
        "n_levels": "coalesce(n_levels, 0)",
        "latitude": "latitude",
        "longitude": "longitude",
        "max_pres": "max_pres",
        "year": "year(timestamp)",
        "month": "month(timestamp)",
        "station_parameters": "case when size(station_parameters) > 0 then station_parameters end",
        "bgc_parameters": "case when size(bgc_parameters) > 0 then bgc_parameters end",
    })


def float_metadata() -> str:
    """Filterable facts of one float row; centre and region need the whole box."""
    center_lat, center_lon = box_center("lat"), box_center("lon")
    whole = f"{center_lat} is not null and {center_lon} is not null"
    return _metadata({
        "platform_number": "platform_number",
        "platform_type": "platform_type",
        "has_bgc": "coalesce(has_bgc, false)",
        "total_cycles": "coalesce(total_cycles, 0)",
        "center_lat": f"case when {whole} then {center_lat} end",
        "center_lon": f"case when {whole} then {center_lon} end",
        "region": f"case when {whole} then {region_of_box()} end",
        "project_name": "nullif(project_name, '')",
        "pi_name": "nullif(pi_name, '')",
        "bgc_parameters": "case when size(bgc_parameters) > 0 then bgc_parameters end",
        "data_modes": "case when size(data_modes_used) > 0 then data_modes_used end",
    })

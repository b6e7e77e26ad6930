"""Field catalogue, fixed lookup values and Spark types of the data model."""

from pyspark.sql import types as T

# Instrument parameter names, quality-flag meanings, region boxes,
# chart labels and store names. Results must use exactly these.
CORE_PARAMS = ["PRES", "TEMP", "PSAL"]
BGC_PARAMS = [
    "DOXY", "CHLA", "CHLA_FLUORESCENCE", "BBP700", "BBP532", "PH_IN_SITU_TOTAL",
    "NITRATE", "CDOM", "DOWN_IRRADIANCE380", "DOWN_IRRADIANCE412",
    "DOWN_IRRADIANCE490", "DOWNWELLING_PAR",
]
QUERY_CORE_PARAMS = ["pres", "temp", "psal"]
QUERY_BGC_PARAMS = [
    "doxy", "chla", "bbp700", "bbp532", "nitrate", "ph_in_situ_total", "cdom",
    "down_irradiance380", "down_irradiance412", "down_irradiance490",
    "downwelling_par",
]
QC_MEANINGS = [
    (0, "no_qc_performed"), (1, "good"), (2, "probably_good"), (3, "probably_bad"),
    (4, "bad"), (5, "changed"), (6, "not_used"), (7, "not_used"),
    (8, "interpolated"), (9, "missing"),
]
# (name, min lat, max lat, min lon, max lon); the first box that holds a point wins
REGIONS = [
    ("Arabian Sea", 5, 25, 50, 75),
    ("Bay of Bengal", 5, 23, 75, 95),
    ("Equatorial Indian", -10, 10, 40, 100),
    ("Southern Indian", -60, -10, 20, 120),
    ("Western Indian", -40, 10, 30, 60),
    ("Eastern Indian", -40, 10, 80, 120),
]
DEFAULT_REGION = "Indian Ocean"
UNKNOWN_REGION = "Unknown Region"
PARAM_LABELS = {
    "temp": "Temperature (°C)",
    "psal": "Salinity (PSU)",
    "pres": "Pressure (dbar)",
    "doxy": "Dissolved Oxygen (µmol/kg)",
    "chla": "Chlorophyll-a (mg/m³)",
    "bbp700": "BBP700 (m⁻¹)",
    "nitrate": "Nitrate (µmol/kg)",
}
DATA_MODE_LABELS = {
    "D": "delayed mode (quality-controlled)",
    "R": "real-time mode",
    "A": "adjusted mode",
}
COLLECTIONS = ["profiles", "bgc_profiles", "floats"]
EMBEDDING_DIM = 384
MAX_LEVELS_SHOWN = 30
NEAREST_PROFILES = 100
NEAREST_FLOATS_SHOWN = 20
# end of fixed values

PARAMS = CORE_PARAMS + BGC_PARAMS
QUERY_PARAMS = QUERY_CORE_PARAMS + QUERY_BGC_PARAMS

# per-parameter parts of a raw profile and the suffix each gets on a level
PARTS = {
    "value": "", "qc": "_qc", "adjusted": "_adjusted", "adjusted_qc": "_adjusted_qc",
    "adjusted_error": "_adjusted_error", "dpres": "_dpres",
}
QC_PARTS = {"qc", "adjusted_qc"}


def part_type(part: str) -> T.DataType:
    """Raw element type of one part: flags arrive as text, the rest as numbers."""
    return T.StringType() if part in QC_PARTS else T.DoubleType()


RAW_PARAM = T.StructType([T.StructField(p, T.ArrayType(part_type(p))) for p in PARTS])

# a parameter outside the catalogue, by its name: of a raw profile, and of one level
RAW_OTHER = T.StructType([T.StructField("name", T.StringType()), *RAW_PARAM.fields])
LEVEL_OTHER = T.StructType([
    T.StructField("name", T.StringType()),
    *(
        T.StructField(part, T.IntegerType() if part in QC_PARTS else T.DoubleType())
        for part in PARTS
    ),
])

LEVEL = T.StructType([
    T.StructField(
        param.lower() + suffix, T.IntegerType() if part in QC_PARTS else T.DoubleType()
    )
    for param in PARAMS
    for part, suffix in PARTS.items()
] + [T.StructField("others", T.ArrayType(LEVEL_OTHER))])

# text of the raw profile -> profile column (N1 on each)
PROFILE_TEXT = [
    "data_type", "format_version", "handbook_version", "project_name", "pi_name",
    "data_centre", "dc_reference", "platform_type", "float_serial_no",
    "firmware_version", "wmo_inst_type", "data_state_indicator",
    "vertical_sampling_scheme", "positioning_system", "direction", "data_mode",
    "profile_pres_qc", "profile_temp_qc", "profile_psal_qc",
]
PROFILE_DATES = ["reference_date_time", "date_creation", "date_update"]
BGC_PROFILE_QC = [f"profile_{p.lower()}_qc" for p in BGC_PARAMS]

# columns a source may leave out; an upsert keeps the stored value for those
OPTIONAL_COLUMNS = ["bgc_parameters", "parameter_data_mode", *BGC_PROFILE_QC]

HISTORY_TEXT = [
    "institution", "step", "software", "software_release", "reference", "action",
    "parameter", "qctest",
]
HISTORY_NUMBERS = ["start_pres", "stop_pres", "previous_value"]
CALIBRATION_TEXT = ["equation", "coefficient", "comment"]

STRINGS = T.ArrayType(T.StringType())
STRING_GRID = T.ArrayType(STRINGS)

# One row per (file, profile): the variables of an instrument file as they were read.
# parse_error marks an unreadable file, a null profile_index a file without profiles.
BRONZE = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("profile_index", T.IntegerType()),
        T.StructField("parse_error", T.StringType()),
        T.StructField("platform_number", T.StringType()),
        T.StructField("cycle_number", T.DoubleType()),
        T.StructField("config_mission_number", T.DoubleType()),
    ]
    + [T.StructField(c, T.StringType()) for c in PROFILE_TEXT + PROFILE_DATES]
    + [T.StructField(c, T.StringType()) for c in BGC_PROFILE_QC]
    + [T.StructField(c, T.DoubleType()) for c in ("juld", "juld_location", "latitude", "longitude")]
    + [T.StructField(c, T.StringType()) for c in ("juld_qc", "position_qc")]
    + [T.StructField(c, STRINGS) for c in ("station_parameters", "parameter_data_mode")]
    + [T.StructField(p.lower(), RAW_PARAM) for p in PARAMS]
    + [T.StructField("other_params", T.ArrayType(RAW_OTHER))]
    + [T.StructField("calib_parameter", STRING_GRID)]
    + [T.StructField(f"calib_{c}", STRING_GRID) for c in CALIBRATION_TEXT + ["date"]]
    + [T.StructField(f"history_{c}", STRINGS) for c in HISTORY_TEXT + ["date"]]
    + [T.StructField(f"history_{c}", T.ArrayType(T.DoubleType())) for c in HISTORY_NUMBERS]
)


def require_param(name: str) -> str:
    """Lower-cased parameter name; ValueError unless the query layer knows it."""
    key = name.strip().lower()
    if key not in QUERY_PARAMS:
        raise ValueError(f"unknown parameter {name!r}; known: {', '.join(QUERY_PARAMS)}")
    return key

"""Every registered query with the SQL that checks it.

Each query runs over whole tables: the profiles are derived from all of ``orders``, flat
levels from all of ``lineitem``, vectors from all of ``embeddings``.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_text as sql
from profilelake.functions import cleaning as cl
from profilelake.functions import text as tx
from profilelake.functions.dates import dated
from profilelake.operators import (
    checks,
    documents,
    lookup,
    nearest,
    rollup,
    series,
    stats,
    vectors,
)
from profilelake.operators.normalize import accepted, clean_fields, normalize, quarantine, with_source
from profilelake.plans import ingest
from profilelake.schema import QC_MEANINGS
from profilelake.session import configure, fresh_path, spread, writing
from profilelake.sources import documents as docstore
from profilelake.sources import fixtures, landing, tables
from profilelake.sources.lake import Lake, fixture_lake, fixture_store
from profilelake.streaming.ingest import stream_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under its key, with its checking SQL if there is one."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def on_lake(name: str, oracle: str | None = None):
    """Register a query over the stored tables."""

    def add(fn: Callable[[Lake], DataFrame]):
        query(name, oracle)(lambda spark, sf_dir: fn(fixture_lake(spark, sf_dir)))
        return fn

    return add


def on_profiles(name: str, oracle_body: str, ctes: str = sql.LEVELS):
    """Register a query over freshly normalised profiles, core and BGC alike."""

    def add(fn: Callable[[DataFrame], DataFrame]):
        query(name, sql.query(ctes, oracle_body))(
            lambda spark, sf_dir: fn(normalize(fixtures.bronze(spark, sf_dir)))
        )
        return fn

    return add


def on_bronze(name: str, oracle_body: str, ctes: str = sql.KEYED):
    def add(fn: Callable[[DataFrame], DataFrame]):
        query(name, sql.query(ctes, oracle_body))(
            lambda spark, sf_dir: fn(fixtures.bronze(spark, sf_dir))
        )
        return fn

    return add


def joined(c: str) -> str:
    return f"array_join({c}, ', ') as {c}"


# --- sources and sinks -----------------------------------------------------------------

LANDING = "*/section=profiles"
#: Groups of floats, a folder each, and orders that make one file in each of them: files of some
#: tens of megabytes, so a stream of many orders has few batches.
LANDING_GROUPS, LANDING_ROWS = 8, 1_000_000
_landings: dict[tuple[str, str], str] = {}


def landing_zone(spark: SparkSession, sf_dir: str) -> str:
    """The bronze rows as files in one folder per group of floats, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landings:
        root = fresh_path(spark, "landing")
        group = F.expr(f"pmod(hash(source_file), {LANDING_GROUPS})")
        rows = fixtures.bronze(spark, sf_dir, LANDING_ROWS).withColumns(
            {"float_group": group, "section": F.lit("profiles")}
        )
        with writing(spark, writers=LANDING_GROUPS):
            rows.write.option("compression", tables.CODEC).partitionBy("float_group", "section").parquet(root)
        _landings[key] = root
    return _landings[key]


@query("scan_raw", sql.query(sql.RAW, """
    SELECT source_file, profile_index, parse_error,
      CASE k % 10 WHEN 0 THEN 'D' WHEN 1 THEN ' ' ELSE 'A' END AS direction FROM landed"""))
def scan_raw(spark, sf_dir):
    rows = landing.scan_raw(spark, landing_zone(spark, sf_dir), LANDING)
    return rows.select("source_file", "profile_index", "parse_error", "direction")


@on_bronze("classify_source", "SELECT source_file, profile_index, file_type FROM landed", sql.RAW)
def classify_source(bronze):
    return with_source(bronze).select("source_file", "profile_index", "file_type")


@on_bronze("limit_input", """SELECT source_file, profile_index FROM landed WHERE source_file IN (
    SELECT DISTINCT source_file FROM landed ORDER BY source_file LIMIT 25)""", sql.RAW)
def limit_input(bronze):
    return landing.limit_input(bronze, 25).select("source_file", "profile_index")


@on_lake("route_profiles", sql.query(sql.KEYED, """
    SELECT profile_id, file_type,
      CASE WHEN file_type = 'synthetic_bgc' THEN 'bgc_profiles' ELSE 'profiles' END AS table_name
    FROM named"""))
def route_profiles(lake):
    def rows(df, name):
        return df.select("profile_id", "file_type", F.lit(name).alias("table_name"))

    return rows(lake.profiles, "profiles").unionByName(rows(lake.bgc_profiles, "bgc_profiles"))


@on_bronze("quarantine", """
    SELECT source_file, profile_index, file_type, coalesce(parse_error,
        CASE WHEN profile_index IS NULL THEN 'no profiles in file' ELSE 'no platform number' END)
        AS error, parse_error IS NOT NULL AS file_failed
    FROM landed WHERE parse_error IS NOT NULL OR profile_index IS NULL OR k % 53 = 0""", sql.RAW)
def quarantine_rows(bronze):
    return quarantine(bronze)


def _resent(bronze: DataFrame) -> DataFrame:
    """A later delivery: new project, no investigator, no station list; BGC files also come
    again as core files, under the same profile ids."""
    changed = bronze.withColumns({
        "project_name": F.lit("RESENT"),
        "pi_name": F.lit(" "),
        "station_parameters": F.lit(None).cast("array<string>"),
    })
    twins = changed.where("source_file like 'B%'").withColumns({
        "source_file": F.expr("concat('D', substring(source_file, 3))"),
        "wmo_inst_type": F.lit("999"),
    })
    return changed.unionByName(twins)


@query("upsert_profiles", sql.query(sql.KEYED, """
    SELECT profile_id, 'RESENT' AS project_name, CAST(NULL AS VARCHAR) AS pi_name, 'core' AS file_type,
      CASE WHEN file_type = 'bgc' THEN '999' ELSE wmo_inst_type END AS wmo_inst_type,
      CASE WHEN h = 0 THEN array_to_string(bgc_parameters, ', ') END AS bgc_parameters
    FROM named WHERE file_type <> 'synthetic_bgc'"""))
def upsert_profiles(spark, sf_dir):
    store = ingest.Store(spark, fresh_path(spark, "upsert"))
    bronze = fixtures.bronze(spark, sf_dir)
    first = normalize(bronze.where("profile_index = 0 or profile_index is null"))
    core = "file_type <> 'synthetic_bgc'"
    ingest.upsert_profiles(store, "profiles", first.where(core))
    second = normalize(_resent(bronze)).where(core)
    return ingest.upsert_profiles(store, "profiles", second).selectExpr(
        "profile_id", "project_name", "pi_name", "file_type", "wmo_inst_type",
        joined("bgc_parameters"),
    )


@on_lake("write_floats", sql.query(sql.FLOATS, """
    SELECT platform_number, total_cycles, has_bgc, bgc_cycles, data_modes_used FROM floats"""))
def write_floats(lake):
    spark = lake.profiles.sparkSession
    store = ingest.Store(spark, fresh_path(spark, "floats"))
    ingest.write_floats(store, rollup.build_floats(lake.profiles, lake.bgc_profiles))
    return ingest.write_floats(store, lake.floats).selectExpr(
        "platform_number", "total_cycles", "has_bgc", "bgc_cycles", joined("data_modes_used")
    )


@on_lake("table_layout", sql.query(sql.LEVELS, """
    SELECT CAST(year(ts) AS INTEGER) AS year, count(*) AS profiles,
      CAST(sum(n_levels) AS BIGINT) AS levels
    FROM prof WHERE file_type <> 'synthetic_bgc' GROUP BY ALL"""))
def table_layout(lake):
    return lake.profiles.groupBy("year").agg(
        F.count("*").alias("profiles"), F.sum("n_levels").alias("levels")
    )


@on_bronze("ingest_summary", """
    SELECT count(DISTINCT source_file) AS files_discovered,
      count(DISTINCT CASE WHEN parse_error IS NULL THEN source_file END) AS files_processed,
      count(DISTINCT CASE WHEN parse_error IS NOT NULL THEN source_file END) AS files_errored,
      count(*) FILTER (WHERE ok AND file_type <> 'synthetic_bgc') AS core_profiles,
      count(*) FILTER (WHERE ok AND file_type = 'synthetic_bgc') AS bgc_profiles
    FROM (SELECT *, parse_error IS NULL AND profile_index IS NOT NULL AND k % 53 <> 0 AS ok
          FROM landed)""", sql.RAW)
def ingest_summary(bronze):
    return ingest.ingest_summary(bronze)


@query("stream_ingest", sql.query(sql.LEVELS, """
    SELECT profile_id, platform_number, n_levels, array_to_string(bgc_parameters, ', ')
      AS bgc_parameters FROM prof"""))
def stream_ingest_query(spark, sf_dir):
    store = ingest.Store(spark, fresh_path(spark, "stream"))
    stream_ingest(store, landing_zone(spark, sf_dir), LANDING, files_per_batch=32)
    fields = ["profile_id", "platform_number", "n_levels", "bgc_parameters"]
    both = store.read("profiles").select(*fields).unionByName(
        store.read("bgc_profiles").select(*fields)
    )
    return both.selectExpr(*fields[:3], joined("bgc_parameters"))


@on_lake("scan_projected", sql.query(sql.LEVELS, f"""
    SELECT profile_id, platform_number, cycle_number, direction, latitude, longitude,
      {sql.iso('ts')} AS timestamp, max_pres, n_levels, data_mode,
      array_to_string(stations, ', ') AS station_parameters, has_bgc AS contains_bgc,
      array_to_string(bgc_parameters, ', ') AS bgc_parameters, project_name, pi_name, file_type,
      profile_pres_qc, profile_temp_qc, profile_psal_qc
    FROM prof WHERE file_type <> 'synthetic_bgc'"""))
def scan_projected(lake):
    rows = documents.scan_projected(lake.profiles)
    return rows.withColumns({
        "timestamp": F.expr(cl.iso_date("timestamp")),
        "station_parameters": F.array_join("station_parameters", ", "),
        "bgc_parameters": F.array_join("bgc_parameters", ", "),
    })


@on_lake("upsert_documents", sql.query(sql.DOCS, """
    SELECT collection, id, document || CASE WHEN collection = 'floats' THEN ' Updated.' ELSE '' END
      AS document FROM docs"""))
def upsert_documents(lake):
    spark = lake.profiles.sparkSession
    store = ingest.Store(spark, fresh_path(spark, "documents"))
    docstore.upsert_documents(store, documents.build_documents(*_tables(lake)))
    again = documents.build_documents(*_tables(lake), "floats").withColumn(
        "document", F.concat("document", F.lit(" Updated."))
    )
    return docstore.upsert_documents(store, again).select("collection", "id", "document")


@on_lake("reset_collections", """
    SELECT collection, CAST(0 AS BIGINT) AS documents
    FROM (VALUES ('profiles'), ('bgc_profiles'), ('floats')) t(collection)""")
def reset_collections(lake):
    spark = lake.profiles.sparkSession
    store = ingest.Store(spark, fresh_path(spark, "reset"))
    docstore.upsert_documents(store, documents.build_documents(*_tables(lake)))
    return stats.collection_stats(docstore.reset_collections(store))


def _tables(lake: Lake) -> tuple[DataFrame, DataFrame, DataFrame]:
    return lake.profiles, lake.bgc_profiles, lake.floats


# --- cleaning --------------------------------------------------------------------------


@on_profiles("clean_text", """
    SELECT profile_id, platform_number, project_name, pi_name, platform_type,
      'Argo profile' AS data_type, CAST(c AS VARCHAR) AS float_serial_no, 'n/a' AS firmware_version
    FROM named""", sql.KEYED)
def clean_text(p):
    return p.select("profile_id", "platform_number", "project_name", "pi_name", "platform_type",
                    "data_type", "float_serial_no", "firmware_version")


@on_bronze("clean_text_array", """
    SELECT source_file, profile_index, CAST(j AS INTEGER) AS position,
      ['PRES', NULL, 'TEMP', 'PSAL'][j + 1] AS name
    FROM (SELECT *, unnest(range(0, 4)) AS j FROM named
          WHERE f % 6 < 2 AND k % 41 <> 0 AND k % 43 <> 0)""")
def clean_text_array(bronze):
    rows = accepted(bronze).where("size(station_parameters) = 4")
    return rows.selectExpr(
        "source_file", "profile_index",
        f"posexplode({cl.clean_text_array('station_parameters')}) as (position, name)",
    )


@on_profiles("clean_numeric", "SELECT profile_id, latitude, longitude FROM named", sql.KEYED)
def clean_numeric(p):
    return p.select("profile_id", "latitude", "longitude")


@on_profiles("clean_int", """
    SELECT profile_id, cycle_number, CASE WHEN k % 3 <> 0 THEN CAST(k % 7 AS INTEGER) END
      AS config_mission_number FROM named""", sql.KEYED)
def clean_int(p):
    return p.select("profile_id", "cycle_number", "config_mission_number")


@on_profiles("decode_qc", """
    SELECT profile_id, [1, -1, 4, -1, -1][k % 5 + 1] AS timestamp_qc,
      [2, -1, 1][k % 3 + 1] AS position_qc FROM named""", sql.KEYED)
def decode_qc(p):
    return p.select("profile_id", "timestamp_qc", "position_qc")


@on_profiles("juld_to_timestamp", f"""
    SELECT profile_id, {sql.iso('ts')} AS timestamp,
      CASE WHEN k % 2 = 0 THEN {sql.iso('CAST(d AS TIMESTAMP) + to_minutes(k % 1440)')} END
        AS timestamp_location FROM named""", sql.KEYED)
def juld_to_timestamp(p):
    return p.selectExpr("profile_id", f"{cl.iso_date('timestamp')} as timestamp",
                        f"{cl.iso_date('timestamp_location')} as timestamp_location")


@on_profiles("parse_datetime14", """
    SELECT profile_id, '1950-01-01T00:00:00Z' AS reference_date_time,
      strftime(d, '%Y-%m-%dT0') || (k % 10) || ':30:15Z' AS date_creation,
      CASE WHEN k % 4 > 1 THEN strftime(d, '%Y-%m-%dT23:59:59Z') END AS date_update
    FROM named""", sql.KEYED)
def parse_datetime14(p):
    return p.selectExpr(
        "profile_id",
        *(f"{cl.iso_date(c)} as {c}" for c in ("reference_date_time", "date_creation", "date_update")),
    )


@on_profiles("build_profile_id", "SELECT source_file, profile_index, profile_id FROM named",
             sql.KEYED)
def build_profile_id(p):
    return p.select("source_file", "profile_index", "profile_id")


@on_bronze("require_platform", "SELECT source_file, profile_index FROM raw", sql.RAW)
def require_platform(bronze):
    return accepted(bronze).select("source_file", "profile_index")


@on_profiles("geo_point", """
    SELECT profile_id, latitude IS NOT NULL AND longitude IS NOT NULL AS has_point,
      CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN longitude END AS lon,
      CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN latitude END AS lat
    FROM named""", sql.KEYED)
def geo_point(p):
    return p.selectExpr("profile_id", "geo_location is not null as has_point",
                        "geo_location.lon as lon", "geo_location.lat as lat")


@on_bronze("profile_fields", """
    SELECT source_file, profile_index, platform_number, cycle_number, direction, data_mode,
      'ref' || k AS dc_reference, wmo_inst_type, data_centre, '2B' AS data_state_indicator,
      CASE WHEN k % 2 = 0 THEN 'GPS' ELSE 'ARGOS' END AS positioning_system,
      profile_pres_qc, profile_temp_qc, profile_psal_qc, '3.1' AS format_version
    FROM named""")
def profile_fields(bronze):
    return clean_fields(bronze).select(
        "source_file", "profile_index", "platform_number", "cycle_number", "direction",
        "data_mode", "dc_reference", "wmo_inst_type", "data_centre", "data_state_indicator",
        "positioning_system", "profile_pres_qc", "profile_temp_qc", "profile_psal_qc",
        "format_version",
    )


@on_profiles("bgc_profile_qc", """
    SELECT profile_id, CASE WHEN f % 6 >= 2 AND k % 8 <> 0 THEN 'A' END AS profile_doxy_qc,
      CAST(NULL AS VARCHAR) AS profile_nitrate_qc FROM named""", sql.KEYED)
def bgc_profile_qc(p):
    return p.select("profile_id", "profile_doxy_qc", "profile_nitrate_qc")


@on_profiles("station_parameters", """
    SELECT profile_id, CAST(unnest(range(0, len(stations))) AS INTEGER) AS position,
      unnest(stations) AS parameter FROM named""", sql.KEYED)
def station_parameters(p):
    return p.selectExpr("profile_id", "posexplode(station_parameters) as (position, parameter)")


@on_profiles("detect_bgc", """
    SELECT profile_id, has_bgc AS contains_bgc, array_to_string(bgc_parameters, ', ')
      AS bgc_parameters FROM named""", sql.KEYED)
def detect_bgc(p):
    return p.selectExpr("profile_id", "contains_bgc", joined("bgc_parameters"))


@on_profiles("parameter_data_mode", """
    SELECT profile_id, CAST(j AS INTEGER) AS position, ['D', NULL, 'R', 'A'][j + 1] AS mode
    FROM (SELECT *, unnest(range(0, 4)) AS j FROM named WHERE f % 6 >= 2)""", sql.KEYED)
def parameter_data_mode(p):
    return p.selectExpr("profile_id", "posexplode(parameter_data_mode) as (position, mode)")


@on_bronze("assemble_levels", """
    SELECT source_file, profile_index, CAST(i AS INTEGER) AS level, pres, cyclic_qc AS pres_qc,
      i * 50e0 + k % 50 + 0.5e0 AS pres_adjusted, 1 AS pres_adjusted_qc,
      2.4e0 AS pres_adjusted_error, temp, temp_adjusted, psal, doxy,
      CASE WHEN has_bgc AND f % 6 < 4 THEN i * 0.5e0 END AS doxy_dpres, chla,
      CASE WHEN has_bgc THEN 0 END AS chla_qc, CAST(NULL AS DOUBLE) AS nitrate,
      CASE WHEN k % 41 <> 0 AND k % 43 <> 0 THEN 'turbidity' END AS other_name,
      CASE WHEN k % 41 <> 0 AND k % 43 <> 0 THEN temp END AS other_value
    FROM measured""", sql.LEVELS)
def assemble_levels(bronze):
    from profilelake.functions import levels as lv
    from profilelake.schema import PARAMS

    # a parameter outside the catalogue, where the file lists any
    listed = "exists(station_parameters, t -> trim(t) = 'PRES')"
    bronze = bronze.withColumns({
        "station_parameters": F.expr(
            f"if({listed}, array_append(station_parameters, 'TURBIDITY '), station_parameters)"),
        "other_params": F.expr(
            "array(named_struct('name', 'Turbidity', 'value', temp.value, 'qc', temp.qc, "
            "'adjusted', temp.adjusted, 'adjusted_qc', temp.adjusted_qc, "
            "'adjusted_error', temp.adjusted_error, 'dpres', temp.dpres))"),
    })
    rows = clean_fields(bronze).withColumns({
        "raw_pres": F.expr("pres.value"),
        "measured": F.expr("transform(station_parameters, t -> upper(t))"),
    })
    rows = rows.withColumns(
        {p.lower(): F.expr(lv.wanted_param(p, "measured")) for p in PARAMS}
        | {"other_params": F.expr(lv.wanted_others("measured"))})
    fields = ["pres", "pres_qc", "pres_adjusted", "pres_adjusted_qc", "pres_adjusted_error",
              "temp", "temp_adjusted", "psal", "doxy", "doxy_dpres", "chla", "chla_qc", "nitrate"]
    return rows.selectExpr(
        "source_file", "profile_index",
        f"posexplode({lv.assemble_levels('raw_pres')}) as (level, m)",
    ).selectExpr(
        "source_file", "profile_index", "level", *(f"m.{f}" for f in fields),
        "get(m.others, 0).name as other_name", "get(m.others, 0).value as other_value",
    )


@on_profiles("filter_levels", "SELECT profile_id, level, pres, temp, psal, doxy, chla FROM lev")
def filter_levels(p):
    fields = ["pres", "temp", "psal", "doxy", "chla"]
    return lookup.explode_levels(p, ["profile_id"], fields).selectExpr(
        "profile_id", "level", *(f"m.{f}" for f in fields)
    )


@on_profiles("n_levels", "SELECT profile_id, n_levels FROM prof")
def n_levels(p):
    return p.select("profile_id", "n_levels")


@on_profiles("max_pres", "SELECT profile_id, max_pres FROM prof")
def max_pres(p):
    return p.select("profile_id", "max_pres")


@on_profiles("flatten_calibration", """
    SELECT profile_id, CASE WHEN p = 0 THEN 'PRES' ELSE 'TEMP' || j END AS parameter,
      CASE WHEN p = 0 THEN 'PA=P-' || (k % 11) ELSE 'none' END AS equation,
      CASE WHEN p = 0 AND j = 0 AND k % 2 = 0 THEN 'dP=0.1' END AS coefficient,
      CASE WHEN p = 0 AND j = 0 THEN 'surface offset' END AS comment,
      CASE WHEN p = 0 AND j = 0 THEN strftime(d, '%Y-%m-%dT12:00:00Z') END AS date
    FROM (SELECT *, unnest([0, 2]) AS p FROM (
      SELECT *, unnest(range(0, k % 2 + 1)) AS j FROM named WHERE k % 9 <> 0))""", sql.KEYED)
def flatten_calibration(p):
    return p.selectExpr("profile_id", "explode(calibration) as e").selectExpr(
        "profile_id", "e.parameter", "e.equation", "e.coefficient", "e.comment",
        f"{cl.iso_date('e.date')} as date",
    )


@on_profiles("flatten_history", """
    SELECT profile_id, CASE WHEN h2 = 0 THEN 'IF' ELSE 'ME' END AS institution,
      CASE WHEN h2 = 0 THEN 'ARFM' ELSE 'ARSQ' END AS step, CASE WHEN h2 = 0 THEN 'SIO' END AS software,
      CASE WHEN h2 = 0 THEN '2.0' ELSE 'V1' END AS software_release, CAST(NULL AS VARCHAR) AS reference,
      CASE WHEN h2 = 0 THEN 'IP' ELSE 'CV' END AS action, CASE WHEN h2 = 2 THEN 'PSAL' END AS parameter,
      CASE WHEN h2 = 0 THEN '8000' ELSE 'Q' || (k % 3) END AS qctest,
      CASE WHEN h2 = 0 THEN strftime(d, '%Y-%m-%dT06:00:00Z') END AS date,
      CASE WHEN h2 = 2 THEN CAST(k % 100 AS DOUBLE) END AS start_pres,
      CASE WHEN h2 = 2 THEN k % 100 + 1000e0 END AS stop_pres,
      CAST(NULL AS DOUBLE) AS previous_value
    FROM (SELECT *, unnest([0, 2]) AS h2 FROM named WHERE k % 6 <> 0)""", sql.KEYED)
def flatten_history(p):
    fields = ["institution", "step", "software", "software_release", "reference", "action",
              "parameter", "qctest", "start_pres", "stop_pres", "previous_value"]
    return p.selectExpr("profile_id", "explode(history) as e").selectExpr(
        "profile_id", *(f"e.{f}" for f in fields), f"{cl.iso_date('e.date')} as date"
    )


@on_bronze("stamp_ingest", """SELECT source_file, profile_index, file_type, true AS stamped FROM raw""",
           sql.RAW)
def stamp_ingest(bronze):
    return normalize(bronze).selectExpr(
        "source_file", "profile_index", "file_type",
        "ingested_at > timestamp'2020-01-01' as stamped",
    )


@on_profiles("qc_meaning", """
    SELECT pres_qc, meaning, count(*) AS levels FROM (
      SELECT cyclic_qc AS pres_qc, CASE cyclic_qc WHEN 1 THEN 'good' WHEN 4 THEN 'bad' END AS meaning
      FROM lev) GROUP BY ALL""")
def qc_meaning(p):
    names = p.sparkSession.createDataFrame(QC_MEANINGS, "pres_qc int, meaning string")
    flags = lookup.explode_levels(p, ["profile_id"], ["pres_qc"]).select("m.pres_qc")
    return flags.groupBy("pres_qc").agg(F.count("*").alias("levels")).join(
        F.broadcast(names), "pres_qc", "left"
    )


@on_profiles("param_label", """
    SELECT parameter, CASE parameter WHEN 'pres' THEN 'Pressure (dbar)'
        WHEN 'temp' THEN 'Temperature (°C)' WHEN 'psal' THEN 'Salinity (PSU)'
        WHEN 'doxy' THEN 'Dissolved Oxygen (µmol/kg)' WHEN 'chla' THEN 'Chlorophyll-a (mg/m³)'
      END AS label, count(*) AS profiles
    FROM (SELECT lower(unnest(stations)) AS parameter FROM named) GROUP BY ALL""", sql.KEYED)
def param_label(p):
    names = p.select(F.explode("station_parameters").alias("s")).selectExpr("lower(s) as parameter")
    return names.groupBy("parameter").agg(F.count("*").alias("profiles")).selectExpr(
        "parameter", f"{tx.param_label('parameter')} as label", "profiles"
    )


@on_profiles("iso_date", f"SELECT profile_id, {sql.iso('ts')} AS date FROM named", sql.KEYED)
def iso_date(p):
    return p.selectExpr("profile_id", f"{cl.iso_date('timestamp')} as date")


# --- aggregation -----------------------------------------------------------------------

BOX = f"""{sql.iso('first_date')} AS first_date, {sql.iso('last_date')} AS last_date,
  min_lat, max_lat, min_lon, max_lon"""
DATES = [f"{cl.iso_date(c)} as {c}" for c in ("first_date", "last_date")]
CORNERS = ["min_lat", "max_lat", "min_lon", "max_lon"]


@on_lake("float_core_rollup", sql.query(sql.FLOATS, f"""
    SELECT platform_number, nullif(project_name, '') AS project_name, nullif(pi_name, '') AS pi_name,
      nullif(platform_type, '') AS platform_type, wmo_inst_type, data_centre, total_cycles, {BOX},
      data_modes AS data_modes_used FROM core_rollup"""))
def float_core_rollup(lake):
    return rollup.float_core_rollup(lake.profiles).selectExpr(
        "platform_number", *rollup.FIRST_FIELDS, "total_cycles", *DATES, *CORNERS,
        joined("data_modes_used"),
    )


@on_lake("float_bgc_rollup", sql.query(sql.FLOATS, f"""
    SELECT platform_number, bgc_cycles, nullif(bgc_parameters, '') AS bgc_parameters, {BOX}
    FROM bgc_rollup"""))
def float_bgc_rollup(lake):
    return rollup.float_bgc_rollup(lake.bgc_profiles).selectExpr(
        "platform_number", "bgc_cycles", joined("bgc_parameters"), *DATES, *CORNERS
    )


FLOAT_FIELDS = ["platform_number", *rollup.FIRST_FIELDS, "total_cycles", "has_bgc",
                joined("bgc_parameters"), "bgc_cycles", *DATES,
                *(f"geo_bounding_box.{c}" for c in CORNERS), joined("data_modes_used")]


@on_lake("build_floats", sql.query(sql.FLOATS, f"""
    SELECT platform_number, project_name, pi_name, platform_type, wmo_inst_type, data_centre,
      total_cycles, has_bgc, bgc_parameters, bgc_cycles, {BOX}, data_modes_used FROM floats"""))
def build_floats(lake):
    return rollup.build_floats(lake.profiles, lake.bgc_profiles).selectExpr(*FLOAT_FIELDS)


STATS = """round(avg(v), 4) AS avg, round(min(v), 4) AS min, round(max(v), 4) AS max,
  count(*) AS count, count(DISTINCT id) AS num_profiles"""


@on_lake("aggregate_statistics", sql.query(sql.LEVELS, f"""
    SELECT 'temp' AS parameter, {STATS} FROM (
      SELECT temp AS v, profile_id AS id FROM lev WHERE file_type <> 'synthetic_bgc'
        AND pres BETWEEN 50 AND 300 AND temp IS NOT NULL
        AND ts BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-06-30')
    UNION ALL
    SELECT 'doxy', {STATS} FROM (
      SELECT doxy AS v, profile_id AS id FROM lev WHERE file_type = 'synthetic_bgc'
        AND pres BETWEEN 0 AND 1000 AND doxy IS NOT NULL)"""))
def aggregate_statistics(lake):
    core = stats.aggregate_statistics(
        lake.profiles, lake.bgc_profiles, 50, 300, "temp", "1996-01-01", "2000-06-30"
    )
    bgc = stats.aggregate_statistics(lake.profiles, lake.bgc_profiles, 0, 1000, "DOXY")
    return core.unionByName(bgc)


@query("aggregate_statistics_levels", f"""
    SELECT 'temp' AS parameter, {STATS} FROM (
      SELECT l_extendedprice / 3500e0 AS v, l_orderkey AS id FROM lineitem
      WHERE l_linenumber <> 7 AND l_quantity BETWEEN 5 AND 40
        AND l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-06-30')""")
def aggregate_statistics_levels(spark, sf_dir):
    levels = fixtures.measured_levels(spark, sf_dir)
    return stats.level_statistics(levels, 5, 40, "temp", "1996-01-01", "2000-06-30")


@on_lake("dataset_metadata", sql.query(sql.FLOATS, f"""
    SELECT (SELECT count(*) FROM floats) AS floats,
      (SELECT count(*) FROM floats WHERE has_bgc) AS bgc_floats,
      (SELECT count(*) FROM core) AS profiles, (SELECT count(*) FROM bgc) AS bgc_profiles,
      (SELECT {sql.iso('min(ts)')} FROM prof) AS first_date,
      (SELECT {sql.iso('max(ts)')} FROM prof) AS last_date"""))
def dataset_metadata(lake):
    return stats.dataset_metadata(*_tables(lake)).selectExpr(
        "floats", "bgc_floats", "profiles", "bgc_profiles", *DATES
    )


@on_lake("collection_stats", sql.query(sql.DOCS, """
    SELECT collection, count(*) AS documents FROM docs GROUP BY collection"""))
def collection_stats(lake):
    return stats.collection_stats(documents.build_documents(*_tables(lake)))


@on_lake("embed_run_summary", sql.query(sql.DOCS, """
    SELECT count(*) AS processed, count(*) FILTER (WHERE document IS NULL) AS errors,
      count(*) FILTER (WHERE collection = 'profiles') AS profiles_count,
      count(*) FILTER (WHERE collection = 'bgc_profiles') AS bgc_profiles_count,
      count(*) FILTER (WHERE collection = 'floats') AS floats_count FROM docs"""))
def embed_run_summary(lake):
    return stats.embed_run_summary(documents.build_documents(*_tables(lake)))


# --- text features ---------------------------------------------------------------------


@on_profiles("detect_region", f"""
    SELECT profile_id, {sql.region('latitude', 'longitude')} AS region FROM named""", sql.KEYED)
def detect_region(p):
    return p.selectExpr("profile_id", f"{tx.detect_region('latitude', 'longitude')} as region")


@on_profiles("format_dates", f"""
    SELECT profile_id, {sql.long_date('ts')} AS date, {sql.month_year('ts')} AS month_year
    FROM named""", sql.KEYED)
def format_dates(p):
    return p.selectExpr("profile_id", f"{tx.format_date('timestamp')} as date",
                        f"{tx.format_month_year('timestamp')} as month_year")


@on_profiles("data_mode_label", f"SELECT profile_id, {sql.MODE} AS label FROM named", sql.KEYED)
def data_mode_label(p):
    return p.selectExpr("profile_id", f"{tx.data_mode_label('data_mode')} as label")


@on_lake("profile_summary", sql.query(sql.LEVELS, f"""
    SELECT profile_id, {sql.PROFILE_SUMMARY} AS document FROM prof
    WHERE file_type <> 'synthetic_bgc'"""))
def profile_summary(lake):
    return lake.profiles.selectExpr("profile_id", f"{tx.profile_summary()} as document")


@on_lake("profile_metadata", sql.query(sql.LEVELS, f"""
    SELECT profile_id, platform_number, coalesce(cycle_number, 0) AS cycle_number, data_mode,
      file_type, has_bgc AS contains_bgc, {sql.region('latitude', 'longitude')} AS region, n_levels,
      latitude, longitude, max_pres, CAST(year(ts) AS INTEGER) AS year,
      CAST(month(ts) AS INTEGER) AS month, array_to_string(stations, ', ') AS station_parameters,
      array_to_string(bgc_parameters, ', ') AS bgc_parameters
    FROM prof WHERE file_type = 'synthetic_bgc'"""))
def profile_metadata(lake):
    fields = ["profile_id", "platform_number", "cycle_number", "data_mode", "file_type",
              "contains_bgc", "region", "n_levels", "latitude", "longitude", "max_pres", "year",
              "month"]
    return lake.bgc_profiles.selectExpr(f"{tx.profile_metadata()} as m").select("m.*").selectExpr(
        *fields, joined("station_parameters"), joined("bgc_parameters")
    )


@on_lake("float_summary", sql.query(sql.FLOATS, f"""
    SELECT platform_number, {sql.FLOAT_SUMMARY} AS document FROM floats"""))
def float_summary(lake):
    return lake.floats.selectExpr("platform_number", f"{tx.float_summary()} as document")


@on_lake("float_metadata", sql.query(sql.FLOATS, f"""
    SELECT platform_number, platform_type, has_bgc, total_cycles,
      CASE WHEN min_lon IS NOT NULL THEN (min_lat + max_lat) / 2 END AS center_lat,
      CASE WHEN min_lat IS NOT NULL THEN (min_lon + max_lon) / 2 END AS center_lon,
      CASE WHEN min_lat IS NOT NULL AND min_lon IS NOT NULL
        THEN {sql.region('(min_lat + max_lat) / 2', '(min_lon + max_lon) / 2')} END AS region,
      project_name, pi_name, nullif(bgc_parameters, '') AS bgc_parameters,
      nullif(data_modes_used, '') AS data_modes FROM floats"""))
def float_metadata(lake):
    return lake.floats.selectExpr(f"{tx.float_metadata()} as m").select("m.*").selectExpr(
        "platform_number", "platform_type", "has_bgc", "total_cycles", "center_lat", "center_lon",
        "region", "project_name", "pi_name", joined("bgc_parameters"), joined("data_modes"),
    )


def _shown(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("collection", "id", "document", "metadata.region as region")


@on_lake("build_profile_documents", sql.query(sql.DOCS, """
    SELECT collection, id, document, region FROM docs WHERE collection = 'bgc_profiles'"""))
def build_profile_documents(lake):
    return _shown(documents.profile_documents(lake.bgc_profiles, "bgc_profiles"))


@on_lake("build_float_documents", sql.query(sql.DOCS, """
    SELECT collection, id, document, region FROM docs WHERE collection = 'floats'"""))
def build_float_documents(lake):
    return _shown(documents.float_documents(lake.floats))


@on_lake("build_documents", sql.query(sql.DOCS, "SELECT collection, id, document, region FROM docs"))
def build_documents(lake):
    return _shown(documents.build_documents(*_tables(lake)))


# --- embedding and search --------------------------------------------------------------

WORDS = sql.words("documents", "doc_id", "text")


@query("embed_documents", f"""
    SELECT doc_id AS id, count(*) AS buckets_used, round(max(n) / sqrt(sum(n * n)), 4) AS top_value,
      min(bucket) AS first_bucket, max(bucket) AS last_bucket
    FROM ({WORDS}) GROUP BY doc_id
    UNION ALL SELECT doc_id, 0, 0, NULL, NULL FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM ({WORDS}))""")
def embed_documents(spark, sf_dir):
    texts = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr(
        "doc_id as id", "text as document"
    ))
    vecs = vectors.embed_documents(texts).selectExpr(
        "id", "embedding as v", "filter(transform(embedding, (x, i) -> if(x <> 0, i, -1)), i -> i >= 0) as used"
    )
    # words are counted, so a vector with any word has a positive maximum
    return vecs.selectExpr(
        "id", "cast(size(used) as bigint) as buckets_used",
        "round(cast(array_max(v) as double), 4) as top_value",
        "cast(get(used, 0) as bigint) as first_bucket",
        "cast(try_element_at(used, -1) as bigint) as last_bucket",
    )


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").selectExpr(
        "vec_id as id", "embedding", "named_struct('label', label) as metadata",
        "element_at(array('profiles', 'bgc_profiles', 'floats'), cast(vec_id % 3 as int) + 1) "
        "as collection",
    )


def _centroids(corpus: DataFrame) -> DataFrame:
    """One query per label: the mean of its vectors, from partial sums per dimension."""
    means = (
        corpus.selectExpr("metadata.label as query_id", "posexplode(embedding) as (dim, x)")
        .groupBy("query_id", "dim")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
    )
    # at most one value per dimension: a bounded group
    rows = means.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("dim", "x"))).alias("r"))
    return rows.select("query_id", F.col("r.x").alias("vector"))


KNN = """WITH parts AS (
  SELECT label AS query_id, unnest(range(1, 65)) AS dim, unnest(embedding) AS x FROM embeddings
), means AS (SELECT query_id, dim, avg(CAST(x AS DOUBLE)) AS x FROM parts GROUP BY ALL
), centroid AS (SELECT query_id, list(x ORDER BY dim) AS vector FROM means GROUP BY query_id
), hits AS (
  SELECT c.query_id, e.vec_id AS id, e.label,
    ['profiles', 'bgc_profiles', 'floats'][e.vec_id % 3 + 1] AS collection,
    round(1 - list_cosine_similarity(c.vector, CAST(e.embedding AS DOUBLE[])), 12) AS distance
  FROM centroid c CROSS JOIN embeddings e
)"""


def knn(n: int, where: str = "true", by: str = "") -> str:
    return f"""{KNN} SELECT query_id, id, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id{by} ORDER BY distance, id) AS rank
          FROM hits WHERE {where}) WHERE rank <= {n}"""


HIT = ["query_id", "id", "rank", "round(distance, 6) as distance"]


@query("semantic_search", knn(10))
def semantic_search(spark, sf_dir):
    corpus = _vectors(spark, sf_dir)
    return vectors.semantic_search(corpus, _centroids(corpus), 10).selectExpr(*HIT)


@query("hybrid_search", knn(10, "label >= 3 AND label <> 7 OR label = 1"))
def hybrid_search(spark, sf_dir):
    corpus = _vectors(spark, sf_dir)
    where = {"$or": [{"label": {"$gte": 3, "$ne": 7}}, {"label": 1}]}
    return vectors.semantic_search(corpus, _centroids(corpus), 10, where).selectExpr(*HIT)


@query("search_all", f"""{KNN}, best AS (
    SELECT *, row_number() OVER (PARTITION BY query_id, collection ORDER BY distance, id) AS r
    FROM hits)
  SELECT query_id, collection, id, round(distance, 6) AS distance, CAST(row_number() OVER (
    PARTITION BY query_id ORDER BY distance, collection, id) AS INTEGER) AS rank
  FROM best WHERE r <= 5""")
def search_all(spark, sf_dir):
    corpus = _vectors(spark, sf_dir)
    return vectors.search_all(corpus, _centroids(corpus), 5).selectExpr(*HIT, "collection")


def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the stored tables with their vectors, written once per session."""
    store = fixture_store(spark, sf_dir)
    if not store.exists("documents"):
        docs = documents.build_documents(*_tables(Lake.of(store)))
        docstore.upsert_documents(store, vectors.embed_documents(docs))
    return store.read("documents")


TEXTS = ["salinity profiles near the equator", "deep ocean profiles in delayed mode"]
TEXT_HITS = sql.DOCS + sql.text_search("docs", TEXTS)


def _text_hits(spark, sf_dir, texts, n, collection, where=None, contains=None) -> DataFrame:
    corpus = embedded(spark, sf_dir).where(F.col("collection") == collection)
    hits = vectors.semantic_search(
        corpus, vectors.text_queries(spark, texts), n, where, contains, few=True
    )
    return vectors.with_documents(hits, corpus, ["id"])


@query("document_filter", sql.query(TEXT_HITS, """
    SELECT query_id, CAST(rank AS INTEGER) AS rank, round(distance, 4) AS distance FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM hits
      WHERE collection = 'floats' AND contains(document, 'PROVOR')) WHERE rank <= 10"""))
def document_filter(spark, sf_dir):
    hits = _text_hits(spark, sf_dir, TEXTS, 10, "floats", contains="PROVOR")
    return hits.selectExpr("query_id", "rank", "round(distance, 4) as distance")


@query("search_profiles", sql.query(TEXT_HITS, """
    SELECT query_id, CAST(rank AS INTEGER) AS rank, round(1 - distance, 2) AS relevance FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM hits
      WHERE collection = 'profiles') WHERE rank <= 5"""))
def search_profiles(spark, sf_dir):
    from profilelake.plans.engine import search_rows

    hits = _text_hits(spark, sf_dir, TEXTS, 5, "profiles")
    return search_rows(hits).select("query_id", "rank", "relevance")


@query("search_bgc_profiles", sql.query(
    sql.DOCS + sql.text_search("docs", ["BGC profile measuring DOXY dissolved oxygen chlorophyll"]),
    """SELECT CAST(rank AS INTEGER) AS rank, round(1 - distance, 2) AS relevance FROM (
      SELECT h.*, row_number() OVER (ORDER BY distance, h.id) AS rank
      FROM hits h JOIN bgc b ON h.id = b.profile_id AND b.has_bgc
      WHERE collection = 'bgc_profiles') WHERE rank <= 5"""))
def search_bgc_profiles(spark, sf_dir):
    from profilelake.plans.engine import Engine

    embedded(spark, sf_dir)
    engine = Engine(fixture_store(spark, sf_dir))
    return engine.search_bgc_profiles("doxy", 5).select("rank", "relevance")


@query("ann_search", """
    SELECT count(DISTINCT label) AS queries, true AS complete, true AS exact, true AS recalled
    FROM embeddings""")
def ann_search(spark, sf_dir):
    """For the centroids of all labels: ten rows each, true distances, and over all queries
    nine tenths of the nearest rows found."""
    corpus = _vectors(spark, sf_dir)
    queries = _centroids(corpus)
    near = vectors.ann_search(corpus, queries, 10).select("query_id", "id", "distance")
    true = vectors.semantic_search(corpus, queries, 10).selectExpr(
        "query_id", "id", "distance as true_distance"
    )
    per_query = near.join(true, ["query_id", "id"], "full_outer").groupBy("query_id").agg(
        F.count("distance").alias("hits"),
        F.count("true_distance").alias("wanted"),
        F.expr("count_if(distance is not null and true_distance is not null)").alias("found"),
        F.expr("bool_and(coalesce(abs(distance - true_distance) < 1e-9, true))").alias("exact"),
    )
    return per_query.agg(
        F.count("*").alias("queries"),
        F.expr("bool_and(hits = wanted)").alias("complete"),
        F.expr("bool_and(exact)").alias("exact"),
        F.expr("sum(found) >= 0.9 * sum(wanted)").alias("recalled"),
    )


# --- retrieval -------------------------------------------------------------------------


@on_lake("float_info", sql.query(sql.FLOATS, f"""
    SELECT platform_number, platform_type, project_name, pi_name, data_centre, total_cycles,
      has_bgc, bgc_parameters, {BOX}, data_modes_used FROM floats"""))
def float_info(lake):
    return lookup.float_info(lake.floats).selectExpr(
        "platform_number", "platform_type", "project_name", "pi_name", "data_centre",
        "total_cycles", "has_bgc", joined("bgc_parameters"), "first_date", "last_date",
        *(f"geo_bounding_box.{c}" for c in CORNERS), joined("data_modes_used"),
    )


@on_lake("float_profiles", sql.query(sql.LEVELS, f"""
    , tagged AS (SELECT *, CASE WHEN file_type = 'synthetic_bgc' THEN 'bgc' ELSE 'core' END AS source
      FROM prof)
    SELECT platform_number, source, profile_id, cycle_number, {sql.iso('ts')} AS timestamp, n_levels,
      CAST(position AS INTEGER) AS position, total_core, total_bgc
    FROM (SELECT *, row_number() OVER (PARTITION BY platform_number, source
            ORDER BY cycle_number NULLS FIRST, profile_id) AS position
          FROM tagged WHERE ts >= TIMESTAMP '1996-03-01')
    JOIN (SELECT platform_number, count(*) FILTER (WHERE source = 'core') AS total_core,
            count(*) FILTER (WHERE source = 'bgc') AS total_bgc
          FROM tagged GROUP BY platform_number) USING (platform_number)
    WHERE position <= 3"""))
def float_profiles(lake):
    return lookup.float_profiles(
        lake.profiles, lake.bgc_profiles, limit=3, start_date="1996-03"
    ).selectExpr(
        "platform_number", "source", "profile_id", "cycle_number",
        f"{cl.iso_date('timestamp')} as timestamp", "n_levels", "position", "total_core", "total_bgc",
    )


REQUESTED = """, wanted AS (
  SELECT replace(profile_id, '_BGC', '') || CASE WHEN k % 5 = 0 THEN '_BGC' ELSE '' END AS asked
  FROM prof
), answers AS (
  SELECT asked, coalesce(c.profile_id, b.profile_id, s.profile_id) AS profile_id,
    CASE WHEN c.profile_id IS NOT NULL THEN 'core' ELSE 'bgc' END AS source
  FROM wanted LEFT JOIN prof c ON c.profile_id = asked AND c.file_type <> 'synthetic_bgc'
  LEFT JOIN prof b ON b.profile_id = asked AND b.file_type = 'synthetic_bgc'
  LEFT JOIN prof s ON s.profile_id = asked || '_BGC' AND NOT ends_with(asked, '_BGC')
    AND s.file_type = 'synthetic_bgc'
  WHERE coalesce(c.profile_id, b.profile_id, s.profile_id) IS NOT NULL
)"""


def asked_ids(lake: Lake) -> DataFrame:
    """An id for every profile, many without their suffix and some with one too many."""
    suffix = (
        "if(coalesce(cycle_number, cast(substring(platform_number, 2) as int)) % 5 = 0, '_BGC', '')"
    )
    fields = ["profile_id", "cycle_number", "platform_number"]
    both = lake.profiles.select(*fields).unionByName(lake.bgc_profiles.select(*fields))
    return both.selectExpr(f"concat(replace(profile_id, '_BGC', ''), {suffix}) as profile_id")


@on_lake("lookup_profile", sql.query(sql.LEVELS + REQUESTED, """
    SELECT asked AS requested_id, profile_id, source FROM answers"""))
def lookup_profile(lake):
    return lookup.lookup_profiles(
        lake.profiles, lake.bgc_profiles, asked_ids(lake), ["platform_number"]
    ).select("requested_id", "profile_id", "source")


@on_lake("profile_data", sql.query(sql.LEVELS + REQUESTED, """
    SELECT asked AS requested_id, a.profile_id, n_levels AS total_levels,
      least(5, n_levels) AS showing_levels, level, pres AS depth_m,
      CASE WHEN p.k % 5 = 0 THEN temp ELSE temp_adjusted END AS temp,
      CASE WHEN p.k % 5 <> 0 THEN 2 END AS temp_qc, psal, CAST(NULL AS INTEGER) AS psal_qc,
      p.latitude, p.longitude, array_to_string(p.stations, ', ') AS station_parameters,
      p.data_mode, p.max_pres
    FROM answers a JOIN prof p ON p.profile_id = a.profile_id JOIN lev USING (k)
    WHERE level < 5"""))
def profile_data(lake):
    return lookup.profile_data(
        lake.profiles, lake.bgc_profiles, asked_ids(lake), "temp,psal", True, max_levels=5
    ).drop("platform_number", "cycle_number", "timestamp").withColumn(
        "station_parameters", F.array_join("station_parameters", ", ")
    )


@on_lake("date_filter", sql.query(sql.LEVELS, """
    SELECT profile_id FROM prof WHERE file_type <> 'synthetic_bgc'
      AND ts >= TIMESTAMP '1997-05-01' AND ts <= TIMESTAMP '1999-12-31 12:00:00'"""))
def date_filter_query(lake):
    return dated(lake.profiles, "1997-05", "1999-12-31T12:00:00Z").select("profile_id")


HAVERSINE = """(2 * 6378.1 * asin(sqrt(least(1, pow(sin(radians(latitude - lat) / 2), 2)
  + cos(radians(lat)) * cos(radians(latitude)) * pow(sin(radians(longitude - lon) / 2), 2)))))"""


def nearest_oracle(points: str, km: int, n: int) -> str:
    return sql.query(sql.LEVELS, f"""
    , points AS ({points}), near AS (
      SELECT * FROM (SELECT *, {HAVERSINE} AS km FROM prof, points
        WHERE file_type <> 'synthetic_bgc' AND latitude IS NOT NULL AND longitude IS NOT NULL)
      WHERE km <= {km}
      QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY km, profile_id) <= {n}
    ), closest AS (
      SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY point_id, platform_number
        ORDER BY km, profile_id) = 1)
    SELECT point_id, CAST(row_number() OVER (PARTITION BY point_id ORDER BY km, profile_id) AS INTEGER)
      AS rank, platform_number, profile_id AS sample_profile_id, round(km, 3) AS distance_km,
      count(*) OVER (PARTITION BY point_id) AS unique_floats
    FROM closest QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY km, profile_id) <= 20""")


NEAR = ["rank", "platform_number", "sample_profile_id", "round(distance_km, 3) as distance_km",
        "unique_floats"]


@on_lake("nearest_floats", nearest_oracle("SELECT 0 AS point_id, 10e0 AS lat, 60e0 AS lon", 500, 100))
def nearest_floats(lake):
    return nearest.nearest_floats(lake.profiles, 10.0, 60.0, 500).selectExpr("0 as point_id", *NEAR)


@query("nearest_join", nearest_oracle("""
    SELECT s_suppkey AS point_id, (s_suppkey * 37 % 901) / 10e0 - 62e0 AS lat,
      (s_suppkey * 131 % 1201) / 10e0 + 10e0 AS lon FROM supplier""", 800, 100))
def nearest_join(spark, sf_dir):
    points = spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr(
        "s_suppkey as point_id", "(s_suppkey * 37 % 901) / 10e0 - 62e0 as lat",
        "(s_suppkey * 131 % 1201) / 10e0 + 10e0 as lon",
    )
    lake = fixture_lake(spark, sf_dir)
    return nearest.nearest_join(lake.profiles, points, 800).selectExpr("point_id", *NEAR)


# --- chart series ----------------------------------------------------------------------


@on_lake("trajectory", sql.query(sql.LEVELS, f"""
    SELECT platform_number, profile_id, cycle_number, latitude AS lat, longitude AS lon,
      {sql.iso('ts')} AS date, count(*) OVER w AS total_points,
      row_number() OVER (w ORDER BY cycle_number NULLS FIRST, profile_id) = 1 AS is_start,
      row_number() OVER (w ORDER BY cycle_number DESC NULLS LAST, profile_id DESC) = 1 AS is_end
    FROM prof WHERE file_type <> 'synthetic_bgc' AND latitude IS NOT NULL AND longitude IS NOT NULL
    WINDOW w AS (PARTITION BY platform_number)"""))
def trajectory(lake):
    return series.trajectory(lake.profiles)


LABEL = "platform_number || '@c' || coalesce(CAST(cycle_number AS VARCHAR), '?') AS label"
SERIES = ["profile_id", "label", "level"]


@on_lake("depth_series", sql.query(sql.LEVELS, f"""
    SELECT profile_id, {LABEL}, level, 'temp' AS parameter, pres AS depth, temp AS value FROM lev
    WHERE pres IS NOT NULL AND temp IS NOT NULL
    UNION ALL SELECT profile_id, {LABEL}, level, 'doxy', pres, doxy FROM lev
    WHERE pres IS NOT NULL AND doxy IS NOT NULL"""))
def depth_series(lake):
    return series.depth_series(lake.profiles, lake.bgc_profiles, None, "temp,doxy").select(
        *SERIES, "parameter", "depth", "value"
    )


@on_lake("ts_pairs", sql.query(sql.LEVELS, f"""
    SELECT profile_id, {LABEL}, level, psal AS salinity, temp AS temperature FROM lev
    WHERE pres IS NOT NULL AND temp IS NOT NULL AND psal IS NOT NULL"""))
def ts_pairs(lake):
    return series.ts_pairs(lake.profiles, lake.bgc_profiles, None).select(
        *SERIES, "salinity", "temperature"
    )


@on_lake("compare_series", sql.query(sql.LEVELS + REQUESTED, f"""
    SELECT asked AS requested_id, a.profile_id, {LABEL}, level, pres AS depth, psal AS value
    FROM answers a JOIN lev ON lev.profile_id = a.profile_id
    WHERE pres IS NOT NULL AND psal IS NOT NULL"""))
def compare_series(lake):
    return series.compare_series(lake.profiles, lake.bgc_profiles, asked_ids(lake), "psal").select(
        "requested_id", *SERIES, "depth", "value"
    )


@on_lake("scatter_pairs", sql.query(sql.LEVELS, f"""
    SELECT profile_id, {LABEL}, level, chla AS x, doxy AS y FROM lev
    WHERE pres IS NOT NULL AND chla IS NOT NULL AND doxy IS NOT NULL"""))
def scatter_pairs(lake):
    return series.scatter_pairs(lake.profiles, lake.bgc_profiles, None, "chla", "doxy").select(
        *SERIES, "x", "y"
    )


@on_lake("markers", sql.query(sql.LEVELS, f"""
    SELECT profile_id, platform_number, latitude AS lat, longitude AS lon, {sql.iso('ts')} AS date,
      cycle_number, latitude IS NOT NULL AND longitude IS NOT NULL AS drawable FROM prof"""))
def markers(lake):
    return series.markers(lake.profiles, lake.bgc_profiles, None).drop("requested_id", "position")


@on_lake("chart_spec", sql.query(sql.LEVELS, """
    SELECT profile_id, '{"type":"chart_depth_profile","params":{"profile_id":"' || profile_id
      || '","parameters":["temp","psal"]}}' AS chart_spec,
      'Depth profile chart for TEMP, PSAL on profile ' || profile_id || ' (float '
        || platform_number || ', cycle ' || coalesce(CAST(cycle_number AS VARCHAR), 'None')
        || ', date: ' || coalesce(""" + sql.iso("ts") + """, 'None') AS summary_start FROM prof"""))
def chart_spec(lake):
    return series.depth_spec(lake.profiles, lake.bgc_profiles, None, "temp, psal").selectExpr(
        "profile_id", "chart_spec", "substring_index(summary, ', lat: ', 1) as summary_start"
    )


def _listed(lake: Lake) -> list[str]:
    """Four ids to draw together: the last of the core table, then the first of the BGC table."""
    core = lake.profiles.select("profile_id").orderBy(F.desc("profile_id")).limit(2)
    bgc = lake.bgc_profiles.select("profile_id").orderBy("profile_id").limit(2)
    return [r.profile_id for part in (core, bgc) for r in part.collect()]


LISTED = f""", listed AS (
  SELECT * FROM (SELECT *, row_number() OVER (ORDER BY profile_id DESC) AS place FROM prof
    WHERE file_type <> 'synthetic_bgc') WHERE place <= 2
  UNION ALL SELECT * FROM (SELECT *, 2 + row_number() OVER (ORDER BY profile_id) AS place FROM prof
    WHERE file_type = 'synthetic_bgc') WHERE place <= 4
), facts AS (
  SELECT count(*) AS n, string_agg(profile_id, ', ' ORDER BY place) AS ids,
    string_agg(label, ', ' ORDER BY place) AS labels,
    string_agg('"' || profile_id || '"', ',' ORDER BY place) AS id_list,
    string_agg('"' || label || '"', ',' ORDER BY place) AS label_list
  FROM (SELECT *, {LABEL} FROM listed)
)"""

SPECS = """
    SELECT 'T-S Diagram for ' || n || ' profile(s): ' || ids || '.' AS summary,
      '{"type":"chart_ts_diagram","params":{"profile_ids":[' || id_list || '],"labels":['
        || label_list || ']}}' AS chart_spec FROM facts
    UNION ALL SELECT 'Comparing DOXY vs depth for ' || n || ' profiles: ' || labels || '.',
      '{"type":"chart_comparison","params":{"profile_ids":[' || id_list
        || '],"parameter":"doxy","labels":[' || label_list || ']}}' FROM facts
    UNION ALL SELECT 'CHLA vs DOXY scatter for ' || n || ' profile(s): ' || labels || '.',
      '{"type":"chart_parameter_scatter","params":{"profile_ids":[' || id_list
        || '],"param_x":"chla","param_y":"doxy","labels":[' || label_list || ']}}' FROM facts
    UNION ALL SELECT 'Map with ' || n || ' profile markers.',
      '{"type":"map_markers","ids":[' || id_list || ']}' FROM facts"""


@on_lake("list_specs", sql.query(sql.LEVELS + LISTED, SPECS))
def list_specs(lake):
    tables_ = (lake.profiles, lake.bgc_profiles, _listed(lake))
    charts = series.ts_spec(*tables_).unionByName(
        series.comparison_spec(*tables_, "DOXY")
    ).unionByName(series.scatter_spec(*tables_, "chla", "doxy"))
    # numbers in the positions print differently in SQL; the ids show order and completeness
    ids = ("to_json(struct('map_markers' as type, from_json(chart_spec, "
           "'params struct<profile_ids: array<string>>').params.profile_ids as ids)) as chart_spec")
    return charts.unionByName(series.markers_spec(*tables_).selectExpr("summary", ids))


@on_lake("trajectory_spec", sql.query(sql.FLOATS, """
    SELECT platform_number, '{"type":"map_trajectory","params":{"platform_number":"'
      || platform_number || '","total_points":' || coalesce(n, 0) || '}}' AS chart_spec,
      'Float ' || platform_number || ' (' || coalesce(platform_type, '?') || '): ' || total_cycles
        || ' cycles from' AS summary_start,
      'Trajectory has ' || coalesce(n, 0) || ' data points.' AS summary_end
    FROM floats LEFT JOIN (SELECT platform_number, count(*) AS n FROM core GROUP BY ALL)
      USING (platform_number)"""))
def trajectory_spec(lake):
    return series.trajectory_spec(lake.profiles, lake.floats).selectExpr(
        "platform_number", "chart_spec", "regexp_extract(summary, '^.* cycles from', 0) as summary_start",
        "regexp_extract(summary, 'Trajectory has.*', 0) as summary_end",
    )


# --- checks ----------------------------------------------------------------------------


@on_lake("check_tables", sql.query(sql.FLOATS, """
    , has_measure AS (SELECT DISTINCT k FROM lev WHERE coalesce(doxy, chla) IS NOT NULL)
    , found(check_name, rows, violations) AS (
      SELECT 'core_required_fields', count(*), count(*) FILTER (WHERE cycle_number IS NULL
        OR latitude IS NULL OR longitude IS NULL) FROM core
      UNION ALL SELECT 'core_measurements', count(*), count(*) FILTER (WHERE n_levels = 0) FROM core
      UNION ALL SELECT 'bgc_required_fields', count(*), 0 FROM bgc
      UNION ALL SELECT 'bgc_extra_parameters', count(*), count(*) FILTER (WHERE h.k IS NULL)
        FROM bgc LEFT JOIN has_measure h USING (k) WHERE has_bgc
      UNION ALL SELECT 'float_required_fields', count(*), 0 FROM floats
      UNION ALL SELECT 'float_key_unique', count(*), 0 FROM floats)
    SELECT check_name, rows, violations, rows > 0 AND violations = 0 AS passed FROM found"""))
def check_tables(lake):
    return checks.check_tables(*_tables(lake))


@on_lake("check_counts", sql.query(sql.DOCS, """
    SELECT collection, documents, minimum, documents > minimum AS passed FROM (
      SELECT collection, count(*) AS documents, CAST(CASE collection WHEN 'profiles' THEN 87000
        WHEN 'bgc_profiles' THEN 13000 ELSE 500 END AS BIGINT) AS minimum
      FROM docs GROUP BY collection)"""))
def check_counts(lake):
    return checks.check_counts(documents.build_documents(*_tables(lake)))


# The labelled searches.
LABELLED = {
    "profiles": ("salinity profiles near the equator", "true"),
    "bgc_profiles": ("BGC float with dissolved oxygen data", "metadata.contains_bgc"),
    "floats": ("floats operating in the Arabian Sea", "metadata.region = 'Arabian Sea'"),
}


@query("check_search", sql.query(
    sql.DOCS + sql.text_search("docs", [text for text, _ in LABELLED.values()]), """
    SELECT h.collection, CASE h.query_id WHEN 0 THEN true WHEN 1 THEN b.has_bgc
      ELSE coalesce(h.region = 'Arabian Sea', false) END AS passed
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS r FROM hits
          WHERE collection = ['profiles', 'bgc_profiles', 'floats'][query_id + 1]) h
    LEFT JOIN bgc b ON h.id = b.profile_id WHERE r = 1"""))
def check_search(spark, sf_dir):
    corpus = embedded(spark, sf_dir)
    queries = vectors.text_queries(spark, [text for text, _ in LABELLED.values()])
    hits = vectors.semantic_search(corpus, queries, 3, by="collection", few=True)
    asked = F.array(*map(F.lit, LABELLED))
    hits = hits.where(F.get(asked, F.col("query_id")) == F.col("collection"))
    return checks.check_search(
        vectors.with_documents(hits, corpus, ["collection", "id"]),
        {i: predicate for i, (_, predicate) in enumerate(LABELLED.values())},
    ).select(F.get(asked, F.col("query_id")).alias("collection"), "passed")


@query("check_hybrid", sql.query(sql.LEVELS, f"""
    SELECT least(3, count(*)) AS hits, CAST(0 AS BIGINT) AS wrong_region, count(*) > 0 AS passed
    FROM prof WHERE file_type <> 'synthetic_bgc'
      AND {sql.region('latitude', 'longitude')} = 'Bay of Bengal'"""))
def check_hybrid(spark, sf_dir):
    region = "Bay of Bengal"
    hits = _text_hits(spark, sf_dir, ["deep ocean profiles"], 3, "profiles", {"region": region})
    return checks.check_hybrid(hits, region)

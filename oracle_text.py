"""SQL for DuckDB that derives the expected results straight from the given tables.

The common part describes the profiles the fixtures encode, without any of the dirt the
Spark side has to clean away first.
"""

RAW = """
o AS (
  SELECT o_orderkey AS k, o_orderkey // 2 AS f, o_orderkey % 2 AS h, o_custkey AS c,
         o_orderstatus AS s, CAST(o_orderdate AS DATE) AS d,
         ['D', 'R', 'SD', 'SR', 'BD', 'BR'][(o_orderkey // 2) % 6 + 1]
           || CAST(o_orderkey // 2 AS VARCHAR) || '.nc' AS source_file,
         ['core', 'core', 'synthetic_bgc', 'synthetic_bgc', 'bgc', 'bgc'][(o_orderkey // 2) % 6 + 1]
           AS file_type
  FROM orders
), landed AS (
  SELECT *, CASE WHEN f % 103 <> 0 OR f % 101 = 0 THEN CAST(h AS INTEGER) END AS profile_index,
         CASE WHEN f % 101 = 0 THEN 'unreadable file' END AS parse_error
  FROM o WHERE (f % 101 <> 0 AND f % 103 <> 0) OR h = 0
), raw AS (
  SELECT * FROM landed WHERE parse_error IS NULL AND profile_index IS NOT NULL AND k % 53 <> 0
)"""

KEYED = RAW + """, keyed AS (
  SELECT *,
    CASE WHEN k % 211 = 0 THEN '9' || k ELSE CAST(c AS VARCHAR) END AS platform_number,
    CASE WHEN k % 211 <> 0 THEN CAST(k AS INTEGER) END AS cycle_number,
    CASE WHEN k % 10 = 0 THEN 'D' WHEN k % 10 <> 1 THEN 'A' END AS direction,
    CASE WHEN k % 29 <> 0 THEN CASE s WHEN 'F' THEN 'D' WHEN 'O' THEN 'R' ELSE 'A' END END
      AS data_mode,
    CASE WHEN k % 61 <> 0 AND k % 67 <> 0 AND k % 71 <> 0
      THEN CAST(d AS TIMESTAMP) + to_hours(k % 24) END AS ts,
    CASE WHEN k % 97 <> 0 AND k % 89 <> 0 THEN ((k * 7919) % 9001) / 100e0 - 62e0 END AS latitude,
    CASE WHEN k % 97 <> 0 THEN ((k * 104729) % 12001) / 100e0 + 10e0 END AS longitude,
    f % 6 >= 2 AND k % 41 <> 0 AND k % 43 <> 0 AS has_bgc,
    CASE WHEN f % 6 < 2 OR k % 41 = 0 OR k % 43 = 0 THEN ['PRES', 'TEMP', 'PSAL']
      ELSE ['PRES', 'TEMP', 'PSAL', CASE WHEN k % 7 = 0 THEN 'doxy' ELSE 'DOXY' END, 'CHLA'] END
      AS stations,
    CASE WHEN c % 17 <> 0 THEN 'PROJECT ' || (c % 25) END AS project_name,
    CASE WHEN c % 13 <> 0 THEN 'PI ' || (c % 50) END AS pi_name,
    ['APEX', 'PROVOR', 'ARVOR', NULL][c % 4 + 1] AS platform_type,
    CAST(840 + c % 10 AS VARCHAR) AS wmo_inst_type,
    CASE WHEN c % 3 = 0 THEN 'IN' ELSE 'IF' END AS data_centre,
    CASE WHEN k % 4 <> 0 THEN 'A' END AS profile_pres_qc,
    CASE WHEN k % 3 <> 0 THEN 'B' END AS profile_temp_qc,
    CASE WHEN k % 4 = 1 THEN 'F' END AS profile_psal_qc
  FROM raw
), named AS (
  SELECT *, CASE WHEN has_bgc THEN ['DOXY', 'CHLA'] END AS bgc_parameters,
    platform_number || '_' || printf('%03d', coalesce(cycle_number, 0))
      || CASE WHEN direction = 'D' THEN 'D' ELSE '' END
      || CASE WHEN file_type = 'synthetic_bgc' THEN '_BGC' ELSE '' END AS profile_id
  FROM keyed
)"""

LEVELS = KEYED + """, axis AS (
  SELECT *, unnest(range(0, CASE WHEN k % 37 = 0 OR k % 47 = 0 THEN 0 ELSE k % 9 + 1 END)) AS i
  FROM named
), measured AS (
  SELECT *,
    CASE WHEN (k + i) % 23 <> 0 AND (k + i) % 31 <> 0 THEN i * 50e0 + k % 50 END AS pres,
    CASE WHEN (k + i) % 23 <> 0 AND (k + i) % 13 <> 0
      THEN 28e0 - i * 2e0 + (k % 100) / 100e0 END AS temp,
    CASE WHEN (k + i) % 23 <> 0 AND (k + i) % 17 <> 0
      THEN 34e0 + ((k + i) % 200) / 100e0 END AS psal,
    CASE WHEN has_bgc AND (k + i) % 19 <> 0 THEN 200e0 - i * 5e0 + k % 20 END AS doxy,
    CASE WHEN has_bgc THEN ((k + i) % 50) / 10e0 END AS chla,
    [1, 4, -1, -1][(k + i) % 4 + 1] AS cyclic_qc,
    CASE WHEN k % 5 <> 0 AND (k + i) % 11 <> 0 THEN 28e0 - i * 2e0 END AS temp_adjusted
  FROM axis
), lev AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY k ORDER BY i) - 1 AS INTEGER) AS level FROM measured
  WHERE coalesce(pres, temp, psal) IS NOT NULL OR coalesce(doxy, chla) IS NOT NULL
), prof AS (
  SELECT n.*, coalesce(x.n_levels, 0) AS n_levels, x.max_pres
  FROM named n LEFT JOIN (
    SELECT k, CAST(count(*) AS INTEGER) AS n_levels, max(pres) AS max_pres FROM lev GROUP BY k
  ) x USING (k)
)"""

FLOATS = LEVELS + """, core AS (SELECT * FROM prof WHERE file_type <> 'synthetic_bgc'
), bgc AS (SELECT * FROM prof WHERE file_type = 'synthetic_bgc'
), core_rollup AS (
  SELECT platform_number, min_by(coalesce(project_name, ''), profile_id) AS project_name,
    min_by(coalesce(pi_name, ''), profile_id) AS pi_name,
    min_by(coalesce(platform_type, ''), profile_id) AS platform_type,
    min_by(wmo_inst_type, profile_id) AS wmo_inst_type,
    min_by(data_centre, profile_id) AS data_centre,
    count(*) AS total_cycles, min(ts) AS first_date, max(ts) AS last_date,
    min(latitude) AS min_lat, max(latitude) AS max_lat,
    min(longitude) AS min_lon, max(longitude) AS max_lon,
    coalesce(string_agg(DISTINCT data_mode, ', ' ORDER BY data_mode), '') AS data_modes
  FROM core GROUP BY platform_number
), bgc_rollup AS (
  SELECT platform_number, count(*) AS bgc_cycles,
    min_by(coalesce(array_to_string(bgc_parameters, ', '), ''), profile_id) AS bgc_parameters,
    min(ts) AS first_date, max(ts) AS last_date,
    min(latitude) AS min_lat, max(latitude) AS max_lat,
    min(longitude) AS min_lon, max(longitude) AS max_lon
  FROM bgc GROUP BY platform_number
), floats AS (
  SELECT platform_number, nullif(c.project_name, '') AS project_name,
    nullif(c.pi_name, '') AS pi_name, nullif(c.platform_type, '') AS platform_type,
    c.wmo_inst_type, c.data_centre,
    coalesce(c.total_cycles, b.bgc_cycles) AS total_cycles, b.bgc_cycles IS NOT NULL AS has_bgc,
    coalesce(b.bgc_parameters, '') AS bgc_parameters, b.bgc_cycles,
    CASE WHEN c.total_cycles IS NULL THEN b.first_date ELSE c.first_date END AS first_date,
    CASE WHEN c.total_cycles IS NULL THEN b.last_date ELSE c.last_date END AS last_date,
    least(c.min_lat, b.min_lat) AS min_lat, greatest(c.max_lat, b.max_lat) AS max_lat,
    least(c.min_lon, b.min_lon) AS min_lon, greatest(c.max_lon, b.max_lon) AS max_lon,
    coalesce(c.data_modes, '') AS data_modes_used
  FROM core_rollup c FULL OUTER JOIN bgc_rollup b USING (platform_number)
)"""


def region(lat: str, lon: str) -> str:
    return f"""CASE WHEN {lat} IS NULL OR {lon} IS NULL THEN 'Unknown Region'
      WHEN {lat} BETWEEN 5 AND 25 AND {lon} BETWEEN 50 AND 75 THEN 'Arabian Sea'
      WHEN {lat} BETWEEN 5 AND 23 AND {lon} BETWEEN 75 AND 95 THEN 'Bay of Bengal'
      WHEN {lat} BETWEEN -10 AND 10 AND {lon} BETWEEN 40 AND 100 THEN 'Equatorial Indian'
      WHEN {lat} BETWEEN -60 AND -10 AND {lon} BETWEEN 20 AND 120 THEN 'Southern Indian'
      WHEN {lat} BETWEEN -40 AND 10 AND {lon} BETWEEN 30 AND 60 THEN 'Western Indian'
      WHEN {lat} BETWEEN -40 AND 10 AND {lon} BETWEEN 80 AND 120 THEN 'Eastern Indian'
      ELSE 'Indian Ocean' END"""


def iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%SZ')"


def long_date(x: str) -> str:
    return f"coalesce(strftime({x}, '%B %d, %Y'), 'unknown date')"


def month_year(x: str) -> str:
    return f"coalesce(strftime({x}, '%B %Y'), 'unknown')"


def _degrees(x: str, digits: int, pos: str, neg: str) -> str:
    return (
        f"printf('%.{digits}f', abs({x})) || '°' || CASE WHEN {x} >= 0 THEN '{pos}' ELSE '{neg}' END"
    )


MODE = """CASE data_mode WHEN 'D' THEN 'delayed mode (quality-controlled)'
  WHEN 'R' THEN 'real-time mode' WHEN 'A' THEN 'adjusted mode' ELSE 'unknown mode' END"""

PROFILE_SUMMARY = f"""concat_ws(' ',
  'ARGO float ' || platform_number || ', cycle ' || coalesce(CAST(cycle_number AS VARCHAR), '?')
    || ', ' || CASE WHEN direction = 'A' THEN 'ascending' ELSE 'descending' END || ' profile.',
  'Located at ' || coalesce({_degrees('latitude', 2, 'N', 'S')}, 'unknown') || ', '
    || coalesce({_degrees('longitude', 2, 'E', 'W')}, 'unknown') || ' in the '
    || {region('latitude', 'longitude')} || '.',
  'Measured on ' || {long_date('ts')} || ' (' || {month_year('ts')} || ').',
  'Depth range: ' || CASE WHEN max_pres <> 0 THEN '0 to ' || printf('%.0f', max_pres) || ' meters'
    ELSE 'unknown depth' END || ' with ' || n_levels || ' depth levels.',
  'Parameters measured: ' || array_to_string(stations, ', ') || '.',
  'Data mode: ' || {MODE} || '.',
  CASE WHEN has_bgc THEN 'Contains BGC (biogeochemical) data: DOXY, CHLA.' END,
  'Project: ' || project_name || '.', 'Principal Investigator: ' || pi_name || '.',
  'Profile quality: ' || nullif(concat_ws(', ', 'pressure QC=' || profile_pres_qc,
    'temperature QC=' || profile_temp_qc, 'salinity QC=' || profile_psal_qc), '') || '.')"""

_CENTER = ("(min_lat + max_lat) / 2", "(min_lon + max_lon) / 2")

FLOAT_SUMMARY = f"""concat_ws(' ',
  'ARGO float ' || platform_number || ' (' || coalesce(platform_type, 'unknown type') || ').',
  CASE WHEN min_lat IS NOT NULL AND min_lon IS NOT NULL THEN 'Operated in the '
    || {region(*_CENTER)} || ', latitude ' || {_degrees('min_lat', 1, 'N', 'S')} || ' to '
    || {_degrees('max_lat', 1, 'N', 'S')} || ', longitude ' || {_degrees('min_lon', 1, 'E', 'W')}
    || ' to ' || {_degrees('max_lon', 1, 'E', 'W')} || '.'
    ELSE 'Operated in the Unknown Region, latitude unknown, longitude unknown.' END,
  'Completed ' || total_cycles || ' measurement cycles from ' || {long_date('first_date')}
    || ' to ' || {long_date('last_date')} || ' (' || {month_year('first_date')} || ' to '
    || {month_year('last_date')} || ').',
  CASE WHEN has_bgc THEN 'Equipped with BGC sensors measuring '
    || coalesce(nullif(bgc_parameters, ''), 'various BGC parameters') || '. ' || bgc_cycles
    || ' BGC profiles available.' ELSE 'Core float (no BGC sensors).' END,
  'Project: ' || project_name || '.', 'Principal Investigator: ' || pi_name || '.',
  'Data centre: ' || data_centre || '.', 'Data modes: ' || nullif(data_modes_used, '') || '.')"""

DOCS = FLOATS + f""", docs AS (
  SELECT CASE WHEN file_type = 'synthetic_bgc' THEN 'bgc_profiles' ELSE 'profiles' END AS collection,
    profile_id AS id, {PROFILE_SUMMARY} AS document, {region('latitude', 'longitude')} AS region
  FROM prof
  UNION ALL
  SELECT 'floats', platform_number, {FLOAT_SUMMARY},
    CASE WHEN min_lat IS NOT NULL AND min_lon IS NOT NULL THEN {region(*_CENTER)} END
  FROM floats
)"""


def words(source: str, key: str, text: str) -> str:
    """Counts of hashed words per row: (key, bucket, n)."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""SELECT {key}, CAST(('0x' || substr(md5(token), 1, 8)) AS BIGINT) % 384 AS bucket,
      count(*) AS n
    FROM (SELECT {key}, unnest(string_split_regex(translate({text}, '{upper}', '{lower}'),
            '[ \\t\\n\\r\\f\\v]+')) AS token FROM {source}) WHERE token <> '' GROUP BY ALL"""


def text_search(corpus: str, texts: list[str]) -> str:
    """CTEs ending in hits(query_id, id, collection, region, distance) over all of ``corpus``."""
    rows = ", ".join(f"({i}, '{t}')" for i, t in enumerate(texts))
    return f""", queries(query_id, txt) AS (VALUES {rows}
), dw AS ({words(corpus, 'collection, id', 'document')}
), qw AS ({words('queries', 'query_id', 'txt')}
), dn AS (SELECT collection, id, sqrt(sum(n * n)) AS norm FROM dw GROUP BY ALL
), qn AS (SELECT query_id, sqrt(sum(n * n)) AS norm FROM qw GROUP BY ALL
), dots AS (SELECT query_id, collection, id, sum(dw.n * qw.n) AS dot FROM dw JOIN qw USING (bucket)
  GROUP BY ALL
), hits AS (
  SELECT q.query_id, c.collection, c.id, c.region, c.document,
    1 - coalesce(dot, 0) / (dn.norm * qn.norm) AS distance
  FROM {corpus} c JOIN dn USING (collection, id) CROSS JOIN queries q JOIN qn USING (query_id)
  LEFT JOIN dots t ON t.query_id = q.query_id AND t.collection = c.collection AND t.id = c.id
)"""


def query(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()} {body}"

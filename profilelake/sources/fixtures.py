"""Raw profiles derived from the ``orders`` table, for tests, checks and benchmarks.

Each order is one raw profile; two orders share a file. Everything is computed from the
order's own columns, so the derivation is a projection that grows with the table and
needs no shuffle. The values carry the dirt the cleaning must handle: fill markers, NaN,
blank flags, padded text, missing variables, unreadable and empty files.
"""

from pyspark.sql import DataFrame, SparkSession

from profilelake.schema import BRONZE, RAW_PARAM
from profilelake.session import spread

#: Orders that one task makes into raw profiles; each grows to some kilobytes.
TASK_ROWS = 50_000


def _levels(condition: str, values: dict[str, str]) -> str:
    """SQL struct of raw arrays; ``i`` is the level, ``k`` the order key."""
    fields = [
        f"cast(transform(lv, i -> {values[f.name]}) as {f.dataType.simpleString()}) as {f.name}"
        if f.name in values
        else f"cast(null as {f.dataType.simpleString()}) as {f.name}"
        for f in RAW_PARAM.fields
    ]
    return f"case when {condition} then struct({', '.join(fields)}) end"


# all values of a level vanish together on some levels
_LOST = "(k + i) % 23 = 0"
_QC = "element_at(array('1', '4', ' ', null), cast((k + i) % 4 as int) + 1)"

_PARAMS = {
    "pres": _levels("k % 47 <> 0", {
        "value": f"case when {_LOST} then 99999e0 when (k + i) % 31 = 0 then double('NaN') "
                 "else i * 50e0 + k % 50 end",
        "qc": _QC,
        "adjusted": "i * 50e0 + k % 50 + 0.5e0",
        "adjusted_qc": "'1'",
        "adjusted_error": "2.4e0",
    }),
    "temp": f"case when k % 5 = 0 then {{bare}} else {{full}} end".format(
        bare=_levels("true", {
            "value": f"case when {_LOST} or (k + i) % 13 = 0 then 99999e0 "
                     "else 28e0 - i * 2e0 + (k % 100) / 100e0 end",
            "qc": _QC,
        }),
        full=_levels("true", {
            "value": f"case when {_LOST} or (k + i) % 13 = 0 then 99999e0 "
                     "else 28e0 - i * 2e0 + (k % 100) / 100e0 end",
            "qc": _QC,
            "adjusted": "case when (k + i) % 11 = 0 then -999e0 else 28e0 - i * 2e0 end",
            "adjusted_qc": "'2'",
            "adjusted_error": "0.002e0",
        }),
    ),
    "psal": _levels("true", {
        "value": f"case when {_LOST} or (k + i) % 17 = 0 then -999e0 "
                 "else 34e0 + ((k + i) % 200) / 100e0 end",
        "qc": "'1'",
    }),
    "doxy": _levels("f % 6 >= 2", {
        "value": "case when (k + i) % 19 = 0 then 1e36 else 200e0 - i * 5e0 + k % 20 end",
        "qc": "'3'",
        "dpres": "case when f % 6 < 4 then i * 0.5e0 end",
    }),
    "chla": _levels("f % 6 >= 2", {"value": "((k + i) % 50) / 10e0", "qc": "'0'"}),
    "nitrate": _levels("f % 6 >= 2 and k % 3 = 0", {"value": "((k + i) % 30) / 2e0"}),
}

_PLATFORM = "case when k % 211 = 0 then concat('9', k) else cast(c as string) end"

_FIELDS = {
    "source_file": "concat(element_at(array('D', 'R', 'SD', 'SR', 'BD', 'BR'), cast(f % 6 as int) + 1),"
                   " f, '.nc')",
    "profile_index": "case when f % 103 <> 0 or f % 101 = 0 then cast(k % 2 as int) end",
    "parse_error": "case when f % 101 = 0 then 'unreadable file' end",
    "platform_number": f"case when k % 53 = 0 then '   ' else concat('  ', {_PLATFORM}, ' ', chr(0)) end",
    "cycle_number": "case when k % 211 <> 0 then cast(k as double) end",
    "config_mission_number": "case when k % 3 = 0 then double('NaN') else k % 7 + 0.9e0 end",
    "data_type": "'Argo profile    '",
    "format_version": "' 3.1'",
    "handbook_version": "'1.2 '",
    "project_name": "case when c % 17 <> 0 then concat('PROJECT ', c % 25, '   ') end",
    "pi_name": "case when c % 13 = 0 then '  ' else concat('PI ', c % 50, ' ') end",
    "data_centre": "case when c % 3 = 0 then 'IN' else 'IF' end",
    "dc_reference": "concat('ref', k)",
    "platform_type": "element_at(array('APEX  ', 'PROVOR', ' ARVOR', ''), cast(c % 4 as int) + 1)",
    "float_serial_no": "concat(c, chr(0), chr(0))",
    "firmware_version": "'n/a\\t'",
    "wmo_inst_type": "cast(840 + c % 10 as string)",
    "data_state_indicator": "'2B  '",
    "vertical_sampling_scheme": "'Primary sampling: averaged   '",
    "positioning_system": "case when k % 2 = 0 then 'GPS  ' else 'ARGOS' end",
    "direction": "case k % 10 when 0 then 'D' when 1 then ' ' else 'A' end",
    "data_mode": "case when k % 29 <> 0 then "
                 "case s when 'F' then 'D' when 'O' then 'R' else 'A' end end",
    "profile_pres_qc": "case when k % 4 <> 0 then 'A' end",
    "profile_temp_qc": "case when k % 3 <> 0 then 'B' else ' ' end",
    "profile_psal_qc": "case when k % 4 = 1 then 'F' end",
    "profile_doxy_qc": "case when f % 6 >= 2 then case when k % 8 = 0 then ' ' else 'A' end end",
    "reference_date_time": "'19500101000000'",
    "date_creation": "concat(date_format(d, 'yyyyMMdd'), '0', k % 10, '3015')",
    "date_update": "case k % 4 when 0 then '20041301000000' when 1 then '2004' "
                   "else concat(date_format(d, 'yyyyMMdd'), '235959  ') end",
    "juld": "case when k % 61 = 0 then 99999e0 when k % 67 = 0 then double('NaN') "
            "when k % 71 = 0 then 4e6 else dn + (k % 24) / 24e0 end",
    "juld_location": "case when k % 2 = 0 then dn + (k % 1440) / 1440e0 end",
    "latitude": "case when k % 97 = 0 then 99999e0 when k % 89 = 0 then double('NaN') "
                "else ((k * 7919) % 9001) / 100e0 - 62e0 end",
    "longitude": "case when k % 97 = 0 then -999e0 else ((k * 104729) % 12001) / 100e0 + 10e0 end",
    "juld_qc": "element_at(array('1', ' ', '4', 'x', null), cast(k % 5 as int) + 1)",
    "position_qc": "element_at(array(' 2', '4.0', '1'), cast(k % 3 as int) + 1)",
    "station_parameters": "case when k % 41 = 0 then null when k % 43 = 0 then array('  ', '') "
                          "when f % 6 >= 2 then array('PRES   ', 'TEMP', 'PSAL ', "
                          "case when k % 7 = 0 then 'doxy' else 'DOXY' end, ' ', 'CHLA') "
                          "else array('PRES', '', 'TEMP  ', 'PSAL') end",
    "parameter_data_mode": "case when f % 6 >= 2 then array('D', ' ', 'R', 'A') end",
    "calib_parameter": "case when k % 9 <> 0 then transform(sequence(0, cast(k % 2 as int)), "
                       "j -> array('PRES ', ' ', concat('TEMP', j))) end",
    "calib_equation": "transform(sequence(0, cast(k % 2 as int)), "
                      "j -> array(concat('PA=P-', k % 11, ' '), '', 'none'))",
    "calib_coefficient": "case when k % 2 = 0 then array(array('dP=0.1', '', '  ')) end",
    "calib_comment": "array(array('surface offset'))",
    "calib_date": "array(array(concat(date_format(d, 'yyyyMMdd'), '120000'), '', 'bad'))",
    "history_institution": "case when k % 6 <> 0 then array('IF  ', '  ', 'ME') end",
    "history_step": "array('ARFM', 'ARGQ', 'ARSQ ')",
    "history_software": "array('SIO', '', '')",
    "history_software_release": "array('2.0', '', 'V1')",
    "history_date": "array(concat(date_format(d, 'yyyyMMdd'), '060000'), '', '19991231')",
    "history_action": "array('IP', 'QC', 'CV')",
    "history_parameter": "array('', '', 'PSAL')",
    "history_start_pres": "array(99999e0, 5e0, cast(k % 100 as double))",
    "history_stop_pres": "array(99999e0, 5e0, k % 100 + 1000e0)",
    "history_qctest": "array('8000', '', concat('Q', k % 3))",
}


def bronze(spark: SparkSession, sf_dir: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """The landing rows of all orders, in the bronze schema; ``task_rows`` orders to a task."""
    orders = spread(spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "o_orderkey as k",
        "o_orderkey div 2 as f",
        "o_custkey as c",
        "o_orderstatus as s",
        "o_orderdate as d",
        "datediff(o_orderdate, date'1950-01-01') as dn",
    ), task_rows)
    # the level count of a profile is 0 to 9; the array is the raw pressure axis
    based = orders.selectExpr(
        "*",
        "case when k % 37 = 0 then cast(array() as array<int>) "
        "else sequence(0, cast(k % 9 as int)) end as lv",
    )

    def expression(name: str, sql_type: str) -> str:
        if name in _FIELDS:
            value = f"cast({_FIELDS[name]} as {sql_type})"
        elif name in _PARAMS:
            value = _PARAMS[name]
        else:
            value = f"cast(null as {sql_type})"
        return f"{value} as {name}"

    rows = based.where("f % 101 <> 0 or k % 2 = 0").where(
        "f % 103 <> 0 or f % 101 = 0 or k % 2 = 0"
    )
    return rows.selectExpr(*(expression(f.name, f.dataType.simpleString()) for f in BRONZE.fields))


def measured_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat levels read from ``lineitem``: quantity is pressure, the order is the profile."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "l_orderkey as profile_id",
        "l_shipdate as timestamp",
        "l_quantity as pres",
        "case when l_linenumber <> 7 then l_extendedprice / 3500e0 end as temp",
        "30e0 + l_tax * 50e0 as psal",
        "l_discount * 3000e0 as doxy",
    )


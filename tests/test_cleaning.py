"""Edge values of the cleaning expressions."""

from datetime import datetime, timedelta

import pytest

from profilelake.functions import cleaning as cl


def values(spark, schema, rows, expr):
    df = spark.createDataFrame([(r,) for r in rows], schema)
    return [r[0] for r in df.selectExpr(f"{expr} as y").collect()]


def test_clean_text(spark):
    rows = ["  a b ", "\x00\x00", "", None, "\t x\x00\n", "a\x00b", " z ", "\x1cq"]
    expected = ["a b", None, None, None, "x", "ab", "z", "q"]
    assert values(spark, "x string", rows, cl.clean_text("x")) == expected


def test_clean_chars_and_bytes(spark):
    rows = [["P", "R", "\x00"], [" ", " "], None]
    assert values(spark, "x array<string>", rows, cl.clean_chars("x")) == ["PR", None, None]
    rows = [b" ok \x00", b"a\xffb", b""]
    assert values(spark, "x binary", rows, cl.clean_bytes("x")) == ["ok", "a�b", None]


def test_clean_numeric(spark):
    rows = [1.5, 99999.0, -999.0, float("nan"), float("inf"), -float("inf"), 1e36, 0.0, None, 1e35]
    expected = [1.5, None, None, None, None, None, None, 0.0, None, 1e35]
    assert values(spark, "x double", rows, cl.clean_numeric("x")) == expected


def test_clean_int(spark):
    rows = [2.9, -2.9, float("nan"), 1e12, None, 99999.0]
    assert values(spark, "x double", rows, cl.clean_int("x")) == [2, -2, None, None, None, 99999]


def test_decode_qc(spark):
    rows = ["1", " 4", " ", "", None, "x", "4.0", "9"]
    assert values(spark, "x string", rows, cl.decode_qc("x")) == [1, 4, -1, -1, -1, -1, -1, 9]


def test_juld(spark):
    rows = [0.0, 19000.041666666668, -1.5, 99999.0, 4e6, None, 2940201.0, 2940202.0, 18000 + 1 / 3]
    got = values(spark, "x double", rows, cl.juld_to_timestamp("x"))

    def expected(days):
        if days is None or days == 99999.0:
            return None
        try:
            return (datetime(1950, 1, 1) + timedelta(days=days)).replace(microsecond=0)
        except OverflowError:
            return None

    assert got == [expected(d) for d in rows]


def test_parse_datetime14(spark):
    rows = ["20040229123456", "20040230000000", "20041301000000", "2004", " 20040101000000xyz", None]
    got = values(spark, "x string", rows, cl.parse_datetime14("x"))
    assert got == [datetime(2004, 2, 29, 12, 34, 56), None, None, None, datetime(2004, 1, 1), None]


def test_timestamps_do_not_depend_on_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = values(spark, "x double", [26382.104166666668], cl.juld_to_timestamp("x"))
        assert got == [datetime(2022, 3, 26, 2, 30)]
        got = values(spark, "x string", ["20220313023000"], cl.parse_datetime14("x"))
        assert got == [datetime(2022, 3, 13, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("name, expected", [
    ("SD1.nc", "synthetic_bgc"), ("SR1.nc", "synthetic_bgc"), ("BD1.nc", "bgc"), ("BR1.nc", "bgc"),
    ("D1.nc", "core"), ("R1.nc", "core"), ("sd1.nc", "core"), ("S", "core"),
])
def test_classify_source(spark, name, expected):
    assert values(spark, "x string", [name], cl.classify_source("x")) == [expected]


def test_profile_id(spark):
    df = spark.createDataFrame(
        [("1900121", 2, "A", "core"), ("1900121", None, "D", "core"),
         ("290", 12345, None, "synthetic_bgc"), ("290", 7, "D", "synthetic_bgc"), ("5", -1, "A", "bgc")],
        "p string, c int, d string, t string",
    )
    got = [r[0] for r in df.selectExpr(cl.build_profile_id("p", "c", "d", "t")).collect()]
    assert got == ["1900121_002", "1900121_000D", "290_12345_BGC", "290_007D_BGC", "5_-01"]


def test_station_parameters_and_bgc(spark):
    rows = [["PRES ", "", "doxy"], [" ", ""], None, ["CHLA", "CHLA", "X"]]
    got = values(spark, "x array<string>", rows, cl.station_parameters("x"))
    core = ["PRES", "TEMP", "PSAL"]
    assert got == [["PRES", "doxy"], core, core, ["CHLA", "CHLA", "X"]]
    got = values(spark, "x array<string>", [["PRES", "doxy"], core, ["CHLA", "CHLA"]],
                 cl.detect_bgc("x"))
    assert got == [["DOXY"], None, ["CHLA", "CHLA"]]


def test_geo_point_and_iso(spark):
    df = spark.createDataFrame([(0.0, 1.0), (None, 1.0)], "lat double, lon double")
    got = [r[0] for r in df.selectExpr(cl.geo_point("lat", "lon")).collect()]
    assert got[0].lon == 1.0 and got[0].lat == 0.0 and got[1] is None
    rows = [datetime(2003, 1, 10, 19, 30, 3), None]
    assert values(spark, "x timestamp_ntz", rows, cl.iso_date("x")) == ["2003-01-10T19:30:03Z", None]


def test_clean_cell_is_clean_text(spark):
    rows = ["  a b ", "\x00\x00", "", " ", None, "\t x\x00\n", "a\x00b", " z ", "\x1cq\x1f", "　",
            " é ", "\x85y", "a "]
    expected = values(spark, "x string", rows, cl.clean_text("x"))
    assert values(spark, "x string", rows, cl.clean_cell("x")) == expected
    assert values(spark, "x array<string>", [rows, None], cl.clean_text_array("x")) == [expected, None]
    # inside a lambda the text is stripped once, by the short list if it is ASCII
    assert cl.clean_cell("x").count("trim(") == 2 and "nullif" not in cl.clean_text_array("x")


def test_datetime_cell_is_parse_datetime14(spark):
    rows = ["20040229123456", "20040230000000", "2004", "2004-01-01", " 20040101000000xyz", None, "",
            "20040101000000\nrest", "x20040101000000", "2004010100000", "T12:00:00"]
    first = datetime(2004, 1, 1)
    expected = [datetime(2004, 2, 29, 12, 34, 56), None, None, None, first, None, None, first, None, None, None]
    assert values(spark, "x string", rows, cl.parse_datetime14("x")) == expected
    assert values(spark, "x string", rows, cl.parse_datetime14_cell("x")) == expected

"""Text features against Python's own formatting."""

import random
from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st

from profilelake.functions import text as tx
from profilelake.functions.dates import parse_date
from profilelake.schema import REGIONS


def evaluate(spark, rows, schema, *exprs):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).selectExpr(*exprs).collect()]


def test_fixed_rounds_like_python(spark):
    rng = random.Random(3)
    numbers = [0.125, 2.675, 1.005, 2.5, 3.5, 0.5, -0.3, 0.0, 1e15 + 0.5, 2.665, 1.115, 99.995]
    numbers += [rng.randrange(10**6) / 1000 for _ in range(3000)]
    numbers += [rng.uniform(-1e5, 1e5) for _ in range(2000)]
    got = evaluate(spark, [(x,) for x in numbers], "x double",
                   *(tx.fixed("x", d) for d in (0, 1, 2)))
    for x, texts in zip(numbers, got):
        assert texts == (f"{x:.0f}", f"{x:.1f}", f"{x:.2f}"), x


def test_fixed_null(spark):
    assert evaluate(spark, [(None,)], "x double", tx.fixed("x", 2)) == [(None,)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-70, 40), st.integers(-180, 180)), min_size=50, max_size=200))
def test_region_takes_first_box(spark, points):
    def expected(lat, lon):
        for name, south, north, west, east in REGIONS:
            if south <= lat <= north and west <= lon <= east:
                return name
        return "Indian Ocean"

    rows = [(float(a), float(b)) for a, b in points]
    got = evaluate(spark, rows, "lat double, lon double", tx.detect_region("lat", "lon"))
    assert [g[0] for g in got] == [expected(*p) for p in rows]


def test_region_without_position(spark):
    got = evaluate(spark, [(None, 1.0), (1.0, None)], "lat double, lon double",
                   tx.detect_region("lat", "lon"))
    assert got == [("Unknown Region",)] * 2


def test_dates(spark):
    rows = [(datetime(2003, 1, 9),), (None,)]
    got = evaluate(spark, rows, "x timestamp_ntz", tx.format_date("x"), tx.format_month_year("x"))
    assert got == [("January 09, 2003", "January 2003"), ("unknown date", "unknown")]
    rows = [("2003-01-10T19:30:03Z",), ("",), (None,), ("not a date at all",), ("2003-13-01",)]
    got = evaluate(spark, rows, "x string", tx.format_date("x", True), tx.format_month_year("x", True))
    assert got == [
        ("January 10, 2003", "January 2003"), ("unknown date", "unknown"),
        ("unknown date", "unknown"), ("not a date", "not a d"), ("2003-13-01", "2003-13"),
    ]


def test_labels(spark):
    got = evaluate(spark, [("D",), ("X",), ("",), (None,)], "x string", tx.data_mode_label("x"))
    assert [g[0] for g in got] == [
        "delayed mode (quality-controlled)", "mode X", "unknown mode", "unknown mode"
    ]
    got = evaluate(spark, [("temp",), ("cdom",)], "x string", tx.param_label("x"))
    assert [g[0] for g in got] == ["Temperature (°C)", "CDOM"]


PROFILE = (
    "platform_number string, cycle_number int, direction string, latitude double, longitude double, "
    "timestamp timestamp_ntz, max_pres double, n_levels int, data_mode string, "
    "station_parameters array<string>, contains_bgc boolean, bgc_parameters array<string>, "
    "project_name string, pi_name string, profile_pres_qc string, profile_temp_qc string, "
    "profile_psal_qc string"
)


def test_profile_summary_sentences(spark):
    full = ("1900121", 2, "A", 0.0, -60.125, datetime(2003, 1, 10), 2.5, 7, "R", ["PRES", "DOXY"],
            True, ["DOXY"], "P", "N", "A", None, "B")
    bare = (None, None, None, None, 5.0, None, 0.0, None, None, [], False, None, None, "", None,
            None, None)
    got = evaluate(spark, [full, bare], PROFILE, tx.profile_summary())
    assert got[0][0] == (
        "ARGO float 1900121, cycle 2, ascending profile. Located at 0.00°N, 60.12°W in the "
        "Indian Ocean. Measured on January 10, 2003 (January 2003). Depth range: 0 to 2 meters "
        "with 7 depth levels. Parameters measured: PRES, DOXY. Data mode: real-time mode. "
        "Contains BGC (biogeochemical) data: DOXY. Project: P. Principal Investigator: N. "
        "Profile quality: pressure QC=A, salinity QC=B."
    )
    assert got[1][0] == (
        "ARGO float Unknown, cycle ?, descending profile. Located at unknown, 5.00°E in the "
        "Unknown Region. Measured on unknown date (unknown). Depth range: unknown depth with 0 "
        "depth levels. Parameters measured: PRES, TEMP, PSAL. Data mode: unknown mode."
    )


def test_parse_date():
    assert parse_date("2003-05") == datetime(2003, 5, 1)
    assert parse_date("2003-05-06T07:08:09Z") == datetime(2003, 5, 6, 7, 8, 9)
    assert parse_date("2003-05-06T07:08:09") == datetime(2003, 5, 6, 7, 8, 9)
    assert parse_date("May 2003") is None and parse_date("") is None and parse_date(None) is None

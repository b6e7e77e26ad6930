"""Radius searches against brute force, also at the date line and the poles."""

import random
from math import asin, cos, radians, sin, sqrt

import pytest

from profilelake.functions.geo import EARTH_RADIUS_KM
from profilelake.operators import nearest


def km(lat1, lon1, lat2, lon2):
    h = sin(radians(lat2 - lat1) / 2) ** 2
    h += cos(radians(lat1)) * cos(radians(lat2)) * sin(radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_KM * asin(sqrt(min(1.0, h)))


@pytest.fixture(scope="module")
def profiles(spark):
    rng = random.Random(11)
    rows = [
        (f"p{i:05d}", f"f{i % 40}", rng.choice([rng.uniform(-90, 90), rng.uniform(-90, -80)]),
         rng.choice([rng.uniform(-180, 180), rng.uniform(175, 180), -179.9]))
        for i in range(3000)
    ]
    rows += [(f"q{i}", "hot", 12.0, 60.0) for i in range(1500)] + [("none", "f1", None, 3.0)]
    return rows, spark.createDataFrame(
        rows, "profile_id string, platform_number string, latitude double, longitude double"
    ).selectExpr("*", "cast(null as timestamp_ntz) as timestamp").cache()


def expected(rows, lat, lon, radius, n=100, shown=20):
    hits = sorted(
        (d, p, f) for p, f, a, b in rows if a is not None and (d := km(lat, lon, a, b)) <= radius
    )[:n]
    best = {}
    for d, p, f in hits:
        best.setdefault(f, (d, p))
    order = sorted((d, p, f) for f, (d, p) in best.items())
    return [(i + 1, f, p, len(best)) for i, (d, p, f) in enumerate(order[:shown])]


POINTS = [(12.0, 60.0), (0.0, 179.95), (0.0, -180.0), (89.5, 10.0), (-90.0, 0.0), (-86.0, -170.0)]


@pytest.mark.parametrize("radius", [50, 800, 6000])
def test_nearest_join_equals_brute_force(spark, profiles, radius):
    rows, df = profiles
    points = nearest.points_frame(spark, [(i, *p) for i, p in enumerate(POINTS)])
    got = nearest.nearest_join(df, points, radius).collect()
    for i, (lat, lon) in enumerate(POINTS):
        mine = sorted(
            (r.rank, r.platform_number, r.sample_profile_id, r.unique_floats)
            for r in got if r.point_id == i
        )
        assert mine == expected(rows, lat, lon, radius), (lat, lon)


@pytest.mark.parametrize("lat, lon", POINTS)
def test_nearest_floats_equals_brute_force(profiles, lat, lon):
    rows, df = profiles
    got = sorted(
        (r.rank, r.platform_number, r.sample_profile_id, r.unique_floats)
        for r in nearest.nearest_floats(df, lat, lon, 700).collect()
    )
    assert got == expected(rows, lat, lon, 700)


def test_crowded_place_makes_few_pairs(spark):
    rng = random.Random(4)
    rows = [(f"p{i:05d}", f"f{i % 90}", 10 + 3 * rng.random(), 60 + 3 * rng.random())
            for i in range(30000)]
    df = spark.createDataFrame(
        rows, "profile_id string, platform_number string, latitude double, longitude double"
    ).selectExpr("*", "cast(null as timestamp_ntz) as timestamp")
    points = nearest.points_frame(spark, [(i, 11 + i / 50, 61.0) for i in range(50)])
    assert nearest.near_pairs(df, points, 500, 100).count() < 50 * 600
    got = nearest.nearest_join(df, points, 500).where("point_id = 7").collect()
    mine = sorted((r.rank, r.platform_number, r.sample_profile_id, r.unique_floats) for r in got)
    assert mine == expected(rows, 11 + 7 / 50, 61.0, 500)


def test_nothing_near(profiles):
    assert nearest.nearest_floats(profiles[1].where("platform_number = 'x'"), 0, 0).count() == 0

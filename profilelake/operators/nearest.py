"""Floats nearest to one point, or to many points at once."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from profilelake.functions.geo import SPLIT, Grid, bounding_box, haversine_km
from profilelake.schema import NEAREST_FLOATS_SHOWN, NEAREST_PROFILES

_FIELDS = ["profile_id", "platform_number", "latitude", "longitude", "timestamp"]


def _closest_floats(hits: DataFrame, by: list[str], shown: int) -> DataFrame:
    """Closest profile of each float among the hits, which are few per point."""
    nearest = [F.col("distance_km"), F.col("profile_id")]
    of_float = Window.partitionBy(*by, "platform_number").orderBy(*nearest)
    of_point = Window.partitionBy(*by).orderBy(*nearest)
    floats = hits.withColumn("_f", F.row_number().over(of_float)).where("_f = 1")
    return (
        floats.withColumn("rank", F.row_number().over(of_point))
        .withColumn("unique_floats", F.count("*").over(Window.partitionBy(*by)))
        .where(F.col("rank") <= shown)
        .select(
            *by,
            "rank",
            "platform_number",
            F.col("profile_id").alias("sample_profile_id"),
            "latitude",
            "longitude",
            "timestamp",
            "distance_km",
            "unique_floats",
        )
    )


def nearest_floats(
    profiles: DataFrame,
    lat: float,
    lon: float,
    max_distance_km: float = 500,
    n_profiles: int = NEAREST_PROFILES,
    shown: int = NEAREST_FLOATS_SHOWN,
) -> DataFrame:
    """Floats with a profile within the radius, nearest first.

    The nearest ``n_profiles`` profiles are looked at, as the feature defines; the box
    around the circle is filtered at the scan.
    """
    hits = (
        profiles.select(*_FIELDS)
        .where(bounding_box(lat, lon, max_distance_km))
        .withColumn(
            "distance_km",
            F.expr(haversine_km(f"{float(lat)!r}D", f"{float(lon)!r}D", "latitude", "longitude")),
        )
        .where(F.col("distance_km") <= max_distance_km)
        .orderBy("distance_km", "profile_id")
        .limit(n_profiles)
        .withColumn("query_lat", F.lit(float(lat)))
        .withColumn("query_lon", F.lit(float(lon)))
    )
    return _closest_floats(hits, ["query_lat", "query_lon"], shown)


#: Levels of the grid below the cells of the search radius.
LEVELS = 4


def _cells_to_search(
    counts: DataFrame, around: DataFrame, grid: Grid, km: float, n_profiles: int
) -> DataFrame:
    """Finest cells that can hold one of the ``n_profiles`` nearest of a point, by point.

    ``counts`` has the profiles per finest cell, ``around`` the points by the cells their
    circles can touch. Level by level, the cells of a point are ordered by their greatest
    distance until they hold ``n_profiles``; cells beyond that distance fall away, and only
    the others are looked at in parts. A point meets a bounded number of cells at each
    level, however many profiles lie in them.
    """
    point = ["point_id", "lat", "lon"]
    cells = around
    for level in range(1, LEVELS + 1):
        parts = SPLIT ** (LEVELS - level)
        held = counts.groupBy(
            F.expr(f"band div {parts}").alias("_band"), F.expr(f"column div {parts}").alias("_column")
        ).agg(F.sum("n").alias("n"))
        inside = held.selectExpr(
            f"cast(_band div {SPLIT} as int) as band", f"cast(_column div {SPLIT} as int) as column",
            "cast(_band as int) as _band", "cast(_column as int) as _column", "n",
        )
        low, high = grid.reach_km("lat", "lon", level)
        nearest = Window.partitionBy(*point)
        cells = (
            cells.join(inside, ["band", "column"])
            .select(*point, F.col("_band").alias("band"), F.col("_column").alias("column"), "n")
            .withColumns({"_low": F.expr(low), "_high": F.expr(high)})
            .withColumn("_held", F.sum("n").over(nearest.orderBy("_high")))
            .withColumn("_far", F.min(F.when(F.col("_held") >= n_profiles, F.col("_high"))).over(nearest))
            .where(F.col("_low") <= F.least(F.col("_far"), F.lit(float(km))))
            .select(*point, "band", "column")
        )
    return cells


def near_pairs(
    profiles: DataFrame, points: DataFrame, max_distance_km: float, n_profiles: int
) -> DataFrame:
    """Pairs of a point and a profile within the radius, with all of the ``n_profiles`` nearest."""
    grid = Grid(max_distance_km)
    placed = profiles.select(*_FIELDS).where(
        "latitude is not null and longitude is not null"
    ).withColumns({
        "band": F.expr(grid.band("latitude", LEVELS)),
        "column": F.expr(grid.column("longitude", LEVELS)),
    })
    around = (
        points.where("lat is not null and lon is not null")
        .withColumn("band", F.explode(F.expr(grid.bands_near("lat"))))
        .withColumn("column", F.explode(F.expr(grid.columns_near("lat", "lon"))))
        .select("point_id", "lat", "lon", "band", "column")
    )
    counts = placed.groupBy("band", "column").agg(F.count("*").alias("n"))
    cells = _cells_to_search(counts, around, grid, max_distance_km, n_profiles)
    return (
        placed.join(cells, ["band", "column"])
        .withColumn("distance_km", F.expr(haversine_km("lat", "lon", "latitude", "longitude")))
        .where(F.col("distance_km") <= max_distance_km)
        .drop("band", "column", "lat", "lon")
    )


def nearest_join(
    profiles: DataFrame,
    points: DataFrame,
    max_distance_km: float = 500,
    n_profiles: int = NEAREST_PROFILES,
    shown: int = NEAREST_FLOATS_SHOWN,
) -> DataFrame:
    """``nearest_floats`` for each row of ``points`` (point_id, lat, lon).

    Profiles are counted per small cell first, and a point is joined to the profiles of the
    cells that can hold its nearest ones, so a crowded place does not pair all its profiles
    with all points nearby. The join is on equal cells: Spark broadcasts the points' cells when
    they are small at run time and splits crowded cells when they are not. Each task keeps the
    nearest ``n_profiles`` per point before the shuffle.
    """
    near = near_pairs(profiles, points, max_distance_km, n_profiles)
    order = Window.partitionBy("point_id").orderBy("distance_km", "profile_id")
    hits = near.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n_profiles)
    return _closest_floats(hits.drop("_n"), ["point_id"], shown)


def points_frame(spark: SparkSession, points: list[tuple]) -> DataFrame:
    """Query points given as (point_id, lat, lon) tuples."""
    return spark.createDataFrame(points, "point_id long, lat double, lon double")

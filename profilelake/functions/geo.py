"""Distances on the sphere and a grid of cells for radius joins."""

from math import asin, cos, degrees, pi, radians, sin

# Fixed value: earth radius of the spherical radius search, in km.
EARTH_RADIUS_KM = 6378.1

# cells are never smaller than this, so a point near a pole touches a bounded number
MIN_CELL_DEGREES = 0.5

# parts of a cell along each side, per level of the grid: a point meets at each level the parts
# of the few cells left of the level above, so small steps keep its rows few
SPLIT = 4


def haversine_km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    half = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"(2 * {EARTH_RADIUS_KM}D * asin(sqrt(least(1D, {half}))))"


def bounding_box(lat: float, lon: float, km: float) -> str:
    """Filter that holds for every point within ``km``; plain ranges reach the scan."""
    angle = km / EARTH_RADIUS_KM
    reach = degrees(angle) + 1e-6
    south, north = lat - reach, lat + reach
    keep = f"latitude between {south!r}D and {north!r}D"
    if angle >= pi / 2 or south <= -90 or north >= 90:
        return keep
    width = degrees(asin(min(1.0, sin(angle) / cos(radians(lat))))) + 1e-6
    west, east = lon - width, lon + width
    if west >= -180 and east <= 180:
        return f"{keep} and longitude between {west!r}D and {east!r}D"
    return f"{keep} and pmod(longitude - {lon!r}D + 180D, 360D) - 180D between {-width!r}D and {width!r}D"


def square(lat: str, lon: str) -> str:
    """Number of the ten-degree square of a place."""
    return f"int(floor(({lat} + 90D) / 10D)) * 36 + int(floor(pmod({lon} + 180D, 360D) / 10D))"


class Grid:
    """Latitude bands cut into equal longitude cells, as wide as the search radius.

    At each further level a cell is cut into ``SPLIT`` by ``SPLIT`` parts.
    """

    def __init__(self, km: float):
        self.reach = degrees(km / EARTH_RADIUS_KM) + 1e-6
        self.angle = km / EARTH_RADIUS_KM
        self.size = max(self.reach, MIN_CELL_DEGREES)
        self.columns = max(1, int(360 // self.size))

    def band(self, lat: str, level: int = 0) -> str:
        return f"cast(floor(({lat} + 90D) * {SPLIT**level / self.size!r}D) as int)"

    def column(self, lon: str, level: int = 0) -> str:
        columns = self.columns * SPLIT**level
        return (
            f"least({columns - 1}, cast(floor(pmod({lon} + 180D, 360D) * "
            f"{columns / 360!r}D) as int))"
        )

    def reach_km(self, lat: str, lon: str, level: int) -> tuple[str, str]:
        """Least and greatest distance, at most and at least, to a place in the cell
        (band, column) of a level: that to its centre and back along parallel and meridian."""
        height, width = self.size / SPLIT**level, 360 / (self.columns * SPLIT**level)
        north = f"((band + 0.5D) * {height!r}D - 90D)"
        east = f"((column + 0.5D) * {width!r}D - 180D)"
        half = (
            f"({EARTH_RADIUS_KM}D * radians({height / 2!r}D + "
            f"abs(cos(radians({north}))) * {width / 2!r}D) + 1e-6D)"
        )
        centre = haversine_km(lat, lon, north, east)
        return f"{centre} - {half}", f"{centre} + {half}"

    def bands_near(self, lat: str) -> str:
        """Bands a circle around the point can touch."""
        low = self.band(f"greatest(-90D, {lat} - {self.reach!r}D)")
        high = self.band(f"least(90D, {lat} + {self.reach!r}D)")
        return f"sequence({low}, {high})"

    def columns_near(self, lat: str, lon: str) -> str:
        """Cells of a band the circle can touch: all of them when it holds a pole."""
        every = f"sequence(0, {self.columns - 1})"
        if self.angle >= pi / 2:
            return every
        width = f"(degrees(asin(least(1D, {sin(self.angle)!r}D / cos(radians({lat}))))) + 1e-6D)"
        scale = f"{self.columns / 360!r}D"
        first = f"cast(floor(({lon} + 180D - {width}) * {scale}) as int)"
        last = f"cast(floor(({lon} + 180D + {width}) * {scale}) as int)"
        near = f"array_distinct(transform(sequence({first}, {last}), c -> pmod(c, {self.columns})))"
        pole = f"abs({lat}) + {self.reach!r}D >= 90D"
        return (
            f"case when {pole} then {every} "
            f"when {last} - {first} >= {self.columns - 1} then {every} else {near} end"
        )

"""Geometry as WKT text columns: simplify, buffer, transform, hash, tile."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH = 6378137.0
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"
NUMBER = r"-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?"
_RING = re.compile(r"\(([^()]*)\)")


def _points(text: str) -> np.ndarray:
    return np.array([[float(x) for x in p.split()[:2]] for p in text.split(",")])


def _text(points: np.ndarray) -> str:
    return ", ".join(f"{x:.10g} {y:.10g}" for x, y in points)


def douglas_peucker(points: np.ndarray, tolerance: float) -> np.ndarray:
    """The points that keep every dropped one within the tolerance of its chord."""
    keep = np.zeros(len(points), bool)
    keep[[0, -1]] = True
    todo = [(0, len(points) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        p, chord = points[a + 1 : b] - points[a], points[b] - points[a]
        size = math.hypot(*chord)
        far = np.abs(chord[0] * p[:, 1] - chord[1] * p[:, 0]) / size if size else np.hypot(p[:, 0], p[:, 1])
        i = int(far.argmax())
        if far[i] > tolerance:
            keep[a + 1 + i] = True
            todo += [(a, a + 1 + i), (a + 1 + i, b)]
    return points[keep]


def simplify_wkt(wkt: str | None, tolerance: float) -> str | None:
    """Each ring or line by itself; a ring that would fall under four points stays as it is."""
    if wkt is None:
        return None
    closed = "POLYGON" in wkt.upper()

    def one(m: re.Match) -> str:
        points = _points(m[1])
        if len(points) < 3:
            return m[0]
        out = douglas_peucker(points, tolerance)
        return m[0] if closed and len(out) < 4 else f"({_text(out)})"

    return _RING.sub(one, wkt)


def simplify_geometry(df: DataFrame, geometry: str, tolerance: float) -> DataFrame:
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: simplify_wkt(t, tolerance))

    return df.withColumn(geometry, run(F.col(geometry)))


def point(x: Column, y: Column) -> Column:
    return F.format_string("POINT (%s %s)", x.cast("string"), y.cast("string"))


def x_of(wkt: Column) -> Column:
    return F.regexp_extract(wkt, rf"\(\s*({NUMBER})", 1).try_cast("double")


def y_of(wkt: Column) -> Column:
    return F.regexp_extract(wkt, rf"\(\s*{NUMBER}\s+({NUMBER})", 1).try_cast("double")


def buffer_point(wkt: Column, distance: float, quadrant_segments: int = 8, cap: str = "round") -> Column:
    """A ring around a point: a circle's corners, or a square with the ``square`` cap; ``flat`` gives an empty polygon.

    Any other geometry is an error; ``buffer_geometry`` takes some of them.
    """
    wkt = F.when(wkt.rlike(r"(?i)\A\s*POINT\b"), wkt).otherwise(F.when(wkt.isNotNull(), F.raise_error(F.concat(F.lit("no point: "), F.substring(wkt, 1, 60)))).cast("string"))
    if cap == "flat":
        return F.when(wkt.isNotNull(), "POLYGON EMPTY")
    n = 4 * quadrant_segments if cap == "round" else 4
    turn, reach = (0.0, distance) if cap == "round" else (math.pi / 4, distance * math.sqrt(2))
    steps = [(round(reach * math.cos(turn - 2 * math.pi * (i % n) / n), 12), round(reach * math.sin(turn - 2 * math.pi * (i % n) / n), 12)) for i in range(n + 1)]
    ring = F.concat_ws(", ", *(F.concat_ws(" ", (x_of(wkt) + dx).cast("string"), (y_of(wkt) + dy).cast("string")) for dx, dy in steps))
    return F.when(wkt.isNotNull(), F.concat(F.lit("POLYGON (("), ring, F.lit("))")))


def convex_hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull from the lowest left one on, against the clock, closed (Andrew's chains)."""
    points = np.unique(points, axis=0)

    def chain(ordered: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for p in ordered:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 1e-12:
                out.pop()
            out.append(p)
        return out

    return np.array([*chain(points)[:-1], *chain(points[::-1])])


def buffer_wkt(wkt: str | None, distance: float, quadrant_segments: int = 8) -> str | None:
    """The polygon of all that lies within a distance of a convex geometry: its hull with a circle's corners at each vertex.

    That is a point, a straight line, and a polygon without holes that turns one way only; others are errors.
    """
    if wkt is None:
        return None
    kind, rings = wkt.strip().split("(")[0].strip().upper(), _RING.findall(wkt)
    if kind not in ("POINT", "LINESTRING", "POLYGON") or len(rings) != 1:
        raise ValueError(f"no convex geometry: {wkt[:60]}")
    points = _points(rings[0])
    a, b, c = points[:-2], points[1:-1], points[2:]
    turns = (b[:, 0] - a[:, 0]) * (c[:, 1] - b[:, 1]) - (b[:, 1] - a[:, 1]) * (c[:, 0] - b[:, 0]) if len(points) > 2 else np.zeros(0)
    around = np.diff(np.unwrap(np.arctan2(*np.diff(points[np.r_[np.arange(len(points)), 1]] if kind == "POLYGON" else points, axis=0).T[::-1])))
    straight = kind != "LINESTRING" or np.abs(turns).max(initial=0) <= 1e-9
    convex = kind != "POLYGON" or ((turns >= -1e-9).all() or (turns <= 1e-9).all()) and abs(around.sum()) < 2 * math.pi + 1e-6
    if not (straight and convex):
        raise ValueError(f"no convex geometry: {wkt[:60]}")
    n = 4 * quadrant_segments
    angles = 2 * math.pi * np.arange(n) / n
    circle = np.round(distance * np.stack([np.cos(angles), np.sin(angles)], axis=1), 12)
    return f"POLYGON (({_text(convex_hull((points[:, None] + circle).reshape(-1, 2)))}))"


def buffer_geometry(df: DataFrame, geometry: str, distance: float, quadrant_segments: int = 8) -> DataFrame:
    """Points, straight lines and convex polygons widened by a distance; any other geometry is an error."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: buffer_wkt(t, distance, quadrant_segments))

    return df.withColumn(geometry, run(F.col(geometry)))


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to metres of the web's Mercator."""
    return F.radians(lon) * EARTH, F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * EARTH


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / EARTH), F.degrees(F.atan(F.exp(y / EARTH)) * 2 - math.pi / 2)


def to_transverse_mercator(lon: Column, lat: Column, lon0: float, lat0: float = 0.0, scale: float = 1.0, false_x: float = 0.0, false_y: float = 0.0, a: float = 6378137.0, f: float = 1 / 298.257222101) -> tuple[Column, Column]:
    """Degrees to metres by Krueger's series on an ellipsoid, to the fourth order."""
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [n / 2 - 2 / 3 * n**2 + 5 / 16 * n**3 + 41 / 180 * n**4, 13 / 48 * n**2 - 3 / 5 * n**3 + 557 / 1440 * n**4, 61 / 240 * n**3 - 103 / 140 * n**4, 49561 / 161280 * n**4]
    e = math.sqrt(f * (2 - f))

    def conformal(phi: Column) -> Column:
        s = F.sin(phi)
        return F.sinh(F.atanh(s) - e * F.atanh(e * s))

    phi, away = F.radians(lat), F.radians(lon - lon0)
    t = conformal(phi)
    xi, eta = F.atan2(t, F.cos(away)), F.asinh(F.sin(away) / F.sqrt(t * t + F.cos(away) ** 2))
    north, east = xi, eta
    for j, c in enumerate(alpha, 1):
        north = north + c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        east = east + c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    s0 = math.sin(math.radians(lat0))
    x0 = math.atan(math.sinh(math.atanh(s0) - e * math.atanh(e * s0)))
    base = x0 + sum(c * math.sin(2 * j * x0) for j, c in enumerate(alpha, 1))
    return false_x + scale * radius * east, false_y + scale * radius * (north - base)


def from_transverse_mercator(x: Column, y: Column, lon0: float, lat0: float = 0.0, scale: float = 1.0, false_x: float = 0.0, false_y: float = 0.0, a: float = 6378137.0, f: float = 1 / 298.257222101) -> tuple[Column, Column]:
    """Metres back to degrees: the series the other way, then the latitude by Newton's steps from the conformal one."""
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = [n / 2 - 2 / 3 * n**2 + 37 / 96 * n**3 - 1 / 360 * n**4, 1 / 48 * n**2 + 1 / 15 * n**3 - 437 / 1440 * n**4, 17 / 480 * n**3 - 37 / 840 * n**4, 4397 / 161280 * n**4]
    delta = [2 * n - 2 / 3 * n**2 - 2 * n**3 + 116 / 45 * n**4, 7 / 3 * n**2 - 8 / 5 * n**3 - 227 / 45 * n**4, 56 / 15 * n**3 - 136 / 35 * n**4, 4279 / 630 * n**4]
    _, origin = to_transverse_mercator(F.lit(lon0), F.lit(0.0), lon0, lat0, scale, false_x, false_y, a, f)
    xi, eta = (y - origin) / (scale * radius), (x - false_x) / (scale * radius)
    north, east = xi, eta
    for j, b in enumerate(beta, 1):
        north = north - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        east = east - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(north) / F.cosh(east))
    lat = chi
    for j, d in enumerate(delta, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return F.degrees(F.atan2(F.sinh(east), F.cos(north))) + lon0, F.degrees(lat)


_KOREA = {"lon0": 127.5, "lat0": 38.0, "scale": 0.9996, "false_x": 1_000_000.0, "false_y": 2_000_000.0}
#: Coordinate systems by EPSG number, from degrees to their own units.
SYSTEMS = {
    4326: lambda lon, lat: (lon, lat),
    3857: to_mercator,
    5179: lambda lon, lat: to_transverse_mercator(lon, lat, **_KOREA),
}
#: And back.
DEGREES = {
    4326: lambda lon, lat: (lon, lat),
    3857: from_mercator,
    5179: lambda x, y: from_transverse_mercator(x, y, **_KOREA),
}


def change_crs(x: Column, y: Column, source: int, target: int) -> tuple[Column, Column]:
    for system in (source, target):
        if system not in SYSTEMS:
            raise ValueError(f"no such system: {system}")
    return SYSTEMS[target](*DEGREES[source](x, y))


def transform_geometry(df: DataFrame, geometry: str, source: int, target: int) -> DataFrame:
    """All coordinates of a WKT column from one system to another; the rest of the text stays.  The target is noted in the metadata."""
    pair = rf"({NUMBER})\s+({NUMBER})"
    number = lambda i: F.transform(F.regexp_extract_all(geometry, F.lit(pair), i), lambda v: v.cast("double"))
    places = F.arrays_zip(number(1).alias("x"), number(2).alias("y"))

    def moved(p: Column) -> Column:
        x, y = change_crs(p["x"], p["y"], source, target)
        return F.concat_ws(" ", x.cast("string"), y.cast("string"))

    pieces = F.split(geometry, pair, -1)
    out = F.array_join(F.zip_with(pieces, F.transform(places, moved), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return df.withColumn(geometry, F.when(F.col(geometry).isNotNull(), out)).withMetadata(geometry, {"crs": f"EPSG:{target}"})


def transform_crs(df: DataFrame, x: str, y: str, source: int, target: int) -> DataFrame:
    """Coordinates in two columns from one system to another; the target is noted in the columns' metadata."""
    tx, ty = change_crs(F.col(x), F.col(y), source, target)
    df = df.withColumns({x: tx, y: ty})
    return df.withMetadata(x, {"crs": f"EPSG:{target}"}).withMetadata(y, {"crs": f"EPSG:{target}"})


def with_crs(df: DataFrame, geometry: str, crs: str) -> DataFrame:
    """Note the coordinate system of a WKT column in its metadata."""
    return df.withMetadata(geometry, {"crs": crs})


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def geohash_long(lon: Column, lat: Column, bits: int = 60) -> Column:
    """Interleaved bits of longitude and latitude, longitude first."""
    n_lon, n_lat = (bits + 1) // 2, bits // 2
    cell = lambda c, low, span, n: F.least(F.greatest(F.floor((c - low) / span * 2.0**n), F.lit(0)), F.lit(2**n - 1)).cast("long")
    cells = F.struct(cell(lon, -180.0, 360.0, n_lon).alias("x"), cell(lat, -90.0, 180.0, n_lat).alias("y"))

    def bit(c: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, F.getbit(c["x"], (n_lon - 1 - F.floor(i / 2)).cast("int"))).otherwise(F.getbit(c["y"], (n_lat - 1 - F.floor(i / 2)).cast("int"))).cast("long")

    return _let(cells, lambda c: F.aggregate(F.sequence(F.lit(0), F.lit(bits - 1)), F.lit(0).cast("long"), lambda acc, i: acc * 2 + bit(c, i)))


def geohash(lon: Column, lat: Column, length: int = 12) -> Column:
    """Base-32 text of up to 12 characters."""

    def text(bits: Column) -> Column:
        digit = lambda i: F.substring(F.lit(BASE32), F.call_function("shiftright", bits, (5 * (length - 1 - i)).cast("int")).bitwiseAND(F.lit(31)).cast("int") + 1, F.lit(1))
        return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(length - 1)), digit), "")

    return F.when(lon.isNotNull() & lat.isNotNull(), _let(geohash_long(lon, lat, 5 * length), text))


def geohash_to_long(text: Column) -> Column:
    """The bits of a base-32 text."""
    digits = F.create_map(*(F.lit(x) for i, d in enumerate(BASE32) for x in (d, i)))
    letters = F.filter(F.split(F.lower(text), ""), lambda x: x != "")
    return F.aggregate(letters, F.lit(0).cast("long"), lambda acc, x: acc * 32 + F.try_element_at(digits, x))


def geohash_center(text: Column) -> tuple[Column, Column]:
    """Longitude and latitude of the middle of the cell."""
    cell = F.struct(geohash_to_long(text).alias("bits"), (F.length(text) * 5).alias("n"))

    def half(first: int) -> Column:
        def value(c: Column) -> Column:
            places = F.filter(F.sequence(F.lit(0), c["n"] - 1), lambda i: i % 2 == first)
            return F.aggregate(places, F.lit(0.0), lambda acc, i: acc * 2 + F.getbit(c["bits"], c["n"] - 1 - i), lambda v: (v + 0.5) / F.pow(F.lit(2.0), F.floor((c["n"] + 1 - first) / 2)))

        return _let(cell, value)

    return half(0) * 360 - 180, half(1) * 180 - 90


def compatible_type(layer: Column, geometry: Column) -> Column:
    """A layer of points or lines takes also their multi type; any other layer type takes MULTI_POLYGON."""
    kind = F.upper(layer)
    return F.when(kind == "POINT", geometry.isin("POINT", "MULTI_POINT")).when(kind == "LINE", geometry.isin("LINE", "MULTI_LINE")).otherwise(geometry == "MULTI_POLYGON")


def layer_extent(df: DataFrame, geometry: str, keys: Sequence[str] = ()) -> DataFrame:
    """min_x, min_y, max_x, max_y of all coordinates of each layer."""
    pair = F.lit(rf"({NUMBER})\s+({NUMBER})")
    xs = F.transform(F.regexp_extract_all(geometry, pair, 1), lambda v: v.cast("double"))
    ys = F.transform(F.regexp_extract_all(geometry, pair, 2), lambda v: v.cast("double"))
    return df.groupBy(*keys).agg(F.min(F.array_min(xs)).alias("min_x"), F.min(F.array_min(ys)).alias("min_y"), F.max(F.array_max(xs)).alias("max_x"), F.max(F.array_max(ys)).alias("max_y"))


def tile_of(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """x and y of the web tile of a point, y from the north."""
    n = 2**zoom
    clip = lambda c: F.least(F.greatest(F.floor(c), F.lit(0)), F.lit(n - 1)).cast("long")
    r = F.radians(lat)
    return clip((lon + 180) / 360 * n), clip((1 - F.log(F.tan(r) + 1 / F.cos(r)) / math.pi) / 2 * n)


def assign_tiles(df: DataFrame, geometry: str, zoom: int) -> DataFrame:
    """A row for each tile that the geometry's box (WKT in degrees) touches; ``tiles.cover_tiles`` gives those of the geometry itself."""
    pair = F.lit(rf"({NUMBER})\s+({NUMBER})")
    xs = F.transform(F.regexp_extract_all(geometry, pair, 1), lambda v: v.cast("double"))
    ys = F.transform(F.regexp_extract_all(geometry, pair, 2), lambda v: v.cast("double"))
    west, north = tile_of(F.array_min(xs), F.array_max(ys), zoom)
    east, south = tile_of(F.array_max(xs), F.array_min(ys), zoom)
    return df.withColumn("tile_x", F.explode(F.sequence(west, east))).withColumn("tile_y", F.explode(F.sequence(north, south)))


def clip_lines(wkt: str | None, box: tuple[float, float, float, float]) -> list[str]:
    """Parts of a LINESTRING inside a box, by Liang and Barsky's test of each segment."""
    out: list[list[tuple[float, float]]] = []
    if wkt is None:
        return []
    x0, y0, x1, y1 = box
    for m in _RING.finditer(wkt):
        pts = _points(m[1])
        for (ax, ay), (bx, by) in zip(pts, pts[1:]):
            t0, t1, dx, dy = 0.0, 1.0, bx - ax, by - ay
            for p, q in ((-dx, ax - x0), (dx, x1 - ax), (-dy, ay - y0), (dy, y1 - ay)):
                if p == 0:
                    if q < 0:
                        t0 = 2.0
                elif p < 0:
                    t0 = max(t0, q / p)
                else:
                    t1 = min(t1, q / p)
            if t0 <= t1:
                a, b = (ax + t0 * dx, ay + t0 * dy), (ax + t1 * dx, ay + t1 * dy)
                if out and out[-1][-1] == a:
                    out[-1].append(b)
                else:
                    out.append([a, b])
    return [f"LINESTRING ({_text(np.array(line))})" for line in out]


def read_postgis(spark, url: str, table: str, geometry: str, columns: Sequence[str], properties: dict[str, str] | None = None) -> DataFrame:
    """A table with its geometry as WKT, made by the database."""
    query = f"SELECT {', '.join(columns)}, ST_AsText({geometry}) AS {geometry} FROM {table}"
    return spark.read.format("jdbc").options(url=url, query=query, **(properties or {})).load()


def postgis_insert(table: str, columns: Sequence[str], geometry: str, srid: int) -> str:
    """The statement that inserts a row with WKT for its geometry."""
    return f"INSERT INTO {table} ({', '.join(columns)}, {geometry}) VALUES ({', '.join('?' * len(columns))}, ST_GeomFromText(?, {srid}))"

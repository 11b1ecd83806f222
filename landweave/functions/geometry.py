"""Polygons as array<array<array<struct<x,y>>>> (polygons, rings, points): measures, tests, projections."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

GEOMETRY = "array<array<array<struct<x:double,y:double>>>>"


def geom_bbox(geom: Column) -> Column:
    """struct(xmin, ymin, xmax, ymax)."""
    points = F.flatten(F.flatten(geom))
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def ring_edges(ring: Column) -> Column:
    """array<struct<a, b>> of a ring's edges, closed."""
    after = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.zip_with(ring, after, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def ring_area(ring: Column) -> Column:
    return F.abs(_sum(F.transform(ring_edges(ring), lambda e: e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]))) / 2


def ring_length(ring: Column) -> Column:
    return _sum(F.transform(ring_edges(ring), lambda e: F.sqrt(F.pow(e["b"]["x"] - e["a"]["x"], 2) + F.pow(e["b"]["y"] - e["a"]["y"], 2))))


def polygon_area(geom: Column) -> Column:
    """Area; a polygon's later rings are holes."""
    return _sum(F.transform(geom, lambda rings: F.aggregate(F.transform(rings, lambda r, i: F.when(i == 0, ring_area(r)).otherwise(-ring_area(r))), F.lit(0.0), lambda s, v: s + v)))


def polygon_perimeter(geom: Column) -> Column:
    """Length of all rings, holes included."""
    return _sum(F.transform(F.flatten(geom), ring_length))


def bbox_perimeter(geom: Column) -> Column:
    b = geom_bbox(geom)
    return 2 * (b["xmax"] - b["xmin"] + b["ymax"] - b["ymin"])


def shape_metrics(area: Column, perimeter: Column, box: Column) -> dict[str, Column]:
    """para, compact, smooth, shape and frac of an area, a perimeter and the bounding box's perimeter."""
    frac = F.when((area <= 1) | (perimeter / 4 < 1), F.lit(1.0)).otherwise(2 * F.log(perimeter / 4) / F.log(area))
    return {
        "para": F.try_divide(perimeter, area),
        "compact": F.try_divide(area * box, F.sqrt(area)),
        "smooth": F.try_divide(area * box, perimeter),
        "shape": F.try_divide(4 * F.lit(math.pi) * area, perimeter * perimeter),
        "frac": frac,
    }


def contains_point(geom: Column, x: Column, y: Column) -> Column:
    """Even-odd test over all rings: holes flip it. Edges are half open in y."""
    edges = F.flatten(F.transform(F.flatten(geom), ring_edges))

    def flips(e: Column) -> Column:
        a, b = e["a"], e["b"]
        across = x < F.try_divide((b["x"] - a["x"]) * (y - a["y"]), b["y"] - a["y"]) + a["x"]
        return ((a["y"] > y) != (b["y"] > y)) & F.coalesce(across, F.lit(False))

    return F.size(F.filter(edges, flips)) % 2 == 1


def centroid(geom: Column) -> Column:
    """struct(x, y): the centre of the area; a polygon's later rings are holes."""

    def moment(ring: Column, sign: Column) -> Column:
        cross = lambda e: e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]
        edges = ring_edges(ring)
        area = _sum(F.transform(edges, cross)) / 2
        way = sign * F.sign(area)
        of = lambda k: way * _sum(F.transform(edges, lambda e: (e["a"][k] + e["b"][k]) * cross(e))) / 6
        return F.struct((way * area).alias("area"), of("x").alias("x"), of("y").alias("y"))

    parts = F.flatten(F.transform(geom, lambda rings: F.transform(rings, lambda r, i: moment(r, F.when(i == 0, 1.0).otherwise(-1.0)))))
    area = _sum(F.transform(parts, lambda m: m["area"]))
    return F.struct(*[F.try_divide(_sum(F.transform(parts, lambda m: m[k])), area).alias(k) for k in ("x", "y")])


def within(geom: Column, point: Column) -> Column:
    """Whether a point lies inside, not on an edge."""
    x, y = point["x"], point["y"]

    def on(e: Column) -> Column:
        a, b = e["a"], e["b"]
        line = (b["x"] - a["x"]) * (y - a["y"]) == (b["y"] - a["y"]) * (x - a["x"])
        return line & x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))

    return contains_point(geom, x, y) & ~F.exists(F.flatten(F.transform(F.flatten(geom), ring_edges)), on)


def bbox_overlaps(a: Column, b: Column) -> Column:
    return (a["xmin"] <= b["xmax"]) & (b["xmin"] <= a["xmax"]) & (a["ymin"] <= b["ymax"]) & (b["ymin"] <= a["ymax"])


def bbox_contained(inner: Column, outer: Column) -> Column:
    return (inner["xmin"] >= outer["xmin"]) & (inner["ymin"] >= outer["ymin"]) & (inner["xmax"] <= outer["xmax"]) & (inner["ymax"] <= outer["ymax"])


def parse_box(text: Column) -> Column:
    """struct(xmin, ymin, xmax, ymax) of `BOX(xmin ymin,xmax ymax)`; null where it is none."""
    pattern = r"BOX\(\s*(\S+)\s+([^\s,]+)\s*,\s*(\S+)\s+([^\s)]+)\s*\)"
    part = lambda i: F.nullif(F.regexp_extract(text, pattern, i), F.lit("")).cast("double")
    return F.struct(*[part(i + 1).alias(n) for i, n in enumerate(("xmin", "ymin", "xmax", "ymax"))])


def tile_corner_lonlat(z: Column, x: Column, y: Column) -> Column:
    """struct(lon, lat) of a web map tile's upper left corner."""
    n = F.pow(F.lit(2.0), z)
    return F.struct((x / n * 360 - 180).alias("lon"), F.degrees(F.atan(F.sinh(F.lit(math.pi) * (1 - 2 * y / n)))).alias("lat"))


def lambert_conformal(lon: Column, lat: Column, lat1: float = 17.5, lat2: float = 29.5, lat0: float = 12.0, lon0: float = -102.0, x0: float = 2_500_000.0, y0: float = 0.0, a: float = 6378137.0, f: float = 1 / 298.257223563) -> Column:
    """struct(x, y) of a longitude and latitude in degrees, conic with two standard parallels."""
    e = math.sqrt(f * (2 - f))
    ts = lambda p: math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)
    ms = lambda p: math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)
    p1, p2, p0 = map(math.radians, (lat1, lat2, lat0))
    n = (math.log(ms(p1)) - math.log(ms(p2))) / (math.log(ts(p1)) - math.log(ts(p2)))
    big_f = ms(p1) / (n * ts(p1) ** n)
    r0 = a * big_f * ts(p0) ** n
    p = F.radians(lat)
    sin = F.sin(p) * e
    t = F.tan(F.lit(math.pi / 4) - p / 2) / F.pow((1 - sin) / (1 + sin), F.lit(e / 2))
    r = F.lit(a * big_f) * F.pow(t, F.lit(n))
    theta = F.lit(n) * (F.radians(lon) - math.radians(lon0))
    return F.struct((F.lit(x0) + r * F.sin(theta)).alias("x"), (F.lit(y0 + r0) - r * F.cos(theta)).alias("y"))


def lambert_conformal_inverse(x: Column, y: Column, lat1: float = 17.5, lat2: float = 29.5, lat0: float = 12.0, lon0: float = -102.0, x0: float = 2_500_000.0, y0: float = 0.0, a: float = 6378137.0, f: float = 1 / 298.257223563) -> Column:
    """struct(x, y): longitude and latitude in degrees."""
    e = math.sqrt(f * (2 - f))
    ts = lambda p: math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)
    ms = lambda p: math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)
    p1, p2, p0 = map(math.radians, (lat1, lat2, lat0))
    n = (math.log(ms(p1)) - math.log(ms(p2))) / (math.log(ts(p1)) - math.log(ts(p2)))
    big_f = ms(p1) / (n * ts(p1) ** n)
    r0 = a * big_f * ts(p0) ** n
    dx, dy = x - F.lit(x0), F.lit(r0 + y0) - y
    t = F.pow(F.sqrt(dx * dx + dy * dy) / F.lit(a * big_f), F.lit(1 / n))
    p = F.lit(math.pi / 2) - 2 * F.atan(t)
    for _ in range(5):  # the fixed point settles below a millionth of a degree in three
        p = F.lit(math.pi / 2) - 2 * F.atan(t * F.pow((1 - e * F.sin(p)) / (1 + e * F.sin(p)), F.lit(e / 2)))
    return F.struct((F.degrees(F.atan2(dx, dy)) / n + lon0).alias("x"), F.degrees(p).alias("y"))


def _authalic(e: float, phi: float) -> float:
    s = math.sin(phi)
    return (1 - e * e) * (s / (1 - e * e * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))


def _equal_area(lat0: float, a: float, f: float) -> tuple[float, float, float, float, float]:
    """e, the authalic q of the pole, the authalic radius, the centre's authalic latitude, and the stretch."""
    e, p0 = math.sqrt(f * (2 - f)), math.radians(lat0)
    pole = _authalic(e, math.pi / 2)
    radius, b0 = a * math.sqrt(pole / 2), math.asin(_authalic(e, p0) / pole)
    return e, pole, radius, b0, a * math.cos(p0) / math.sqrt(1 - (e * math.sin(p0)) ** 2) / (radius * math.cos(b0))


def lambert_equal_area(lon: Column, lat: Column, lat0: float, lon0: float, x0: float = 0.0, y0: float = 0.0, a: float = 6378137.0, f: float = 1 / 298.257223563) -> Column:
    """struct(x, y) of a longitude and latitude in degrees, azimuthal and of equal area around a centre that is no pole."""
    e, pole, radius, b0, d = _equal_area(lat0, a, f)
    s, lam = F.sin(F.radians(lat)), F.radians(lon - F.lit(lon0))
    q = (1 - e * e) * (s / (1 - e * e * s * s) - F.log((1 - e * s) / (1 + e * s)) / (2 * e))
    beta = F.asin(F.greatest(F.least(q / pole, F.lit(1.0)), F.lit(-1.0)))
    b = radius * F.sqrt(2 / (1 + math.sin(b0) * F.sin(beta) + math.cos(b0) * F.cos(beta) * F.cos(lam)))
    x = b * d * F.cos(beta) * F.sin(lam)
    y = b / d * (math.cos(b0) * F.sin(beta) - math.sin(b0) * F.cos(beta) * F.cos(lam))
    return F.struct((x0 + x).alias("x"), (y0 + y).alias("y"))


def lambert_equal_area_inverse(x: Column, y: Column, lat0: float, lon0: float, x0: float = 0.0, y0: float = 0.0, a: float = 6378137.0, f: float = 1 / 298.257223563) -> Column:
    """struct(x, y): longitude and latitude in degrees."""
    e, pole, radius, b0, d = _equal_area(lat0, a, f)
    dx, dy = (x - F.lit(x0)) / d, (y - F.lit(y0)) * d
    far = F.sqrt(dx * dx + dy * dy)
    c = 2 * F.asin(far / (2 * radius))
    beta = F.asin(F.cos(c) * math.sin(b0) + F.coalesce(F.try_divide(dy * F.sin(c), far), F.lit(0.0)) * math.cos(b0))
    lam = F.atan2(dx * F.sin(c), far * math.cos(b0) * F.cos(c) - dy * math.sin(b0) * F.sin(c))
    series = (e**2 / 3 + 31 * e**4 / 180 + 517 * e**6 / 5040, 23 * e**4 / 360 + 251 * e**6 / 3780, 761 * e**6 / 45360)
    lat = beta
    for k, v in enumerate(series, 1):
        lat = lat + v * F.sin(2 * k * beta)
    es = e * F.sin(lat)  # the series is right to about two millimetres; a step of Newton's method settles the rest
    off = F.sin(beta) * (pole / (1 - e * e)) - F.sin(lat) / (1 - es * es) + F.log((1 - es) / (1 + es)) / (2 * e)
    lat = lat + F.coalesce(F.try_divide((1 - es * es) * (1 - es * es) * off, 2 * F.cos(lat)), F.lit(0.0))
    return F.struct((F.degrees(lam) + lon0).alias("x"), F.degrees(lat).alias("y"))


def transverse_mercator(lon: Column, lat: Column, zone: int, south: bool = False, a: float = 6378137.0, f: float = 1 / 298.257223563) -> Column:
    """struct(x, y) in a UTM zone, by the series in the third flattening."""
    n = f / (2 - f)
    big_a = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    e = 2 * math.sqrt(n) / (1 + n)
    p, lam = F.radians(lat), F.radians(lon - F.lit(zone * 6.0 - 183.0))
    t = F.sinh(F.atanh(F.sin(p)) - e * F.atanh(e * F.sin(p)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, k in enumerate(alpha, 1):
        x = x + k * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + k * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return F.struct((F.lit(500_000.0) + 0.9996 * big_a * x).alias("x"), (F.lit(10_000_000.0 if south else 0.0) + 0.9996 * big_a * y).alias("y"))


def transverse_mercator_inverse(x: Column, y: Column, zone: Column, south: Column, a: float = 6378137.0, f: float = 1 / 298.257223563) -> Column:
    """struct(x, y): longitude and latitude in degrees of coordinates in a UTM zone."""
    n = f / (2 - f)
    big_a = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    xi = (y - F.when(south, 10_000_000.0).otherwise(0.0)) / (0.9996 * big_a)
    eta = (x - 500_000.0) / (0.9996 * big_a)
    p, q = xi, eta
    for j, k in enumerate(beta, 1):
        p = p - k * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        q = q - k * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(p) / F.cosh(q))
    lat = chi
    for j, k in enumerate(delta, 1):
        lat = lat + k * F.sin(2 * j * chi)
    lon = F.degrees(F.atan2(F.sinh(q), F.cos(p))) + zone * 6.0 - 183.0
    return F.struct(lon.alias("x"), F.degrees(lat).alias("y"))


def flat_edges(geom: Column) -> Column:
    """All edges of a geometry as one array of doubles, four to an edge."""
    edges = F.flatten(F.transform(F.flatten(geom), ring_edges))
    return F.flatten(F.transform(edges, lambda e: F.array(e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"])))


def _edges_meet(e: Column, f: Column) -> Column:
    def side(p: Column, q: Column, r: Column) -> Column:
        return F.signum((q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"]))

    near = F.lit(True)
    for k in ("x", "y"):
        near = near & (F.least(e["a"][k], e["b"][k]) <= F.greatest(f["a"][k], f["b"][k])) & (F.least(f["a"][k], f["b"][k]) <= F.greatest(e["a"][k], e["b"][k]))
    return near & (side(e["a"], e["b"], f["a"]) * side(e["a"], e["b"], f["b"]) <= 0) & (side(f["a"], f["b"], e["a"]) * side(f["a"], f["b"], e["b"]) <= 0)


def intersects(a: Column, b: Column) -> Column:
    """Whether two geometries share a point, borders included: edges meet, or one has a ring's start inside the other."""
    ea, eb = (F.flatten(F.transform(F.flatten(g), ring_edges)) for g in (a, b))
    meet = F.exists(ea, lambda e: F.exists(eb, lambda f: _edges_meet(e, f)))
    starts = lambda inner, outer: F.exists(F.flatten(inner), lambda r: contains_point(outer, F.get(r, F.lit(0))["x"], F.get(r, F.lit(0))["y"]))
    return meet | starts(a, b) | starts(b, a)


def feature_geometry(text: Column) -> Column:
    """The geometry of a GeoJSON feature of a polygon or multipolygon, rings without their closing point; null for others."""
    kind, points = F.get_json_object(text, "$.geometry.type"), F.get_json_object(text, "$.geometry.coordinates")
    one, many = F.from_json(points, "array<array<array<double>>>"), F.from_json(points, "array<array<array<array<double>>>>")
    geom = F.when(kind == "Polygon", F.array(one)).when(kind == "MultiPolygon", many)

    def opened(ring: Column) -> Column:
        closed = (F.size(ring) > 1) & (F.get(ring, F.lit(0)) == F.get(ring, F.size(ring) - 1))
        kept = F.slice(ring, F.lit(1), F.size(ring) - F.when(closed, 1).otherwise(0))
        return F.transform(kept, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))

    return F.transform(geom, lambda rings: F.transform(rings, opened))


def reproject(geom: Column, project) -> Column:
    """Every point of a geometry projected, holes kept; `project` takes and gives coordinates."""
    return F.transform(geom, lambda rings: F.transform(rings, lambda ring: F.transform(ring, lambda p: project(p["x"], p["y"]))))

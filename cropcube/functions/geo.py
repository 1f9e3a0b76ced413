"""Map projections and raster-grid arithmetic as Spark Column expressions.

All functions return Columns, so they run inside whole-stage codegen (or a
higher-order function for the fixed-step latitude iteration) with no Python
on the executors.  Angles are degrees on the outside, radians inside.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.functions.hof import let, record


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


# --- EPSG:5070 parameters, derived once on the driver from the definition ---
_A = K.GRS80_A
_F = 1.0 / K.GRS80_INV_F
_E2 = 2 * _F - _F * _F
_E = math.sqrt(_E2)


def _q(phi: float) -> float:
    s = math.sin(phi)
    return (1 - _E2) * (s / (1 - _E2 * s * s)
                        - (1 / (2 * _E)) * math.log((1 - _E * s) / (1 + _E * s)))


def _m(phi: float) -> float:
    s = math.sin(phi)
    return math.cos(phi) / math.sqrt(1 - _E2 * s * s)


_P1, _P2, _P0 = (math.radians(v) for v in (K.ALBERS_LAT1, K.ALBERS_LAT2, K.ALBERS_LAT0))
_L0 = math.radians(K.ALBERS_LON0)
ALBERS_N = (_m(_P1) ** 2 - _m(_P2) ** 2) / (_q(_P2) - _q(_P1))
ALBERS_C = _m(_P1) ** 2 + ALBERS_N * _q(_P1)
ALBERS_RHO0 = _A * math.sqrt(ALBERS_C - ALBERS_N * _q(_P0)) / ALBERS_N
ALBERS_ITERATIONS = 5


def _q_col(phi: Column) -> Column:
    s = F.sin(phi)
    return F.lit(1 - _E2) * (s / (F.lit(1.0) - F.lit(_E2) * s * s)
                             - F.lit(1 / (2 * _E)) * F.log((F.lit(1.0) - F.lit(_E) * s)
                                                           / (F.lit(1.0) + F.lit(_E) * s)))


def lonlat_to_albers(lon, lat) -> Column:
    """EPSG:4326 -> EPSG:5070; returns struct<x DOUBLE, y DOUBLE>."""
    lon, lat = _c(lon), _c(lat)
    rho = F.lit(_A) * F.sqrt(F.lit(ALBERS_C) - F.lit(ALBERS_N) * _q_col(F.radians(lat))) / F.lit(ALBERS_N)
    theta = F.lit(ALBERS_N) * (F.radians(lon) - F.lit(_L0))
    return F.struct(
        (rho * F.sin(theta)).alias("x"),
        (F.lit(ALBERS_RHO0) - rho * F.cos(theta)).alias("y"),
    )


def albers_to_lonlat(x, y, digits: int | None = None) -> Column:
    """EPSG:5070 -> EPSG:4326; returns struct<lon DOUBLE, lat DOUBLE>.

    Latitude is solved from the authalic q with a fixed number of Newton
    steps (``aggregate`` over a 5-element sequence), exact to ~1e-14 deg.
    """
    x, y = _c(x).cast("double"), _c(y).cast("double")

    def solve(p):
        q, theta = p["q"], p["theta"]
        lon = F.degrees(F.lit(_L0) + theta / F.lit(ALBERS_N))

        def step(phi, _i):
            s = F.sin(phi)
            one_minus = F.lit(1.0) - F.lit(_E2) * s * s
            return phi + one_minus * one_minus / (F.lit(2.0) * F.cos(phi)) * (
                q / F.lit(1 - _E2) - s / one_minus
                + F.lit(1 / (2 * _E)) * F.log((F.lit(1.0) - F.lit(_E) * s) / (F.lit(1.0) + F.lit(_E) * s)))

        lat = F.degrees(F.aggregate(F.sequence(F.lit(1), F.lit(ALBERS_ITERATIONS)), F.asin(q / F.lit(2.0)), step))
        if digits is not None:
            lon, lat = F.round(lon, digits), F.round(lat, digits)
        return record(lon=lon, lat=lat)

    def polar(xy):
        dy = F.lit(ALBERS_RHO0) - xy["y"]
        rho2 = xy["x"] * xy["x"] + dy * dy
        return record(q=(F.lit(ALBERS_C) - rho2 * F.lit(ALBERS_N * ALBERS_N / (_A * _A))) / F.lit(ALBERS_N),
                      theta=F.atan2(xy["x"], dy))

    return let(let(record(x=x, y=y), polar), solve)


# --- UTM (Transverse Mercator, Krueger n-series to third order) ---
_WF = 1.0 / K.WGS84_INV_F
_N = _WF / (2 - _WF)
_UTM_A = K.WGS84_A / (1 + _N) * (1 + _N ** 2 / 4 + _N ** 4 / 64)
_ALPHA = [
    _N / 2 - 2 * _N ** 2 / 3 + 5 * _N ** 3 / 16,
    13 * _N ** 2 / 48 - 3 * _N ** 3 / 5,
    61 * _N ** 3 / 240,
]
_TWO_SQRT_N = 2 * math.sqrt(_N) / (1 + _N)


def utm_zone(lon) -> Column:
    return (F.floor((_c(lon) + F.lit(180.0)) / F.lit(6.0)) + F.lit(1)).cast("int")


def lonlat_to_utm(lon, lat, zone=None) -> Column:
    """EPSG:4326 -> UTM (WGS84) of ``zone`` (default: the point's own zone).

    Returns struct<zone INT, x DOUBLE, y DOUBLE>; southern latitudes get the
    10,000 km false northing.
    """
    lon, lat = _c(lon), _c(lat)
    zone = utm_zone(lon) if zone is None else _c(zone).cast("int")
    k = F.lit(K.UTM_K0 * _UTM_A)

    def conformal(p):
        phi = F.radians(p["lat"])
        lam = F.radians(p["lon"]) - F.radians(p["zone"].cast("double") * F.lit(6.0) - F.lit(183.0))
        t = F.sinh(F.atanh(F.sin(phi)) - F.lit(_TWO_SQRT_N) * F.atanh(F.lit(_TWO_SQRT_N) * F.sin(phi)))
        return let(record(t=t, lam=lam), lambda v: record(
            xi=F.atan(v["t"] / F.cos(v["lam"])),
            eta=F.atanh(F.sin(v["lam"]) / F.sqrt(F.lit(1.0) + v["t"] * v["t"])),
            zone=p["zone"], south=p["lat"] < 0))

    def series(c):
        xi, eta = c["xi"], c["eta"]
        e_sum, n_sum = eta, xi
        for j, alpha in enumerate(_ALPHA, start=1):
            e_sum = e_sum + F.lit(alpha) * F.cos(F.lit(2.0 * j) * xi) * F.sinh(F.lit(2.0 * j) * eta)
            n_sum = n_sum + F.lit(alpha) * F.sin(F.lit(2.0 * j) * xi) * F.cosh(F.lit(2.0 * j) * eta)
        north = F.when(c["south"], k * n_sum + F.lit(K.UTM_FALSE_NORTHING_SOUTH)).otherwise(k * n_sum)
        return record(zone=c["zone"], x=F.lit(K.UTM_FALSE_EASTING) + k * e_sum, y=north)

    return let(let(record(lon=lon, lat=lat, zone=zone), conformal), series)


def lonlat_to_web_mercator(lon, lat) -> Column:
    """EPSG:4326 -> EPSG:3857; struct<x, y>."""
    lon, lat = _c(lon), _c(lat)
    r = F.lit(K.WEB_MERCATOR_R)
    return F.struct((r * F.radians(lon)).alias("x"),
                    (r * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / F.lit(2.0)))).alias("y"))


# --- raster grid arithmetic ---

def cell_center(row, col, x0, y0, dx, dy) -> Column:
    """(row, col) -> x, y of the cell centre of a north-up raster."""
    return F.struct((_c(x0) + (_c(col) + F.lit(0.5)) * _c(dx)).alias("x"),
                    (_c(y0) - (_c(row) + F.lit(0.5)) * _c(dy)).alias("y"))


def cell_of(x, y, x0, y0, dx, dy) -> Column:
    """x, y -> (row, col) of the cell containing the point (nearest-cell sample)."""
    return record(row=F.floor((_c(y0) - _c(y)) / _c(dy)).cast("int"),
                  col=F.floor((_c(x) - _c(x0)) / _c(dx)).cast("int"))


# --- bounding boxes ---

def parse_bbox(text) -> Column:
    """"left, bottom, right, top" (commas, optional spaces) -> struct of 4 BIGINT."""
    parts = F.split(F.trim(_c(text)), r",\s*")
    return F.struct(*[F.element_at(parts, i + 1).cast("bigint").alias(n)
                      for i, n in enumerate(["left", "bottom", "right", "top"])])


def bbox_to_lonlat(bbox_struct, mode: str = "envelope") -> Column:
    """Reproject an EPSG:5070 box to lon/lat bounds.

    ``mode="corners"`` transforms the lower-left and upper-right corners only
    (the original behaviour); ``"envelope"`` takes min/max over all four
    corners so every point of the box is inside the result.
    """
    b = _c(bbox_struct)
    corners = record(ll=albers_to_lonlat(b["left"], b["bottom"]), lr=albers_to_lonlat(b["right"], b["bottom"]),
                     ur=albers_to_lonlat(b["right"], b["top"]), ul=albers_to_lonlat(b["left"], b["top"]))

    def bounds(c):
        if mode == "corners":
            return record(min_lon=c["ll"]["lon"], min_lat=c["ll"]["lat"], max_lon=c["ur"]["lon"], max_lat=c["ur"]["lat"])
        pts = [c[n] for n in ("ll", "lr", "ur", "ul")]
        return record(min_lon=F.least(*[p["lon"] for p in pts]), min_lat=F.least(*[p["lat"] for p in pts]),
                      max_lon=F.greatest(*[p["lon"] for p in pts]), max_lat=F.greatest(*[p["lat"] for p in pts]))
    return let(corners, bounds)


def bounds_ring(min_x, min_y, max_x, max_y) -> Column:
    """Closed 5-point ring (counter-clockwise) of a box: array<struct<x,y>>."""
    pts = [(min_x, min_y), (max_x, min_y), (max_x, max_y), (min_x, max_y), (min_x, min_y)]
    return F.array(*[F.struct(_c(a).alias("x"), _c(b).alias("y")) for a, b in pts])


def boxes_intersect(a_min_x, a_min_y, a_max_x, a_max_y, b_min_x, b_min_y, b_max_x, b_max_y) -> Column:
    """Closed-box overlap predicate."""
    return ((_c(a_min_x) <= _c(b_max_x)) & (_c(b_min_x) <= _c(a_max_x))
            & (_c(a_min_y) <= _c(b_max_y)) & (_c(b_min_y) <= _c(a_max_y)))


def bbox_corners(bbox_struct) -> Column:
    """An EPSG:5070 box as the ring of its four corners in lon/lat: array<struct<x,y>>, no corner twice."""
    b = _c(bbox_struct)

    def point(x, y):
        return let(albers_to_lonlat(x, y), lambda p: record(x=p["lon"], y=p["lat"]))
    return F.array(point(b["left"], b["bottom"]), point(b["right"], b["bottom"]), point(b["right"], b["top"]), point(b["left"], b["top"]))


def ring_bounds(ring) -> Column:
    """Bounds of a ring: struct<min_x, min_y, max_x, max_y>."""
    def bounds(r):
        xs, ys = F.transform(r, lambda p: p["x"]), F.transform(r, lambda p: p["y"])
        return record(min_x=F.array_min(xs), min_y=F.array_min(ys), max_x=F.array_max(xs), max_y=F.array_max(ys))
    return let(_c(ring), bounds)


def convex_intersect(a, b) -> Column:
    """Whether two closed convex rings (corners in order, either way round) share a point.

    Separating axes: they are apart exactly if, along the normal of some edge of either, all
    of one lies before all of the other.
    """
    def edges(r):
        return F.transform(r, lambda p, i: let(F.get(r, F.pmod(i + 1, F.size(r))), lambda q: record(x=p["y"] - q["y"], y=q["x"] - p["x"])))

    def met(r):
        def reach(ring, axis):
            return F.transform(ring, lambda p: p["x"] * axis["x"] + p["y"] * axis["y"])

        def overlap(axis):
            return let(record(a=reach(r["a"], axis), b=reach(r["b"], axis)), lambda v: (
                (F.array_min(v["a"]) <= F.array_max(v["b"])) & (F.array_min(v["b"]) <= F.array_max(v["a"]))))
        return F.forall(F.concat(edges(r["a"]), edges(r["b"])), overlap)
    return let(record(a=_c(a), b=_c(b)), met)


def bounds_text(min_x, min_y, max_x, max_y) -> Column:
    """Integer-truncated "left, bottom, right, top" text of a box."""
    return F.concat_ws(", ", *[_c(v).cast("bigint").cast("string") for v in (min_x, min_y, max_x, max_y)])

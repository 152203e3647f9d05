"""Distances and positions on the WGS84 ellipsoid as native columns (metres, degrees)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayloom.functions.binding import let

# The WGS84 ellipsoid.
SEMI_MAJOR_M = 6378137.0
FLATTENING = 1 / 298.257223563

SEMI_MINOR_M = SEMI_MAJOR_M * (1 - FLATTENING)
ECCENTRICITY2 = FLATTENING * (2 - FLATTENING)
SECOND_ECCENTRICITY2 = ECCENTRICITY2 / (1 - ECCENTRICITY2)

# Up to this length, and away from the poles, closed forms around the middle of an edge are
# exact to 5 micrometres.
SHORT_EDGE_M = 1000.0
POLAR_LATITUDE = 80.0
# Enough for sub-micrometre convergence on any edge that is not nearly antipodal.
INVERSE_STEPS = 5
DIRECT_STEPS = 3


def short_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Closed-form distance for nearby points."""
    mid = F.radians((y1 + y2) / 2.0)
    curvature = F.struct(
        (1.0 - ECCENTRICITY2 * F.sin(mid) * F.sin(mid)).alias("q"), F.cos(mid).alias("cos_mid")
    )

    def metres(c: Column) -> Column:
        north = SEMI_MAJOR_M * (1 - ECCENTRICITY2) / (c.q * F.sqrt(c.q)) * F.radians(y2 - y1)
        east = SEMI_MAJOR_M / F.sqrt(c.q) * c.cos_mid * F.radians(x2 - x1)
        return F.sqrt(north * north + east * east)

    return let(curvature, metres)


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Geodesic distance: closed form for short edges, fixed-step iteration for long ones."""
    return let(
        short_distance(x1, y1, x2, y2),
        lambda d: F.when(_is_short(d, y1), d).otherwise(inverse(x1, y1, x2, y2).metres),
    )


def _is_short(metres: Column, y: Column) -> Column:
    return (metres < SHORT_EDGE_M) & (F.abs(y) < POLAR_LATITUDE)


def point_on_edge(
    x1: Column, y1: Column, x2: Column, y2: Column, edge_m: Column, into_m: Column
) -> Column:
    """``struct(x, y)`` on an edge of known length, this many metres from its start."""
    along = lambda: point_along(x1, y1, inverse(x1, y1, x2, y2).azimuth, into_m)
    return F.when(_is_short(edge_m, y1), _near_point(x1, y1, x2, y2, edge_m, into_m)).otherwise(along())


def _near_point(x1: Column, y1: Column, x2: Column, y2: Column, edge_m: Column, into_m: Column) -> Column:
    """Second-order solution of the geodesic equations, curvature taken mid-edge."""
    mid = let(
        F.radians((y1 + y2) / 2.0), lambda lat: F.struct(F.sin(lat).alias("s"), F.cos(lat).alias("c"))
    )
    part = F.coalesce(F.try_divide(into_m, edge_m), F.lit(0.0))

    def bend(m: Column) -> Column:
        q = 1.0 - ECCENTRICITY2 * m.s * m.s
        return F.struct(
            ((2.0 * (1 - ECCENTRICITY2)) * m.s / (q * m.c) * (y2 - y1) * F.radians(x2 - x1)).alias("x"),
            (
                (-3.0 * ECCENTRICITY2) * m.s * m.c / q * (y2 - y1) * F.radians(y2 - y1)
                - m.s * m.c * q / (1 - ECCENTRICITY2) * (x2 - x1) * F.radians(x2 - x1)
            ).alias("y"),
        )

    def interpolate(b: Column) -> Column:
        return let(
            part,
            lambda t: F.struct(
                (x1 + t * (x2 - x1 + (t - 1.0) / 2.0 * b.x)).alias("x"),
                (y1 + t * (y2 - y1 + (t - 1.0) / 2.0 * b.y)).alias("y"),
            ),
        )

    return let(let(mid, bend), interpolate)


def inverse(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """``struct(metres, azimuth)`` from the first point to the second (Vincenty 1975)."""
    reduced = F.struct(
        F.radians(_one_turn(x2 - x1)).alias("lon"), _reduced_tan(y1).alias("t1"), _reduced_tan(y2).alias("t2")
    )

    def ends(r: Column) -> Column:
        """Products of sines and cosines of both reduced latitudes."""
        cc = 1.0 / F.sqrt((1.0 + r.t1 * r.t1) * (1.0 + r.t2 * r.t2))
        return let(
            F.struct(r.lon.alias("lon"), r.t1.alias("t1"), r.t2.alias("t2"), cc.alias("cc")),
            lambda e: F.aggregate(F.sequence(F.lit(0), F.lit(INVERSE_STEPS)), start(e), lambda g, _: step(e, g), finish),
        )

    def start(e: Column) -> Column:
        zero = F.lit(0.0)
        return _arc(e.lon, zero, zero, zero, zero, zero)

    def step(e: Column, g: Column) -> Column:
        """Arc on the auxiliary sphere for the current longitude, and a better longitude."""
        across = F.sqrt(1.0 + e.t1 * e.t1) * e.cc * F.sin(g.lon)
        along = e.cc * (e.t2 - e.t1 * F.cos(g.lon))
        legs = F.struct(
            across.alias("across"),
            along.alias("along"),
            F.hypot(across, along).alias("sin"),
            (e.cc * (e.t1 * e.t2 + F.cos(g.lon))).alias("cos"),
        )

        def turn(q: Column) -> Column:
            sin_alpha = F.coalesce(F.try_divide(e.cc * F.sin(g.lon), q.sin), F.lit(0.0))
            return let(sin_alpha, lambda sa: measure(q, sa, 1.0 - sa * sa))

        def measure(q: Column, sa: Column, c2: Column) -> Column:
            cos_2m = q.cos - F.coalesce(F.try_divide(2.0 * e.t1 * e.t2 * e.cc, c2), F.lit(0.0))
            return let(
                cos_2m,
                lambda m: _arc(
                    e.lon + _longitude_excess(F.atan2(q.sin, q.cos), q.sin, q.cos, m, sa, c2),
                    q.across, q.along, F.atan2(q.sin, q.cos), c2, m,
                ),
            )

        return let(legs, turn)

    def finish(g: Column) -> Column:
        length = let(
            _series(g.cos2_alpha * SECOND_ECCENTRICITY2),
            lambda s: SEMI_MINOR_M * s.a * (g.sigma - _arc_correction(s.b, g.sigma, g.cos_2m)),
        )
        return F.struct(length.alias("metres"), F.atan2(g.across, g.along).alias("azimuth"))

    return let(reduced, ends)


def _arc(lon: Column, across: Column, along: Column, sigma: Column, cos2_alpha: Column, cos_2m: Column) -> Column:
    return F.struct(
        lon.alias("lon"),
        across.alias("across"),
        along.alias("along"),
        sigma.alias("sigma"),
        cos2_alpha.alias("cos2_alpha"),
        cos_2m.alias("cos_2m"),
    )


def point_along(x1: Column, y1: Column, azimuth: Column, metres: Column) -> Column:
    """``struct(x, y)`` reached from a point along an azimuth (Vincenty 1975, direct)."""
    given = F.struct(_reduced_tan(y1).alias("t"), azimuth.alias("az"), metres.alias("metres"))

    def start(g: Column) -> Column:
        return F.struct(
            (g.t / F.sqrt(1.0 + g.t * g.t)).alias("s1"),
            (1.0 / F.sqrt(1.0 + g.t * g.t)).alias("c1"),
            F.sin(g.az).alias("sin_az"),
            F.cos(g.az).alias("cos_az"),
            F.atan2(g.t, F.cos(g.az)).alias("sigma1"),
            (F.sin(g.az) / F.sqrt(1.0 + g.t * g.t)).alias("sin_alpha"),
            g.metres.alias("metres"),
        )

    def solve(p: Column) -> Column:
        cos2_alpha = 1.0 - p.sin_alpha * p.sin_alpha
        return let(_series(cos2_alpha * SECOND_ECCENTRICITY2), lambda s: walk(p, s))

    def walk(p: Column, s: Column) -> Column:
        first = p.metres / (SEMI_MINOR_M * s.a)
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(DIRECT_STEPS)),
            first,
            lambda sg, _: first + _arc_correction(s.b, sg, F.cos(2.0 * p.sigma1 + sg)),
            lambda sg: arrive(p, sg),
        )

    def arrive(p: Column, sg: Column) -> Column:
        ahead = p.s1 * F.sin(sg) - p.c1 * F.cos(sg) * p.cos_az
        lat = F.atan2(
            p.s1 * F.cos(sg) + p.c1 * F.sin(sg) * p.cos_az, (1 - FLATTENING) * F.hypot(p.sin_alpha, ahead)
        )
        lam = F.atan2(F.sin(sg) * p.sin_az, p.c1 * F.cos(sg) - p.s1 * F.sin(sg) * p.cos_az)
        excess = _longitude_excess(
            sg, F.sin(sg), F.cos(sg), F.cos(2.0 * p.sigma1 + sg), p.sin_alpha, 1.0 - p.sin_alpha * p.sin_alpha
        )
        return let(
            x1 + F.degrees(lam - excess), lambda x: F.struct(_one_turn(x).alias("x"), F.degrees(lat).alias("y"))
        )

    return let(let(given, start), solve)


def _one_turn(lon: Column) -> Column:
    return F.when(lon > 180.0, lon - 360.0).when(lon < -180.0, lon + 360.0).otherwise(lon)


def _reduced_tan(lat: Column) -> Column:
    return (1 - FLATTENING) * F.tan(F.radians(lat))


def _longitude_excess(
    sigma: Column, sin_sigma: Column, cos_sigma: Column, cos_2m: Column, sin_alpha: Column, cos2_alpha: Column
) -> Column:
    c = FLATTENING / 16.0 * cos2_alpha * (4.0 + FLATTENING * (4.0 - 3.0 * cos2_alpha))
    wave = cos_2m + c * cos_sigma * (2.0 * cos_2m * cos_2m - 1.0)
    return (1.0 - c) * FLATTENING * sin_alpha * (sigma + c * sin_sigma * wave)


def _series(u2: Column) -> Column:
    """Length factors of an arc, in powers of ``u2``."""
    return F.struct(
        (1.0 + u2 / 16384.0 * (4096.0 + u2 * (u2 * (320.0 - 175.0 * u2) - 768.0))).alias("a"),
        (u2 / 1024.0 * (256.0 + u2 * (u2 * (74.0 - 47.0 * u2) - 128.0))).alias("b"),
    )


def _arc_correction(b: Column, sigma: Column, cos_2m: Column) -> Column:
    m2 = cos_2m * cos_2m
    tail = cos_2m * (4.0 * F.sin(sigma) * F.sin(sigma) - 3.0) * (4.0 * m2 - 3.0)
    return b * F.sin(sigma) * (cos_2m + b / 4.0 * (F.cos(sigma) * (2.0 * m2 - 1.0) - b / 6.0 * tail))

"""Column expressions of vector and plane geometry; angles in degrees. Everything stays inside whole-stage code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Vec = tuple[Column, Column, Column]


def vec(prefix: str = "n", names: str = "xyz") -> Vec:
    return tuple(F.col(prefix + a) for a in names)  # type: ignore[return-value]


def dot(a: Vec, b: Vec) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: Vec, b: Vec) -> Vec:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def norm(a: Vec) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Vec) -> Vec:
    """Of length 1, or null if a component is not finite or the vector is (nearly) zero."""
    n = norm(a)
    ok = (n > 1e-15) & (n < float("inf"))
    return tuple(F.when(ok, c / n) for c in a)  # type: ignore[return-value]


def up(a: Vec) -> Vec:
    """Turned so that z is not negative; z = 0 stays as it is."""
    s = F.when(a[2] < 0, -1.0).otherwise(1.0)
    return tuple(c * s for c in a)  # type: ignore[return-value]


def axial_angle(a: Vec, b: Vec) -> Column:
    """Between axes, 0 to 90: the sign of a direction does not count."""
    return F.degrees(F.acos(F.least(F.abs(dot(a, b)), F.lit(1.0))))


def dip(n: Vec) -> Column:
    return F.degrees(F.atan2(F.sqrt(n[0] * n[0] + n[1] * n[1]), n[2]))


def dip_direction(n: Vec) -> Column:
    """Azimuth, clockwise from north (y)."""
    return F.pmod(F.degrees(F.atan2(n[0], n[1])) + 360.0, F.lit(360.0))


def aligned_sign(a: Vec, b: Vec) -> Column:
    """-1 where b has to be turned to point with a."""
    return F.when(dot(a, b) < 0, -1.0).otherwise(1.0)


def offset_between(na: Vec, da: Column, nb: Vec, db: Column) -> Column:
    """Difference of plane offsets once b is turned towards a."""
    return F.abs(da - aligned_sign(na, nb) * db)


def residual(n: Vec, d: Column, p: Vec) -> Column:
    return F.abs(dot(n, p) + d)


def plane_axes(n: Vec) -> tuple[Vec, Vec]:
    """Two unit vectors that span the plane; the first is square to z, or to x where the normal is close to z."""
    steep = F.abs(n[2]) > 0.90
    ref = (F.when(steep, 1.0).otherwise(0.0), F.lit(0.0), F.when(steep, 0.0).otherwise(1.0))
    u = unit(cross(ref, n))
    return u, cross(n, u)


def to_plane(p: Vec, c: Vec, n: Vec) -> tuple[Column, Column]:
    u, v = plane_axes(n)
    d = tuple(a - b for a, b in zip(p, c))
    return dot(d, u), dot(d, v)  # type: ignore[arg-type]


def oblique(p: Vec, origin: tuple[float, float, float], azimuth_deg: float, elevation_deg: float) -> tuple[Column, Column]:
    """Orthographic view: u to the right, v upwards, seen along an azimuth and an elevation."""
    from math import cos, radians, sin

    a, e = radians(azimuth_deg), radians(elevation_deg)
    dx, dy, dz = (c - o for c, o in zip(p, origin))
    return dx * cos(a) + dy * sin(a), dz * cos(e) - (dx * -sin(a) + dy * cos(a)) * sin(e)


def in_polygon(u: Column, v: Column, ring: list[tuple[float, float]], buffer: float = 0.0) -> Column:
    """Strictly inside a ring by crossings of a ray, after its box; with a buffer, also within that distance of an edge."""
    us, vs = [p[0] for p in ring], [p[1] for p in ring]
    box = (u >= min(us) - buffer) & (u <= max(us) + buffer) & (v >= min(vs) - buffer) & (v <= max(vs) + buffer)
    crossings, close, edge = F.lit(0), F.lit(False), F.lit(False)
    for (au, av), (bu, bv) in zip(ring, ring[1:] + ring[:1]):
        if av != bv:
            crosses = ((v < av) != (v < bv)) & (u < (v - av) * ((bu - au) / (bv - av)) + au)
            crossings = crossings + F.when(crosses, 1).otherwise(0)
        if buffer == 0:
            on = ((u - au) * (bv - av) - (v - av) * (bu - au) == 0) & (u >= min(au, bu)) & (u <= max(au, bu)) & (v >= min(av, bv)) & (v <= max(av, bv))
            edge = edge | on
        else:
            length2 = (bu - au) ** 2 + (bv - av) ** 2
            t = F.least(F.greatest(((u - au) * (bu - au) + (v - av) * (bv - av)) / (length2 or 1.0), F.lit(0.0)), F.lit(1.0))
            du, dv = u - (t * (bu - au) + au), v - (t * (bv - av) + av)
            close = close | (du * du + dv * dv < buffer * buffer)
    return box & ((crossings % 2 == 1) | close) & ~edge


def features_of(eigenvalues: tuple[Column, Column, Column]) -> dict[str, Column]:
    """planarity, surface_variation and entropy of three ascending eigenvalues, held at 0 from below."""
    l0, l1, l2 = (F.greatest(c, F.lit(0.0)) for c in eigenvalues)
    total = F.greatest(l0 + l1 + l2, F.lit(1e-15))
    entropy = F.lit(0.0)
    for c in (l0, l1, l2):
        p = c / total
        entropy = entropy - F.when(p > 0, p * F.log(p)).otherwise(0.0)
    return {"planarity": (l1 - l0) / F.greatest(l2, F.lit(1e-15)), "surface_variation": l0 / total, "entropy": entropy}


def quantised(v: Column, scale: float, offset: float) -> Column:
    """The 32-bit integer of a coordinate, rounded half away from zero; out of range is an error."""
    raw = F.round((v - offset) / scale)
    return F.when(F.abs(raw) <= 2147483647, raw.cast("int")).otherwise(F.raise_error(F.lit("coordinate does not fit 32 bits")).cast("int"))


def golden_colour(index: Column) -> Column:
    """(red, green, blue) of a number: hues a golden ratio apart, full brightness, fixed saturation; negative is grey."""
    h = F.pmod(index.cast("double") * 0.61803398875, F.lit(1.0)) * 6.0
    s, v = 0.75, 0.95

    def part(shift: float) -> Column:
        k = F.pmod(h + shift, F.lit(6.0))
        low = F.greatest(F.least(F.least(k, 4.0 - k), F.lit(1.0)), F.lit(0.0))
        return F.when(index < 0, F.lit(128)).otherwise(F.round((v - v * s * low) * 255).cast("int"))

    return F.struct(part(5.0).alias("red"), part(3.0).alias("green"), part(1.0).alias("blue"))

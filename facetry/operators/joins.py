"""Joins that a range or a rank decides, written as equi-joins on cells so that no pair outside neighbouring cells is looked at."""

from __future__ import annotations

from functools import reduce
from itertools import product
from math import radians, sin

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetry.functions.geometry import axial_angle


def _cells(names: tuple[str, ...], size: float) -> list[Column]:
    return [F.floor(F.col(a) / size).cast("long") for a in names]


def _offsets(dims: int, reach: int = 1) -> Column:
    """A constant array of the steps to all cells within `reach`: structs d0, d1, ..."""
    steps = product(range(-reach, reach + 1), repeat=dims)
    return F.array(*[F.struct(*[F.lit(d).cast("long").alias(f"d{i}") for i, d in enumerate(step)]) for step in steps])


def squared(names: tuple[str, ...], a: str, b: str) -> Column:
    return reduce(lambda s, t: s + t, [(F.col(n + a) - F.col(n + b)) * (F.col(n + a) - F.col(n + b)) for n in names])


def finite(names: tuple[str, ...]) -> Column:
    return reduce(lambda s, t: s & t, [F.abs(F.col(n)) < float("inf") for n in names])


def _packed(cells: list[Column]) -> Column:
    """A cell as one long. Cells that lie millions apart may share it, neighbours never do."""
    bits = min(21, 63 // len(cells))
    return reduce(lambda s, c: F.shiftleft(s, bits).bitwiseOR(c), [F.pmod(c, F.lit(1 << bits)) for c in cells])


def radius_join(left: DataFrame, right: DataFrame, radius: float, *, on: tuple[str, ...] = ("x", "y", "z"), suffixes: tuple[str, str] = ("_a", "_b"), by: str | None = None, cell: float | None = None, keep_cell: bool = False) -> DataFrame:
    """Pairs at most `radius` apart, with d2; with `by`, only rows that are equal in that column. One side goes to the cells around it, the other stays in its own.

    Columns get the suffixes. Rows without finite coordinates meet nobody. Dense cells are left to the skew handling of
    the join. A cell is as wide as the radius, so it holds little more than true neighbours; a wider one (`cell`) compares
    more and shuffles less. keep_cell: the left row's cell stays as `_c` (and `_by`): what is grouped by it too needs no
    second shuffle.
    """
    size = radius if cell is None else max(cell, radius)
    a, b = (df.select([F.col(c).alias(c + s) for c in df.columns]) for df, s in zip((left, right), suffixes))
    na, nb = (tuple(n + s for n in on) for s in suffixes)
    keys = ["_c"]
    a = a.where(finite(na)).withColumn("_c", _packed(_cells(na, size)))
    b = b.where(finite(nb)).withColumn("_g", F.explode(_offsets(len(on))))
    at = [c + F.col(f"_g.d{i}") for i, c in enumerate(_cells(nb, size))]
    # of the 27 cells about 21 come within the radius (of wider ones fewer), the others are not shuffled
    away = [F.greatest(k * size - F.col(n), F.col(n) - (k + 1) * size, F.lit(0.0)) for k, n in zip(at, nb)]
    b = b.where(reduce(lambda s, t: s + t, [d * d for d in away]) <= radius * radius * (1 + 1e-6)).withColumn("_c", _packed(at)).drop("_g")
    if by:
        keys.append("_by")
        a, b = a.withColumn("_by", F.col(by + suffixes[0])), b.withColumn("_by", F.col(by + suffixes[1]))
    joined = a.join(b, keys).withColumn("d2", squared(on, *suffixes))
    near = joined.where(F.col("d2") <= radius * radius)
    return near if keep_cell else near.drop(*keys)


def self_radius_pairs(points: DataFrame, radius: float, key: str, *, on: tuple[str, ...] = ("x", "y", "z")) -> DataFrame:
    """Each unordered pair of different rows once: key_a < key_b, d2."""
    pairs = radius_join(points.select(key, *on), points.select(key, *on), radius, on=on)
    return pairs.where(F.col(key + "_a") < F.col(key + "_b")).select(key + "_a", key + "_b", "d2")


def k_smallest(pairs: DataFrame, k: int, by: str, order: list[Column]) -> DataFrame:
    return pairs.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= k)


def knn_within(points: DataFrame, k: int, radius: float, key: str, *, on: tuple[str, ...] = ("x", "y", "z")) -> DataFrame:
    """The k nearest rows within the radius, the row itself first: key_a, key_b, d2, rank. Ties go to the smaller key."""
    pairs = radius_join(points.select(key, *on), points.select(key, *on), radius, on=on)
    return k_smallest(pairs, k, key + "_a", [F.col("d2"), F.col(key + "_b")]).select(key + "_a", key + "_b", "d2", "rank")


def knn(points: DataFrame, k: int, key: str, *, start: float, on: tuple[str, ...] = ("x", "y", "z"), by: str | None = None, grow: float = 2.0, most_rounds: int = 40) -> DataFrame:
    """The k nearest rows at any distance (itself included): key_a, key_b, d2, rank. Ties go to the smaller key; keys are unique
    (with `by`, in each group). Rounds of growing radius, in which only the places without k rows around them so far look
    again. Exact: a place is done when k rows lie within the radius of its round. With `by`, rows meet only those that are
    equal in that column, and a group of fewer than k rows is done when all have met. Rows without finite coordinates are
    left out."""
    from facetry.operators import blocks
    from facetry.operators.places import nearest_places, nearest_rows, places

    if not by and on == blocks.XYZ and grow == 2.0 and not blocks.crowded(points):
        return blocks.nearest_rows(points, k, key, start)
    at = places(points, key=key, first=k, on=on, by=by)
    near = nearest_places(at, k, start=start, on=on, by=by, grow=grow, most_rounds=most_rounds)
    return nearest_rows(points, at, near, k, key, on=on, by=by)


def nearest(left: DataFrame, right: DataFrame, radius: float, left_key: str, right_key: str, *, on: tuple[str, ...] = ("x", "y", "z")) -> DataFrame:
    """For each left row its nearest right row within the radius: left_key, right_key, d2. Ties go to the smaller key."""
    l, r = left.select(F.col(left_key).alias("_lk"), *on), right.select(F.col(right_key).alias("_rk"), *on)
    pairs = radius_join(l, r, radius, on=on)
    best = pairs.groupBy("_lk_a").agg(F.min(F.struct("d2", "_rk_b")).alias("m"))
    return best.select(F.col("_lk_a").alias(left_key), F.col("m._rk_b").alias(right_key), F.col("m.d2").alias("d2"))


def axial_join(normals: DataFrame, angle_deg: float, key: str) -> DataFrame:
    """Pairs of unit axes at most angle_deg apart (sign does not matter): key_a < key_b, angle_deg.

    Every axis is also entered turned round; two axes within the angle have ends within the chord 2 sin(angle / 2).
    """
    chord = 2 * sin(radians(min(angle_deg, 90.0)) / 2) * (1 + 1e-9) + 1e-9
    ends = normals.select(key, "nx", "ny", "nz").checkpoint()  # else the axes' expressions go into each of the 27 cells' code
    turned = ends.select(key, *[(-F.col(c)).alias(c) for c in ("nx", "ny", "nz")])
    pairs = radius_join(ends, ends.unionByName(turned), chord, on=("nx", "ny", "nz")).where(F.col(key + "_a") < F.col(key + "_b"))
    angle = axial_angle(tuple(F.col(c + "_a") for c in ("nx", "ny", "nz")), tuple(F.col(c + "_b") for c in ("nx", "ny", "nz")))
    return pairs.select(key + "_a", key + "_b", angle.alias("angle_deg")).where(F.col("angle_deg") <= angle_deg).distinct()


def box_gap_join(boxes: DataFrame, gap: float, key: str, *, cell: float, carry: list[str] | None = None, beside: tuple[str, str] | None = None) -> DataFrame:
    """Pairs of rows whose XY boxes (x0, x1, y0, y1) come within `gap` of each other: key_a < key_b.

    A box enters all cells it touches, half the gap widened; a pair counts in the first cell that both touch only. carry:
    columns of both rows that come along (c_a, c_b), so that the pairs, which may be many more than the rows, need no join.
    beside: tile numbers; only rows of neighbouring tiles meet, not those of one tile.
    """
    carry = carry or []
    h = gap / 2
    lo = [F.floor((F.col(c) - h) / cell).cast("long") for c in ("x0", "y0")]
    hi = [F.floor((F.col(c) + h) / cell).cast("long") for c in ("x1", "y1")]
    b = boxes.select(key, *carry, "x0", "x1", "y0", "y1", lo[0].alias("i0"), lo[1].alias("j0"), hi[0].alias("i1"), hi[1].alias("j1")).where("i1 >= i0 and j1 >= j0")
    each = b.withColumn("ci", F.explode(F.sequence("i0", "i1"))).withColumn("cj", F.explode(F.sequence("j0", "j1")))
    l, r = (each.select([F.col(c).alias(c if c in ("ci", "cj") else c + s) for c in each.columns]) for s in ("_a", "_b"))
    keys = ["ci", "cj"]
    if beside:
        around = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p, q in product((-1, 0, 1), repeat=2) if p or q])
        l = l.withColumns({"_p": F.col(beside[0] + "_a").cast("long"), "_q": F.col(beside[1] + "_a").cast("long")})
        r = r.withColumn("_g", F.explode(around)).withColumns({"_p": F.col(beside[0] + "_b").cast("long") + F.col("_g.p"), "_q": F.col(beside[1] + "_b").cast("long") + F.col("_g.q")}).drop("_g")
        keys += ["_p", "_q"]
    first = (F.col("ci") == F.greatest("i0_a", "i0_b")) & (F.col("cj") == F.greatest("j0_a", "j0_b"))
    near = (F.greatest("x0_a", "x0_b") - F.least("x1_a", "x1_b") <= gap) & (F.greatest("y0_a", "y0_b") - F.least("y1_a", "y1_b") <= gap)
    return l.join(r, keys).where((F.col(key + "_a") < F.col(key + "_b")) & first & near).select(key + "_a", key + "_b", *[c + s for s in ("_a", "_b") for c in carry])

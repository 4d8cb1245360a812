"""Searches by place. Rows with the same coordinates have the same neighbours, so a place is searched once, with the number of
its rows as weight; what holds for a place is joined to its rows at the end.

A table whose points repeat n times so costs one search over the distinct points instead of n * n, and the rows are
shuffled twice at most, whatever the radius. Rows without finite coordinates have no place.
"""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetry.operators.joins import _cells, _packed, finite, k_smallest, radius_join, squared

XYZ = ("x", "y", "z")


def repeated(points: DataFrame, key: str) -> bool:
    """Whether a key may stand on several rows (a shared hash counts too). Only hashes are shuffled."""
    return not points.groupBy(F.xxhash64(key).alias("_h")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def places(points: DataFrame, *, key: str | None = None, first: int = 0, on: tuple[str, ...] = XYZ, by: str | None = None) -> DataFrame:
    """place (a number), the coordinates, `by`, m (rows there); with `first`, keys: the smallest so many keys there, in order."""
    at = [*on, *([by] if by else [])]
    rows = points.where(finite(on))
    if first:
        w = Window.partitionBy(*at)
        ranked = rows.select(key, *at).withColumns({"_nth": F.row_number().over(w.orderBy(key)), "m": F.count(F.lit(1)).over(w)}).where(F.col("_nth") <= first)
        one = ranked.groupBy(*at).agg(F.max("m").alias("m"), F.array_sort(F.collect_list(key)).alias("keys"))
    else:
        one = rows.groupBy(*at).agg(F.count(F.lit(1)).alias("m"))
    return one.withColumn("place", F.monotonically_increasing_id()).checkpoint()


def place_pairs(left: DataFrame, right: DataFrame, radius: float, *, on: tuple[str, ...] = XYZ, by: str | None = None) -> DataFrame:
    """Pairs of places within the radius, a place with itself included, with d2. Grouping by own(by) needs no shuffle."""
    return radius_join(left.drop("keys"), right.drop("keys"), radius, on=on, by=by, cell=1.5 * radius, keep_cell=True)


def own(by: str | None = None) -> list[str]:
    return ["_c", *(["_by"] if by else []), "place_a"]


def at_place(rows: DataFrame, told: DataFrame, *, on: tuple[str, ...] = XYZ, by: str | None = None, how: str = "inner") -> DataFrame:
    """rows with what is told of their places; told has one row for each place with its coordinates, and is not sorted for it."""
    return rows.join(told.hint("shuffle_hash"), [*on, *([by] if by else [])], how)


def up_to(pairs: DataFrame, k: Column, by: str | None = None) -> DataFrame:
    """Of each place the nearest places up to that with its k-th row, all at the same distance included, with `before` (rows
    that are nearer), `upto` (rows as near or nearer) and `tied` (places at this distance)."""
    w = Window.partitionBy(*own(by))
    same = w.partitionBy(*own(by), "d2")
    out = pairs.withColumns({"upto": F.sum("m_b").over(w.orderBy("d2")), "_same": F.sum("m_b").over(same), "tied": F.count(F.lit(1)).over(same)})
    return out.withColumn("before", F.col("upto") - F.col("_same")).drop("_same").where(F.col("before") < k)


def nearest_places(at: DataFrame, k: int, *, start: float, on: tuple[str, ...] = XYZ, by: str | None = None, grow: float = 2.0, most_rounds: int = 40, whole: bool = True) -> DataFrame:
    """place_a, place_b, d2, m_b, before: for each place the places that hold its k nearest rows, in rounds of growing radius.

    Of several places at the last distance all are there. Places with k rows of their own need no search. whole=False:
    one round only, places with fewer rows around them have those.
    """
    if by:
        sizes = at.groupBy(by).agg(F.least(F.sum("m"), F.lit(k)).alias("wanted"))
        rows = at.drop("keys").join(sizes, by).checkpoint()
    else:
        rows = at.drop("keys").withColumn("wanted", F.lit(min(k, at.agg(F.sum("m")).first()[0] or 0)).cast("long"))
    names = ["place_a", "place_b", "d2", "m_b", "before"]
    parts = [rows.where("m >= wanted").select(F.col("place").alias("place_a"), F.col("place").alias("place_b"), F.lit(0.0).alias("d2"), F.col("m").alias("m_b"), F.lit(0).cast("long").alias("before"))]
    todo, radius = rows.where("m < wanted"), start
    for _ in range(most_rounds):
        if todo.isEmpty():
            break
        near = up_to(place_pairs(todo, rows.drop("wanted"), radius, on=on, by=by), F.col("wanted_a"), by)
        if not whole:
            parts.append(near.select(*names))
            break
        ranked = near.withColumn("_most", F.max("upto").over(Window.partitionBy(*own(by)))).where("_most >= wanted_a").select(*names).checkpoint()
        parts.append(ranked)
        todo = todo.join(ranked.select(F.col("place_a").alias("place")).distinct(), "place", "left_anti").checkpoint()
        radius *= grow
    else:
        if not todo.isEmpty():
            raise RuntimeError(f"neighbours not found in {most_rounds} rounds")
    return reduce(DataFrame.unionByName, parts)


def nearest_rows(points: DataFrame, at: DataFrame, near: DataFrame, k: int, key: str, *, on: tuple[str, ...] = XYZ, by: str | None = None) -> DataFrame:
    """The k nearest rows of every row, ties to the smaller key: key_a, key_b, d2, rank. at: places with their first k keys."""
    rows = near.join(at.select(F.col("place").alias("place_b"), "keys"), "place_b").select("place_a", "d2", F.explode("keys").alias("_k"))
    best = k_smallest(rows, k, "place_a", [F.col("d2"), F.col("_k")]).groupBy("place_a").agg(F.collect_list(F.struct(F.col("_k").alias(key + "_b"), "d2", "rank")).alias("_near"))
    told = at.select("place", *on, *([by] if by else [])).join(best, F.col("place") == F.col("place_a")).drop("place", "place_a")
    found = at_place(points.select(F.col(key).alias(key + "_a"), *on, *([by] if by else [])), told, on=on, by=by)
    return found.select(key + "_a", F.explode("_near").alias("_n")).select(key + "_a", "_n.*")


def row_pairs(points: DataFrame, radius: float, key: str, *, on: tuple[str, ...] = XYZ, cell: float | None = None, most: int = 512) -> DataFrame:
    """Each unordered pair of rows at most `radius` apart once: key_a < key_b, d2. Keys may stand on several rows.

    The rows are shuffled once, to their cell. There those of a place become lists of at most `most` keys; only lists meet,
    and only lists near the side of a cell are sent on, to the half of the cells around it that come later. Pairs of rows are
    made from pairs of lists at the very end, so that nothing that is shuffled grows with their number.
    """
    size = 4 * radius if cell is None else max(cell, radius)
    nth = F.row_number().over(Window.partitionBy("_c", *on).orderBy(key)) - 1
    rows = points.where(finite(on)).select(key, *[(F.col(c) + 0.0).alias(c) for c in on]).withColumn("_c", _packed(_cells(on, size))).repartition("_c")
    lists = rows.withColumn("_n", F.floor(nth / most)).groupBy("_c", *on, "_n").agg(F.collect_list(key).alias("keys"))
    a, b = (lists.select("_c", *[F.col(c).alias(c + s) for c in (*on, "_n", "keys")]) for s in ("_a", "_b"))
    # a place before another one, and of one place a list before another one or with itself
    ahead = F.struct(*[c + "_a" for c in (*on, "_n")]) <= F.struct(*[c + "_b" for c in (*on, "_n")])
    later = [step for step in product((-1, 0, 1), repeat=len(on)) if step > (0,) * len(on)]
    steps = F.array(*[F.struct(*[F.lit(d).cast("long").alias(f"d{i}") for i, d in enumerate(step)]) for step in later])
    sent = b.withColumn("_g", F.explode(steps))
    at = [c + F.col(f"_g.d{i}") for i, c in enumerate(_cells(tuple(c + "_b" for c in on), size))]
    away = [F.greatest(k * size - F.col(c + "_b"), F.col(c + "_b") - (k + 1) * size, F.lit(0.0)) for k, c in zip(at, on)]
    sent = sent.where(reduce(lambda s, t: s + t, [d * d for d in away]) <= radius * radius * (1 + 1e-6)).withColumn("_c", _packed(at)).drop("_g")
    d2 = squared(on, "_a", "_b")
    near = [a.join(b, "_c").where(ahead & (d2 <= radius * radius)), a.join(sent, "_c").where(d2 <= radius * radius)]
    same = reduce(lambda s, t: s & t, [F.col(c + "_a") == F.col(c + "_b") for c in (*on, "_n")])
    out = []
    for n in near:
        each = n.select("keys_a", "keys_b", d2.alias("d2"), same.alias("_same")).select(F.explode("keys_a").alias("_p"), "keys_b", "d2", "_same")
        each = each.select("_p", F.explode("keys_b").alias("_q"), "d2", "_same")
        # a list with itself has each pair both ways
        out.append(each.where(F.when(F.col("_same"), F.col("_p") < F.col("_q")).otherwise(F.col("_p") != F.col("_q"))).select(F.least("_p", "_q").alias(key + "_a"), F.greatest("_p", "_q").alias(key + "_b"), "d2"))
    return out[0].unionByName(out[1])

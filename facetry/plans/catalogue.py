"""The query catalogue over the driver's tables: each entry is a plan in Spark and, where SQL can say it, its SQL.

All queries run over whole tables. Figures are rounded to ten places at most so that both sides agree to the last digit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from facetry.config import DEFAULTS
from facetry.functions import geometry as G, scores
from facetry.operators import grouped, order, points as P, sets, tiling
from facetry.operators.blocks import crowded, nearest_within
from facetry.operators.graph import _ensure_checkpoint_dir
from facetry.operators.joins import axial_join, k_smallest, knn, radius_join
from facetry.operators.places import at_place, nearest_places, nearest_rows, own, place_pairs, places, repeated, row_pairs
from facetry.plans.adapters import PLANES_SQL, POINTS_SQL, planes, points, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _r(c, places: int = 8):
    return F.round(c, places)


P_WITH, N_WITH = "WITH " + POINTS_SQL, "WITH " + PLANES_SQL
_ANGLE = "degrees(acos(least(abs(a.nx * b.nx + a.ny * b.ny + a.nz * b.nz), 1.0)))"


# --- points -----------------------------------------------------------------------------------------------------


@query(P_WITH + """, low AS (SELECT min(x) AS x0, min(y) AS y0, min(z) AS z0 FROM pts)
SELECT CAST(floor((x - x0) / 5.0) AS BIGINT) AS kx, CAST(floor((y - y0) / 5.0) AS BIGINT) AS ky, CAST(floor((z - z0) / 5.0) AS BIGINT) AS kz, count(*) AS n,
  round(CAST(sum(CAST(x AS DECIMAL(24,10))) AS DOUBLE) / count(*), 10) AS cx, round(CAST(sum(CAST(y AS DECIMAL(24,10))) AS DOUBLE) / count(*), 10) AS cy, round(CAST(sum(CAST(z AS DECIMAL(24,10))) AS DOUBLE) / count(*), 10) AS cz
FROM pts, low GROUP BY 1, 2, 3""")
def voxel_downsample(spark, sf_dir):
    v = P.voxel_downsample(points(spark, sf_dir), 5.0, exact=True)
    return v.select("kx", "ky", "kz", "n", *[_r(F.col(c), 10).alias("c" + c) for c in "xyz"])


@query(P_WITH + "SELECT pid, x, y, z FROM pts WHERE x BETWEEN 10 AND 30 AND y BETWEEN 20 AND 60")
def bbox_scan(spark, sf_dir):
    return P.scan(points(spark, sf_dir), (10, 30, 20, 60)).select("pid", "x", "y", "z")


@query(P_WITH + "SELECT pid, x, y, z FROM pts WHERE x BETWEEN 5 AND 25 AND y BETWEEN 10 AND 40 AND z BETWEEN 2 AND 6")
def bbox_scan_3d(spark, sf_dir):
    return P.scan(points(spark, sf_dir), (5, 25, 10, 40, 2, 6)).select("pid", "x", "y", "z")


@query(P_WITH + "SELECT count(*) AS point_count, CAST(0 AS BIGINT) AS non_finite_count, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y, min(z) AS min_z, max(z) AS max_z FROM pts")
def audit_summary(spark, sf_dir):
    return P.audit(points(spark, sf_dir))


@query("SELECT bool_or(l_quantity <> 0) AS has_l_quantity, bool_or(l_discount <> 0) AS has_l_discount FROM lineitem")
def attribute_presence(spark, sf_dir):
    return P.attributes_present(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"])


@query(P_WITH + ", b AS (SELECT floor(min(x) / 7) * 7 AS ox, floor(min(y) / 7) * 7 AS oy, max(x) AS mx, max(y) AS my FROM pts) SELECT ox AS origin_x, oy AS origin_y, CAST(floor((mx - ox) / 7) AS INTEGER) AS max_ix, CAST(floor((my - oy) / 7) AS INTEGER) AS max_iy FROM b")
def grid_plan(spark, sf_dir):
    g = tiling.plan_for(points(spark, sf_dir), 7.0, 1.0)
    return spark.createDataFrame([(float(g.origin_x), float(g.origin_y), g.max_ix, g.max_iy)], "origin_x double, origin_y double, max_ix int, max_iy int")


_GRID = ", b AS (SELECT floor(min(x) / 7) * 7 AS ox, floor(min(y) / 7) * 7 AS oy, max(x) AS mx, max(y) AS my FROM pts), g AS (SELECT *, CAST(floor((mx - ox) / 7) AS INTEGER) AS ux, CAST(floor((my - oy) / 7) AS INTEGER) AS uy FROM b)"


@query(P_WITH + _GRID + " SELECT pid, least(CAST(floor((x - ox) / 7) AS INTEGER), ux) || '_' || least(CAST(floor((y - oy) / 7) AS INTEGER), uy) AS tile_id FROM pts, g")
def tile_assign_core(spark, sf_dir):
    p = points(spark, sf_dir)
    return tiling.assign_core(p, tiling.plan_for(p, 7.0, 1.0)).select("pid", "tile_id")


@query(P_WITH + _GRID + """, t AS (
  SELECT pid, unnest(range(least(greatest(CAST(ceil((x - 1 - ox) / 7) AS INTEGER) - 1, 0), ux), greatest(least(CAST(floor((x + 1 - ox) / 7) AS INTEGER), ux), least(greatest(CAST(ceil((x - 1 - ox) / 7) AS INTEGER) - 1, 0), ux)) + 1)) AS ix, y, oy, uy FROM pts, g
), u AS (
  SELECT pid, ix, unnest(range(least(greatest(CAST(ceil((y - 1 - oy) / 7) AS INTEGER) - 1, 0), uy), greatest(least(CAST(floor((y + 1 - oy) / 7) AS INTEGER), uy), least(greatest(CAST(ceil((y - 1 - oy) / 7) AS INTEGER) - 1, 0), uy)) + 1)) AS iy FROM t
) SELECT ix || '_' || iy AS tile_id, count(*) AS points FROM u GROUP BY 1""")
def tile_halo_counts(spark, sf_dir):
    p = points(spark, sf_dir)
    return tiling.halo(p, tiling.plan_for(p, 7.0, 1.0)).groupBy("tile_id").agg(F.count(F.lit(1)).alias("points"))


@query(P_WITH + _GRID + " SELECT CAST(floor((x - ox) / 7) AS INTEGER) AS ix, count(*) AS points, count(DISTINCT least(CAST(floor((y - oy) / 7) AS INTEGER), uy)) AS rows_used FROM pts, g GROUP BY 1")
def tile_counts(spark, sf_dir):
    p = points(spark, sf_dir)
    return tiling.assign_core(p, tiling.plan_for(p, 7.0, 1.0)).groupBy("ix").agg(F.count(F.lit(1)).alias("points"), F.count_distinct("iy").alias("rows_used"))


_RING = [(-20.0, -5.0), (15.0, -12.0), (30.0, 10.0), (5.0, 30.0), (-15.0, 20.0)]
_EDGES = ", ".join(f"({a[0]}::double, {a[1]}::double, {b[0]}::double, {b[1]}::double)" for a, b in zip(_RING, _RING[1:] + _RING[:1]))


@query(P_WITH + f""", v AS (SELECT pid, (x - 25.0) * cos(radians(30.0)) + (y - 50.0) * sin(radians(30.0)) AS u, (z - 6.0) * cos(radians(28.0)) - ((x - 25.0) * -sin(radians(30.0)) + (y - 50.0) * cos(radians(30.0))) * sin(radians(28.0)) AS v FROM pts),
e(au, av, bu, bv) AS (VALUES {_EDGES})
SELECT pid FROM v, e WHERE (v < av) <> (v < bv) AND u < (v - av) * ((bu - au) / (bv - av)) + au GROUP BY pid, u, v HAVING count(*) % 2 = 1""")
def projected_polygon_crop(spark, sf_dir):
    return P.crop_projected(points(spark, sf_dir), origin=(25.0, 50.0, 6.0), azimuth_deg=30.0, elevation_deg=28.0, ring=_RING).select("pid")


# every point's neighbours at most 0.45 away
_NEAR = """, c AS (SELECT *, CAST(floor(x / 0.45) AS BIGINT) AS i, CAST(floor(y / 0.45) AS BIGINT) AS j, CAST(floor(z / 0.45) AS BIGINT) AS k FROM pts),
o AS (SELECT c.pid, c.x, c.y, c.z, i + di AS i, j + dj AS j, k + dk AS k FROM c, (SELECT unnest([-1, 0, 1]) AS di), (SELECT unnest([-1, 0, 1]) AS dj), (SELECT unnest([-1, 0, 1]) AS dk)),
near AS (SELECT c.pid AS pid_a, o.pid AS pid_b, o.x AS xb, o.y AS yb, o.z AS zb, (c.x - o.x) * (c.x - o.x) + (c.y - o.y) * (c.y - o.y) + (c.z - o.z) * (c.z - o.z) AS d2 FROM c JOIN o USING (i, j, k)
  WHERE (c.x - o.x) * (c.x - o.x) + (c.y - o.y) * (c.y - o.y) + (c.z - o.z) * (c.z - o.z) <= 0.45 * 0.45)"""


def _near(spark, sf_dir, radius: float = 0.45) -> DataFrame:
    p = points(spark, sf_dir).select("pid", "x", "y", "z")
    return radius_join(p, p, radius)


def _unique(spark, sf_dir) -> DataFrame | None:
    """The points if every pid stands on one row: then what SQL says of a pid holds for its place. Else None, as SQL puts the rows of a pid together."""
    _ensure_checkpoint_dir(spark)
    p = points(spark, sf_dir).select("pid", "x", "y", "z")
    return None if repeated(p, "pid") else p


@query(P_WITH + _NEAR + " SELECT pid_a, pid_b, round(d2, 8) AS d2 FROM near WHERE pid_a < pid_b")
def radius_pairs(spark, sf_dir):
    return row_pairs(points(spark, sf_dir), 0.45, "pid").select("pid_a", "pid_b", _r(F.col("d2")).alias("d2"))


@query(P_WITH + _NEAR + " SELECT neighbors, count(*) AS points FROM (SELECT pid_a, count(*) AS neighbors FROM near GROUP BY 1) GROUP BY 1")
def radius_degree(spark, sf_dir):
    return _near(spark, sf_dir).groupBy("pid_a").agg(F.count(F.lit(1)).alias("neighbors")).groupBy("neighbors").agg(F.count(F.lit(1)).alias("points"))


@query(P_WITH + _NEAR + " SELECT pid_a, pid_b, CAST(row_number() OVER (PARTITION BY pid_a ORDER BY d2, pid_b) AS INTEGER) AS rank FROM near QUALIFY row_number() OVER (PARTITION BY pid_a ORDER BY d2, pid_b) <= 4")
def knn_topk(spark, sf_dir):
    p = _unique(spark, sf_dir)
    if p is not None and not crowded(p):
        return nearest_within(p, 4, 0.45, "pid").select("pid_a", "pid_b", "rank")
    if p is not None:
        at = places(p, key="pid", first=4)
        return nearest_rows(p, at, nearest_places(at, 4, start=0.45, whole=False), 4, "pid").select("pid_a", "pid_b", "rank")
    return k_smallest(_near(spark, sf_dir), 4, "pid_a", [F.col("d2"), F.col("pid_b")]).select("pid_a", "pid_b", "rank")


@query(P_WITH + _NEAR + ", m AS (SELECT pid_a, sqrt(min(d2)) AS d FROM near WHERE pid_a <> pid_b GROUP BY 1 HAVING sqrt(min(d2)) > 1e-9) SELECT count(*) AS sample_count, round(quantile_cont(d, 0.1), 8) AS p10_m, round(quantile_cont(d, 0.5), 8) AS median_m, round(quantile_cont(d, 0.9), 8) AS p90_m FROM m")
def nn_spacing_quantiles(spark, sf_dir):
    p = _unique(spark, sf_dir)
    if p is not None:
        at = places(p)
        near = place_pairs(at.where("m = 1"), at, 0.45).where("place_a <> place_b")
        d = near.groupBy(*own()).agg(F.sqrt(F.min("d2")).alias("d")).where("d > 1e-9")
    else:
        d = _near(spark, sf_dir).where("pid_a <> pid_b").groupBy("pid_a").agg(F.sqrt(F.min("d2")).alias("d")).where("d > 1e-9")
    return d.agg(F.count(F.lit(1)).alias("sample_count"), *[_r(F.percentile("d", q)).alias(n) for q, n in ((0.1, "p10_m"), (0.5, "median_m"), (0.9, "p90_m"))])


@query(P_WITH + _NEAR + " SELECT pid_a, count(*) AS n, round(var_pop(xb), 10) + 0.0 AS cxx, round(covar_pop(xb, yb), 10) + 0.0 AS cxy, round(covar_pop(xb, zb), 10) + 0.0 AS cxz, round(var_pop(yb), 10) + 0.0 AS cyy, round(covar_pop(yb, zb), 10) + 0.0 AS cyz, round(var_pop(zb), 10) + 0.0 AS czz FROM near GROUP BY 1 HAVING count(*) >= 4")
def local_covariance(spark, sf_dir):
    near = _near(spark, sf_dir)
    c = near.groupBy("pid_a").agg(*P.covariances(near, "pid_a")).where("n >= 4")
    return c.select("pid_a", "n", *[(_r(F.col(f"c{i}{j}"), 10) + 0.0).alias("c" + "xyz"[i] + "xyz"[j]) for i in range(3) for j in range(i, 3)])


@query(P_WITH + _NEAR + ", m AS (SELECT pid_a, avg(sqrt(d2)) AS d FROM near WHERE pid_a <> pid_b GROUP BY 1), s AS (SELECT avg(d) AS a, stddev_pop(d) AS b FROM m) SELECT pid_a, round(d, 8) AS mean_distance FROM m, s WHERE d <= a + 1.5 * b")
def statistical_outliers(spark, sf_dir):
    p = _unique(spark, sf_dir)
    if p is not None:
        at = places(p)
        near = place_pairs(at, at, 0.45).groupBy(*own(), "x_a", "y_a", "z_a", "m_a").agg((F.sum(F.sqrt("d2") * F.col("m_b")) / F.greatest(F.sum("m_b") - 1, F.lit(1))).alias("d"), F.sum("m_b").alias("n")).where("n > 1")
        judged = near.select(*[F.col(c + "_a").alias(c) for c in "xyz"], F.col("m_a").alias("m"), "d").checkpoint()
        kept = judged.join(F.broadcast(P.weighted_limit(judged, "d", 1.5))).where("d <= _most").select("x", "y", "z", "d")
        return at_place(p, kept).select(F.col("pid").alias("pid_a"), _r(F.col("d")).alias("mean_distance"))
    m = _near(spark, sf_dir).where("pid_a <> pid_b").groupBy("pid_a").agg(F.avg(F.sqrt("d2")).alias("d"))
    s = m.agg(F.avg("d").alias("a"), F.stddev_pop("d").alias("b")).first()
    return m.where(F.col("d") <= s.a + 1.5 * s.b).select("pid_a", _r(F.col("d")).alias("mean_distance"))


# the same at any distance: the k nearest of the whole table, too many pairs for SQL


def _rows(spark, sf_dir) -> DataFrame:
    """The points under keys of their own: rows after the first of one pid (by x, y, z) get its number appended."""
    p = points(spark, sf_dir).select("pid", "x", "y", "z")
    if not repeated(p, "pid"):
        return p
    nth = F.row_number().over(Window.partitionBy("pid").orderBy("x", "y", "z"))
    return p.withColumn("_nth", nth).withColumn("pid", F.when(F.col("_nth") > 1, F.concat("pid", F.lit("#"), F.col("_nth"))).otherwise(F.col("pid"))).drop("_nth").checkpoint()


@query()
def knn_any_distance(spark, sf_dir):
    _ensure_checkpoint_dir(spark)
    return knn(_rows(spark, sf_dir), 4, "pid", start=0.45).select("pid_a", "pid_b", "rank")


@query()
def nn_spacing(spark, sf_dir):
    _ensure_checkpoint_dir(spark)
    d = P.nn_spacing(points(spark, sf_dir), start=0.45)
    return d.select("sample_count", *[_r(F.col(c)).alias(c) for c in ("p10_m", "median_m", "p90_m")])


@query()
def statistical_inliers(spark, sf_dir):
    _ensure_checkpoint_dir(spark)
    return P.statistical_inliers(_rows(spark, sf_dir), key="pid", start=0.45).select("pid", _r(F.col("mean_distance")).alias("mean_distance"))


@query(P_WITH + _NEAR + """, core AS (SELECT pid_a AS pid FROM near GROUP BY 1 HAVING count(*) >= 5) SELECT count(*) AS cores, (SELECT count(DISTINCT pid_b) FROM near JOIN core ON pid_a = pid WHERE pid_b NOT IN (SELECT pid FROM core)) AS borders FROM core""")
def dbscan_cores(spark, sf_dir):
    p = _unique(spark, sf_dir)
    if p is not None:
        at = places(p)
        some = place_pairs(at, at, 0.45).groupBy(*own(), "x_a", "y_a", "z_a", "m_a").agg((F.sum("m_b") >= 5).alias("core"))
        judged = some.select(F.col("place_a").alias("place"), *[F.col(c + "_a").alias(c) for c in "xyz"], F.col("m_a").alias("m"), "core").checkpoint()
        beside = place_pairs(judged.where("not core"), judged.where("core"), 0.45).groupBy(*own()).agg(F.first("m_a").alias("m"))
        return judged.agg(F.coalesce(F.sum(F.when(F.col("core"), F.col("m"))), F.lit(0)).alias("cores")).join(beside.agg(F.coalesce(F.sum("m"), F.lit(0)).alias("borders")))
    near = _near(spark, sf_dir)
    core = near.groupBy("pid_a").agg(F.count(F.lit(1)).alias("n")).where("n >= 5").select("pid_a")
    border = near.join(core, "pid_a", "left_semi").join(core.withColumnRenamed("pid_a", "pid_b"), "pid_b", "left_anti").agg(F.count_distinct("pid_b").alias("borders"))
    return core.agg(F.count(F.lit(1)).alias("cores")).join(border)


@query()
def spatial_dbscan(spark, sf_dir):
    from facetry.operators.clusters import spatial_dbscan as run

    _ensure_checkpoint_dir(spark)
    return run(points(spark, sf_dir), 0.45, 5, key="pid")


@query()
def pca_features(spark, sf_dir):
    f = P.ball_features(points(spark, sf_dir), 1.0, min_neighbors=4, key="pid")
    return f.select("pid", "neighbor_count", *[_r(F.col(c), 6).alias(c) for c in ("planarity", "surface_variation")], "normal_stable")


@query()
def multiscale_features(spark, sf_dir):
    f = P.multiscale_features(points(spark, sf_dir), [0.5, 0.75, 1.0], min_neighbors=4, key="pid")
    return f.select("pid", "neighbor_count", _r(F.col("planarity"), 6).alias("planarity"), "normal_scale_m", "normal_stable", "normal_valid_scale_count")


@query()
def tile_regions(spark, sf_dir):
    """Region growing over tiles of the points, features and all."""
    _ensure_checkpoint_dir(spark)
    p = _rows(spark, sf_dir)
    t = tiling.assign_core(p, tiling.plan_for(p, 7.0, 1.0)).withColumn("point_id", F.xxhash64("pid"))
    f = P.local_features(t, 1.0, min_neighbors=6, by="tile_id")
    cand = P.planar_candidates(f, min_planarity=0.3, max_surface_variation=0.2, min_neighbors=6).join(t.select("tile_id", "point_id", "x", "y", "z"), "point_id")
    cfg = DEFAULTS["region_growing"] | {"radius": 1.0, "angle_deg": 15.0, "max_angle_deg": 25.0, "distance": 0.3, "max_distance": 0.5, "max_curvature": 0.2}
    return grouped.regions(cand, cfg, 10).groupBy("tile_id", "region").agg(F.count(F.lit(1)).alias("points"))


@query(P_WITH + ", r AS (SELECT pid, row_number() OVER (ORDER BY x, y, z, pid) - 1 AS p, count(*) OVER () AS n FROM pts), s AS (SELECT CAST(floor(i * (CAST((SELECT count(*) FROM pts) - 1 AS DOUBLE) / 999)) AS BIGINT) AS p FROM range(1000) t(i)) SELECT DISTINCT pid FROM r JOIN s USING (p)")
def linspace_sample(spark, sf_dir):
    return order.linspace_sample(points(spark, sf_dir), 1000, [F.col(c) for c in ("x", "y", "z", "pid")]).select("pid")


@query("WITH r AS (SELECT l_extendedprice AS v, row_number() OVER (ORDER BY l_extendedprice) - 1 AS p, count(*) OVER () AS n FROM lineitem) SELECT min(v) AS value FROM r WHERE p = round_even((n - 1) * 0.9, 0)")
def nearest_rank_quantile(spark, sf_dir):
    return order.nearest_rank(table(spark, sf_dir, "lineitem"), "l_extendedprice", 0.9)


_TRI = """, t AS (SELECT pid, l_orderkey, l_linenumber, x, y, z, lead(x) OVER w AS bx, lead(y) OVER w AS by_, lead(z) OVER w AS bz, lead(x, 2) OVER w AS cx, lead(y, 2) OVER w AS cy, lead(z, 2) OVER w AS cz FROM pts WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, pid))"""


@query(P_WITH + _TRI + """ SELECT pid, round(0.5 * sqrt(power((by_-y)*(cz-z)-(bz-z)*(cy-y), 2) + power((bz-z)*(cx-x)-(bx-x)*(cz-z), 2) + power((bx-x)*(cy-y)-(by_-y)*(cx-x), 2)), 6) AS area FROM t WHERE cx IS NOT NULL""")
def triangle_areas(spark, sf_dir):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "pid")
    t = points(spark, sf_dir)
    t = t.withColumns({p + c: F.lead(c, i).over(w) for i, p in ((1, "b"), (2, "c")) for c in "xyz"}).where("cx is not null")
    u, v = (tuple(F.col(p + c) - F.col(c) for c in "xyz") for p in "bc")
    return t.select("pid", _r(G.norm(G.cross(u, v)) * 0.5, 6).alias("area"))


# --- planes -----------------------------------------------------------------------------------------------------


@query(N_WITH + " SELECT vec_id, round(degrees(atan2(sqrt(nx * nx + ny * ny), nz)), 8) AS dip_deg, round((degrees(atan2(nx, ny)) + 360.0) % 360.0, 8) AS dip_direction_deg FROM planes")
def dip_direction(spark, sf_dir):
    return planes(spark, sf_dir).select("vec_id", _r(G.dip(G.vec())).alias("dip_deg"), _r(G.dip_direction(G.vec())).alias("dip_direction_deg"))


@query(N_WITH + f" SELECT a.vec_id AS vec_id_a, b.vec_id AS vec_id_b, round({_ANGLE}, 6) AS angle_deg FROM planes a JOIN planes b ON a.vec_id < b.vec_id WHERE {_ANGLE} <= 5.0")
def axial_pairs(spark, sf_dir):
    return axial_join(planes(spark, sf_dir), 5.0, "vec_id").select("vec_id_a", "vec_id_b", _r(F.col("angle_deg"), 6).alias("angle_deg"))


@query("WITH RECURSIVE " + PLANES_SQL + f""", e AS (SELECT a.vec_id AS u, b.vec_id AS v FROM planes a JOIN planes b ON a.vec_id <> b.vec_id AND {_ANGLE} <= 4.0),
r(node, root) AS (SELECT vec_id, vec_id FROM planes UNION SELECT e.v, r.root FROM r JOIN e ON e.u = r.node)
SELECT node AS vec_id, min(root) AS component FROM r GROUP BY 1""")
def axial_components(spark, sf_dir):
    _ensure_checkpoint_dir(spark)
    return sets.axial_components(planes(spark, sf_dir), 4.0, "vec_id")


@query()
def axial_bisection(spark, sf_dir):
    _ensure_checkpoint_dir(spark)
    p = planes(spark, sf_dir)
    return grouped.split_families(p.join(sets.axial_components(p, 4.0, "vec_id"), "vec_id"), 12.0, key="vec_id")


@query(N_WITH + """ SELECT vec_id, CASE WHEN abs(nz) > 0.9 THEN 1 ELSE 0 END AS steep, round(sqrt(CASE WHEN abs(nz) > 0.9 THEN nz * nz + ny * ny ELSE ny * ny + nx * nx END), 8) AS side FROM planes""")
def plane_axes(spark, sf_dir):
    n = G.vec()
    steep = F.abs(n[2]) > 0.9
    ref = (F.when(steep, 1.0).otherwise(0.0), F.lit(0.0), F.when(steep, 0.0).otherwise(1.0))
    return planes(spark, sf_dir).select("vec_id", F.when(steep, 1).otherwise(0).alias("steep"), _r(G.norm(G.cross(ref, n))).alias("side"))


@query(P_WITH + ", " + PLANES_SQL + " SELECT p.vec_id, count(*) AS points, round(min(abs(p.nx * q.x + p.ny * q.y + p.nz * q.z + p.plane_d)), 8) AS nearest, round(max(abs(p.nx * q.x + p.ny * q.y + p.nz * q.z + p.plane_d)), 8) AS farthest FROM planes p JOIN pts q ON q.l_orderkey = p.vec_id GROUP BY 1")
def plane_residuals(spark, sf_dir):
    j = planes(spark, sf_dir).join(points(spark, sf_dir), F.col("l_orderkey") == F.col("vec_id"))
    r = G.residual(G.vec(), F.col("plane_d"), tuple(F.col(c) for c in "xyz"))
    return j.groupBy("vec_id").agg(F.count(F.lit(1)).alias("points"), _r(F.min(r)).alias("nearest"), _r(F.max(r)).alias("farthest"))


_CONF = "0.15 * least(1.0, greatest(0.0, point_count / 100.0)) + 0.10 * least(1.0, greatest(0.0, area_m2 / 0.25)) + 0.15 * least(1.0, greatest(0.0, planarity)) + 0.20 * least(1.0, greatest(0.0, inlier_ratio)) + 0.15 * least(1.0, greatest(0.0, 1.0 - rms_m / 0.05)) + 0.15 * least(1.0, greatest(0.0, 1.0 - normal_dispersion_deg / 12.0)) + 0.10 * least(1.0, greatest(0.0, boundary_completeness))"


def _confidence():
    return scores.confidence(*[F.col(c) for c in ("point_count", "area_m2", "planarity", "inlier_ratio", "rms_m", "normal_dispersion_deg", "boundary_completeness")], min_points=100, min_area=0.25, max_rms=0.05, max_dispersion_deg=12.0)


@query(N_WITH + f" SELECT vec_id, round({_CONF}, 8) AS score FROM planes")
def confidence_score(spark, sf_dir):
    return planes(spark, sf_dir).select("vec_id", _r(_confidence()).alias("score"))


@query(N_WITH + f", s AS (SELECT {_CONF} AS c FROM planes) SELECT CASE WHEN c >= 0.85 THEN 'A' WHEN c >= 0.70 THEN 'B' WHEN c >= 0.55 THEN 'C' ELSE 'Rejected' END AS quality_grade, count(*) AS planes FROM s GROUP BY 1")
def quality_grade_counts(spark, sf_dir):
    return planes(spark, sf_dir).select(scores.grade(_confidence()).alias("quality_grade")).groupBy("quality_grade").agg(F.count(F.lit(1)).alias("planes"))


@query(N_WITH + ", t AS (SELECT vec_id, least(1.0, greatest(0.0, (1.0 - planarity) + rms_m / 0.3)) AS t FROM planes) SELECT vec_id, round(8.0 + t * 4.0, 8) AS angle_deg, round(0.025 + t * 0.025, 8) AS distance_m FROM t")
def dynamic_thresholds(spark, sf_dir):
    a, d = scores.dynamic_thresholds(F.col("planarity"), F.col("rms_m"), max_curvature=0.3)
    return planes(spark, sf_dir).select("vec_id", _r(a).alias("angle_deg"), _r(d).alias("distance_m"))


_GATE = {"min_confidence": 0.55, "min_area_m2": 0.05, "min_minor_extent_m": 0.02, "min_boundary_completeness": 0.52, "min_inlier_ratio": 0.63, "max_normal_dispersion_deg": 8.0, "reject_edge_censored": True}
_REASONS = """concat_ws(';', CASE WHEN confidence < 0.55 THEN 'below_min_confidence' END, CASE WHEN area_m2 < 0.05 THEN 'below_min_area' END, CASE WHEN minor_extent_m < 0.02 THEN 'below_min_minor_extent' END,
 CASE WHEN boundary_completeness < 0.52 THEN 'below_min_boundary_completeness' END, CASE WHEN inlier_ratio < 0.63 THEN 'below_min_inlier_ratio' END, CASE WHEN normal_dispersion_deg > 8.0 THEN 'above_max_normal_dispersion' END, CASE WHEN edge_censored THEN 'roi_edge_censored' END)"""


@query(N_WITH + f" SELECT vec_id, CASE WHEN {_REASONS} = '' THEN 'candidate_joint_plane' ELSE 'not_selected' END AS status, CASE WHEN {_REASONS} = '' THEN '{scores.ACCEPTED}' ELSE {_REASONS} END AS selection_reason FROM planes")
def candidate_gate(spark, sf_dir):
    return sets.gate(planes(spark, sf_dir), _GATE).select("vec_id", "status", "selection_reason")


@query(N_WITH + """ SELECT vec_id, concat_ws(';', CASE WHEN confidence < 0.55 THEN 'below_min_confidence' END, CASE WHEN area_m2 < 0.1 THEN 'below_min_area' END, CASE WHEN minor_extent_m < 0.05 THEN 'below_min_minor_extent' END, CASE WHEN major_extent_m < 0.1 THEN 'below_min_major_extent' END,
 CASE WHEN boundary_completeness < 0.52 THEN 'below_min_boundary_completeness' END, CASE WHEN inlier_ratio < 0.63 THEN 'below_min_inlier_ratio' END, CASE WHEN normal_dispersion_deg > 8.0 THEN 'above_max_normal_dispersion' END) AS why FROM planes""")
def global_gate(spark, sf_dir):
    cfg = {"detachment": _GATE, "global_candidate_gate": {"min_area_m2": 0.1, "min_major_extent_m": 0.1, "min_minor_extent_m": 0.05}}
    g = sets.global_gate(planes(spark, sf_dir).withColumn("observed_area_m2", F.col("area_m2")), cfg)
    return g.select("vec_id", F.when(F.col("selection_reason") == scores.ACCEPTED, "").otherwise(F.col("selection_reason")).alias("why"))


@query(N_WITH + """ SELECT coalesce(CASE WHEN point_count < 30 THEN 'below_min_points' END, CASE WHEN inlier_ratio < 0.63 THEN 'below_min_inlier_ratio' END, CASE WHEN area_m2 < 0.05 THEN 'below_min_area' END, CASE WHEN minor_extent_m < 0.02 THEN 'below_min_minor_extent' END, CASE WHEN rms_m > 0.15 THEN 'above_max_rms' END, CASE WHEN confidence < 0.55 THEN 'below_min_confidence' END, 'accepted') AS reason, count(*) AS planes FROM planes GROUP BY 1""")
def fit_rejections(spark, sf_dir):
    why = scores.fit_rejection(min_points=30, min_inlier_ratio=0.63, min_area=0.05, min_minor=0.02, max_rms=0.15, min_confidence=0.55)
    return planes(spark, sf_dir).withColumn("fitted", F.lit(True)).select(F.coalesce(why, F.lit("accepted")).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("planes"))


_PAIRS = N_WITH + f""", j AS (SELECT a.vec_id AS vec_id_a, b.vec_id AS vec_id_b, {_ANGLE} AS ang, abs(a.plane_d - CASE WHEN a.nx * b.nx + a.ny * b.ny + a.nz * b.nz < 0 THEN -1.0 ELSE 1.0 END * b.plane_d) AS off, a.rms_m AS ra, b.rms_m AS rb,
 sqrt(power(greatest(0.0, greatest(a.bbox_min_x, b.bbox_min_x) - least(a.bbox_max_x, b.bbox_max_x)), 2) + power(greatest(0.0, greatest(a.bbox_min_y, b.bbox_min_y) - least(a.bbox_max_y, b.bbox_max_y)), 2) + power(greatest(0.0, greatest(a.bbox_min_z, b.bbox_min_z) - least(a.bbox_max_z, b.bbox_max_z)), 2)) AS gap
 FROM planes a JOIN planes b ON a.vec_id < b.vec_id AND abs(a.ix - b.ix) <= 1 AND abs(a.iy - b.iy) <= 1 AND (a.ix <> b.ix OR a.iy <> b.iy)
 WHERE greatest(a.bbox_min_x, b.bbox_min_x) - least(a.bbox_max_x, b.bbox_max_x) <= 0.05 AND greatest(a.bbox_min_y, b.bbox_min_y) - least(a.bbox_max_y, b.bbox_max_y) <= 0.05),
p AS (SELECT *, CASE WHEN ang > 25.0 THEN 'normal_angle' WHEN off > 0.10 THEN 'plane_offset' WHEN ra > 0.25 OR rb > 0.25 THEN 'rms' WHEN gap > 0.05 THEN 'bbox_gap' ELSE 'accepted' END AS reason FROM j)"""


def _merge_pairs(spark, sf_dir):
    return sets.merge_candidates(planes(spark, sf_dir), key="vec_id", gap_m=0.05, angle_deg=25.0, offset_m=0.10, max_rms=0.25, cell=0.25)


_GATES = {"angle_deg": 25.0, "offset_m": 0.10, "gap_m": 0.05}


def _tile_planes(spark, sf_dir):
    return sets.tile_planes(planes(spark, sf_dir), key="vec_id", max_rms=0.25)


@query(_PAIRS + " SELECT vec_id_a, vec_id_b, reason FROM p WHERE reason IN ('accepted', 'bbox_gap', 'rms')")
def plane_merge_candidates(spark, sf_dir):
    return grouped.tile_pairs(_tile_planes(spark, sf_dir), "vec_id", _GATES).where(F.col("reason").isin("accepted", "bbox_gap", "rms"))


@query(_PAIRS + " SELECT reason, count(*) AS pairs FROM p GROUP BY 1")
def merge_rejection_histogram(spark, sf_dir):
    return sets.rejection_histogram(_merge_pairs(spark, sf_dir))


@query()
def greedy_merge(spark, sf_dir):
    from facetry.operators.graph import connected_components

    _ensure_checkpoint_dir(spark)
    p = _tile_planes(spark, sf_dir)
    edges = grouped.tile_pairs(p, "vec_id", _GATES, trees=True)
    return grouped.merge_planes(p, connected_components(edges, "vec_id_a", "vec_id_b"), "vec_id", _GATES)


@query(N_WITH + """, rep AS (SELECT label, arg_max(struct_pack(nx := nx, ny := ny, nz := nz), struct_pack(p := core_red_points, s := -vec_id)) AS r FROM planes GROUP BY 1),
j AS (SELECT p.*, CASE WHEN r.nx * p.nx + r.ny * p.ny + r.nz * p.nz < 0 THEN -1.0 ELSE 1.0 END AS sg, greatest(1.0, core_red_points) AS w, greatest(1.0, point_count) AS n FROM planes p JOIN rep USING (label))
SELECT label, count(*) AS instance_count, count(DISTINCT ix || '_' || iy) AS tile_count, round(sum(center_x * w) / sum(w), 8) AS center_x, round(sqrt(sum(rms_m * rms_m * n) / sum(n)), 8) AS rms_m, round(sum(inlier_ratio * n) / sum(n), 8) AS inlier_ratio, min(bbox_min_x) AS bbox_min_x, max(bbox_max_z) AS bbox_max_z, bool_and(edge_censored) AS edge_censored, round(max(area_m2), 10) AS max_instance_area_m2 FROM j GROUP BY 1""")
def plane_rollup(spark, sf_dir):
    p = planes(spark, sf_dir).withColumns({"tile_id": F.concat_ws("_", "ix", "iy"), "seq": F.col("vec_id"), "observed_area_m2": F.col("area_m2"), "normal_scale_m": F.lit(0.15), "normal_stable_fraction": F.lit(1.0), "normal_valid_scale_count": F.lit(2.0), "normal_stability_deg": F.lit(0.0)})
    r = sets.roll_up(p, "label")
    return r.select("label", "instance_count", "tile_count", *[_r(F.col(c)).alias(c) for c in ("center_x", "rms_m", "inlier_ratio")], "bbox_min_x", "bbox_max_z", "edge_censored", _r(F.col("max_instance_area_m2"), 10).alias("max_instance_area_m2"))


@query(N_WITH + " SELECT label, arg_max(vec_id, struct_pack(p := core_red_points, s := -vec_id)) AS vec_id FROM planes GROUP BY 1")
def representative(spark, sf_dir):
    return planes(spark, sf_dir).groupBy("label").agg(F.max_by("vec_id", F.struct(F.col("core_red_points").alias("p"), (-F.col("vec_id")).alias("s"))).alias("vec_id"))


@query(N_WITH + ", s AS (SELECT label, count(*) AS n, sqrt(power(sum(nx), 2) + power(sum(ny), 2) + power(sum(nz), 2)) / count(*) AS r FROM planes GROUP BY 1) SELECT label, round(CASE WHEN n < 2 OR r >= 0.999999 THEN NULL WHEN r < 1e-6 THEN 0.0 ELSE (3 * r - r * r * r) / greatest(1 - r * r, 1e-12) END, 8) AS fisher_k FROM s")
def fisher_k(spark, sf_dir):
    s = planes(spark, sf_dir).groupBy("label").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias("s" + c) for c in ("nx", "ny", "nz")])
    return s.select("label", _r(sets.fisher_k(F.col("n"), F.col("snx"), F.col("sny"), F.col("snz"))).alias("fisher_k"))


@query(N_WITH + " SELECT vec_id, format('J{}-{:03d}', label, row_number() OVER (PARTITION BY label ORDER BY point_count DESC, center_x, center_y, vec_id)) AS plane_id FROM planes")
def plane_numbering(spark, sf_dir):
    p = planes(spark, sf_dir).withColumn("set_id", F.concat(F.lit("J"), F.col("label")))
    return order.numbered(p, "set_id", [F.desc("point_count"), F.asc("center_x"), F.asc("center_y"), F.asc("vec_id")]).select("vec_id", "plane_id")


@query(N_WITH + ", s AS (SELECT label, sum(point_count) AS w, min(vec_id) AS t FROM planes GROUP BY 1) SELECT label, 'J' || row_number() OVER (ORDER BY round(w, 6) DESC, t) AS set_id FROM s")
def set_numbering(spark, sf_dir):
    return order.numbered_sets(planes(spark, sf_dir).select("label", "vec_id", "point_count"), "label", "point_count", "vec_id").select("label", "set_id").distinct()


@query(N_WITH + ", g AS (SELECT vec_id % 37 AS g, min(vec_id) AS s FROM planes GROUP BY 1), n AS (SELECT g, format('GJ-{:05d}', row_number() OVER (ORDER BY s)) AS global_plane_id FROM g) SELECT vec_id, global_plane_id FROM planes JOIN n ON g = vec_id % 37")
def global_ids(spark, sf_dir):
    p = planes(spark, sf_dir).select("vec_id", (F.col("vec_id") % 37).alias("g"))
    return order.global_ids(p, "g", "vec_id").select("vec_id", "global_plane_id")


# --- scans and spacings -----------------------------------------------------------------------------------------

_SCAN = "WITH d AS (SELECT user_id, lag(event_id) OVER w AS event_id_a, event_id AS event_id_b, value - lag(value) OVER w AS spacing_m FROM events WINDOW w AS (PARTITION BY user_id ORDER BY value, event_id)), s AS (SELECT * FROM d WHERE spacing_m > 1e-9)"


def _scan(spark, sf_dir):
    return sets.scanline_spacing(table(spark, sf_dir, "events"), "user_id", "value", "event_id")


@query(_SCAN + " SELECT user_id, event_id_a, event_id_b, round(spacing_m, 8) AS spacing_m FROM s")
def scanline_spacing(spark, sf_dir):
    return _scan(spark, sf_dir).withColumn("spacing_m", _r(F.col("spacing_m")))


@query(_SCAN + " SELECT user_id, count(*) AS spacing_count, round(avg(spacing_m), 6) AS mean_spacing_m, round(quantile_cont(spacing_m, 0.5), 6) AS median_spacing_m, round(stddev_pop(spacing_m), 6) AS std_spacing_m, round(min(spacing_m), 6) AS min_spacing_m, round(max(spacing_m), 6) AS max_spacing_m, round(quantile_cont(spacing_m, 0.1), 6) AS p10_spacing_m, round(quantile_cont(spacing_m, 0.9), 6) AS p90_spacing_m FROM s GROUP BY 1")
def joint_set_stats(spark, sf_dir):
    s = sets.spacing_statistics(_scan(spark, sf_dir), "user_id")
    return s.select("user_id", "spacing_count", *[_r(F.col(c), 6).alias(c) for c in s.columns if c.endswith("_spacing_m")])


@query(_SCAN + ", e AS (SELECT event_id_a AS plane_id, spacing_m FROM s UNION ALL SELECT event_id_b, spacing_m FROM s) SELECT plane_id, round(min(spacing_m), 8) AS nearest_spacing_m FROM e GROUP BY 1")
def nearest_spacing(spark, sf_dir):
    return sets.nearest_spacing(_scan(spark, sf_dir), "event_id_a", "event_id_b").select("plane_id", _r(F.col("nearest_spacing_m")).alias("nearest_spacing_m"))


@query(N_WITH + """, lead_ AS (SELECT label, arg_max(struct_pack(nx := nx, ny := ny, nz := nz), struct_pack(w := 1.0, a := -abs(nx), b := -abs(ny), c := -abs(nz))) AS r FROM planes GROUP BY 1),
j AS (SELECT p.*, CASE WHEN r.nx * p.nx + r.ny * p.ny + r.nz * p.nz < 0 THEN -1.0 ELSE 1.0 END AS g FROM planes p JOIN lead_ USING (label)),
m AS (SELECT label, count(*) AS n, sum(nx * g) AS x, sum(ny * g) AS y, sum(nz * g) AS z, sqrt(sum(nx * g) * sum(nx * g) + sum(ny * g) * sum(ny * g) + sum(nz * g) * sum(nz * g)) AS len, CASE WHEN sum(nz * g) < 0 THEN -1.0 ELSE 1.0 END AS f FROM j GROUP BY 1)
SELECT 'S' || label AS set_id, n AS plane_count, round(degrees(atan2(sqrt(x * x + y * y), z * f)), 6) AS mean_dip_deg, round((degrees(atan2(x * f, y * f)) + 360.0) % 360.0, 6) AS mean_dip_direction_deg FROM m""")
def set_orientations(spark, sf_dir):
    p = planes(spark, sf_dir).select(F.concat(F.lit("S"), F.col("label")).alias("set_id"), "vec_id", "nx", "ny", "nz", "plane_d", *[F.col(f"center_{c}").alias(f"centroid_{c}") for c in "xyz"])
    j, _ = sets.joint_sets(p, key="vec_id", max_deviation_deg=None)
    return j.select("set_id", "plane_count", _r(F.col("mean_dip_deg"), 6).alias("mean_dip_deg"), _r(F.col("mean_dip_direction_deg"), 6).alias("mean_dip_direction_deg"))


@query("WITH t AS (SELECT event_type, quantile_cont(value, 0.1) AS p10, quantile_cont(value, 0.5) AS m FROM events GROUP BY 1) SELECT CASE WHEN p10 IS NULL OR m IS NULL THEN 'DENSITY_NOT_ASSESSED' WHEN p10 >= 5 AND m >= 40 THEN 'pass' ELSE 'DENSITY_TARGET_NOT_MET' END AS status, count(*) AS tiles FROM t GROUP BY 1")
def density_status(spark, sf_dir):
    t = table(spark, sf_dir, "events").groupBy("event_type").agg(F.percentile("value", 0.1).alias("p10"), F.percentile("value", 0.5).alias("m"))
    return t.select(scores.density_status(F.col("p10"), F.col("m"), 5, 40).alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("tiles"))


@query("WITH t AS (SELECT user_id, quantile_cont(value, 0.5) AS m FROM events GROUP BY 1) SELECT count(*) AS tile_count, round(quantile_cont(m, 0.1), 8) AS p10, round(quantile_cont(m, 0.5), 8) AS median, round(quantile_cont(m, 0.9), 8) AS p90 FROM t")
def tile_density_summary(spark, sf_dir):
    t = table(spark, sf_dir, "events").groupBy("user_id").agg(F.percentile("value", 0.5).alias("m"))
    return t.agg(F.count(F.lit(1)).alias("tile_count"), *[_r(F.percentile("m", q)).alias(n) for q, n in ((0.1, "p10"), (0.5, "median"), (0.9, "p90"))])


@query(N_WITH + " SELECT vec_id, round(CASE WHEN minor_extent_m > 0 THEN point_count / minor_extent_m END, 4) AS p10_discontinuities_per_m, round(CASE WHEN area_m2 > 0 THEN point_count / area_m2 END, 4) AS p20_planes_per_m2, CASE WHEN CASE WHEN area_m2 > 0 THEN major_extent_m / area_m2 END IS NULL THEN 'trace_module_unavailable' END AS p21_reason FROM planes")
def density_observables(spark, sf_dir):
    o = P.density_observables(F.col("point_count"), F.col("area_m2"), F.col("major_extent_m"), F.col("minor_extent_m"))
    return planes(spark, sf_dir).select("vec_id", _r(o["p10_discontinuities_per_m"], 4).alias("p10_discontinuities_per_m"), _r(o["p20_planes_per_m2"], 4).alias("p20_planes_per_m2"), o["p21_reason"].alias("p21_reason"))


# --- state and membership ---------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def overlay_semi_join(spark, sf_dir):
    chosen = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, sf_dir, "lineitem").join(chosen, "l_orderkey", "left_semi").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def resume_anti_join(spark, sf_dir):
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(done, "c_custkey", "left_anti").select("c_custkey")


@query("SELECT l_partkey AS member FROM lineitem UNION SELECT p_partkey FROM part")
def distinct_members(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("member")).union(table(spark, sf_dir, "part").select("p_partkey")).distinct()


@query("SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def json_properties(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.get_json_object("props", "$.k").cast("long").alias("k"), "value")
    return e.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("""SELECT 'line_keys_have_orders' AS check_name, CAST(0 AS BIGINT) AS expected, (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS actual
UNION ALL SELECT 'orders_unique', (SELECT count(*) FROM orders), (SELECT count(DISTINCT o_orderkey) FROM orders)
UNION ALL SELECT 'quantities_positive', CAST(0 AS BIGINT), (SELECT count(*) FROM lineitem WHERE NOT l_quantity > 0)""")
def validation_checks(spark, sf_dir):
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    keys = o.select(F.col("o_orderkey").alias("l_orderkey"))
    a = li.join(keys, "l_orderkey", "left_anti").agg(F.lit("line_keys_have_orders").alias("check_name"), F.lit(0).cast("long").alias("expected"), F.count(F.lit(1)).alias("actual"))
    b = o.agg(F.lit("orders_unique").alias("check_name"), F.count(F.lit(1)).alias("expected"), F.count_distinct("o_orderkey").alias("actual"))
    c = li.agg(F.lit("quantities_positive").alias("check_name"), F.lit(0).cast("long").alias("expected"), F.count_if(~(F.col("l_quantity") > 0)).alias("actual"))
    return a.unionByName(b).unionByName(c)


@query("SELECT n_nationkey AS point_id, round(0.61803398875 * n_nationkey - floor(0.61803398875 * n_nationkey), 8) AS hue FROM nation")
def golden_hues(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("point_id"), _r(F.pmod(F.col("n_nationkey").cast("double") * 0.61803398875, F.lit(1.0))).alias("hue"))


@query(P_WITH + " SELECT pid, CAST(round(x / 0.001) AS INTEGER) AS qx, CAST(round((y - 0.0) / 0.001) AS INTEGER) AS qy FROM pts")
def quantised_coordinates(spark, sf_dir):
    return points(spark, sf_dir).select("pid", G.quantised(F.col("x"), 0.001, 0.0).alias("qx"), G.quantised(F.col("y"), 0.001, 0.0).alias("qy"))

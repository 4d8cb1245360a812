import random
from math import acos, degrees

import numpy as np
import pytest
from pyspark.sql import functions as F

from facetry.operators import clusters, joins, order, points as P, sets


@pytest.fixture(scope="module")
def scan(spark):
    rng = np.random.default_rng(3)
    p = np.round(rng.random((150, 3)) * 3, 3)
    return p, spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(p)], "point_id long, x double, y double, z double")


def test_radius_and_knn(spark, scan):
    p, df = scan
    d2 = ((p[:, None] - p[None]) ** 2).sum(-1)
    got = {(r.point_id_a, r.point_id_b) for r in joins.self_radius_pairs(df, 0.5, "point_id").collect()}
    assert got == {(i, j) for i in range(150) for j in range(i + 1, 150) if d2[i, j] <= 0.25}
    near = joins.knn(df, 5, "point_id", start=0.2)
    got = {}
    for r in near.collect():
        got.setdefault(r.point_id_a, {})[r["rank"]] = r.point_id_b
    for i in range(150):
        want = sorted(range(150), key=lambda j: (d2[i, j], j))[:5]
        assert [got[i][k] for k in range(1, 6)] == want


def test_axial_join_is_blind_to_sign(spark):
    rng = np.random.default_rng(4)
    n = rng.normal(size=(80, 3))
    n /= np.linalg.norm(n, axis=1)[:, None]
    n[1], n[2] = -n[0], n[0]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(n)], "k long, nx double, ny double, nz double")
    want = {(i, j) for i in range(80) for j in range(i + 1, 80) if degrees(acos(min(1.0, abs(float(n[i] @ n[j]))))) <= 15}
    assert {(r.k_a, r.k_b) for r in joins.axial_join(df, 15.0, "k").collect()} == want
    comp = {r.k: r.component for r in sets.axial_components(df, 1.0, "k").collect()}
    assert comp[0] == comp[1] == comp[2] == 0


def test_boxes(spark):
    rng = random.Random(5)
    b = [(i, x, x + rng.random() * 3, y, y + rng.random() * 3) for i in range(80) for x, y in [(rng.random() * 20, rng.random() * 20)]]
    df = spark.createDataFrame(b, "k int, x0 double, x1 double, y0 double, y1 double")
    want = {(p[0], q[0]) for p in b for q in b if p[0] < q[0] and max(p[1], q[1]) - min(p[2], q[2]) <= 0.5 and max(p[3], q[3]) - min(p[4], q[4]) <= 0.5}
    rows = [(r.k_a, r.k_b) for r in joins.box_gap_join(df, 0.5, "k", cell=2.0).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_dbscan(spark, scan):
    p, df = scan
    d2 = ((p[:, None] - p[None]) ** 2).sum(-1)
    near = d2 <= 0.4**2
    core = near.sum(1) >= 4
    got = {r.point_id: r for r in clusters.spatial_dbscan(df, 0.4, 4).collect()}
    assert [got[i].core for i in range(150)] == core.tolist()
    for i in range(150):
        assert (got[i].cluster is None) == (not core[i] and not (near[i] & core).any())


def test_order(spark):
    rng = random.Random(6)
    v = [rng.randint(0, 50) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(v)), "i int, v int")
    ranks = {r.i: r.r for r in order.ranked(df, [F.col("v"), F.col("i")], "r").collect()}
    assert [ranks[i] for i in sorted(range(500), key=lambda i: (v[i], i))] == list(range(1, 501))
    for m in (2, 7, 100, 499):
        got = sorted(r.i for r in order.linspace_sample(df, m, [F.col("i")]).collect())
        assert got == sorted({int(k * ((500 - 1) / (m - 1))) for k in range(m)})
    assert order.nearest_rank(df, "v", 0.5).first().value == sorted(v)[round(499 * 0.5)]


def test_features_of_a_plane(spark):
    g = [(i * 21 + j, i * 0.1, j * 0.1, 0.5 * i * 0.1) for i in range(21) for j in range(21)]
    df = spark.createDataFrame(g, "point_id long, x double, y double, z double")
    f = P.local_features(df, 0.35, min_neighbors=8)
    r = f.where("point_id = 220").first()
    assert r.planarity > 0.5 and r.surface_variation < 1e-9 and abs(abs(np.dot(r.normal, np.array([-0.5, 0, 1]) / 1.25**0.5)) - 1) < 1e-9
    m = P.multiscale_features(df, [0.25, 0.35, 0.45], min_neighbors=8, knn_cap=None)
    r = m.where("point_id = 220").first()
    assert r.normal_stable and r.normal_scale_m == 0.25 and r.normal_stability_deg < 1e-3
    assert P.planar_candidates(m, min_neighbors=8).count() > 300
    v = P.voxel_downsample(df, 0.5)
    assert v.agg(F.sum("n")).first()[0] == 441
    tri = spark.createDataFrame([(0.0, 0.0, 0.0, 2.0, 0.0, 0.0, 0.0, 2.0, 0.0)], "ax double, ay double, az double, bx double, by double, bz double, cx double, cy double, cz double")
    s = P.triangle_samples(tri, 100)
    assert s.count() == 200 and s.where("x < 0 or y < 0 or x + y > 2.000001").count() == 0


def test_merge_candidates_joins_once(spark):
    from facetry.plans import catalogue

    df = catalogue._merge_pairs(spark, "/root/testdata/sf0.001").select("vec_id_a", "vec_id_b", "reason")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1  # pairs may be many times the rows: they are not joined with them again

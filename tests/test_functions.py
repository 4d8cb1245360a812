import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from facetry import config, schemas
from facetry.functions import geometry as G, scores, shapes
from facetry.operators import grouped, tiling


def test_config_merges_and_boxes():
    c = config.load(None, {"plane": {"ransac_distance": 0.5}, "new": {"a": 1}, "plane_merge": {"hierarchical": {"normal_angle_deg": 3}}})
    assert c["plane"]["distance"] == 0.5 and c["plane"]["iterations"] == 1000 and c["new"] == {"a": 1} and c["plane_merge"]["hierarchical"]["angle_deg"] == 3
    assert config.parse_bbox("1,2,3,4") == (1, 2, 3, 4) == config.parse_bbox({"xmin": 1, "max_x": 2, "min_y": 3, "ymax": 4})
    for bad in ("1,2,3", "2,1,3,4", {"xmin": 1, "ymin": 0, "ymax": 1}, [1, 2, 3, float("nan")]):
        with pytest.raises(ValueError):
            config.parse_bbox(bad)


def test_shapes_of_known_patches():
    n = np.array([0.2, 0.4, 0.894])
    n /= np.linalg.norm(n)
    u, v = shapes.axes_of(n)
    p = np.array([10.0, -3, 7]) + np.array([a * u + b * v for a in (-2, 2) for b in (-1, 1)])
    m, d = shapes.fit_tls(p)
    assert np.allclose(np.abs(m @ n), 1) and np.allclose(p @ m + d, 0)
    s = shapes.shape_metrics(shapes.to_uv(p, p.mean(0), m))
    assert round(s["area"], 4) == 8.0 and s["diameter"] > 4 and math.isclose(s["major"], 4) and math.isclose(s["minor"], 2)
    q = np.random.default_rng(0).random((200, 2))
    t = shapes.triangulate(q)
    assert math.isclose(sum(abs(shapes._turn(*q[x])) / 2 for x in t), shapes.area(shapes.hull(q)), rel_tol=1e-3)
    a, b = np.array([[0, 0], [1, 0], [1, 1], [0, 1.0]]), np.array([[2, 0], [3, 0], [3, 1], [2, 1.0]])
    assert shapes.ring_gap(a, b) == 1.0 and shapes.ring_gap(a, a + 0.5) == 0.0
    assert math.isclose(shapes.union_area([a, a + 0.5, b]), 1.75 + 1.0, rel_tol=2e-3)


def test_ransac_finds_the_plane():
    rng = np.random.default_rng(1)
    p = np.vstack([np.column_stack([rng.random((200, 2)), rng.normal(0, 0.002, 200)]), rng.random((60, 3)) + [0, 0, 0.1]])
    n, d, inside = shapes.ransac(p, 0.01, 200, 1)
    assert abs(n[2]) > 0.999 and inside[:200].all() and inside[200:].sum() <= 2


def test_splitting_keeps_every_axis_within_the_limit():
    rng = np.random.default_rng(2)
    n = np.vstack([c + rng.normal(0, 0.03, (4, 3)) for c in np.eye(3)]) * rng.choice([-1, 1], (12, 1))
    n /= np.linalg.norm(n, axis=1)[:, None]
    leaf = grouped.split_axes(n, 12)
    assert len(set(leaf.tolist())) == 3
    for k in set(leaf.tolist()):
        c = grouped._axis(n[leaf == k])
        assert np.degrees(np.arccos(np.clip(np.abs(n[leaf == k] @ c), 0, 1))).max() <= 12 + 1e-6


def test_complete_linkage_stops_chains():
    got = grouped.complete_linkage([1, 2, 3], [(1, 2), (2, 3)])
    assert sorted(got.values()) == [1, 1, 3]


def test_expressions(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 2.0), (2, 1.0, 0.0, 1.0), (3, 0.0, -1.0, -1.0), (4, 0.0, 0.0, 0.0)], "i int, nx double, ny double, nz double")
    n = G.up(G.unit(G.vec()))
    rows = {r.i: r for r in df.select("i", G.dip(n).alias("d"), G.dip_direction(n).alias("a")).collect()}
    assert rows[1].d == 0 and round(rows[2].d, 6) == 45 and round(rows[2].a, 6) == 90 and round(rows[3].a, 6) == 0 and rows[4].d is None
    g = {"min_confidence": 0.5, "min_area_m2": 0.25, "min_minor_extent_m": 0.2, "reject_edge_censored": True}
    planes = spark.createDataFrame([(1, 0.9, 1.0, 1.0, False), (2, 0.9, 0.1, None, True)], "i int, confidence double, area_m2 double, minor_extent_m double, edge_censored boolean")
    why = {c: [r[0] for r in planes.orderBy("i").select(scores.candidate_reasons(g, context=c)).collect()] for c in ("roi", "tile")}
    assert why["roi"] == ["", "below_min_area;below_min_minor_extent;roi_edge_censored"] and why["tile"][1] == "below_min_area;below_min_minor_extent"
    t = schemas.conform(spark.createDataFrame([(float("nan"), "x")], "spacing_m double, other string"), schemas.SPACING).first()
    assert t.spacing_m is None and t.set_id is None and not hasattr(t, "other")


def test_tiles_own_each_point_once(spark):
    g = tiling.grid_plan(0, 100, 0, 50, 40, 1)
    assert (g.max_ix, g.max_iy) == (2, 1)
    df = spark.createDataFrame([(40.0, 1.0), (39.999999, 1.0), (80.0, 49.0), (100.0, 50.0), (0.0, 0.0)], "x double, y double")
    assert [r.tile_id for r in tiling.assign_core(df, g).collect()] == ["1_0", "0_0", "2_1", "2_1", "0_0"]
    h = tiling.halo(df, g)
    assert h.where("core").count() == 5
    assert sorted(r.tile_id for r in h.where("x = 40.0").collect()) == ["0_0", "1_0"]
    with pytest.raises(ValueError):
        tiling.grid_plan(0, 1, 0, 1, 10, 5)
    assert tiling.parse_tile_name("a/tile_-1_2.laz") == (-1, 2)
    r = spark.createDataFrame([("3_-4",), ("x",)], "t string").select(*tiling.tile_indices(F.col("t"))).collect()
    assert tuple(r[0]) == (3, -4) and tuple(r[1]) == (None, None)

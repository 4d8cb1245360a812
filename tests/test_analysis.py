import numpy as np
import pandas as pd
import pytest

from facetry.config import load
from facetry.plans import analysis


@pytest.fixture(scope="module")
def setting():
    return load(None, {
        "preprocess": {"voxel_size": 0.0, "remove_outliers": False}, "normal": {"multiscale": False, "radius": 0.9, "min_neighbors": 8, "knn": 16, "max_neighbors": 16},
        "region_growing": {"radius": 0.9, "require_stable_seed": False}, "target": {"min_points": 30}, "detachment": {"reject_edge_censored": False}, "quality": {"min_confidence": 0.3},
    })


@pytest.fixture(scope="module")
def patches(spark):
    """Two parallel patches of 6 x 5 m, dip 45, dip direction 90, two metres apart."""
    u, v = np.meshgrid(np.arange(0, 6.01, 0.25), np.arange(0, 5.01, 0.25))
    n, a, b = np.array([1, 0, 1]) / 2**0.5, np.array([0, 1.0, 0]), np.array([1, 0, -1]) / 2**0.5
    p = np.vstack([u.ravel()[:, None] * a + v.ravel()[:, None] * b + n * k for k in (0, 2)]) + [1000, 2000, 50]
    return spark.createDataFrame(pd.DataFrame(p, columns=list("xyz")))


def test_two_parallel_patches(spark, patches, setting):
    r = analysis.analyse_area(patches, setting)
    planes = r.planes.toPandas()
    assert len(planes) == 2 and (planes.dip_deg.round(6) == 45).all() and (planes.dip_direction_deg.round(6) == 90).all()
    gaps = r.spacings.toPandas()
    assert set(gaps.method) == {"spacing_virtual_scanline", "spacing_3d_nonpersistent"} and (abs(gaps.spacing_m - 2) < 0.15).all()
    assert r.joint_sets.first().plane_count == 2
    assert all(c.ok for c in analysis.area_checks(r).collect())


def test_tiles_give_the_same_planes(spark, patches, setting):
    rows, _ = analysis.analyse_tiles(patches, setting, tile_size=4.0, overlap=1.0)
    out = analysis.aggregate_global(rows.checkpoint(), setting, tile_size=4.0, overlap=1.0)
    planes = out["planes"].toPandas()
    assert len(planes) == 2 and set(planes.global_set_id) == {"J1"} and (abs(planes.nearest_spacing_m - 2) < 0.15).all()
    assert {r.reason for r in out["rejections"].collect()} <= {"accepted", "plane_offset", "centroid_offset", "footprint_gap"}


def _plane(key, tile, box, footprint=None, normal=(0.0, 0.0, 1.0), d=0.0):
    x0, x1, y0, y1 = map(float, box)
    ix, iy = map(int, tile.split("_"))
    return (key, tile, ix, iy, *normal, d, x0, x1, y0, y1, 0.0, 0.0, (x0 + x1) / 2, (y0 + y1) / 2, 0.0, 0.01, footprint)


_PLANE = "row_id string, tile_id string, ix int, iy int, nx double, ny double, nz double, plane_d double, bbox_min_x double, bbox_max_x double, bbox_min_y double, bbox_max_y double, bbox_min_z double, bbox_max_z double, center_x double, center_y double, center_z double, rms_m double, footprint array<array<array<double>>>"


def test_footprints_beyond_their_boxes_meet(spark):
    ring = lambda x: [[[x, 0.0, 0.0], [x + 1, 0.0, 0.0], [x + 1, 1.0, 0.0], [x, 1.0, 0.0]]]
    rows = [_plane("a", "0_0", (0, 1, 0, 1), ring(50.0)), _plane("b", "1_0", (101, 102, 0, 1), ring(51.1))]
    from facetry.operators import sets

    args = {"key": "row_id", "gap_m": 0.3, "angle_deg": 5.0, "offset_m": 0.1, "max_rms": 0.05, "cell": 10.0, "footprint_gap": analysis._footprint_column()}
    assert [r.reason for r in sets.merge_candidates(spark.createDataFrame(rows, _PLANE), **args).collect()] == ["accepted"]
    apart = [r[:-1] + (None,) for r in rows]
    assert sets.merge_candidates(spark.createDataFrame(apart, _PLANE), **args).count() == 0


def test_outliers_are_judged_per_tile(spark):
    from facetry.operators.points import statistical_inliers

    rng = np.random.default_rng(1)
    rows = []
    for t, scale in (("0_0", 1.0), ("1_0", 20.0)):  # at the same place, so that tiles must not mix
        p = rng.random((120, 3)) * scale
        p[0] = [9 * scale] * 3
        rows += [(t, int(1000 * scale) + i, *map(float, q)) for i, q in enumerate(p)]
    rows += [("2_0", 1, 0.0, 0.0, 0.0), ("2_0", 2, 50.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "tile_id string, point_id long, x double, y double, z double")
    got = {(r.tile_id, r.point_id) for r in statistical_inliers(df, 6, 2.0, by="tile_id", start=0.2).collect()}
    want = {("2_0", 1), ("2_0", 2)}
    for t in ("0_0", "1_0"):
        mine = [r for r in rows if r[0] == t]
        p = np.array([r[2:] for r in mine])
        m = np.sort(np.linalg.norm(p[:, None] - p[None], axis=2), axis=1)[:, 1:7].mean(1)
        want |= {(t, r[1]) for r, x in zip(mine, m) if x <= m.mean() + 2.0 * m.std()}
    assert got == want and ("0_0", 1000) not in got


def test_edges_are_those_of_the_tile(spark, patches, setting):
    rows, grid = analysis.analyse_tiles(patches, setting, tile_size=3.0, overlap=0.5)
    # every patch crosses the tiles' borders, so each tile's part of it is cut
    assert rows.count() > 4 and rows.where("not edge_censored").count() == 0


def test_regions_of_touching_patches_and_ransac():
    from facetry.functions import shapes
    from facetry.operators.grouped import grow_regions

    g = np.arange(0, 2.01, 0.1)
    u, v = (a.ravel() for a in np.meshgrid(g, g))
    flat = np.column_stack([u, v, 0 * u])
    steep = np.column_stack([2.1 + 0 * u, v, u])  # touches the flat one along its edge
    p, normals = np.vstack([flat, steep]), np.vstack([np.tile([0, 0, 1.0], (len(u), 1)), np.tile([1.0, 0, 0], (len(u), 1))])
    cfg = {"angle_deg": 10.0, "max_angle_deg": 20.0, "distance": 0.05, "max_distance": 0.1, "radius": 0.25, "max_pairs": 10**6, "max_curvature": 0.2, "require_stable_seed": False, "max_seed_points": 64, "refit_every": 48}
    planarity, curvature = np.full(len(p), 0.9), np.full(len(p), 0.01)
    label = grow_regions(p, normals, planarity, curvature, np.ones(len(p), bool), cfg, 30)
    assert set(label) == {0, 1} and len(set(label[: len(u)])) == 1 and len(set(label[len(u) :])) == 1
    assert (grow_regions(p, normals, planarity, curvature, np.ones(len(p), bool), cfg, 10**6) == -1).all()
    rng = np.random.default_rng(2)
    noisy = np.vstack([flat + rng.normal(0, 0.005, flat.shape), rng.random((60, 3)) * 2 + [0, 0, 0.5]])
    n, d, inside = shapes.ransac(noisy, 0.03, 80, 7)
    assert abs(n[2]) > 0.9999 and abs(d) < 0.01 and inside[: len(u)].mean() > 0.99 and not inside[len(u) :].any()
    # the same result whatever fits into a block
    again = shapes.ransac(noisy, 0.03, 80, 7, cells=1)
    assert (again[2] == inside).all() and np.allclose(again[0], n)
    assert shapes.ransac(flat[:2], 0.1, 5, 1) is None and shapes.ransac(np.zeros((5, 3)), 0.1, 5, 1) is None

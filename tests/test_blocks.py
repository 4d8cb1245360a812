"""Searches block by block find what searches by place and brute force find, and join no pairs."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from facetry.functions.shapes import nearest_in
from facetry.operators import blocks, joins, order, places, points as P
from facetry.plans import catalogue


@pytest.fixture(scope="module")
def cloud(spark):
    """Points that mostly differ: some copies, ties on a grid, a few far away."""
    rng = np.random.default_rng(3)
    p = np.round(rng.random((500, 3)) * [4, 3, 2], 1)
    p[:6] *= 9
    p = np.concatenate([p, p[:30], p[:9]])
    ids = [f"p{i:03}" for i in rng.permutation(len(p))]
    return ids, p, spark.createDataFrame([(k, *map(float, r)) for k, r in zip(ids, p)], "pid string, x double, y double, z double").checkpoint()


@pytest.fixture
def by_blocks(monkeypatch):
    """Small tables go by blocks too, and radius joins are refused."""
    def refused(*_, **__):
        raise AssertionError("pairs are joined")

    monkeypatch.setattr(blocks, "crowded", lambda *_: False)
    for module in (P, catalogue):
        monkeypatch.setattr(module, "crowded", lambda *_: False, raising=False)
    for module in (joins, places, catalogue):
        monkeypatch.setattr(module, "radius_join", refused)


def squares(p):
    return ((p[:, None, 0] - p[None, :, 0]) ** 2 + (p[:, None, 1] - p[None, :, 1]) ** 2) + (p[:, None, 2] - p[None, :, 2]) ** 2


@pytest.fixture(scope="module")
def part_of_table(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("part"))
    duckdb.execute(f"copy (select * from '/root/testdata/sf0.01/lineitem.parquet' where l_quantity <= 4) to '{folder}/lineitem.parquet' (format parquet)")
    return folder


def test_knn_topk_by_blocks(spark, part_of_table, by_blocks):
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from '{part_of_table}/lineitem.parquet'")
    got, want = catalogue.QUERIES["knn_topk"](spark, part_of_table), con.execute(catalogue.SQL["knn_topk"])
    assert sorted(map(tuple, got.select(*[c[0] for c in want.description]).collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("k,radius", [(4, 0.3), (12, 50.0)])
def test_nearest_in(cloud, k, radius):
    p, m = np.unique(cloud[1], axis=0, return_counts=True)
    d2 = squares(p)
    asked = np.arange(0, len(p), 2)
    q, b, _, full = nearest_in(p, m, asked, k, radius, at_once=3000)
    for i, a in enumerate(asked):
        near = [j for j in np.argsort(d2[a], kind="stable") if d2[a, j] <= radius * radius]
        c = np.cumsum(m[near])
        if full[i]:
            near = [j for j in near if d2[a, j] <= d2[a, near[np.argmax(c >= k)]]]
        assert full[i] == (c[-1] >= k) and set(b[q == i]) == set(near)


def test_knn_any_distance_by_blocks(cloud, by_blocks):
    ids, p, df = cloud
    got = {(r.pid_a, r["rank"]): (r.pid_b, r.d2) for r in joins.knn(df, 4, "pid", start=0.5).collect()}
    d2 = squares(p)
    assert got == {(ids[i], n + 1): (ids[j], d2[i, j]) for i in range(len(p)) for n, j in enumerate(np.lexsort((ids, d2[i]))[:4])}


def test_nn_spacing_by_blocks(cloud, by_blocks):
    _, p, df = cloud
    d2 = squares(p)
    np.fill_diagonal(d2, np.inf)
    d = np.sqrt(d2.min(1))
    d = d[d > 1e-9]
    r = P.nn_spacing(df, start=0.5).first()
    assert r.sample_count == len(d) and np.allclose([r.p10_m, r.median_m, r.p90_m], np.quantile(d, [0.1, 0.5, 0.9]))


def test_statistical_inliers_by_blocks(cloud, by_blocks):
    ids, p, df = cloud
    mean = np.sqrt(np.sort(squares(p), 1)[:, 1:8]).mean(1)
    got = {r.pid: r.mean_distance for r in P.statistical_inliers(df, 7, 1.0, key="pid", start=0.5).collect()}
    want = {ids[i]: mean[i] for i in np.flatnonzero(mean <= mean.mean() + mean.std())}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_multiscale_features_by_blocks(cloud, by_blocks, monkeypatch):
    _, _, df = cloud
    run = lambda: {r.pid: r for r in P.multiscale_features(df, [0.3, 0.5, 0.8], min_neighbors=4, knn_cap=9, key="pid").collect()}
    got = run()
    monkeypatch.undo()
    want = run()
    assert got.keys() == want.keys()
    for k, w in want.items():
        for name in ("neighbor_count", "normal_scale_m", "normal_stable", "normal_valid_scale_count"):
            assert got[k][name] == w[name], (k, name)
        for name in ("planarity", "surface_variation", "curvature", "multiscale_entropy"):
            assert got[k][name] is None and w[name] is None or abs(got[k][name] - w[name]) < 1e-9
        assert (got[k].eigenvalues is None) == (w.eigenvalues is None) and (w.eigenvalues is None or np.allclose(got[k].eigenvalues, w.eigenvalues, atol=1e-9))


def test_quantiles(cloud):
    df, qs = cloud[2], [0.0, 0.1, 0.37, 0.5, 1.0]
    assert np.allclose(order.quantiles(df, "x", qs, buckets=3), df.agg(F.percentile("x", qs)).first()[0])
    assert order.quantiles(df.where("x < -1"), "x", [0.5]) == [None]

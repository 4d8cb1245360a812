"""Rows at one place are searched once, and each still gets its own result."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from facetry.operators import clusters, joins, places, points as P
from facetry.plans import catalogue


@pytest.fixture(scope="module")
def copies(spark):
    rng = np.random.default_rng(8)
    p = np.repeat(np.round(rng.random((30, 3)) * 2, 2), rng.integers(1, 9, 30), axis=0)
    ids = [f"p{i:03}" for i in rng.permutation(len(p))]
    return ids, p, spark.createDataFrame([(k, *map(float, r)) for k, r in zip(ids, p)], "pid string, x double, y double, z double").checkpoint()


@pytest.fixture
def searched(monkeypatch):
    """How many rows each radius join was given, the larger side."""
    seen, real = [], joins.radius_join

    def noted(left, right, *args, **named):
        seen.append(max(left.count(), right.count()))
        return real(left, right, *args, **named)

    for module in (joins, places, catalogue, clusters, P):
        monkeypatch.setattr(module, "radius_join", noted, raising=False)
    return seen


def squares(p):
    return ((p[:, None, 0] - p[None, :, 0]) ** 2 + (p[:, None, 1] - p[None, :, 1]) ** 2) + (p[:, None, 2] - p[None, :, 2]) ** 2


def test_knn_of_copies(copies, searched):
    ids, p, df = copies
    got = {(r.pid_a, r["rank"]): (r.pid_b, r.d2) for r in joins.knn(df, 4, "pid", start=0.2).collect()}
    d2 = squares(p)
    want = {(ids[i], n + 1): (ids[j], d2[i, j]) for i in range(len(p)) for n, j in enumerate(np.lexsort((ids, d2[i]))[:4])}
    assert got == want
    assert searched and max(searched) <= 30


def test_rows_without_a_place(spark):
    rows = [("a", 0.0, 0.0, 0.0), ("b", 1.0, 0.0, -0.0), ("c", None, 0.0, 0.0), ("d", float("nan"), 0.0, 0.0), ("e", float("inf"), 0.0, 0.0)]
    df = spark.createDataFrame(rows, "pid string, x double, y double, z double")
    assert {(r.pid_a, r.pid_b) for r in joins.knn(df, 4, "pid", start=0.2).collect()} == {(a, b) for a in "ab" for b in "ab"}
    assert joins.radius_join(df, df, 2.0).count() == 4


def test_nn_spacing_of_copies(copies, searched):
    _, p, df = copies
    d2 = squares(p)
    np.fill_diagonal(d2, np.inf)
    d = np.sqrt(d2.min(1))
    d = d[d > 1e-9]
    r = P.nn_spacing(df, start=0.2).first()
    assert r.sample_count == len(d) and np.allclose([r.p10_m, r.median_m, r.p90_m], np.quantile(d, [0.1, 0.5, 0.9]))
    assert searched and max(searched) <= 30


def test_inliers_of_copies(copies, searched):
    ids, p, df = copies
    mean = np.sqrt(np.sort(squares(p), 1)[:, 1:7]).mean(1)
    got = {r.pid: r.mean_distance for r in P.statistical_inliers(df, 6, 1.0, key="pid", start=0.2).collect()}
    want = {ids[i]: mean[i] for i in np.flatnonzero(mean <= mean.mean() + mean.std())}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert searched and max(searched) <= 30


@pytest.fixture(scope="module")
def copied_table(tmp_path_factory):
    """Some lineitems, three times each with orders of their own."""
    folder = str(tmp_path_factory.mktemp("copies"))
    duckdb.execute(f"copy (select l.* replace (l_orderkey + r.range * 1000000 as l_orderkey) from '/root/testdata/sf0.001/lineitem.parquet' l, range(3) r where l_quantity <= 5) to '{folder}/lineitem.parquet' (format parquet)")
    return folder


@pytest.mark.parametrize("name", ["knn_topk", "nn_spacing_quantiles", "statistical_outliers", "dbscan_cores"])
def test_queries_on_copies(spark, copied_table, searched, name):
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from '{copied_table}/lineitem.parquet'")
    most = con.sql("select count(distinct (l_quantity, l_extendedprice, l_discount, l_tax)) from lineitem").fetchall()[0][0]
    got, want = catalogue.QUERIES[name](spark, copied_table), con.execute(catalogue.SQL[name])
    cols = [c[0] for c in want.description]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(want.fetchall())
    assert searched and max(searched) <= most


def test_scales_of_copies(copies, searched):
    """At most the 5 nearest rows count; of rows at one distance those with the smaller keys, here on a coarse grid."""
    ids, p, df = copies
    p = np.round(p)
    df = df.select("pid", *[F.rint(c).alias(c) for c in "xyz"])
    r = {r.pid: r for r in P.multiscale_features(df, [1.0, 1.5], min_neighbors=3, knn_cap=5, key="pid").collect()}
    wide = {r.pid: r for r in P.local_features(df, 1.5, min_neighbors=3, knn_cap=5, key="pid").collect()}
    d2 = squares(p)
    for i, k in enumerate(ids):
        near = np.lexsort((ids, d2[i]))[:5]
        near = near[d2[i, near] <= 2.25]
        assert wide[k].neighbor_count == len(near) and r[k].neighbor_count <= len(near)
        if len(near) >= 3:
            assert np.allclose(wide[k].eigenvalues, np.maximum(np.linalg.eigvalsh(np.cov(p[near].T, bias=True)), 0), atol=1e-9)
    assert searched and max(searched) <= 30


def test_features_of_copies(copies, searched):
    ids, p, df = copies
    got = {r.pid: r for r in P.local_features(df, 0.8, min_neighbors=4, key="pid").collect()}
    near = squares(p) <= 0.8 * 0.8
    assert len(got) == len(ids)
    for i, k in enumerate(ids):
        assert got[k].neighbor_count == near[i].sum()
        if near[i].sum() >= 4:
            assert np.allclose(got[k].eigenvalues, np.maximum(np.linalg.eigvalsh(np.cov(p[near[i]].T, bias=True)), 0), atol=1e-9)
    assert searched and max(searched) <= 30


def test_dbscan_of_copies(copies, searched):
    ids, p, df = copies
    near = squares(p) <= 0.45 * 0.45
    core = near.sum(1) >= 8
    got = {r.pid: r for r in clusters.spatial_dbscan(df, 0.45, 8, key="pid").collect()}
    assert [got[k].core for k in ids] == core.tolist()
    reach = np.linalg.matrix_power((near & core & core[:, None]).astype(float), len(p)) > 0
    for i, k in enumerate(ids):
        if core[i]:
            assert got[k].cluster == min(ids[j] for j in np.flatnonzero(reach[i]))
        else:
            assert (got[k].cluster is not None) == (near[i] & core).any()
    assert searched and max(searched) <= 30


def test_pairs_of_rows(spark):
    """Copies, repeated keys, -0.0, rows without a place; lists of at most two keys, cells from narrow to wide."""
    rng = np.random.default_rng(5)
    p = np.repeat(np.round(rng.random((40, 3)) * 3 - 1.5, 1) + 0.0, rng.integers(1, 6, 40), axis=0)
    ids = [f"p{i % 90:02}" for i in rng.permutation(len(p))]
    rows = [(k, *map(float, r)) for k, r in zip(ids, p)] + [("a", 0.0, 0.0, 0.0), ("b", -0.0, 0.0, -0.0), ("c", None, 0.0, 0.0), ("d", float("nan"), 0.0, 0.0), ("e", float("inf"), 0.0, 0.0)]
    df = spark.createDataFrame(rows, "pid string, x double, y double, z double").checkpoint()
    whole = [r for r in rows if r[0] not in "cde"]
    ids, d2 = [r[0] for r in whole], squares(np.array([r[1:] for r in whole]))
    want = sorted((ids[i], ids[j], d2[i, j]) for i in range(len(ids)) for j in range(len(ids)) if ids[i] < ids[j] and d2[i, j] <= 0.36)
    for cell, most in ((None, 512), (0.6, 2), (5.0, 1)):
        got = sorted((r.pid_a, r.pid_b, r.d2) for r in places.row_pairs(df, 0.6, "pid", cell=cell, most=most).collect())
        assert got == want


def test_pairs_query_on_copies(spark, copied_table, searched):
    """No join of rows: those of a place travel as one list."""
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from '{copied_table}/lineitem.parquet'")
    got, want = catalogue.QUERIES["radius_pairs"](spark, copied_table), con.execute(catalogue.SQL["radius_pairs"])
    assert sorted(map(tuple, got.select(*[c[0] for c in want.description]).collect())) == sorted(want.fetchall())
    assert not searched


@pytest.mark.parametrize("lines,most", [(True, 10**6), (False, 10**6), (True, 1), (False, 1)])
def test_features_by_blocks(spark, lines, most):
    """On dense lines and scattered, copies and all, as pairs of rows have them; blocks that are cut, rows without a place."""
    rng = np.random.default_rng(4)
    p = np.stack([rng.integers(-3, 9, 900), rng.random(900) * 9 - 2, rng.integers(0, 40, 900) / 10], 1) if lines else rng.random((900, 3)) * [12, 9, 4] - 2
    p = np.concatenate([p, p[:50], p[:20]]) if most > 1 else np.repeat(p[:300], rng.integers(1, 12, 300), axis=0)
    ids = [f"p{i}" for i in rng.permutation(len(p))]
    rows = [(k, *map(float, r)) for k, r in zip(ids, p)]
    df = spark.createDataFrame([*rows, ("none", None, 0.0, 0.0), ("nan", float("nan"), 0.0, 0.0)], "pid string, x double, y double, z double").checkpoint()
    near = squares(p) <= 1.0
    got = {r.pid: r for r in P.ball_features(df, 1.0, min_neighbors=4, key="pid", most=most).collect()}
    assert len(got) == len(ids)
    for i, k in enumerate(ids):
        r = got[k]
        assert r.neighbor_count == near[i].sum() and r.normal_stable == (r.neighbor_count >= 4)
        if r.normal_stable:
            e = np.maximum(np.linalg.eigvalsh(np.cov(p[near[i]].T, bias=True)), 0)
            assert abs(r.planarity - (e[1] - e[0]) / max(e[2], 1e-15)) < 1e-9 and abs(r.surface_variation - e[0] / max(e.sum(), 1e-15)) < 1e-9
        else:
            assert r.planarity is None and r.surface_variation is None


def test_features_query_makes_no_pairs(spark, copied_table, searched):
    """Every point differs, so that places alone would not help."""
    got = catalogue.QUERIES["pca_features"](spark, copied_table)
    assert got.count() == duckdb.sql(f"select count(*) from '{copied_table}/lineitem.parquet'").fetchall()[0][0]
    assert not searched

"""Every query of the catalogue that has SQL, against DuckDB over the same files."""

import os

import duckdb
import pytest

from facetry.plans import catalogue

SF = os.environ.get("TEST_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n in catalogue.QUERIES if n in catalogue.SQL])
def test_matches_sql(spark, duck, name):
    a, b = catalogue.QUERIES[name](spark, SF).toPandas(), duck.sql(catalogue.SQL[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    a, b = (d[cols].sort_values(cols).reset_index(drop=True) for d in (a, b))
    assert len(a) == len(b)
    for c in cols:
        assert ((a[c] == b[c]) | (a[c].isna() & b[c].isna())).all(), c


@pytest.mark.parametrize("name", ["greedy_merge", "axial_bisection"])
def test_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_neighbours_at_any_distance(spark):
    import numpy as np

    from facetry.plans.adapters import points

    p = points(spark, SF).select("pid", "x", "y", "z").toPandas()
    nth = p.sort_values(["x", "y", "z"]).groupby("pid").cumcount() + 1
    p["pid"] = [k if n == 1 else f"{k}#{n}" for k, n in zip(p["pid"], nth.sort_index())]
    ids, x = p["pid"].to_numpy(), p[["x", "y", "z"]].to_numpy(float)
    assert p["pid"].is_unique
    order, near = [], []
    for i in range(len(x)):
        d2 = ((x[i, 0] - x[:, 0]) ** 2 + (x[i, 1] - x[:, 1]) ** 2) + (x[i, 2] - x[:, 2]) ** 2
        first = np.lexsort((ids, d2))[:33]
        order.append(first[:4])
        near.append(np.sqrt(d2[first]))
    got = {(r.pid_a, r.rank): r.pid_b for r in catalogue.QUERIES["knn_any_distance"](spark, SF).collect()}
    assert got == {(ids[i], k + 1): ids[j] for i in range(len(x)) for k, j in enumerate(order[i])}
    near = np.array(near)
    nearest = near[:, 1][near[:, 1] > 1e-9]
    r = catalogue.QUERIES["nn_spacing"](spark, SF).first()
    assert r.sample_count == len(nearest) and np.allclose([r.p10_m, r.median_m, r.p90_m], np.quantile(nearest, [0.1, 0.5, 0.9]), atol=1e-7)
    mean = near[:, 1:].mean(1)
    want = {ids[i]: mean[i] for i in np.flatnonzero(mean <= mean.mean() + 2.5 * mean.std())}
    got = {r.pid: r.mean_distance for r in catalogue.QUERIES["statistical_inliers"](spark, SF).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-7 for k in want)

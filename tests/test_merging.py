"""Pairs of planes tile by tile, and groups without the pairs, against the box join and the rule itself."""

import duckdb
import numpy as np
import pytest

from facetry.operators import graph, grouped, sets
from facetry.plans import catalogue

GATES = {"angle_deg": 25.0, "offset_m": 0.10, "gap_m": 0.05}


def some_planes(spark, n, keys, seed):
    """Much alike, in 4 x 3 tiles; some have no box along z or no normal, some too large an rms or one that is not a number."""
    rng = np.random.default_rng(seed)
    nan, rows = float("nan"), []
    for k in range(n):
        v, c, h = rng.normal([0, 0, 1], 0.3), rng.random(3) * 0.3, rng.random(3) * 0.1
        box = [float(x) for pair in zip(c - h, c + h) for x in pair]
        if k % 11 == 0:
            box[4] = None
        rms = [0.1, 0.3, nan, None][rng.choice(4, p=[0.85, 0.05, 0.05, 0.05])]
        rows.append((int(rng.integers(0, keys)), int(rng.integers(0, 4)), int(rng.integers(0, 3)), *([0.0] * 3 if k % 13 == 0 else map(float, v)), float(rng.normal(0, 0.08)), rms, *box))
    cols = "vec_id long, ix long, iy long, nx double, ny double, nz double, plane_d double, rms_m double, " + ", ".join(f"bbox_{m}_{c} double" for c in "xyz" for m in ("min", "max"))
    return spark.createDataFrame(rows, cols).checkpoint()


@pytest.mark.parametrize("keys,most", [(10**9, 4096), (60, 7)])
def test_tiles_against_boxes(spark, keys, most):
    df = some_planes(spark, 150, keys, 3)
    boxes = sets.merge_candidates(df, key="vec_id", max_rms=0.25, cell=0.25, **GATES).where("reason not in ('normal_angle', 'plane_offset', 'invalid_normal_or_plane')").select("vec_id_a", "vec_id_b", "reason")
    want = sorted(map(tuple, boxes.collect()))
    rows = sets.tile_planes(df, key="vec_id", max_rms=0.25)
    got = sorted(map(tuple, grouped.tile_pairs(rows, "vec_id", GATES, most=most).collect()))
    assert got == want and {r for *_, r in got} == set(grouped.TilePlanes.PASSED)
    edges = sorted({(a, b) for a, b, r in want if r == "accepted"})
    linked = grouped.complete_linkage(sorted({m for e in edges for m in e}), edges)
    trees = grouped.tile_pairs(rows, "vec_id", GATES, trees=True, most=most)
    merged = grouped.merge_planes(rows, graph.connected_components(trees, "vec_id_a", "vec_id_b"), "vec_id", GATES)
    assert {r.vec_id: r.merged_into for r in merged.collect()} == linked and len(set(linked.values())) < len(linked)


def test_no_planes(spark):
    rows = sets.tile_planes(some_planes(spark, 3, 9, 1).where("false"), key="vec_id", max_rms=0.25)
    assert grouped.tile_pairs(rows, "vec_id", GATES).count() == 0


@pytest.fixture(scope="module")
def alike(tmp_path_factory):
    """120 planes that are nearly the same, in two tiles; one of them has no end."""
    folder = str(tmp_path_factory.mktemp("alike"))
    duckdb.execute(f"""copy (select r.range // 60 + 8 * (r.range % 60) * 8 as vec_id, cast(0 as integer) as label,
      list_transform(range(64), lambda i: cast(case when i = 2 then 1 when i = 8 and r.range = 5 then 'inf' when i >= 8 and i < 11 then 0.1 else r.range / 1e5 end as float)) as embedding
      from range(120) r) to '{folder}/embeddings.parquet' (format parquet)""")
    return folder


def test_plane_without_end(spark, alike):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{alike}/embeddings.parquet'")
    want = con.execute(catalogue.SQL["plane_merge_candidates"])
    got = catalogue.QUERIES["plane_merge_candidates"](spark, alike)
    rows = sorted(map(tuple, got.select(*[c[0] for c in want.description]).collect()))
    assert rows == sorted(want.fetchall()) and len(rows) == 3600


def test_merging_links_no_more_than_planes(spark, alike, monkeypatch):
    seen, real = [], graph.connected_components

    def noted(edges, *args, **named):
        seen.append(edges.count())
        return real(edges, *args, **named)

    monkeypatch.setattr(graph, "connected_components", noted)
    got = {r.vec_id: r.merged_into for r in catalogue.QUERIES["greedy_merge"](spark, alike).collect()}
    assert len(got) == 120 and set(np.unique(list(got.values()), return_counts=True)[1]) == {2}
    assert 0 < seen[0] < 5 * 120

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from facetry import app, schemas
from facetry.operators import tiling
from facetry.sources import files, las
from facetry.streaming import tiles


@pytest.fixture()
def scan(spark):
    rng = np.random.default_rng(1)
    rows = [(float(1000 + 10 * a), float(2000 + 10 * b), float(3000 + c), int(100 * a), i % 30, i % 7, 100, 200, 300) for i, (a, b, c) in enumerate(rng.random((1000, 3)))]
    return spark.createDataFrame(rows, las.SCHEMA)


def test_las_round_trip(spark, scan, tmp_path):
    path = str(tmp_path / "out.las")
    info = las.write_las(scan.repartition(3), path)
    assert info["points"] == 1000 and info["max_abs_error_m"] <= 0.000501
    back = las.read_las(spark, path, recordsPerPartition=100)
    assert back.rdd.getNumPartitions() >= 10
    a, b = (d.orderBy("x", "y").select(F.round("x", 3).alias("x"), "intensity", "classification", "point_source_id", "red").collect() for d in (scan, back))
    assert sorted(r.intensity for r in a) == sorted(r.intensity for r in b) and {r.red for r in b} == {100}
    assert back.where("x >= 1005 and y < 2003").count() == scan.where("round(x, 3) >= 1005 and round(y, 3) < 2003").count()
    h = las.read_header(os.path.join(path, os.listdir(path)[0]))
    assert h.version == (1, 4) and not las.is_copc(h.path)
    open(tmp_path / "bad.las", "wb").write(b"nothing")
    assert tiles.invalid_tiles(str(tmp_path)) == [str(tmp_path / "bad.las")]


def test_tables_and_reports(spark, tmp_path):
    df = spark.createDataFrame([("J1", "a", "b", 1.25), ("J1", "b", "c", float("inf"))], "set_id string, plane_id_a string, plane_id_b string, spacing_m double").withColumn("extra", F.lit(1))
    files.write_table(df, str(tmp_path / "s"), schemas.SPACING, one_file=True)
    back = files.read_table(spark, str(tmp_path / "s"), schemas.SPACING).orderBy("plane_id_a").collect()
    assert back[0].spacing_m == 1.25 and back[1].spacing_m is None and back[0].method is None
    files.write_json(str(tmp_path / "r.json"), {"a": float("nan"), "b": np.float64(1), "c": [np.int32(2)]})
    assert files.read_json(str(tmp_path / "r.json")) == {"a": None, "b": 1.0, "c": [2]}
    p = spark.createDataFrame([("p", [[[0.0, 0.0, 0.0], [1.0, 0.0, 0.0], [1.0, 1.0, 0.0]]])], "plane_id string, footprint array<array<array<double>>>")
    assert files.write_geojson(p, str(tmp_path / "g.json"), ["plane_id"]) == 1
    g = json.load(open(tmp_path / "g.json"))["features"][0]
    assert g["geometry"]["type"] == "Polygon" and g["geometry"]["coordinates"][0][0] == g["geometry"]["coordinates"][0][-1] and g["properties"] == {"plane_id": "p"}
    pts = spark.createDataFrame([(0.0, 1.0, 2.0, 0, 0), (1.0, 1.0, 1.0, -1, -1)], "x double, y double, z double, label int, plane_index int")
    files.write_ply(pts, str(tmp_path / "a.ply"))
    assert files.ply_header(str(tmp_path / "a.ply"))[0] == 2 and files.ply_is_whole(str(tmp_path / "a.ply"))


def test_view_polygon():
    roi = files.projection_roi({"projection": {"origin_xyz": [0, 0, 0], "elevation_deg": 28}, "polygon_uv": [[0, 0], [1, 0], [1, 1], [0, 0]], "boundary_buffer_m": 1})
    assert len(roi["ring"]) == 3 and roi["buffer"] == 1
    for bad in ({"origin": [0, 0], "polygon_uv": [[0, 0], [1, 0], [1, 1]]}, {"origin": [0, 0, 0], "polygon_uv": [[0, 0], [1, 1], [1, 0], [0, 1]]}, {"origin": [0, 0, 0], "polygon_uv": [[0, 0], [1, 1], [2, 2]]}):
        with pytest.raises(ValueError):
            files.projection_roi(bad)


def test_state_fences_and_retries(spark, tmp_path):
    g = tiling.grid_plan(0, 79, 0, 39, 40, 1)
    path = str(tmp_path / "state.json")
    s = tiles.TileState(path, g, "v1")
    calls = []

    def work(t):
        calls.append(t)
        if t == "1_0" and calls.count(t) == 1:
            raise RuntimeError("first time")
        return "r", 5

    assert tiles.run_tiles(s, ["0_0", "1_0"], work) == 1
    s = tiles.TileState(path, g, "v1", resume=True)
    assert [r.tile_id for r in s.pending(tiling.tiles(spark, g)).collect()] == ["1_0"]
    assert tiles.run_tiles(s, ["0_0", "1_0"], work) == 0 and calls == ["0_0", "1_0", "1_0"]
    for bad in (lambda: tiles.TileState(path, g, "v2", resume=True), lambda: tiles.TileState(path, tiling.grid_plan(0, 79, 0, 39, 20, 1), "v1", resume=True), lambda: tiles.TileState(path, g, "v1")):
        with pytest.raises(ValueError):
            bad()


def test_streaming_crop_goes_on(spark, tmp_path):
    roi = {"origin": (0.0, 0.0, 0.0), "azimuth_deg": 0.0, "elevation_deg": 0.0, "ring": [(1.0, 1.0), (9.0, 1.0), (9.0, 9.0), (1.0, 9.0)], "buffer": 0.0}
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    make = lambda lo: spark.range(lo, lo + 10).selectExpr("cast(id as double) x", "0D y", "cast(id as double) z").coalesce(1).write.mode("append").parquet(src)
    make(0)
    assert tiles.stream_crop(spark, src, out, ck, roi).count() == 7
    make(0)
    kept = tiles.stream_crop(spark, src, out, ck, roi)
    assert kept.count() == 14
    r = tiles.crop_report(spark.read.parquet(src), kept).first()
    assert r.input_points == 20 and r.kept_fraction == 0.7


def test_commands_are_chosen():
    assert app.chosen(["roi", "--x"]) == ("roi", ["--x"]) and app.chosen(["--mode", "validate", "d"]) == ("validate", ["d"])
    assert app.chosen(["--mode=crop-roi"]) == ("crop-roi", []) and app.chosen(["--input", "a"]) == ("whole", ["--input", "a"])

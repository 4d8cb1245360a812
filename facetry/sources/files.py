"""Other files that the plans read and write: tables of fixed columns, JSON reports, GeoJSON, PLY, OBJ, raw coordinates."""

from __future__ import annotations

import json
import math
import os
import struct
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetry.functions.geometry import golden_colour
from facetry.schemas import conform


def write_table(df: DataFrame, path: str, ddl: str, *, form: str = "csv", one_file: bool = False) -> None:
    """Exactly the table's columns. one_file is for small result tables that people open; big ones stay in parts."""
    out = conform(df, ddl)
    out = out.coalesce(1) if one_file else out
    writer = out.write.mode("overwrite")
    writer.option("header", True).csv(path) if form == "csv" else writer.format(form).save(path)


def read_table(spark: SparkSession, path: str, ddl: str, *, form: str = "csv") -> DataFrame:
    """Recovered rows: missing columns are null, unknown ones are left out, rows that don't parse become nulls."""
    if form == "json":
        return spark.read.schema(ddl).json(path)
    raw = spark.read.option("header", True).csv(path) if form == "csv" else spark.read.format(form).load(path)
    from facetry.schemas import struct as of

    return raw.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in of(ddl)])


def _plain(v: Any) -> Any:
    if isinstance(v, dict):
        return {str(k): _plain(x) for k, x in v.items()}
    if isinstance(v, (list, tuple)):
        return [_plain(x) for x in v]
    if isinstance(v, np.ndarray):
        return _plain(v.tolist())
    if isinstance(v, np.generic):
        return _plain(v.item())
    return None if isinstance(v, float) and not math.isfinite(v) else v


def write_json(path: str, value: Any) -> None:
    """Whole or not at all; what is not finite becomes null."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    part = f"{path}.tmp"
    with open(part, "w", encoding="utf-8") as f:
        json.dump(_plain(value), f, ensure_ascii=False, indent=2)
        f.flush()
        os.fsync(f.fileno())
    os.replace(part, path)


def read_json(path: str) -> Any:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def features(planes: DataFrame, properties: list[str], rings: str = "footprint") -> DataFrame:
    """One GeoJSON feature per plane (`feature`): a polygon or several, outer rings only, closed."""
    closed = F.transform(F.filter(rings, lambda r: F.size(r) >= 3), lambda r: F.concat(r, F.slice(r, 1, 1)))
    n = F.size(closed)
    prop = F.struct(*properties)
    one = F.to_json(F.struct(F.lit("Feature").alias("type"), prop.alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(F.get(closed, 0)).alias("coordinates")).alias("geometry")))
    more = F.to_json(F.struct(F.lit("Feature").alias("type"), prop.alias("properties"), F.struct(F.lit("MultiPolygon").alias("type"), F.transform(closed, lambda r: F.array(r)).alias("coordinates")).alias("geometry")))
    return planes.where(F.col(rings).isNotNull() & (n > 0)).select(F.when(n == 1, one).otherwise(more).alias("feature"))


def write_geojson(planes: DataFrame, path: str, properties: list[str], rings: str = "footprint") -> int:
    """A feature collection; features are streamed to the file one partition at a time."""
    n, part = 0, f"{path}.tmp"
    with open(part, "w", encoding="utf-8") as f:
        f.write('{"type":"FeatureCollection","features":[')
        for r in features(planes, properties, rings).toLocalIterator():
            f.write(("," if n else "") + r.feature)
            n += 1
        f.write("]}")
    os.replace(part, path)
    return n


_VERTEX = struct.Struct("<fffBBBii")


def write_ply(points: DataFrame, path: str, *, colour: Column | None = None, label: str = "label", plane: str = "plane_index") -> int:
    """Binary PLY: coordinates, colour, two numbers. Colours follow the plane's number unless given."""
    c = colour if colour is not None else golden_colour(F.coalesce(F.col(plane), F.lit(-1)))
    rows = points.select("x", "y", "z", c.alias("c"), F.coalesce(F.col(label), F.lit(-1)).alias("l"), F.coalesce(F.col(plane), F.lit(-1)).alias("p"))
    n, part = points.count(), f"{path}.tmp"
    with open(part, "wb") as f:
        f.write(f"ply\nformat binary_little_endian 1.0\nelement vertex {n}\nproperty float x\nproperty float y\nproperty float z\nproperty uchar red\nproperty uchar green\nproperty uchar blue\nproperty int set_label\nproperty int plane_index\nend_header\n".encode())
        for r in rows.toLocalIterator():
            f.write(_VERTEX.pack(r.x, r.y, r.z, r.c.red, r.c.green, r.c.blue, r.l, r.p))
    os.replace(part, path)
    return n


def candidate_colour(selected: Column) -> Column:
    """Selected planes red, the rest grey."""
    return F.struct(*[F.when(selected, a).otherwise(128).alias(n) for n, a in (("red", 230), ("green", 35), ("blue", 35))])


def ply_header(path: str) -> tuple[int, int]:
    """Vertices and where they begin; the payload has to have just their size."""
    with open(path, "rb") as f:
        head = f.read(65536)
    end = head.find(b"end_header\n")
    lines = head[: max(end, 0)].decode("ascii", "replace").split("\n")
    if end < 0 or lines[0] != "ply":
        raise ValueError(f"{path}: no PLY header")
    n = next(int(x.split()[2]) for x in lines if x.startswith("element vertex"))
    return n, end + 11


def ply_is_whole(path: str) -> bool:
    n, at = ply_header(path)
    return os.path.getsize(path) == at + n * _VERTEX.size


def obj_checks(spark: SparkSession, path: str) -> DataFrame:
    """Counts, bounds and groups of a Wavefront text, one row."""
    t = spark.read.text(path)
    p = F.split(F.trim("value"), r"\s+")
    v = F.when(t.value.startswith("v "), F.transform(F.slice(p, 2, 3), lambda s: s.try_cast("double")))
    r = t.select(v.alias("v"), t.value.startswith("f ").alias("f"), F.when(t.value.startswith("o ") | t.value.startswith("g "), F.get(p, 1)).alias("g"), F.when(t.value.startswith("f "), F.size(p) - 1).alias("corners"))
    return r.agg(F.count("v").alias("vertices"), F.count_if("f").alias("faces"), F.count("g").alias("groups"), F.count_distinct("g").alias("sources"), F.min("corners").alias("least_corners"), F.max("corners").alias("most_corners"), *[f(F.get("v", i)).alias(f"{n}_{c}") for i, c in enumerate("xyz") for n, f in (("min", F.min), ("max", F.max))])


def raw_points(spark: SparkSession, path: str) -> DataFrame:
    """Little-endian doubles x, y, z, one after the other, with Spark's fixed-length record reader."""
    rdd = spark.sparkContext.binaryRecords(path, 24)
    return rdd.map(lambda b: struct.unpack("<3d", bytes(b))).toDF("x double, y double, z double")


def origin_of(path: str) -> tuple[tuple[float, float, float], str | None]:
    """Origin and CRS of a metadata.xml."""
    import xml.etree.ElementTree as E

    root = E.parse(path).getroot()
    text = (root.findtext("SRSOrigin") or "").replace(",", " ").split()
    if len(text) != 3:
        raise ValueError(f"{path}: no origin of three numbers")
    return tuple(map(float, text)), root.findtext("SRS")  # type: ignore[return-value]


def projection_roi(value: dict[str, Any]) -> dict[str, Any]:
    """A checked view polygon: origin of 3 finite numbers, at least 3 corners, a simple ring with an area, buffer >= 0."""
    view = value.get("projection", value)
    origin = [float(v) for v in view.get("origin_xyz", view.get("origin", ()))]
    ring = [tuple(map(float, p)) for p in value["polygon_uv"]]
    ring = ring[:-1] if len(ring) > 1 and ring[0] == ring[-1] else ring
    buffer = float(value.get("boundary_buffer_m", value.get("buffer", 0.0)))
    angles = float(view.get("azimuth_deg", 0.0)), float(view.get("elevation_deg", 0.0))
    if len(origin) != 3 or len(ring) < 3 or any(len(p) != 2 for p in ring) or not all(map(math.isfinite, [*origin, buffer, *angles, *(c for p in ring for c in p)])) or buffer < 0:
        raise ValueError("the view polygon needs an origin of 3 numbers, at least 3 corners and a buffer of at least 0")
    turn = lambda o, a, b: (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
    n = len(ring)
    for i in range(n):
        for j in range(i + 2, n - (i == 0)):
            a, b, c, d = ring[i], ring[i + 1], ring[j], ring[(j + 1) % n]
            if turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0:
                raise ValueError("the view polygon cuts itself")
    if abs(sum(ring[i][0] * ring[(i + 1) % n][1] - ring[(i + 1) % n][0] * ring[i][1] for i in range(n))) < 1e-12:
        raise ValueError("the view polygon has no area")
    return {"origin": tuple(origin), "azimuth_deg": angles[0], "elevation_deg": angles[1], "ring": ring, "buffer": buffer}

"""LAS point files as a Spark data source: read in byte ranges with box filters pushed down, written one file per task.

Uncompressed LAS 1.2 to 1.4, point formats 0 to 3 and 6 to 8. Compressed files (LAZ, COPC) are recognised by their header
and refused with a clear message, as no decompressor is assumed.
"""

from __future__ import annotations

import glob
import os
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "x double, y double, z double, intensity int, classification int, point_source_id int, red int, green int, blue int"
# Record lengths and whether colours stand in a record, by point format.
LENGTHS = {0: 20, 1: 28, 2: 26, 3: 34, 6: 30, 7: 36, 8: 38}
COLOUR_AT = {2: 20, 3: 28, 7: 30, 8: 30}


@dataclass(frozen=True)
class Header:
    path: str
    version: tuple[int, int]
    point_format: int
    record_length: int
    count: int
    data_at: int
    scale: tuple[float, float, float]
    offset: tuple[float, float, float]
    low: tuple[float, float, float]
    high: tuple[float, float, float]
    compressed: bool
    copc: bool
    crs: str | None

    @property
    def dimensions(self) -> list[str]:
        names = ["x", "y", "z", "intensity", "classification", "point_source_id"]
        return names + ["red", "green", "blue"] * (self.point_format in COLOUR_AT)

    def metadata(self) -> dict[str, Any]:
        return {"path": self.path, "total_points": self.count, "point_format": self.point_format, "dimensions": self.dimensions, "has_rgb": self.point_format in COLOUR_AT, "scale": list(self.scale), "offset": list(self.offset), "bounds": {"min": list(self.low), "max": list(self.high)}, "crs": self.crs}


def read_header(path: str) -> Header:
    with open(path, "rb") as f:
        h = f.read(375)
        if h[:4] != b"LASF" or len(h) < 227:
            raise ValueError(f"{path}: not a LAS file")
        version = h[24], h[25]
        size, data_at, n_vlr = struct.unpack_from("<HII", h, 94)
        kind, length = h[104], struct.unpack_from("<H", h, 105)[0]
        count = struct.unpack_from("<Q", h, 247)[0] if version >= (1, 4) else 0
        count = count or struct.unpack_from("<I", h, 107)[0]
        scale, offset = struct.unpack_from("<3d", h, 131), struct.unpack_from("<3d", h, 155)
        b = struct.unpack_from("<6d", h, 179)
        crs, copc = None, False
        f.seek(size)
        for _ in range(n_vlr):
            v = f.read(54)
            if len(v) < 54:
                break
            user, rid, n = v[2:18].rstrip(b"\0"), *struct.unpack_from("<HH", v, 18)
            body = f.read(n)
            copc |= user == b"copc" and rid == 1
            if user == b"LASF_Projection" and rid == 2112:
                crs = body.rstrip(b"\0").decode("utf-8", "replace")
    return Header(path, version, kind & 0x3F, length, count, data_at, scale, offset, (b[1], b[3], b[5]), (b[0], b[2], b[4]), bool(kind & 0x80), copc, crs)


def is_copc(path: str) -> bool:
    """By the file's own records, whatever its name."""
    try:
        return read_header(path).copc
    except (ValueError, OSError):
        return False


def _dtype(h: Header) -> np.dtype:
    wide = h.point_format >= 6
    fields = {"X": ("<i4", 0), "Y": ("<i4", 4), "Z": ("<i4", 8), "intensity": ("<u2", 12), "classification": ("u1", 16 if wide else 15), "point_source_id": ("<u2", 20 if wide else 18)}
    if h.point_format in COLOUR_AT:
        at = COLOUR_AT[h.point_format]
        fields |= {"red": ("<u2", at), "green": ("<u2", at + 2), "blue": ("<u2", at + 4)}
    return np.dtype({"names": list(fields), "formats": [f for f, _ in fields.values()], "offsets": [o for _, o in fields.values()], "itemsize": h.record_length})


@dataclass
class _Range(InputPartition):
    header: Header
    first: int
    count: int


class LasReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options, self.box = options, {}

    def pushFilters(self, filters: list) -> Iterator:
        """Bounds on x, y, z skip whole files by their header and rows before they leave the reader; Spark checks again."""
        for f in filters:
            if isinstance(f, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and len(f.attribute) == 1 and f.attribute[0] in ("x", "y", "z"):
                k = f.attribute[0], isinstance(f, (GreaterThan, GreaterThanOrEqual))
                old = self.box.get(k)
                self.box[k] = f.value if old is None else max(old, f.value) if k[1] else min(old, f.value)
            yield f

    def partitions(self) -> list[_Range]:
        path = self.options["path"]
        files = sorted(glob.glob(os.path.join(path, "*.las"))) if os.path.isdir(path) else sorted(glob.glob(path)) or [path]
        per, out = int(self.options.get("recordsPerPartition", 1_000_000)), []
        for p in files:
            h = read_header(p)
            if h.compressed or h.copc or h.point_format not in LENGTHS:
                raise ValueError(f"{p}: compressed or unsupported point data (format {h.point_format}); convert it to LAS first")
            if any((v > h.high["xyz".index(a)] if lower else v < h.low["xyz".index(a)]) for (a, lower), v in self.box.items()):
                continue
            out += [_Range(h, at, min(per, h.count - at)) for at in range(0, h.count, per)]
        return out

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        h = part.header
        kind = _dtype(h)
        with open(h.path, "rb") as f:
            for at in range(part.first, part.first + part.count, 100_000):
                n = min(100_000, part.first + part.count - at)
                f.seek(h.data_at + at * h.record_length)
                r = np.frombuffer(f.read(n * h.record_length), kind)
                if len(r) < n:
                    raise ValueError(f"{h.path}: ends before its {h.count} records")
                xyz = [r[c].astype(float) * h.scale[i] + h.offset[i] for i, c in enumerate("XYZ")]
                keep = np.ones(n, bool)
                for (a, lower), v in self.box.items():
                    keep &= xyz["xyz".index(a)] >= v if lower else xyz["xyz".index(a)] <= v
                cols = [pa.array(c[keep]) for c in xyz]
                cols += [pa.array(r[c][keep].astype(np.int32)) if c in kind.names else pa.nulls(int(keep.sum()), pa.int32()) for c in ("intensity", "classification", "point_source_id", "red", "green", "blue")]
                yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in SCHEMA.split(", ")])


def pack_header(count: int, scale: tuple, offset: tuple, low: tuple, high: tuple, point_format: int = 2, crs: str | None = None) -> bytes:
    """A LAS 1.4 header (375 bytes) and, with a CRS, its record."""
    vlr = b""
    if crs:
        body = crs.encode() + b"\0"
        vlr = struct.pack("<H16sHH32s", 0, b"LASF_Projection", 2112, len(body), b"WKT") + body
    h = bytearray(375)
    h[:4] = b"LASF"
    struct.pack_into("<H", h, 6, 16 if crs else 0)
    h[24:26] = bytes((1, 4))
    struct.pack_into("<32s32s", h, 26, b"facetry", b"facetry")
    struct.pack_into("<HIIBH", h, 94, 375, 375 + len(vlr), int(bool(crs)), point_format, LENGTHS[point_format])
    struct.pack_into("<I", h, 107, count if count < 1 << 32 and point_format < 6 else 0)
    struct.pack_into("<12d", h, 131, *scale, *offset, high[0], low[0], high[1], low[1], high[2], low[2])
    struct.pack_into("<Q", h, 247, count)
    return bytes(h) + vlr


@dataclass
class _Written(WriterCommitMessage):
    path: str | None
    count: int


class LasWriter(DataSourceWriter):
    """Each task writes a part file, renamed once it is whole; a file of a failed job is removed."""

    def __init__(self, options: dict[str, str], schema: StructType, overwrite: bool):
        self.options, self.names, self.job = options, schema.names, uuid.uuid4().hex[:12]
        self.scale = tuple([float(options.get("scale", 0.001))] * 3)
        self.kind = int(options.get("pointFormat", 2))
        path = options["path"]
        os.makedirs(path, exist_ok=True)
        self.old = glob.glob(os.path.join(path, "*.las")) if overwrite else []

    def write(self, rows: Iterator) -> _Written:
        cols: dict[str, list] = {n: [] for n in self.names}
        for r in rows:
            for n, v in zip(self.names, r):
                cols[n].append(v)
        n = len(cols["x"])
        if not n:
            return _Written(None, 0)
        xyz = [np.array(cols[c], float) for c in "xyz"]
        offset = tuple(float(np.floor(c.min())) for c in xyz)
        h = Header("", (1, 4), self.kind, LENGTHS[self.kind], n, 0, self.scale, offset, (0,) * 3, (0,) * 3, False, False, None)
        out = np.zeros(n, _dtype(h))
        for i, c in enumerate("XYZ"):
            raw = np.floor(np.abs((xyz[i] - offset[i]) / self.scale[i]) + 0.5)
            if not (raw <= 2**31 - 1).all():
                raise ValueError("coordinates do not fit 32 bits at this scale")
            out[c] = raw
        for c, top in (("intensity", 65535), ("classification", 255), ("point_source_id", 65535), ("red", 65535), ("green", 65535), ("blue", 65535)):
            if c in cols and c in out.dtype.names:
                v = np.array([x or 0 for x in cols[c]], np.int64)
                if ((v < 0) | (v > top)).any():
                    raise ValueError(f"{c} does not fit its field")
                out[c] = v
        low, high = (tuple(float(f(out[c].astype(float) * self.scale[i] + offset[i])) for i, c in enumerate("XYZ")) for f in (np.min, np.max))
        path = os.path.join(self.options["path"], f"part-{self.job}-{uuid.uuid4().hex[:12]}.las")
        with open(path + ".tmp", "wb") as f:
            f.write(pack_header(n, self.scale, offset, low, high, self.kind, self.options.get("crs")))
            f.write(out.tobytes())
        return _Written(path, n)

    def commit(self, messages: list[_Written | None]) -> None:
        for p in self.old:
            os.remove(p)
        for m in messages:
            if m and m.path:
                os.replace(m.path + ".tmp", m.path)

    def abort(self, messages: list[_Written | None]) -> None:
        for p in glob.glob(os.path.join(self.options["path"], f"part-{self.job}-*.tmp")):
            os.remove(p)


class LasSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "las"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> LasReader:
        return LasReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> LasWriter:
        return LasWriter(self.options, schema, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LasSource)


def read_las(spark: SparkSession, path: str, **options: Any) -> DataFrame:
    register(spark)
    return spark.read.format("las").options(**options).load(path)


def write_las(points: DataFrame, path: str, *, verify: bool = True, **options: Any) -> dict[str, float]:
    """Write and read back: the count has to be equal and no coordinate may be off by more than half a step."""
    from pyspark.sql import functions as F

    register(points.sparkSession)
    points.write.format("las").mode("overwrite").options(**options).save(path)
    if not verify:
        return {}
    a, b = (d.agg(F.count("x").alias("n"), *[f(c).alias(f"{k}_{c}") for c in "xyz" for k, f in (("min", F.min), ("max", F.max), ("sum", F.sum))]).first() for d in (points, read_las(points.sparkSession, path)))
    scale = float(options.get("scale", 0.001))
    worst = max([abs(a[k] - b[k]) for k in a.asDict() if k[:3] in ("min", "max")], default=0.0) if a.n else 0.0
    if a.n != b.n or worst > scale / 2 + 1e-6:
        raise ValueError(f"read back {b.n} of {a.n} points, off by {worst}")
    return {"points": a.n, "max_abs_error_m": worst}

"""Work that goes on in steps: crops over files as they arrive, and tiles whose state outlives a run."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import asdict
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetry.operators import points as P
from facetry.operators.tiling import Grid
from facetry.schemas import TILE_STATE
from facetry.sources.files import read_json, write_json


def stream_crop(spark: SparkSession, source: str, target: str, checkpoint: str, roi: Mapping[str, Any], *, schema: str = "x double, y double, z double", form: str = "parquet") -> DataFrame:
    """Crop every file of a folder that has not been cropped yet, then stop; what is kept is exactly once in `target`."""
    rows = spark.readStream.schema(schema).format(form).load(source)
    kept = P.crop_projected(rows, origin=roi["origin"], azimuth_deg=roi["azimuth_deg"], elevation_deg=roi["elevation_deg"], ring=list(roi["ring"]), buffer=roi["buffer"])
    kept.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target).awaitTermination()
    return spark.read.schema(schema).parquet(target)


def crop_report(source: DataFrame, kept: DataFrame) -> DataFrame:
    """One row: points before and after, the share kept, bounds of what is left."""
    n = source.agg(F.count(F.lit(1)).alias("input_points"))
    k = kept.agg(F.count(F.lit(1)).alias("kept_points"), *[f(c).alias(f"{a}_{c}") for c in "xyz" for a, f in (("min", F.min), ("max", F.max))])
    return n.join(k).withColumn("kept_fraction", F.when(F.col("input_points") > 0, F.col("kept_points") / F.col("input_points")))


class TileState:
    """Which tiles are done. A run goes on where the last one stopped, but only with the same grid and version.

    The state is one small JSON file, replaced whole after each tile; a failed tile is tried again on the next run.
    """

    def __init__(self, path: str, grid: Grid, version: str, *, resume: bool = False):
        self.path, self.plan, self.version = path, asdict(grid), version
        self.tiles: dict[str, dict[str, Any]] = {}
        if os.path.exists(path):
            if not resume:
                raise ValueError(f"{path} exists; resume it or choose another folder")
            old = read_json(path)
            if old.get("version") != version:
                raise ValueError(f"{path} was written by version {old.get('version')}, not {version}")
            if old.get("plan") is not None and old["plan"] != self.plan:
                raise ValueError(f"{path} belongs to another grid")
            self.tiles = old.get("tiles", {})

    def save(self) -> None:
        write_json(self.path, {"version": self.version, "plan": self.plan, "tiles": self.tiles})

    def done(self, tile: str, report: str, core_points: int) -> None:
        self.tiles[tile] = {"status": "done", "report": report, "candidate_red_points": core_points, "error": None}
        self.save()

    def failed(self, tile: str, error: str) -> None:
        self.tiles[tile] = {"status": "error", "report": None, "candidate_red_points": None, "error": error}
        self.save()

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(t, s["status"], s.get("report"), s.get("candidate_red_points"), s.get("error")) for t, s in self.tiles.items()]
        return spark.createDataFrame(rows, TILE_STATE)

    def pending(self, tiles: DataFrame) -> DataFrame:
        """The tiles that are not done."""
        return tiles.join(self.table(tiles.sparkSession).where("status = 'done'"), "tile_id", "left_anti")


def run_tiles(state: TileState, tiles: list[str], work: Callable[[str], tuple[str, int]]) -> int:
    """Work on the tiles that are not done; one that fails is marked and the rest goes on. Returns how many failed."""
    failed = 0
    for t in tiles:
        if state.tiles.get(t, {}).get("status") == "done":
            continue
        try:
            report, n = work(t)
        except Exception as e:  # noqa: BLE001  the state keeps the reason
            state.failed(t, f"{type(e).__name__}: {e}")
            failed += 1
        else:
            state.done(t, report, n)
    return failed


def invalid_tiles(folder: str) -> list[str]:
    """Tile files that cannot be read or hold no points."""
    from facetry.sources.las import read_header

    bad = []
    for name in sorted(os.listdir(folder)):
        if name.endswith((".las", ".laz")) and os.path.isfile(os.path.join(folder, name)):
            path = os.path.join(folder, name)
            try:
                ok = read_header(path).count > 0
            except (ValueError, OSError):
                ok = False
            if not ok:
                bad.append(path)
    return bad


def quarantine(paths: list[str]) -> list[str]:
    out = []
    for p in paths:
        os.replace(p, q := p + ".invalid")
        out.append(q)
    return out

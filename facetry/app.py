"""Commands: whole (the default), roi, validate, roi-compare, crop-roi, sample-mesh."""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetry import schemas
from facetry.config import config_bbox, dump, load, parse_bbox
from facetry.operators import points as P, tiling
from facetry.plans import analysis
from facetry.sources import files
from facetry.sources.las import read_header, read_las, write_las

DEFAULT = "whole"
COMMANDS = (DEFAULT, "roi", "validate", "roi-compare", "crop-roi", "sample-mesh")


def session() -> SparkSession:
    return SparkSession.builder.appName("facetry").config("spark.sql.adaptive.enabled", "true").getOrCreate()


def chosen(argv: Sequence[str]) -> tuple[str, list[str]]:
    """The command, which is the first argument or the value of --mode, and the rest. A longer name that begins with "whole" is that command."""
    modes = argparse.ArgumentParser(add_help=False, allow_abbrev=False)
    modes.add_argument("--mode", default=DEFAULT)
    named = bool(argv) and (argv[0] in COMMANDS or argv[0].startswith(DEFAULT + "-"))
    given, rest = modes.parse_known_args(["--mode", *argv] if named else list(argv))
    return DEFAULT if given.mode.startswith(DEFAULT) else given.mode, rest


def load_points(spark: SparkSession, path: str) -> DataFrame:
    return read_las(spark, path) if path.endswith(".las") or os.path.isdir(path) and any(n.endswith(".las") for n in os.listdir(path)) else spark.read.parquet(path)


def _parser(command: str) -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog=f"facetry {command}")
    if command == "validate":
        p.add_argument("folder")
        return p
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--config")
    if command == DEFAULT:
        p.add_argument("--tile-size", type=float)
        p.add_argument("--overlap", type=float)
        for flag in ("--resume", "--prepare-only", "--keep-source-tiles", "--plan-only"):
            p.add_argument(flag, action="store_true")
        p.add_argument("--max-tiles", type=int)
        p.add_argument("--workers", type=int)
        p.add_argument("--pdal")
    elif command == "roi":
        p.add_argument("--bbox")
        p.add_argument("--force", action="store_true")
    elif command == "roi-compare":
        p.add_argument("--force", action="store_true")
        p.add_argument("--summarize-existing", action="store_true")
    elif command == "crop-roi":
        p.add_argument("--roi-config", required=True)
        p.add_argument("--report")
        p.add_argument("--chunk-size", type=int, default=1_000_000)
        p.add_argument("--overwrite", action="store_true")
        p.add_argument("--quiet", action="store_true")
    elif command == "sample-mesh":
        p.add_argument("--density", type=float, default=600.0)
        p.add_argument("--seed", type=int, default=42)
    return p


def write_area(result: analysis.Result, folder: str, cfg: dict[str, Any], bounds_note: dict[str, Any] | None = None) -> None:
    """All tables and reports of one area."""
    os.makedirs(folder, exist_ok=True)
    planes = result.planes.withColumns({f"center_{c}": F.col(f"centroid_{c}") for c in "xyz"}).withColumn("trace_length_m", F.lit(None).cast("double"))
    for name, df, ddl in (
        ("planes", planes, schemas.PLANE), ("plane_instances", result.instances, schemas.PLANE), ("joint_sets", result.joint_sets, schemas.JOINT_SET), ("spacings", result.spacings, schemas.SPACING),
        ("detachment_planes", planes, schemas.DETACHMENT), ("rejected", result.rejected, schemas.REJECTED),
        ("traces", planes.select("plane_id", F.lit(False).alias("available"), F.lit(False).alias("trace_verified"), F.lit("trace_module_unavailable").alias("reason")), schemas.TRACE),
        ("apertures", planes.select("plane_id", F.lit(False).alias("available"), F.lit("aperture_source_unavailable").alias("reason")), schemas.APERTURE),
    ):
        files.write_table(df, os.path.join(folder, name + ".csv"), ddl, one_file=True)
    result.members.write.mode("overwrite").parquet(os.path.join(folder, "members.parquet"))
    files.write_geojson(planes, os.path.join(folder, "plane_boundaries.geojson"), ["plane_id", "set_id", "status", "area_m2"])
    index = result.members.select("plane_id").distinct()
    idx = analysis.ranked(index, [F.asc("plane_id")], "r").select("plane_id", (F.col("r") - 1).cast("int").alias("plane_index"))
    files.write_ply(result.members.join(idx, "plane_id").withColumn("label", F.col("plane_index")), os.path.join(folder, "segmented.ply"))
    files.write_json(os.path.join(folder, "report.json"), {"version": analysis.VERSION, "counts": result.counts, "input": bounds_note})
    dump(cfg, os.path.join(folder, "config.yaml"))


def run_roi(a: argparse.Namespace) -> int:
    cfg = load(a.config)
    box = parse_bbox(a.bbox) or config_bbox(cfg)
    if box is None:
        raise SystemExit("a bounding box is needed: --bbox or roi in the config")
    if os.path.exists(a.output) and os.listdir(a.output) and not a.force:
        raise SystemExit(f"{a.output} exists; use --force")
    spark = session()
    pts = P.scan(load_points(spark, a.input), box)
    if pts.isEmpty():
        raise SystemExit("no points in the box")
    write_area(analysis.analyse_area(pts, cfg), a.output, cfg, {"path": a.input, "bbox": box})
    return 0


def run_whole(a: argparse.Namespace) -> int:
    cfg = load(a.config)
    size = a.tile_size or cfg["tiling"]["tile_size"]
    over = cfg["tiling"]["overlap"] if a.overlap is None else a.overlap
    if a.plan_only and a.input.endswith(".las"):
        h = read_header(a.input)
        print(json.dumps(vars(tiling.grid_plan(h.low[0], h.high[0], h.low[1], h.high[1], size, over)), indent=2))
        return 0
    spark = session()
    pts = load_points(spark, a.input)
    g = tiling.plan_for(pts, size, over)
    if a.plan_only:
        print(json.dumps(vars(g), indent=2))
        return 0
    if os.path.exists(a.output) and os.listdir(a.output) and not a.resume:
        raise SystemExit(f"{a.output} exists; use --resume")
    os.makedirs(a.output, exist_ok=True)
    from facetry.streaming.tiles import TileState

    state = TileState(os.path.join(a.output, "processing_state.json"), g, analysis.VERSION, resume=a.resume)
    if a.prepare_only:
        tiling.write_tiles(pts, g, os.path.join(a.output, "tiles"))
        files.write_json(os.path.join(a.output, "report.json"), {"version": analysis.VERSION, "plan": vars(g), "status": "prepared", "points": pts.count()})
        return 0
    todo = state.pending(tiling.tiles(spark, g)).orderBy("tile_id")
    todo = todo.limit(a.max_tiles) if a.max_tiles else todo
    halo = tiling.halo(pts.where(P.finite()), g).join(todo.select("tile_id"), "tile_id", "left_semi")
    rows_path, failed = os.path.join(a.output, "tile_planes.parquet"), 0
    try:
        rows, _ = analysis.analyse_tiles(pts, cfg, tile_size=size, overlap=over, only=todo.select("tile_id"))
        rows.write.mode("append").parquet(rows_path)
        for r in halo.where("core").groupBy("tile_id").agg(F.count(F.lit(1)).alias("n")).toLocalIterator():
            state.tiles[r.tile_id] = {"status": "done", "report": rows_path, "candidate_red_points": r.n, "error": None}
    except Exception as e:  # noqa: BLE001  kept with the state, tried again on resume
        for r in todo.select("tile_id").toLocalIterator():
            state.tiles[r.tile_id] = {"status": "error", "report": None, "candidate_red_points": None, "error": f"{type(e).__name__}: {e}"}
            failed += 1
    state.save()
    if os.path.exists(rows_path):
        out = analysis.aggregate_global(spark.read.parquet(rows_path), cfg, tile_size=size, overlap=over)
        files.write_table(out["planes"].withColumns({f"centroid_{c}": F.col(f"center_{c}") for c in "xyz"}), os.path.join(a.output, "joint_planes.csv"), schemas.GLOBAL_PLANE, one_file=True)
        shown = out["instances"]
        if cfg.get("export", {}).get("selected_only", True):
            shown = shown.join(out["planes"].select("global_plane_id"), "global_plane_id", "left_semi")
        files.write_table(shown, os.path.join(a.output, "plane_instances.csv"), schemas.TILE_PLANE, one_file=True)
        files.write_table(out["joint_sets"], os.path.join(a.output, "joint_sets.csv"), schemas.JOINT_SET, one_file=True)
        gaps = out["spacings"].withColumns({"global_plane_id_a": F.col("plane_id_a"), "global_plane_id_b": F.col("plane_id_b"), "tile_id": F.lit("merged")})
        files.write_table(gaps, os.path.join(a.output, "spacings.csv"), schemas.SPACING_GLOBAL, one_file=True)
        hist = {r.reason: r.pairs for r in out["rejections"].collect()}
        files.write_json(os.path.join(a.output, "report.json"), {"version": analysis.VERSION, "plan": vars(g), "tiles": len(state.tiles), "failed_tiles": failed, "global_planes": out["planes"].count(), "merge_reasons": hist})
    return 2 if failed else 0


def run_validate(a: argparse.Namespace) -> int:
    """Checks of an output folder; the kind of run is told by its files."""
    spark, bad = session(), []
    whole = os.path.exists(os.path.join(a.folder, "processing_state.json"))
    report = files.read_json(os.path.join(a.folder, "report.json"))
    if whole:
        planes = files.read_table(spark, os.path.join(a.folder, "joint_planes.csv"), schemas.GLOBAL_PLANE)
        n, ids = planes.count(), planes.select("global_plane_id").distinct().count()
        checks = {"planes_match_report": (report.get("global_planes", n), n), "ids_unique": (n, ids), "no_failed_tiles": (0, report.get("failed_tiles", 0))}
    else:
        planes = files.read_table(spark, os.path.join(a.folder, "planes.csv"), schemas.PLANE)
        n = planes.count()
        checks = {"planes_match_report": (report["counts"]["accepted_planes"], n), "ids_unique": (n, planes.select("plane_id").distinct().count()), "finite": (0, planes.where("nx is null or plane_d is null").count())}
        for name, ddl in (("traces", schemas.TRACE), ("apertures", schemas.APERTURE)):
            checks[f"{name}_cover_planes"] = (n, files.read_table(spark, os.path.join(a.folder, name + ".csv"), ddl).count())
        checks["ply_is_whole"] = (1, int(files.ply_is_whole(os.path.join(a.folder, "segmented.ply"))))
    for k, (want, got) in checks.items():
        print(f"{'ok ' if want == got else 'BAD'} {k}: expected {want}, found {got}")
        bad += [k] * (want != got)
    print("PASS" if not bad else "FAIL")
    return int(bool(bad))


VARIANTS = {"baseline": {"normal": {"multiscale": False}, "plane_merge": {"hierarchical": {"enabled": False}}}, "multiscale": {"normal": {"multiscale": True}, "plane_merge": {"hierarchical": {"enabled": False}}}, "multiscale_hmerge": {"normal": {"multiscale": True}, "plane_merge": {"hierarchical": {"enabled": True}}}}


def run_compare(a: argparse.Namespace) -> int:
    """Each box of the config under each variant; one summary row per run, quantiles by nearest rank."""
    from facetry.config import merged
    from facetry.operators.order import nearest_rank

    cfg, spark, rows = load(a.config), session(), []
    for roi, box in cfg.get("rois", {}).items():
        for name, change in VARIANTS.items():
            folder = os.path.join(a.output, roi, name)
            if not a.summarize_existing:
                if os.path.exists(folder) and not a.force:
                    raise SystemExit(f"{folder} exists; use --force")
                write_area(analysis.analyse_area(P.scan(load_points(spark, a.input), parse_bbox(box)), merged(cfg, change)), folder, merged(cfg, change), {"roi": roi})
            p = files.read_table(spark, os.path.join(folder, "planes.csv"), schemas.PLANE)
            q = lambda c, v, p=p: nearest_rank(p, c, v).first()
            rows.append({"roi": roi, "variant": name, "planes": p.count(), **{f"{c}_{k}": (r[0] if (r := q(c, v)) else None) for c in ("area_m2", "rms_m", "confidence") for k, v in (("median", 0.5), ("p90", 0.9))}})
    files.write_json(os.path.join(a.output, "comparison.json"), rows)
    return 0


def run_crop(a: argparse.Namespace) -> int:
    if os.path.abspath(a.input) == os.path.abspath(a.output):
        raise SystemExit("the output must not be the input")
    if os.path.exists(a.output) and not a.overwrite:
        raise SystemExit(f"{a.output} exists; use --overwrite")
    from facetry.streaming.tiles import crop_report

    spark, roi = session(), files.projection_roi(files.read_json(a.roi_config))
    pts = load_points(spark, a.input)
    kept = P.crop_projected(pts, **roi)
    write_las(kept, a.output) if a.input.endswith(".las") else kept.write.mode("overwrite").parquet(a.output)
    report = crop_report(pts, kept).first().asDict()
    if a.report:
        files.write_json(a.report, report)
    if not a.quiet:
        print(json.dumps(report))
    return 0


def run_mesh(a: argparse.Namespace) -> int:
    """Points on a table of triangles (ax..cz), written and read back."""
    spark = session()
    out = P.triangle_samples(load_points(spark, a.input), a.density, seed=a.seed)
    path = a.output + ".staging"
    out.write.mode("overwrite").parquet(path)
    print(json.dumps(write_las(spark.read.parquet(path), a.output)))
    return 0


def main(argv: Sequence[str] | None = None) -> int:
    argv = list(sys.argv[1:] if argv is None else argv)
    if argv and argv[0] in ("-h", "--help"):
        print(__doc__)
        return 0
    command, rest = chosen(argv)
    if command not in COMMANDS:
        raise SystemExit(f"unknown command {command}; one of {', '.join(COMMANDS)}")
    run = {DEFAULT: run_whole, "roi": run_roi, "validate": run_validate, "roi-compare": run_compare, "crop-roi": run_crop, "sample-mesh": run_mesh}[command]
    return run(_parser(command).parse_args(rest))


if __name__ == "__main__":
    sys.exit(main())

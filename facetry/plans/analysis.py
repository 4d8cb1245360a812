"""From points to planes, families and spacings: one area at once, or tile by tile with planes merged across tiles."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetry.config import load
from facetry.functions import shapes
from facetry.functions.scores import confidence, fit_rejection, grade
from facetry.operators import clusters, grouped, points as P, sets, tiling
from facetry.operators.graph import _ensure_checkpoint_dir, connected_components
from facetry.operators.order import global_ids, numbered, numbered_sets, ranked

VERSION = "facetry-1"


@dataclass
class Result:
    """What an analysis yields; every member is a DataFrame."""

    planes: DataFrame
    instances: DataFrame
    rejected: DataFrame
    members: DataFrame
    joint_sets: DataFrame
    spacings: DataFrame
    counts: dict[str, int] = field(default_factory=dict)


def _features(pts: DataFrame, cfg: Mapping[str, Any]) -> DataFrame:
    n = cfg["normal"]
    if n["multiscale"]:
        return P.multiscale_features(pts, n["radii"], min_neighbors=n["min_neighbors"], knn_cap=max(3, n["max_neighbors"], n["knn"], 2 * n["min_neighbors"]), stable_angle_deg=n["stable_angle_deg"], min_valid_scales=n["min_valid_scales"], by="tile_id")
    return P.local_features(pts, n["radius"], min_neighbors=n["min_neighbors"], knn_cap=max(n["knn"], 2 * n["min_neighbors"], n["max_neighbors"]), by="tile_id")


def _segments(cand: DataFrame, cfg: Mapping[str, Any]) -> DataFrame:
    """tile_id, point_id, region of the candidates, by the strategy that the config names."""
    least = cfg["target"]["min_points"]
    if cfg["region_growing"]["method"] == "planarity_seeded":
        return grouped.regions(cand, cfg["region_growing"], least).where("region >= 0").withColumn("region", F.col("region").cast("string"))
    flat = cand.withColumns({c: F.get("normal", i) for i, c in enumerate(("nx", "ny", "nz"))})
    o, s = cfg["orientation_cluster"], cfg["spatial_cluster"]
    axes = clusters.angular_grid_clusters(flat, o["angle_deg"], o["min_samples"]).where("cluster is not null").withColumnRenamed("cluster", "family")
    both = flat.join(axes, "point_id")
    space = clusters.spatial_dbscan(both, s["eps"], s["min_samples"], angle_deg=s["angle_deg"]).where("cluster is not null")
    lab = both.join(space, "point_id").select("tile_id", "point_id", F.concat_ws("/", "family", F.col("cluster").cast("string")).alias("region"))
    full = lab.groupBy("tile_id", "region").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return lab.join(full.select("tile_id", "region"), ["tile_id", "region"], "left_semi")


def _scored(fits: DataFrame, cfg: Mapping[str, Any]) -> DataFrame:
    t, p, q = cfg["target"], cfg["plane"], cfg["quality"]
    score = confidence(*[F.col(c) for c in ("point_count", "area_m2", "planarity", "inlier_ratio", "rms_m", "normal_dispersion_deg", "boundary_completeness")], min_points=t["min_points"], min_area=t["min_area_m2"], max_rms=p["max_rms"], max_dispersion_deg=p["max_dispersion_deg"])
    out = fits.withColumn("confidence", score)
    out = out.withColumns({"quality_score": F.col("confidence"), "quality_grade": grade(F.col("confidence"), q["grade_a"], q["grade_b"], q["grade_c"])})
    why = fit_rejection(min_points=t["min_points"], min_inlier_ratio=t["min_inlier_ratio"], min_area=t["min_area_m2"], min_minor=t["min_minor_extent_m"], max_rms=p["max_rms"], min_confidence=q["min_confidence"])
    return out.withColumns({"reason": why, "trace_length_m": F.lit(None).cast("double"), "data_gap_censored": F.lit(False), "trace_verified": F.lit(False), "aperture_available": F.lit(False), "aperture_reason": F.lit("aperture_source_unavailable")})


def _merged_regions(fits: DataFrame, members: DataFrame, cfg: Mapping[str, Any]) -> DataFrame:
    """tile_id, region -> merged region, for planes of one tile that a joint fit supports. Groups are tiles."""
    m = cfg["plane_merge"]
    pts = members.groupBy("tile_id", "region").agg(F.array_sort(F.collect_list(F.struct("point_id", "x", "y", "z"))).alias("pts"))
    rows = fits.where("reason is null").join(pts, ["tile_id", "region"])

    def body(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("region", key=lambda s: s.str.zfill(12), kind="stable").reset_index(drop=True)
        arr = {i: np.array([[q["x"], q["y"], q["z"]] for q in v], float) for i, v in enumerate(g["pts"])}
        o = np.vstack(list(arr.values())).mean(0)
        arr = {i: a - o for i, a in arr.items()}
        n = g[["nx", "ny", "nz"]].to_numpy(float)
        d = g["plane_d"].to_numpy(float) + n @ o
        c = g[["centroid_x", "centroid_y", "centroid_z"]].to_numpy(float) - o
        lo, hi = (g[[f"bbox_{f}_{a}" for a in "xyz"]].to_numpy(float) - o for f in ("min", "max"))
        foot = [[(np.array([list(q) for q in ring], float) - o).tolist() for ring in (v if v is not None else [])] for v in g["footprint"]]

        def accepted(k: dict, idx: list[list[int]]) -> list[tuple[int, int]]:
            out = []
            for a in range(len(idx)):
                for b in range(a + 1, len(idx)):
                    i, j = idx[a][0], idx[b][0]
                    dot = float(n[i] @ n[j])
                    s = 1.0 if dot >= 0 else -1.0
                    if np.degrees(np.arccos(min(abs(dot), 1.0))) > k["angle_deg"] or abs(d[i] - s * d[j]) > k["offset_m"]:
                        continue
                    if abs(n[i] @ c[j] + d[i]) > k["offset_m"] or abs(n[j] @ c[i] + d[j]) > k["offset_m"]:
                        continue
                    gap = shapes.footprint_gap(foot[i], foot[j], (c[i] + c[j]) / 2, n[i])
                    if gap is None:
                        gap = float(np.linalg.norm(np.maximum(0, np.maximum(lo[i], lo[j]) - np.minimum(hi[i], hi[j]))))
                    if gap <= k["gap_m"]:
                        out.append((a, b))
            return out

        groups = [[i] for i in range(len(g))]
        groups = grouped.merge_within(g, arr, m, accepted(m, groups))
        h = m["hierarchical"]
        if h["enabled"] and len(groups) > 1:
            fitted = [shapes.fit_tls(np.vstack([arr[i] for i in x])) for x in groups]
            f = pd.DataFrame([{"nx": a[0], "ny": a[1], "nz": a[2], "rms_m": float(np.sqrt(((np.vstack([arr[i] for i in x]) @ a + b) ** 2).mean()))} for (a, b), x in zip(fitted, groups)])
            again = grouped.merge_within(f, {i: np.vstack([arr[k] for k in x]) for i, x in enumerate(groups)}, h, accepted(h, groups), h["min_merged_rms"])
            groups = [sorted(k for i in x for k in groups[i]) for x in again]
        lead = {i: x[0] for x in groups for i in x}
        return pd.DataFrame({"tile_id": g["tile_id"], "region": g["region"], "merged": [g["region"][lead[i]] for i in range(len(g))]})

    return rows.groupBy("tile_id").applyInPandas(body, "tile_id string, region string, merged string")


def tile_edges(pts: DataFrame) -> DataFrame:
    """tile_id and the extent of its points as edges (x0, x1, y0, y1)."""
    return pts.groupBy("tile_id").agg(F.array(F.min("x"), F.max("x"), F.min("y"), F.max("y")).alias("edges"))


def process(pts: DataFrame, config: Mapping[str, Any] | None = None, *, bounds: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Planes of each tile. pts: tile_id, point_id, x, y, z. Returns instances, merged planes, rejected, members.

    Voxel, outlier and neighbourhood steps are plain joins and aggregates; growing, fitting and merging run per tile.
    bounds: tile_id and edges (x0, x1, y0, y1) of the tiles' sources, where these were more than pts.
    """
    cfg = config or load()
    _ensure_checkpoint_dir(pts.sparkSession)
    bounds = tile_edges(pts) if bounds is None else bounds
    feat = _features(pts.select("tile_id", "point_id", "x", "y", "z"), cfg)
    f = cfg["feature"]
    cand = P.planar_candidates(feat, min_planarity=f["min_planarity"], max_surface_variation=f["max_surface_variation"], min_neighbors=cfg["normal"]["min_neighbors"]).join(pts.select("tile_id", "point_id", "x", "y", "z"), "point_id").checkpoint()
    members = cand.join(_segments(cand, cfg), ["tile_id", "point_id"]).join(bounds, "tile_id").checkpoint()
    stats = members.groupBy("tile_id", "region").agg(F.percentile("normal_stability_deg", 0.9).alias("normal_stability_deg"), F.percentile("normal_scale_m", 0.5).alias("normal_scale_m"), F.avg(F.col("normal_stable").cast("int")).alias("normal_stable_fraction"), F.avg(F.col("normal_valid_scale_count") if "normal_valid_scale_count" in members.columns else F.lit(1)).alias("normal_valid_scale_count"))
    fits = _scored(grouped.fit_regions(members, cfg, by=["tile_id", "region"]), cfg).join(stats, ["tile_id", "region"]).withColumn("normal_stable", F.col("normal_stable_fraction") >= 0.5).checkpoint()
    rejected = fits.where("reason is not null").select("tile_id", F.col("region").alias("raw_set_label"), F.col("candidate_point_count").alias("point_count"), "reason")
    merged = _merged_regions(fits, members, cfg).checkpoint()
    joined = members.join(merged, ["tile_id", "region"]).withColumn("region", F.col("merged")).drop("merged")
    refit = _scored(grouped.fit_regions(joined, cfg, by=["tile_id", "region"]), cfg)
    # a joint plane that the gates refuse falls back to its parts
    bad = refit.where("reason is not null").select("tile_id", F.col("region").alias("merged"))
    back = merged.join(bad, ["tile_id", "merged"], "left_semi")
    good = merged.join(bad, ["tile_id", "merged"], "left_anti")
    final = good.unionByName(back.withColumn("merged", F.col("region"))).checkpoint()
    joined = members.join(final, ["tile_id", "region"]).withColumn("region", F.col("merged")).drop("merged").checkpoint()
    st = joined.groupBy("tile_id", "region").agg(F.percentile("normal_stability_deg", 0.9).alias("normal_stability_deg"), F.percentile("normal_scale_m", 0.5).alias("normal_scale_m"), F.avg(F.col("normal_stable").cast("int")).alias("normal_stable_fraction"), F.avg(F.col("normal_valid_scale_count") if "normal_valid_scale_count" in joined.columns else F.lit(1)).alias("normal_valid_scale_count"))
    planes = _scored(grouped.fit_regions(joined, cfg, by=["tile_id", "region"]), cfg).join(st, ["tile_id", "region"]).withColumn("normal_stable", F.col("normal_stable_fraction") >= 0.5).checkpoint()
    return fits.where("reason is null"), planes.where("fitted"), rejected, joined.select("tile_id", "point_id", "region", "x", "y", "z")


def orientation_sets(planes: DataFrame, cfg: Mapping[str, Any], key: str = "row_id", weight: str = "point_count") -> DataFrame:
    """planes with set_id J1, J2, ...: axial components, cut where they spread too far, numbered by their weight."""
    j = cfg["joint_sets"]
    comp = sets.axial_components(planes, j["angle_deg"], key)
    leaves = grouped.split_families(planes.join(comp, key), j["max_deviation_deg"], key=key)
    named = planes.join(leaves.select(key, F.concat_ws("/", F.col("component").cast("string"), F.col("leaf").cast("string")).alias("_fam")), key)
    return numbered_sets(named, "_fam", weight, key).drop("_fam")


def analyse_area(pts: DataFrame, config: Mapping[str, Any] | None = None) -> Result:
    """One area: all steps, then families, gate and spacings over the planes that the gate selects."""
    cfg = config or load()
    _ensure_checkpoint_dir(pts.sparkSession)
    pre = cfg["preprocess"]
    vox = P.voxel_downsample(pts.where(P.finite()), pre["voxel_size"])
    vox = vox.withColumn("point_id", F.xxhash64("kx", "ky", "kz") if pre["voxel_size"] > 0 else F.xxhash64("x", "y", "z")).checkpoint()
    kept = P.statistical_inliers(vox, pre["outlier_k"], pre["outlier_ratio"], start=max(pre["voxel_size"], 0.01) * 4) if pre.get("remove_outliers", True) else vox
    one = kept.select(F.lit("0_0").alias("tile_id"), "point_id", "x", "y", "z").checkpoint()
    instances, planes, rejected, members = process(one, cfg)
    ided = planes.withColumn("row_id", F.concat_ws("/", "tile_id", "region"))
    named = numbered(orientation_sets(ided, cfg), "set_id", [F.desc("point_count"), F.asc("centroid_x"), F.asc("centroid_y"), F.asc("row_id")])
    gated = sets.gate(named, cfg["detachment"], context="roi").checkpoint()
    chosen = gated.where("status = 'candidate_joint_plane'")
    joint, gaps = sets.joint_sets(chosen, min_planes=cfg["spacing"]["min_planes"], max_deviation_deg=cfg["spacing"]["max_set_deviation_deg"])
    finite = _finite_spacings(chosen, gaps, members, cfg)
    allgaps = gaps.select("set_id", "plane_id_a", "plane_id_b", "spacing_m", "method", "sample_count").unionByName(finite)
    near = sets.nearest_spacing(allgaps)
    gated = gated.join(near, "plane_id", "left")
    counts = {"input_points": pts.count(), "voxel_points": vox.count(), "retained_points": one.count(), "plane_instances": instances.count(), "accepted_planes": planes.count(), "candidate_joint_planes": chosen.count(), "rejected_instances": rejected.count()}
    return Result(gated, instances, rejected, members.join(gated.select("tile_id", "region", "plane_id"), ["tile_id", "region"]), joint, allgaps, counts)


def _finite_spacings(planes: DataFrame, gaps: DataFrame, members: DataFrame, cfg: Mapping[str, Any]) -> DataFrame:
    """Spacing of neighbouring patches between their points: nearest partners from both sides, along the mean axis."""
    most = cfg["spacing"]["max_samples"]
    pts = members.join(planes.select("tile_id", "region", "plane_id", "nx", "ny", "nz"), ["tile_id", "region"]).groupBy("plane_id", "nx", "ny", "nz").agg(F.array_sort(F.collect_list(F.struct("point_id", "x", "y", "z"))).alias("pts"))
    a, b = (pts.select([F.col(c).alias(c + s) for c in pts.columns]) for s in ("_a", "_b"))
    pairs = gaps.select("set_id", "plane_id_a", "plane_id_b").join(a, "plane_id_a").join(b, "plane_id_b")

    def body(batches):
        for g in batches:
            out = []
            for r in g.itertuples():
                na, nb = np.array([r.nx_a, r.ny_a, r.nz_a]), np.array([r.nx_b, r.ny_b, r.nz_b])
                m = na + (nb if na @ nb >= 0 else -nb)
                pa_, pb_ = (np.array([[q["x"], q["y"], q["z"]] for q in v], float) for v in (r.pts_a, r.pts_b))
                s, n = grouped.finite_patch_spacing(pa_, pb_, m / np.linalg.norm(m), most)
                if s is not None:
                    out.append((r.set_id, r.plane_id_a, r.plane_id_b, s, "spacing_3d_nonpersistent", n))
            yield pd.DataFrame(out, columns=["set_id", "plane_id_a", "plane_id_b", "spacing_m", "method", "sample_count"])

    return pairs.mapInPandas(body, "set_id string, plane_id_a string, plane_id_b string, spacing_m double, method string, sample_count long")


def analyse_tiles(pts: DataFrame, config: Mapping[str, Any] | None = None, *, tile_size: float | None = None, overlap: float | None = None, only: DataFrame | None = None) -> tuple[DataFrame, tiling.Grid]:
    """Plane rows of all tiles (or of those in `only`): each tile is worked on with its margin, and only points of its core count for a plane."""
    cfg = config or load()
    _ensure_checkpoint_dir(pts.sparkSession)
    g = tiling.plan_for(pts, tile_size or cfg["tiling"]["tile_size"], cfg["tiling"]["overlap"] if overlap is None else overlap)
    pre = cfg["preprocess"]
    spread = tiling.halo(pts.where(P.finite()).select("x", "y", "z"), g)
    if only is not None:
        spread = spread.join(only.select("tile_id"), "tile_id", "left_semi")
    spread = spread.checkpoint()
    bounds = tile_edges(spread).checkpoint()
    if pre["voxel_size"] > 0:
        v = pre["voxel_size"]
        spread = spread.groupBy("tile_id", "ix", "iy", *[F.floor(F.col(c) / v).alias("k" + c) for c in "xyz"]).agg(*[F.avg(c).alias(c) for c in "xyz"])
    ix, iy = tiling.owner(g)
    # equal points of a tile are one point, so that an id names one row
    spread = spread.dropDuplicates(["tile_id", "x", "y", "z"]).withColumns({"point_id": F.xxhash64("tile_id", "x", "y", "z"), "core": (ix == F.col("ix")) & (iy == F.col("iy"))}).checkpoint()
    if pre.get("remove_outliers", True):
        spread = P.statistical_inliers(spread, pre["outlier_k"], pre["outlier_ratio"], start=max(pre["voxel_size"], 0.01) * 4, by="tile_id").drop("mean_distance").checkpoint()
    _, planes, _, members = process(spread.select("tile_id", "point_id", "x", "y", "z"), cfg, bounds=bounds)
    return _core_rows(planes, members, spread, cfg), g


def _core_rows(planes: DataFrame, members: DataFrame, spread: DataFrame, cfg: Mapping[str, Any]) -> DataFrame:
    core = members.join(spread.where("core").select("tile_id", "point_id"), ["tile_id", "point_id"], "left_semi").groupBy("tile_id", "region").agg(F.count(F.lit(1)).alias("core_red_points"))
    rows = planes.join(core, ["tile_id", "region"]).where("core_red_points > 0")
    return rows.withColumns({"center_x": F.col("centroid_x"), "center_y": F.col("centroid_y"), "center_z": F.col("centroid_z"), "row_id": F.concat_ws("/", "tile_id", "region")})


def aggregate_global(rows: DataFrame, config: Mapping[str, Any] | None = None, *, tile_size: float, overlap: float) -> dict[str, DataFrame]:
    """Planes merged across tiles, gated, with families and spacings of what is selected; and the rejection histogram.

    rows: tile planes with row_id, tile_id and their figures. Pairs come from neighbouring tiles; complete linkage runs
    within each cluster of touching planes.
    """
    cfg = config or load()
    _ensure_checkpoint_dir(rows.sparkSession)
    w = cfg["whole"]
    ix, iy = tiling.tile_indices(F.col("tile_id"))
    rows = ranked(rows.withColumns({"ix": ix, "iy": iy}), [F.asc("tile_id"), F.asc("row_id")], "seq").checkpoint()
    gap = max(w["merge_xy_gap_m"], 2 * overlap)
    pairs = sets.merge_candidates(rows, key="row_id", gap_m=gap, angle_deg=w["merge_angle_deg"], offset_m=w["merge_offset_m"], max_rms=w["merge_max_rms"], cell=max(tile_size / 4, 4 * gap), footprint_gap=_footprint_column() if "footprint" in rows.columns else None, centroids=True).checkpoint()
    ok = pairs.where("reason = 'accepted'").select("row_id_a", "row_id_b", "tile_id_a", "tile_id_b")
    groups = grouped.merge_groups(ok, connected_components(ok, "row_id_a", "row_id_b"), "row_id", ["tile_id_a", "tile_id_b"])
    grouped_rows = rows.join(groups, "row_id", "left").withColumn("_group", F.coalesce("merged_into", "row_id"))
    ided = global_ids(grouped_rows, "_group", "row_id").drop("_group", "merged_into").checkpoint()
    rolled = sets.roll_up(ided, config=cfg)
    if "footprint" in ided.columns:
        rolled = _union_shapes(rolled, ided, cfg)
    rolled = rolled.checkpoint()
    gated = sets.global_gate(rolled, cfg).checkpoint()
    chosen = gated.where("status = 'candidate_joint_plane'")
    named = orientation_sets(chosen.withColumn("row_id", F.col("global_plane_id")).drop("set_id"), cfg, weight="core_red_points").withColumnRenamed("set_id", "global_set_id").checkpoint()
    joint, gaps = sets.joint_sets(named, group="global_set_id", key="global_plane_id", weight=F.greatest(F.lit(1.0), F.col("core_red_points").cast("double")), centre=("center_x", "center_y", "center_z"), min_planes=cfg["joint_sets"]["min_planes"], max_deviation_deg=None, method="spacing_virtual_scanline_merged_tiles")
    near = sets.nearest_spacing(gaps).withColumnRenamed("plane_id", "global_plane_id")
    return {"instances": ided, "planes": named.join(near, "global_plane_id", "left"), "gated": gated, "joint_sets": joint, "spacings": gaps, "rejections": sets.rejection_histogram(pairs)}


def _union_shapes(rolled: DataFrame, members: DataFrame, cfg: Mapping[str, Any]) -> DataFrame:
    """Area, extents and completeness of the union of the members' footprints, and the score that follows from them."""
    names = ["observed_area_m2", "major_extent_m", "minor_extent_m", "boundary_completeness"]

    def body(k: tuple, g: pd.DataFrame) -> pd.DataFrame:
        n, c = g[["gnx", "gny", "gnz"]].to_numpy(float)[0], g[["gx", "gy", "gz"]].to_numpy(float)[0]
        rings = [shapes.to_uv(np.array([list(q) for q in r], float), c, n) for v in g["footprint"] if v is not None for r in v if len(r) >= 3]
        if not rings:
            return pd.DataFrame(columns=["global_plane_id", *names])
        total, h = shapes.union_area(rings), shapes.hull(np.vstack(rings))
        major, minor = shapes.smallest_rectangle(h)
        whole = abs(shapes.area(h))
        return pd.DataFrame([(k[0], total, major, minor, min(1.0, total / whole) if whole > 1e-12 else 0.0)], columns=["global_plane_id", *names])

    of = rolled.select("global_plane_id", *[F.col(c).alias("g" + c) for c in ("nx", "ny", "nz")], *[F.col(f"center_{c}").alias("g" + c) for c in "xyz"])
    got = members.select("global_plane_id", "footprint").join(of, "global_plane_id").groupBy("global_plane_id").applyInPandas(body, "global_plane_id string, " + ", ".join(f"{c} double" for c in names))
    joined = rolled.join(got.withColumnsRenamed({c: "_u_" + c for c in names}), "global_plane_id", "left")
    out = joined.withColumns({c: F.coalesce("_u_" + c, c) for c in names}).drop(*["_u_" + c for c in names])
    t, p = cfg["target"], cfg["plane"]
    score = confidence(*[F.col(c) for c in ("point_count", "observed_area_m2", "planarity", "inlier_ratio", "rms_m", "normal_dispersion_deg", "boundary_completeness")], min_points=t["min_points"], min_area=t["min_area_m2"], max_rms=p["max_rms"], max_dispersion_deg=p["max_dispersion_deg"])
    out = out.withColumn("confidence", score)
    return out.withColumns({"quality_score": F.col("confidence"), "quality_grade": grade(F.col("confidence"))})


def _footprint_column():
    @F.pandas_udf("double")
    def gap(a: pd.Series, b: pd.Series, ca: pd.DataFrame, cb: pd.DataFrame, n: pd.DataFrame) -> pd.Series:
        out = []
        for i in range(len(a)):
            fa, fb = ([[list(map(float, q)) for q in ring] for ring in v] if v is not None else None for v in (a.iloc[i], b.iloc[i]))
            out.append(shapes.footprint_gap(fa, fb, (ca.iloc[i].to_numpy(float) + cb.iloc[i].to_numpy(float)) / 2, n.iloc[i].to_numpy(float)))
        return pd.Series(out, dtype=float)

    s = lambda p, e: F.struct(*[F.col(f"{p}{c}{e}") for c in "xyz"])
    return gap(F.col("footprint_a"), F.col("footprint_b"), s("center_", "_a"), s("center_", "_b"), s("n", "_a"))


def area_checks(result: Result) -> DataFrame:
    """check, expected, actual, ok over a result: counts that belong together, unique ids, finite figures."""
    spark = result.planes.sparkSession
    p = result.planes.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("plane_id").alias("ids"), F.count_if(F.col("nx").isNull() | F.isnan("nx") | F.col("plane_d").isNull()).alias("bad"), F.count_if(F.col("status") == "candidate_joint_plane").alias("chosen")).first()
    in_sets = result.joint_sets.agg(F.coalesce(F.sum("plane_count"), F.lit(0)).alias("s")).first().s
    odd = result.spacings.where(~(F.col("spacing_m") > 0)).count()
    rows = [("planes_match_count", result.counts.get("accepted_planes", p.n), p.n), ("plane_ids_unique", p.n, p.ids), ("plane_figures_finite", 0, p.bad), ("set_members_match_selected", p.chosen, in_sets), ("spacings_positive", 0, odd)]
    return spark.createDataFrame([(a, int(b), int(c), int(b) == int(c)) for a, b, c in rows], "check string, expected long, actual long, ok boolean")

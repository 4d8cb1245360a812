"""Orientation families and spacings of planes; merging planes across tiles and rolling them up."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetry.functions.geometry import aligned_sign, axial_angle, dip, dip_direction, unit, up, vec
from facetry.functions.scores import ACCEPTED, candidate_reasons, confidence, grade
from facetry.operators.graph import connected_components
from facetry.operators.joins import axial_join, box_gap_join

_N = ("nx", "ny", "nz")


def nearest_spacing(spacings: DataFrame, a: str = "plane_id_a", b: str = "plane_id_b") -> DataFrame:
    """plane_id and the least positive finite spacing to a neighbour, seen from either end."""
    ok = spacings.where((F.col("spacing_m") > 0) & ~F.isnan("spacing_m") & (F.col("spacing_m") < float("inf")))
    ends = ok.select(F.explode(F.array(a, b)).alias("plane_id"), "spacing_m")
    return ends.groupBy("plane_id").agg(F.min("spacing_m").alias("nearest_spacing_m"))


def fisher_k(n: Column, sx: Column, sy: Column, sz: Column) -> Column:
    """Concentration from the sum of unit vectors: null for fewer than two or (nearly) parallel ones, 0 for no resultant."""
    r = F.sqrt(sx * sx + sy * sy + sz * sz) / n
    return F.when(n < 2, None).when(r >= 0.999999, None).when(r < 1e-6, 0.0).otherwise((3 * r - r * r * r) / F.greatest(1 - r * r, F.lit(1e-12)))


def scanline_spacing(rows: DataFrame, group: str, t: str, key: str, least: float = 1e-9) -> DataFrame:
    """Differences of neighbours along t within a group: group, key_a, key_b, spacing_m."""
    w = Window.partitionBy(group).orderBy(t, key)
    out = rows.select(group, F.lag(key).over(w).alias(key + "_a"), F.col(key).alias(key + "_b"), (F.col(t) - F.lag(t).over(w)).alias("spacing_m"))
    return out.where(F.col("spacing_m") > least)


def _mean_normals(planes: DataFrame, group: str, weight: Column) -> DataFrame:
    """Mean axis per group; members are first turned towards the member with the largest weight."""
    lead = planes.groupBy(group).agg(F.max_by(F.struct(*_N), F.struct(weight.alias("w"), *[(-F.abs(F.col(c))).alias(c) for c in _N])).alias("_r"))
    joined = planes.join(lead, group)
    s = aligned_sign(tuple(F.col(f"_r.{c}") for c in _N), vec())
    sums = joined.groupBy(group).agg(*[F.sum(F.col(c) * s * weight).alias(c) for c in _N])
    m = up(unit(vec()))
    return sums.select(group, *[c.alias("m" + n) for c, n in zip(m, _N)])


def set_parameters(planes: DataFrame, group: str = "set_id", *, weight: Column | None = None, centre: tuple[str, str, str] = ("centroid_x", "centroid_y", "centroid_z")) -> DataFrame:
    """Planes with their set's mean axis (mnx..), the deviation from it, and the parameter t along it through the mean centre."""
    weight = F.lit(1.0) if weight is None else weight
    means = _mean_normals(planes, group, weight)
    w = planes.groupBy(group).agg(*[F.avg(c).alias(f"_c{i}") for i, c in enumerate(centre)])
    j = planes.join(means, group).join(w, group)
    m = tuple(F.col("m" + c) for c in _N)
    s = aligned_sign(m, vec())
    across = F.abs(F.col("nx") * m[0] + F.col("ny") * m[1] + F.col("nz") * m[2])
    at = s * (F.col("nx") * F.col("_c0") + F.col("ny") * F.col("_c1") + F.col("nz") * F.col("_c2") + F.col("plane_d"))
    return j.withColumns({"deviation_deg": axial_angle(vec(), m), "t": -at / across}).drop("_c0", "_c1", "_c2")


def spacing_statistics(spacings: DataFrame, group: str = "set_id") -> DataFrame:
    s = F.col("spacing_m")
    return spacings.groupBy(group).agg(F.count(F.lit(1)).alias("spacing_count"), F.avg(s).alias("mean_spacing_m"), F.percentile(s, 0.5).alias("median_spacing_m"), F.stddev_pop(s).alias("std_spacing_m"), F.min(s).alias("min_spacing_m"), F.max(s).alias("max_spacing_m"), F.percentile(s, 0.1).alias("p10_spacing_m"), F.percentile(s, 0.9).alias("p90_spacing_m"))


def joint_sets(planes: DataFrame, *, group: str = "set_id", key: str = "plane_id", weight: Column | None = None, centre: tuple[str, str, str] = ("centroid_x", "centroid_y", "centroid_z"), min_planes: int = 2, max_deviation_deg: float | None = 12.0, method: str = "spacing_virtual_scanline") -> tuple[DataFrame, DataFrame]:
    """Per set its orientation and spacing statistics, and the spacings. Sets that spread too far have none, with a reason.

    Normals are aligned to the mean axis first, so that steep planes facing either way do not cancel.
    """
    p = set_parameters(planes, group, weight=weight, centre=centre)
    m = tuple(F.col("m" + c) for c in _N)
    s = aligned_sign(m, vec())
    sets = p.groupBy(group, *["m" + c for c in _N]).agg(F.count(F.lit(1)).alias("plane_count"), F.max("deviation_deg").alias("angular_dispersion_deg"), *[F.sum(F.col(c) * s).alias("s" + c) for c in _N])
    wide = F.lit(False) if max_deviation_deg is None else F.col("angular_dispersion_deg") > max_deviation_deg
    fine = p.join(sets.where(~wide).select(group), group, "left_semi")
    gaps = scanline_spacing(fine, group, "t", key).withColumn("method", F.lit(method))
    st = sets.join(spacing_statistics(gaps, group), group, "left")
    reason = F.when(wide, "normal_dispersion_too_large").when(F.col("plane_count") < min_planes, "fewer_than_min_planes_for_set_statistics").when(F.col("spacing_count").isNull(), "no_positive_spacing")
    out = st.select(
        F.col(group).alias("set_id"), "plane_count", dip_direction(m).alias("mean_dip_direction_deg"), dip(m).alias("mean_dip_deg"), *[a.alias("mean_normal_" + c) for a, c in zip(m, "xyz")], "angular_dispersion_deg",
        F.col("spacing_count").isNotNull().alias("spacing_available"), reason.alias("spacing_reason"), *[c for c in spacing_statistics(gaps, group).columns if c.endswith("_spacing_m")],
        F.coalesce("spacing_count", F.lit(0)).alias("spacing_virtual_scanline_sample_count"), fisher_k(F.col("plane_count"), *[F.col("s" + c) for c in _N]).alias("fisher_k"),
    )
    return out, gaps.withColumnsRenamed({key + "_a": "plane_id_a", key + "_b": "plane_id_b"}).withColumn("sample_count", F.lit(1).cast("long"))


def axial_components(normals: DataFrame, angle_deg: float, key: str) -> DataFrame:
    """key and component (its smallest key): axes that chains of at most angle_deg connect. Equal axes are joined once."""
    # cut in two: unit() names each component often, and so would any expressions that they come from
    given = normals.select(key, *_N).checkpoint()
    u = given.select(key, *[c.alias(n) for c, n in zip(unit(vec()), _N)]).where("nx is not null").checkpoint()
    flip = F.when((F.col("nz") < 0) | ((F.col("nz") == 0) & ((F.col("ny") < 0) | ((F.col("ny") == 0) & (F.col("nx") < 0)))), -1.0).otherwise(1.0)
    u = u.select(key, *[F.round(F.col(c) * flip + 0.0, 12).alias(c) for c in _N])
    one = u.groupBy(*_N).agg(F.min(key).alias("_rep")).checkpoint()
    edges = axial_join(one.withColumnRenamed("_rep", "rid"), angle_deg, "rid")
    comp = connected_components(edges, "rid_a", "rid_b")
    named = one.join(comp, F.col("_rep") == F.col("node"), "left").select(*_N, F.coalesce("component", "_rep").alias("component"))
    return u.join(named, list(_N)).select(key, "component")


def merge_reason(*, angle_deg: float, offset_m: float, max_rms: float | None = None, centroids: bool = False, suffixes: tuple[str, str] = ("_a", "_b"), normals: tuple[str, str, str] | None = None) -> Column:
    """The first gate that refuses a pair of planes, 'geometry' if only their distance is left to judge.

    normals: columns that are units already, so that many pairs don't each work them out.
    centroids: also hold each plane's centre against the other plane, as within one area; offsets alone mean little far
    from the origin.
    """
    a, b = suffixes
    na, nb = (tuple(F.col(c + s) for c in normals) if normals else unit(tuple(F.col(c + s) for c in _N)) for s in (a, b))
    s = aligned_sign(na, nb)
    out = F.when(na[0].isNull() | nb[0].isNull() | F.col("plane_d" + a).isNull() | F.col("plane_d" + b).isNull(), "invalid_normal_or_plane")
    out = out.when(axial_angle(na, nb) > angle_deg, "normal_angle").when(F.abs(F.col("plane_d" + a) - s * F.col("plane_d" + b)) > offset_m, "plane_offset")
    if centroids:
        ab = F.abs(sum((na[i] * F.col(f"center_{c}{b}") for i, c in enumerate("xyz")), F.col("plane_d" + a)))
        ba = F.abs(sum((nb[i] * F.col(f"center_{c}{a}") for i, c in enumerate("xyz")), F.col("plane_d" + b)))
        out = out.when((ab > offset_m) | (ba > offset_m), "centroid_offset")
    if max_rms is not None:
        out = out.when((F.coalesce("rms_m" + a, F.lit(0.0)) > max_rms) | (F.coalesce("rms_m" + b, F.lit(0.0)) > max_rms), "rms")
    return out


def bbox_gap(suffixes: tuple[str, str] = ("_a", "_b")) -> Column:
    a, b = suffixes
    total = F.lit(0.0)
    for c in "xyz":
        g = F.greatest(F.lit(0.0), F.greatest(f"bbox_min_{c}{a}", f"bbox_min_{c}{b}") - F.least(f"bbox_max_{c}{a}", f"bbox_max_{c}{b}"))
        total = total + g * g
    return F.sqrt(total)


def xy_bounds(with_footprint: bool) -> list[Column]:
    """x0, x1, y0, y1 of a plane row: its box, and where its footprint reaches beyond."""
    def along(i: int) -> Column:
        return F.transform(F.flatten("footprint"), lambda q: F.get(q, F.lit(i)).cast("double"))

    out = []
    for i, c in enumerate("xy"):
        at = along(i) if with_footprint else F.lit(None).cast("array<double>")
        out += [F.least(F.col(f"bbox_min_{c}"), F.array_min(at)).alias(f"{c}0"), F.greatest(F.col(f"bbox_max_{c}"), F.array_max(at)).alias(f"{c}1")]
    return out


def merge_candidates(planes: DataFrame, *, key: str, gap_m: float, angle_deg: float, offset_m: float, max_rms: float | None, cell: float, footprint_gap: Column | None = None, centroids: bool = False, neighbours_only: bool = True) -> DataFrame:
    """Pairs of plane rows whose boxes come near, with the first reason that refuses them or 'accepted'.

    neighbours_only: planes of neighbouring tiles, not of the same one.
    """
    large = [c for c, t in planes.dtypes if t.startswith(("array", "map", "struct"))]
    units = ("_ux", "_uy", "_uz")
    boxes = planes.drop(*large).select("*", *[c.alias(n) for c, n in zip(unit(vec()), units)])
    if "footprint" in large:
        boxes = boxes.join(planes.select(key, *xy_bounds(True)), key)
    else:
        boxes = boxes.select("*", *xy_bounds(False))
    carry = [c for c in boxes.columns if c not in (key, "x0", "x1", "y0", "y1")]
    j = box_gap_join(boxes, gap_m, key, cell=cell, carry=carry, beside=("ix", "iy") if neighbours_only else None)
    if large:
        for s in ("_a", "_b"):
            j = j.join(planes.select(F.col(key).alias(key + s), *[F.col(c).alias(c + s) for c in large]), key + s)
    gap = bbox_gap()
    missing = F.col("bbox_min_z_a").isNull() | F.col("bbox_min_z_b").isNull()
    reason = merge_reason(angle_deg=angle_deg, offset_m=offset_m, max_rms=max_rms, centroids=centroids, normals=units).when(missing, "missing_bbox")
    if footprint_gap is not None:
        reason = reason.when(footprint_gap > gap_m, "footprint_gap").when(footprint_gap <= gap_m, "accepted")
    return j.withColumn("reason", reason.when(gap > gap_m, "bbox_gap").otherwise("accepted")).drop(*[c + s for c in units for s in ("_a", "_b")])


def tile_planes(planes: DataFrame, *, key: str, max_rms: float) -> DataFrame:
    """What grouped.TilePlanes needs of plane rows without footprints; planes that have no tile, normal, offset or box are in no pair."""
    units = ("_ux", "_uy", "_uz")
    box = [F.col(f"bbox_{m}_{c}").cast("double").alias(f"{c}{i}") for c in "xyz" for i, m in enumerate(("min", "max"))]
    rough = (F.coalesce("rms_m", F.lit(0.0)) > max_rms).alias("_rough")
    flat = F.col("bbox_min_z").isNull().alias("_flat")
    rows = planes.select(key, *[F.col(c).cast("long").alias(c) for c in ("ix", "iy")], *[c.alias(n) for c, n in zip(unit(vec()), units)], F.col("plane_d").cast("double").alias("plane_d"), *box, rough, flat)
    return rows.where(" and ".join(f"{c} is not null" for c in (key, "ix", "iy", *units, "plane_d", "x0", "x1", "y0", "y1")))


def rejection_histogram(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("reason").agg(F.count(F.lit(1)).alias("pairs"))


def gate(planes: DataFrame, limits: Mapping[str, Any], *, context: str = "roi", area: str = "area_m2") -> DataFrame:
    """status and selection_reason for every plane."""
    why = candidate_reasons(limits, context=context, area=area)
    return planes.withColumn("_why", why).withColumns({"status": F.when(F.col("_why") == "", "candidate_joint_plane").otherwise("not_selected"), "selection_reason": F.when(F.col("_why") == "", ACCEPTED).otherwise(F.col("_why"))}).drop("_why")


def global_gate(planes: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    """The gate for merged planes: the local limits with the global ones laid over; edges are no reason here."""
    return gate(planes, {**config.get("detachment", {}), **(config.get("global_candidate_gate") or {})}, context="global", area="observed_area_m2")


def roll_up(rows: DataFrame, group: str = "global_plane_id", *, config: Mapping[str, Any] | None = None) -> DataFrame:
    """One row per merged plane from its members (with `seq`, their order).

    The member with the most core points (the first, on ties) is the representative. Orientation, offset and centre are
    weighted by core points, fit quality by all points; boxes are joined, edges are censored only if all are.
    """
    cfg = config or {}
    w, n = F.greatest(F.lit(1.0), F.coalesce(F.col("core_red_points").cast("double"), F.lit(0.0))), F.greatest(F.lit(1.0), F.coalesce(F.col("point_count").cast("double"), F.lit(0.0)))
    rep = rows.groupBy(group).agg(F.max_by(F.struct(*rows.columns), F.struct(F.coalesce("core_red_points", F.lit(0)).alias("p"), (-F.col("seq")).alias("s"))).alias("_rep"))
    j = rows.join(rep, group)
    s = aligned_sign(tuple(F.col(f"_rep.{c}") for c in _N), vec())
    j = j.withColumns({"_w": w, "_n": n, "_s": s})
    mean = lambda c, by: F.sum(F.when(F.col(c).isNotNull(), F.col(c) * F.col(by))) / F.sum(F.when(F.col(c).isNotNull(), F.col(by)))
    sums = j.groupBy(group).agg(
        F.first("_rep").alias("_rep"),
        F.count_distinct("tile_id").alias("tile_count"), F.count(F.lit(1)).alias("instance_count"), F.sum("core_red_points").alias("core_red_points"), F.sum("_n").cast("long").alias("point_count"),
        *[F.sum(F.col(c) * F.col("_s") * F.col("_w")).alias("_m" + c) for c in _N], (F.sum(F.col("plane_d") * F.col("_s") * F.col("_w")) / F.sum("_w")).alias("_d"),
        *[mean(f"center_{c}", "_w").alias(f"center_{c}") for c in "xyz"],
        *[F.min(f"bbox_min_{c}").alias(f"bbox_min_{c}") for c in "xyz"], *[F.max(f"bbox_max_{c}").alias(f"bbox_max_{c}") for c in "xyz"],
        F.sum("observed_area_m2").alias("observed_area_sum_m2"), F.max("observed_area_m2").alias("max_instance_area_m2"), F.max("major_extent_m").alias("major_extent_m"), F.max("minor_extent_m").alias("minor_extent_m"), F.min("boundary_completeness").alias("boundary_completeness"),
        F.sqrt(F.sum(F.col("rms_m") * F.col("rms_m") * F.col("_n")) / F.sum(F.when(F.col("rms_m").isNotNull(), F.col("_n")))).alias("rms_m"),
        *[mean(c, "_n").alias(c) for c in ("inlier_ratio", "planarity", "normal_scale_m", "normal_stable_fraction", "normal_valid_scale_count")],
        F.max("normal_dispersion_deg").alias("_disp"), F.max("normal_stability_deg").alias("normal_stability_deg"), F.bool_and("edge_censored").alias("edge_censored"),
        F.collect_list(F.struct(*_N)).alias("_members"),
    )
    raw = unit(tuple(F.col("_m" + c) for c in _N))
    flip = F.when(raw[2] < 0, -1.0).otherwise(1.0)
    out = sums.withColumns({c: a * flip for c, a in zip(_N, raw)} | {"plane_d": F.col("_d") * flip})
    spread = F.array_max(F.transform("_members", lambda m: axial_angle((m["nx"], m["ny"], m["nz"]), vec())))
    out = out.withColumns({"normal_dispersion_deg": F.greatest("_disp", spread), "normal_stable": F.col("normal_stable_fraction") >= 0.5, "observed_area_m2": F.col("max_instance_area_m2")})
    target, plane = cfg.get("target", {}), cfg.get("plane", {})
    score = confidence(F.col("point_count"), F.col("observed_area_m2"), F.col("planarity"), F.col("inlier_ratio"), F.col("rms_m"), F.col("normal_dispersion_deg"), F.col("boundary_completeness"), min_points=target.get("min_points", 100), min_area=target.get("min_area_m2", 0.25), max_rms=plane.get("max_rms", 0.05), max_dispersion_deg=plane.get("max_dispersion_deg", 12.0))
    out = out.withColumns({"confidence": score, "dip_deg": dip(vec()), "dip_direction_deg": dip_direction(vec())}).withColumns({"quality_score": F.col("confidence"), "quality_grade": grade(F.col("confidence"))})
    keep = [c for c in ("plane_id", "set_id", "mae_m", "p95_residual_m", "near_vertical", "trace_length_m", "data_gap_censored", "trace_verified", "aperture_available", "aperture_reason") if c in rows.columns]
    return out.withColumns({c: F.col(f"_rep.{c}") for c in keep}).drop("_rep", "_d", "_disp", "_members", *["_m" + c for c in _N])

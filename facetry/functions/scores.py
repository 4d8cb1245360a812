"""Scores, grades and gates: expressions that always say why a row is rejected."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the confidence terms.
WEIGHTS = {"points": 0.15, "area": 0.10, "planarity": 0.15, "inlier": 0.20, "rms": 0.15, "dispersion": 0.15, "completeness": 0.10}


def _clip(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def confidence(points: Column, area: Column, planarity: Column, inlier: Column, rms: Column, dispersion: Column, completeness: Column, *, min_points: float, min_area: float, max_rms: float, max_dispersion_deg: float = 12.0) -> Column:
    terms = {
        "points": _clip(points / max(1.0, float(min_points))),
        "area": _clip(area / max(1e-12, float(min_area))),
        "planarity": _clip(planarity),
        "inlier": _clip(inlier),
        "rms": _clip(1.0 - rms / max_rms),
        "dispersion": _clip(1.0 - dispersion / max_dispersion_deg),
        "completeness": _clip(completeness),
    }
    out = F.lit(0.0)
    for k, w in WEIGHTS.items():
        out = out + terms[k] * w
    return out


def grade(score: Column, a: float = 0.85, b: float = 0.70, c: float = 0.55) -> Column:
    return F.when(score >= a, "A").when(score >= b, "B").when(score >= c, "C").otherwise("Rejected")


def looseness(planarity: Column, curvature: Column, max_curvature: float) -> Column:
    return _clip((1.0 - planarity) + curvature / max_curvature)


def dynamic_thresholds(planarity: Column, curvature: Column, *, max_curvature: float = 0.08, angle: float = 8.0, max_angle: float = 12.0, distance: float = 0.025, max_distance: float = 0.05) -> tuple[Column, Column]:
    """Angle and distance that a point is granted: the less planar its surroundings, the more."""
    t = looseness(planarity, curvature, max_curvature)
    return t * (max_angle - angle) + angle, t * (max_distance - distance) + distance


def _below(value: Column, least: float) -> Column:
    """True if the value does not reach the least; null and NaN do not."""
    return value.isNull() | F.isnan(value) | (value < least)


def _above(value: Column, most: float) -> Column:
    return value.isNull() | F.isnan(value) | (value > most)


ACCEPTED = "accepted_conservative_planar_discontinuity_candidate"


def candidate_reasons(gate: Mapping[str, Any], *, context: str = "roi", area: str = "area_m2") -> Column:
    """Why a plane is no candidate, joined by ';' ('' if it is one).

    Confidence and area are always checked, the rest only where the gate has a limit; null and NaN fail a check.
    """
    checks = [(_below(F.col("confidence"), gate.get("min_confidence", 0.0)), "below_min_confidence"), (_below(F.col(area), gate.get("min_area_m2", 0.0)), "below_min_area")]
    for column, name in (("minor_extent_m", "minor_extent"), ("major_extent_m", "major_extent"), ("boundary_completeness", "boundary_completeness"), ("inlier_ratio", "inlier_ratio")):
        key = f"min_{column}"
        if gate.get(key) is not None:
            checks.append((_below(F.col(column), gate[key]), f"below_min_{name}"))
    if gate.get("max_normal_dispersion_deg") is not None:
        checks.append((_above(F.col("normal_dispersion_deg"), gate["max_normal_dispersion_deg"]), "above_max_normal_dispersion"))
    if gate.get("reject_edge_censored") and context == "roi":
        checks.append((F.coalesce(F.col("edge_censored"), F.lit(False)), "roi_edge_censored"))
    return F.concat_ws(";", *[F.when(bad, F.lit(why)) for bad, why in checks])


def fit_rejection(*, min_points: int, min_inlier_ratio: float, min_area: float, min_minor: float, max_rms: float, min_confidence: float) -> Column:
    """The first reason why a fitted plane is refused, null if none."""
    return F.coalesce(
        F.when(~F.coalesce(F.col("fitted"), F.lit(True)), F.lit("ransac_failed")),
        F.when(F.col("point_count") < min_points, F.lit("below_min_points")),
        F.when(F.col("inlier_ratio") < min_inlier_ratio, F.lit("below_min_inlier_ratio")),
        F.when(F.col("area_m2") < min_area, F.lit("below_min_area")),
        F.when(F.col("minor_extent_m") < min_minor, F.lit("below_min_minor_extent")),
        F.when(F.col("rms_m") > max_rms, F.lit("above_max_rms")),
        F.when(F.col("confidence") < min_confidence, F.lit("below_min_confidence")),
    )


def density_status(p10: Column, median: Column, min_p10: float, min_median: float) -> Column:
    return F.when(p10.isNull() | median.isNull(), "DENSITY_NOT_ASSESSED").when((p10 >= min_p10) & (median >= min_median), "pass").otherwise("DENSITY_TARGET_NOT_MET")

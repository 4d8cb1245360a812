"""Column lists of the tables that operators exchange and sinks write; every column is nullable unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = "point_id long, x double, y double, z double, intensity int, classification int, red int, green int, blue int"
FEATURE = (
    "point_id long, neighbor_count int, normal array<double>, eigenvalues array<double>, planarity double, surface_variation double, curvature double, "
    "normal_scale_m double, normal_stability_deg double, normal_stable boolean, normal_valid_scale_count int, multiscale_entropy double"
)
_BOX = "bbox_min_x double, bbox_min_y double, bbox_min_z double, bbox_max_x double, bbox_max_y double, bbox_max_z double"
_NORMAL = "normal_dispersion_deg double, normal_scale_m double, normal_stability_deg double, normal_stable_fraction double, normal_valid_scale_count double, normal_stable boolean"
PLANE = (
    "plane_id string, set_id string, point_count long, candidate_point_count long, nx double, ny double, nz double, plane_d double, "
    f"dip_direction_deg double, dip_deg double, centroid_x double, centroid_y double, centroid_z double, {_BOX}, area_m2 double, "
    "observed_area_m2 double, apparent_persistence_m double, major_extent_m double, minor_extent_m double, trace_length_m double, rms_m double, "
    f"mae_m double, p95_residual_m double, inlier_ratio double, planarity double, {_NORMAL}, boundary_completeness double, "
    "edge_censored boolean, confidence double, quality_score double, quality_grade string, near_vertical boolean, data_gap_censored boolean, "
    "trace_verified boolean, aperture_available boolean, aperture_reason string"
)
TILE_PLANE = (
    "tile_id string, global_plane_id string, global_set_id string, global_instance_count long, global_tile_count long, core_red_points long, "
    f"tile_plane_index int, status string, selection_reason string, nearest_spacing_m double, center_x double, center_y double, center_z double, {PLANE}"
)
GLOBAL_PLANE = (
    "global_plane_id string, global_set_id string, tile_count long, instance_count long, core_red_points long, plane_id string, set_id string, "
    "dip_direction_deg double, dip_deg double, trace_length_m double, observed_area_m2 double, observed_area_sum_m2 double, max_instance_area_m2 double, "
    "major_extent_m double, minor_extent_m double, edge_censored boolean, nearest_spacing_m double, center_x double, center_y double, center_z double, "
    f"centroid_x double, centroid_y double, centroid_z double, nx double, ny double, nz double, plane_d double, {_BOX}, rms_m double, mae_m double, "
    f"p95_residual_m double, inlier_ratio double, planarity double, {_NORMAL}, boundary_completeness double, confidence double, quality_score double, "
    "quality_grade string, near_vertical boolean, data_gap_censored boolean, trace_verified boolean, aperture_available boolean, aperture_reason string"
)
JOINT_SET = (
    "set_id string, plane_count long, mean_dip_direction_deg double, mean_dip_deg double, mean_normal_x double, mean_normal_y double, mean_normal_z double, "
    "angular_dispersion_deg double, spacing_available boolean, spacing_reason string, mean_spacing_m double, median_spacing_m double, std_spacing_m double, "
    "min_spacing_m double, max_spacing_m double, p10_spacing_m double, p90_spacing_m double, spacing_3d_sample_count long, "
    "spacing_virtual_scanline_sample_count long, mean_spacing_3d_m double, median_spacing_3d_m double, mean_spacing_virtual_scanline_m double, "
    "median_spacing_virtual_scanline_m double, fisher_k double"
)
SPACING = "set_id string, plane_id_a string, plane_id_b string, spacing_m double, method string, sample_count long"
SPACING_GLOBAL = "tile_id string, plane_id_a string, plane_id_b string, global_plane_id_a string, global_plane_id_b string, spacing_m double, method string"
DETACHMENT = (
    "plane_id string, set_id string, status string, selection_reason string, dip_direction_deg double, dip_deg double, trace_length_m double, "
    "apparent_persistence_m double, observed_area_m2 double, major_extent_m double, minor_extent_m double, edge_censored boolean, nearest_spacing_m double, "
    f"center_x double, center_y double, center_z double, area_m2 double, boundary_completeness double, inlier_ratio double, {_NORMAL}, "
    "confidence double, quality_score double, quality_grade string"
)
REJECTED = "raw_set_label int, point_count long, reason string"
TRACE = "plane_id string, available boolean, trace_verified boolean, method string, chord_length_m double, polyline_length_m double, reason string"
APERTURE = "plane_id string, available boolean, source string, effective_resolution_m double, aperture_m double, reason string"
TILE_STATE = "tile_id string, status string, report string, candidate_red_points long, error string"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def finite_or_null(c: Column) -> Column:
    """NaN and the infinities as null; they never leave through a sink."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Exactly the columns of the table in their order: extra ones go, missing ones are null, doubles are finite or null."""
    cols = []
    for f in struct(ddl):
        c = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        cols.append((finite_or_null(c) if isinstance(f.dataType, T.DoubleType) else c).alias(f.name))
    return df.select(*cols)

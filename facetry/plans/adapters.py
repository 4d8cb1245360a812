"""Views of the driver's tables as points, planes and scans; the SQL beside them makes the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTS_SQL = """pts AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS pid, l_orderkey, l_linenumber,
         CAST(l_quantity AS DOUBLE) AS x, CAST(l_extendedprice AS DOUBLE) / 1000 AS y, CAST(l_discount AS DOUBLE) * 100 + CAST(l_tax AS DOUBLE) * 10 AS z FROM lineitem)"""
PLANES_SQL = """raw AS (
  SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS e FROM embeddings
), unit AS (
  SELECT *, sqrt(e[1] * e[1] + e[2] * e[2] + e[3] * e[3]) AS len FROM raw
), planes AS (
  SELECT vec_id, label, CASE WHEN e[3] / len < 0 THEN -1.0 ELSE 1.0 END AS s, e[1] / len * s AS nx, e[2] / len * s AS ny, e[3] / len * s AS nz, e[4] * s AS plane_d, abs(e[5]) AS rms_m,
         e[6] AS center_x, e[7] AS center_y, e[8] AS center_z, abs(e[9]) AS major_extent_m, abs(e[10]) AS minor_extent_m, abs(e[11]) AS area_m2,
         e[6] - abs(e[9]) AS bbox_min_x, e[6] + abs(e[9]) AS bbox_max_x, e[7] - abs(e[10]) AS bbox_min_y, e[7] + abs(e[10]) AS bbox_max_y, e[8] - abs(e[11]) AS bbox_min_z, e[8] + abs(e[11]) AS bbox_max_z,
         vec_id % 8 AS ix, (vec_id // 8) % 8 AS iy, abs(e[12]) * 1000 AS core_red_points, abs(e[13]) * 500 AS point_count,
         0.5 + abs(e[14]) AS confidence, 0.6 + abs(e[15]) AS inlier_ratio, 0.5 + abs(e[16]) AS boundary_completeness, abs(e[17]) * 40 AS normal_dispersion_deg, 0.4 + abs(e[18]) AS planarity, e[19] > 0.2 AS edge_censored FROM unit)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem")
    return t.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("pid"), "l_orderkey", "l_linenumber",
        F.col("l_quantity").cast("double").alias("x"), (F.col("l_extendedprice").cast("double") / 1000).alias("y"), (F.col("l_discount").cast("double") * 100 + F.col("l_tax").cast("double") * 10).alias("z"),
    )


def planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))
    e = lambda i: F.get("e", i - 1)
    t = t.withColumn("len", F.sqrt(e(1) * e(1) + e(2) * e(2) + e(3) * e(3)))
    t = t.withColumn("s", F.when(e(3) / F.col("len") < 0, -1.0).otherwise(1.0))
    a = lambda i: F.abs(e(i))
    return t.select(
        "vec_id", "label", *[(e(i + 1) / F.col("len") * F.col("s")).alias(n) for i, n in enumerate(("nx", "ny", "nz"))], (e(4) * F.col("s")).alias("plane_d"), a(5).alias("rms_m"),
        *[e(6 + i).alias(f"center_{c}") for i, c in enumerate("xyz")], a(9).alias("major_extent_m"), a(10).alias("minor_extent_m"), a(11).alias("area_m2"),
        *[(e(6 + i) - a(9 + i)).alias(f"bbox_min_{c}") for i, c in enumerate("xyz")], *[(e(6 + i) + a(9 + i)).alias(f"bbox_max_{c}") for i, c in enumerate("xyz")],
        (F.col("vec_id") % 8).alias("ix"), (F.floor(F.col("vec_id") / 8) % 8).alias("iy"), (a(12) * 1000).alias("core_red_points"), (a(13) * 500).alias("point_count"),
        (a(14) + 0.5).alias("confidence"), (a(15) + 0.6).alias("inlier_ratio"), (a(16) + 0.5).alias("boundary_completeness"), (a(17) * 40).alias("normal_dispersion_deg"), (a(18) + 0.4).alias("planarity"), (e(19) > 0.2).alias("edge_censored"),
    )

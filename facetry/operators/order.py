"""Global order without a global sort task: ranks and the samples and windows that rest on them."""

from __future__ import annotations

from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetry.operators.graph import _ensure_checkpoint_dir


def ranked(df: DataFrame, order: list[Column], name: str = "rank", partitions: int | None = None) -> DataFrame:
    """row_number() over the whole table (from 1). Ranges are numbered apart; one offset per range goes to the driver."""
    spark = df.sparkSession
    _ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()).checkpoint()
    counts = {r["_part"]: r.n for r in parts.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    base, rows = 0, []
    for p in sorted(counts):
        rows.append((p, base))
        base += counts[p]
    offsets = spark.createDataFrame(rows, "_part int, _base long")  # one row per partition
    within = parts.withColumn("_rn", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return within.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_rn") + F.col("_base")).drop("_part", "_rn", "_base")


def linspace_sample(df: DataFrame, m: int, order: list[Column]) -> DataFrame:
    """m rows at even steps of an order: places trunc(i * step), step = (n - 1) / (m - 1) in doubles. All rows, if no more."""
    n = df.count()
    if n <= m:
        return df
    step = (n - 1) / (m - 1)
    at = F.col("_rank") - 1
    i = F.ceil(at / step)
    taken = F.lit(False)
    for d in (-1, 0, 1):
        taken = taken | ((i + d >= 0) & (i + d <= m - 1) & (F.floor((i + d).cast("double") * step) == at))
    return ranked(df, order, "_rank").where(taken).drop("_rank")


def nearest_rank(df: DataFrame, column: str, q: float) -> DataFrame:
    """One row: the value at place round((n - 1) q), halves to the even place."""
    values = df.where(F.col(column).isNotNull()).select(column)
    n = values.count()
    if not n:
        return values.agg(F.max(column).alias("value"))
    place = round((n - 1) * q) + 1
    return ranked(values, [F.col(column)], "_rank").where(F.col("_rank") == place).select(F.col(column).alias("value"))


def numbered(df: DataFrame, group: str, order: list[Column], template: str = "%s-%03d", name: str = "plane_id") -> DataFrame:
    """Ids within a group: `group-001`, ... in the given order."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(name, F.format_string(template, F.col(group), F.row_number().over(w)))


def numbered_sets(df: DataFrame, key: str, weight: str, tie: str, name: str = "set_id", template: str = "J%d") -> DataFrame:
    """Sets by falling total weight, ties by the smallest `tie`: J1, J2, ..."""
    sums = df.groupBy(key).agg(F.sum(weight).alias("_w"), F.min(tie).alias("_t"))
    named = ranked(sums, [F.desc("_w"), F.asc("_t"), F.asc(key)], "_r").select(key, F.format_string(template, F.col("_r")).alias(name))
    return df.join(named, key)


def global_ids(df: DataFrame, component: str, seq: str, template: str = "GJ-%05d", name: str = "global_plane_id") -> DataFrame:
    """Ids of merged groups, numbered by each group's smallest member."""
    firsts = df.groupBy(component).agg(F.min(seq).alias("_s"))
    named = ranked(firsts, [F.asc("_s")], "_r").select(component, F.format_string(template, F.col("_r")).alias(name))
    return df.join(named, component)


def quantiles(df: DataFrame, column: str, qs: list[float], *, buckets: int = 4096) -> list[float | None]:
    """Quantiles as percentile() interpolates them, without a map of all values in one task: values are counted in even buckets
    between their bounds, and the bucket that holds a wanted place is counted again until it holds one value."""
    _ensure_checkpoint_dir(df.sparkSession)
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v")).checkpoint()
    n, low, high = values.agg(F.count("v"), F.min("v"), F.max("v")).first()
    if not n:
        return [None] * len(qs)
    at = [(n - 1) * q for q in qs]
    got: dict[int, float] = {}
    todo = [(low, high, 0, sorted({int(f(a)) for a in at for f in (floor, ceil)}))]
    while todo:
        low, high, base, wanted = todo.pop()
        if low == high:
            got |= dict.fromkeys(wanted, low)
            continue
        bucket = F.least(F.floor((F.col("v") - low) / (high - low) * buckets), F.lit(buckets - 1))
        for r in sorted(values.where(F.col("v").between(low, high)).groupBy(bucket.alias("b")).agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect(), key=lambda r: r.b):
            if some := [w for w in wanted if base <= w < base + r.n]:
                todo.append((r.lo, r.hi, base, some))
            base += r.n
    return [got[int(a)] if a == int(a) else (ceil(a) - a) * got[floor(a)] + (a - floor(a)) * got[ceil(a)] for a in at]

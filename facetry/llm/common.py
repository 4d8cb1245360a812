"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir where the cluster names one.

    Only where it is unset (a single-machine session, as in tests) is a folder chosen here.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        jsc = spark.sparkContext._jsc.sc()
        if jsc.getCheckpointDir().isEmpty():
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
            spark.sparkContext.setCheckpointDir("/tmp/facetry-shared")
        named = jsc.getCheckpointDir().get()
    return named.rstrip("/")


def written(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut the lineage: write df as a Parquet table in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/facetry-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: join_spread() takes keys with one part in so many of all rows, or more, apart: there are so many such keys at most.
HOT = 1000


def join_spread(rows: DataFrame, side: DataFrame, on: list[str], total: int, count: str = "n") -> DataFrame:
    """rows joined with side, which has one row for each key with the number of its rows in `count`.

    Keys that hold a thousandth of all rows are a thousand at most, and are joined by a broadcast; no key of the rest is large.
    """
    hot = F.col(count) * HOT >= total
    wide = F.broadcast(side.where(hot).drop(count))
    rest = rows.join(wide.select(*on), on, "left_anti").join(side.where(~hot).drop(count), on)
    return rows.join(wide, on).unionByName(rest)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def schema_with(extra: str) -> T.StructType:
    return T.StructType.fromDDL(extra)

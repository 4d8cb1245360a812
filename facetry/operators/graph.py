"""Connected components of an undirected graph given as edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", *, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node that has an edge; the component is its smallest node.

    Each round maps every node to the first of itself and its neighbours in the order of a hash, contracts the graph along
    that map and drops loops and repeated edges. The hash makes the order random, so that chains whose ids rise shrink
    as fast as others: the number of rounds is logarithmic. A hub's edges are reduced to a minimum per task before they
    meet. Rounds are cut by checkpoint() into the folder that the cluster names; the maps are then chained.
    """
    spark = edges.sparkSession
    _ensure_checkpoint_dir(spark)
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a <> b")
    e = e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().checkpoint()
    labels = e.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")).checkpoint()
    for _ in range(most_rounds):
        if e.isEmpty():
            least = labels.groupBy("root").agg(F.min("node").alias("component"))
            return labels.join(least, "root").select("node", "component")
        first = lambda n, m: e.select(F.col(n).alias("n"), F.struct(F.xxhash64(m).alias("h"), F.col(m).alias("m")).alias("s"))
        both = first("a", "a").unionByName(first("a", "b")).unionByName(first("b", "a")).unionByName(first("b", "b"))
        step = both.groupBy("n").agg(F.min("s").alias("s")).select("n", "s.m").checkpoint()
        sa, sb = step.select(F.col("n").alias("a"), F.col("m").alias("ma")), step.select(F.col("n").alias("b"), F.col("m").alias("mb"))
        e = e.join(sa, "a").join(sb, "b").where("ma <> mb").select(F.least("ma", "mb").alias("a"), F.greatest("ma", "mb").alias("b")).distinct().checkpoint()
        labels = labels.join(step.withColumnRenamed("n", "root"), "root", "left").select("node", F.coalesce("m", "root").alias("root")).checkpoint()
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _ensure_checkpoint_dir(spark) -> None:
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(named or "/tmp/facetry-shared")

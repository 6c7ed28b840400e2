"""Connected components of a link table, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.plans.session import scratch_path
from tallgrass.sources.writers import store


def keep(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    return store(df, scratch_path(spark, label))


def drop(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables made by ``keep`` when all that reads them has been written."""
    for table in tables:
        for file in table.inputFiles()[:1]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; a component is named by its smallest node.

    Alternates two steps until nothing changes. Large star: every neighbour larger than a node is
    linked to the smallest of its neighbours and itself. Small star: the others are. Each step is one
    aggregate (a minimum per node, combined before the shuffle) and one join; a hub's many links are
    split by adaptive execution. The number of rounds grows with the logarithm of the largest
    component. Self links keep their node; nulls are ignored.
    """
    links = links.select("a", "b").where("a is not null and b is not null")
    nodes = keep(spark, links.distinct(), "links")
    edges = nodes.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = keep(spark, edges.distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = (
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        before, edges = edges, keep(spark, small, "edges")
        drop(spark, before)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    alone = nodes.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return alone.join(edges.select(F.col("a").alias("node"), "b"), "node", "left").select(
        "node", F.coalesce("b", "node").alias("component")
    )

"""Connected components of a link table by large-star / small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.llm.common import written

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round; minima are aggregates with a map-side combine, so a hub is no hot task."""
    near = edges.select("u", "v")
    if large:
        near = near.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = near.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")).withColumn("m", F.least("k", "m"))
    joined = near.join(least, F.col("u") == F.col("k"))
    if large:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select(F.col("k").alias("u"), F.col("m").alias("v"))
    return moved.union(own).where("u <> v").distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``links`` (a, b) without nulls -> (node, root), root the least node; only linked nodes appear.

    Every round is written to the shared folder, which cuts the lineage.  The
    rounds end when the link table no longer changes (a logarithmic number).
    """
    edges = written(spark, links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct(), "links")
    mark = None
    for _ in range(MAX_ROUNDS):
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or tuple(now) == mark:
            break
        mark = tuple(now)
        edges = written(spark, _star(_star(edges, True), False), "links")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )

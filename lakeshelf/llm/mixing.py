"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected copies, target / source size.
Their prefix sum runs through the source's documents, from the largest to the
smallest; one offset is added, and a document is emitted once for each integer
boundary its step crosses.  The order by size keeps the taken words within about
one large document of the target, whatever the offset; of ``DRAWS`` seeded offsets
the one that comes nearest is used, so small sources come near too.

Targets: the words of all sources, shared by weight; no target is above
``CEILING`` times its source's words, and what is over is shared again by weight.

Defined results: a null or empty text has size 0 and takes 0 words.  Null is a
source of its own, the last.  A source without words has target 0.  Repeated rows
are rows like any others.  Same rows, same result.  An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.llm.common import WORD, ordered_prefix, row_key, written

WEIGHTS = (5, 2, 1)
CEILING = 3
SEED = 7_919
DRAWS = 32


def n_words(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(spark: SparkSession, sources: DataFrame, weights: Sequence[float] = WEIGHTS, ceiling: float = CEILING) -> DataFrame:
    """``sources`` (source, source_size) plus ``target``; sources stay a distributed table.

    Each round shares what is left among the sources below their ceiling; those it
    lifts over stay at the ceiling.  A round is one aggregate that gives one row.
    """
    ranked = ordered_prefix(
        spark, sources.withColumn("_one", F.lit(1)), [F.col("source").asc_nulls_last()], "_one", "_rank", name="sourcerank"
    )
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("_rank", F.lit(len(weights))) + 1).cast("int"))
    table = written(spark, ranked.select("source", "source_size", weight.alias("weight")), "weights")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    top = F.col("source_size") * F.lit(float(ceiling))
    level, capped = None, None
    while True:
        over = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= top
        row = table.agg(
            F.sum(F.when(over, F.col("source_size")).otherwise(0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))),
            F.sum(over.cast("long")),
        ).first()
        if row[1] is None or row[2] == capped or row[1] == 0:
            break
        capped, level = row[2], (total - ceiling * row[0]) / row[1]
    share = F.col("weight") * F.lit(level if level is not None else 0.0)
    return table.select("source", "source_size", "weight", F.least(top, share).alias("target"))


def lot(seed: int, *parts: Column) -> Column:
    """A hash of ``parts`` that SQL engines share."""
    return F.md5(F.concat_ws("|", F.lit(seed), *parts))


def offset(seed: int, draw: int, source: Column) -> Column:
    """A number in [0, 1) for each draw and source, from 52 bits of the hash."""
    return F.conv(F.substring(lot(seed, F.lit(draw), source), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def copies(step: Column, rank: Column, start: Column) -> Column:
    """Integer boundaries crossed by the step to prefix sum ``step * (rank + 1)``."""
    return F.floor(start + step * (rank + 1)) - F.floor(start + step * rank)


def mix(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = WEIGHTS, ceiling: float = CEILING, seed: int = SEED, draws: int = DRAWS) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: one row for each row of ``docs``."""
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), n_words(text).alias("size"))
    return _mix(spark, written(spark, narrow, "sizes"), weights, ceiling, seed, draws)


def _mix(spark: SparkSession, sizes: DataFrame, weights: Sequence[float], ceiling: float, seed: int, draws: int) -> DataFrame:
    extra = [c for c in sizes.columns if c not in ("source", "size")]
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = targets(spark, per_source, weights, ceiling)
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    starts = F.array(*[offset(seed, i, F.col("source")) for i in range(draws)])
    goals = written(spark, goals.withColumns({"step": step, "starts": starts}).withColumnRenamed("source", "of"), "targets")
    order = [F.col("size").desc(), lot(seed, *[F.col(c) for c in extra]).asc()]
    ranked = ordered_prefix(spark, sizes.withColumn("_one", F.lit(1)), order, "_one", "rank", group="source", name="ranks").drop("_one")
    same = F.col("source").eqNullSafe(F.col("of"))
    ranked = ranked.join(goals, same)
    tries = [F.get("starts", F.lit(i)) for i in range(draws)]
    far = ranked.groupBy("of").agg(
        F.first("target").alias("target"), *[F.sum(F.col("size") * copies(F.col("step"), F.col("rank"), u)).alias(f"t{i}") for i, u in enumerate(tries)]
    )
    # The nearest draw; of equally near ones the first.
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"t{i}") - F.col("target")).alias("d"), F.lit(i).alias("i")) for i in range(draws)]))
    best = far.select(F.col("of").alias("of2"), nearest["i"].alias("draw"))
    ranked = ranked.join(best, F.col("of").eqNullSafe(F.col("of2")))
    taken = copies(F.col("step"), F.col("rank"), F.get("starts", F.col("draw"))).cast("long")
    return ranked.select(*extra, "source", "size", "source_size", "target", taken.alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))


def mixed(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
          weights: Sequence[float] = WEIGHTS, ceiling: float = CEILING, seed: int = SEED, draws: int = DRAWS) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; rows are told apart by ``row_key``."""
    row = row_key(docs)
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), n_words(text).alias("size"), row.alias("row"))
    plan = _mix(spark, written(spark, narrow, "sizes"), weights, ceiling, seed, draws)
    # Repeated rows share a key: their copies are added and dealt out evenly.
    times = plan.groupBy("row").agg(F.sum("copies").alias("\x00c"), F.count(F.lit(1)).alias("\x00n")).withColumnRenamed("row", "\x00r")
    times = written(spark, times.where("`\x00c` > 0").select(F.col("`\x00r`").alias("r"), F.col("`\x00c`").alias("c"), F.col("`\x00n`").alias("n")), "copies")
    # Rows meet their copies by a shuffle of both, alike at every size; the narrow side is hashed, texts are not sorted.
    times = times.select(*[F.col(c).alias("\x00" + c) for c in ("r", "c", "n")]).hint("shuffle_hash")
    once = docs.withColumn("\x00row", row).join(times, F.col("`\x00row`") == F.col("`\x00r`"))
    repeated = times.where("`\x00n` > 1")
    if not repeated.isEmpty():
        once = once.where("`\x00n` = 1").unionByName(once.where("`\x00n` > 1").dropDuplicates(["\x00row"]))
    many = once.withColumn("\x00copy", F.explode(F.sequence(F.lit(1), F.col("`\x00c`"))))
    return many.select(*[F.col(f"`{c}`") for c in docs.columns])

"""SimHash near-duplicates: a binary trie of fingerprints joined with itself.

Each text gives a 64-bit fingerprint.  Distinct fingerprints form a binary trie;
pairs of its nodes are walked down together, adding up differing bits, and a pair
is dropped once it exceeds the error budget.  The top of the trie is walked as
DataFrames of node counts, so a node that would overfill a task is always split
further; the node pairs that fit are walked in tasks.

Defined results: a null, empty or blank text has fingerprint 0 and links like any
other.  A null doc_id keeps its row; the class id is the least non-null doc_id of
the class, null if it has none.  Repeated rows share a fingerprint and stay.  An
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakeshelf.llm.common import add_columns, join_split, parts_for, row_key, written
from lakeshelf.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
BITS = 64
BUDGET = 2
STEP = 4  # bits a round of the top walk goes down
NODE_LIMIT = 65_536  # fingerprints both sides of a pair may have in one task
FRONT_LIMIT = 1_000_000  # node pairs a task holds at once

FINGERPRINT = StructType([StructField("fingerprint", LongType())])


def fingerprint(text: bytes | None) -> int:
    """The signed 64-bit fingerprint of one text."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE_WORDS:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        spans = zip(starts[: 1 - SHINGLE_WORDS].tolist(), ends[SHINGLE_WORDS - 1 :].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64, len(words) - SHINGLE_WORDS + 1)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, hashes.size, 65_536):  # bounded unpacked bits for very long texts
        piece = hashes[i : i + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(piece, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > hashes.size, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus ``fingerprint``."""
    return add_columns(docs, text, FINGERPRINT, lambda texts: [[fingerprint(t) for t in texts]], keep)


def _top(column: str, depth: int):
    """The first ``depth`` bits of a fingerprint as a number."""
    return F.shiftrightunsigned(F.col(column), BITS - depth) if depth else F.lit(0).cast("long")


def node_pairs(spark: SparkSession, prints: DataFrame, budget: int, limit: int) -> dict[int, DataFrame]:
    """Pairs of trie nodes that fit one task, by depth: (a, b, err), a <= b.

    From the root pair downwards: pairs that hold more than ``limit``
    fingerprints are replaced by the pairs of their children within the budget.
    """
    pairs = spark.createDataFrame([(0, 0, 0)], "a long, b long, err int")
    ready: dict[int, DataFrame] = {}
    for depth in range(0, BITS + 1, STEP):
        nodes = prints.groupBy(_top("fp", depth).alias("node")).agg(F.count(F.lit(1)).alias("n"))
        sized = (
            pairs.join(nodes.select(F.col("node").alias("a"), F.col("n").alias("na")), "a")
            .join(nodes.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
            .select("a", "b", "err", (F.col("na") + F.col("nb")).alias("n"))
        )
        sized = written(spark, sized, "nodepairs")
        fits = F.col("n") <= limit if depth < BITS else F.lit(True)
        ready[depth] = sized.where(fits).select("a", "b", "err")
        heavy = sized.where(~fits)
        if depth == BITS or heavy.isEmpty():
            break
        child = nodes_below(prints, depth + STEP)
        left = heavy.join(child.select(F.col("up").alias("a"), F.col("node").alias("ca")), "a")
        both = left.join(child.select(F.col("up").alias("b"), F.col("node").alias("cb")), "b")
        err = (F.col("err") + F.bit_count(F.col("ca").bitwiseXOR(F.col("cb")).bitwiseAND(F.lit(2**STEP - 1)))).cast("int")
        pairs = both.where((F.col("a") != F.col("b")) | (F.col("ca") <= F.col("cb"))).select(
            F.col("ca").alias("a"), F.col("cb").alias("b"), err.alias("err")
        )
        pairs = pairs.where(F.col("err") <= budget)
    return ready


def nodes_below(prints: DataFrame, depth: int) -> DataFrame:
    """The trie's nodes at ``depth`` with the node ``STEP`` bits above each."""
    nodes = prints.select(_top("fp", depth).alias("node")).distinct()
    return nodes.select("node", F.shiftrightunsigned("node", STEP).alias("up"))


def walk(left: np.ndarray, right: np.ndarray, depth: int, err: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of two sorted uint64 arrays that differ in at most ``budget`` bits.

    Both arrays share their own first ``depth`` bits, which differ in ``err`` bits.
    The front of node pairs goes down a bit at a time; a pair of two single
    fingerprints is settled at once.  A front over ``FRONT_LIMIT`` is cut in parts.
    """
    todo = [(depth, *(np.array([x], np.int64) for x in (0, left.size, 0, right.size, err)))]
    while todo:
        d, a0, a1, b0, b1, e = todo.pop()
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():
            i, j = a0[single], b0[single]
            near = np.bitwise_count(left[i] ^ right[j]) <= budget
            yield i[near], j[near]
            a0, a1, b0, b1, e = (x[~single] for x in (a0, a1, b0, b1, e))
        if not a0.size:
            continue
        if d == BITS:  # equal elements on each side are not split further
            for x0, x1, y0, y1 in zip(a0.tolist(), a1.tolist(), b0.tolist(), b1.tolist(), strict=True):
                i, j = np.meshgrid(np.arange(x0, x1), np.arange(y0, y1), indexing="ij")
                yield i.ravel(), j.ravel()
            continue
        if a0.size > FRONT_LIMIT:
            half = a0.size // 2
            todo += [(d, a0[:half], a1[:half], b0[:half], b1[:half], e[:half]), (d, a0[half:], a1[half:], b0[half:], b1[half:], e[half:])]
            continue
        shift = np.uint64(BITS - 1 - d)
        mid = []
        for values, lo, hi in ((left, a0, a1), (right, b0, b1)):
            ones = np.concatenate(([0], np.cumsum(((values >> shift) & np.uint64(1)).astype(np.int64))))
            mid.append(hi - (ones[hi] - ones[lo]))
        am, bm = mid
        same = left is right  # then each pair of nodes is walked once
        parts = []
        for x0, x1, y0, y1, cost in ((a0, am, b0, bm, 0), (am, a1, bm, b1, 0), (a0, am, bm, b1, 1), (am, a1, b0, bm, 1)):
            ok = (x1 > x0) & (y1 > y0) & (e + cost <= budget)
            if same:
                ok &= x0 <= y0
            parts.append((x0[ok], x1[ok], y0[ok], y1[ok], e[ok] + cost))
        todo.append((d + 1, *(np.concatenate(x) for x in zip(*parts, strict=True))))


class Forest:
    """Keeps of many links those that join two trees."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = up.get(p, p)
            x = p
        return x

    def add(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def _links(depth: int, budget: int):
    """For one group (a node pair): the links of a spanning forest of its near pairs."""

    def run(group: pa.Table) -> pa.Table:
        err = group.column("err")[0].as_py()
        side, fp = group.column("side").to_numpy(), group.column("fp").to_numpy()
        a = np.sort(fp[side == 0].view(np.uint64))
        b = np.sort(fp[side == 1].view(np.uint64)) if (side == 1).any() else a
        forest, found = Forest(), []
        for i, j in walk(a, b, depth, err, budget):
            x, y = a[i].view(np.int64), b[j].view(np.int64)
            found += [(p, q) for p, q in zip(x.tolist(), y.tolist(), strict=True) if p != q and forest.add(p, q)]
        return pa.table({"a": pa.array([p for p, _ in found], pa.int64()), "b": pa.array([q for _, q in found], pa.int64())})

    return run


def links(spark: SparkSession, prints: DataFrame, budget: int = BUDGET, limit: int = NODE_LIMIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``prints`` (fp); they span all classes.

    Within a task only links that join two trees are kept, so a dense cloud of
    fingerprints never becomes all its pairs.
    """
    out = None
    for depth, pairs in node_pairs(spark, prints, budget, limit).items():
        sides = pairs.select("a", "b", "err", F.col("a").alias("node"), F.lit(0).alias("side")).union(
            pairs.where("a <> b").select("a", "b", "err", F.col("b").alias("node"), F.lit(1).alias("side"))
        )
        dealt = sides.join(prints.select(_top("fp", depth).alias("node"), "fp"), "node").drop("node")
        dealt = dealt.repartition(parts_for(spark), "a", "b")  # small rows, much work: not to be merged by size
        found = dealt.groupBy("a", "b").applyInArrow(_links(depth, budget), "a long, b long")
        out = found if out is None else out.union(found)
    return out


def classes(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """(one row for each document: doc_id, fp; one row for each fingerprint: fp, component_id, n documents)."""
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    marked = written(spark, fingerprints(narrow, "text", ["doc_id"]).withColumnRenamed("fingerprint", "fp"), "fingerprints")
    reps = written(spark, marked.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "reps")
    roots = written(spark, components(spark, links(spark, reps.select("fp"), budget)), "roots")
    least = roots.join(reps, roots["node"] == reps["fp"]).groupBy("root").agg(F.min("rep").alias("least"))
    linked = roots.join(least, "root").select(F.col("node").alias("fp"), "least", F.lit(True).alias("linked"))
    of = reps.join(linked, "fp", "left").select("fp", F.when(F.col("linked"), F.col("least")).otherwise(F.col("rep")).alias("component_id"), "n")
    return marked, written(spark, of, "classes")


def near_duplicates(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", budget: int = BUDGET) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id; one row for each document."""
    marked, of = classes(spark, docs, doc_id, text, budget)
    return join_split(marked, of, "fp", "n").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", budget: int = BUDGET) -> DataFrame:
    """One row of ``docs`` for each class, all columns: the least doc_id (nulls last), then the least text hash.

    The winners are found on narrow rows; the texts are only filtered, never shuffled by class.
    """
    row = row_key(docs)
    tagged = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), row.alias("row"))
    marked = written(spark, fingerprints(tagged, "text", ["doc_id", "row"]).withColumnRenamed("fingerprint", "fp"), "fingerprints")
    reps = written(spark, marked.groupBy("fp").agg(F.min("doc_id").alias("rep")), "reps")
    roots = written(spark, components(spark, links(spark, reps.select("fp"), budget)), "roots")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    by_print = marked.groupBy("fp").agg(F.min(rank).alias("first"))
    root = by_print.join(roots, F.col("fp") == F.col("node"), "left").select(F.coalesce("root", "fp").alias("root"), "first")
    best = root.groupBy("root").agg(F.min("first").alias("first"))
    best = best.select(F.col("first.doc_id").alias("w_id"), F.col("first.row").alias("w_row"))
    times = marked.groupBy("doc_id", "row").agg(F.count(F.lit(1)).alias("times"))
    winners = written(spark, best.join(times, F.col("w_id").eqNullSafe(F.col("doc_id")) & (F.col("w_row") == F.col("row"))), "winners")
    key = "\x00row"

    def rows_of(chosen: DataFrame) -> DataFrame:
        chosen = chosen.select(F.col("w_id").alias("\x00id"), F.col("w_row").alias("\x00w"))
        same = (F.col(f"`{key}`") == F.col("`\x00w`")) & F.col(f"`{doc_id}`").eqNullSafe(F.col("`\x00id`"))
        return docs.withColumn(key, row).join(chosen, same, "left_semi")

    kept = rows_of(winners.where("times = 1")).drop(key)
    again = winners.where("times > 1")
    if again.isEmpty():
        return kept
    # Repeated rows of a winner are equal in all columns: one of them stays.
    return kept.union(rows_of(again).dropDuplicates([key]).drop(key))

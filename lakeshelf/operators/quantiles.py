"""Quantiles per key: exact ones by selection, approximate ones from sketches that are kept and merged."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lakeshelf.operators.joins import join_null_safe

PER_OCTAVE = 16  # coarse buckets between a number and its double
FINE = 16_384  # equal steps within a coarse bucket
SKETCH_K = 1024  # items a level of a sketch keeps; ranks are then right to about 0.3 %
RANK_ERROR = 0.01


def _coarse(value: Column) -> Column:
    """A bucket number that grows with the value: steps of its logarithm, mirrored for negative values."""
    x = value.cast("double")

    def steps(size: Column) -> Column:
        # Infinity gets a bucket of its own beyond all finite numbers.
        return F.floor(F.least(F.log2(size) * PER_OCTAVE, F.lit(1e6))).cast("long")

    number = F.when(x > 0, steps(x) + 2_000_000).when(x < 0, -2_000_000 - steps(-x)).otherwise(F.lit(0).cast("long"))
    return F.when(F.isnan(x), F.lit(9_000_000).cast("long")).otherwise(number)


def _fine(value: Column, low: Column, high: Column) -> Column:
    """Which of ``FINE`` equal steps between ``low`` and ``high`` a value lies in; it grows with the value too."""
    x, a, b = (c.cast("double") for c in (value, low, high))
    step = F.least(F.floor(F.try_divide((x - a) * FINE, b - a)), F.lit(FINE - 1))
    return F.coalesce(step, F.lit(0)).cast("long")


def _picked(histogram: DataFrame, group: Sequence[str], wanted: DataFrame | None, quantiles: Mapping[str, float]) -> DataFrame:
    """The bucket of each key that holds the wanted place: (keys, _q, _place, _before, _low, _high).

    ``histogram`` is (group, _b, _n, _low, _high).  Its windows run over buckets, a
    bounded number for each key, not over values.
    """
    whole = Window.partitionBy(*group)
    upto = F.sum("_n").over(whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    here = (F.col("_place") > F.col("_upto") - F.col("_n")) & (F.col("_place") <= F.col("_upto"))
    ends = ["_low", "_high"]
    if wanted is not None:
        summed = histogram.select(*group, "_n", *ends, (upto + F.col("_before")).alias("_upto"))
        kept = [c for c in group if c != "_before"]
        return summed.where(here).select(*kept, (F.col("_upto") - F.col("_n")).alias("_before"), *ends)

    def place(share: float) -> Column:
        exact = F.ceil(F.col("_rows").cast("decimal(18,0)") * F.lit(Decimal(str(share)))).cast("long")
        return F.greatest(exact, F.lit(1).cast("long"))

    summed = histogram.select(*group, "_n", *ends, upto.alias("_upto"), F.sum("_n").over(whole).alias("_rows"))
    places = F.array(*[F.struct(F.lit(q).alias("_q"), place(s).alias("_place")) for q, s in quantiles.items()])
    held = F.filter(places, lambda p: (p["_place"] > F.col("_upto") - F.col("_n")) & (p["_place"] <= F.col("_upto")))
    return summed.select(*group, F.inline(held), (F.col("_upto") - F.col("_n")).alias("_before"), *ends)


def _histogram(rows: DataFrame, group: Sequence[str], bucket: Column, value: str) -> DataFrame:
    return rows.groupBy(*group, bucket.alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(value).alias("_low"), F.max(value).alias("_high")
    )


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The first pass of ``discrete_quantiles`` alone, to be held and given to it for these keys and coarser ones."""
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    return _histogram(rows, keys, _coarse(F.col("_v")), "_v")


def discrete_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float], few_keys: bool = True,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Exact: per key the least value that at least this share of the rows does not exceed.

    Selection instead of sorting.  Rows are counted per key and coarse bucket (map-side
    combine, a bounded number of buckets for each key); the bucket that holds the place is
    cut in fine steps, counted the same way from its rows alone.  A step that holds one value
    is the answer; only where it holds several are its values counted (with money that
    branch is empty, and AQE leaves its scan out).  All of it is one lazy plan.

    NULL values do not count, so a key without values has no row.  NaN is above all numbers.
    ``few_keys`` says that the keys are those of a report, bounded by codes and not by rows: the picked buckets
    (one row for each key and quantile) are then broadcast.  Without it rows meet them in a shuffle.
    ``counted`` is ``value_counts`` of the same rows at these keys or finer ones; the rows are then not passed over for it.
    """
    if not isinstance(df.schema[value].dataType, NumericType):
        raise TypeError(f"{value} is not a number")
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    names = [*keys, "_q", "_place", "_before"]

    def inside(picks: DataFrame) -> DataFrame:
        """The rows within the picked range of their key, beside the pick."""
        renamed = picks.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_q", "_place", "_before", "_low", "_high")
        renamed = F.broadcast(renamed) if few_keys else renamed
        same = F.col("_v").between(F.col("_low"), F.col("_high"))
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        return rows.join(renamed, same)

    coarse = value_counts(df, keys, value) if counted is None else counted.groupBy(*keys, "_b").agg(
        F.sum("_n").alias("_n"), F.min("_low").alias("_low"), F.max("_high").alias("_high")
    )
    first = _picked(coarse, keys, None, quantiles)
    fine = _histogram(inside(first), names, _fine(F.col("_v"), F.col("_low"), F.col("_high")), "_v")
    second = _picked(fine, names, first, quantiles)
    sole = second.where("_low = _high").select(*keys, "_q", F.col("_low").alias("_v"))
    values = _histogram(inside(second.where("_low <> _high")), names, F.col("_v"), "_v")
    third = _picked(values, names, second, quantiles)
    found = sole.unionByName(third.select(*keys, "_q", F.col("_low").alias("_v")))
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("_q") == q, F.col("_v"))).alias(q) for q in quantiles])


# --- sketches -----------------------------------------------------------------------


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = SKETCH_K) -> DataFrame:
    """(keys, rows, sketch): a sketch of bounded size for each key, to be kept in a table.

    ``rows`` counts the values that are not NULL; a key without any has an empty sketch.
    """
    number = F.col(value).cast("double")
    return df.groupBy(*keys).agg(F.count(number).alias("rows"), F.kll_sketch_agg_double(number, F.lit(k)).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """(keys, rows, sketch) of coarser keys from sketches of finer ones; no row of the data is read again."""
    full = sketches.where("rows > 0")
    return full.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, keys: Sequence[str], quantiles: Mapping[str, float]) -> DataFrame:
    """(keys, rows, quantiles): each estimate's rank is within ``RANK_ERROR`` of the share asked for."""
    full = sketches.where("rows > 0")
    return full.select(*keys, "rows", *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias(n) for n, q in quantiles.items()])


def rank_errors(df: DataFrame, keys: Sequence[str], value: str, estimates: DataFrame, quantiles: Mapping[str, float]) -> DataFrame:
    """(keys, one column for each quantile): how far the estimate's true rank is from the share asked for.

    The rank of a value that repeats is a range, from the rows below it to the rows up to it.
    """
    both = join_null_safe(df.where(F.col(value).isNotNull()), F.broadcast(estimates.select(*keys, *quantiles)), keys)
    rows = F.count(F.lit(1))

    def off(name: str, share: float) -> Column:
        below = F.count_if(F.col(value) < F.col(name)) / rows
        upto = F.count_if(F.col(value) <= F.col(name)) / rows
        return F.greatest(below - share, share - upto, F.lit(0.0)).alias(name)

    return both.groupBy(*keys).agg(*[off(n, q) for n, q in quantiles.items()])

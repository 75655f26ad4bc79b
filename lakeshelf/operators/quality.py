"""Data-quality rules: one row per rule, checked before a write."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshelf.functions.measures import null_counts


@dataclass(frozen=True)
class Rule:
    """An aggregate that must satisfy ``holds(observed, allowed)``."""

    name: str
    observed: Column
    allowed: float
    holds: Callable[[Column, Column], Column]


def at_most(name: str, observed: Column, allowed: float) -> Rule:
    return Rule(name, observed, allowed, lambda seen, limit: seen <= limit)


def at_least(name: str, observed: Column, allowed: float) -> Rule:
    return Rule(name, observed, allowed, lambda seen, limit: seen >= limit)


def equal_to(name: str, observed: Column, allowed: float) -> Rule:
    return Rule(name, observed, allowed, lambda seen, limit: seen == limit)


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, observed, allowed, passed), all rules from one scan; NULL does not pass."""
    seen = df.agg(*[r.observed.cast("double").alias(f"o{i}") for i, r in enumerate(rules)])
    rows = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.col(f"o{i}").alias("observed"),
            F.lit(float(r.allowed)).alias("allowed"),
            F.coalesce(r.holds(F.col(f"o{i}"), F.lit(float(r.allowed))), F.lit(False)).alias("passed"),
        )
        for i, r in enumerate(rules)
    ]
    return seen.select(F.inline(F.array(*rows)))


class QualityError(ValueError):
    """At least one rule does not hold."""


def enforce(outcomes: DataFrame) -> None:
    """Raise with the rules that do not hold; ``outcomes`` has one row per rule."""
    broken = outcomes.where(~F.col("passed")).collect()
    if broken:
        raise QualityError(
            "; ".join(f"{r['rule']}: {r['observed']} against {r['allowed']}" for r in broken)
        )


def row_counts(**layers: DataFrame) -> DataFrame:
    """(layer, rows) for each named frame."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows")
        for name, df in layers.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def reconcile(source: DataFrame, written: DataFrame) -> DataFrame:
    """One row: rows on each side, the difference and whether there is none."""
    sides = row_counts(source=source, written=written)
    counts = sides.agg(
        F.sum(F.when(F.col("layer") == "source", F.col("rows"))).alias("source_rows"),
        F.sum(F.when(F.col("layer") == "written", F.col("rows"))).alias("written_rows"),
    )
    return counts.withColumns(
        {
            "removed": F.col("source_rows") - F.col("written_rows"),
            "passed": F.col("source_rows") == F.col("written_rows"),
        }
    )


def null_report(df: DataFrame, columns: Sequence[str] | None = None, top: int = 10) -> DataFrame:
    """Columns with most NULLs; metadata columns (leading underscore) are left out."""
    names = [c for c in (columns or df.columns) if not c.startswith("_")]
    return null_counts(df, names).orderBy(F.col("nulls").desc(), "column_name").limit(top)


def codes_with_many_labels(df: DataFrame, code: str, label: str) -> DataFrame:
    """Codes that carry more than one label, with how many."""
    labels = df.groupBy(code).agg(F.count_distinct(label).alias("labels"))
    return labels.where(F.col("labels") > 1)

"""Aggregation shapes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from haulmark.functions.numbers import ratio
from haulmark.operators.pick import top_k


def summarise(df: DataFrame, by: Sequence, **aggregates: Column) -> DataFrame:
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in aggregates.items()])


def count_when(cond: Column) -> Column:
    """Rows where the condition holds; 0 for none."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def distinct_when(df: DataFrame, by: Sequence[str], ident: str, flags: Mapping[str, Column],
                  total: str | None = None) -> DataFrame:
    """Many conditional distinct counts in one pass.

    One row per (group, id) with the OR of each flag, then a sum. This avoids
    multiplying the input by the number of distinct counts.
    """
    marks = {n: F.max(F.when(c, F.lit(1)).otherwise(F.lit(0))) for n, c in flags.items()}
    per_id = df.groupBy(*by, ident).agg(*[c.alias(n) for n, c in marks.items()])
    known = F.col(ident).isNotNull()
    out = [F.sum(F.when(known, F.col(n)).otherwise(F.lit(0))).alias(n) for n in flags]
    if total:
        out.append(F.count(ident).alias(total))
    return per_id.groupBy(*by).agg(*out)


def milestones(log: DataFrame, key: str, ts: str, spec: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """First or last time per named condition: ``{name: ("min" | "max", condition)}``."""
    pick = {"min": F.min, "max": F.max}
    return log.groupBy(key).agg(*[pick[how](F.when(cond, F.col(ts))).alias(n) for n, (how, cond) in spec.items()])


def weekday_pivot(df: DataFrame, by: Sequence[str], week: str, day: str, value: str) -> DataFrame:
    """Seven columns monday..sunday by distance from the week start."""
    # Column names in week order.
    names = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
    gap = F.datediff(F.col(day), F.col(week))
    return df.groupBy(*by).agg(*[F.sum(F.when(gap == i, F.col(value))).alias(n) for i, n in enumerate(names)])


def first_k_columns(df: DataFrame, by: Sequence[str], order: Sequence, value: str, k: int = 10,
                    prefix: str = "fr_") -> DataFrame:
    """The first ``k`` values per group spread over ``k`` columns."""
    numbered = top_k(df, by, order, k, "_rn")
    return numbered.groupBy(*by).agg(
        *[F.max(F.when(F.col("_rn") == i, F.col(value))).alias(f"{prefix}{i}") for i in range(1, k + 1)])


def with_total(df: DataFrame, by: str, sums: Mapping[str, Column], label: str = "Total",
               ratios: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Per-group rows and one total row; ratios are taken after summing.

    An empty input gives a total row with null sums, as an aggregate without keys does.
    """
    grouped = df.rollup(by).agg(F.grouping_id().alias("_g"), *[c.alias(n) for n, c in sums.items()])
    named = grouped.withColumn(by, F.when(F.col("_g") == 1, F.lit(label)).otherwise(F.col(by))).drop("_g")
    return named.withColumns({n: ratio(a, b) for n, (a, b) in (ratios or {}).items()})


def share_by(df: DataFrame, by: Sequence[str], cond: Column) -> DataFrame:
    """Group size, matching rows and whole-percent share."""
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total_count"), F.count_if(cond).alias("failed_count"))
    return out.withColumn("failed_rate", F.call_function(
        "div", F.col("failed_count") * 100, F.col("total_count")).cast("int"))

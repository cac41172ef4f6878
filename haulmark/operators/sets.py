"""Set operations and ordering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Stack by name and drop repeats, also those inside one branch."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()


def union_all(*frames: DataFrame) -> DataFrame:
    """Stack by name; columns missing in a branch are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def pad_nulls(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add typed null columns."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items()})


def ordered(df: DataFrame, *order: Column | str) -> DataFrame:
    """Global order for a report; use it at the sink only. Descending puts nulls first."""
    cols = [F.desc_nulls_first(o[1:]) if isinstance(o, str) and o.startswith("-")
            else F.asc_nulls_last(o) if isinstance(o, str) else o for o in order]
    return df.orderBy(*cols)


def label_first(df: DataFrame, column: str, label: str = "Total", then: Sequence = ()) -> DataFrame:
    """Sort with one label ahead of all others."""
    return df.orderBy(F.when(F.col(column) == label, 0).otherwise(1), F.asc_nulls_last(column), *then)


def head(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First ``n`` rows of a total order."""
    return ordered(df, *order).limit(n)

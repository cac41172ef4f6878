"""Projection, masking, null handling and filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def project(df: DataFrame, columns: Sequence[str] | None = None, renames: Mapping[str, str] | None = None,
            computed: Mapping[str, Column] | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """Keep, compute, rename, drop; in that order."""
    out = df.select(*columns) if columns else df
    if computed:
        out = out.withColumns(dict(computed))
    if renames:
        out = out.withColumnsRenamed(dict(renames))
    return out.drop(*drop) if drop else out


def mask_update(df: DataFrame, cond: Column, values: Mapping[str, object]) -> DataFrame:
    """Set columns where ``cond`` holds; an unknown condition leaves the row as it is."""
    return df.withColumns({
        c: F.when(cond, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c))
        for c, v in values.items()})


def drop_any_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(columns) if columns else None)


def fill_null(df: DataFrame, value, columns: Sequence[str] | None = None) -> DataFrame:
    """Typed fill: a number fills numeric columns only."""
    return df.na.fill(value, subset=list(columns) if columns else None)


def coalesce_from(df: DataFrame, columns: Iterable[str], suffix: str = "_fill") -> DataFrame:
    """Where ``c`` is null take ``c + suffix``, then drop the second source."""
    columns = list(columns)
    return (df.withColumns({c: F.coalesce(F.col(c), F.col(c + suffix)) for c in columns})
              .drop(*[c + suffix for c in columns]))


def like_any(c, marks: Iterable[str], ignore_case: bool = True) -> Column:
    """True when any mark occurs in the text."""
    col = F.col(c) if isinstance(c, str) else c
    text = F.lower(col) if ignore_case else col
    out = F.lit(False)
    for m in marks:
        out = out | text.contains(m.lower() if ignore_case else m)
    return out


def all_days(df: DataFrame, start: Column, end: Column, out: str = "day") -> DataFrame:
    """Repeat every row once per day of [start, end]: a calendar without a cross join."""
    days = F.sequence(start.cast("date"), end.cast("date"), F.expr("INTERVAL '1' DAY"))
    return df.withColumn(out, F.explode(days))


def with_rows(df: DataFrame, rows: Sequence[Sequence], names: Sequence[str]) -> DataFrame:
    """Pair each row with every row of a short literal list."""
    items = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rows])
    exploded = df.withColumn("_row", F.explode(items))
    return exploded.select(*df.columns, *[F.col(f"_row.{n}").alias(n) for n in names])

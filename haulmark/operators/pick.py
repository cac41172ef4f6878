"""Pick one row per key, drop repeats, collapse runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from haulmark.operators.ordered import lag, running


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key under a total order.

    The row_number filter becomes a per-partition group limit before the shuffle,
    so a frequent key sends one row per task.
    """
    if not order:
        raise ValueError("a total order is required; add the unique id")
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], k: int,
          number: str = "rn") -> DataFrame:
    """The first ``k`` rows per key, numbered."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(number, F.row_number().over(w)).filter(F.col(number) <= k)


def rank_top(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """All rows that share the first rank."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rk", F.rank().over(w)).filter("_rk = 1").drop("_rk")


def latest_value(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A few columns of the last row per key, by plain aggregation."""
    last = F.max_by(F.struct(*columns), F.struct(*order))
    return df.groupBy(*keys).agg(last.alias("_l")).select(*keys, *[F.col(f"_l.{c}").alias(c) for c in columns])


def keep_argmax(df: DataFrame, keys: Sequence[str], ts: str, tie: str) -> DataFrame:
    """Row with the greatest ``ts``; the first such row by ``tie``. Null keys and times are left out."""
    kept = df.dropna(subset=[*keys, ts])
    return distinct_on(kept, keys, [F.desc(ts), F.asc(tie)])


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


def collapse_runs(df: DataFrame, keys: Sequence[str], ts: str, tie: str, state: str,
                  states: Sequence[str] | None = None, hot="auto") -> DataFrame:
    """Keep the first row of each run of equal states, looking at ``states`` only."""
    rows = df.filter(F.col(state).isin(list(states))) if states else df
    out = running(rows, keys, ts, [tie], hot=hot, _prev=lag(state))
    return out.filter(F.col("_prev").isNull() | (F.col("_prev") != F.col(state))).drop("_prev")


def max_dims(df: DataFrame, key: str = "shipment_awb") -> DataFrame:
    """Largest volume and weight per parcel."""
    return df.groupBy(key).agg(
        F.max(F.col("length") * F.col("breadth") * F.col("height")).alias("dwh_volume"),
        F.max("weight").alias("dwh_weight"))

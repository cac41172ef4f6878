"""Table changes as new tables: every function returns the full next state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from haulmark.operators.quality import require_unique
from haulmark.operators.skew import salted_join


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str], update_when: Column | None = None,
           update: bool = True, exclude: Sequence[str] = ()) -> DataFrame:
    """Insert new keys, update known ones.

    ``update_when`` may use ``t.<col>`` and ``s.<col>``; where it is not true the
    old row stays. ``update=False`` leaves known keys alone. Columns in ``exclude``
    are never written: they stay as they are, and are null in new rows. Repeated
    source rows are dropped; two different source rows for one key raise when the job runs.
    """
    key = list(key)
    columns = [c for c in target.columns if c not in exclude and c in source.columns]
    fresh = require_unique(source.select(*columns).distinct(), key)
    s = fresh.withColumn("_s", F.lit(True)).alias("s")
    t = target.withColumn("_t", F.lit(True)).alias("t")
    cond = None
    for k in key:
        c = F.col(f"t.{k}") == F.col(f"s.{k}")
        cond = c if cond is None else cond & c
    is_new = F.col("_t").isNull()
    changes = F.col("_s").isNotNull() & F.lit(update)
    if update_when is not None:
        changes = changes & F.coalesce(update_when, F.lit(False))
    take = is_new | changes
    out = [F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) if c in columns
           else F.col(f"t.{c}").alias(c) for c in target.columns]
    return t.join(s, cond, "full").select(*out)


def update_where(df: DataFrame, cond: Column, values: Mapping[str, object]) -> DataFrame:
    from haulmark.operators.shape import mask_update
    return mask_update(df, cond, values)


def updated_rows(df: DataFrame, cond: Column, values: Mapping[str, object]) -> DataFrame:
    """The changed rows only, after the change."""
    return update_where(df.filter(cond), F.lit(True), values)


def update_from(target: DataFrame, source: DataFrame, key: Sequence[str], columns: Sequence[str], hot="auto") -> DataFrame:
    """Take ``columns`` from the matching source row (one per key), also when it is null there."""
    key = list(key)
    s = require_unique(source.select(*key, *[F.col(c).alias(f"_new_{c}") for c in columns]), key)
    joined = salted_join(target, s.withColumn("_hit", F.lit(True)), key, "left", hot=hot)
    return joined.select(*[
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in target.columns])


def recompute_totals(df: DataFrame, totals: Mapping[str, Sequence[str]]) -> DataFrame:
    """Each total is the sum of its parts; a null part makes it null."""
    def add(parts):
        out = F.col(parts[0])
        for p in parts[1:]:
            out = out + F.col(p)
        return out
    return df.withColumns({n: add(list(parts)) for n, parts in totals.items()})


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """Rows for which the condition is not true stay."""
    return df.filter(~F.coalesce(cond, F.lit(False)))


def delete_in(df: DataFrame, cond: Column, column: str, listed: DataFrame, hot="auto") -> DataFrame:
    """Delete rows that meet ``cond`` and whose ``column`` is in the list."""
    hit = listed.select(F.col(column).alias(column)).dropna().distinct().withColumn("_hit", F.lit(True))
    joined = salted_join(df, hit, [column], "left", hot=hot)
    gone = F.coalesce(cond, F.lit(False)) & F.col("_hit").isNotNull()
    return joined.filter(~gone).select(*df.columns)


def evolve_schema(df: DataFrame, renames: Mapping[str, str] | None = None,
                  types: Mapping[str, str] | None = None, order: Sequence[str] | None = None) -> DataFrame:
    out = df.withColumnsRenamed(dict(renames)) if renames else df
    if types:
        out = out.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
    return out.select(*order) if order else out

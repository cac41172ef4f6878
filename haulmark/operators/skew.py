"""Hot keys: find them once, and join without sending one key's rows to one task.

A key is hot when it holds at least ``min_rows`` rows. Keys are counted exactly,
once per table and key: the list is written below the shared folder and read back,
so a re-run task sees the same list, its size is known to the planner, and it can
be passed on to every step that uses the key. At most rows / ``min_rows`` keys can
be hot, which bounds the list; no key is left off. The list only decides how rows
are placed, never which rows are kept, so a list counted on a base table also serves
frames made from it.
"""

from __future__ import annotations

import weakref
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from haulmark import files
from haulmark.session import discard, written

HOT_MIN_ROWS = 2_000_000

_listed: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int | None = None) -> DataFrame:
    """Keys with many rows and their ``hot_parts``: the number of tasks that share them."""
    return _counted(df, keys, HOT_MIN_ROWS if min_rows is None else min_rows).drop("hot_rows")


def _counted(df: DataFrame, keys: Sequence[str], min_rows: int) -> DataFrame:
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("hot_rows")).filter(F.col("hot_rows") >= min_rows)
    return counted.select(*keys, (F.floor(F.col("hot_rows") / min_rows) + 1).cast("int").alias("hot_parts"), "hot_rows")


def resolve_hot(df: DataFrame, keys: Sequence[str], hot) -> DataFrame | None:
    """The list to use: ``"auto"`` counts the keys of ``df`` now, an int sets the row limit, None means groups are bounded.

    Gives None when no key is hot, so that plans without hot keys stay plain. Give ``"auto"`` a
    base table, not a joined frame: it is read once for the count.
    """
    if hot is None or isinstance(hot, DataFrame):
        return hot
    limit = HOT_MIN_ROWS if hot == "auto" else int(hot)
    known = _listed.setdefault(df.sparkSession, {})
    narrow = df.select(*keys)
    # Size of the input along with the plan: a table that was added to is counted again.
    size = str(narrow._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    name = (narrow.semanticHash(), tuple(keys), limit, size)
    if name in known and known[name] is not None and not files.exists(df.sparkSession, known[name]._written_to):
        del known[name]
    if name not in known:
        stored = written(_counted(narrow, keys, limit), "hot")
        known[name] = None if stored.isEmpty() else stored
        if known[name] is None:
            discard(stored)
    return known[name]


def forget(spark: SparkSession) -> None:
    """Drop all lists of the session; frames that use one must not be run any more."""
    for stored in _listed.pop(spark, {}).values():
        if stored is not None:
            discard(stored)


def mark_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame, parts: str = "_parts") -> DataFrame:
    """Add the number of parts of each row's key, null for ordinary keys; null keys are matched too."""
    listed = hot.select(*[F.col(k).alias(f"_hk{i}") for i, k in enumerate(keys)], F.col("hot_parts").alias(parts))
    cond = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"_hk{i}"))
        cond = c if cond is None else cond & c
    return df.join(listed, cond, "left").drop(*[f"_hk{i}" for i in range(len(keys))])


def salt(columns: Sequence[str], parts: Column) -> Column:
    """One of ``parts`` numbers for each row, by its content."""
    # The partition id spreads exact copies of a row; it is the same when a task is run again.
    return F.pmod(F.xxhash64(*columns) + F.spark_partition_id(), parts).cast("int")


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                hot: DataFrame | str | int | None = "auto") -> DataFrame:
    """Equi join whose left side may hold a few very frequent keys.

    Rows of a hot key on the left are spread over as many tasks as its rows ask
    for, and only the right rows of those keys are repeated. ``how`` is inner,
    left, left_semi or left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join does not support {how!r}")
    listed = resolve_hot(left, on, hot)
    if listed is None:
        return left.join(right, list(on), how)
    parts = F.col("_parts")
    spread = F.when(parts.isNotNull(), salt(left.columns, parts)).otherwise(F.lit(0))
    copies = F.when(parts.isNotNull(), F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.lit(0)))
    lhs = mark_hot(left, on, listed).withColumn("_salt", spread).drop("_parts")
    rhs = mark_hot(right, on, listed).withColumn("_salt", F.explode(copies)).drop("_parts")
    return lhs.join(rhs, [*on, "_salt"], how).drop("_salt")

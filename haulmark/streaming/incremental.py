"""Changed keys, full-history recompute, upsert by key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from haulmark.operators.mutate import upsert
from haulmark.operators.skew import salted_join
from haulmark.session import written
from haulmark.sources.readers import changed_keys
from haulmark.sources.writers import upsert_partitions


def history_of(log: DataFrame, keys: DataFrame, key: str, hot="auto") -> DataFrame:
    """Every row of the changed keys. A runtime filter on the key prunes the log before the shuffle."""
    return salted_join(log, keys, [key], "left_semi", hot=hot)


def incremental_recompute(target: DataFrame, log: DataFrame, compute: Callable[[DataFrame], DataFrame], key: str,
                          ts_cols: Sequence[str], as_of, hours: float = 4,
                          exclude: tuple[str, Sequence] | None = None, update_when: Column | None = None,
                          hot="auto") -> DataFrame:
    """Next state of ``target`` as a frame: changed keys recomputed from their whole history, the rest untouched.

    For a table that is stored in partitions use :func:`refresh_partitions`, which leaves the other partitions alone.
    """
    keys = changed_keys(log, key, ts_cols, as_of, hours, exclude)
    fresh = compute(history_of(log, keys, key, hot))
    return upsert(target, fresh, [key], update_when)


def bucket_of(key: str, buckets: int) -> Column:
    """Partition value of a key: the same for every row of the key."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, key: str, buckets: int, column: str = "bucket") -> None:
    """Store a table or log in partitions by bucket of its key."""
    df.withColumn(column, bucket_of(key, buckets)).repartition(buckets, column).write.mode("overwrite").partitionBy(column).parquet(path)


def refresh_partitions(spark: SparkSession, target: str, log: str, compute: Callable[[DataFrame], DataFrame], key: str,
                       ts_cols: Sequence[str], as_of, hours: float = 4, exclude: tuple[str, Sequence] | None = None,
                       update_when: Column | None = None, hot="auto", column: str = "bucket") -> list:
    """Bring a stored table up to date with a stored log, both in partitions by the same bucket of the key.

    The changed keys are found from the time columns alone. Only log partitions that hold one of
    them are read for their history, and only those target partitions are read and rewritten;
    their values are returned. The new rows are written before the target is touched, so a run
    that breaks off can be repeated.
    """
    rows = spark.read.parquet(log)
    keys = written(changed_keys(rows, key, ts_cols, as_of, hours, exclude, also=[column]), "keys")
    values = [r[0] for r in keys.select(column).distinct().collect()]  # one per partition at most
    history = history_of(rows.filter(F.col(column).isin(values)), keys.select(key), key, hot)
    fresh = written(compute(history.drop(column)).join(keys, key), "fresh")
    return upsert_partitions(target, fresh, [key], column, update_when)

"""A log and a table stored by the day their keys began, so that what changes together lies together.

Changes of the last hours belong mostly to keys that began lately. Here every row of a key is stored under the key's *home*: the
period of its first row. A refresh then rewrites the few recent periods, however many keys have changed, whereas a
layout by hash of the key spreads any larger change set over all partitions.

A key's home must not move when older rows of it turn up later, so it is looked up: ``homes`` has one row (key, home) per key,
in folders by batch. ``append`` gives the rows of a batch the homes of their keys and adds homes for keys that are new.
The lookup is read once per batch, two columns of it; changed keys carry their home in the log, so a refresh needs no lookup.

    path/homes/batch=<n>         key, home
    path/log/batch=<n>/home=<p>  the rows of a batch
    path/table/home=<p>          what is computed from the log, one row per key
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from haulmark import files
from haulmark.operators.skew import salted_join
from haulmark.session import discard, written
from haulmark.sources.readers import changed_keys
from haulmark.sources.writers import upsert_partitions

HOME = "home"
#: Period of keys none of whose rows has a time when the first of them arrives.
NO_HOME = "1900-01-01"


def period_of(ts: str, unit: str = "day") -> Column:
    """First day of the period a time lies in."""
    return F.to_date(F.date_trunc(unit, F.col(ts).cast("timestamp_ntz")))


def append(spark: SparkSession, path: str, rows: DataFrame, key: str, ts: str, batch: int, unit: str = "day", hot="auto") -> None:
    """Add a batch of log rows. A batch that is repeated replaces its own rows and homes.

    ``unit`` is the length of a period (day, week, month) and must stay the same. A null key has a home like any other key, and may
    hold any share of the rows: within a period they are dealt by content. ``rows`` is read twice.
    """
    firsts = rows.groupBy(key).agg(F.coalesce(F.min(period_of(ts, unit)), F.lit(NO_HOME).cast("date")).alias("_first"))
    if batch > 0 and files.exists(spark, f"{path}/homes"):
        known = spark.read.option("basePath", f"{path}/homes").parquet(f"{path}/homes").filter(F.col("batch") < batch).select(F.col(key).alias("_key"), F.col(HOME).alias("_home"))
        firsts = firsts.join(known, F.col(key).eqNullSafe(F.col("_key")), "left")
    else:
        firsts = firsts.withColumn("_home", F.lit(None).cast("date"))
    homes = written(firsts.select(key, F.coalesce("_home", "_first").alias(HOME), F.col("_home").isNull().alias("_new")), "homes")
    homes.filter("_new").select(key, HOME).write.mode("overwrite").parquet(f"{path}/homes/batch={batch}")
    # Null keys match nothing in a join on equality: their one home is taken apart.
    nobody = homes.filter(F.col(key).isNull()).select(HOME).first()
    placed = salted_join(rows.filter(F.col(key).isNotNull()), homes.select(key, HOME), [key], "inner", hot=hot)
    if nobody is not None:
        placed = placed.unionByName(rows.filter(F.col(key).isNull()).withColumn(HOME, F.lit(nobody[0])))
    placed.write.mode("overwrite").partitionBy(HOME).parquet(f"{path}/log/batch={batch}")
    discard(homes)


def read_log(spark: SparkSession, path: str, homes: Sequence | None = None) -> DataFrame:
    """Rows of the log with their home; of the listed homes only, if given: other folders are not opened."""
    log = spark.read.option("basePath", f"{path}/log").parquet(f"{path}/log").drop("batch")
    return log if homes is None else log.filter(F.col(HOME).isin(list(homes)))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/table")


def build(spark: SparkSession, path: str, compute: Callable[[DataFrame], DataFrame], key: str) -> None:
    """Compute the whole table once. ``compute`` gives one row per key that it is given rows of."""
    log = read_log(spark, path)
    table = compute(log.drop(HOME))
    _with_home(table, log.groupBy(key).agg(F.min(HOME).alias(HOME)), key).write.mode("overwrite").partitionBy(HOME).parquet(f"{path}/table")


def _with_home(table: DataFrame, homes: DataFrame, key: str) -> DataFrame:
    named = homes.select(F.col(key).alias("_key"), HOME)
    return table.join(named, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")


def refresh(spark: SparkSession, path: str, compute: Callable[[DataFrame], DataFrame], key: str, ts_cols: Sequence[str], as_of, hours: float = 4,
            exclude: tuple[str, Sequence] | None = None, update_when: Column | None = None, hot="auto") -> list:
    """Bring the table up to date with the log; returns the homes whose partitions were rewritten.

    Changed keys come from the time columns alone, with their homes. Only the log of those homes is read for the keys'
    whole history, and only those partitions of the table are read and written. New rows are written before the table
    is touched, so a run that breaks off can be repeated. Null keys have no history that could be told apart and are not refreshed.
    """
    log = read_log(spark, path)
    keys = written(changed_keys(log, key, ts_cols, as_of, hours, exclude, also=[HOME]).filter(F.col(key).isNotNull()), "keys")
    homes = [r[0] for r in keys.select(HOME).distinct().collect()]  # one per period at most
    if not homes:
        return homes
    history = salted_join(read_log(spark, path, homes).drop(HOME), keys.select(key), [key], "left_semi", hot=hot)
    fresh = written(_with_home(compute(history), keys, key), "fresh")
    upsert_partitions(f"{path}/table", fresh, [key], HOME, update_when)
    discard(keys)
    discard(fresh)
    return homes

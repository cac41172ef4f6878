"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulmark.session import discard, shared_folder  # noqa: F401

#: A word is a run of anything but blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
#: Rows in a batch between Spark and its Python workers.
BATCH_ROWS = 512


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per session, so that functions run there wherever it is installed.

    Also keeps Arrow batches short: rows hold whole texts, and a worker's memory should not follow the longest of them.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_haulmark_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(), "haulmark.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._haulmark_shipped = True


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one that all executors share."""
    return f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex[:12]}-{name}"


def table(df: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared folder of the cluster and read it back.

    Cuts the lineage: what follows reads files every executor can reach, so a lost executor costs only its own tasks.
    """
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, though ``body`` may name it many times and inside lambdas."""
    return F.transform(F.array(value), body)[0]


def rank_within(rows: DataFrame, keys: list[str], order: list[str], out: str, group_rows: int = 4096,
                few_keys: bool = False) -> DataFrame:
    """Number the rows of each key from 0, by a hash of ``order``; equal hashes follow ``order``.

    ``rows`` must be a written table, as it is read three times. A key of n rows is cut into about n / ``group_rows``
    groups by the hash, so one key may hold any share of all rows: counts of groups give each group its first number,
    and only groups are sorted. Rows alike in all columns of ``order`` share a group and take its numbers in any order.
    Key columns must hold no nulls. ``few_keys`` says that the number of keys has a bound of its own (shards, lengths),
    so their counts may be broadcast.
    """
    h = F.xxhash64(*order)
    per_key = rows.groupBy(*keys).agg(F.count("*").alias("__n"))
    cut = (rows.join(F.broadcast(per_key) if few_keys else per_key, keys)
           .withColumn("__h", h)
           .withColumn("__b", F.pmod(F.col("__h"), F.ceil(F.col("__n") / F.lit(group_rows)).cast("long")))
           .drop("__n"))
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    first = (cut.groupBy(*keys, "__b").agg(F.count("*").alias("__c"))
             .withColumn("__first", F.coalesce(F.sum("__c").over(before), F.lit(0))).drop("__c"))
    inside = Window.partitionBy(*keys, "__b").orderBy("__h", *order)
    return (cut.join(first, [*keys, "__b"])
            .withColumn(out, F.col("__first") + F.row_number().over(inside) - 1)
            .drop("__h", "__b", "__first"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): one row (node, root) per node that has an edge.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its smallest one, then its
    smaller neighbours and itself. ``root`` is the smallest node of the component. No component is gathered anywhere;
    each round is written, so a lost executor repeats only tasks of the running round.
    """
    def small_of(rows):
        return rows.groupBy("u").agg(F.min("v").alias("m"))

    def state(e):
        # The number of edges and an order-free sum over them: both stay the same only when the edges do.
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    hi, lo = F.greatest("a", "b"), F.least("a", "b")
    now = table(edges.filter(F.col("a") != F.col("b")).select(hi.alias("u"), lo.alias("v")).distinct(), "edges")
    seen = state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(small_of(both).withColumn("m", F.least("u", "m")), "u")
                 .filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter(F.col("u") != F.col("v")).distinct())
        large = table(large, "large")
        small = (large.join(small_of(large), "u").filter(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small_of(large).select("u", F.col("m").alias("v"))).distinct())
        now = table(small, "small")
        last, seen = seen, state(now)
        if last == seen:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

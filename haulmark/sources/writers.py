"""Writing: materialized tables, appends, delimited files, partitioned reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from haulmark.operators.quality import is_unique
from haulmark.session import cut_lineage


def materialize(df: DataFrame, path: str, key: Sequence[str] | None = None,
                partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a Parquet table, failing when ``key`` repeats, and return it as read back.

    The rows go to a folder next to the table first and take its place when the
    write has succeeded; ``df`` may therefore read the table it replaces. The key is
    checked on the written rows, reading its columns only; a key with a null repeats nothing.
    """
    spark = df.sparkSession
    staged, previous = f"{path}__next", f"{path}__previous"
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(staged)
    if key and not is_unique(spark.read.parquet(staged).dropna(subset=list(key)), key):
        raise ValueError(f"key {list(key)} is not unique in {staged}")
    swap(spark, staged, path, previous)
    return spark.read.parquet(path)


def swap(spark: SparkSession, staged: str, path: str, previous: str) -> None:
    """Rename the staged folder into place; the former content is kept until the next swap."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    live = hadoop.Path(path)
    fs = live.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(live):
        fs.delete(hadoop.Path(previous), True)
        fs.rename(live, hadoop.Path(previous))
    fs.rename(hadoop.Path(staged), live)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def align(df: DataFrame, columns: Sequence[str], types: dict[str, str]) -> DataFrame:
    """Match columns by name; columns not given become typed nulls, unknown ones are refused."""
    extra = [c for c in df.columns if c not in types]
    if extra:
        raise ValueError(f"columns not in the table: {extra}")
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(types[c]).alias(c) for c in columns])


def insert_select(target: DataFrame, rows: DataFrame) -> DataFrame:
    """The table with the rows added, aligned by name."""
    return target.unionByName(align(rows, target.columns, dict(target.dtypes)))


def copy_delimited(df: DataFrame, path: str, sep: str = "\t", header: bool = True) -> None:
    df.write.mode("overwrite").option("sep", sep).option("header", header).csv(path)


def load_delimited(spark: SparkSession, path: str, schema, sep: str = "\t", header: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("sep", sep).option("header", header).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_partitioned_report(df: DataFrame, path: str, by: Sequence[str] = ("city", "hub")) -> None:
    """One folder with one file per group; group columns leave the content.

    The rows of a group come together in one task; use it after aggregation, where groups
    are report sized.
    """
    df.repartition(*by).write.mode("overwrite").partitionBy(*by).option("header", True).csv(path)


def ctas_reordered(df: DataFrame, table: str, columns: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """A new version with another column order, sorted inside its files."""
    return materialize(df.select(*columns).sortWithinPartitions(*order_by), table)


def upsert_partitions(path: str, source: DataFrame, key: Sequence[str], partition: str, update_when=None) -> list:
    """Upsert into a partitioned Parquet table, rewriting only the partitions the source touches, which it returns.

    A key must always carry the same partition value (a creation day, say, or a bucket of the
    key). ``source`` should be a written table. The values it touches, at most one per
    partition of the table, become a filter on the partition column, so other partitions are
    neither listed, read nor written.
    """
    from haulmark.operators.mutate import upsert

    spark = source.sparkSession
    values = [r[0] for r in source.select(partition).distinct().collect()]
    if not values:
        return values
    target = spark.read.parquet(path)
    touched = target.filter(F.col(partition).isin(values) | (F.col(partition).isNull() & F.lit(None in values)))
    merged = cut_lineage(upsert(touched, source, key, update_when))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    return values

"""Reading: named tables, SQL texts, CSV masters, calendars, inline rows, look-back keys."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from haulmark.functions import clock
from haulmark.functions.text import parse_money


def scan(spark: SparkSession, name: str, columns: Sequence[str] | None = None, root: str | None = None) -> DataFrame:
    """A registered table, or ``root/name`` as Parquet; only the listed columns are read."""
    if root is None:
        df = spark.table(name)
    else:
        path = f"{root.rstrip('/')}/{name}"
        df = spark.read.parquet(path if name.endswith(".parquet") else f"{path}.parquet")
    return df.select(*columns) if columns else df


def read_query(spark: SparkSession, sql: str, params: Mapping[str, object] | None = None, **frames: DataFrame) -> DataFrame:
    """Run a SQL text. ``:name`` marks take ``params``; ``{name}`` marks take ``frames``."""
    return spark.sql(sql, args=dict(params or {}), **frames)


def read_sql_file(spark: SparkSession, path: str, params: Mapping[str, object] | None = None, **frames: DataFrame) -> DataFrame:
    """The text of a .sql file as a query. The file is small by nature and read where the query is planned."""
    with open(path, encoding="utf-8") as f:
        return read_query(spark, f.read().strip().rstrip(";"), params, **frames)


def read_master_csv(spark: SparkSession, path: str, schema: T.StructType | str, money: Sequence[str] = (),
                    day_first: Sequence[str] = ()) -> DataFrame:
    """A CSV master: money columns arrive as text and leave as decimals, dd/MM/yyyy columns as dates."""
    df = spark.read.schema(schema).option("header", True).option("quote", '"').csv(path)
    out = {c: parse_money(c) for c in money}
    out.update({c: F.try_to_timestamp(F.col(c), F.lit("dd/MM/yyyy")).cast("date") for c in day_first})
    return df.withColumns(out) if out else df


TABULAR = {".csv": "csv", ".tsv": "csv", ".parquet": "parquet", ".json": "json", ".orc": "orc"}


def read_tabular(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Pick the reader by file extension. Workbooks must be exported to CSV first."""
    extension = os.path.splitext(path.rstrip("/"))[1].lower()
    if extension in (".xls", ".xlsx"):
        raise ValueError("workbooks are not read directly; export the sheet as CSV")
    if extension not in TABULAR:
        raise ValueError(f"no reader for {extension or 'a path without extension'!r}")
    reader = spark.read.format(TABULAR[extension])
    if extension in (".csv", ".tsv"):
        reader = reader.option("header", True).option("sep", "\t" if extension == ".tsv" else ",")
    return (reader.schema(schema) if schema else reader).load(path)


def read_jdbc(spark: SparkSession, options: Mapping[str, str], table: str, partition_column: str | None = None,
              bounds: tuple | None = None, partitions: int = 1) -> DataFrame:
    """A database table by configuration; give a partition column to read it in parallel."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", str(bounds[0]))
                  .option("upperBound", str(bounds[1])).option("numPartitions", str(partitions)))
    return reader.load()


def day_spine(spark: SparkSession, start, end, step: str = "INTERVAL '1' DAY", name: str = "dd") -> DataFrame:
    """Calendar rows from ``start`` to ``end``, both included."""
    days = F.sequence(clock.moment(start), clock.moment(end), F.expr(step))
    return spark.range(1).select(F.explode(days).alias(name))


def inline_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def touched(ts_cols: Sequence[str], as_of, hours: float) -> Column:
    """True when any of the times lies in the last ``hours``."""
    lo = clock.plus(clock.moment(as_of), minutes=-int(hours * 60))
    out = F.lit(False)
    for c in ts_cols:
        out = out | (F.col(c) >= lo)
    return out


def changed_keys(log: DataFrame, key: str, ts_cols: Sequence[str], as_of, hours: float = 4,
                 exclude: tuple[str, Sequence] | None = None, also: Sequence[str] = ()) -> DataFrame:
    """Distinct keys touched in the look-back on any of the times; rows of listed owners do not count.

    ``also`` names columns that hang on the key, such as its partition."""
    rows = log.filter(touched(ts_cols, as_of, hours))
    if exclude:
        rows = rows.filter(~F.col(exclude[0]).isin(list(exclude[1])))
    return rows.select(key, *also).distinct()


def lookback_extract(trips: DataFrame, links: DataFrame, tracker: DataFrame, as_of, hours: float = 1) -> DataFrame:
    """Trips started, closed or paid in the last hours.

    ``links``: trip_id, transaction_id. ``tracker``: transaction_id, created_at.
    The newest payment per trip is found by aggregation.
    """
    newest = (links.join(tracker, "transaction_id", "left").groupBy("trip_id")
              .agg(F.max("created_at").alias("transaction_created_at")))
    joined = trips.join(newest, "trip_id", "left")
    return joined.filter(touched(["start_at", "closed_at", "transaction_created_at"], as_of, hours))

"""Session settings the library relies on, and the shared checkpoint folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from haulmark import files

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Leave out the call site of every column expression: plans of this library are built from many small ones.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def spark_session(app: str = "haulmark", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with UTC time, AQE and skew-join handling on.

    On a cluster leave ``shuffle_partitions`` unset and size it in the submit
    configuration; AQE coalesces what turns out to be small.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, or one given to ``setCheckpointDir``; there is no other."""
    named = named_folder(spark)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return named


def named_folder(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    return spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()


_run: ContextVar[str | None] = ContextVar("haulmark_run", default=None)


def new_folder(spark: SparkSession, name: str = "work") -> str:
    """A fresh folder below that of the current run, or else below the shared one."""
    return f"{_run.get() or shared_folder(spark).rstrip('/')}/haulmark-{uuid.uuid4().hex[:12]}-{name}"


@contextmanager
def run_folder(spark: SparkSession):
    """Own what is written on the way: all intermediate tables made inside lie in one folder, which goes when the block ends.

    Write or collect results inside; frames made inside cannot be read after it. A run inside a run has a folder of its
    own. Functions that a stream calls for its batches run elsewhere and delete their own tables.
    """
    path = f"{shared_folder(spark).rstrip('/')}/haulmark-run-{uuid.uuid4().hex[:12]}"
    before = _run.set(path)
    try:
        yield path
    finally:
        _run.reset(before)
        files.delete(spark, path)


def written(df: DataFrame, name: str = "work") -> DataFrame:
    """Write a frame below the shared folder and read it back.

    Cuts the lineage, and tells the planner the size of the rows: a small side is then
    broadcast before the other side is shuffled, a large one never.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(table: DataFrame) -> None:
    """Delete the folder of a written table that nothing reads any more; any other frame is left alone."""
    path = getattr(table, "_written_to", None)
    if path:
        files.delete(table.sparkSession, path)
        table._written_to = None


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)

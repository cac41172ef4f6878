"""Structured Streaming forms of the milestone table, the daily counts and the changed keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from haulmark.session import discard, written
from haulmark.sources.readers import touched
from haulmark.streaming.store import BatchStore


def read_log(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None,
             time_columns: Sequence[str] = ("update_time",)) -> DataFrame:
    """File stream of Parquet; times become instants, as watermarks need."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    df = reader.parquet(path)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in time_columns})


PICK = {"min": F.min, "max": F.max}


def stream_milestones(log: DataFrame, key: str, ts: str, spec: Mapping[str, tuple[str, Column]],
                      finished: Column | None = None, expire: str | None = None) -> DataFrame:
    """First/last times kept continuously.

    Without ``expire`` there is one state row per key for good. With it (``"30 days"``, say) state
    is kept per key and stretch of that length and dropped once the watermark has passed it; rows
    then are partial times of one stretch, which :func:`read_milestones` merges. Scans that come
    later than ``expire`` do not reach this form; :func:`milestone_batches` has no such limit.
    ``finished`` leaves out scans of ended shipments.
    """
    rows = log if finished is None else log.filter(~finished)
    by = [F.col(key)]
    if expire is not None:
        rows = rows.withWatermark(ts, expire)
        by.append(F.window(ts, expire).alias("_stretch"))
    out = rows.groupBy(*by).agg(*[PICK[how](F.when(cond, F.col(ts))).alias(n) for n, (how, cond) in spec.items()])
    return out.drop("_stretch")


def merge_milestones(stored: DataFrame, batch: DataFrame, key: str, spec: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """Combine stored and new milestone rows; applying a batch twice changes nothing."""
    both = stored.unionByName(batch)
    return both.groupBy(key).agg(*[PICK[how](n).alias(n) for n, (how, _) in spec.items()])


def milestone_sink(path: str, key: str | None = None, spec: Mapping[str, tuple[str, Column]] | None = None,
                   compact_every: int | None = None, keep: int = 10) -> Callable[[DataFrame, int], None]:
    """Store the changed rows of each batch in a :class:`BatchStore`.

    A batch writes only the keys it changed. With ``compact_every`` (and ``key`` and ``spec``) so many folders of one level are
    folded into one of the next; :func:`read_milestones` merges what is left. Readers that have listed the folders before a
    fold can go on for ``keep`` commits.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        fold = (lambda rows: _merged(rows, key, spec)) if compact_every else None
        BatchStore(batch.sparkSession, path, compact_every or 2, keep).add(batch_id, batch, fold=fold)
    return store


def milestone_batches(path: str, key: str, ts: str, spec: Mapping[str, tuple[str, Column]],
                      compact_every: int | None = None, keep: int = 10) -> Callable[[DataFrame, int], None]:
    """A sink for the raw log: each batch stores the first and last times of its own scans.

    The stream then keeps no state at all, and no scan is ever too late.
    """
    put = milestone_sink(path, key, spec, compact_every, keep)

    def store(batch: DataFrame, batch_id: int) -> None:
        put(batch.groupBy(key).agg(*[PICK[how](F.when(cond, F.col(ts))).alias(n) for n, (how, cond) in spec.items()]), batch_id)
    return store


def _merged(rows: DataFrame, key: str, spec: Mapping[str, tuple[str, Column]]) -> DataFrame:
    return rows.groupBy(key).agg(*[PICK[how](n).alias(n) for n, (how, _) in spec.items()])


def read_milestones(spark: SparkSession, path: str, key: str, spec: Mapping[str, tuple[str, Column]]) -> DataFrame | None:
    """Current milestone per key, None before the first batch. First and last times merge in any order."""
    rows = BatchStore(spark, path).read()
    return None if rows is None else _merged(rows, key, spec)


def stream_daily_counts(log: DataFrame, by: Sequence[str], ts: str, ident: str, late: str = "2 days",
                        rsd: float = 0.01) -> DataFrame:
    """Scans and (approximately) distinct shipments per day and group, with late data up to ``late``."""
    return (log.withWatermark(ts, late).groupBy(F.window(ts, "1 day").alias("_w"), *by)
            .agg(F.count(F.lit(1)).alias("scans"), F.approx_count_distinct(ident, rsd).alias("shipments"))
            .select(F.col("_w.start").alias("day"), *by, "scans", "shipments"))


def daily_counts(log: DataFrame, by: Sequence[str], ts: str, ident: str) -> DataFrame:
    """Batch form with exact distinct counts."""
    return log.groupBy(F.date_trunc("day", ts).alias("day"), *by).agg(
        F.count(F.lit(1)).alias("scans"), F.count_distinct(ident).alias("shipments"))


#: Sketches of distinct shipments hold 2 ** 14 registers: a standard error of 1.04 / sqrt(2 ** 14), 0.8 %.
SKETCH_LOG2 = 14
OPEN_DAYS = 3


def _latest(batch: DataFrame, at: Column) -> str | None:
    return batch.agg(F.max(at.cast("timestamp")).cast("string")).first()[0]


def _later(*times: str | None) -> str | None:
    """The largest of times written as Spark writes them, year first."""
    return max((t for t in times if t is not None), default=None)


def daily_sink(path: str, by: Sequence[str], ts: str, ident: str, open_days: int = OPEN_DAYS, fan: int = 8,
               keep: int = 10) -> Callable[[DataFrame, int], None]:
    """A sink for the raw log that keeps days exact while they are open and small once they are closed.

    The last ``open_days`` days up to the largest time seen are open: below ``path/open`` they have one row per day, group and
    shipment, so distinct counts are exact. Older days have one row per day and group below ``path/closed``: scans, the exact
    distinct count of what closed together, and a mergeable sketch of the shipments. Scans of closed days are
    closed at once; where a day and group closed in several lots, distinct shipments come from the merged sketches.
    Storage of closed days grows with days and groups alone. Rows without a time form a day of their own that never closes.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        live, shut = (BatchStore(spark, f"{path}/{name}", fan, keep) for name in ("open", "closed"))
        before = live.newest()
        if batch_id <= before.through:
            return
        lots = written(batch.groupBy(F.date_trunc("day", ts).alias("day"), *by, ident).agg(F.count(F.lit(1)).alias("scans")), "lots")
        clock = _later(before.clock, _latest(lots, F.col("day")))
        is_open = _is_open(clock, open_days)
        # Days that were open until now, and lots that come too late for an open day, close together.
        was_open = _is_open(before.clock, open_days)
        held = live.read(before)
        due = lots.filter(~is_open)
        if held is not None:
            due = due.unionByName(held.filter(was_open & ~is_open)).groupBy("day", *by, ident).agg(F.sum("scans").alias("scans"))
        closing = due.groupBy("day", *by).agg(
            F.sum("scans").alias("scans"), F.count(ident).alias("shipments"), F.hll_sketch_agg(F.col(ident).cast("string"), F.lit(SKETCH_LOG2)).alias("sketch"),
            F.lit(1).alias("lots"))
        # Closed first: a run that breaks off here repeats both, and the stores pass over what they have.
        shut.add(batch_id, closing, fold=lambda r: _closed(r, by))
        live.add(batch_id, lots.filter(is_open), clock=clock,
                 fold=lambda r: r.filter(is_open).groupBy("day", *by, ident).agg(F.sum("scans").alias("scans")))
        discard(lots)
    return store


def _is_open(clock: str | None, open_days: int) -> Column:
    """Whether a day is open when the largest day seen is ``clock``; a day that is not known always is."""
    if clock is None:
        return F.lit(True)
    return F.coalesce(F.col("day") >= F.lit(clock).cast("timestamp") - F.make_dt_interval(F.lit(open_days - 1)), F.lit(True))


def _closed(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Closed days from several lots: the count stays exact where there is one lot."""
    one = F.sum("lots") == 1
    return rows.groupBy("day", *by).agg(
        F.sum("scans").alias("scans"), F.when(one, F.max("shipments")).otherwise(F.hll_sketch_estimate(F.hll_union_agg("sketch"))).alias("shipments"),
        F.hll_union_agg("sketch").alias("sketch"), F.sum("lots").cast("int").alias("lots"))


def read_daily_counts(spark: SparkSession, path: str, by: Sequence[str], ident: str, open_days: int = OPEN_DAYS) -> DataFrame | None:
    """Scans and distinct shipments per day and group, and whether the latter are exact; None before the first batch.

    ``open_days`` must be that of the sink. Open and closed days are read as of the same batch.
    """
    columns = ["day", *by, "scans", "shipments", "exact"]
    live, shut = (BatchStore(spark, f"{path}/{name}") for name in ("open", "closed"))
    now = live.newest()
    current = live.read(now)
    if current is None:
        return None
    one = current.filter(_is_open(now.clock, open_days)).groupBy("day", *by, ident).agg(F.sum("scans").alias("scans"))
    out = one.groupBy("day", *by).agg(F.sum("scans").alias("scans"), F.count(ident).alias("shipments"), F.lit(True).alias("exact")).select(*columns)
    closed = shut.read(shut.as_of(now.through))
    return out if closed is None else out.unionByName(_closed(closed, by).withColumn("exact", F.col("lots") == 1).select(*columns))


def changed_keys_sink(path: str, key: str, ts_cols: Sequence[str], horizon: str | None = None, fan: int = 8, keep: int = 10) -> Callable[[DataFrame, int], None]:
    """A sink for the raw log: the keys of each batch with the latest of their times, once per key.

    A scan counts on any of its times. With ``horizon`` ("7 days", say) the store holds what was touched within that stretch
    before the largest time seen: a folder goes when its last touch is older, and folding leaves older rows out, so storage follows the
    keys of the stretch, not of all time. Scans that come with older times are not stored but counted, as ``late_keys`` and
    ``late_scans`` of the store (see :func:`late_changes`). With a horizon, a key without
    any time counts as touched at the largest time seen when it came.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        target = BatchStore(spark, path, fan, keep)
        before = target.newest()
        if batch_id <= before.through:
            return
        touch = F.greatest(*ts_cols) if len(ts_cols) > 1 else F.col(ts_cols[0])
        rows = written(batch.groupBy(key).agg(F.max(touch).cast("timestamp").alias("touched_at"), F.count(F.lit(1)).alias("scans")), "touched")
        latest = _latest(rows, F.col("touched_at"))
        clock = _later(before.clock, latest)
        if horizon is None or clock is None:
            target.add(batch_id, rows.drop("scans"), latest, clock, fold=lambda r: _last_touch(r, key))
            discard(rows)
            return
        cut = F.lit(clock).cast("timestamp") - F.expr(f"interval {horizon}")
        fresh = F.coalesce(F.col("touched_at") >= cut, F.lit(True))
        limit, late_keys, late_scans = rows.agg(F.max(cut).cast("string"), F.count(F.when(~fresh, 1)), F.coalesce(F.sum(F.when(~fresh, F.col("scans"))), F.lit(0))).first()
        kept = rows.filter(fresh).select(key, F.coalesce("touched_at", F.lit(clock).cast("timestamp")).alias("touched_at"))
        target.add(batch_id, kept, latest or clock, clock, {"late_keys": late_keys, "late_scans": late_scans},
                   lambda r: _last_touch(r, key).filter(fresh), lambda f: limit is not None and f.latest is not None and f.latest < limit)
        discard(rows)
    return store


def _last_touch(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.max("touched_at").alias("touched_at"))


def read_changed_keys(spark: SparkSession, path: str, key: str, as_of=None, hours: float = 4) -> DataFrame | None:
    """Keys in the store with their latest time; with ``as_of`` those of the last ``hours``; None before the first batch.

    With a horizon, look-backs that start within it are exact.
    """
    stored = BatchStore(spark, path).read()
    if stored is None:
        return None
    out = _last_touch(stored, key).withColumn("touched_at", F.col("touched_at").cast("timestamp_ntz"))
    return out if as_of is None else out.filter(touched(["touched_at"], as_of, hours))


def late_changes(spark: SparkSession, path: str) -> Mapping[str, int]:
    """How many keys (per batch) and scans came with times before the horizon and are not in the store."""
    return {"late_keys": 0, "late_scans": 0, **BatchStore(spark, path).newest().counts}


def run_available(df: DataFrame, checkpoint: str, output_mode: str = "append",
                  each: Callable[[DataFrame, int], None] | None = None, table: str | None = None,
                  path: str | None = None) -> StreamingQuery:
    """Process what is there and stop: into ``each`` batch by batch, a memory table, or Parquet."""
    writer = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if each is not None:
        query = writer.foreachBatch(each).start()
    elif table is not None:
        query = writer.format("memory").queryName(table).start()
    else:
        query = writer.format("parquet").option("path", path).start()
    query.awaitTermination()
    return query

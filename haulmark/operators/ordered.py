"""Row-order computations per key that stay balanced when one key is huge.

``running`` adds ranks, neighbours and last-seen values in one pass. Ordinary
keys use a plain window. Rows of a hot key are cut into stretches of their order;
each stretch is its own window group, and what must be carried between stretches
comes from one summary row per stretch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from haulmark.operators.skew import mark_hot, resolve_hot
from haulmark.session import written


@dataclass(frozen=True)
class Spec:
    kind: str
    column: str | None = None


def rank() -> Spec:
    """1 + number of rows of the key with an earlier time; ties share a rank."""
    return Spec("rank")


def row_number() -> Spec:
    return Spec("row_number")


def lag(column: str) -> Spec:
    return Spec("lag", column)


def lead(column: str) -> Spec:
    return Spec("lead", column)


def last_seen(column: str) -> Spec:
    """Latest non-null value up to and including this row."""
    return Spec("last_seen", column)


def previous_seen(column: str) -> Spec:
    """Latest non-null value on the rows in front of this one."""
    return Spec("previous_seen", column)


def seen_before(column: str) -> Spec:
    """Latest non-null value at a strictly earlier time; null for rows without a time."""
    return Spec("seen_before", column)


def least_so_far(column: str) -> Spec:
    return Spec("least_so_far", column)


def _windowed(spec: Spec, groups: Sequence[str], ts: str, tie: Sequence[str]) -> Column:
    w = Window.partitionBy(*groups).orderBy(F.col(ts).asc_nulls_last(), *tie)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if spec.kind == "rank":
        return F.rank().over(Window.partitionBy(*groups).orderBy(F.col(ts).asc_nulls_last()))
    if spec.kind == "row_number":
        return F.row_number().over(w)
    if spec.kind == "lag":
        return F.lag(spec.column).over(w)
    if spec.kind == "lead":
        return F.lead(spec.column).over(w)
    if spec.kind == "last_seen":
        return F.last(spec.column, ignorenulls=True).over(upto)
    if spec.kind == "previous_seen":
        return F.last(spec.column, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    if spec.kind == "least_so_far":
        return F.min(spec.column).over(upto)
    if spec.kind == "seen_before":
        earlier = (Window.partitionBy(*groups).orderBy(F.col("_micros").asc_nulls_last())
                   .rangeBetween(Window.unboundedPreceding, -1))
        return F.when(F.col(ts).isNotNull(), F.last(spec.column, ignorenulls=True).over(earlier))
    raise ValueError(spec.kind)


def _with_micros(df: DataFrame, ts: str, specs: dict[str, Spec]) -> DataFrame:
    if any(s.kind == "seen_before" for s in specs.values()):
        return df.withColumn("_micros", F.unix_micros(F.col(ts).cast("timestamp")))
    return df


# Place of rows without a time: behind all others.
NO_TIME = 2 ** 63 - 1

# Rows of hot keys are cut as finely as their list asks for, into at most this many tasks; beyond that, into tasks of STRETCH_ROWS rows.
STRETCH_TASKS = 256
STRETCH_ROWS = 2_000_000


def running(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] = (),
            hot: DataFrame | str | int | None = "auto", attach: DataFrame | None = None, **specs: Spec) -> DataFrame:
    """Add one column per spec, in the order of ``ts`` (nulls last) and ``tie`` within each key.

    ``attach`` is a frame to left-join on the same keys. The lookup and the windows then
    share one shuffle of ``df``. Rows of hot keys take a path of their own, see ``_segmented``.
    """
    keys = list(keys)
    listed = resolve_hot(df, keys, hot)
    if listed is None:
        return _plain(df, keys, ts, tie, attach, specs)
    marked = mark_hot(df, keys, listed)
    extra = [] if attach is None else [c for c in attach.columns if c not in keys]
    columns = [*df.columns, *extra, *specs]
    ordinary = _plain(marked.filter(F.col("_parts").isNull()).drop("_parts"), keys, ts, tie, attach, specs)
    split = _segmented(marked.filter(F.col("_parts").isNotNull()).drop("_parts"), keys, ts, tie, listed, attach, specs)
    return ordinary.select(*columns).unionByName(split.select(*columns))


def _plain(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str], attach: DataFrame | None, specs: dict[str, Spec]) -> DataFrame:
    out = _with_micros(df if attach is None else df.join(attach, keys, "left"), ts, specs)
    return out.withColumns({n: _windowed(s, keys, ts, tie) for n, s in specs.items()}).drop("_micros")


def _segmented(rows: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str], listed: DataFrame, attach: DataFrame | None,
               specs: dict[str, Spec]) -> DataFrame:
    """The same columns for rows of hot keys.

    The rows are range-partitioned by key, time and tie, so each task gets one stretch of the
    order, of about equal size whatever the times are: one hour, one moment or no time at all
    may be cut. They are written with the number of their stretch; windows then run inside
    (key, stretch), and one summary row per (key, stretch) carries what the next one needs.
    A task holds the stretches of many keys where the keys are many and small.
    """
    parts = _tasks(listed)
    place = F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(NO_TIME))
    # Rows of one time and tie are told apart by their content, and copies by the task they come from: both are the same when a
    # task is run again. So any number of equal or missing times can be cut.
    hashed = [f.name for f in rows.schema if "map<" not in f.dataType.simpleString()]
    stored = written(rows.withColumn("_o", place).withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in hashed])).withColumn("_from", F.spark_partition_id())
                     .repartitionByRange(parts, *keys, "_o", *tie, "_tie", "_from")
                     .withColumn("_seg", F.spark_partition_id()), "hot-rows")
    tie = [*tie, "_tie"]
    carry = _carry(stored, keys, tie, specs)
    extra = [] if attach is None else [c for c in attach.columns if c not in keys]
    if attach is not None:  # one row per key meets one row per stretch
        carry = carry.join(attach, list(keys), "left")
    renamed = carry.select(*[F.col(k).alias(f"_q{i}") for i, k in enumerate(keys)], F.col("_seg").alias("_qseg"),
                           *[c for c in carry.columns if c not in (*keys, "_seg")])
    cond = F.col("_seg") == F.col("_qseg")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_q{i}"))
    out = stored.join(renamed, cond, "left").withColumn("_micros", F.when(F.col("_o") != NO_TIME, F.col("_o")))
    inside = [*keys, "_seg"]
    ordered = Window.partitionBy(*inside).orderBy("_o", *tie)
    first = F.row_number().over(ordered) == 1
    final_row = F.lead(F.lit(1)).over(ordered).isNull()
    tied = F.coalesce(F.col("_o") == F.col("_prev_o"), F.lit(False))  # the same moment as the end of the stretch before
    before = F.coalesce(F.col("_before"), F.lit(0))
    cols = {}
    for name, s in specs.items():
        local = _windowed(s, inside, ts, tie)
        x = F.col(f"_x_{name}") if s.kind not in ("rank", "row_number") else None
        if s.kind == "rank":
            cols[name] = (local + before - F.when(tied, F.coalesce(F.col("_tied"), F.lit(0))).otherwise(0)).cast("int")
        elif s.kind == "row_number":
            cols[name] = (local + before).cast("int")
        elif s.kind == "lag":
            cols[name] = F.when(first, x).otherwise(local)
        elif s.kind == "lead":
            cols[name] = F.when(final_row, x).otherwise(local)
        elif s.kind == "least_so_far":
            cols[name] = F.least(local, x)
        elif s.kind == "seen_before":
            cols[name] = F.when(F.col(ts).isNotNull(), F.coalesce(local, F.when(tied, F.col(f"_y_{name}")).otherwise(x)))
        else:
            cols[name] = F.coalesce(local, x)
    return out.withColumns(cols).select(*[c for c in rows.columns], *extra, *specs)


def _tasks(listed: DataFrame) -> int:
    """How many tasks share the rows of hot keys: a number that does not follow the length of the list."""
    asked = listed.agg(F.coalesce(F.sum("hot_parts"), F.lit(1)).alias("parts"),
                       (F.sum("hot_rows") if "hot_rows" in listed.columns else F.lit(None)).cast("bigint").alias("rows")).first()
    if asked["rows"] is None:  # a list of other origin: its parts are taken as meant
        return int(asked["parts"])
    return min(int(asked["parts"]), max(STRETCH_TASKS, -(-asked["rows"] // STRETCH_ROWS)))


def _carry(stored: DataFrame, keys: Sequence[str], tie: Sequence[str], specs: dict[str, Spec]) -> DataFrame:
    """What each stretch needs from its neighbours: one row per hot key and stretch."""
    order = F.struct("_o", *tie)
    end = Window.partitionBy(*keys, "_seg")
    rows = stored.withColumn("_end", F.max("_o").over(end)) if any(s.kind == "seen_before" for s in specs.values()) else stored
    summary = {"_n": F.count(F.lit(1)), "_last": F.max("_o")}
    for name, s in specs.items():
        if s.kind == "lag":
            summary[f"_c_{name}"] = F.max_by(s.column, order)
        elif s.kind == "lead":
            summary[f"_c_{name}"] = F.min_by(s.column, order)
        elif s.kind in ("last_seen", "previous_seen", "seen_before"):
            summary[f"_c_{name}"] = F.max_by(s.column, F.when(F.col(s.column).isNotNull(), order))
        elif s.kind == "least_so_far":
            summary[f"_c_{name}"] = F.min(s.column)
        if s.kind == "seen_before":  # the same before the last moment of the stretch
            summary[f"_s_{name}"] = F.max_by(s.column, F.when(F.col(s.column).isNotNull() & (F.col("_o") < F.col("_end")), order))
    moments = stored.groupBy(*keys, "_seg", "_o").agg(F.count(F.lit(1)).alias("_m"))
    at_end = moments.groupBy(*keys, "_seg").agg(F.max_by("_m", "_o").alias("_n_last"))
    stretches = rows.groupBy(*keys, "_seg").agg(*[c.alias(n) for n, c in summary.items()])
    cond = stretches["_seg"] == at_end["_seg"]
    for k in keys:
        cond = cond & stretches[k].eqNullSafe(at_end[k])
    stretches = stretches.join(at_end, cond).select(*[stretches[c] for c in stretches.columns], "_n_last")
    by = Window.partitionBy(*keys).orderBy("_seg")
    earlier = by.rowsBetween(Window.unboundedPreceding, -1)
    same_end = Window.partitionBy(*keys, "_last").orderBy("_seg").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = {"_run": F.sum("_n_last").over(same_end), "_prev_o": F.lag("_last").over(by),
             "_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0))}
    for name, s in specs.items():
        c = f"_c_{name}"
        if s.kind == "lag":
            inner[f"_x_{name}"] = F.lag(c).over(by)
        elif s.kind == "lead":
            inner[f"_x_{name}"] = F.lead(c).over(by)
        elif s.kind in ("last_seen", "previous_seen", "seen_before"):
            inner[f"_x_{name}"] = F.last(c, ignorenulls=True).over(earlier)
        elif s.kind == "least_so_far":
            inner[f"_x_{name}"] = F.min(c).over(earlier)
    carried = stretches.withColumns(inner)
    # Stretches that end at the same moment share what lies before it: that of the first of them.
    strict = {f"_b_{n}": F.first(F.coalesce(F.col(f"_s_{n}"), F.col(f"_x_{n}"))).over(same_end) for n, s in specs.items() if s.kind == "seen_before"}
    carried = carried.withColumns(strict) if strict else carried
    ends = {"_tied": F.lag("_run").over(by), **{f"_y_{n[3:]}": F.lag(n).over(by) for n in strict}}
    kept = [*keys, "_seg", "_before", "_prev_o", "_tied", *[f"_x_{n}" for n, s in specs.items() if s.kind not in ("rank", "row_number")], *[f"_y_{n[3:]}" for n in strict]]
    return carried.withColumns(ends).select(*kept)

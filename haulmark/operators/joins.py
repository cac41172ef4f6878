"""Join shapes. No broadcast hints: Catalyst broadcasts a side only when its size is known to be small."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from haulmark.operators.ordered import last_seen, running, seen_before
from haulmark.operators.skew import HOT_MIN_ROWS, mark_hot, resolve_hot, salt, salted_join

# A grid join has about this many cells beyond one per key, unless a cell's side would then have more than HOT_MIN_ROWS rows.
GRID_CELLS = 256


def star(fact: DataFrame, *dims: tuple[DataFrame, Sequence[str] | str]) -> DataFrame:
    """Left-join unique-keyed dimensions one after another."""
    out = fact
    for dim, on in dims:
        out = out.join(dim, [on] if isinstance(on, str) else list(on), "left")
    return out


def on_expressions(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[Column, Column]],
                   how: str = "inner", hot=None) -> DataFrame:
    """Join on computed keys: they become columns first, so the join stays an equi join."""
    names = [f"_j{i}" for i in range(len(pairs))]
    l = left.withColumns({n: p[0] for n, p in zip(names, pairs)})
    r = right.withColumns({n: p[1] for n, p in zip(names, pairs)})
    return salted_join(l, r, names, how, hot=hot).drop(*names)


def on_cast(left: DataFrame, right: DataFrame, left_key: str, right_key: str, to: str = "decimal(38,0)",
            how: str = "left", hot="auto") -> DataFrame:
    """Text key against numeric key; text that is not a number matches nothing.

    Such rows share the null key, which is spread like any other hot key.
    """
    return on_expressions(left, right, [(F.col(left_key).try_cast(to), F.col(right_key).cast(to))], how, hot)


def full_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], hot="auto") -> DataFrame:
    """Full outer join where a null key matches a null key.

    Without hot keys a left join plus the right rows without a match: a full outer join is never split by the engine, whereas a
    hot key on the left of a left join is. A key that is hot on both sides, as null often is, has rows times rows results:
    its left rows are dealt into rows and its right rows into columns of a grid, by content, each goes to every cell of its row or
    column, and every pair meets in one cell. The number of cells does not follow the input, so neither does the number of times a
    row is repeated; the pairs themselves are rows times rows. Rows without a match are found by semi joins and never repeated.
    """
    listed = resolve_hot(left, on, hot), resolve_hot(right, on, hot)
    if listed[0] is not None or listed[1] is not None:
        return _on_grid(left, right, on, *listed)

    rest = [c for c in right.columns if c not in on]
    r = right.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(on)], *[F.col(c).alias(f"_v{i}") for i, c in enumerate(rest)])
    both = left.join(r, _same(on, r), "left").select(*on, *[c for c in left.columns if c not in on], *[F.col(f"_v{i}").alias(c) for i, c in enumerate(rest)])
    return both.unionByName(_alone(right, left, on).select(*on, *rest), allowMissingColumns=True)


def _same(on: Sequence[str], other: DataFrame) -> Column:
    """Null-safe equality with columns ``_r0``, ``_r1`` ... of the other frame."""
    cond = F.lit(True)
    for i, k in enumerate(on):
        cond = cond & F.col(k).eqNullSafe(other[f"_r{i}"])
    return cond


def _alone(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key the other frame does not have."""
    seen = other.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(on)]).distinct()
    return df.join(seen, _same(on, seen), "left_anti")


def _coarser(on: Sequence[str], hot_left: DataFrame | None, hot_right: DataFrame | None) -> float:
    """By how much the parts of all keys are divided, so that their cells come down to ``GRID_CELLS``."""
    sides = [x for x in (hot_left, hot_right) if x is not None]
    if any("hot_rows" not in x.columns for x in sides):  # lists of other origin: their parts are taken as meant
        return 1.0
    size = (F.col("hot_rows") / F.col("hot_parts")).alias("_size")
    parts = [x.select(*on, *[(F.col("hot_parts") if x is own else F.lit(1)).cast("double").alias(name) for name, own in (("_rows", hot_left), ("_columns", hot_right))], size)
             for x in sides]
    per_key = reduce(DataFrame.unionByName, parts).groupBy(*on).agg((F.max("_rows") * F.max("_columns")).alias("_cells"), F.max("_size").alias("_size"))
    total = per_key.agg(F.sum("_cells").alias("cells"), F.max("_size").alias("size")).first()
    if total["cells"] is None:
        return 1.0
    return max(1.0, min((total["cells"] / GRID_CELLS) ** 0.5, HOT_MIN_ROWS / total["size"]))


def _on_grid(left: DataFrame, right: DataFrame, on: Sequence[str], hot_left: DataFrame | None, hot_right: DataFrame | None) -> DataFrame:
    rest = [c for c in right.columns if c not in on]
    by = _coarser(on, hot_left, hot_right)

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        marked = df
        for name, listed in (("_rows", hot_left), ("_columns", hot_right)):
            marked = marked.withColumn(name, F.lit(None).cast("int")) if listed is None else mark_hot(marked, on, listed, name)
        rows, columns = (F.ceil(F.coalesce(c, F.lit(1)) / F.lit(by)).cast("int") for c in (own, other))
        return marked.withColumn("_own", salt(df.columns, rows)).withColumn("_all", F.explode(F.sequence(F.lit(0), columns - 1))).drop("_rows", "_columns")

    l = dealt(left, "_rows", "_columns")
    r = dealt(right, "_columns", "_rows").select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(on)], F.col("_own").alias("_column"), F.col("_all").alias("_row"),
                                                 *[F.col(c).alias(f"_v{i}") for i, c in enumerate(rest)])
    met = l.join(r, _same(on, r) & (F.col("_own") == F.col("_row")) & (F.col("_all") == F.col("_column")))
    both = met.select(*on, *[c for c in left.columns if c not in on], *[F.col(f"_v{i}").alias(c) for i, c in enumerate(rest)])
    return (both.unionByName(_alone(left, right, on), allowMissingColumns=True)
            .unionByName(_alone(right, left, on).select(*on, *rest), allowMissingColumns=True))


def semi(df: DataFrame, keep: DataFrame, on: Sequence[str], hot=None) -> DataFrame:
    return salted_join(df, keep, on, "left_semi", hot=hot)


def anti(df: DataFrame, remove: DataFrame, on: Sequence[str], hot=None) -> DataFrame:
    return salted_join(df, remove, on, "left_anti", hot=hot)


def not_in(df: DataFrame, column: str, listed: DataFrame, listed_column: str, hot=None) -> DataFrame:
    """``column NOT IN (SELECT listed_column ...)`` with its null rules, for lists of any size.

    A null in the list removes every row; a null value is kept only against an empty list.
    """
    values = listed.select(F.col(listed_column).alias(column))
    counts = values.agg(F.struct(F.count(F.lit(1)).alias("size"), F.count_if(F.col(column).isNull()).alias("nulls")).alias("n")).scalar()
    allowed = df.filter((counts["nulls"] == 0) & (F.col(column).isNotNull() | (counts["size"] == 0)))
    return salted_join(allowed, values.dropna().distinct(), [column], "left_anti", hot=hot)


def after(events: DataFrame, marks: DataFrame, on: Sequence[str], ts: str, mark_ts: str, hot="auto") -> DataFrame:
    """Events strictly later than their key's mark; ``marks`` has one row per key."""
    joined = salted_join(events, marks.select(*on, mark_ts), on, "inner", hot=hot)
    return joined.filter(F.col(ts) > F.col(mark_ts))


def neighbours(df: DataFrame, key: str, number: str, ts: str, prev: str = "previous_trip_time",
               nxt: str = "next_trip_time", bounded: bool = False) -> DataFrame:
    """Times of the attempts numbered one lower and one higher.

    Rows that share a number share a time, so each row stays one row. With
    ``bounded`` groups a range window does it without a shuffle of its own;
    otherwise one time per (key, number) is joined back, which no hot key can tilt.
    """
    if bounded:
        w = Window.partitionBy(key).orderBy(number)
        return df.withColumns({prev: F.min(ts).over(w.rangeBetween(-1, -1)),
                               nxt: F.min(ts).over(w.rangeBetween(1, 1))})
    times = df.groupBy(key, number).agg(F.min(ts).alias("_t"))
    nothing = F.lit(None).cast(dict(df.dtypes)[ts])
    spread = times.select(key, F.inline(F.array(
        F.struct((F.col(number) + 1).alias(number), F.col("_t").alias("_p"), nothing.alias("_x")),
        F.struct((F.col(number) - 1).alias(number), nothing.alias("_p"), F.col("_t").alias("_x")))))
    sides = spread.groupBy(key, number).agg(F.max("_p").alias(prev), F.max("_x").alias(nxt))
    return df.join(sides, [key, number], "left")


def interval_latest(attempts: DataFrame, replies: DataFrame, key: str, ts: str, reply_ts: str,
                    reply_id: str, hot="auto") -> DataFrame:
    """Latest reply of each attempt: at or after the attempt, up to and including the next one.

    Both sides are laid on one timeline per key, so no attempt x reply pairs are
    produced. A reply at the very moment of an attempt belongs to that attempt and
    to the one before. Replies without a key or a time match nothing.
    """
    payload = [c for c in replies.columns if c != key]
    listed = resolve_hot(attempts.select(key).unionByName(replies.select(key)), [key], hot)
    reply_rows = replies.filter(F.col(key).isNotNull() & F.col(reply_ts).isNotNull())
    if listed is None:
        order = [reply_ts, reply_id, *[c for c in payload if c not in (reply_ts, reply_id)]]
        said = reply_rows.select(key, F.col(reply_ts).alias("_at"), F.struct(*order).alias("_reply"))
        line = (attempts.withColumns({"_at": F.col(ts), "_row": F.lit(True)})
                .unionByName(said, allowMissingColumns=True))
        out = latest_on_timeline(line, key)
        return out.select(*attempts.columns, *[F.col(f"_reply.{c}").alias(c) for c in payload])
    starts = attempts.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(key, F.col(ts).alias("_at")).distinct()
    line = (starts.withColumns({"_start": F.col("_at"), "_kind": F.lit(0)})
            .unionByName(reply_rows.select(
                key, F.col(reply_ts).alias("_at"), F.lit(1).alias("_kind"),
                F.struct(*payload).alias("_reply")), allowMissingColumns=True))
    seen = running(line, [key], "_at", ["_kind"], hot=listed, _own=last_seen("_start"), _earlier=seen_before("_start"))
    owned = (seen.filter("_kind = 1")
             .withColumn("_start", F.explode(F.array_distinct(F.array("_own", "_earlier"))))
             .filter(F.col("_start").isNotNull()))
    best = owned.groupBy(key, "_start").agg(
        F.max_by("_reply", F.struct(F.col(f"_reply.{reply_ts}"), F.col(f"_reply.{reply_id}"))).alias("_reply"))
    joined = salted_join(attempts, best.withColumnRenamed("_start", ts), [key, ts], "left", hot=None)
    return joined.select(*attempts.columns, *[F.col(f"_reply.{c}").alias(c) for c in payload])


def latest_on_timeline(line: DataFrame, key: str) -> DataFrame:
    """The rows of ``line`` with ``_row`` set, ``_reply`` filled with the latest one of their stretch.

    ``line`` holds attempts (``_row``) and replies (``_reply``, a struct that starts with its
    time) by ``key`` and time ``_at``. One running maximum forwards gives the latest reply up to
    each moment; one pass backwards brings that of the next attempt. All windows share the
    partitioning of the key.
    """
    micros = F.unix_micros(F.col("_at").cast("timestamp"))
    timed = line.withColumns({"_up": micros, "_down": -micros})
    upto = F.max("_reply").over(Window.partitionBy(key).orderBy("_up").rangeBetween(Window.unboundedPreceding, 0))
    later = Window.partitionBy(key).orderBy(F.col("_down").asc_nulls_last()).rangeBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.col("_row"), F.lit(False)) & F.col("_at").isNotNull()
    marked = timed.withColumn("_upto", upto)
    next_one = F.last(F.when(start, F.struct(F.lit(True).alias("has"), F.col("_upto").alias("reply"))), ignorenulls=True).over(later)
    last_one = F.max("_reply").over(Window.partitionBy(key))
    filled = marked.withColumns({"_next": next_one, "_last": last_one}).filter("_row")
    latest = F.when(F.col("_next.has"), F.col("_next.reply")).otherwise(F.col("_last"))
    first_field = line.schema["_reply"].dataType.fieldNames()[0]
    in_time = F.col(key).isNotNull() & (latest[first_field] >= F.col("_at"))
    return filled.withColumn("_reply", F.when(in_time, latest)).drop("_up", "_down", "_upto", "_next", "_last")

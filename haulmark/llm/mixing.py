"""Mixing sources to target weights by entropy balancing.

Each source has a token target. Among all document rates that meet it, and none above ``most`` copies, the ones closest to
one copy each in relative entropy are exponentially tilted: rate = min(most, exp(lambda * tokens / mean tokens)). The convex
dual, one lambda per source, is solved by Newton steps: every step is one distributed aggregation over the histogram of
(source, size) and one small written table of multipliers, bracketed so that it cannot run away. Documents of one source
and size share a rate; whole copies of them are planned per size from the largest, each size taking up the words the ones
before missed, and documents take the extra copies by their rank under a hash.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulmark.llm.common import WORD, rank_within, ship, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
STEPS = 80
TOLERANCE = 1e-7
#: Copies that move at most between sizes of a source after rounding.
MOVES = 16
#: Share of a source's target that rounding may miss before documents may get a second extra copy.
NEAR = 0.005


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source of ``sizes`` (source, size): no, source, source_size, n, target.

    Sources are numbered by code point, null last, and take ``weights`` in turn. They share ``share`` times all sizes by
    weight; a target stops at ``most`` times its source's size and the excess is shared among the others by weight, until
    none is above. Works on one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count_if(F.col("size") > 0).alias("n"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    numbered = (totals.withColumn("no", F.row_number().over(order) - 1)
                .withColumn("w", F.get(cycle, F.pmod(F.col("no"), F.lit(len(weights)))))
                .withColumn("cap", F.col("source_size") * F.lit(float(most))))
    # The level is the first at which no source left is above its cap; the ones with the least cap per weight stop first.
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), "no")
    everything = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    levelled = numbered.withColumn("level", level).withColumn("fits", F.col("cap") / F.col("w") >= F.col("level"))
    chosen = F.min_by(F.when(F.col("fits"), F.col("level")), F.when(F.col("fits"), F.struct(F.col("cap") / F.col("w"), F.col("no")))).over(everything)
    return (levelled.withColumn("target", F.least("cap", F.coalesce(chosen, F.lit(float("inf"))) * F.col("w")))
            .select("no", "source", "source_size", "n", "target"))


def multipliers(histogram: DataFrame, sources: DataFrame, most: int = MOST) -> DataFrame:
    """The dual's solution: one row (no, lam, mean) per source; ``lam`` is null where every document takes ``most`` copies.

    ``histogram`` (no, size, n) and ``sources`` (no, n, source_size, target) are written tables.
    """
    mean = F.col("source_size") / F.greatest(F.col("n"), F.lit(1))
    capped = F.col("target") >= most * F.col("source_size") * (1 - 1e-12)
    state = table(sources.select("no", mean.alias("mean"), "target", "source_size",
                                 F.when(capped, None).otherwise(F.log(F.col("target") / F.col("source_size"))).alias("lam"),
                                 F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"), capped.alias("done")), "state")
    for _ in range(STEPS):
        z = F.col("size") / F.col("mean")
        tilt = F.least(F.lit(700.0), F.col("lam") * z)
        free = tilt < F.lit(math.log(most))
        rate = F.when(free, F.exp(tilt)).otherwise(F.lit(float(most)))
        sums = (histogram.filter(F.col("size") > 0).join(state.filter(~F.col("done")), "no").groupBy("no")
                .agg(F.sum(F.col("n") * F.col("size") * rate).alias("got"),
                     F.sum(F.when(free, F.col("n") * F.col("size") * z * F.exp(tilt)).otherwise(0.0)).alias("slope")))
        gap = F.col("got") - F.col("target")
        low = F.when(gap < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.when(F.col("slope") > 0, F.col("lam") - gap / F.col("slope"))
        open_end = F.when(gap < 0, F.col("lam") + F.abs("lam") + 1).otherwise(F.col("lam") - F.abs("lam") - 1)
        halved = F.when((low > float("-inf")) & (high < float("inf")), (low + high) / 2).otherwise(open_end)
        step = F.when((newton > low) & (newton < high) & (F.abs(newton - F.col("lam")) <= 4 * (F.abs("lam") + 1)), newton).otherwise(halved)
        done = F.abs(gap) <= TOLERANCE * F.col("target")
        moved = (state.join(sums, "no", "left")
                 .select("no", "mean", "target", "source_size",
                         F.when(F.col("done") | done, F.col("lam")).otherwise(F.coalesce(step, F.col("lam"))).alias("lam"),
                         F.coalesce(low, F.col("low")).alias("low"), F.coalesce(high, F.col("high")).alias("high"),
                         (F.col("done") | F.coalesce(done, F.lit(True))).alias("done")))
        state = table(moved, "state")
        if state.filter(~F.col("done")).isEmpty():
            break
    return state.select("no", "lam", "mean")


def round_copies(size: np.ndarray, n: np.ndarray, part: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Whole extra copies per size (falling, positive), ``room`` at most, so that their words come to sum(n * part * size).

    Each size takes up what the ones before missed, with one extra copy of a document at most; single copies then move
    between sizes while that closes the gap left, in the end with second extra copies where a source has few documents.
    """
    extra, owed = np.zeros(len(size), np.int64), 0.0
    once = np.minimum(n, room)
    wanted = n * part * size
    for i, (s, want, most) in enumerate(zip(size.tolist(), wanted.tolist(), once.tolist())):
        owed += want
        extra[i] = min(most, max(0, math.floor(owed / s + 0.5)))
        owed -= int(extra[i]) * s
    extra, owed = _closed(size, extra, once, owed)
    if abs(owed) > NEAR * wanted.sum():
        extra, owed = _closed(size, extra, room, owed)
    return extra


def _closed(size, extra, room, owed):
    for _ in range(MOVES):
        up, down, gap = _best_move(size, extra, room, owed)
        if gap >= abs(owed) - 0.5:
            break
        for i, step in ((up, 1), (down, -1)):
            if i is not None:
                extra[i] += step
                owed -= step * size[i]
    return extra, owed


def _best_move(size, extra, room, owed):
    """One more copy of a size, one less, or one more of one and one less of another, found by bisection."""
    more, less = np.flatnonzero(extra < room), np.flatnonzero(extra > 0)
    moves = [(None, None, abs(owed))]
    moves += [(int(i), None, abs(owed - size[i])) for i in more[:: max(1, len(more) // 64)]]
    moves += [(None, int(j), abs(owed + size[j])) for j in less[:: max(1, len(less) // 64)]]
    if len(more) and len(less):
        rising = more[::-1]
        at = np.searchsorted(size[rising], owed + size[less])
        for side in (np.minimum(at, len(rising) - 1), np.maximum(at - 1, 0)):
            gap = np.abs(owed - size[rising[side]] + size[less])
            best = int(gap.argmin())
            moves.append((int(rising[side[best]]), int(less[best]), float(gap[best])))
    return min(moves, key=lambda m: m[2])


def _plan_source(rows: pd.DataFrame, most: int) -> pd.DataFrame:
    rows = rows.sort_values("size", ascending=False)
    words = rows["size"].to_numpy() > 0
    extra = np.zeros(len(rows), np.int64)
    size, n, part, base = (rows[c].to_numpy()[words] for c in ("size", "n", "part", "base"))
    extra[words] = round_copies(size, n, part, n * (most - base))
    return rows[["no", "size", "n", "base"]].assign(extra=extra)


def copies(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` (id, source, size) with source_size, target and copies (0 to ``most``); reads only these columns.

    Null sources are one source, the last; a size of 0 takes one copy and no words. Repeated rows are documents like any
    other. The same rows give the same copies on every run.
    """
    ship(docs.sparkSession)
    most = options.get("most", MOST)
    sizes = table(docs.select(id_col, "source", F.coalesce("size", F.lit(0)).cast("long").alias("size")), "sizes")
    sources = table(targets(sizes, **options), "sources")
    named = (sizes.join(sources.select("no", F.col("source").alias("s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("s")))
             .select(id_col, "no", "size", "source_size", "target"))
    named = table(named, "named")
    histogram = table(named.groupBy("no", "size").agg(F.count("*").alias("n")), "histogram")
    solved = multipliers(histogram, sources, most)
    tilt = F.least(F.lit(700.0), F.col("lam") * F.col("size") / F.col("mean"))
    rate = F.when(F.col("lam").isNull(), F.lit(float(most))).otherwise(F.least(F.lit(float(most)), F.exp(tilt)))
    rate = F.when(F.col("size") == 0, 1.0).otherwise(rate)
    rated = (histogram.join(solved, "no").withColumn("rate", rate).withColumn("base", F.floor("rate").cast("long"))
             .select("no", "size", "n", "base", (F.col("rate") - F.col("base")).alias("part")))
    # One row per size of a source: the sizes of a source, not its documents, meet in a task.
    planned = table(rated.groupBy("no").applyInPandas(lambda rows: _plan_source(rows, most), "no int, size long, n long, base long, extra long"), "planned")
    ranked = rank_within(named, ["no", "size"], [id_col], "rank")
    return (ranked.join(planned, ["no", "size"])
            .withColumn("copies", F.col("base") + F.floor(F.col("extra") / F.col("n"))
                        + F.when(F.col("rank") < F.col("extra") % F.col("n"), 1).otherwise(0))
            .select(id_col, "size", "source_size", "target", "copies"))


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, source) with the number of words of the text as size; a null text has none."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).alias("size"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken words per row of ``docs`` (doc_id, text, source)."""
    found = copies(sized(docs))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs`` repeated as often as their copies say, all columns as they are.

    Rows alike in all columns are interchangeable and share their copies. Columns may have any name and type; maps that hold
    the same in another order are different.
    """
    def named(c):
        return F.col("`" + c.replace("`", "``") + "`")

    odd = [c for c, t in docs.dtypes if "map<" in t or "variant" in t]  # they cannot be hashed, but written out
    parts = [named(c) for c, _ in docs.dtypes if c not in odd]
    if odd:
        parts.append(F.to_json(F.struct(*(named(c).alias(f"c{i}") for i, c in enumerate(odd))), {"ignoreNullFields": "false"}))
    own = F.xxhash64(*parts)
    # The id and a hash of the whole row stand for the row while copies are planned.
    marked = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), own.alias("hash"))
    small = sized(docs.select(F.struct(F.col("doc_id").alias("id"), own.alias("hash")).alias("doc_id"), "text", "source"))
    of_row = (copies(small).groupBy(F.col("doc_id.id").alias("of_id"), F.col("doc_id.hash").alias("of_hash"))
              .agg(F.sum("copies").cast("int").alias("copies")).filter(F.col("copies") > 0))
    one = marked.dropDuplicates(["id", "hash"])
    joined = one.join(of_row, (F.col("hash") == F.col("of_hash")) & F.col("id").eqNullSafe(F.col("of_id")))
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")

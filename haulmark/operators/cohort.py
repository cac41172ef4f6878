"""Improvement program: weekly selection, scorecards, life cycle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from haulmark import rules
from haulmark.functions import clock, lookup
from haulmark.functions.numbers import ratio, round_to_int, truncate
from haulmark.operators.aggregate import weekday_pivot
from haulmark.operators.attempts import COMPLETED, payment_mode
from haulmark.operators.joins import not_in
from haulmark.operators.mutate import delete_in, update_where
from haulmark.operators.shape import with_rows
from haulmark.session import written


def cells() -> list[tuple[str, str, float, str]]:
    """Slot, payment, threshold and a short column prefix."""
    return [(s, m, t, f"{s.lower()}_{m.lower()}") for s, m, t in rules.PROGRAM_THRESHOLDS]


def slot_days(ranked: DataFrame) -> DataFrame:
    """Attempts and deliveries per rider, day and slot. Needs ``attempt_number, shipping_city``."""
    fresh, done, mode = F.col("attempt_number") == 1, F.col("status") == COMPLETED, payment_mode()
    prepared = ranked.withColumns({"dispatch_date": clock.day("dispatch_time"), "slot": clock.slot_of("dispatch_time", "program")})
    return prepared.groupBy("dispatch_date", "shipping_city", "slot", "rider_id").agg(
        F.count_if(fresh).alias("fresh_attempted"), F.count_if(fresh & done).alias("fresh_delivered"),
        F.count_if(fresh & (mode == "Prepaid")).alias("prepaid_attempted"),
        F.count_if(fresh & done & (mode == "Prepaid")).alias("prepaid_delivered"),
        F.count_if(fresh & (mode == "COD")).alias("cod_attempted"),
        F.count_if(fresh & done & (mode == "COD")).alias("cod_delivered"),
        F.count("task_id").alias("total_attempted"), F.count_if(done).alias("total_delivered"))


def weekly_rates(days: DataFrame) -> DataFrame:
    """Weekly success per rider, per slot and payment mode, with average delivered orders per slot day."""
    def cell(slot, c):
        return F.sum(F.when(F.col("slot") == slot, F.col(c)))
    by = ["shipping_city", "dispatch_week", "rider_id"]
    rows = days.filter(F.col("shipping_city").isNotNull()).withColumn("dispatch_week", clock.week("dispatch_date"))
    # A rider, day and slot is one row, so counting rows counts distinct days of a slot.
    aggs = [F.sum("total_attempted").alias("assigned"), F.sum("fresh_delivered").alias("_fd"), F.sum("fresh_attempted").alias("_fa")]
    for slot, mode, _, name in cells():
        m = mode.lower()
        aggs += [cell(slot, f"{m}_delivered").alias(f"_{name}_d"), cell(slot, f"{m}_attempted").alias(f"_{name}_a"),
                 F.count_if(F.col("slot") == slot).alias(f"_{name}_n")]
    out = rows.groupBy(*by).agg(*aggs).withColumn("fasr", ratio("_fd", "_fa"))
    for _, _, _, name in cells():
        out = out.withColumns({f"{name}_fasr": ratio(f"_{name}_d", f"_{name}_a"),
                               f"{name}_orders": ratio(f"_{name}_d", f"_{name}_n")})
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def _improvement_text() -> Column:
    """Cells below their threshold, as text."""
    parts = []
    for slot, mode, bound, name in cells():
        label = F.concat(F.lit(rules.PROGRAM_TEXT[slot, mode]), round_to_int(F.col(f"{name}_fasr") * 100).cast("string"), F.lit("%) "))
        parts.append(F.when(F.col(f"{name}_fasr") < bound, label))
    return F.concat_ws("", *parts)


def cohort_select(days: DataFrame, riders: DataFrame, week=None, scheduled: bool = False) -> DataFrame:
    """Riders to enter the program in the week after a weak one.

    ``days`` comes from :func:`slot_days`; ``riders``: rider_id, rider_name, hub,
    hub_type, vendor_name, created_at. The scheduled form looks only at slot days
    with enough deliveries and does not exclude franchise hubs. Without ``week``
    every entry week is returned.
    """
    rows = days.filter(F.col("total_delivered") >= rules.PROGRAM_MIN_ORDERS) if scheduled else days
    rates = weekly_rates(rows)
    known = riders if scheduled else riders.filter(F.col("hub_type") != "franchise")
    rated = rates.join(known, "rider_id", "left" if scheduled else "inner").withColumn(
        "rider_age", clock.whole_days("dispatch_week", "created_at"))
    closing = rated.select("rider_id", clock.plus("dispatch_week", days=-7).alias("dispatch_week"),
                           truncate(F.col("fasr") * 100).alias("closing_fasr"))
    weak = F.lit(False)
    for _, _, bound, name in cells():
        weak = weak | ((F.col(f"{name}_fasr") < bound) & (F.col(f"{name}_orders") >= rules.PROGRAM_MIN_ORDERS))
    chosen = rated.filter((F.col("fasr") < rules.PROGRAM_ENTRY_FASR) & weak
                          & (F.col("rider_age") >= rules.PROGRAM_MIN_AGE_DAYS))
    out = chosen.join(closing, ["rider_id", "dispatch_week"], "left").withColumn("pip_date", clock.plus("dispatch_week", days=7))
    if week is not None:
        out = out.filter(F.col("pip_date") == clock.week(clock.moment(week)))
    return out.select(
        F.concat_ws("-", F.date_format("pip_date", "yyyyMMdd"), F.col("rider_id").cast("string")).alias("key"),
        F.col("pip_date").cast("date").alias("pip_date"), "shipping_city", "rider_id", "rider_name", "hub",
        "vendor_name", "rider_age", _improvement_text().alias("need_improvement"),
        truncate(F.col("fasr") * 100).alias("starting_fasr"), "closing_fasr",
        F.lit("running").alias("pip_status"), F.lit("").alias("pip_result"))


def lost_tours(tasks: DataFrame) -> DataFrame:
    """Tours on which nothing was delivered."""
    return (tasks.groupBy("rider_id", "tour_id").agg(F.count_if(F.col("status") == COMPLETED).alias("_d"))
            .filter("_d = 0").select("tour_id").distinct())


def cohort_scorecard(cohort: DataFrame, ranked: DataFrame, closing: bool = False) -> DataFrame:
    """Daily success of each cohort rider against the four thresholds, with pass or fail.

    Start form: no data is a pass. Closing form: no data is a fail and tours
    without any delivery do not count; ranks are taken before that removal.
    """
    if closing:  # the ranked attempts are read for the rows, and twice for the list of tours
        ranked = written(ranked, "ranked")
    rows = not_in(ranked, "tour_id", lost_tours(ranked), "tour_id") if closing else ranked
    fresh, done = F.col("attempt_number") == 1, F.col("status") == COMPLETED
    kind = F.concat_ws("-", clock.slot_of("dispatch_time", "program"), payment_mode())
    daily = (rows.withColumns({"dispatch_week": clock.week("dispatch_time"), "dispatch_date": clock.day("dispatch_time"),
                               "performance_type": kind})
             .groupBy("dispatch_week", "dispatch_date", "rider_id", "shipping_city", "performance_type")
             .agg(F.count_if(fresh & done).alias("_d"), F.count_if(fresh).alias("_a"))
             .withColumn("_fasr", truncate(ratio("_d", "_a"), 2)))
    by = ["dispatch_week", "rider_id", "shipping_city", "performance_type"]
    gap = F.datediff("dispatch_date", "dispatch_week")
    # Column names in week order.
    names = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
    weekly = daily.groupBy(*by).agg(
        *[F.sum(F.when(gap == i, F.col("_fasr"))).alias(n) for i, n in enumerate(names)],
        truncate(ratio(F.sum("_d"), F.sum("_a")), 2).alias("avg_fasr"))
    asked = with_rows(cohort.select(F.col("pip_date").cast("timestamp_ntz").alias("dispatch_week"),
                                    F.col("pip_date"), "shipping_city", "rider_id", "rider_name", "hub"),
                      [(f"{s}-{m}", t) for s, m, t in rules.PROGRAM_THRESHOLDS], ["performance_type", "threshold"])
    # The rider's week is matched whatever the city of the parcels was.
    scored = asked.join(weekly.drop("shipping_city"), ["dispatch_week", "rider_id", "performance_type"], "left")
    low = F.col("avg_fasr") < F.col("threshold")
    fails = low | F.col("avg_fasr").isNull() if closing else low
    return scored.withColumn("status", F.when(fails, "fail").otherwise("pass")).drop("dispatch_week")


def close_week(cohort: DataFrame, week) -> DataFrame:
    """Running rows of the week become closed."""
    return update_where(cohort, F.col("pip_date") == clock.week(clock.moment(week)).cast("date"), {"pip_status": "closed"})


def record_results(cohort: DataFrame, results: DataFrame) -> DataFrame:
    """Set pass or fail from a table of (key, pip_result)."""
    r = results.select("key", F.col("pip_result").alias("_r"))
    return cohort.join(r, "key", "left").withColumn("pip_result", F.coalesce("_r", "pip_result")).drop("_r").select(*cohort.columns)


def finalise(cohort: DataFrame) -> DataFrame:
    """Closed rows become final, then riders with a final fail leave the running cohort."""
    final = update_where(cohort, F.col("pip_status") == "closed", {"pip_status": "final"})
    failed = final.filter((F.col("pip_status") == "final") & (F.col("pip_result") == "failed")).select("rider_id")
    return delete_in(final, F.col("pip_status") == "running", "rider_id", failed)


def block_list(cohort: DataFrame, riders: DataFrame, weeks: Sequence | None = None) -> DataFrame:
    """Riders who closed with a fail."""
    rows = cohort.filter((F.col("pip_status") == "closed") & (F.col("pip_result") == "failed"))
    if weeks is not None:
        rows = rows.filter(F.col("pip_date").isin(list(weeks)))
    r = riders.select(F.col("rider_id"), F.col("node_id").alias("node_node_id"))
    return rows.select("rider_id", "rider_name", "hub", F.col("shipping_city").alias("city")).join(r, "rider_id", "left")


def message_list(cohort: DataFrame, riders: DataFrame, week=None, event: str = "rider_pip_start") -> DataFrame:
    """Work list for messages: rider, phone, text, template by city language."""
    rows = cohort if week is None else cohort.filter(F.col("pip_date") == clock.week(clock.moment(week)).cast("date"))
    language = F.when(F.col("shipping_city").isin(rules.HINDI_CITIES), "hindi").otherwise("english")
    return rows.join(riders.select("rider_id", "phone"), "rider_id", "left").select(
        "rider_id", "rider_name", "need_improvement", "shipping_city", "phone",
        F.concat(F.lit(f"{event}_"), language).alias("event"))

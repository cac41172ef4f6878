"""Rider, team and city reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from haulmark.functions import clock
from haulmark.functions.numbers import exact_sum, ratio
from haulmark.functions.text import percent_text, rupees
from haulmark.operators import payout
from haulmark.operators.aggregate import first_k_columns
from haulmark.operators.attempts import CANCELLED, COMPLETED, attempt_rank, payment_mode
from haulmark.operators.report import daily_intake_average, slot_productivity, star_rating


def _day_counts(today, done, fresh, mode):
    return {"load": today, "delivered": today & done, "fresh_attempted": today & fresh, "fresh_delivered": today & fresh & done,
            "prepaid_fresh_attempted": today & fresh & (mode == "Prepaid"),
            "prepaid_fresh_delivered": today & fresh & done & (mode == "Prepaid"),
            "cod_fresh_attempted": today & fresh & (mode == "COD"), "cod_fresh_delivered": today & fresh & done & (mode == "COD")}


def _money_or(amount, empty: str):
    return F.when(amount.isNull(), empty).otherwise(rupees(amount))


def rider_report(tasks: DataFrame, cohort: DataFrame, ledger: DataFrame, losses: DataFrame, payments: DataFrame,
                 riders: DataFrame, report_date, month_start=None, hot="auto") -> DataFrame:
    """One row per rider with work on the report day: shares, pending money and returns, fakes, stars.

    ``tasks``: task_id, awb, status, rider_id, rider_name, city, hub, dispatch_time, cod_amount,
    is_realized, is_fake_attempt. Ranks are taken within the report month (from ``month_start``).
    ``payments``: rider_id, trip_date, amount. Money sums come from the rider-level tables, each
    brought to one row per rider before the join.
    """
    day = clock.moment(report_date)
    lo = clock.month(clock.moment(month_start)) if month_start is not None else clock.month(day)
    rows = tasks.filter(F.col("awb").isNotNull() & (F.col("dispatch_time") >= lo) & (F.col("dispatch_time") < clock.plus(clock.day(day), days=1)))
    ranked = attempt_rank(rows, hot=hot).withColumn("dispatch_date", clock.day("dispatch_time"))
    own = ranked.filter(~payout.is_franchise("hub"))
    today = F.col("dispatch_date") == clock.day(day)
    past = F.col("dispatch_date") < clock.day(day)
    fake, lying = F.col("is_fake_attempt"), (F.col("status") == CANCELLED) & ~F.col("is_realized")
    counts = _day_counts(today, F.col("status") == COMPLETED, F.col("attempt_number") == 1, payment_mode())
    counts.update({"mtd_fake": fake, "today_fake": fake & today, "today_fd_pendency": lying & today, "past_fd_pendency": lying & past})
    numbers = own.groupBy("city", "hub", "rider_id", "rider_name").agg(*[F.count_if(c).alias(n) for n, c in counts.items()]).filter("load <> 0")
    fakes = first_k_columns(ranked.filter(fake & today), ["rider_id"], ["dispatch_time", "task_id"], "awb", 10)
    open_cash = ledger.filter(F.col("collected") == 0)
    owed = open_cash.groupBy("rider_id").agg(
        exact_sum(F.when(F.col("delivery_date") == day.cast("date"), F.col("amount")).otherwise(0)).alias("today_cod"),
        exact_sum(F.when(F.col("delivery_date") < day.cast("date"), F.col("amount")).otherwise(0)).alias("past_cod"))
    lost = losses.filter(clock.in_month("lost_date", day)).groupBy("rider_id").agg(
        exact_sum("shipment_value").alias("lost_amount"), F.count("awb").alias("lost_count"))
    earned = payments.filter(clock.in_month("trip_date", day)).groupBy("rider_id").agg(
        exact_sum("amount").alias("monthly_earning"),
        exact_sum(F.when(clock.day("trip_date") == clock.day(day), F.col("amount")).otherwise(0)).alias("today_earning"))
    pip = cohort.filter((F.col("pip_status") == "running") & (F.col("pip_date") == clock.week(day).cast("date"))).select(
        "rider_id", F.when(F.col("pip_result") == "failed", "failing").otherwise("passing").alias("pip_result"))
    out = numbers
    for side in (pip, owed, lost, earned, fakes):
        out = out.join(side, "rider_id", "left")
    out = out.join(riders.select("rider_id", "phone"), "rider_id", "left")
    out = out.withColumns({
        "assigned": F.col("load"), "delivery_per": ratio("delivered", "load"),
        "fasr": ratio("fresh_delivered", "fresh_attempted") * 100,
        "prepaid_fasr_per": ratio("prepaid_fresh_delivered", "prepaid_fresh_attempted"),
        "cod_fasr_per": ratio("cod_fresh_delivered", "cod_fresh_attempted"),
        "today_cod": F.coalesce("today_cod", F.lit(0.0)), "past_cod": F.coalesce("past_cod", F.lit(0.0)),
        "lost_count": F.coalesce("lost_count", F.lit(0)), "pip_result": F.coalesce("pip_result", F.lit("no_pip")),
        **{f"fr_{i}": F.coalesce(F.col(f"fr_{i}").cast("string"), F.lit("")) for i in range(1, 11)}})
    out = out.withColumns({
        "delivery_per_string": percent_text(F.col("delivery_per") * 100),
        "prepaid_fasr_per_string": percent_text(F.col("prepaid_fasr_per") * 100),
        "cod_fasr_per_string": percent_text(F.col("cod_fasr_per") * 100),
        "today_cod_string": F.when(F.col("today_cod") != 0, rupees("today_cod")).otherwise("0"),
        "past_cod_string": F.when(F.col("past_cod") != 0, rupees("past_cod")).otherwise("0"),
        "lost_amount_string": _money_or(F.col("lost_amount"), "-"),
        "monthly_earning": _money_or(F.col("monthly_earning"), "-"), "today_earning": _money_or(F.col("today_earning"), "-")})
    return star_rating(out.drop("load"))


def team_report(tasks: DataFrame, cohort: DataFrame, as_of, days: int = 30, hot="auto") -> DataFrame:
    """Rider rows of the day for team leads, with pending returns and money over the look-back."""
    day = clock.day(clock.moment(as_of))
    rows = tasks.filter(F.col("awb").isNotNull() & (F.col("dispatch_time") > clock.plus(clock.moment(as_of), days=-days)))
    ranked = attempt_rank(rows, hot=hot).withColumn("dispatch_date", clock.day("dispatch_time"))
    today, old = F.col("dispatch_date") == day, F.col("dispatch_date") <= clock.plus(day, days=-1)
    done = F.col("status") == COMPLETED
    counts = _day_counts(today, done, F.col("attempt_number") == 1, payment_mode())
    counts.update({"failed_collection_pendency": old & (F.col("status") == CANCELLED) & ~F.col("is_realized"), "_fake": F.col("is_fake_attempt")})
    owed = exact_sum(F.when(old & done & ~F.col("is_collected"), F.col("cod_amount")).otherwise(0))
    out = ranked.groupBy("city", "hub", "rider_id", "rider_name").agg(
        *[F.count_if(c).alias(n) for n, c in counts.items()], owed.alias("_owed")).filter("load <> 0")
    pip = cohort.filter(F.col("pip_status") == "running").select(
        "rider_id", F.when(F.col("pip_result") == "failed", "failing").otherwise("passing").alias("pip_result")).distinct()
    def pct(a, b):
        return F.rint(ratio(a, b) * 100)
    return out.join(pip, "rider_id", "left").select(
        F.col("city").alias("shipping_city"), "hub", "rider_id", "rider_name", "load", pct("delivered", "load").alias("delivery_per"),
        pct("fresh_delivered", "fresh_attempted").alias("fasr"), pct("prepaid_fresh_delivered", "prepaid_fresh_attempted").alias("prepaid_fasr"),
        pct("cod_fresh_delivered", "cod_fresh_attempted").alias("cod_fasr"), "failed_collection_pendency",
        F.rint("_owed").alias("cod_collection_pendency"), F.nullif("_fake", F.lit(0)).alias("mtd_fake"), "pip_result")


def slot_productivity_report(tasks: DataFrame, ops: DataFrame) -> DataFrame:
    """Monthly intake per day joined with slot productivity; franchise hubs left out by the caller's rows."""
    return daily_intake_average(ops).join(slot_productivity(tasks), ["shipping_city", "dispatch_month"], "left").filter(
        F.col("shipping_city").isNotNull())

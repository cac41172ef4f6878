"""Service levels: on-time flags, pending work, the daily hub grid, ageing, clusters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from haulmark import rules
from haulmark.functions import clock, lookup
from haulmark.functions.numbers import int_ratio, ratio
from haulmark.operators.aggregate import distinct_when
from haulmark.operators.attempts import COMPLETED
from haulmark.operators.shape import all_days


def on_time(actual: str | Column, promise: str | Column) -> Column:
    """1 by the promised date, 0 later, null when either is unknown."""
    a, p = lookup.as_col(actual).cast("date"), lookup.as_col(promise).cast("date")
    return F.when(a > p, 0).when(a <= p, 1)


def on_time_known(actual: str | Column, promise: str | Column) -> Column:
    """Two-state form: the day of ``actual`` at or before the promised moment, else 0."""
    return F.when(clock.day(actual) <= lookup.as_col(promise), 1).otherwise(0)


def outlier_flag(delivered, ideal_pickup, pickup, first_ofd, created) -> Column:
    """Very late against the ideal pickup, or times in the wrong order."""
    h = clock.hours_between
    wrong = ((h(delivered, ideal_pickup) > rules.OUTLIER_HOURS) | (h(pickup, first_ofd) < 0)
             | (h(pickup, delivered) < 0) | (h(created, delivered) < 0))
    return F.when(wrong, 1).otherwise(0)


def action_bucket(df: DataFrame, as_of, out: str = "action_bucket") -> DataFrame:
    """Class of pending work. Needs ``shipment_status, datetime, last_ofd, delivery_attempts``."""
    status = F.col("shipment_status")
    sent_out = status == "Out for Delivery"
    today = clock.moment(as_of).cast("date")
    return df.withColumn(out, lookup.first_match([
        (status.isin(rules.PICKUP_STATUSES) & F.col("datetime").isNotNull(), "pickup"),
        (sent_out & (F.col("last_ofd").cast("date") == today), "action_taken"),
        (sent_out & (F.col("delivery_attempts") >= 1), "reattempt"),
        (sent_out, "fresh_attempt"),
    ], lookup.decode(status, rules.ACTION_BY_STATUS, "action_taken")))


def action_date(df: DataFrame, out: str = "action_date") -> DataFrame:
    """Due day of the pending work."""
    bucket = F.col("action_bucket")
    def ts(c):
        return F.col(c).cast("timestamp_ntz")
    return df.withColumn(out, lookup.first_match([
        (bucket == "pickup", ts("edd")),
        (bucket.isin("fresh_attempt", "reattempt"), ts("ndd")),
        (bucket == "ndr_required", ts("last_failed_date")),
        (bucket == "RTO OFD", ts("rto_freeze_date")),
        (bucket == "RTO Delivery", clock.plus(ts("rto_ofd_date"), days=1)),
        (bucket == "Lost", clock.day("lost_mark_time")),
    ], ts("modified_date")))


def missing_scan(df: DataFrame, as_of, by: Sequence[str] = ("shipping_city", "last_mile_hub"),
                 hours: int = 24) -> DataFrame:
    """Open, picked-up shipments without a scan for ``hours``, by day of the last scan."""
    stale = df.filter((F.col("last_scan_time") <= clock.plus(clock.moment(as_of), hours=-hours))
                      & (F.col("closure_status") != "closed") & F.col("pickup_date").isNotNull())
    return (stale.withColumn("missing_action_date", F.col("last_scan_time").cast("date"))
            .groupBy(*by, "missing_action_date").agg(F.count_distinct("awb").alias("missing_shipment")))


PENDING = {"fresh_pending": "fresh_attempt", "reattempt_pending": "reattempt", "pickup_pending": "pickup"}


def pending_counts(df: DataFrame, by: Sequence[str], literal_lost: bool = False) -> DataFrame:
    """Distinct shipments per class of pending work.

    ``literal_lost`` compares with the lower-case spelling, which never occurs.
    """
    flags = {n: F.col("action_bucket") == b for n, b in PENDING.items()}
    flags["lost_marked"] = F.col("action_bucket") == ("lost" if literal_lost else "Lost")
    return distinct_when(df, by, "awb", flags)


def delivery_by_edd(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Shipments due per day: on-time counts, whole-number and real ratios, ratings."""
    rows = df.filter(F.col("pickup_date").isNotNull())
    # One row per (group, parcel) first: the distinct count then needs no second shuffle of the input.
    per_awb = rows.groupBy(*by, "awb").agg(
        F.sum("otd").alias("otd"), F.sum("ofd").alias("ofd"),
        F.count_if(F.col("shipment_status") == "Delivered").alias("delivered"),
        F.count("rating").alias("no_ratings"), F.sum("rating").alias("rating_sum"))
    out = per_awb.groupBy(*by).agg(
        F.sum("otd").alias("otd"), F.sum("ofd").alias("ofd"), F.sum("delivered").alias("delivered"),
        F.count("awb").alias("efd"), F.sum("no_ratings").alias("no_ratings"),
        F.sum("rating_sum").alias("rating_sum"))
    return out.select(
        *by, "otd", "ofd", "delivered", "efd",
        int_ratio("otd", "efd").alias("otd_pct"), int_ratio("ofd", "efd").alias("ofd_pct"),
        int_ratio("delivered", "efd").alias("del_pct"), ratio("otd", "efd").alias("otd_ratio"),
        ratio("ofd", "efd").alias("ofd_ratio"), ratio("delivered", "efd").alias("del_ratio"),
        "no_ratings", ratio("rating_sum", "no_ratings").alias("avg_rating"))


def intake_by_day(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Shipments taken in per day and how many are heavy."""
    heavy = F.col("chargeable_weight") >= rules.HEAVY_GRAMS
    per_awb = (df.filter(F.col("datetime").isNotNull()).withColumn("datetime", clock.day("datetime"))
               .groupBy(*by, "datetime", "awb").agg(F.count_if(heavy).alias("heavy")))
    return per_awb.groupBy(*by, "datetime").agg(
        F.count("awb").alias("drr"), F.sum("heavy").alias("heavy_shipments"))


def hub_grid(df: DataFrame, start: Column, end: Column,
             by: Sequence[str] = ("shipping_city", "last_mile_hub")) -> DataFrame:
    """Every hub with every day of the range."""
    hubs = df.select(*by).dropna().filter(F.col(by[-1]) != "").distinct()
    return all_days(hubs, start, end, "datetime").withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


def productivity(df: DataFrame, by: Sequence[str], target: DataFrame | None = None) -> DataFrame:
    """Deliveries per rider day and per pincode, and use of the target. Needs ``total_delivered, mandays``."""
    out = df.withColumns({
        "productivity": ratio("total_delivered", "mandays"),
        "load_per_pincode": ratio("total_delivered", "distinct_pincodes"),
    })
    if target is None:
        return out
    return out.join(target, list(by), "left").withColumn("cap_util", ratio("productivity", "target_productivity"))


def rider_days(ranked: DataFrame, by: Sequence[str]) -> DataFrame:
    """Deliveries, distinct riders and distinct pincodes per group.

    Grouping by rider and pincode first shrinks the rows the two distinct counts see.
    """
    small = ranked.groupBy(*by, "rider_id", "pincode").agg(F.count_if(F.col("status") == COMPLETED).alias("_d"))
    return small.groupBy(*by).agg(F.sum("_d").alias("total_delivered"), F.count_distinct("rider_id").alias("mandays"),
                                  F.count_distinct("pincode").alias("distinct_pincodes"))


def ageing(ops: DataFrame, as_of, picked_by) -> DataFrame:
    """Open shipments picked up on or before ``picked_by`` and not closed before ``as_of``."""
    today, bound = clock.moment(as_of), clock.moment(picked_by)
    still_open = ((F.col("pickuptime") < clock.plus(clock.day(bound), days=1))
                  & ~F.col("shipment_status").isin(rules.AGEING_EXCLUDED)
                  & ((F.col("delivertime") >= clock.day(today)) | F.col("delivertime").isNull())
                  & ((F.col("rto_delivered_time") >= clock.day(today)) | F.col("rto_delivered_time").isNull()))
    return ops.filter(still_open).withColumn("age_interval", clock.days_between(today, "pickuptime"))


def ageing_summary(ops: DataFrame, as_of, picked_by) -> DataFrame:
    return (ageing(ops, as_of, picked_by).groupBy("user_name", "shipment_status", F.col("age_interval").alias("ageing"))
            .agg(F.count_distinct("awb").alias("orders")))


def cluster_kpis(ops: DataFrame, ranked: DataFrame, by: Sequence[str], window: Column | None = None,
                 dispatch_window: Column | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """On-time percentages by due date joined with first-attempt success by dispatch date.

    ``ops``: one row per parcel with ``awb, edd, delivertime, first_ofd_time`` and the
    group columns. ``ranked``: attempts with the same group columns. ``window`` and
    ``dispatch_window`` limit the two sides to a day or a week; ``extra`` names
    period columns present on both sides when no window is given.
    """
    due = ops if window is None else ops.filter(window)
    sent = ranked if dispatch_window is None else ranked.filter(dispatch_window)
    groups = [*by, *extra]
    flags = {"_otd": clock.day("delivertime") <= F.col("edd"), "_ofd": clock.day("first_ofd_time") <= F.col("edd")}
    on_due = distinct_when(due, groups, "awb", flags, total="_n").select(
        *groups, ratio(F.col("_otd") * 100.0, "_n").alias("otd"), ratio(F.col("_ofd") * 100.0, "_n").alias("ofd"))
    fresh = F.col("attempt_number") == 1
    tried = sent.groupBy(*groups).agg(
        F.count_if(fresh & (F.col("status") == COMPLETED)).alias("_d"), F.count_if(fresh).alias("_a")).select(
        *groups, ratio(F.col("_d") * 100.0, "_a").alias("fasr"))
    return on_due.join(tried, groups, "left")


def lead_nodes(node_stats: DataFrame, rider_stats: DataFrame, job_id: int) -> DataFrame:
    """Places assigned to riders of one planning job."""
    riders = rider_stats.filter(F.col("job_id") == job_id).select(F.col("id").alias("assigned_rider_id"), "rider_id")
    return node_stats.join(riders, "assigned_rider_id", "inner").select("rider_id", "lat", "lng")


def hub_service_pincodes(pins: DataFrame, cities: DataFrame, shipper_id: int, policy: str, city: str) -> DataFrame:
    served = pins.filter((F.col("shipper_id") == shipper_id) & (F.col("cost_policy") == policy))
    named = cities.filter(F.col("city_name") == city).select("shipper_city_id")
    return served.join(named, "shipper_city_id", "inner").select("pincode")

"""Rider stars and city profit and loss."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from haulmark import rules
from haulmark.functions import clock, lookup
from haulmark.functions.numbers import exact_sum, ratio
from haulmark.operators.aggregate import with_total

# Bounds of the five stars.
STAR_BOUNDS = {"delivery": 0.8, "prepaid": 0.9, "cod": 0.7, "lost": 1000, "fake_share": 0.001, "fake_month": 10}


def star_rating(df: DataFrame) -> DataFrame:
    """Five 0/1 flags, their sum, one column per possible sum, and a remark.

    Needs ``delivery_per, prepaid_fasr_per, cod_fasr_per, past_fd_pendency, past_cod,
    lost_amount, today_fake, mtd_fake, assigned``.
    """
    b = STAR_BOUNDS
    def flag(cond):
        return F.when(cond, 1).otherwise(0)
    flags = {
        "delivery_flag": flag(F.col("delivery_per") >= b["delivery"]),
        "fasr_flag": flag((F.col("prepaid_fasr_per") > b["prepaid"]) & (F.col("cod_fasr_per") > b["cod"])),
        "pendency_flag": flag((F.col("past_fd_pendency") == 0) & (F.col("past_cod") == 0)),
        "lost_flag": F.when(F.col("lost_amount") >= b["lost"], 0).otherwise(1),
        "fake_flag": flag((ratio("today_fake", "assigned") < b["fake_share"]) & (F.col("mtd_fake") <= b["fake_month"])),
    }
    total = F.lit(0)
    for n in flags:
        total = total + F.col(n)
    out = df.withColumns(flags).withColumn("final_rating", total)
    stars = {f"star_score_{i}": flag(F.col("final_rating") == i) for i in rules.STAR_REMARKS}
    return out.withColumns({**stars, "star_remark": lookup.decode("final_rating", rules.STAR_REMARKS)})


def city_revenue(revenue: DataFrame, as_of) -> DataFrame:
    """Delivered revenue per city: yesterday and month to date.

    ``revenue``: awb, shipping_city, shipping_partner, shipment_status, closure_date, final_total_charges.
    """
    now = clock.moment(as_of)
    today, yesterday = clock.day(now), clock.plus(clock.day(now), days=-1)
    rows = revenue.filter((F.col("closure_date") >= clock.month(now)) & (F.col("closure_date") < today)
                          & (F.col("shipping_partner") == rules.OWN_CARRIER)
                          & (F.col("shipment_status") == "Delivered") & F.col("shipping_city").isNotNull())
    last_day = F.col("closure_date") >= yesterday
    charge = F.col("final_total_charges")
    # One row per parcel and city first; the distinct count of yesterday is then a plain count.
    per_awb = rows.groupBy("shipping_city", "awb").agg(
        exact_sum(F.when(last_day, charge).otherwise(0)).alias("_y"), exact_sum(charge).alias("_m"),
        F.count(F.lit(1)).alias("_n"), F.max(last_day.cast("int")).alias("_yes"))
    return per_awb.groupBy(F.col("shipping_city").alias("city")).agg(
        exact_sum("_y").alias("revenue_drr"), F.sum(F.when(F.col("awb").isNotNull(), F.col("_yes"))).alias("order_drr"),
        exact_sum("_m").alias("mtd_revenue"), F.sum(F.when(F.col("awb").isNotNull(), F.col("_n"))).alias("mtd_orders"))


def city_cost(pay: DataFrame, fuel: DataFrame, riders: DataFrame, mid_mile: DataFrame, as_of) -> DataFrame:
    """Rider pay, fuel, vendor charge and a day's share of mid-mile cost per city.

    ``pay``: rider_id, trip_date, amount. ``fuel``: rider_id, tour_date, fuel_payout.
    ``riders``: rider_id, city, vendor_charge_percent, vendor_charge_fuel_percent.
    ``mid_mile``: city, month_cost. A missing part of a city day leaves its cost unknown.
    """
    now = clock.moment(as_of)
    today, yesterday = clock.day(now), clock.plus(clock.day(now), days=-1)
    paid = pay.groupBy("rider_id", "trip_date").agg(exact_sum("amount").alias("pay_amount"))
    fuelled = fuel.groupBy("rider_id", F.col("tour_date").alias("trip_date")).agg(exact_sum("fuel_payout").alias("fuel_payout"))
    rows = paid.join(fuelled, ["rider_id", "trip_date"], "left").join(riders, "rider_id", "left")
    charge = (F.col("pay_amount") * F.col("vendor_charge_percent") * 0.01
              + F.col("fuel_payout") * F.col("vendor_charge_fuel_percent") * 0.01)
    per_day = rows.withColumn("_charge", charge).groupBy("city", "trip_date").agg(
        exact_sum("pay_amount").alias("pay_amount"), exact_sum("fuel_payout").alias("fuel_payout"),
        exact_sum("_charge").alias("vendor_charge"))
    daily = per_day.join(mid_mile, "city", "left").withColumn(
        "total_cost", F.col("pay_amount") + F.col("fuel_payout") + F.col("vendor_charge")
        + F.col("month_cost") / rules.MONTH_DAYS_FOR_MID_MILE)
    mtd = daily.filter((F.col("trip_date") >= clock.month(now)) & (F.col("trip_date") < today))
    return mtd.groupBy("city").agg(
        exact_sum(F.when(F.col("trip_date") == yesterday, F.col("total_cost"))).alias("cost_drr"),
        exact_sum("total_cost").alias("mtd_cost"))


def pnl_daily(revenue: DataFrame, cost: DataFrame) -> DataFrame:
    """City rows and a total row; per-order figures are taken from the sums."""
    rows = revenue.join(cost, "city", "left").withColumns({
        "profit_drr": F.col("revenue_drr") - F.col("cost_drr"), "mtd_profit": F.col("mtd_revenue") - F.col("mtd_cost")})
    money = ["revenue_drr", "cost_drr", "profit_drr", "mtd_revenue", "mtd_cost", "mtd_profit"]
    sums = {c: exact_sum(c) for c in money}
    sums.update({"order_drr": F.sum("order_drr"), "mtd_orders": F.sum("mtd_orders")})
    return with_total(rows, "city", sums, ratios={
        "mtd_rpo": ("mtd_revenue", "mtd_orders"), "mtd_cpo": ("mtd_cost", "mtd_orders"), "mtd_ppo": ("mtd_profit", "mtd_orders")})


def actual_charges(revenue: DataFrame, rates: DataFrame) -> DataFrame:
    """Contracted charge per parcel.

    ``rates``: user_id, city, forward_rpo, rto_multiplier, cod_charge. Capital-region
    parcels use the rates of the main city.
    """
    city = lookup.canonical("shipping_city", rules.MERGED_CITIES)
    cod = F.when(F.col("cod_charge") == "Yes", 1).otherwise(0)
    joined = revenue.withColumn("city", city).join(rates, ["user_id", "city"], "inner")
    charge = lookup.first_match([
        (F.col("shipment_status") == "Delivered", F.col("forward_rpo") + cod * F.col("finops_cod_charge")),
        (F.col("shipment_status") == "RTO Delivered", F.col("forward_rpo") * (F.col("rto_multiplier") + 1)),
    ], 0.0)
    return joined.withColumn("actual_charges", charge)


def slot_productivity(rows: DataFrame) -> DataFrame:
    """Monthly averages per city: weight per attempt, attempts and deliveries per rider slot day.

    ``rows``: shipping_city, dispatch_time, task_id, rider_id, status, chargeable_weight.
    """
    done = F.col("status") == "COMPLETED"
    by = ["shipping_city", "dispatch_date", "slot"]
    slotted = rows.withColumns({"dispatch_date": clock.day("dispatch_time"), "slot": clock.slot_of("dispatch_time", "productivity")})
    per_rider = slotted.groupBy(*by, "rider_id").agg(
        F.count("task_id").alias("attempted"), F.count_if(done & F.col("task_id").isNotNull()).alias("delivered"),
        F.count_if(F.col("chargeable_weight") >= rules.HEAVY_GRAMS_PRODUCTIVITY).alias("heavy_attempted"),
        exact_sum("chargeable_weight").alias("weight"))
    per_slot = per_rider.groupBy(*by).agg(
        F.sum("attempted").alias("attempted"), F.sum("delivered").alias("delivered"),
        F.sum("heavy_attempted").alias("heavy_attempted"), F.count("rider_id").alias("mandays"),
        F.floor(exact_sum("weight")).alias("weight_load"))
    early, late = F.col("slot") == "Morning", F.col("slot") == "Afternoon"
    def of(cond, c):
        return F.sum(F.when(cond, F.col(c)))
    return per_slot.groupBy("shipping_city", clock.month("dispatch_date").alias("dispatch_month")).agg(
        ratio(F.sum("weight_load"), F.sum("attempted")).alias("avg_weight"),
        ratio(of(early, "attempted"), of(early, "mandays")).alias("mn_att_prod"),
        ratio(of(early, "delivered"), of(early, "mandays")).alias("mn_del_prod"),
        ratio(of(late, "attempted"), of(late, "mandays")).alias("af_att_prod"),
        ratio(of(late, "delivered"), of(late, "mandays")).alias("af_del_prod"))


def daily_intake_average(ops: DataFrame) -> DataFrame:
    """Average parcels due per day, per city and month."""
    per_day = ops.groupBy("shipping_city", "edd").agg(F.count("awb").alias("drr"))
    return per_day.groupBy("shipping_city", clock.month("edd").alias("dispatch_month")).agg(
        ratio(F.sum("drr"), F.count("drr")).alias("drr"))

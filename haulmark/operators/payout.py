"""Rider pay: per order, per day, per month, guarantees, bonuses, allocation back to orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from haulmark import rules
from haulmark.functions import clock, lookup
from haulmark.functions.numbers import exact_sum, ratio
from haulmark.operators.attempts import CANCELLED, COMPLETED
from haulmark.operators.joins import not_in
from haulmark.operators.shape import like_any
from haulmark.operators.skew import salted_join

DAY_KEY = ["dispatch_date", "city", "hub", "rider_id", "payout_structure"]


def _bands(city: Column, weight: Column, bands) -> Column:
    """First band whose bound is exceeded, per city; bands are kept in their given order."""
    return lookup.first_match([((city == c) & (weight > above), float(amount))
                               for c, rows in bands.items() for above, amount in rows], 0.0)


def order_pay(df: DataFrame, card: rules.OrderCard) -> DataFrame:
    """Pay parts of one order.

    Needs ``status, payout_structure, city, dispatch_time, chargeable_weight,
    delivered_rate, cancellation_remarks`` and, for cards with client rates, ``user_id``.
    """
    city = F.col("city")
    by_order = F.col("payout_structure") == "ORDER"
    delivered = by_order & (F.col("status") == COMPLETED)
    base = [((city == c), F.lit(float(a)) + (F.col("delivered_rate") if c in card.pincode_cities else F.lit(0.0)))
            for c, a in card.base.items()]
    pay = lookup.first_match(base, 0.0)
    if card.special_clients:
        special = lookup.decode(city, {c: float(a) for c, a in card.client_base.items()}, 0.0)
        pay = F.when(F.col("user_id").isin(list(card.special_clients)), special).otherwise(pay)
    evening = lookup.decode(city, {c: float(a) for c, a in card.evening.items()}, 0.0) if card.evening else F.lit(0.0)
    visit = lookup.decode(city, {c: float(a) for c, a in card.failed_visit.items()}, 0.0) if card.failed_visit else F.lit(0.0)
    real_visit = (by_order & (F.col("status") == CANCELLED)
                  & ~F.lower(F.col("cancellation_remarks")).contains(rules.OPERATIONAL_CONSTRAINT))
    late = clock.hour("dispatch_time") >= rules.EVENING_HOUR
    return df.withColumns({
        "org_id_pay": F.lit(0.0),
        "delivery_incentive": F.when(delivered, pay).otherwise(0.0),
        "weight_incentive": F.when(delivered, _bands(city, F.col("chargeable_weight"), card.weight_bands)).otherwise(0.0),
        "failed_delivery_incentive": F.when(real_visit, visit).otherwise(0.0),
        "evening_order_incentive": F.when(delivered & late, evening).otherwise(0.0),
    })


def franchise_order_pay(df: DataFrame, base=rules.FRANCHISE_BASE, weight=rules.FRANCHISE_WEIGHT) -> DataFrame:
    """Pay of a delivered order of a franchise hub."""
    def here(city, hubs):
        c = F.col("city") == city
        return c & F.col("hub").isin(hubs) if hubs else c
    done = F.col("status") == COMPLETED
    fixed = lookup.first_match([(here(c, h), float(a)) for c, h, a in base], 0.0)
    extra = lookup.first_match([(here(c, h) & (F.col("chargeable_weight") > g), float(a)) for c, h, g, a in weight], 0.0)
    return df.withColumns({
        "delivery_incentive": F.when(done, fixed).otherwise(0.0),
        "weight_incentive": F.when(done, extra).otherwise(0.0),
    })


def slab_pay(delivered: Column, city: Column, slabs: Sequence[rules.Slab]) -> Column:
    """Day pay by number of deliveries; slabs of a city are tried in order, an unknown city pays 0."""
    def amount(s):
        return F.lit(float(s.base)) + F.lit(float(s.rate)) * (delivered - s.beyond)
    arms = [((city == s.city) & (delivered <= s.upto) if s.upto is not None else (city == s.city), amount(s))
            for s in slabs]
    return lookup.first_match(arms, 0.0)


def guarantee(city: Column, hub: Column, rows: Sequence[rules.Guarantee]) -> Column:
    arms = []
    for g in rows:
        cond = (city == g.city) & (F.col(g.measure) >= g.at_least)
        arms.append((cond & (hub == g.hub) if g.hub else cond, float(g.amount)))
    return lookup.first_match(arms, 0.0)


def minimum_guarantee(days: DataFrame, rows: Sequence[rules.Guarantee]) -> DataFrame:
    """Guaranteed amount of the day and the top-up to reach it."""
    mg = F.when(F.col("payout_structure") == "ORDER", guarantee(F.col("city"), F.col("hub"), rows)).otherwise(0.0)
    short = F.col("order_earning") < F.col("order_mg")
    return days.withColumn("order_mg", mg).withColumn(
        "mg_payed", F.when(short, F.col("order_mg") - F.col("order_earning")).otherwise(0.0))


def fasr_bonus(fasr: Column, delivered: Column, steps=rules.FASR_BONUS) -> Column:
    return lookup.first_match([(fasr > bound, delivered * float(per)) for bound, per in steps], 0.0)


def rider_day(orders: DataFrame, card: str = "april") -> DataFrame:
    """One row per rider, hub and day with all pay parts.

    ``orders`` comes from :func:`order_pay` with ``task_id, slot, order_type``.
    One row per task is made first, so counts of distinct tasks are plain sums.
    """
    pays = {"org_id_pay": "org_id_pay", "delivery_pay": "delivery_incentive", "heavy_pay": "weight_incentive",
            "vfd_pay": "failed_delivery_incentive", "evening_pay": "evening_order_incentive"}
    done, fresh = F.col("status") == COMPLETED, F.col("order_type") == "Fresh"
    flags = {"delivered": done, "morning_delivered": done & (F.col("slot") == "morning"),
             "evening_delivered": done & (F.col("slot") == "evening"),
             "fresh_delivered": done & fresh, "fresh_attempted": fresh}
    dated = orders.withColumn("dispatch_date", clock.day("dispatch_time"))
    per_task = dated.groupBy(*DAY_KEY, "task_id").agg(
        *[F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in flags.items()],
        *[exact_sum(c).alias(n) for n, c in pays.items()])
    days = per_task.groupBy(*DAY_KEY).agg(
        *[F.sum(n).alias(n) for n in flags], F.count("task_id").alias("attempted"),
        *[exact_sum(n).alias(n) for n in pays])
    days = days.withColumn("order_earning", F.col("org_id_pay") + F.col("delivery_pay") + F.col("heavy_pay")
                           + F.col("vfd_pay") + F.col("evening_pay"))
    days = minimum_guarantee(days, rules.GUARANTEES[card])
    fixed = slab_pay(F.col("delivered"), F.col("city"), rules.SLABS[card])
    return (days.withColumns({"fixed_pay": F.when(F.col("payout_structure") == "FIXED", fixed).otherwise(0.0),
                              "fasr": ratio("fresh_delivered", "fresh_attempted")})
            .withColumn("total_pay", F.col("order_earning") + F.col("mg_payed") + F.col("fixed_pay")))


def payout_table(days: DataFrame) -> DataFrame:
    """The stored rider-day table with the success bonus and the key."""
    bonus = fasr_bonus(F.col("fasr"), F.col("delivered"))
    zero = F.lit(0.0)
    subtotal = F.col("delivery_pay") + F.col("heavy_pay") + F.col("evening_pay") + F.col("fasr_pay") + F.col("mg_payed")
    return days.withColumn("fasr_pay", bonus).select(
        F.col("city").alias("shipping_city"), F.col("hub").alias("node_name"),
        F.col("rider_id").alias("num_rider_id"), "payout_structure", "dispatch_date",
        F.col("attempted").alias("assigned"), "delivered", "fasr",
        F.col("delivery_pay").alias("order_base_0_pay"), F.col("heavy_pay").alias("order_base_3000_pay"),
        zero.alias("order_base_5000_pay"), zero.alias("order_slot_0_12_pay"), zero.alias("order_slot_12_15_pay"),
        F.col("evening_pay").alias("order_slot_15_24_pay"), zero.alias("pincode_rate_pay"), "fasr_pay",
        "mg_payed", "fixed_pay", zero.alias("fixed_milestone_pay"), subtotal.alias("order_subtotal"),
        F.col("fixed_pay").alias("fixed_subtotal"), (subtotal + F.col("fixed_pay")).alias("total_pay"),
        F.concat_ws("", F.col("rider_id").cast("string"), F.lit("-"), F.date_format("dispatch_date", "yyyy-MM-dd"),
                    F.lit("-"), F.col("hub")).alias("key"))


def corrected_guarantee(table: DataFrame, until) -> DataFrame:
    """Raise the top-up of listed hubs to their guarantee for days up to ``until``."""
    goal = lookup.decode("node_name", {h: float(a) for h, a in rules.GUARANTEE_FIX.items()})
    due = ((F.col("shipping_city") == rules.GUARANTEE_FIX_CITY)
           & (F.col("delivered") >= rules.GUARANTEE_FIX_MIN_DELIVERED)
           & (F.col("dispatch_date") <= clock.moment(until)) & (F.col("order_subtotal") <= goal))
    return table.withColumn("mg_payed", F.when(
        due, F.col("mg_payed") + goal - F.col("order_subtotal")).otherwise(F.col("mg_payed")))


ORDER_PARTS = ["order_base_0_pay", "order_base_3000_pay", "order_base_5000_pay", "order_slot_0_12_pay",
               "order_slot_12_15_pay", "order_slot_15_24_pay", "pincode_rate_pay", "fasr_pay", "mg_payed"]
PAYOUT_TOTALS = {"order_subtotal": ORDER_PARTS, "total_pay": [*ORDER_PARTS, "fixed_pay", "fixed_milestone_pay"]}


def attendance_bonus(days: DataFrame, by: Sequence[str], card: str = "april") -> DataFrame:
    """Days present and the bonus for enough full days."""
    rule = rules.ATTENDANCE[card]
    per_day = days.groupBy(*by, "dispatch_date").agg(F.max("delivered").alias("_top"))
    counted = per_day.groupBy(*by).agg(F.count_if(F.col("_top") >= rule.present_from).alias("attendance"),
                                       F.count_if(F.col("_top") >= rule.bonus_from).alias("_full"))
    needed = lookup.decode("city", rule.days, rule.days_other) if rule.days else F.lit(rule.days_other)
    return counted.withColumn("attendance_incentive", F.when(
        F.col("_full") >= needed, float(rules.ATTENDANCE_BONUS)).otherwise(0.0)).drop("_full")


def rider_month(days: DataFrame, card: str = "april") -> DataFrame:
    """Month totals per rider, hub and pay structure."""
    by = ["dispatch_month", "city", "rider_id", "hub", "payout_structure"]
    dated = days.withColumn("dispatch_month", clock.month("dispatch_date"))
    parts = ["org_id_pay", "delivery_pay", "heavy_pay", "vfd_pay", "evening_pay", "mg_payed"]
    rule = rules.ATTENDANCE[card]
    needed = lookup.decode("city", rule.days, rule.days_other) if rule.days else F.lit(rule.days_other)
    # A rider-day is one row here, so distinct days are plain counts.
    out = dated.groupBy(*by).agg(
        F.count_if(F.col("delivered") >= rule.present_from).alias("attendance"),
        F.count_if(F.col("delivered") >= rule.bonus_from).alias("_full"), F.sum("delivered").alias("delivered"),
        *[exact_sum(p).alias(p) for p in parts], exact_sum("fixed_pay").alias("fixed_pay"))
    variable = (F.col("org_id_pay") + F.col("delivery_pay") + F.col("vfd_pay") + F.col("evening_pay")
                + F.col("mg_payed") + F.col("heavy_pay"))
    bonus = F.when(F.col("_full") >= needed, float(rules.ATTENDANCE_BONUS)).otherwise(0.0)
    return (out.withColumns({"total_variable_pay": variable, "attendance_incentive": bonus})
            .withColumn("total_pay", F.col("total_variable_pay") + F.col("fixed_pay") + F.col("attendance_incentive"))
            .drop("_full"))


def hub_month(months: DataFrame) -> DataFrame:
    """Month totals per hub and cost per order."""
    parts = ["org_id_pay", "delivery_pay", "heavy_pay", "vfd_pay", "evening_pay", "mg_payed",
             "total_variable_pay", "fixed_pay", "attendance_incentive", "total_pay"]
    out = months.groupBy("dispatch_month", "city", "hub").agg(
        F.sum("attendance").alias("mandays"), F.sum("delivered").alias("delivered"),
        *[exact_sum(p).alias(p) for p in parts])
    return out.withColumn("cpo", ratio("total_pay", "delivered"))


def leave_calendar(days: DataFrame, month) -> DataFrame:
    """Each rider of the month with every day of it; ``delivered`` is null on days off."""
    first = clock.month(clock.moment(month))
    here = days.filter(clock.in_month("dispatch_date", month))
    grid = here.select("city", "rider_id").distinct().withColumn(
        "dates", F.explode(F.sequence(first.cast("date"), F.last_day(first), F.expr("INTERVAL '1' DAY"))))
    worked = here.groupBy("city", "rider_id", F.col("dispatch_date").cast("date").alias("dates")).agg(
        F.sum("delivered").alias("delivered"))
    return grid.join(worked, ["city", "rider_id", "dates"], "left")


def unbroken_attendance(days: DataFrame, month, windows=None) -> DataFrame:
    """Riders without a day off inside their city's window, per bonus type.

    A rider has no day off when the distinct days worked in the window equal its
    length. Cities without a window always qualify; one city takes no part.
    """
    windows = windows or rules.UNBROKEN_WINDOWS
    first = clock.month(clock.moment(month))
    here = days.filter(clock.in_month("dispatch_date", month))
    worked = here.groupBy("city", "rider_id", "dispatch_date").agg(F.count(F.lit(1)).alias("_n"))
    riders = worked.select("city", "rider_id").distinct()
    out = None
    for name, spans in windows.items():
        lo = lookup.decode("city", {c: a for c, (a, _) in spans.items()})
        hi = lookup.decode("city", {c: b for c, (_, b) in spans.items()})
        dom = F.dayofmonth("dispatch_date")
        present = worked.groupBy("city", "rider_id").agg(F.count_if(dom.between(lo, hi)).alias("_worked"))
        broken = present.filter(F.col("_worked") < hi - lo + 1)
        kept = not_in(riders.filter(F.col("city") != rules.UNBROKEN_EXCLUDED_CITY), "rider_id", broken, "rider_id")
        typed = kept.select("city", "rider_id", F.lit(rules.UNBROKEN_BONUS).alias("amount"), F.lit(name).alias("type"))
        out = typed if out is None else out.unionByName(typed)
    return out.distinct()


def allocate_to_orders(orders: DataFrame, days: DataFrame, hot="auto") -> DataFrame:
    """Delivered orders with their full cost: own pay, fuel, and a share of top-up and fixed pay."""
    dated = orders.filter(F.col("status") == COMPLETED).withColumn("dispatch_date", clock.day("dispatch_time"))
    shares = days.select(*DAY_KEY, F.coalesce(ratio("mg_payed", "delivered"), F.lit(0.0)).alias("mg_amount"),
                         F.coalesce(ratio("fixed_pay", "delivered"), F.lit(0.0)).alias("fixed_amount"))
    joined = salted_join(dated, shares, DAY_KEY, "left", hot=hot)
    own = (F.col("org_id_pay") + F.col("delivery_incentive") + F.col("weight_incentive")
           + F.col("failed_delivery_incentive") + F.col("evening_order_incentive") + F.col("fuel_amount"))
    return joined.withColumn("awb_pay", own + F.col("mg_amount") + F.col("fixed_amount"))


def fuel_per_task(tours: DataFrame) -> DataFrame:
    """Fuel pay of a tour per completed task; 0 when not automated or nothing was completed."""
    paid = F.when(F.col("fuel_payout_automation") == "true", F.col("fuel_payout")).otherwise(0.0)
    return tours.withColumn("fuel_amount", F.coalesce(ratio(paid, "completed_tasks"), F.lit(0.0)))


def rider_tour_days(tours: DataFrame) -> DataFrame:
    """Fuel, tasks and distance per rider and tour date."""
    by = ["node_name", "node_type", "tour_date", "rider_id", "rider_name", "fuel_payout_automation"]
    return tours.groupBy(*by).agg(
        exact_sum("fuel_payout").alias("fuel_payout"), F.sum("total_tasks").alias("assigned_orders"),
        F.sum("completed_tasks").alias("delivered_orders"), exact_sum("covered_distance").alias("covered_distance"),
        F.count("tour_id").alias("tours"))


def fuel_eligibility(tour_days: DataFrame, cod_pending: DataFrame | None = None,
                     least: float = rules.FUEL_MIN_DELIVERED_SHARE) -> DataFrame:
    """Rider days that earn fuel pay: automation on, no franchise hub, overall delivered share high enough."""
    rows = tour_days.filter(F.col("fuel_payout_automation") == "true")
    share = F.when(F.col("assigned_orders") != 0, ratio("delivered_orders", "assigned_orders")).otherwise(0.0)
    low = (rows.groupBy("rider_id").agg(F.sum("assigned_orders").alias("assigned_orders"),
                                        F.sum("delivered_orders").alias("delivered_orders"))
           .filter(share < least))
    kept = not_in(rows, "rider_id", low, "rider_id").filter(F.col("node_type") != "franchise_hub")
    if cod_pending is not None:
        kept = kept.join(cod_pending, "rider_id", "left")
    return kept.withColumns({"final_distance": F.col("covered_distance"),
                             "final_fuel_payout": F.col("fuel_payout"), "del_percent": share})


def is_franchise(hub: str = "hub") -> Column:
    return like_any(hub, rules.FRANCHISE_MARKS)

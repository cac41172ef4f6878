"""Payout runs: order pay input, rider-day tables, order costs, fuel."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from haulmark import rules
from haulmark.functions import clock
from haulmark.functions.numbers import chargeable_weight
from haulmark.operators import payout
from haulmark.operators.attempts import attempt_rank, order_type, payment_mode
from haulmark.operators.pick import max_dims
from haulmark.operators.sets import union_distinct
from haulmark.operators.skew import resolve_hot


def rider_info(riders: DataFrame, nodes: DataFrame, vendors: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Rider master with hub, city, vendor and pay structure; overrides win where given."""
    out = (riders.join(nodes.select("node_id", F.col("node_name").alias("hub"), "city"), "node_id", "left")
           .join(vendors.select("vendor_id", "vendor_name"), "vendor_id", "left")
           .select("rider_id", "rider_name", "hub", "city", "payout_structure", "vendor_name"))
    if overrides is None:
        return out
    o = overrides.select("rider_id", F.col("payout_structure").alias("_p"), F.col("vendor_name").alias("_v"))
    return (out.join(o, "rider_id", "left")
            .withColumns({"payout_structure": F.coalesce("_p", "payout_structure"), "vendor_name": F.coalesce("_v", "vendor_name")})
            .drop("_p", "_v"))


def pay_input(attempts: DataFrame, headers: DataFrame, weights: DataFrame, info: DataFrame, rates: DataFrame,
              fuel: DataFrame | None = None, month=None, franchise: bool = False, excluded_hubs: Sequence[str] = (),
              hot="auto") -> DataFrame:
    """Attempts of the period with everything the rate cards ask for.

    The month filter comes before the rank, so attempt 1 is the first one in the
    month. Hub selection too happens before the rank. ``rates``: pincode, delivered_rate.
    """
    listed = resolve_hot(attempts, ["awb"], hot)
    rows = attempts.filter(F.col("awb").isNotNull())
    if month is not None:
        rows = rows.filter(clock.in_month("dispatch_time", month))
    side = payout.is_franchise("hub")
    rows = rows.join(info.filter(side if franchise else ~side).filter(~F.col("hub").isin(list(excluded_hubs))), "rider_id", "inner")
    head = headers.select("awb", "user_id", "warehouse_city", "pincode", "shipment_chargeable_weight")
    dims = max_dims(weights).withColumnRenamed("shipment_awb", "awb")
    per_awb = head.join(dims, "awb", "left").select(
        "awb", "user_id", "warehouse_city", "pincode",
        chargeable_weight("shipment_chargeable_weight", "dwh_volume", "dwh_weight").alias("chargeable_weight"))
    own = [c for c in rows.columns if c not in per_awb.columns or c == "awb"]
    out = order_type(attempt_rank(rows.select(*own), hot=listed, attach=per_awb)).join(rates, "pincode", "left")
    out = out.withColumns({"slot": clock.slot_of("dispatch_time", "payout"), "mop": payment_mode()})
    if fuel is None:
        return out.withColumn("fuel_amount", F.lit(0.0))
    return out.join(fuel.select("tour_id", "fuel_amount"), "tour_id", "left").withColumn(
        "fuel_amount", F.coalesce("fuel_amount", F.lit(0.0)))


def own_payout(orders: DataFrame, card: str = "april",
               keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> dict[str, DataFrame]:
    """Orders with pay, rider days, rider months, hub months, and cost per delivered order.

    Paid orders and rider days are read several times; pass a ``keep`` that writes or
    checkpoints them when more than one of the results is used.
    """
    paid = keep(payout.order_pay(orders, rules.ORDER_CARDS[card]))
    days = keep(payout.rider_day(paid, card))
    months = payout.rider_month(days, card)
    return {"orders": paid, "days": days, "months": months, "hubs": payout.hub_month(months),
            "costs": payout.allocate_to_orders(paid, days)}


COST_COLUMNS = ["awb", "task_id", "dispatch_date", "slot", "city", "warehouse_city", "hub", "rider_id", "awb_pay", "status",
                "payout_structure"]


def order_costs(own: DataFrame, franchise: DataFrame) -> DataFrame:
    """Cost per delivered order of own and franchise hubs together, without repeats."""
    paid = payout.franchise_order_pay(franchise).filter(F.col("status") == "COMPLETED").withColumns({
        "dispatch_date": clock.day("dispatch_time"), "awb_pay": F.col("delivery_incentive") + F.col("weight_incentive")})
    return union_distinct(own.select(*COST_COLUMNS), paid.select(*COST_COLUMNS))


def zone_day_table(orders: DataFrame, cities: Sequence[str] = ("Bangalore", "Hyderabad", "Mumbai"), until=None) -> DataFrame:
    """Rider-day table of the listed cities up to a day, with the success bonus."""
    rows = orders.filter(F.col("city").isin(list(cities)))
    if until is not None:
        rows = rows.filter(F.col("dispatch_time") < clock.plus(clock.day(clock.moment(until)), days=1))
    return payout.payout_table(payout.rider_day(payout.order_pay(rows, rules.ORDER_CARDS["zone"]), "zone"))


def month_view(months: DataFrame, info: DataFrame, orders: DataFrame) -> DataFrame:
    """Rider months with names and the rider's first-attempt success of the period."""
    from haulmark.functions.numbers import ratio
    fresh, done = F.col("order_type") == "Fresh", F.col("status") == "COMPLETED"
    fasr = orders.groupBy("rider_id").agg(F.count_if(fresh & done).alias("_d"), F.count_if(fresh).alias("_a")).select(
        "rider_id", ratio("_d", "_a").alias("fasr"))
    return (months.join(info.select("rider_id", "rider_name", "vendor_name"), "rider_id", "left")
            .join(fasr, "rider_id", "left"))


def fuel_payout(tours: DataFrame, riders: DataFrame, nodes: DataFrame, fuel: DataFrame, tour_facts: DataFrame,
                ledger: DataFrame, as_of, month=None) -> DataFrame:
    """Fuel pay per rider and tour date for riders who qualify, with their old uncollected cash."""
    rows = tours if month is None else tours.filter(clock.in_month("tour_date", month))
    hub = nodes.select("node_id", "node_name", "node_type")
    rider = riders.select("rider_id", "rider_name", "fuel_payout_automation", "node_id")
    joined = (rows.select("tour_id", "rider_id", "tour_date").join(rider, "rider_id", "left").join(hub, "node_id", "left")
              .join(fuel, "tour_id", "left").join(tour_facts, "tour_id", "left"))
    bound = clock.plus(clock.day(clock.moment(as_of)), days=-1).cast("date")
    from haulmark.functions.numbers import exact_sum
    pending = (ledger.filter((F.col("collected") == 0) & (F.col("delivery_date") < bound)).groupBy("rider_id")
               .agg(exact_sum("amount").alias("cod_pending")))
    return payout.fuel_eligibility(payout.rider_tour_days(joined), pending)

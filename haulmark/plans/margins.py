"""Margins: by lane, client, pincode, rider and slot; monthly by vendor."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from haulmark import rules
from haulmark.functions import lookup
from haulmark.functions.numbers import exact_sum, ratio
from haulmark.operators import margin
from haulmark.operators.pick import keep_argmax
from haulmark.operators.skew import resolve_hot, salted_join
from haulmark.session import written


def merge_cities(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: lookup.canonical(c, rules.MERGED_CITIES) for c in columns})


def order_margin(revenue: DataFrame, orders: DataFrame, lane_costs_master: DataFrame, fuel: DataFrame | None = None) -> DataFrame:
    """Revenue rows with the full cost of their order (left join by parcel; revenue has one row per parcel).

    ``revenue``: awb, user_name, drop_pincode, shipping_city, warehouse_city, shipment_status, shipment_charges.
    ``orders``: awb, city, warehouse_city, rider_id, awb_pay, slot, dispatch_date.
    """
    o = merge_cities(orders, "city", "warehouse_city")
    lanes = margin.lane_cost_allocation(margin.lane_orders(o), merge_cities(lane_costs_master, "warehouse_city", "shipping_city"))
    cost = margin.order_total_cost(o, lanes, fuel)
    r = merge_cities(revenue, "shipping_city", "warehouse_city")
    return r.join(cost.select("awb", "rider_id", "slot", "dispatch_date", "awb_pay", "total_cost"), "awb", "left")


def rider_margin(rows: DataFrame, by=("shipping_city", "rider_id"), cost: str = "total_cost") -> DataFrame:
    """Margin per rider with the charges of returned orders spread over the city's riders."""
    known = rows.filter(F.col("rider_id").isNotNull()).dropna(subset=list(by))
    per = known.groupBy(*by).agg(F.count("awb").alias("orders"), exact_sum("shipment_charges").alias("shipment_charges"),
                                 F.coalesce(exact_sum(cost), F.lit(0.0)).alias("total_cost"))
    back = rows.filter(F.col("rider_id").isNull() & F.col("shipping_city").isNotNull())
    return margin.gross_up_returns(per, back)


def monthly_costs(delivered: DataFrame, rider_pay: DataFrame, franchise_pay: DataFrame, vendors: DataFrame, fuel: DataFrame,
                  ignored_hubs=(), hot="auto") -> DataFrame:
    """Cost parts per delivered parcel for one month.

    ``delivered``: awb, trip_id, num_rider_id, node_name, shipping_city, dispatch_time; the
    latest attempt of a parcel counts. ``rider_pay``: rider_id, vendor_name, payout_structure,
    total_pay, key. ``franchise_pay``: hub, total_pay. ``vendors``: key, extra_per_rs.
    ``fuel``: city, amount. Rows with an unknown part are dropped, as in the month-end run.
    """
    hot_riders = resolve_hot(delivered, ["num_rider_id"], hot)
    hot_hubs = resolve_hot(delivered, ["node_name"], hot)
    one = keep_argmax(delivered, ["awb"], "dispatch_time", "trip_id").na.drop("any")
    per_rider = one.groupBy("num_rider_id").agg(F.count("awb").alias("orders"))
    per_hub = one.groupBy("node_name").agg(F.count("awb").alias("orders")).filter(~F.col("node_name").isin(list(ignored_hubs)))
    per_city = one.groupBy("shipping_city").agg(F.count("awb").alias("orders"))
    riders = margin.cpo(rider_pay.withColumnRenamed("rider_id", "num_rider_id"), per_rider, "num_rider_id").select(
        "num_rider_id", "vendor_name", "payout_structure", "rider_pay_cpo", "key")
    hubs = margin.cpo(franchise_pay.withColumnRenamed("hub", "node_name"), per_hub, "node_name").select(
        "node_name", F.col("node_name").alias("vendor_name_fill"), F.lit("ORDER").alias("payout_structure_fill"),
        F.col("rider_pay_cpo").alias("rider_pay_cpo_fill"), F.col("node_name").alias("key_fill"))
    from haulmark.operators.shape import coalesce_from
    rows = salted_join(one, riders, ["num_rider_id"], "left", hot=hot_riders)
    rows = salted_join(rows, hubs, ["node_name"], "left", hot=hot_hubs)
    rows = coalesce_from(rows, ["vendor_name", "payout_structure", "rider_pay_cpo", "key"]).na.drop("any")
    rows = margin.vendor_cpo(rows, vendors).drop("key")
    fuel_city = fuel.groupBy(F.col("city").alias("shipping_city")).agg(exact_sum("amount").alias("_amount"))
    fuel_cpo = per_city.join(fuel_city, "shipping_city", "left").select("shipping_city", ratio("_amount", "orders").alias("fuel_cpo"))
    return rows.join(written(fuel_cpo, "fuel"), "shipping_city", "left").na.fill(0.0, ["fuel_cpo"])


def monthly_margin(revenue: DataFrame, costs: DataFrame, mid_mile: DataFrame, rider_pay: DataFrame | None = None,
                   literal_city: bool = False) -> DataFrame:
    """Revenue and cost per parcel for one month, mid-mile cost included.

    ``revenue``: awb, user_name, warehouse_city, shipping_city, drop_pincode, shipment_status, mop,
    shipment_charges. ``mid_mile``: shipping_city, cost. Pay of the third-party warehouse vendor in
    ``rider_pay`` (city, vendor_name, total_pay) is taken out of the mid-mile cost.
    ``literal_city`` overwrites the shipping city with the warehouse city.
    """
    r = merge_cities(revenue, "warehouse_city", "shipping_city")
    if literal_city:
        r = r.withColumn("shipping_city", F.col("warehouse_city"))
    shares = margin.return_share(r)
    pay = mid_mile.groupBy("shipping_city").agg(exact_sum("cost").alias("cost"))
    if rider_pay is not None:
        out = (rider_pay.filter(F.col("vendor_name") == rules.THIRD_PARTY_WAREHOUSE_VENDOR)
               .groupBy(F.col("city").alias("shipping_city")).agg(exact_sum("total_pay").alias("_own")))
        pay = pay.join(out, "shipping_city", "left").withColumn("cost", F.col("cost") - F.coalesce("_own", F.lit(0.0))).drop("_own")
    factors = margin.return_weighted_factor(pay, shares)
    merged = margin.merge_revenue_cost(r, costs.drop("shipping_city"))
    complete = margin.zero_returns(merged).na.drop("any")
    return margin.mid_mile_cpo(complete, factors).withColumnsRenamed(
        {"shipment_charges": "rpo", "payout_structure": "rider_payout_structure", "fuel_cpo": "rider_fuel_cpo"})


def corrected_city(rows: DataFrame, cities: DataFrame) -> DataFrame:
    """Replace the shipping city by the one of the shipment table where that is known."""
    c = merge_cities(cities.select("awb", F.col("shipping_city").alias("_city")), "_city")
    return rows.join(c, "awb", "left").withColumn("shipping_city", F.coalesce("_city", "shipping_city")).drop("_city")

"""Cost per order and margins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from haulmark import rules
from haulmark.functions.numbers import exact_sum, ratio, round_half_even
from haulmark.operators.skew import resolve_hot, salt, salted_join
from haulmark.session import written

DELIVERED, RETURNED = "Delivered", "RTO Delivered"

# Rows that name no order are dealt over this many groups.
NULL_PARTS = 1024


def lane_orders(orders: DataFrame) -> DataFrame:
    """Orders per lane, local or between cities."""
    return orders.groupBy("warehouse_city", "city").agg(F.count("awb").alias("orders"))


def lane_cost_allocation(lanes: DataFrame, costs: DataFrame) -> DataFrame:
    """First and mid-mile cost per order for each lane.

    ``costs``: warehouse_city, shipping_city, lane_type, cost. A warehouse's local
    cost is spread so that a local order bears two parts and an intercity order one;
    intercity cost is spread over the orders of its lane. Costs of a lane are summed first.
    """
    local = F.col("warehouse_city") == F.col("city")
    per_city = lanes.filter(F.col("warehouse_city").isNotNull()).groupBy("warehouse_city").agg(
        F.sum(F.when(local, F.col("orders")).otherwise(0)).alias("self_orders"),
        F.sum(F.when(~local, F.col("orders")).otherwise(0)).alias("intercity_orders"))
    own = (costs.filter(F.col("lane_type") == "Hyperlocal").groupBy("warehouse_city")
           .agg(exact_sum("cost").alias("mm_cost")))
    unit = per_city.join(own, "warehouse_city", "left").withColumn(
        "unit", ratio("mm_cost", F.col("self_orders") * 2 + F.col("intercity_orders"))).select("warehouse_city", "unit")
    lane_cost = costs.groupBy("warehouse_city", F.col("shipping_city").alias("city")).agg(exact_sum("cost").alias("lane_cost"))
    out = lanes.join(unit, "warehouse_city", "left").join(lane_cost, ["warehouse_city", "city"], "left")
    self_part = F.when(local, F.col("unit") * 2).otherwise(0.0)
    inter_part = F.when(local, 0.0).otherwise(F.col("unit"))
    mid_part = F.when(local, 0.0).otherwise(ratio("lane_cost", "orders"))
    return out.select("warehouse_city", "city", "orders", self_part.alias("self_mm_fm_cpo"),
                      inter_part.alias("intercity_fm_cpo"), mid_part.alias("intercity_mm_cpo"),
                      (self_part + inter_part + mid_part).alias("total_mm_cost"))


def order_total_cost(orders: DataFrame, lane_costs: DataFrame, fuel: DataFrame | None = None, hot="auto") -> DataFrame:
    """Pay, mid-mile, fuel and vendor share per order; missing parts count as 0."""
    listed = None if fuel is None else resolve_hot(orders, ["rider_id"], hot)
    # Lanes are few; written, their size is known and the orders need not be dealt out by city.
    lanes = written(lane_costs.select("warehouse_city", "city", "total_mm_cost"), "lanes")
    joined = orders.join(lanes, ["warehouse_city", "city"], "left")
    if fuel is not None:
        joined = salted_join(joined, fuel.select("rider_id", "fuel_cpo"), ["rider_id"], "left", hot=listed)
    else:
        joined = joined.withColumn("fuel_cpo", F.lit(0.0))
    filled = joined.withColumn("vendor_comm", F.col("awb_pay") * rules.VENDOR_SHARE).na.fill(
        0.0, ["awb_pay", "total_mm_cost", "fuel_cpo", "vendor_comm"])
    return filled.withColumn("total_cost", F.col("awb_pay") + F.col("total_mm_cost") + F.col("fuel_cpo") + F.col("vendor_comm"))


def margin_by(rows: DataFrame, dims: Sequence[str], revenue: str = "shipment_charges", cost: str = "total_cost") -> DataFrame:
    """Distinct orders, revenue, cost and margin per group.

    The first dimension is the city: rows without it are left out. Nulls in other
    dimensions form a group of their own.
    """
    per = _per_combination(rows.dropna(subset=[dims[0]]), dims, revenue, cost)
    out = per.groupBy(*dims).agg((F.sum("_n") + F.count("_order")).alias("orders"), exact_sum("_r").alias(revenue), exact_sum("_c").alias(cost))
    return out.withColumn("margin", F.col(revenue) - F.col(cost))


def _per_combination(rows: DataFrame, dims: Sequence[str], revenue: str, cost: str) -> DataFrame:
    """Sums per combination of ``dims``: ``_r``, ``_c`` and ``_n``, the orders all of whose rows have this combination.

    An order with several combinations keeps a row for each, under its id in ``_order``, and is not in ``_n``: who merges
    combinations counts it once. One look along the rows of each order tells the two apart, so no table of all orders is
    held in memory. Rows without an order are spread; they have sums but no order.
    """
    spread = F.when(F.col("awb").isNull(), salt([*dims, revenue, cost], F.lit(NULL_PARTS))).otherwise(F.lit(0))
    same = Window.partitionBy("awb", "_salt").orderBy("awb")
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    combination = F.struct(*dims)
    seen = rows.withColumn("_salt", spread).withColumns({
        "_one": F.col("awb").isNull() | F.min(combination).over(whole).eqNullSafe(F.max(combination).over(whole)),
        "_first": F.row_number().over(same) == 1})
    return seen.groupBy(*dims, F.when(~F.col("_one"), F.col("awb")).alias("_order")).agg(
        exact_sum(F.coalesce(F.col(revenue), F.lit(0.0))).alias("_r"), exact_sum(F.coalesce(F.col(cost), F.lit(0.0))).alias("_c"),
        F.count_if(F.col("_one") & F.col("_first") & F.col("awb").isNotNull()).alias("_n"))


def margin_cuts(rows: DataFrame, cuts: Mapping[str, Sequence[str]], revenue: str = "shipment_charges", cost: str = "total_cost") -> DataFrame:
    """``margin_by`` for several cuts at once: cut, all dimensions (null outside of a cut), orders, revenue, cost and margin.

    The rows are read once and summed per combination of all dimensions; only those sums are repeated per cut. Distinct orders
    stay exact where an order has several values of a dimension: a cut counts it once per group.
    """
    dims = list(dict.fromkeys(d for c in cuts.values() for d in c))
    per = _per_combination(rows, dims, revenue, cost)
    kinds = dict(per.dtypes)
    one = [F.struct(F.lit(name).alias("cut"), *[(F.col(d) if d in cut else F.lit(None).cast(kinds[d])).alias(d) for d in dims], F.col(cut[0]).isNotNull().alias("_in"))
           for name, cut in cuts.items()]
    kept = ["_order", "_n", "_r", "_c"]
    spread = per.select(F.explode(F.array(*one)).alias("_s"), *kept).select("_s.*", *kept).filter("_in")
    per_cut = spread.groupBy("cut", *dims, "_order").agg(F.sum("_n").alias("_n"), exact_sum("_r").alias("_r"), exact_sum("_c").alias("_c"))
    out = per_cut.groupBy("cut", *dims).agg((F.sum("_n") + F.count("_order")).alias("orders"), exact_sum("_r").alias(revenue), exact_sum("_c").alias(cost))
    return out.withColumn("margin", F.col(revenue) - F.col(cost))


def gross_up_returns(rider_margin: DataFrame, returns: DataFrame, city: str = "shipping_city",
                     charges: str = "shipment_charges") -> DataFrame:
    """Spread the charges and orders of returns over a city's riders by their orders.

    ``rider_margin``: city, ..., orders, charges, total_cost. ``returns``: city, awb, charges.
    """
    per_city = rider_margin.groupBy(city).agg(F.sum("orders").alias("_orders"))
    back = returns.groupBy(city).agg(F.count("awb").alias("_awb"), exact_sum(charges).alias("_charges"))
    rates = per_city.join(back, city, "left").select(
        city, ratio("_charges", "_orders").alias("rto_rpo"), ratio("_awb", "_orders").alias("rto_apo"))
    return (rider_margin.join(rates, city, "left").withColumns({
        "total_charges": F.col("orders") * F.col("rto_rpo") + F.col(charges),
        "total_orders": F.col("orders") * F.col("rto_apo") + F.col("orders")})
        .withColumn("margin", F.col("total_charges") - F.col("total_cost")))


def return_share(revenue: DataFrame, city: str = "shipping_city") -> DataFrame:
    """Delivered and returned orders per city; cities without deliveries are left out."""
    out = revenue.filter(F.col(city).isNotNull()).groupBy(city).agg(
        F.count_if((F.col("shipment_status") == DELIVERED) & F.col("awb").isNotNull()).alias("delivered_orders"),
        F.nullif(F.count_if((F.col("shipment_status") == RETURNED) & F.col("awb").isNotNull()), F.lit(0)).alias("returned_orders"))
    return out.filter("delivered_orders > 0").withColumn(
        "rto_per", ratio("returned_orders", F.col("delivered_orders") + F.col("returned_orders")))


def return_weighted_factor(costs: DataFrame, shares: DataFrame, city: str = "shipping_city", cost: str = "cost") -> DataFrame:
    """Mid-mile cost per order where a return counts twice, rounded to two places, halves to even.

    A city without returns has no factor, as its return count is unknown.
    """
    weight = F.col("delivered_orders") + F.col("returned_orders") * 2
    return costs.join(shares, city, "left").withColumn(
        "r_factor", F.rint(ratio(cost, weight) * 100) / 100)


def mid_mile_cpo(rows: DataFrame, factors: DataFrame, city: str = "shipping_city") -> DataFrame:
    """Returned orders bear two factors, delivered ones one, others none."""
    r, status = F.col("r_factor"), F.col("shipment_status")
    joined = rows.join(written(factors.select(city, "r_factor"), "factors"), city, "left")
    return joined.withColumn("fm_mm_cpo", F.when(status == RETURNED, r * 2).when(status == DELIVERED, r).otherwise(0.0)).drop("r_factor")


def cpo(payouts: DataFrame, orders: DataFrame, key: str, total: str = "total_pay", out: str = "rider_pay_cpo") -> DataFrame:
    """Cost per delivered order: total pay over the orders of the same rider, hub or city."""
    return payouts.join(orders, key, "left").withColumn(out, ratio(total, "orders"))


def vendor_cpo(rows: DataFrame, vendors: DataFrame) -> DataFrame:
    """Vendor cost per order from the extra amount per rupee of rider pay; unknown vendors cost 0."""
    joined = rows.join(vendors.select("key", "extra_per_rs"), "key", "left")
    return joined.withColumn("vendor_cpo", F.coalesce(F.col("rider_pay_cpo") * F.col("extra_per_rs"), F.lit(0.0))).drop("extra_per_rs")


COST_COLUMNS = ["num_rider_id", "trip_id", "node_name", "vendor_name", "payout_structure", "rider_pay_cpo",
                "dispatch_time", "vendor_cpo", "fuel_cpo"]


def merge_revenue_cost(revenue: DataFrame, costs: DataFrame) -> DataFrame:
    """Revenue rows with the cost of their parcel. Rows without a parcel, and costs without revenue, are not complete."""
    return revenue.filter(F.col("awb").isNotNull()).join(costs, "awb", "left")


def zero_returns(rows: DataFrame, columns: Sequence[str] = COST_COLUMNS) -> DataFrame:
    """Delivery cost of returned orders is 0; text columns get '0'."""
    types = dict(rows.dtypes)
    back = F.col("shipment_status") == RETURNED
    def zero(c):
        if types[c].startswith("timestamp") or types[c] == "date":
            return F.lit("1970-01-01").cast(types[c])
        return F.lit("0" if types[c] == "string" else 0).cast(types[c])
    return rows.withColumns({c: F.when(back, zero(c)).otherwise(F.col(c)) for c in columns if c in types})


def vendor_margins(rows: DataFrame, by: Sequence[str] = ("shipping_city", "vendor_name", "num_rider_id")) -> DataFrame:
    """Orders, cost parts, revenue and margin per vendor and rider."""
    parts = {"rider_pay": "rider_pay_cpo", "vendor_pay": "vendor_cpo", "rider_fuel_cpo": "rider_fuel_cpo",
             "fm_mm_cpo": "fm_mm_cpo", "rpo": "rpo"}
    out = rows.dropna(subset=list(by)).groupBy(*by).agg(
        F.count("awb").alias("awb"), *[F.coalesce(exact_sum(c, 4), F.lit(0.0)).alias(n) for n, c in parts.items()])
    return out.withColumn("total_cost", F.col("rider_pay") + F.col("vendor_pay") + F.col("rider_fuel_cpo") + F.col("fm_mm_cpo")) \
              .withColumn("margin", F.col("rpo") - F.col("total_cost"))

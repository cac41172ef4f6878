"""Operational views: attempts, tours, finance lines, warehouse stages, the shipment table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from haulmark import rules
from haulmark.functions import clock, lookup, text
from haulmark.functions.numbers import exact_sum, haversine_km, metres_to_km, seconds_to_minutes
from haulmark.operators import fulfilment
from haulmark.operators.attempts import CANCELLED, COMPLETED
from haulmark.operators.cash import loss_attribution
from haulmark.operators.pick import distinct_on
from haulmark.operators.service import on_time, outlier_flag
from haulmark.operators.sets import union_distinct
from haulmark.operators.skew import resolve_hot, salted_join


def carrier_name(carrier_id: Column, carriers=rules.CARRIERS) -> Column:
    unknown = F.concat_ws("", carrier_id.cast("string"), F.lit(", "), F.lit("Unknown"))
    return F.coalesce(lookup.decode(carrier_id.cast("int"), carriers), unknown)


def short_status(carrier: str = "shipper_id", status: str = "shipment_status") -> Column:
    """Client-facing status; a few statuses exist only for own or only for partner carriers."""
    own = lookup.decode(status, {**rules.SHORT_STATUS, **rules.SHORT_STATUS_OWN}, rules.SHORT_STATUS_UNKNOWN)
    partner = lookup.decode(status, {**rules.SHORT_STATUS, **rules.SHORT_STATUS_PARTNER}, rules.SHORT_STATUS_UNKNOWN)
    return lookup.first_match([(F.col(carrier) == rules.OWN_CARRIER_ID, own), (F.col(carrier).isNotNull(), partner)],
                              rules.SHORT_STATUS_UNKNOWN)


def task_brief(tasks: DataFrame, riders: DataFrame, headers: DataFrame,
               order: Sequence = ("accepted_at", "rider_id"), hot="auto") -> DataFrame:
    """One row per attempt in local time with distances, rider and sort code.

    ``order`` decides which of several rows of one task is kept.
    """
    listed = resolve_hot(tasks.select(F.col("scan_id").alias("awb")), ["awb"], hot)
    t = distinct_on(tasks, ["task_id"], list(order))
    drift = haversine_km("planned_location_lat", "planned_location_lng", "actual_location_lat", "actual_location_lng")
    def given(c):
        # Text that is empty gives null; the measured distance stands in only where nothing was written.
        return F.when(F.col(c).isNull(), drift).otherwise(F.nullif(F.col(c), F.lit("")).try_cast("double"))
    local = clock.to_local
    passed_on = [c for c in ("customer_name", "customer_address", "line_items", "plan_id", "pod", "track_link", "signature")
                 if c in tasks.columns]
    out = t.select(
        "task_id", F.col("scan_id").alias("awb"), F.col("alternate_id").alias("shop_order_number"),
        F.col("task_status").alias("status"), "rider_id", local("started_at").alias("task_start_time"),
        F.coalesce(local("completed_at"), local("cancelled_at")).alias("task_end_time"),
        F.col("homebase_address").alias("homebase"), F.col("team_name").alias("lm_team_name"),
        local("completed_at").alias("completed_at"), local("cancelled_at").alias("cancelled_at"), "cancellation_remarks",
        F.col("amount_collected").try_cast("double").alias("cod_amount"), drift.alias("drift_distance"),
        given("drift_cancelled_kms").alias("drift_cancelled_kms"), given("drift_completed_kms").alias("drift_completed_kms"),
        local("initial_eta").alias("original_eta"),
        F.timestamp_diff("SECOND", F.col("initial_eta"), F.col("completed_at")).alias("sla_delay"),
        F.col("pincode").alias("customer_pincode"), "location_id", "tour_id", local("accepted_at").alias("dispatch_time"),
        local("slot_start").alias("slot_start"), local("slot_end").alias("slot_end"), *passed_on)
    named = out.join(riders.select(F.col("locus_rider_id").alias("rider_id"), "rider_name", F.col("phone").alias("rider_phone")),
                     "rider_id", "left")
    codes = headers.filter(F.col("awb").isNotNull()).groupBy("awb").agg(F.max_by("sort_code", "shipment_id").alias("sort_code"))
    return salted_join(named, codes, ["awb"], "left", hot=listed)


def tour_brief(tours: DataFrame, tasks: DataFrame, riders: DataFrame, road_time_divisor: float = 1000.0) -> DataFrame:
    """One row per tour: counts, distances in kilometres, times, collected money from its tasks.

    ``road_time_divisor`` is the unit of the actual time on road; its sibling column uses 60.
    """
    status = F.col("status")
    per_tour = tasks.groupBy("tour_id").agg(
        exact_sum(F.when(status == COMPLETED, F.col("cod_amount")).otherwise(0)).alias("expected_net_amount"),
        exact_sum(F.when(status == COMPLETED, F.col("drift_completed_kms")).otherwise(0), 6).alias("total_completed_drift"),
        exact_sum(F.when(status == CANCELLED, F.col("drift_cancelled_kms")).otherwise(0), 6).alias("total_cancelled_drift"),
        F.min("task_start_time").alias("tour_start_time"), F.min("task_end_time").alias("tour_end_time"),
        F.min("dispatch_time").alias("dispatch_time"))
    def whole(c, name):
        return F.col(c).try_cast("int").alias(name)
    one = distinct_on(tours, ["tour_id"], ["batch_id", "rider_id"])
    out = one.select(
        "tour_id", "batch_id", F.col("actual_net_amount").try_cast("double").alias("actual_net_amount"),
        F.col("planned_tour_date").try_cast("date").alias("tour_date"), whole("all_tasks", "total_tasks"),
        whole("cancelled_tasks", "cancelled_tasks"), whole("completed_tasks", "completed_tasks"),
        whole("number_of_delayed_taskssla", "number_of_delayed_tasks"), whole("ongoing_tasks", "ongoing_tasks"),
        seconds_to_minutes("live_duration").alias("live_duration"), metres_to_km("planned_distance_kms").alias("planned_distance"),
        seconds_to_minutes("planned_time_on_road").alias("planned_time_on_road"),
        metres_to_km("travelled_distance_kms").alias("actual_distance"),
        (F.col("actual_time_on_road").try_cast("double") / road_time_divisor).alias("actual_time_on_road"),
        "rider_id", "rider_status", whole("sequence_edited", "sequence_edited"), F.col("team_name").alias("lm_team_name"),
        "tour_name", "tour_status")
    named = out.join(riders.select(F.col("locus_rider_id").alias("rider_id"), "rider_name", F.col("phone").alias("rider_phone")),
                     "rider_id", "left")
    return named.join(per_tour, "tour_id", "left")


MAIN_WALLET = 1
FINANCE_START = "2022-09-01"
MANUAL_MARK = "MANUAL"


def finance_lines(transactions: DataFrame, headers: DataFrame, companies: DataFrame, cashflows: DataFrame,
                  since=FINANCE_START, hot="auto") -> DataFrame:
    """Transactions of known shipments with client, carrier and cash flow.

    ``reference_id`` is text; a reference that is not a number belongs to no shipment.
    """
    local = clock.to_local
    ref = F.col("incoming_ref_id")
    rows = transactions.filter(((F.col("wallet_id") != MAIN_WALLET) | F.col("wallet_id").isNull())
                               & (F.col("created_time") >= clock.moment(since)))
    collected = F.when(text.substring(ref, 0, 7) == MANUAL_MARK, text.substring(ref, 9, 10).try_cast("date"))
    lines = rows.select(
        "transaction_id", "amount", "realized", "anulled", F.col("reference_type").alias("transaction_type"),
        local("created_time").alias("created_time"), local("completion_time").alias("completion_time"),
        "incoming_cash_flow_id", "outgoing_cash_flow_id", "reference_party_1", "incoming_ref_id",
        collected.alias("collection_date"), F.col("reference_id").try_cast("bigint").alias("shipment_id"))
    head = headers.select("shipment_id", "awb", "shop_order_number", "user_id", "shipper_id", "shipment_status")
    flow = cashflows.select(F.col("id").alias("incoming_cash_flow_id"), local("created_time").alias("cashflow_time"),
                            F.col("txn_id").alias("cashflow_ref_id"), F.col("verified").alias("cashflow_verified"))
    # Most lines have no cash flow yet: the null key counts as hot and its rows are spread.
    flows_of = resolve_hot(transactions, ["incoming_cash_flow_id"], hot)
    out = (salted_join(lines.join(head, "shipment_id", "inner"), flow, ["incoming_cash_flow_id"], "left", hot=flows_of)
           .join(companies.select("user_id", "user_name"), "user_id", "left"))
    return out.withColumn("shipping_partner", carrier_name(F.col("shipper_id"), rules.FINANCE_CARRIERS)).drop(
        "user_id", "shipper_id")


def outflow_table(log: DataFrame, outflows: DataFrame, warehouses: DataFrame, headers: DataFrame, suborders: DataFrame,
                  events: DataFrame, as_of, managed: Sequence[int] | None = None, clients: Sequence[int] | None = None,
                  client_warehouses: Sequence[int] | None = None) -> DataFrame:
    """Warehouse stage per shipment from two systems: own stage log, and client suborders.

    The id lists limit each system to its warehouses and clients; without a list there is no limit.
    """
    stages = fulfilment.pick_pack_milestones(log)
    own = (outflows.withColumnRenamed("id", "outflow_id") if "id" in outflows.columns else outflows)
    if managed is not None:
        own = own.filter(F.col("warehouse_id").isin(list(managed)))
    head = headers.select("shipment_id", "awb", "user_id", "shipment_status")
    house = warehouses.select(F.col("warehouse_int_id").alias("warehouse_id"), "warehouse_city")
    first = (own.join(stages, "outflow_id", "inner").withColumnRenamed("awb_number", "awb")
             .join(head, "awb", "left").join(house, "warehouse_id", "left"))
    first = fulfilment.cutoff_clock(first, "assigned_time", "packed_time", clock.to_local(clock.moment(as_of)))
    first = first.withColumns({"id": F.col("outflow_id").cast("string"), "suborder_id": F.col("suborder_id").cast("string"),
                               "order_id": F.col("order_id").cast("string"), "tat": F.col("tat").cast("double"),
                               "warehouse_city": lookup.canonical("warehouse_city", rules.CITY_GROUPS)})
    second = headers.filter(F.col("shipment_status") != "Cancelled")
    if clients is not None:
        second = second.filter(F.col("user_id").isin(list(clients)))
    if client_warehouses is not None:
        second = second.filter(F.col("warehouse_id").isin(list(client_warehouses)))
    parts = suborders.select(F.col("order_id_id").alias("order_id"), "suborder_id", "quantity")
    second = (second.join(parts, "order_id", "left")
              .join(events.select("shipment_id", "pickup_time", "first_ofd"), "shipment_id", "left")
              .withColumns({"id": F.concat_ws("", F.col("suborder_id").cast("string"), F.lit("-1")),
                            "suborder_id": F.col("suborder_id").cast("string"), "order_id": F.col("order_id").cast("string"),
                            "status": F.when(F.col("shipment_status").isin(rules.NOT_YET_SHIPPED), "Packed").otherwise("Left Warehouse"),
                            "warehouse_city": lookup.canonical("warehouse_city", {}, {"Delhi": "Dwarka"}),
                            "assigned_time": F.col("created_date"), "picked_time": F.col("created_date"),
                            "packed_time": F.col("created_date"), "dispatched_time": F.coalesce("pickup_time", "first_ofd"),
                            "shop_order_number": F.col("shop_order_number")}))
    second = fulfilment.cutoff_clock(second, "created_date", "created_date", clock.to_local(clock.moment(as_of)))
    second = second.withColumn("tat", F.lit(0.0))
    columns = ["id", "suborder_id", "quantity", "status", "warehouse_id", "shipment_id", "awb", "user_id", "shipment_status",
               "warehouse_city", "cutoff", "order_id", "shop_order_number", "assigned_time", "picked_time", "packed_time",
               "dispatched_time", "tat", "day_since_cutoff"]
    return fulfilment.stage_dedup(union_distinct(first.select(*columns), second.select(*columns))).drop("id", "suborder_id")


OWN_PARTY = f"s{rules.OWN_CARRIER_ID}"


def last_rider(tasks: DataFrame) -> DataFrame:
    """Rider of the latest attempt of each parcel, as text."""
    who = F.max_by(F.struct("rider_id", "rider_name"), F.struct("task_start_time", "task_id"))
    return (tasks.filter(F.col("awb").isNotNull() & F.col("task_start_time").isNotNull()).groupBy("awb").agg(who.alias("_w"))
            .select("awb", F.concat(F.lit("rider_id: "), F.col("_w.rider_id").cast("string"), F.lit(" -- rider_name: "),
                                    F.col("_w.rider_name")).alias("last_rider")))


def ops_main(headers: DataFrame, companies: DataFrame, events: DataFrame, timelines: DataFrame, tasks: DataFrame,
             outflow: DataFrame, finance: DataFrame, as_of) -> DataFrame:
    """The shipment table: header, milestones, promises, flags, place, cash dates. One row per shipment.

    Every side is unique on its join key, so no row multiplies; only the client
    join has few keys, and the client table is small or handled by AQE.
    """
    ready = outflow.groupBy("shipment_id").agg(F.max("packed_time").alias("ready_to_dispatch_time"))
    cod = (finance.filter((F.col("reference_party_1") == OWN_PARTY) & (F.col("transaction_type") == "cod_amount")
                          & F.col("realized") & ~F.col("anulled"))
           .groupBy("shipment_id").agg(F.max("collection_date").alias("_collected"), F.max("cashflow_time").alias("cod_deposition_date")))
    e = events.select("shipment_id", "no_attempts", "first_failed_delivered", "first_failed_delivered_remarks",
                      "last_failed_delivered", "last_failed_delivered_remarks", "last_remark", "pickup_time", "delivered_time",
                      "first_ofd", "last_ofd", "rto_initiated_time", "rto_ofd_time", "rto_delivered_time", "rto_freeze_time",
                      "last_update_time", F.col("last_location").alias("_place"), "last_scan_location")
    rows = (headers.join(e, "shipment_id", "left").join(timelines, "shipment_id", "left").join(ready, "shipment_id", "left")
            .join(cod, "shipment_id", "left").join(last_rider(tasks), "awb", "left")
            .join(companies.select("user_id", "user_name"), "user_id", "left"))
    own = F.col("shipper_id") == rules.OWN_CARRIER_ID
    place = F.col("_place")
    # Place prefixes of the own network.
    prefixes = ["Sorted to bin RTO", "Sorted to bin NDR", "Sorted to bin", "Prepared Bag"]
    short_place = lookup.first_match([(place.startswith(p) & own, p) for p in prefixes], place)
    detail = lookup.first_match([
        (place == "Fulfillment Centre", F.concat("warehouse_name", F.lit(", "), "warehouse_city")),
        (~own, F.lit("3PL")),
        ((place == "Last Mile Hub") & own, F.col("last_scan_location")),
        ((place == "Rider") & own, F.col("last_rider")),
        ((place.startswith(prefixes[0]) | place.startswith(prefixes[1])) & own, F.col("last_scan_location")),
        (place.startswith(prefixes[2]) & own, text.substring(place, len(prefixes[2]) + 1)),
        (place.startswith(prefixes[3]) & own, text.substring(place, 16)),
    ])
    h = clock.hours_between
    return rows.select(
        "awb", "shipment_id", "shop_order_number", "shipment_status", "shipment_type", "shipping_zone", "warehouse_name",
        "warehouse_city", "shipping_city",
        F.when(own, text.part("sort_code", "/", 2)).otherwise("NA-3PL").alias("last_mile_hub"), "user_name",
        F.col("payment_type").alias("mop"), "created_date", "modified_date",
        carrier_name(F.col("shipper_id")).alias("shipping_partner"), F.col("shipment_edd").alias("edd"),
        F.when(F.col("shipment_status").isin(rules.CLOSED_STATUSES), "closed").otherwise("open").alias("closure_status"),
        F.coalesce(F.col("delivery_attempts").cast("double"), F.col("no_attempts").cast("double"), F.lit(0.0)).alias("delivery_attempts"),
        F.col("first_failed_delivered").alias("first_failed_time"), F.col("first_failed_delivered_remarks").alias("first_failed_remark"),
        F.col("last_failed_delivered").alias("last_failed_date"), F.col("last_remark").alias("latest_remark"),
        "ideal_pickup_time", F.col("ndd").alias("next_delivery_date"), short_status().alias("gs_status"),
        F.col("pickup_time").alias("pickuptime"), F.col("delivered_time").alias("delivertime"),
        F.col("first_ofd").alias("first_ofd_time"), F.col("last_ofd").alias("last_ofd_time"), "rto_initiated_time",
        "rto_ofd_time", "rto_delivered_time", "rto_freeze_time", "last_update_time",
        on_time("pickup_time", "ideal_pickup_time").alias("on_time_pickup"), on_time("first_ofd", "shipment_edd").alias("on_time_ofd"),
        on_time("delivered_time", "shipment_edd").alias("on_time_del"), h("pickup_time", "first_ofd").alias("pto_h"),
        h("ideal_pickup_time", "delivered_time").alias("ito_h"),
        outlier_flag("delivered_time", "ideal_pickup_time", "pickup_time", "first_ofd", "created_date").alias("outlier_flag"),
        F.col("last_failed_delivered_remarks").alias("last_failed_remark"), "shipping_pincode",
        F.col("shipment_edd_logops").alias("shipper_edd"), F.col("last_update_time").alias("last_scan_time"), "op_owner", "sort_code",
        "ideal_packed_time", short_place.alias("last_location"), detail.alias("last_location_details"), "ready_to_dispatch_time",
        F.coalesce(F.col("_collected").cast("timestamp_ntz"), F.col("cod_deposition_date")).alias("cod_collection_date"),
        "cod_deposition_date", clock.moment(as_of).alias("data_refresh_time"))


def ops_main_brief(ops: DataFrame, headers: DataFrame) -> DataFrame:
    """Narrow shipment view with amounts and phone from the header."""
    extra = headers.select("shipment_id", "cod_amount", F.col("total_shipment_value").alias("order_amount"),
                           F.col("shipping_city").alias("_city"), F.col("shipping_phone").alias("customer_phone"))
    return ops.join(extra, "shipment_id", "left").select(
        "shipment_id", "awb", "shop_order_number", "user_name", "shipping_partner", "created_date", "shipment_status",
        "latest_remark", "cod_amount", "order_amount", "edd", "warehouse_name", "shipping_pincode",
        F.col("_city").alias("shipping_city"), "shipping_zone", "customer_phone", "pickuptime", "delivertime",
        "first_ofd_time", "first_failed_time", "closure_status", "delivery_attempts",
        F.col("data_refresh_time").alias("last_update_time"))


def lost_attribution(ops: DataFrame, log: DataFrame, headers: DataFrame, riders: DataFrame, nodes: DataFrame,
                     since="2023-08-01", shipper_id: int | None = None, hot="auto") -> DataFrame:
    """Who lost each lost shipment. The status filters run before the joins on both sides."""
    lost = ops.filter(F.col("shipment_status") == "Lost").select("awb", "shipping_city")
    scans = log.filter((F.col("shipment_status") == "Lost") & (F.col("update_time") >= clock.moment(since)))
    if shipper_id is not None:
        scans = scans.filter(F.col("shipper_id") == shipper_id)
    scans = scans.select("awb", "remark", F.col("timestamp").cast("date").alias("lost_date"))
    value = headers.select("awb", F.col("total_shipment_value").alias("shipment_value"))
    return loss_attribution(lost.join(scans, "awb", "inner").join(value, "awb", "left"), riders, nodes, hot, counted=scans)


def build_views(tables: dict, as_of, folder: str | None = None, hot="auto") -> dict[str, DataFrame]:
    """The view graph in refresh order; tables read more than once are written out."""
    from haulmark.operators.tracking import tracking_events
    from haulmark.sources.views import view_dag

    stages = {
        "events": lambda order_tracking: tracking_events(order_tracking, hot=hot),
        "tasks": lambda locus_task, rider, shipment_order_details: task_brief(locus_task, rider, shipment_order_details, hot=hot),
        "tours": lambda locus_tour, tasks, rider: tour_brief(locus_tour, tasks, rider),
        "finance": lambda finops_transaction, shipment_order_details, company_info, finops_cashflow: finance_lines(
            finops_transaction, shipment_order_details, company_info, finops_cashflow),
        "outflow": lambda outflow_outflowlog, outflow_outflow, warehouses_warehouse, shipment_order_details, appserver_suborder,
        events, as_of: outflow_table(outflow_outflowlog, outflow_outflow, warehouses_warehouse, shipment_order_details,
                                     appserver_suborder, events, as_of),
        "ops": lambda shipment_order_details, company_info, events, shipment_timelines, tasks, outflow, finance, as_of: ops_main(
            shipment_order_details, company_info, events, shipment_timelines, tasks, outflow, finance, as_of),
        "ops_brief": lambda ops, shipment_order_details: ops_main_brief(ops, shipment_order_details),
        "lost": lambda ops, order_tracking, shipment_order_details, rider, node: lost_attribution(
            ops, order_tracking, shipment_order_details, rider, node),
    }
    keys = {"events": ["shipment_id"], "tasks": ["task_id"], "ops": ["shipment_id"]}
    return view_dag(tables, stages, as_of, keep=["events", "tasks", "ops"], keys=keys, folder=folder)

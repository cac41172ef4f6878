"""End-to-end tables and reports (P-1 to P-25)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bindings import bind, cents, run, sql
from catalog.q_business import RANKED, cohort_sql  # noqa: F401
from catalog.q_money import (APRIL, DONE_ORDERS, FRANCHISE, LANES, LEDGER, MARGIN_ROWS, NEEDS, OWN, REVENUE, TRIPS as COD_TRIPS, days_sql, dense, dense_rows,
                             ledger, margin_rows, views)
from catalog.q_tracking import ALL_MILESTONES, CANON, STAGE_LOG
from catalog.registry import AS_OF_SCAN, AS_OF_TASK, query, with_hot_keys
from haulmark import rules
from haulmark.functions import clock
from haulmark.operators import cohort, payout, service, tracking
from haulmark.plans import kpi, margins, ops, pay, reports, trips
from haulmark.session import cut_lineage

# ---------------------------------------------------------------- raw tables
RAW_TASK = """select o_orderkey as task_id, o_custkey as scan_id, concat('SO', cast(o_orderkey as varchar(12))) as alternate_id,
  case o_orderstatus when 'F' then 'COMPLETED' when 'O' then 'CANCELLED' else 'ONGOING' end as task_status, concat('R', cast(o_orderkey % 97 as varchar(6))) as rider_id,
  o_orderdate + (o_orderkey % 24) * interval '1' hour as accepted_at, case when o_orderkey % 19 <> 0 then o_orderdate + (o_orderkey % 24) * interval '1' hour + interval '25' minute end as started_at,
  case o_orderstatus when 'F' then o_orderdate + (o_orderkey % 24 + 5) * interval '1' hour end as completed_at, case o_orderstatus when 'O' then o_orderdate + (o_orderkey % 24 + 6) * interval '1' hour end as cancelled_at,
  o_orderdate + (o_orderkey % 24 + 4) * interval '1' hour as initial_eta, o_orderdate as slot_start, o_orderdate + interval '12' hour as slot_end,
  case when o_orderkey % 13 = 0 then null else concat(cast(o_orderkey % 5000 as varchar(6)), '.25') end as amount_collected,
  case o_orderkey % 3 when 0 then null when 1 then '' else '2.5' end as drift_cancelled_kms, case o_orderkey % 4 when 0 then null when 1 then '' else '1.25' end as drift_completed_kms,
  8 + cast(o_orderkey % 200 as double) / 16 as planned_location_lat, 70 + cast(o_orderkey % 150 as double) / 16 as planned_location_lng, 8 + cast(o_custkey % 200 as double) / 16 as actual_location_lat,
  70 + cast(o_custkey % 170 as double) / 16 as actual_location_lng, 'base' as homebase_address, 'team' as team_name, cast(null as varchar(20)) as cancellation_remarks, o_custkey % 500 as pincode,
  concat('HB', cast(o_custkey % 25 as varchar(4))) as location_id, o_orderkey % 400 as tour_id from orders"""
DRIFT = """2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin((radians(actual_location_lat) - radians(planned_location_lat)) / 2), 2) + cos(radians(planned_location_lat)) * cos(radians(actual_location_lat))
  * pow(sin((radians(actual_location_lng) - radians(planned_location_lng)) / 2), 2))))"""
LOCAL = "{} + interval 330 minute as {}"
TASK_BRIEF = f"""select task_id, scan_id as awb, alternate_id as shop_order_number, task_status as status, t.rider_id, rider_name, phone as rider_phone, started_at + interval 330 minute as task_start_time,
    coalesce(completed_at, cancelled_at) + interval 330 minute as task_end_time, homebase_address as homebase, team_name as lm_team_name, {LOCAL.format('completed_at', 'completed_at')},
    {LOCAL.format('cancelled_at', 'cancelled_at')}, cancellation_remarks, cast(amount_collected as double) as cod_amount, {DRIFT} as drift_distance,
    case when drift_cancelled_kms is null then {DRIFT} else cast(nullif(drift_cancelled_kms, '') as double) end as drift_cancelled_kms,
    case when drift_completed_kms is null then {DRIFT} else cast(nullif(drift_completed_kms, '') as double) end as drift_completed_kms, {LOCAL.format('initial_eta', 'original_eta')},
    epoch_us(completed_at) // 1000000 - epoch_us(initial_eta) // 1000000 as sla_delay, t.pincode as customer_pincode, location_id, tour_id, {LOCAL.format('accepted_at', 'dispatch_time')},
    {LOCAL.format('slot_start', 'slot_start')}, {LOCAL.format('slot_end', 'slot_end')}, sort_code
  from ({RAW_TASK}) t left join rider r on r.locus_rider_id = t.rider_id left join shipment s on s.awb = t.scan_id"""
ROUND_DRIFT = "round(drift_distance, 6) as drift_distance, round(drift_cancelled_kms, 6) as drift_cancelled_kms, round(drift_completed_kms, 6) as drift_completed_kms"


def task_brief(spark, sf):
    bind(spark, sf, "orders")
    return ops.task_brief(run(spark, RAW_TASK), bind(spark, sf, "rider"), bind(spark, sf, "shipment"))


def rounded(df, *columns, places=6):
    return df.withColumns({c: F.round(c, places) for c in columns})


@query("p_01_tracking_events", sql("scan_wide", "with c as (" + CANON.format(log="scan_wide") + f"), {ALL_MILESTONES}"))
def tracking_events(spark, sf, hot="auto"):
    return tracking.tracking_events(bind(spark, sf, "scan_wide"), hot=hot)


with_hot_keys("p_01_tracking_events", tracking_events, 60)


@query("p_02_task_brief", sql("rider shipment", f"select * replace ({ROUND_DRIFT}) from ({TASK_BRIEF}) b"))
def p_task_brief(spark, sf):
    return rounded(task_brief(spark, sf), "drift_distance", "drift_cancelled_kms", "drift_completed_kms")


RAW_TOUR = """select o_orderkey % 400 as tour_id, concat('B', cast(o_orderkey % 400 as varchar(6))) as batch_id, concat('R', cast(o_orderkey % 400 % 97 as varchar(6))) as rider_id, 'done' as rider_status,
  'team' as team_name, concat('T', cast(o_orderkey % 400 as varchar(6))) as tour_name, 'COMPLETED' as tour_status, cast(cast(min(o_orderdate) as date) as varchar(10)) as planned_tour_date,
  cast(count(*) as varchar(10)) as all_tasks, cast(sum(case when o_orderstatus = 'O' then 1 else 0 end) as varchar(10)) as cancelled_tasks, cast(sum(case when o_orderstatus = 'F' then 1 else 0 end) as varchar(10)) as completed_tasks,
  '0' as number_of_delayed_taskssla, '' as ongoing_tasks, cast(count(*) * 600 as varchar(10)) as live_duration, cast(count(*) * 900 as varchar(10)) as planned_distance_kms, cast(count(*) * 950 as varchar(10)) as travelled_distance_kms,
  '7200' as planned_time_on_road, '9000' as actual_time_on_road, '1' as sequence_edited, '12.5' as actual_net_amount from orders group by 1, 2, 3, 6"""


@query("p_03_tour_brief", sql("rider shipment", f"""
    with b as ({TASK_BRIEF}), a as (select tour_id, {cents("case when status = 'COMPLETED' then cod_amount else 0 end")} as expected_net_amount,
        {cents("case when status = 'COMPLETED' then round(drift_completed_kms, 6) else 0 end", 6)} as total_completed_drift, {cents("case when status = 'CANCELLED' then round(drift_cancelled_kms, 6) else 0 end", 6)} as total_cancelled_drift,
        min(task_start_time) as tour_start_time, min(task_end_time) as tour_end_time, min(dispatch_time) as dispatch_time from b group by 1)
    select t.tour_id, batch_id, cast(actual_net_amount as double) as actual_net_amount, cast(planned_tour_date as date) as tour_date, cast(all_tasks as int) as total_tasks, cast(cancelled_tasks as int) as cancelled_tasks,
      cast(completed_tasks as int) as completed_tasks, cast(number_of_delayed_taskssla as int) as number_of_delayed_tasks, try_cast(nullif(ongoing_tasks, '') as int) as ongoing_tasks, cast(live_duration as double) / 60 as live_duration,
      cast(planned_distance_kms as double) / 1000 as planned_distance, cast(planned_time_on_road as double) / 60 as planned_time_on_road, cast(travelled_distance_kms as double) / 1000 as actual_distance,
      cast(actual_time_on_road as double) / 1000 as actual_time_on_road, t.rider_id, rider_status, cast(sequence_edited as int) as sequence_edited, team_name as lm_team_name, tour_name, tour_status, rider_name, phone as rider_phone,
      expected_net_amount, round(total_completed_drift, 3) as total_completed_drift, round(total_cancelled_drift, 3) as total_cancelled_drift, tour_start_time, tour_end_time, dispatch_time
    from ({RAW_TOUR}) t left join rider r on r.locus_rider_id = t.rider_id left join a on a.tour_id = t.tour_id"""))
def tour_brief(spark, sf):
    tasks = rounded(task_brief(spark, sf), "drift_cancelled_kms", "drift_completed_kms")
    out = ops.tour_brief(run(spark, RAW_TOUR), tasks, bind(spark, sf, "rider"))
    return rounded(out, "total_completed_drift", "total_cancelled_drift", places=3)


RAW_TXN = """select o_orderkey as transaction_id, case when o_orderkey % 6 = 5 then concat('W', cast(o_custkey as varchar(12))) else cast(o_custkey as varchar(12)) end as reference_id,
  case when o_orderkey % 3 = 0 then 'cod_amount' else 'freight' end as reference_type, case when o_orderkey % 2 = 0 then 's301' else 's2' end as reference_party_1, o_totalprice as amount,
  o_orderstatus <> 'P' as realized, o_orderkey % 11 = 0 as anulled, o_orderdate as created_time, o_orderdate + interval '6' hour as completion_time,
  case when o_orderkey % 4 = 0 then null else o_orderkey end as incoming_cash_flow_id, o_orderkey + 7 as outgoing_cash_flow_id,
  case when o_orderkey % 5 < 2 then concat('MANUAL__', cast(cast(o_orderdate as date) as varchar(10))) else concat('AUTO', cast(o_orderkey as varchar(12))) end as incoming_ref_id,
  case o_orderkey % 7 when 0 then 1 when 1 then null else 2 end as wallet_id from orders"""
RAW_FLOW = "select o_orderkey as id, o_orderdate + interval '20' hour as created_time, concat('X', cast(o_orderkey as varchar(12))) as txn_id, o_orderkey % 2 = 0 as verified from orders"
# Header, promises and clients for the view graph.
HEADER = """select shipment_id, awb, concat('SO', cast(shipment_id as varchar(12))) as shop_order_number, shipment_id * 3 as order_id, user_id, shipper_id, shipment_status, 'forward' as shipment_type, shipping_zone,
  shipment_id % 6 + 180 as warehouse_id, concat('WH ', cast(shipment_id % 6 as varchar(2))) as warehouse_name, warehouse_city, city as shipping_city, pincode as shipping_pincode, sort_code,
  case when shipment_id % 2 = 0 then 'COD' else 'Prepaid' end as payment_type, case when shipment_id % 10 = 0 then 'house' else 'client' end as op_owner, case when shipment_id % 4 = 0 then 2 end as delivery_attempts, created_date,
  created_date + interval '50' hour as modified_date, shipment_chargeable_weight, abs(total_shipment_value) as cod_amount, total_shipment_value, concat('phone ', cast(shipment_id as varchar(12))) as shipping_phone from shipment"""
PROMISE = """select shipment_id, created_date + interval '254160' hour as shipment_edd, created_date + interval '254170' hour as shipment_edd_logops, created_date + interval '254120' hour as ideal_pickup_time,
  created_date + interval '254130' hour as ideal_packed_time, created_date + interval '254184' hour as ndd from shipment"""
CLIENT = "select distinct user_id, concat('client ', cast(user_id as varchar(6))) as user_name from shipment where user_id % 10 <> 3"
PARTNER = "case shipper_id when 2 then 'Delhivery' when 301 then 'Hyperlocal' when 1001 then 'B2B' else concat(cast(shipper_id as varchar), ', Unknown') end"
FINANCE = f"""select transaction_id, amount, realized, anulled, reference_type as transaction_type, {LOCAL.format('t.created_time', 'created_time')}, {LOCAL.format('completion_time', 'completion_time')}, incoming_cash_flow_id,
    outgoing_cash_flow_id, reference_party_1, incoming_ref_id, case when left(incoming_ref_id, 6) = 'MANUAL' then cast(substring(incoming_ref_id, 9, 10) as date) end as collection_date, h.shipment_id, h.awb, shop_order_number,
    shipment_status, {LOCAL.format('f.created_time', 'cashflow_time')}, txn_id as cashflow_ref_id, verified as cashflow_verified, user_name, {PARTNER.replace("when 1001 then 'B2B' ", "")} as shipping_partner
  from ({RAW_TXN}) t join ({HEADER}) h on try_cast(t.reference_id as bigint) = h.shipment_id left join ({RAW_FLOW}) f on f.id = t.incoming_cash_flow_id left join ({CLIENT}) c using (user_id)
  where coalesce(wallet_id, 0) <> 1 and t.created_time >= timestamp '1995-06-01'"""


def header_views(spark, sf):
    views(spark, sf, "shipment")
    bind(spark, sf, "orders")
    return run(spark, HEADER), run(spark, CLIENT), run(spark, PROMISE)


def finance(spark, sf):
    head, clients, _ = header_views(spark, sf)
    return ops.finance_lines(run(spark, RAW_TXN), head, clients, run(spark, RAW_FLOW), since="1995-06-01")


@query("p_04_finance_lines", sql("shipment", FINANCE))
def finance_lines(spark, sf):
    return finance(spark, sf)


OUTFLOWS = """select o_orderkey as id, o_orderkey * 2 as suborder_id, o_orderkey % 5 + 1 as quantity, case o_orderkey % 4 when 0 then 'Order Assigned' when 1 then 'Picked' when 2 then 'Packed' else 'Left Warehouse' end as status,
  o_custkey % 6 + 180 as warehouse_id, o_custkey as awb_number, o_orderkey as order_id, concat('SO', cast(o_orderkey as varchar(12))) as shop_order_number from orders"""
HOUSES = """select distinct cast(n_nationkey % 6 + 180 as bigint) as warehouse_int_id, case n_nationkey % 6 when 0 then 'Gurgaon ' when 1 then 'Bengaluru' when 2 then 'Thane' when 3 then 'K.V.Rangareddy' when 4 then 'Pune' else 'Dwarka' end as warehouse_city from nation"""
SUBORDERS = "select o_custkey * 3 as order_id_id, o_orderkey * 7 as suborder_id, o_orderkey % 4 + 1 as quantity from orders"
CUT = "date_trunc('day', {0})::timestamp + case when hour({0}) < 15 then interval 17 hour when {0} is not null then interval 36 hour end"
STAGE_AS_OF = "2001-12-31"
NOW_LOCAL = f"(timestamp '{STAGE_AS_OF}' + interval 330 minute)"


def since_cut(c):
    return f"(epoch_us({NOW_LOCAL}) - epoch_us({c})) / 3.6e9 / 24.0"


EVENTS = "with c as (" + CANON.format(log="scan_wide") + f"), {ALL_MILESTONES}"
STAGES_ALL = f"""select outflow_id, max(timestamp) filter (status in ('Order Assigned', 'STO Assigned')) + interval 330 minute as assigned_time, max(timestamp) filter (status = 'Picked') + interval 330 minute as picked_time,
  max(timestamp) filter (status = 'Packed') + interval 330 minute as packed_time, max(timestamp) filter (status = 'Left Warehouse') + interval 330 minute as dispatched_time from ({STAGE_LOG}) l group by 1"""
OUTFLOW = f"""with e as ({EVENTS}), raw as (
    select cast(o.id as varchar) as id, cast(o.suborder_id as varchar) as suborder_id, o.quantity, o.status, o.warehouse_id, h.shipment_id, o.awb_number as awb, h.user_id, h.shipment_status,
        case w.warehouse_city when 'Gurgaon ' then 'Delhi' when 'Dwarka' then 'Delhi' when 'Bengaluru' then 'Bangalore' when 'Thane' then 'Mumbai' when 'K.V.Rangareddy' then 'Hyderabad' else w.warehouse_city end as warehouse_city,
        {CUT.format('assigned_time')} as cutoff, cast(o.order_id as varchar) as order_id, o.shop_order_number, assigned_time, picked_time, packed_time, dispatched_time,
        (epoch_us(packed_time) - epoch_us(assigned_time)) / 3.6e9 as tat, {since_cut(CUT.format('assigned_time'))} as day_since_cutoff
      from ({OUTFLOWS}) o join ({STAGES_ALL}) s on s.outflow_id = o.id left join ({HEADER}) h on h.awb = o.awb_number left join ({HOUSES}) w on w.warehouse_int_id = o.warehouse_id
    union select concat(cast(b.suborder_id as varchar), '-1'), cast(b.suborder_id as varchar), b.quantity, case when h.shipment_status in ('Awb Generated', 'Order Assigned', 'Out for Pickup', 'Pickup Failed', 'Shipment Created') then 'Packed' else 'Left Warehouse' end,
        h.warehouse_id, h.shipment_id, h.awb, h.user_id, h.shipment_status, case when warehouse_city like '%Delhi%' then 'Dwarka' else warehouse_city end, {CUT.format('created_date')}, cast(h.order_id as varchar), h.shop_order_number,
        created_date, created_date, created_date, coalesce(e.pickup_time, e.first_ofd), 0.0::double, {since_cut(CUT.format('created_date'))}
      from ({HEADER}) h left join ({SUBORDERS}) b on b.order_id_id = h.order_id left join e on e.shipment_id = h.shipment_id where h.shipment_status <> 'Cancelled'),
    q as (select *, sum(quantity) over (partition by awb) as qs from raw where shipment_id is not null)
  select shipment_id, awb, cast(qs as bigint) as quantity_sum, status, warehouse_id, user_id, shipment_status, warehouse_city, cutoff, order_id, shop_order_number, assigned_time, picked_time, packed_time, dispatched_time, tat, day_since_cutoff
  from q qualify row_number() over (partition by shipment_id order by case status when 'Order Assigned' then 1 when 'Picked' then 2 when 'Packed' then 3 when 'Left Warehouse' then 4 end desc nulls first, id) = 1"""


def outflow(spark, sf, events):
    head, _, _ = header_views(spark, sf)
    bind(spark, sf, "lineitem")
    return ops.outflow_table(run(spark, STAGE_LOG), run(spark, OUTFLOWS), run(spark, HOUSES), head, run(spark, SUBORDERS), events, STAGE_AS_OF)


@query("p_05_outflow_table", sql("shipment scan_wide", OUTFLOW))
def outflow_table(spark, sf):
    return outflow(spark, sf, tracking.tracking_events(bind(spark, sf, "scan_wide")))


H = "(epoch_us({}) - epoch_us({})) / 3.6e9"
OPS = f"""e as ({EVENTS}), b as ({TASK_BRIEF}), fin as ({FINANCE}), outf as ({OUTFLOW}),
  lr as (select awb, concat('rider_id: ', rider_id, ' -- rider_name: ') || rider_name as last_rider from (select awb, max_by(rider_id, struct_pack(task_start_time, task_id)) as rider_id,
      max_by(coalesce(rider_name, '~'), struct_pack(task_start_time, task_id)) as rn, nullif(rn, '~') as rider_name from b where awb is not null and task_start_time is not null group by awb) z),
  cod as (select shipment_id, max(collection_date) as col, max(cashflow_time) as cod_deposition_date from fin where reference_party_1 = 's301' and transaction_type = 'cod_amount' and realized and not anulled group by 1),
  ops_main as (select h.awb, h.shipment_id, h.shop_order_number, h.shipment_status, shipment_type, shipping_zone, warehouse_name, h.warehouse_city, shipping_city,
      case when shipper_id = 301 then trim(split_part(h.sort_code, '/', 2)) else 'NA-3PL' end as last_mile_hub, user_name, payment_type as mop, created_date, modified_date, {PARTNER} as shipping_partner, shipment_edd as edd,
      case when h.shipment_status in ('Delivered', 'RTO Delivered', 'Lost', 'Cancelled') then 'closed' else 'open' end as closure_status, coalesce(cast(delivery_attempts as double), no_attempts, 0.0::double) as delivery_attempts,
      first_failed_delivered as first_failed_time, first_failed_delivered_remarks as first_failed_remark, last_failed_delivered as last_failed_date, last_remark as latest_remark, ideal_pickup_time, ndd as next_delivery_date,
      case h.shipment_status when 'Delivered' then 'DL' when 'Reached Nearest Hub' then 'IN' when 'Out for Delivery' then 'OFD' when 'Failed Delivered' then 'ND' when 'RTO Out for Delivery' then 'RTO OFD' when 'Lost' then 'LT'
        when 'Picked-up' then 'IN' when 'NDR Initiated' then 'NDR' when 'RTO Delivered' then 'RTO DL' when 'Cancelled' then 'CN' when 'RTO Freeze' then case when shipper_id = 301 then 'RTO' else 'SND' end else 'SND' end as gs_status,
      pickup_time as pickuptime, delivered_time as delivertime, first_ofd as first_ofd_time, last_ofd as last_ofd_time, rto_initiated_time, rto_ofd_time, rto_delivered_time, rto_freeze_time, last_update_time,
      case when pickup_time::date > ideal_pickup_time::date then 0 when pickup_time::date <= ideal_pickup_time::date then 1 end as on_time_pickup,
      case when first_ofd::date > shipment_edd::date then 0 when first_ofd::date <= shipment_edd::date then 1 end as on_time_ofd,
      case when delivered_time::date > shipment_edd::date then 0 when delivered_time::date <= shipment_edd::date then 1 end as on_time_del, {H.format('pickup_time', 'first_ofd')} as pto_h, {H.format('ideal_pickup_time', 'delivered_time')} as ito_h,
      case when {H.format('delivered_time', 'ideal_pickup_time')} > 240 or pickup_time < first_ofd or pickup_time < delivered_time or created_date < delivered_time then 1 else 0 end as outlier_flag,
      last_failed_delivered_remarks as last_failed_remark, shipping_pincode, shipment_edd_logops as shipper_edd, last_update_time as last_scan_time, op_owner, h.sort_code, ideal_packed_time, last_location,
      case when last_location = 'Fulfillment Centre' then warehouse_name || ', ' || h.warehouse_city when shipper_id <> 301 then '3PL' when last_location = 'Rider' then last_rider end as last_location_details,
      packed_time as ready_to_dispatch_time, coalesce(col::timestamp, cod_deposition_date) as cod_collection_date, cod_deposition_date, timestamp '{STAGE_AS_OF}' as data_refresh_time
    from ({HEADER}) h left join e using (shipment_id) left join ({PROMISE}) p using (shipment_id) left join (select shipment_id, packed_time from outf) o using (shipment_id) left join cod using (shipment_id)
      left join lr on lr.awb = h.awb left join ({CLIENT}) c using (user_id))"""


def ops_frames(spark, sf):
    """Events, tasks and the shipment table; the first two are read by several stages and written out."""
    head, clients, promises = header_views(spark, sf)
    events = cut_lineage(tracking.tracking_events(bind(spark, sf, "scan_wide")))
    tasks = cut_lineage(task_brief(spark, sf))
    main = ops.ops_main(head, clients, events, promises, tasks, outflow(spark, sf, events), finance(spark, sf), STAGE_AS_OF)
    return head, events, tasks, main


@query("p_06_ops_main", sql("shipment scan_wide rider", f"with {OPS} select * from ops_main"))
def ops_main(spark, sf):
    return ops_frames(spark, sf)[3]


@query("p_07_ops_main_brief", sql("shipment scan_wide rider", f"""
    with {OPS} select o.shipment_id, o.awb, o.shop_order_number, user_name, shipping_partner, o.created_date, o.shipment_status, latest_remark, h.cod_amount, h.total_shipment_value as order_amount, edd, o.warehouse_name,
      o.shipping_pincode, h.shipping_city, o.shipping_zone, h.shipping_phone as customer_phone, pickuptime, delivertime, first_ofd_time, first_failed_time, closure_status, o.delivery_attempts, data_refresh_time as last_update_time
    from ops_main o left join ({HEADER}) h using (shipment_id)"""))
def ops_main_brief(spark, sf):
    head, _, _, main = ops_frames(spark, sf)
    return ops.ops_main_brief(main, head)


LOST_LOG = """select shipment_id as awb, shipment_status, update_time, update_time as timestamp, 301 as shipper_id, case tracking_id % 4 when 0 then concat('Lost on Hub: ', cast(tracking_id % 25 as varchar(3)), '. seen')
    when 1 then concat('Lost on Rider:', cast(tracking_id % 90 as varchar(3)), '.') when 2 then 'Lost on FM: truck' else 'unknown' end as remark from scan_wide"""


@query("p_08_lost_attribution", sql("shipment scan_wide rider node", f"""
    with l as (select s.awb, s.city as shipping_city, s.total_shipment_value as shipment_value, remark, cast(timestamp as date) as lost_date, case tracking % 4 when 0 then 'Hub' when 1 then 'Rider' when 2 then 'FM' end as attribution, tracking
      from shipment s join (select *, case when remark like 'Lost on Hub%' then 0 when remark like 'Lost on Rider%' then 1 when remark like 'Lost on FM%' then 2 else 3 end as tracking from ({LOST_LOG}) x where shipment_status = 'Lost'
        and update_time >= timestamp '2024-01-02') g on g.awb = s.awb where s.shipment_status = 'Lost')
    select awb, remark, attribution, locus_rider_id as rider_id, node_name, lost_date, shipment_value, shipping_city from l
    left join rider r on attribution = 'Rider' and r.rider_id = try_cast(split_part(split_part(remark, ':', 2), '.', 1) as bigint)
    left join node n on attribution = 'Hub' and n.node_id = try_cast(trim(split_part(split_part(remark, ':', 2), '.', 1)) as bigint) where attribution is not null"""))
def lost_attribution(spark, sf, hot="auto"):
    views(spark, sf, "scan_wide")
    head, _, _ = header_views(spark, sf)
    return ops.lost_attribution(head.select("awb", "shipment_status", "shipping_city"), run(spark, LOST_LOG), head, bind(spark, sf, "rider"), bind(spark, sf, "node"), since="2024-01-02", hot=hot)


with_hot_keys("p_08_lost_attribution", lost_attribution, 5)


# ---------------------------------------------------------------- daily hub table
KPI_OPS = """select awb, shipment_id, city as shipping_city, last_mile_hub, user_name, shipment_status, shipping_partner, created_date, pickuptime, first_ofd_time, last_ofd, delivertime, edd, last_scan_time,
  delivery_attempts, closure_status, edd + interval '1' day as next_delivery_date, last_ofd as last_failed_date, last_scan_time + interval '20' hour as modified_date,
  case when awb % 10 = 0 then 'house' else 'client' end as op_owner from ops"""
KPI_EVENTS = "select shipment_id, last_ofd, last_scan_time as lost_mark_time, last_scan_time - interval '2' hour as rto_freeze_time, last_scan_time as rto_ofd_time from ops"
KPI_RATING = "select awb, cast(task_id % 5 + 1 as double) as shipper_rating from task where status = 'COMPLETED'"
KPI_TASK = "select t.*, t.pincode as customer_pincode, concat('HB', cast(n.node_id as varchar(4))) as location_id from task t join shipment s on s.awb = t.awb join node n on n.node_name = s.hub"
KPI_NODE = "select *, concat('HB', cast(node_id as varchar(4))) as home_base_id from node"
KPI_TRIP = "select task_id, case task_id % 3 when 0 then 'Manual__hub' when 1 then 'upi' end as collected_by, cod_amount from task"
KPI_TARGET = """select distinct n.node_name as last_mile_hub, n.city as shipping_city, cast(date_trunc('month', o_orderdate) as date) as month, cast(n.node_id % 4 + 1 as double) / 2 as target_productivity
  from node n join customer on c_nationkey = n.node_id join orders on o_custkey = c_custkey where n.node_id % 6 <> 4"""
KPI_START, KPI_END = "1995-01-01", "2001-09-30"
KPI_NOW = f"timestamp '{AS_OF_TASK} 00:00:00'"
HUB = "shipping_city, last_mile_hub"


def midnight(c):
    return f"date_trunc('day', {c})::timestamp"


def per(num, den):
    return f"{num} / nullif({den}, 0)::double"


def same_day(side):
    return f"left join {side} on {side}.shipping_city = g.shipping_city and {side}.last_mile_hub = g.last_mile_hub and {side}.datetime = g.datetime"


def kpi_sql() -> str:
    """Checking SQL: one aggregation per side, joined to the grid."""
    fresh, done, cod = "attempt_number = 1", "status = 'COMPLETED'", "cod_amount > 0"
    return f"""with o as ({KPI_OPS}), ev as ({KPI_EVENTS}), dims as (select awb, max(length * breadth * height) as vol, max(weight) as wt from weight group by 1),
      stars as (select awb, sum(shipper_rating) as rs, count(shipper_rating) as rn from ({KPI_RATING}) r group by 1),
      b0 as (select o.awb, o.shipping_city, n.node_name as last_mile_hub, o.shipment_status, {midnight('pickuptime')} as pickup_date, case when op_owner = 'house' then o.created_date else pickuptime end as datetime,
          case when {midnight('delivertime')} <= edd then 1 else 0 end as otd, case when {midnight('first_ofd_time')} <= edd then 1 else 0 end as ofd, edd, next_delivery_date as ndd, last_failed_date::date as last_failed_date,
          modified_date::date as modified_date, rto_freeze_time::date as rto_freeze_date, rto_ofd_time::date as rto_ofd_date, ev.last_ofd, delivery_attempts, last_scan_time, lost_mark_time, closure_status, rs, rn,
          greatest(s.shipment_chargeable_weight, vol / 5000.0, wt) as weight
        from o join node n on trim(split_part(n.sort_codes, '/', 2)) = o.last_mile_hub left join ev on ev.shipment_id = o.shipment_id left join shipment s on s.shipment_id = o.shipment_id
          left join dims on dims.awb = o.awb left join stars on stars.awb = o.awb where shipping_partner = 'Hyperlocal'),
      b1 as (select *, case when shipment_status = 'Picked-up' and datetime is not null then 'pickup' when shipment_status = 'Reached Nearest Hub' then 'fresh_attempt' when shipment_status = 'NDR Initiated' then 'reattempt'
          when shipment_status = 'Failed Delivered' then 'ndr_required' when shipment_status = 'Out for Delivery' and last_ofd::date = {KPI_NOW}::date then 'action_taken'
          when shipment_status = 'Out for Delivery' and delivery_attempts >= 1 then 'reattempt' when shipment_status = 'Out for Delivery' then 'fresh_attempt' when shipment_status = 'RTO Freeze' then 'RTO OFD'
          when shipment_status = 'RTO Out for Delivery' then 'RTO Delivery' when shipment_status = 'Lost' then 'Lost' else 'action_taken' end as bucket from b0),
      b as (select *, case when bucket = 'pickup' then edd when bucket in ('fresh_attempt', 'reattempt') then ndd when bucket = 'ndr_required' then last_failed_date::timestamp when bucket = 'RTO OFD' then rto_freeze_date::timestamp
          when bucket = 'RTO Delivery' then rto_ofd_date + interval 1 day when bucket = 'Lost' then {midnight('lost_mark_time')} else modified_date::timestamp end as action_date from b1),
      g as (select h.*, d as datetime from (select distinct {HUB} from b where shipping_city is not null and last_mile_hub <> '') h,
          (select unnest(generate_series(timestamp '{KPI_START}', timestamp '{KPI_END}', interval 1 day)) as d) s),
      intake as (select {HUB}, {midnight('datetime')} as datetime, count(distinct awb) as drr, cast(sum(case when weight >= 2000 then 1 else 0 end) as bigint) as heavy_shipments from b where datetime is not null group by 1, 2, 3),
      due as (select {HUB}, edd as datetime, cast(sum(otd) as bigint) as otd, cast(sum(ofd) as bigint) as ofd, count(*) filter (shipment_status = 'Delivered') as delivered, count(distinct awb) as efd,
          cast(sum(coalesce(rn, 0)) as bigint) as no_ratings, {per('sum(rs)', 'sum(coalesce(rn, 0))')} as avg_rating from b where pickup_date is not null group by 1, 2, 3),
      pend as (select {HUB}, action_date as datetime, count(distinct awb) filter (bucket = 'fresh_attempt') as fresh_pending, count(distinct awb) filter (bucket = 'reattempt') as reattempt_pending,
          count(distinct awb) filter (bucket = 'pickup') as pickup_pending, count(distinct awb) filter (bucket = 'Lost') as lost_marked from b group by 1, 2, 3),
      miss as (select {HUB}, {midnight('last_scan_time')} as datetime, count(distinct awb) as missing_shipment from b where last_scan_time <= {KPI_NOW} - interval 24 hour and closure_status <> 'closed' and pickup_date is not null group by 1, 2, 3),
      lt as (select t.*, n.node_name as last_mile_hub, n.city as shipping_city, {midnight('dispatch_time')} as datetime, rank() over (partition by t.awb order by dispatch_time) as attempt_number, p.collected_by, p.cod_amount as paid
        from ({KPI_TASK}) t left join ({KPI_NODE}) n on n.home_base_id = t.location_id left join ({KPI_TRIP}) p on p.task_id = t.task_id),
      att as (select {HUB}, datetime, count(*) filter ({fresh} and {done}) as fresh_delivered, count(*) filter ({fresh}) as fresh_attempted, count(*) filter ({fresh} and {done} and not {cod}) as prepaid_fresh_delivered,
          count(*) filter ({fresh} and not {cod}) as prepaid_fresh_attempted, count(*) filter ({fresh} and {done} and {cod}) as cod_fresh_delivered, count(*) filter ({fresh} and {cod}) as cod_fresh_attempted,
          count(*) filter ({done}) as locus_delivered, {cents("case when lower(collected_by) not like '%manual%' then paid else 0 end")} as upi_collection,
          {cents("case when lower(collected_by) like '%manual%' then paid else 0 end")} as cash_collection, count(distinct rider_id) as mandays, count(distinct customer_pincode) as distinct_pincodes from lt group by 1, 2, 3)
    select concat(strftime(g.datetime, '%d/%m/%Y'), '-', g.shipping_city, '-', g.last_mile_hub) as key, g.datetime, g.shipping_city, g.last_mile_hub, drr, heavy_shipments, otd, ofd, delivered, efd,
      otd // nullif(efd, 0) as otd_pct, ofd // nullif(efd, 0) as ofd_pct, delivered // nullif(efd, 0) as del_pct, {per('otd', 'efd')} as otd_ratio, {per('ofd', 'efd')} as ofd_ratio, {per('delivered', 'efd')} as del_ratio,
      no_ratings, avg_rating, prepaid_fresh_delivered, prepaid_fresh_attempted, cod_fresh_delivered, cod_fresh_attempted, fresh_delivered, fresh_attempted, mandays,
      {per('prepaid_fresh_delivered', 'prepaid_fresh_attempted')} as prepaid_fasr, {per('cod_fresh_delivered', 'cod_fresh_attempted')} as cod_fasr, {per('fresh_delivered', 'fresh_attempted')} as fasr,
      upi_collection, cash_collection, locus_delivered, {per('locus_delivered', 'mandays')} as productivity, distinct_pincodes, {per('locus_delivered', 'distinct_pincodes')} as load_per_pincode,
      fresh_pending, reattempt_pending, pickup_pending, lost_marked, missing_shipment, target_productivity, {per('locus_delivered', 'mandays')} / nullif(target_productivity, 0) as cap_util
    from g {' '.join(same_day(x) for x in ('intake', 'due', 'att', 'pend', 'miss'))}
      left join ({KPI_TARGET}) t on t.last_mile_hub = g.last_mile_hub and t.shipping_city = g.shipping_city and t.month = date_trunc('month', g.datetime)::date"""


@query("p_09_main_metric_table", sql("ops weight node", kpi_sql()))
def main_metric_table(spark, sf):
    return hub_table(spark, sf)


def older_kpi_sql() -> str:
    """Attempts at the shipment's own city and hub, own-network shipments only."""
    text = kpi_sql()
    i, j = text.index("      lt as (select"), text.index("      att as (select")
    own = f"""      lt as (select t.*, b.last_mile_hub, b.shipping_city, {midnight('dispatch_time')} as datetime, rank() over (partition by t.awb order by dispatch_time) as attempt_number, p.collected_by, p.cod_amount as paid
        from ({KPI_TASK}) t join b on b.awb = t.awb left join ({KPI_TRIP}) p on p.task_id = t.task_id),
"""
    text = text[:i].rstrip() + "\n" + own + text[j:]
    return text.replace(" as cap_util\n", " as cap_util, delivered / nullif(mandays, 0)::double as delivered_productivity\n")


@query("p_09_main_metric_table_older", sql("ops weight node", older_kpi_sql()))
def main_metric_table_older(spark, sf):
    return kpi.with_delivered_productivity(hub_table(spark, sf, older=True))


def hub_table(spark, sf, older=False):
    views(spark, sf, "task", "shipment", "ops", "node")
    nodes = run(spark, KPI_NODE)
    base = kpi.shipment_base(run(spark, KPI_OPS), run(spark, KPI_EVENTS), bind(spark, sf, "shipment"), bind(spark, sf, "weight").withColumnRenamed("awb", "shipment_awb"),
                             run(spark, KPI_RATING), nodes, AS_OF_TASK, months=None, created_owners=["house"])
    if older:
        attempts = kpi.attempt_metrics_of(run(spark, KPI_TASK), base, run(spark, KPI_TRIP))
    else:
        attempts = kpi.attempt_metrics(run(spark, KPI_TASK), nodes, run(spark, KPI_TRIP), AS_OF_TASK, months=None)
    return kpi.main_metric_table(base, attempts, run(spark, KPI_TARGET), AS_OF_TASK, start=KPI_START, end=KPI_END, keep=cut_lineage)

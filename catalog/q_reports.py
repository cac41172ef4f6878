"""Payout runs, margins and reports (P-10 to P-25)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bindings import bind, cents, run, sql
from catalog.q_business import followed, ranked_tasks  # noqa: F401
from catalog.q_changes import COHORT_DUCK, cohort_rows
from catalog.q_money import (ALLOCATED, APRIL, DAY_OUT, FLOWS, FRANCHISE, FRANCHISE_DELIVERY, FRANCHISE_HEAVY, LANE_COST, LEDGER, LEGACY, LINES, MARGIN_ROWS, NEEDS, OWN, SLABS_LEGACY, TRIPS, days_sql, dense, dense_rows, ledger, ledger_sql,
                             margin_rows, merged, rider_margin_sql, views)
from catalog.registry import AS_OF_TASK, query
from haulmark import rules
from haulmark.functions import clock, text
from haulmark.functions.numbers import exact_sum
from haulmark.operators import cash, cohort, margin, payout, service
from haulmark.plans import margins, pay, reports, trips
from haulmark.session import cut_lineage

NOW = f"timestamp '{AS_OF_TASK} 00:00:00'"


# ---------------------------------------------------------------- P-10, P-11
@query("p_10_cod_base_data", sql("task crew txn", f"""
    with trips as ({TRIPS}), {ledger_sql('1998-06-15')} select l.* from ledger l join (select trip_id, dispatch_time, completed_at from trips) t using (trip_id)
    where dispatch_time >= timestamp '1998-06-01' and completed_at >= timestamp '1998-06-15'"""))
def cod_base_data(spark, sf):
    views(spark, sf, "task", "crew", "txn")
    return cash.cod_ledger(run(spark, TRIPS), run(spark, LINES), run(spark, FLOWS), AS_OF_TASK, months=36)


TRIP_ROWS = """select task_id as trip_id, concat('L', cast(task_id as varchar(12))) as locus_trip_id, awb as trip_name, dispatch_time as start_at, status, cod_amount, cancellation_remarks as failed_delivery_reason,
  case when status <> 'ONGOING' then dispatch_time + interval '7' hour end as closed_at, tour_id, pincode as location_dest, awb as shipment_id from task"""
PLACES = "select distinct pincode as location_id, concat('pin ', cast(pincode as varchar(6))) as pincode, concat('street ', cast(pincode as varchar(6))) as address, 8 + cast(pincode as double) / 64 as lat, 70 + cast(pincode as double) / 32 as lng from task"
TRIP_TOURS = "select tour_id, min(rider_id) as rider_id, min(tour_id % 25) as node_id, min(dispatch_time) as start_time, max(dispatch_time) as end_time, cast(min(dispatch_time) as date) as tour_date from task group by tour_id"
TRIP_NODES = "select node_id, node_name, node_type, city as actual_city_name, concat('HB', cast(node_id as varchar(4))) as home_base_id from node"


@query("p_11_trip_extract", sql("task rider node", f"""
    select t.trip_id, locus_trip_id, trip_name as awb, start_at as dispatch_time, status, cod_amount, failed_delivery_reason as cancellation_remarks, t.tour_id, shipment_id,
      case when status = 'COMPLETED' then closed_at end as completed_at, case when status = 'CANCELLED' then closed_at end as cancelled_at, p.pincode, address as customer_address, lat as actual_location_lat, lng as actual_location_lng,
      u.rider_id as num_rider_id, u.node_id, start_time as slot_start, end_time as slot_end, tour_date, locus_rider_id as rider_id, rider_name, phone as rider_phone, node_name, node_type, actual_city_name as shipping_city, home_base_id as location_id
    from ({TRIP_ROWS}) t left join ({PLACES}) p on p.location_id = t.location_dest left join ({TRIP_TOURS}) u on u.tour_id = t.tour_id left join rider r on r.rider_id = u.rider_id left join ({TRIP_NODES}) n on n.node_id = u.node_id"""))
def trip_extract(spark, sf):
    views(spark, sf, "task", "node")
    return trips.trip_extract(run(spark, TRIP_ROWS), run(spark, PLACES), run(spark, TRIP_TOURS), bind(spark, sf, "rider"), run(spark, TRIP_NODES))


# ---------------------------------------------------------------- P-13, P-14
PARTS = ["org_id_pay", "delivery_pay", "heavy_pay", "vfd_pay", "evening_pay", "mg_payed"]


def months_sql(needed: str, present: int, full: int) -> str:
    return f"""m0 as (select date_trunc('month', dispatch_date)::timestamp as dispatch_month, city, rider_id, hub, payout_structure, count(distinct dispatch_date) filter (delivered >= {present}) as attendance,
        count(distinct dispatch_date) filter (delivered >= {full}) as whole, cast(sum(delivered) as bigint) as delivered, {', '.join(f'{cents(p)} as {p}' for p in PARTS)}, {cents('fixed_pay')} as fixed_pay from d group by 1, 2, 3, 4, 5),
      m as (select * exclude (whole), org_id_pay + delivery_pay + vfd_pay + evening_pay + mg_payed + heavy_pay as total_variable_pay, case when whole >= {needed} then 1000 else 0 end::double as attendance_incentive,
        total_variable_pay + fixed_pay + attendance_incentive as total_pay from m0)"""


APRIL_MONTHS = months_sql("case when city in ('Mumbai', 'Bangalore') then 28 else 26 end", 3, 4)


@query("p_13_april_month_view", sql(NEEDS, f"""
    with {dense(OWN)}, {APRIL}, {days_sql('april')}, {APRIL_MONTHS},
      f as (select rider_id, count(*) filter (order_type = 'Fresh' and status = 'COMPLETED') / nullif(count(*) filter (order_type = 'Fresh'), 0)::double as fasr from x group by 1)
    select m.*, rider_name, vendor_name, fasr from m left join (select rider_id, rider_name, vendor_name from crew) c using (rider_id) left join f using (rider_id)"""))
def april_month_view(spark, sf):
    orders = dense_rows(spark, sf)
    return pay.month_view(pay.own_payout(orders)["months"], bind(spark, sf, "crew"), orders)


HUB_SUMS = [*PARTS, "total_variable_pay", "fixed_pay", "attendance_incentive", "total_pay"]


@query("p_13_april_hub_view", sql(NEEDS, f"""
    with {dense(OWN)}, {APRIL}, {days_sql('april')}, {APRIL_MONTHS}, h as (select dispatch_month, city, hub, cast(sum(attendance) as bigint) as mandays, cast(sum(delivered) as bigint) as delivered,
      {', '.join(f'{cents(p)} as {p}' for p in HUB_SUMS)} from m group by 1, 2, 3) select *, total_pay / nullif(delivered, 0)::double as cpo from h"""))
def april_hub_view(spark, sf):
    return pay.own_payout(dense_rows(spark, sf))["hubs"]


COST_OUT = "awb, task_id, dispatch_date, slot, city, warehouse_city, hub, rider_id, awb_pay, status, payout_structure"
F_PAY = f"({FRANCHISE_DELIVERY} + {FRANCHISE_HEAVY})::double"


def franchise_ctes() -> str:
    return dense(FRANCHISE).replace("att as", "fatt as").replace("from att", "from fatt").replace("att.", "fatt.").replace("dims as", "fdims as").replace("join dims", "join fdims").replace("x as (select", "fx as (select")


@query("p_13_order_costs", sql(NEEDS, f"""
    with {dense(OWN)}, {APRIL}, {days_sql('april')}, a as (select k.*, p.slot, p.city, p.warehouse_city, p.hub, p.status, p.payout_structure from ({ALLOCATED}) k join p on p.task_id = k.task_id), {franchise_ctes()}
    select {COST_OUT} from a union select awb, task_id, date_trunc('day', dispatch_time)::timestamp, slot, city, warehouse_city, hub, rider_id, {F_PAY}, status, payout_structure from fx where status = 'COMPLETED'"""))
def order_costs(spark, sf):
    own = pay.own_payout(dense_rows(spark, sf), keep=cut_lineage)["costs"]
    return pay.order_costs(own, dense_rows(spark, sf, franchise=True))


TABLE_SUM = "delivery_pay + heavy_pay + evening_pay + fasr_pay + mg_payed"


@query("p_13_zone_day_table", sql(NEEDS, f"""
    with {dense(OWN)}, z as (select * from x where city in ('Bangalore', 'Hyderabad', 'Mumbai') and dispatch_time < timestamp '2000-06-17'), {APRIL.replace('from x)', 'from z)')}, {days_sql('zone')},
      t as (select *, case when fasr > 0.9 then 2 * delivered when fasr > 0.85 then delivered else 0 end::double as fasr_pay, 0.0::double as zero from d)
    select city as shipping_city, hub as node_name, rider_id as num_rider_id, payout_structure, dispatch_date, attempted as assigned, delivered, fasr, delivery_pay as order_base_0_pay, heavy_pay as order_base_3000_pay,
      zero as order_base_5000_pay, zero as order_slot_0_12_pay, zero as order_slot_12_15_pay, evening_pay as order_slot_15_24_pay, zero as pincode_rate_pay, fasr_pay, mg_payed, fixed_pay, zero as fixed_milestone_pay,
      {TABLE_SUM} as order_subtotal, fixed_pay as fixed_subtotal, {TABLE_SUM} + fixed_pay as total_pay, concat(cast(rider_id as varchar), '-', strftime(dispatch_date, '%Y-%m-%d'), '-', hub) as key from t"""))
def zone_day_table(spark, sf):
    return pay.zone_day_table(dense_rows(spark, sf), until="2000-06-16")


LEGACY_DAYS = days_sql("april").replace(days_sql("april").split("case when payout_structure = 'ORDER' then ")[1].split(" else 0 end::double as order_mg")[0], "case when city = 'Mumbai' and delivered > 2 then 600 else 0 end")
LEGACY_DAYS = LEGACY_DAYS.replace(LEGACY_DAYS.split("case when payout_structure = 'FIXED' then ")[1].split(" else 0 end as fixed_pay")[0], SLABS_LEGACY.format(d="delivered"))


@query("p_13_legacy_month_view", sql(NEEDS, f"with {dense(OWN)}, {LEGACY}, {LEGACY_DAYS}, {months_sql('26', 2, 0)} select * from m"))
def legacy_month_view(spark, sf):
    import dataclasses
    card = dataclasses.replace(rules.ORDER_CARDS["legacy"], special_clients=(2, 34))
    days = payout.rider_day(payout.order_pay(dense_rows(spark, sf), card), "legacy")
    return payout.rider_month(days, "legacy")


FUEL_TOURS = """select o_orderkey % 4000 as tour_id, min(o_orderkey % 97) as rider_id, cast(min(o_orderdate) as date) as tour_date, cast(count(*) as double) * 7.5 as fuel_payout, cast(min(o_orderkey % 37) as double) + 0.5 as covered_distance,
  count(*) as total_tasks, sum(case when o_orderstatus = 'F' or o_totalprice > 450000 then 1 else 0 end) as completed_tasks from orders group by 1"""


@query("p_14_fuel_payout", sql("task crew txn", f"""
    with trips as ({TRIPS}), {LEDGER}, cod as (select rider_id, {cents('amount')} as cod_pending from ledger where collected = 0 and delivery_date < date '2001-06-14' group by 1),
      b as (select hub as node_name, node_type, tour_date, t.rider_id, rider_name, fuel_payout_automation, {cents('fuel_payout')} as fuel_payout, cast(sum(total_tasks) as bigint) as assigned_orders, cast(sum(completed_tasks) as bigint) as delivered_orders,
        {cents('covered_distance')} as covered_distance, count(tour_id) as tours from ({FUEL_TOURS}) t left join crew c on c.rider_id = t.rider_id group by 1, 2, 3, 4, 5, 6),
      k as (select * from b where fuel_payout_automation = 'true'),
      low as (select rider_id from k group by 1 having sum(delivered_orders) / nullif(sum(assigned_orders), 0)::double < 0.4)
    select k.*, cod_pending, covered_distance as final_distance, fuel_payout as final_fuel_payout, case when assigned_orders <> 0 then delivered_orders / assigned_orders::double else 0 end as del_percent
    from k left join cod using (rider_id) where rider_id not in (select rider_id from low) and node_type <> 'franchise_hub'"""))
def fuel_payout(spark, sf):
    bind(spark, sf, "orders")
    t = run(spark, FUEL_TOURS)
    crew = bind(spark, sf, "crew")
    nodes = crew.select("node_id", F.col("hub").alias("node_name"), "node_type").distinct()
    return pay.fuel_payout(t.select("tour_id", "rider_id", "tour_date"), crew, nodes, t.select("tour_id", "fuel_payout", "covered_distance"),
                           t.select("tour_id", "total_tasks", "completed_tasks"), ledger(spark, sf), AS_OF_TASK)


# ---------------------------------------------------------------- P-15, P-16
@query("p_15_margin_by_rider_slot", rider_margin_sql("rider_id, dispatch_date, slot", "awb_pay"))
def margin_by_rider_slot(spark, sf):
    return margins.rider_margin(margin_rows(spark, sf), ("shipping_city", "rider_id", "dispatch_date", "slot"), "awb_pay")


DELIVERED = "select t.awb, task_id as trip_id, t.rider_id as num_rider_id, hub as node_name, city as shipping_city, dispatch_time from task t join crew c on c.rider_id = t.rider_id where status = 'COMPLETED'"
RIDER_PAY = """select c.rider_id, city, case when vendor_name = 'vendor 2' then '3WH' else vendor_name end as vendor_name, payout_structure, cast(1000 + c.rider_id * 13 as double) as total_pay, concat(city, '-', vendor_name) as key
  from crew c where hub_type = 'own' and node_id <> 7"""
FRANCHISE_PAY = "select distinct hub, cast(5000 + length(hub) * 100 as double) as total_pay from crew where hub_type = 'franchise'"
VENDORS = "select distinct concat(city, '-', vendor_name) as key, cast(length(vendor_name) as double) / 100 as extra_per_rs from crew where vendor_name <> 'vendor 4'"
CITY_FUEL = "select distinct city, cast(length(city) * 1000 as double) as amount from crew where city <> 'Jaipur'"
MONTH_REVENUE = """select awb, user_name, warehouse_city, case when city = 'Jaipur' then 'NCR' else city end as shipping_city, pincode as drop_pincode,
  case awb % 4 when 0 then 'RTO Delivered' when 1 then 'Lost' else 'Delivered' end as shipment_status, case when awb % 2 = 0 then 'COD' else 'Prepaid' end as mop, abs(total_shipment_value) as shipment_charges from shipment"""
MID_MILE = "select distinct city as shipping_city, cast(length(city) * 4321 as double) as cost from crew"
COSTS = f"""one as (select * from (select *, row_number() over (partition by awb order by dispatch_time desc, trip_id) as rn from ({DELIVERED}) x) y where rn = 1),
  pr as (select rider_id, vendor_name, payout_structure, total_pay / nullif(orders, 0)::double as rider_pay_cpo, key from ({RIDER_PAY}) p left join (select num_rider_id, count(awb) as orders from one group by 1) o on o.num_rider_id = p.rider_id),
  fr as (select hub, total_pay / nullif(orders, 0)::double as c from ({FRANCHISE_PAY}) p left join (select node_name, count(awb) as orders from one group by 1) o on o.node_name = p.hub),
  mast as (select one.* exclude (rn), coalesce(vendor_name, hub) as vendor_name, coalesce(payout_structure, case when hub is not null then 'ORDER' end) as payout_structure, coalesce(rider_pay_cpo, c) as rider_pay_cpo, coalesce(key, hub) as key
    from one left join pr on pr.rider_id = one.num_rider_id left join fr on fr.hub = one.node_name),
  fu as (select o.shipping_city, amount / nullif(orders, 0)::double as fuel_cpo from (select shipping_city, count(awb) as orders from one group by 1) o left join ({CITY_FUEL}) f on f.city = o.shipping_city),
  cost as (select mast.* exclude (key), coalesce(rider_pay_cpo * extra_per_rs, 0) as vendor_cpo, coalesce(fuel_cpo, 0) as fuel_cpo from mast left join ({VENDORS}) v using (key) left join fu using (shipping_city)
    where mast.vendor_name is not null and rider_pay_cpo is not null and key is not null)"""


def month_costs(spark, sf):
    views(spark, sf, "task", "crew", "shipment")
    return margins.monthly_costs(run(spark, DELIVERED), run(spark, RIDER_PAY).drop("city"), run(spark, FRANCHISE_PAY), run(spark, VENDORS), run(spark, CITY_FUEL))


@query("p_16_monthly_costs", sql("task crew", f"with {COSTS} select * from cost"))
def monthly_costs(spark, sf):
    return month_costs(spark, sf)


MONTH_MARGIN = f"""{COSTS}, r as (select * replace ({merged('warehouse_city')} as warehouse_city, {merged('shipping_city')} as shipping_city) from ({MONTH_REVENUE}) x),
  sh as (select shipping_city, count(*) filter (shipment_status = 'Delivered') as dn, nullif(count(*) filter (shipment_status = 'RTO Delivered'), 0) as rn from r group by 1),
  mm as (select p.shipping_city, cost - coalesce(own, 0) as cost from ({MID_MILE}) p left join (select city, {cents('total_pay')} as own from ({RIDER_PAY}) q where vendor_name = '3WH' group by 1) o on o.city = p.shipping_city),
  fac as (select mm.shipping_city, round_even(cost / nullif(dn + 2 * rn, 0)::double * 100, 0) / 100 as r_factor from mm left join (select * from sh where dn > 0) sh using (shipping_city)),
  j as (select r.*, cost.* exclude (awb, shipping_city), shipment_status = 'RTO Delivered' as back from r join cost on cost.awb = r.awb where shipment_status <> 'RTO Delivered'
    union all select r.*, {', '.join('null' for _ in range(9))}, true from r where shipment_status = 'RTO Delivered')"""


@query("p_16_monthly_margin", sql("task crew shipment", f"""
    with {MONTH_MARGIN} select j.awb, user_name, warehouse_city, j.shipping_city, drop_pincode, shipment_status, mop, shipment_charges as rpo, case when back then 0 else trip_id end as trip_id, case when back then 0 else num_rider_id end as num_rider_id,
      case when back then '0' else node_name end as node_name, case when back then timestamp '1970-01-01' else dispatch_time end as dispatch_time, case when back then '0' else vendor_name end as vendor_name,
      case when back then '0' else payout_structure end as rider_payout_structure, case when back then 0 else rider_pay_cpo end as rider_pay_cpo, case when back then 0 else vendor_cpo end as vendor_cpo,
      case when back then 0 else fuel_cpo end as rider_fuel_cpo, case shipment_status when 'RTO Delivered' then 2 * r_factor when 'Delivered' then r_factor else 0 end as fm_mm_cpo from j left join fac using (shipping_city)"""))
def monthly_margin(spark, sf):
    costs = month_costs(spark, sf)
    return margins.monthly_margin(run(spark, MONTH_REVENUE), costs, run(spark, MID_MILE), run(spark, RIDER_PAY))


@query("p_16_vendor_margins", sql("task crew shipment", f"""
    with {MONTH_MARGIN}, k as (select j.*, case shipment_status when 'RTO Delivered' then 2 * r_factor when 'Delivered' then r_factor else 0 end as fm from j left join fac using (shipping_city)),
      g as (select shipping_city, case when back then '0' else vendor_name end as vendor_name, case when back then 0 else num_rider_id end as num_rider_id, count(awb) as awb, coalesce({cents('case when back then 0 else rider_pay_cpo end', 4)}, 0) as rider_pay,
        coalesce({cents('case when back then 0 else vendor_cpo end', 4)}, 0) as vendor_pay, coalesce({cents('case when back then 0 else fuel_cpo end', 4)}, 0) as rider_fuel_cpo, coalesce({cents('fm', 4)}, 0) as fm_mm_cpo, coalesce({cents('shipment_charges', 4)}, 0) as rpo from k group by 1, 2, 3)
    select *, rider_pay + vendor_pay + rider_fuel_cpo + fm_mm_cpo as total_cost, rpo - total_cost as margin from g"""))
def vendor_margins(spark, sf):
    return margin.vendor_margins(monthly_margin(spark, sf))


@query("p_16_corrected_city", sql("task crew shipment ops", f"""
    with {MONTH_MARGIN} select j.awb, coalesce(case when o.hubs >= 12 then null when o.city = 'NCR' then 'Delhi' else o.city end, j.shipping_city) as shipping_city, shipment_status from j
    left join (select awb, warehouse_city as city, delivery_attempts as hubs from ops) o using (awb)"""))
def corrected_city(spark, sf):
    known = bind(spark, sf, "ops").select("awb", F.when(F.col("delivery_attempts") < 12, F.col("warehouse_city")).alias("shipping_city"))
    return margins.corrected_city(monthly_margin(spark, sf).select("awb", "shipping_city", "shipment_status"), known)


# ---------------------------------------------------------------- P-17, P-18
# All attempts folded onto one June, so that every day of the report month is full.
REPORT_TASK = """select task_id, awb, status, t.rider_id, rider_name, city, hub, timestamp '2001-06-01 00:00:00' + (day(dispatch_time) - 1) * interval '1' day + hour(dispatch_time) * interval '1' hour as dispatch_time, cod_amount,
  task_id % 3 <> 0 as is_realized, task_id % 5 <> 0 as is_collected, cod_amount > 470000 as is_fake_attempt from task t join crew c on c.rider_id = t.rider_id"""
REPORT_CASH = "select rider_id, cast(dispatch_time as date) as delivery_date, cod_amount / 100 as amount, case when is_collected then 1 else 0 end as collected from rt where status = 'COMPLETED'"
REPORT_LOSS = "select rider_id, task_id as awb, cast(dispatch_time as date) as lost_date, cod_amount / 3000 as shipment_value from rt where status = 'CANCELLED'"
REPORT_PAY = "select rider_id, dispatch_time - hour(dispatch_time) * interval '1' hour as trip_date, cod_amount / 800 as amount from rt where status = 'COMPLETED' and is_realized"
REPORT_PIP = "select rider_id, date '2001-06-11' as pip_date, 'running' as pip_status, case when vendor_name = 'vendor 1' then 'failed' else '' end as pip_result from crew where vendor_name in ('vendor 1', 'vendor 3')"
REPORT_DAY = "2001-06-15"
DAY = f"timestamp '{REPORT_DAY} 00:00:00'"


def rupees(c):
    return rf"""'₹' || (case when length({c}) <= 3 then {c} else regexp_replace(reverse(regexp_replace(reverse(left({c}, length({c}) - 3)), '(\d\d)', '\1,', 'g')) || ',' || right({c}, 3), '^,', '') end)"""


def whole(c):
    return f"cast(cast(round({c}) as bigint) as varchar)"


def counted(cond):
    return f"count(*) filter ({cond})"


def percent(c):
    return f"lpad(cast(cast(round_even({c} * 100, 0) as bigint) as varchar), 4, ' ') || '%'"


def flag(cond):
    return f"case when {cond} then 1 else 0 end"


TODAY, OLD, FRESH, DONE = f"d = {DAY}", f"d < {DAY}", "rk = 1", "status = 'COMPLETED'"
RIDER_REPORT = rf"""with rt as ({REPORT_TASK}), k as (select *, date_trunc('day', dispatch_time)::timestamp as d, rank() over (partition by awb order by dispatch_time) as rk from rt where dispatch_time < {DAY} + interval 1 day),
  n as (select city, hub, rider_id, rider_name, {counted(TODAY)} as assigned, {counted(f'{TODAY} and {DONE}')} as delivered, {counted(f'{TODAY} and {FRESH}')} as fresh_attempted, {counted(f'{TODAY} and {FRESH} and {DONE}')} as fresh_delivered,
    {counted(f'{TODAY} and {FRESH} and cod_amount = 0')} as prepaid_fresh_attempted, {counted(f'{TODAY} and {FRESH} and {DONE} and cod_amount = 0')} as prepaid_fresh_delivered,
    {counted(f'{TODAY} and {FRESH} and cod_amount <> 0')} as cod_fresh_attempted, {counted(f'{TODAY} and {FRESH} and {DONE} and cod_amount <> 0')} as cod_fresh_delivered, {counted('is_fake_attempt')} as mtd_fake,
    {counted(f'is_fake_attempt and {TODAY}')} as today_fake, {counted(f"status = 'CANCELLED' and not is_realized and {TODAY}")} as today_fd_pendency, {counted(f"status = 'CANCELLED' and not is_realized and {OLD}")} as past_fd_pendency
    from k where lower(hub) not like '%franchise%' group by 1, 2, 3, 4 having assigned <> 0),
  fk as (select rider_id, {', '.join(f"max(awb) filter (rn = {i}) as a{i}" for i in range(1, 11))} from (select *, row_number() over (partition by rider_id order by dispatch_time, task_id) as rn from k where is_fake_attempt and {TODAY}) x group by 1),
  owed as (select rider_id, {cents(f"case when delivery_date = {DAY}::date then amount else 0 end")} as tc, {cents(f"case when delivery_date < {DAY}::date then amount else 0 end")} as pc from ({REPORT_CASH}) c where collected = 0 group by 1),
  lost as (select rider_id, {cents('shipment_value')} as lost_amount, count(awb) as lc from ({REPORT_LOSS}) l where lost_date < date '2001-07-01' group by 1), earn as (select rider_id, {cents('amount')} as me, {cents(f"case when trip_date = {DAY} then amount else 0 end")} as te from ({REPORT_PAY}) p where trip_date < timestamp '2001-07-01' group by 1),
  j as (select n.*, delivered / nullif(assigned, 0)::double as delivery_per, fresh_delivered / nullif(fresh_attempted, 0)::double * 100 as fasr, prepaid_fresh_delivered / nullif(prepaid_fresh_attempted, 0)::double as prepaid_fasr_per,
    cod_fresh_delivered / nullif(cod_fresh_attempted, 0)::double as cod_fasr_per, coalesce(tc, 0.0::double) as today_cod, coalesce(pc, 0.0::double) as past_cod, lost_amount, coalesce(lc, 0) as lost_count,
    coalesce(case when pip_result = 'failed' then 'failing' when pip_result is not null then 'passing' end, 'no_pip') as pip_result, {', '.join(f"coalesce(cast(a{i} as varchar), '') as fr_{i}" for i in range(1, 11))}, phone, me, te
    from n left join owed using (rider_id) left join lost using (rider_id) left join earn using (rider_id) left join fk using (rider_id) left join ({REPORT_PIP}) pip using (rider_id) left join (select rider_id, phone from crew) c using (rider_id)),
  f as (select * exclude (me, te), {percent('delivery_per')} as delivery_per_string, {percent('prepaid_fasr_per')} as prepaid_fasr_per_string, {percent('cod_fasr_per')} as cod_fasr_per_string,
    case when today_cod <> 0 then {rupees(whole('today_cod'))} else '0' end as today_cod_string, case when past_cod <> 0 then {rupees(whole('past_cod'))} else '0' end as past_cod_string,
    case when lost_amount is null then '-' else {rupees(whole('lost_amount'))} end as lost_amount_string, case when me is null then '-' else {rupees(whole('me'))} end as monthly_earning, case when te is null then '-' else {rupees(whole('te'))} end as today_earning,
    {flag('delivery_per >= 0.8')} as delivery_flag, {flag('prepaid_fasr_per > 0.9 and cod_fasr_per > 0.7')} as fasr_flag, {flag('past_fd_pendency = 0 and past_cod = 0')} as pendency_flag, {flag('coalesce(lost_amount, 0) < 1000')} as lost_flag,
    {flag('today_fake / nullif(assigned, 0)::double < 0.001 and mtd_fake <= 10')} as fake_flag, delivery_flag + fasr_flag + pendency_flag + lost_flag + fake_flag as final_rating from j)
  select *, {', '.join(f'{flag(f"final_rating = {i}")} as star_score_{i}' for i in range(6))}, case final_rating when 0 then 'Improvement required, focus on all areas.' when 1 then 'Below expectations, work on improvement.'
    when 2 then 'Improvement needed, aim for better.' when 3 then 'Average performance, keep improving.' when 4 then 'Great job, 1 more star to go!' else 'Outstanding performance, top-notch work!!' end as star_remark from f"""


def report_tasks(spark, sf):
    views(spark, sf, "task", "crew")
    rows = run(spark, REPORT_TASK)
    rows.createOrReplaceTempView("rt")
    return rows


@query("p_17_rider_report", sql("task crew", RIDER_REPORT))
def rider_report(spark, sf):
    tasks = report_tasks(spark, sf)
    return reports.rider_report(tasks, run(spark, REPORT_PIP), run(spark, REPORT_CASH), run(spark, REPORT_LOSS), run(spark, REPORT_PAY), bind(spark, sf, "crew"), REPORT_DAY)


def share(num, den):
    return f"round_even({num} / nullif({den}, 0)::double * 100, 0)"


@query("p_18_team_report", sql("task crew", f"""
    with rt as ({REPORT_TASK}), k as (select *, date_trunc('day', dispatch_time)::timestamp as d, rank() over (partition by awb order by dispatch_time) as rk from rt where dispatch_time > {DAY} - interval 30 day),
      n as (select city as shipping_city, hub, rider_id, rider_name, {counted(TODAY)} as load, {counted(f'{TODAY} and {DONE}')} as a, {counted(f'{TODAY} and {FRESH}')} as b, {counted(f'{TODAY} and {FRESH} and {DONE}')} as c,
        {counted(f'{TODAY} and {FRESH} and cod_amount = 0')} as p, {counted(f'{TODAY} and {FRESH} and {DONE} and cod_amount = 0')} as q, {counted(f'{TODAY} and {FRESH} and cod_amount <> 0')} as r, {counted(f'{TODAY} and {FRESH} and {DONE} and cod_amount <> 0')} as s,
        {counted(f"{OLD} and status = 'CANCELLED' and not is_realized")} as failed_collection_pendency, {cents(f"case when {OLD} and {DONE} and not is_collected then cod_amount else 0 end")} as owed, {counted('is_fake_attempt')} as fake from k group by 1, 2, 3, 4 having load <> 0)
    select shipping_city, hub, rider_id, rider_name, load, {share('a', 'load')} as delivery_per, {share('c', 'b')} as fasr, {share('q', 'p')} as prepaid_fasr, {share('s', 'r')} as cod_fasr, failed_collection_pendency, round_even(owed, 0) as cod_collection_pendency,
      nullif(fake, 0) as mtd_fake, case when pip_result = 'failed' then 'failing' when pip_result is not null then 'passing' end as pip_result from n left join ({REPORT_PIP}) x using (rider_id)"""))
def team_report(spark, sf):
    return reports.team_report(report_tasks(spark, sf), run(spark, REPORT_PIP), REPORT_DAY)


# ---------------------------------------------------------------- P-19, P-22 to P-25
@query("p_19_block_list", sql("task crew", f"""
    with c as ({COHORT_DUCK}) select c.rider_id, c.rider_name, c.hub, c.shipping_city as city, node_id as node_node_id from c left join (select rider_id, node_id from crew) r using (rider_id) where pip_status = 'closed' and pip_result = 'failed'"""))
def block_list(spark, sf):
    rows = cohort_rows(spark, sf)
    return cohort.block_list(rows, bind(spark, sf, "crew"))


@query("p_19_program_results", sql("task crew", f"""
    with c as ({COHORT_DUCK}), r as (select key, case when attempts > 2 then 'passed' else 'failed' end as res from (select key, cast(split_part(need_improvement, ' ', 2) as int) as attempts from c where pip_status = 'closed') x)
    select c.* replace (coalesce(res, pip_result) as pip_result) from c left join r using (key)"""))
def program_results(spark, sf):
    rows = cohort_rows(spark, sf)
    attempts = F.split_part("need_improvement", F.lit(" "), F.lit(2)).cast("int")
    results = rows.filter("pip_status = 'closed'").select("key", F.when(attempts > 2, "passed").otherwise("failed").alias("pip_result"))
    return cohort.record_results(rows, results)


@query("p_19_failed_rate", sql("task crew", f"""
    with c as ({COHORT_DUCK}) select shipping_city, hub, count(*) as total_count, count(*) filter (pip_result = 'failed') as failed_count, cast(count(*) filter (pip_result = 'failed') * 100 // count(*) as int) as failed_rate from c group by 1, 2"""))
def failed_rate(spark, sf):
    from haulmark.operators.aggregate import share_by
    return share_by(cohort_rows(spark, sf), ["shipping_city", "hub"], F.col("pip_result") == "failed")


WEIGHED = """select s.city as shipping_city, t.dispatch_time, t.task_id, t.rider_id, t.status, greatest(s.shipment_chargeable_weight, d.vol / 5000.0, d.wt) as chargeable_weight from task t join shipment s on s.awb = t.awb
  left join (select awb, max(length * breadth * height) as vol, max(weight) as wt from weight group by awb) d on d.awb = t.awb"""
DUE_PARCELS = "select awb, city as shipping_city, edd from ops where shipping_partner = 'Hyperlocal'"


@query("p_22_slot_productivity", sql("ops weight", f"""
    with w as ({WEIGHED}), g as (select shipping_city, date_trunc('day', dispatch_time)::timestamp as d, case when hour(dispatch_time) >= 12 then 'A' else 'M' end as slot, count(task_id) as att, count(task_id) filter (status = 'COMPLETED') as del,
        count(distinct rider_id) as md, cast(floor({cents('chargeable_weight')}) as bigint) as wl from w group by 1, 2, 3),
      m as (select shipping_city, date_trunc('month', d)::timestamp as dispatch_month, sum(wl) / nullif(sum(att), 0)::double as avg_weight, sum(att) filter (slot = 'M') / nullif(sum(md) filter (slot = 'M'), 0)::double as mn_att_prod,
        sum(del) filter (slot = 'M') / nullif(sum(md) filter (slot = 'M'), 0)::double as mn_del_prod, sum(att) filter (slot = 'A') / nullif(sum(md) filter (slot = 'A'), 0)::double as af_att_prod,
        sum(del) filter (slot = 'A') / nullif(sum(md) filter (slot = 'A'), 0)::double as af_del_prod from g group by 1, 2),
      i as (select shipping_city, date_trunc('month', edd)::timestamp as dispatch_month, sum(drr) / count(drr)::double as drr from (select shipping_city, edd, count(awb) as drr from ({DUE_PARCELS}) p group by 1, 2) q group by 1, 2)
    select i.*, avg_weight, mn_att_prod, mn_del_prod, af_att_prod, af_del_prod from i left join m using (shipping_city, dispatch_month)"""))
def slot_productivity(spark, sf):
    views(spark, sf, "task", "shipment", "weight", "ops")
    return reports.slot_productivity_report(run(spark, WEIGHED), run(spark, DUE_PARCELS))


@query("p_23_ageing_rows", sql("ops", f"""
    select awb, user_name, shipment_status, pickuptime, cast({NOW}::date - pickuptime::date as int) as age_interval, last_mile_hub from ops where pickuptime < timestamp '2001-05-02'
      and shipment_status not in ('Cancelled', 'Lost', 'Delivered', 'RTO Delivered', 'Damaged') and (delivertime >= {NOW} or delivertime is null) and (rto_delivered_time >= {NOW} or rto_delivered_time is null)"""))
def ageing_rows(spark, sf):
    return service.ageing(bind(spark, sf, "ops"), AS_OF_TASK, "2001-05-01").select("awb", "user_name", "shipment_status", "pickuptime", "age_interval", "last_mile_hub")


RANKED = "ranked as (select t.*, s.shipping_city, s.sort_code, s.shipper_id, rank() over (partition by t.awb order by dispatch_time) as attempt_number from task t left join shipment s on t.awb = s.awb)"


@query("p_24_cluster_last_week", sql("ops", f"""
    with {RANKED}, a as (select shipping_city, substring(sort_code, 14) as cluster_code, count(distinct awb) filter (date_trunc('day', delivertime) <= edd) * 100.0 / nullif(count(distinct awb), 0)::double as otd,
        count(distinct awb) filter (date_trunc('day', first_ofd_time) <= edd) * 100.0 / nullif(count(distinct awb), 0)::double as ofd from ops where shipper_id = 301 and edd >= timestamp '1995-01-09' and edd < timestamp '1995-01-16' group by 1, 2),
      b as (select shipping_city, substring(sort_code, 14) as cluster_code, count(*) filter (attempt_number = 1 and status = 'COMPLETED') * 100.0 / nullif(count(*) filter (attempt_number = 1), 0)::double as fasr from ranked
        where shipper_id = 301 and dispatch_time >= timestamp '1995-01-09' and dispatch_time < timestamp '1995-01-16' group by 1, 2)
    select a.*, fasr from a left join b using (shipping_city, cluster_code)"""))
def cluster_last_week(spark, sf):
    ops = bind(spark, sf, "ops").filter("shipper_id = 301").withColumn("cluster_code", text.substring("sort_code", 14))
    tried = ranked_tasks(spark, sf, "sort_code", "shipper_id").filter("shipper_id = 301").withColumn("cluster_code", text.substring("sort_code", 14))
    week = clock.plus(clock.moment("1995-01-18"), days=-7)
    return service.cluster_kpis(ops, tried, ["shipping_city", "cluster_code"], clock.in_week("edd", week), clock.in_week("dispatch_time", week))


@query("p_25_message_list", sql("task crew", f"""
    with c as ({COHORT_DUCK}) select c.rider_id, c.rider_name, need_improvement, shipping_city, phone, case when shipping_city in ('Jaipur', 'Delhi', 'Mumbai') then 'rider_pip_start_hindi' else 'rider_pip_start_english' end as event
    from c left join (select rider_id, phone from crew) r using (rider_id)"""))
def message_list(spark, sf):
    return cohort.message_list(cohort_rows(spark, sf), bind(spark, sf, "crew"))

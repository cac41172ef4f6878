"""Pay, cash, loss, margin and profit queries (O-10.26 to O-10.42)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bindings import bind, cents, run, sql
from catalog.registry import AS_OF_TASK, query
from haulmark import rules
from haulmark.functions import clock
from haulmark.functions.numbers import exact_sum, ratio
from haulmark.operators import cash, margin, payout, report
from haulmark.plans import pay
from haulmark.session import cut_lineage
from haulmark.sources.readers import inline_table

# ---------------------------------------------------------------- payout input
INPUT = """att as (select t.task_id, t.awb, t.status, t.rider_id, t.dispatch_time, t.cod_amount, t.tour_id, t.cancellation_remarks, c.hub, c.city, c.payout_structure,
    rank() over (partition by t.awb order by dispatch_time) as attempt_number from task t join crew c using (rider_id) where {where}),
  dims as (select awb, max(length * breadth * height) as vol, max(weight) as wt from weight group by 1),
  x as (select att.*, s.user_id, s.warehouse_city, s.pincode, greatest(s.shipment_chargeable_weight, vol / 5000.0, wt) as chargeable_weight, delivered_rate,
      case when hour(dispatch_time) >= 15 then 'evening' else 'morning' end as slot, case when attempt_number = 1 then 'Fresh' else 'Reattempt' end as order_type
    from att left join shipment s on s.awb = att.awb left join dims d on d.awb = att.awb left join rate r on r.pincode = s.pincode)"""
OWN = INPUT.format(where="lower(c.hub) not like '%franchise%'")
FRANCHISE = INPUT.format(where="lower(c.hub) like '%franchise%'")
NEEDS = "task shipment weight crew rate"


def pay_rows(spark, sf, franchise=False):
    info = bind(spark, sf, "crew").select("rider_id", "hub", "city", "payout_structure")
    attempts = bind(spark, sf, "task").select("task_id", "awb", "status", "rider_id", "dispatch_time", "cod_amount", "tour_id", "cancellation_remarks")
    weights = bind(spark, sf, "weight").withColumnRenamed("awb", "shipment_awb")
    return pay.pay_input(attempts, bind(spark, sf, "shipment"), weights, info, bind(spark, sf, "rate"), franchise=franchise)


# Pay per order by city, by city and weight above so many grams, and by franchise hub.
APRIL_BASE = "('Mumbai', 26), ('Delhi', 20), ('Bangalore', 27), ('Hyderabad', 30)"
APRIL_WEIGHT = "('Delhi', 4000, 30), ('Mumbai', 3000, 30), ('Mumbai', 5000, 60)"
LEGACY_BASE = "('Mumbai', 30), ('Delhi', 20), ('Bangalore', 22)"
LEGACY_SPECIAL = "('Mumbai', 20), ('Delhi', 25), ('Bangalore', 22)"
LEGACY_WEIGHT = "('Bangalore', 350, 8), ('Delhi', 4000, 25), ('Mumbai', 3000, 30), ('Mumbai', 5000, 60)"
LEGACY_EVENING = "('Delhi', 10), ('Mumbai', 15)"
FRANCHISE_BASE = "('Bangalore', null, 38), ('Bangalore', 'BLDR-Franchise', 35), ('Delhi', null, 33), ('Hyderabad', null, 38), ('Mumbai', 'GRGN-Franchise', 40)"
FRANCHISE_WEIGHT = "('Bangalore', null, 40, 3000), ('Bangalore', 'BLDR-Franchise', 45, 3000), ('Delhi', null, 30, 4000), ('Hyderabad', null, 40, 3000), ('Mumbai', null, 40, 3000)"


def by_city(rates: str) -> str:
    return f"coalesce((select max(amount) from (values {rates}) r(place, amount) where place = city), 0)"


def by_weight(rates: str) -> str:
    """The highest band that the weight is above."""
    return f"coalesce((select max_by(amount, above) from (values {rates}) r(place, above, amount) where place = city and chargeable_weight > above), 0)"


def by_hub(rates: str, weight: bool = False) -> str:
    """The rate of the hub itself comes before that of its city."""
    columns, more = ("place, own, amount, above", " and chargeable_weight > above") if weight else ("place, own, amount", "")
    return (f"coalesce((select max_by(amount, case when own is null then 0 else 1 end) from (values {rates}) r({columns}) "
            f"where place = city and (own is null or own = hub){more}), 0)")


def order_pay_sql(**parts: tuple[str, str]) -> str:
    """Rows with one pay column per part: its amount where its condition holds, for riders paid by order."""
    columns = ", ".join(f"(case when payout_structure = 'ORDER' and {cond} then {amount} else 0 end)::double as {name}" for name, (cond, amount) in parts.items())
    return f"p as (select *, 0.0::double as org_id_pay, {columns} from x)"


PAID, LATE = "status = 'COMPLETED'", "status = 'COMPLETED' and hour(dispatch_time) >= 15"
APRIL = order_pay_sql(
    delivery_incentive=(PAID, f"{by_city(APRIL_BASE)} + case city when 'Delhi' then delivered_rate else 0 end"),
    weight_incentive=(PAID, by_weight(APRIL_WEIGHT)), failed_delivery_incentive=("false", "0"),
    evening_order_incentive=(LATE, by_city("('Delhi', 5)")))
LEGACY = order_pay_sql(
    delivery_incentive=(PAID, f"case when user_id in (2, 34) then {by_city(LEGACY_SPECIAL)} else {by_city(LEGACY_BASE)} + case when city in ('Delhi', 'Mumbai') then delivered_rate else 0 end end"),
    weight_incentive=(PAID, by_weight(LEGACY_WEIGHT)),
    failed_delivery_incentive=("status = 'CANCELLED' and lower(cancellation_remarks) not like '%operational constraint%'", by_city("('Mumbai', 10)")),
    evening_order_incentive=(LATE, by_city(LEGACY_EVENING)))
FRANCHISE_DELIVERY, FRANCHISE_HEAVY = by_hub(FRANCHISE_BASE), by_hub(FRANCHISE_WEIGHT, weight=True)
ORDER_OUT = "task_id, city, hub, org_id_pay, delivery_incentive, weight_incentive, failed_delivery_incentive, evening_order_incentive"

SLABS_APRIL = """case city when 'Mumbai' then case when {d} <= 3 then {d} * 45 else 642 end
  when 'Delhi' then case when {d} <= 5 then {d} * 50 when {d} <= 20 then 640 when {d} <= 30 then 640 + ({d} - 20) * 10 when {d} <= 40 then 740 + ({d} - 30) * 15
    when {d} <= 50 then 890 + ({d} - 40) * 20 else 1090 end
  when 'Bangalore' then case when {d} <= 5 then {d} * 35 when {d} <= 20 then 690 when {d} <= 30 then 690 + ({d} - 20) * 5 when {d} <= 40 then 740 + ({d} - 30) * 10
    when {d} <= 50 then 840 + ({d} - 40) * 15 else 990 + ({d} - 50) * 20 end
  when 'Hyderabad' then case when {d} <= 3 then {d} * 45 when {d} <= 15 then 750 else 750 + ({d} - 15) * 15 end
  when 'Jaipur' then case when {d} <= 2 then {d} * 30 when {d} <= 20 then 540 when {d} <= 30 then 540 + ({d} - 20) * 10 when {d} <= 40 then 640 + ({d} - 30) * 15
    when {d} <= 50 then 790 + ({d} - 40) * 20 else 990 end else 0 end::double"""
SLABS_LEGACY = """case city when 'Mumbai' then case when {d} <= 3 then {d} * 45 else 769 end when 'Delhi' then case when {d} <= 1 then {d} * 30 else 692 end
  when 'Bangalore' then case when {d} <= 3 then {d} * 35 when {d} <= 20 then 690 when {d} <= 30 then 690 + ({d} - 20) * 10 when {d} <= 40 then 790 + ({d} - 30) * 15
    when {d} <= 50 then 940 + ({d} - 40) * 20 else 1140 + ({d} - 50) * 25 end
  when 'Hyderabad' then case when {d} < 1 then 0 when {d} <= 15 then 750 else 750 + ({d} - 15) * 15 end else 0 end::double"""


# Deliveries per rider and week: large enough to reach every slab.
WEEKLY = """select rider_id, city, date_trunc('month', dispatch_time)::timestamp as m, count(*) filter (status = 'COMPLETED') as delivered from task join crew using (rider_id) group by 1, 2, 3"""


@query("o_10_26_slab_pay", sql("task crew", f"""
    select rider_id, city, m, delivered, {SLABS_APRIL.format(d='(delivered * 9)')} as april, {SLABS_LEGACY.format(d='(delivered * 9)')} as legacy from ({WEEKLY}) w"""))
def slab_pay(spark, sf):
    rows = bind(spark, sf, "task").join(bind(spark, sf, "crew").select("rider_id", "city"), "rider_id").groupBy(
        "rider_id", "city", clock.month("dispatch_time").alias("m")).agg(F.count_if(F.col("status") == "COMPLETED").alias("delivered"))
    d = F.col("delivered") * 9
    return rows.withColumns({c: payout.slab_pay(d, F.col("city"), rules.SLABS[c]) for c in ("april", "legacy")})


@query("o_10_27_order_pay_april", sql(NEEDS, f"with {OWN}, {APRIL} select {ORDER_OUT} from p"))
def order_pay_april(spark, sf):
    return payout.order_pay(pay_rows(spark, sf), rules.ORDER_CARDS["april"]).select(*ORDER_OUT.split(", "))


@query("o_10_27_order_pay_legacy", sql(NEEDS, f"with {OWN}, {LEGACY} select {ORDER_OUT} from p"))
def order_pay_legacy(spark, sf):
    import dataclasses
    card = dataclasses.replace(rules.ORDER_CARDS["legacy"], special_clients=(2, 34))
    return payout.order_pay(pay_rows(spark, sf), card).select(*ORDER_OUT.split(", "))


@query("o_10_27_order_pay_franchise", sql(NEEDS, f"""
    with {FRANCHISE} select task_id, city, hub, (case when {PAID} then {FRANCHISE_DELIVERY} else 0 end)::double as delivery_incentive,
      (case when {PAID} then {FRANCHISE_HEAVY} else 0 end)::double as weight_incentive from x"""))
def order_pay_franchise(spark, sf):
    return payout.franchise_order_pay(pay_rows(spark, sf, True)).select("task_id", "city", "hub", "delivery_incentive", "weight_incentive")


GUARANTEE = {
    "april": """case when city = 'Delhi' and delivered >= 10 then 500 when city = 'Mumbai' and hub = 'DS BOM KDWL' and delivered >= 15 then 750
      when city = 'Mumbai' and delivered >= 5 then 600 when city = 'Hyderabad' and delivered >= 3 then 600 when city = 'Bangalore' and evening_delivered >= 15 then 500 else 0 end""",
    "zone": """case when city = 'Delhi' and delivered >= 10 then 500 when city = 'Mumbai' and delivered >= 5 then case when hub = 'DS BOM KDWL' then 750 else 600 end
      when city = 'Hyderabad' and delivered >= 3 then 600 when city = 'Bangalore' and evening_delivered >= 5 then 500 else 0 end""",
}


def days_sql(card: str, date="date_trunc('day', dispatch_time)::timestamp") -> str:
    slabs = SLABS_APRIL.format(d="delivered")
    return f"""d0 as (select {date} as dispatch_date, city, hub, rider_id, payout_structure,
        count(distinct task_id) filter (status = 'COMPLETED') as delivered, count(distinct task_id) filter (status = 'COMPLETED' and slot = 'morning') as morning_delivered,
        count(distinct task_id) filter (status = 'COMPLETED' and slot = 'evening') as evening_delivered, count(distinct task_id) filter (status = 'COMPLETED' and order_type = 'Fresh') as fresh_delivered,
        count(distinct task_id) filter (order_type = 'Fresh') as fresh_attempted, count(distinct task_id) as attempted, {cents('org_id_pay')} as org_id_pay,
        {cents('delivery_incentive')} as delivery_pay, {cents('weight_incentive')} as heavy_pay, {cents('failed_delivery_incentive')} as vfd_pay,
        {cents('evening_order_incentive')} as evening_pay from p group by 1, 2, 3, 4, 5),
      d1 as (select *, org_id_pay + delivery_pay + heavy_pay + vfd_pay + evening_pay as order_earning,
        case when payout_structure = 'ORDER' then {GUARANTEE[card]} else 0 end::double as order_mg,
        case when payout_structure = 'FIXED' then {slabs} else 0 end as fixed_pay, fresh_delivered / nullif(fresh_attempted, 0)::double as fasr from d0),
      d as (select *, case when order_earning < order_mg then order_mg - order_earning else 0 end as mg_payed, order_earning + mg_payed + fixed_pay as total_pay from d1)"""


# The test attempts are spread over seven years; moving every week onto its Monday gives full rider days.
MONTH_HOUR = "date_trunc('month', dispatch_time)::timestamp + hour(dispatch_time) * interval 1 hour"


def dense(text: str) -> str:
    """Checking SQL with attempts moved to the first day of their month."""
    return text.replace("t.dispatch_time, t.cod_amount", f"{MONTH_HOUR.replace('dispatch_time', 't.dispatch_time')} as dispatch_time, t.cod_amount").replace(
        "order by dispatch_time) as attempt_number", f"order by {MONTH_HOUR.replace('dispatch_time', 't.dispatch_time')}) as attempt_number")


def dense_rows(spark, sf, franchise=False):
    info = bind(spark, sf, "crew").select("rider_id", "hub", "city", "payout_structure")
    attempts = bind(spark, sf, "task").select("task_id", "awb", "status", "rider_id", "dispatch_time", "cod_amount", "tour_id", "cancellation_remarks").withColumn(
        "dispatch_time", clock.month("dispatch_time") + F.make_dt_interval(F.lit(0), F.hour("dispatch_time")))
    weights = bind(spark, sf, "weight").withColumnRenamed("awb", "shipment_awb")
    return pay.pay_input(attempts, bind(spark, sf, "shipment"), weights, info, bind(spark, sf, "rate"), franchise=franchise)


def april_days(spark, sf):
    return payout.rider_day(payout.order_pay(dense_rows(spark, sf), rules.ORDER_CARDS["april"]), "april")


DAY_OUT = """dispatch_date, city, hub, rider_id, payout_structure, delivered, morning_delivered, evening_delivered, fresh_delivered, fresh_attempted, attempted, org_id_pay, delivery_pay,
  heavy_pay, vfd_pay, evening_pay, order_earning, order_mg, mg_payed, fixed_pay, fasr, total_pay"""


@query("o_10_28_minimum_guarantee", sql(NEEDS, f"with {dense(OWN)}, {APRIL}, {days_sql('april')} select {DAY_OUT} from d"))
def minimum_guarantee(spark, sf):
    return april_days(spark, sf).select(*[c.strip() for c in DAY_OUT.split(",")])


@query("o_10_28_guarantee_correction", sql(NEEDS, f"""
    with {dense(OWN)}, {APRIL}, {days_sql('zone')}, t as (select *, case when fasr > 0.9 then 2 * delivered when fasr > 0.85 then delivered else 0 end::double as fasr_pay from d),
      g as (select *, delivery_pay + heavy_pay + evening_pay + fasr_pay + mg_payed as sub, case hub when 'DS BOM KDWL' then 750 when 'DS BOM SWRI' then 600 end as goal from t)
    select rider_id as num_rider_id, dispatch_date, hub as node_name, delivered, case when city = 'Mumbai' and delivered >= 5 and dispatch_date <= timestamp '2000-06-16' and sub <= goal
      then mg_payed + goal - sub else mg_payed end as mg_payed from g"""))
def guarantee_correction(spark, sf):
    table = payout.payout_table(payout.rider_day(payout.order_pay(dense_rows(spark, sf), rules.ORDER_CARDS["zone"]), "zone"))
    return payout.corrected_guarantee(table, "2000-06-16").select("num_rider_id", "dispatch_date", "node_name", "delivered", "mg_payed")


@query("o_10_29_fasr_bonus", sql("task", """
    with r as (select rider_id, date_trunc('month', dispatch_time)::timestamp as m, count(*) filter (status = 'COMPLETED') as delivered, count(*) filter (status <> 'CANCELLED') as tried from task group by 1, 2)
    select *, delivered / nullif(tried, 0)::double as fasr, case when fasr > 0.9 then 2 * delivered when fasr > 0.85 then delivered else 0 end::double as bonus from r"""))
def fasr_bonus(spark, sf):
    rows = bind(spark, sf, "task").groupBy("rider_id", clock.month("dispatch_time").alias("m")).agg(
        F.count_if(F.col("status") == "COMPLETED").alias("delivered"), F.count_if(F.col("status") != "CANCELLED").alias("tried"))
    return rows.withColumn("fasr", ratio("delivered", "tried")).withColumn("bonus", payout.fasr_bonus(F.col("fasr"), F.col("delivered")))


# Rider days counted per quarter so that full attendance occurs: the day of the month carries on.
ATTEND = """select city, rider_id % 5 as rider_id, date_trunc('day', dispatch_time)::timestamp as dispatch_date, count(*) filter (status = 'COMPLETED') + 3 as delivered
  from task join crew using (rider_id) group by 1, 2, 3"""


def attend(spark, sf):
    rows = bind(spark, sf, "task").select("rider_id", "dispatch_time", "status").join(bind(spark, sf, "crew").select("rider_id", "city"), "rider_id")
    return rows.withColumn("rider_id", F.col("rider_id") % 5).groupBy("city", "rider_id", clock.day("dispatch_time").alias("dispatch_date")).agg(
        (F.count_if(F.col("status") == "COMPLETED") + 3).alias("delivered"))


@query("o_10_30_attendance_bonus", sql("task crew", f"""
    select city, rider_id, q as quarter, count(distinct dispatch_date) filter (delivered >= 3) as attendance,
      case when count(distinct dispatch_date) filter (delivered > 3) >= case when city in ('Mumbai', 'Bangalore') then 28 else 26 end then 1000 else 0 end::double as attendance_incentive
    from (select *, date_trunc('year', dispatch_date)::timestamp as q from ({ATTEND}) a) b group by 1, 2, 3"""))
def attendance_bonus(spark, sf):
    days = attend(spark, sf).withColumn("quarter", F.date_trunc("year", "dispatch_date").cast("timestamp_ntz"))
    return payout.attendance_bonus(days, ["city", "rider_id", "quarter"])


def unbroken_sql(month: str) -> str:
    last = {"longer-consecutive-attendance": {"Mumbai": (8, 19), "Bangalore": (6, 19), "Hyderabad": (7, 19)},
            "shorter-consecutive-attendance": {"Mumbai": (8, 16), "Bangalore": (10, 16), "Hyderabad": (10, 16)}}
    parts = []
    for name, spans in last.items():
        inside = " or ".join(f"(city = '{c}' and day(g) between {a} and {b})" for c, (a, b) in spans.items())
        parts.append(f"""select distinct city, rider_id, 1000 as amount, '{name}' as type from d where city <> 'Delhi' and rider_id not in (
          select rider_id from (select distinct d.city, d.rider_id, g from d, (select unnest(generate_series(timestamp '{month}', timestamp '{month}' + interval 1 month - interval 1 day, interval 1 day)) as g) c) x
          where ({inside}) and not exists (select 1 from d y where y.city = x.city and y.rider_id = x.rider_id and y.dispatch_date = x.g))""")
    return f"d as (select * from ({ATTEND.replace('rider_id % 5', 'rider_id % 3')}) a where dispatch_date >= timestamp '{month}' and dispatch_date < timestamp '{month}' + interval 1 month) " + " union all ".join(parts)


# Attendance is dense when all years fall into one month, day by day.
FOLDED = """select city, rider_id % 11 as rider_id, timestamp '2001-03-01 00:00:00' + (day(dispatch_time) - 1) * interval '1' day as dispatch_date, count(*) as delivered
  from task join crew using (rider_id) group by all"""


@query("o_10_31_unbroken_attendance", sql("task crew", "with " + unbroken_sql("2001-03-01").replace(ATTEND.replace("rider_id % 5", "rider_id % 3"), FOLDED)))
def unbroken_attendance(spark, sf):
    return payout.unbroken_attendance(folded(spark, sf), "2001-03-01")


def folded(spark, sf):
    rows = bind(spark, sf, "task").select("rider_id", "dispatch_time").join(bind(spark, sf, "crew").select("rider_id", "city"), "rider_id")
    at = clock.moment("2001-03-01") + F.make_dt_interval(F.dayofmonth("dispatch_time") - 1)
    return rows.groupBy("city", (F.col("rider_id") % 11).alias("rider_id"), at.alias("dispatch_date")).agg(F.count(F.lit(1)).alias("delivered"))


@query("o_10_31_leave_calendar", sql("task crew", f"""
    with d as ({FOLDED}) select g.city, g.rider_id, cast(g.t as date) as dates, delivered from (select distinct city, rider_id, t from d, (select unnest(generate_series(timestamp '2001-03-01', timestamp '2001-03-31', interval 1 day)) as t) c) g
    left join d on d.city = g.city and d.rider_id = g.rider_id and d.dispatch_date = g.t"""))
def leave_calendar(spark, sf):
    return payout.leave_calendar(folded(spark, sf), "2001-03-01")


ALLOCATED = """select task_id, awb, p.rider_id, date_trunc('day', dispatch_time)::timestamp as dispatch_date, p.org_id_pay + delivery_incentive + weight_incentive + failed_delivery_incentive + evening_order_incentive
    + 0.0 + coalesce(mg_payed / nullif(delivered, 0)::double, 0) + coalesce(fixed_pay / nullif(delivered, 0)::double, 0) as awb_pay
  from p left join d on d.rider_id = p.rider_id and d.dispatch_date = date_trunc('day', p.dispatch_time) and d.city = p.city and d.hub = p.hub and d.payout_structure = p.payout_structure where status = 'COMPLETED'"""


@query("o_10_32_allocate_to_orders", sql(NEEDS, f"with {dense(OWN)}, {APRIL}, {days_sql('april')} {ALLOCATED}"))
def allocate(spark, sf):
    costs = pay.own_payout(dense_rows(spark, sf), keep=cut_lineage)["costs"]
    return costs.select("task_id", "awb", "rider_id", "dispatch_date", "awb_pay")


# Tours of the test attempts: facts per tour and its rider.
TOURS = """select tour_id, min(rider_id) as rider_id, cast(min(dispatch_time) as date) as tour_date, count(*) as total_tasks, sum(case when status = 'COMPLETED' then 1 else 0 end) as completed_tasks,
  cast(count(*) as double) * 7.5 as fuel_payout, cast(tour_id % 37 as double) + 0.5 as covered_distance from (select *, o_orderkey % 4000 as tour_id from
  (select o_orderkey, o_orderkey % 97 as rider_id, o_orderdate as dispatch_time, case o_orderstatus when 'F' then 'COMPLETED' when 'O' then 'CANCELLED' else 'ONGOING' end as status from orders) o) t group by tour_id"""


@query("o_10_33_fuel_eligibility", sql("crew", f"""
    with b as (select hub as node_name, node_type, tour_date, t.rider_id, rider_name, fuel_payout_automation, {cents('fuel_payout')} as fuel_payout, cast(sum(total_tasks) as bigint) as assigned_orders,
        cast(sum(completed_tasks) as bigint) as delivered_orders, {cents('covered_distance')} as covered_distance, count(tour_id) as tours
      from ({TOURS}) t left join crew c on c.rider_id = t.rider_id group by 1, 2, 3, 4, 5, 6),
      k as (select * from b where fuel_payout_automation = 'true'),
      low as (select rider_id from k group by 1 having case when sum(assigned_orders) <> 0 then sum(delivered_orders) / sum(assigned_orders)::double else 0 end < 0.33)
    select k.*, covered_distance as final_distance, fuel_payout as final_fuel_payout, case when assigned_orders <> 0 then delivered_orders / assigned_orders::double else 0 end as del_percent
    from k where rider_id not in (select rider_id from low) and node_type <> 'franchise_hub'"""))
def fuel_eligibility(spark, sf):
    bind(spark, sf, "orders")
    crew = bind(spark, sf, "crew").select("rider_id", F.col("hub").alias("node_name"), "node_type", "rider_name", "fuel_payout_automation")
    tours = run(spark, TOURS).join(crew, "rider_id", "left")
    return payout.fuel_eligibility(payout.rider_tour_days(tours), least=0.33)


# ---------------------------------------------------------------- cash and losses
TRIPS = """select task_id as trip_id, awb, awb as shipment_id, t.rider_id, rider_name, status, dispatch_time + interval '5' hour as completed_at, dispatch_time, cod_amount, hub as hub_name,
  city as shipping_city, task_id % 3 = 0 as is_collected, task_id % 5 = 0 as is_realized, dispatch_time + interval '30' hour as reconciled_at,
  concat('app__cash__hub__', cast(t.rider_id % 4 as varchar(2))) as collected_by from task t join crew c on c.rider_id = t.rider_id"""
LINES = """select shipment_id, amount, case when transaction_type = 'cod_amount' then 'cod_amount' else 'freight' end as reference_type,
  case when transaction_id % 4 = 0 then null else transaction_id end as incoming_cash_flow_id from txn"""
FLOWS = "select transaction_id as id, created_time + interval '7' hour as created_time from txn"


def ledger_sql(since: str = "1900-01-01") -> str:
    """Checking SQL: one row per trip; the lines of a shipment are summed first."""
    return f"""ledger as (
  select completed_at::date as delivery_date, rider_id, rider_name, awb, cod_amount as amount, hub_name, shipping_city, 0 as collected, 0 as deposited, null::date as collected_on, null as collected_by,
    trip_id, null::date as deposited_on from trips where status = 'COMPLETED' and not is_collected and not is_realized and cod_amount <> 0
  union select completed_at::date, rider_id, rider_name, awb, l.amount, hub_name, shipping_city, 1, l.deposited, reconciled_at::date, split_part(collected_by, '__', 4), trip_id, l.deposited_on
  from trips join (select shipment_id, {cents('amount')} as amount, bool_and(incoming_cash_flow_id is not null)::int as deposited, max(f.created_time::date) as deposited_on
      from ({LINES}) x left join (select * from ({FLOWS}) y where created_time >= timestamp '{since}') f on f.id = x.incoming_cash_flow_id where reference_type = 'cod_amount' group by 1) l using (shipment_id)
  where status = 'COMPLETED' and (is_collected or is_realized))"""


LEDGER = ledger_sql()


def ledger(spark, sf):
    for name in ("task", "crew", "txn"):
        bind(spark, sf, name).createOrReplaceTempView(name)
    return cash.cod_ledger(run(spark, TRIPS), run(spark, LINES), run(spark, FLOWS))


@query("o_10_34_cod_ledger", sql("task crew txn", f"with trips as ({TRIPS}), {LEDGER} select * from ledger"))
def cod_ledger(spark, sf):
    return ledger(spark, sf)


@query("o_10_34_cod_ledger_horizon", sql("task crew txn", f"""
    with trips as (select * from ({TRIPS}) t where dispatch_time >= timestamp '1999-06-01' and completed_at >= timestamp '1999-06-15'), {ledger_sql('1999-06-15')} select * from ledger"""))
def cod_ledger_horizon(spark, sf):
    """Trips and cash flows of the last two years."""
    for name in ("task", "crew", "txn"):
        bind(spark, sf, name).createOrReplaceTempView(name)
    return cash.cod_ledger(run(spark, TRIPS), run(spark, LINES), run(spark, FLOWS), AS_OF_TASK, months=24)


@query("o_10_34_cod_pendency", sql("task crew txn", f"""
    with trips as ({TRIPS}), {LEDGER} select rider_id, {cents("case when delivery_date = date '2000-12-31' then amount else 0 end")} as today_cod,
      {cents("case when delivery_date < date '2000-12-31' then amount else 0 end")} as past_cod from ledger where collected = 0 group by 1"""))
def cod_pendency(spark, sf):
    return cash.cod_pendency(ledger(spark, sf), "2000-12-31")


LOSSES = """select event_id as awb, case event_id % 7 when 0 then concat('Lost on Hub: ', cast(event_id % 25 as varchar(3)), '. x') when 1 then concat('Lost on Rider:', cast(event_id % 90 as varchar(3)), '.')
    when 2 then 'Lost on FM: van 3.' when 3 then 'Lost on Hub: 12' when 4 then concat('. Lost on Rider:', cast(event_id % 90 as varchar(3))) when 5 then 'Lost on Rider:seven.' else 'Lost somewhere' end as remark,
  cast(ts as date) as lost_date, value as shipment_value, event_type as shipping_city from events"""


@query("o_10_35_loss_attribution", sql("rider node", f"""
    with l as (select *, case when remark like '%Lost on Hub:%' then 'Hub' when remark like '%Lost on Rider:%' then 'Rider' when remark like '%Lost on FM:%' then 'FM' end as attribution,
        position(':' in remark) as a, position('.' in remark) as b from ({LOSSES}) x),
      k as (select *, case when a > 0 and b > 0 and attribution = 'Hub' and b - a - 2 >= 0 then try_cast(substring(remark, a + 2, b - a - 2) as bigint) end as node_key,
        case when a > 0 and b > 0 and attribution = 'Rider' and b - a - 1 >= 0 then try_cast(substring(remark, a + 1, b - a - 1) as bigint) end as rider_key from l where attribution is not null)
    select awb, remark, attribution, locus_rider_id as rider_id, node_name, lost_date, shipment_value, shipping_city from k left join rider r on r.rider_id = rider_key left join node n on n.node_id = node_key"""))
def loss_attribution(spark, sf):
    bind(spark, sf, "events")
    return cash.loss_attribution(run(spark, LOSSES), bind(spark, sf, "rider"), bind(spark, sf, "node"))


@query("o_10_35_hub_loss_total", f"""
    select cast(date_trunc('month', lost_date) as date) as lost_month, {cents('shipment_value')} as hub_loss from ({LOSSES}) x where remark like '%Lost on Hub:%' group by 1""")
def hub_loss_total(spark, sf):
    bind(spark, sf, "events")
    return cash.hub_loss_total(cash.classify_loss(run(spark, LOSSES)))


# ---------------------------------------------------------------- margins
ORDERS = """select task_id as awb, t.rider_id, case s.city when 'Jaipur' then 'NCR' else s.city end as city, s.warehouse_city, cod_amount / 4000 as awb_pay,
  case when hour(dispatch_time) >= 15 then 'evening' else 'morning' end as slot, dispatch_time - hour(dispatch_time) * interval '1' hour as dispatch_date,
  status from task t join shipment s on t.awb = s.awb where status <> 'ONGOING'"""
DONE_ORDERS = ORDERS.replace("status <> 'ONGOING'", "status = 'COMPLETED'")
REVENUE = """select task_id as awb, user_name, s.pincode as drop_pincode, s.city as shipping_city, s.warehouse_city, s.user_id, s.shipper_id,
  case status when 'COMPLETED' then 'Delivered' when 'CANCELLED' then 'RTO Delivered' else 'Lost' end as shipment_status, cast(floor(c.cents / 1000) as double) / 100 as shipment_charges,
  case when cod_amount = 0 then 'Prepaid' else 'COD' end as mop, dispatch_time as closure_date from task t join shipment s on t.awb = s.awb join charge c on c.order_id = t.task_id"""
# Cost master by lane: every lane that has shipments but those into Hyderabad, and every city with itself.
LANES = """select warehouse_city, shipping_city, case when warehouse_city = shipping_city then 'Hyperlocal' else 'Intercity' end as lane_type,
  cast(1000 + length(warehouse_city) * 37 + length(shipping_city) * 11 as double) as cost
  from (select case warehouse_city when 'NCR' then 'Delhi' else warehouse_city end as warehouse_city, city as shipping_city from shipment where city <> 'Hyderabad' group by 1, 2 union select city, city from node group by 1) x"""
TEXT = {"Delhi": ["NCR"]}


def merged(c):
    return f"case when {c} = 'NCR' then 'Delhi' else {c} end"


LANE_COST = f"""o as (select * replace ({merged('city')} as city, {merged('warehouse_city')} as warehouse_city) from ({DONE_ORDERS}) x),
  l as (select warehouse_city, city, count(awb) as orders from o group by 1, 2),
  per as (select warehouse_city, sum(orders) filter (warehouse_city = city) as so, sum(orders) filter (warehouse_city <> city) as io from l group by 1),
  own as (select warehouse_city, {cents('cost')} as mm_cost from ({LANES}) m where lane_type = 'Hyperlocal' group by 1),
  unit as (select per.warehouse_city, mm_cost / nullif(2 * coalesce(so, 0) + coalesce(io, 0), 0)::double as unit from per left join own using (warehouse_city)),
  mid as (select warehouse_city, shipping_city as city, {cents('cost')} as lane_cost from ({LANES}) m group by 1, 2),
  lc as (select l.warehouse_city, l.city, orders, case when l.warehouse_city = l.city then unit * 2 else 0 end as self_mm_fm_cpo, case when l.warehouse_city = l.city then 0 else unit end as intercity_fm_cpo,
    case when l.warehouse_city = l.city then 0 else lane_cost / nullif(orders, 0)::double end as intercity_mm_cpo from l left join unit u on u.warehouse_city = l.warehouse_city left join mid on mid.warehouse_city = l.warehouse_city and mid.city = l.city)"""


def views(spark, sf, *names):
    for name in names:
        bind(spark, sf, name).createOrReplaceTempView(name)


@query("o_10_36_lane_cost_allocation", sql("task shipment node", f"with {LANE_COST} select *, self_mm_fm_cpo + intercity_fm_cpo + intercity_mm_cpo as total_mm_cost from lc"))
def lane_cost(spark, sf):
    from haulmark.plans.margins import merge_cities
    views(spark, sf, "task", "shipment", "node")
    orders = merge_cities(run(spark, DONE_ORDERS), "city", "warehouse_city")
    return margin.lane_cost_allocation(margin.lane_orders(orders), run(spark, LANES))


SHARES = """sh as (select shipping_city, count(awb) filter (shipment_status = 'Delivered') as delivered_orders, nullif(count(awb) filter (shipment_status = 'RTO Delivered'), 0) as returned_orders from r group by 1)"""


@query("o_10_37_return_weighted_factor", sql("task shipment charge node", f"""
    with r as ({REVENUE}), {SHARES}, c as (select city as shipping_city, cast(count(*) * 123457 as double) as cost from node group by 1),
      f as (select c.*, delivered_orders, returned_orders, returned_orders / (delivered_orders + returned_orders)::double as rto_per,
        round_even(cost / nullif(delivered_orders + 2 * returned_orders, 0)::double * 100, 0) / 100 as r_factor from c left join (select * from sh where delivered_orders > 0) sh using (shipping_city))
    select r.awb, r.shipping_city, r.shipment_status, case r.shipment_status when 'RTO Delivered' then 2 * r_factor when 'Delivered' then r_factor else 0 end as fm_mm_cpo from r left join f using (shipping_city)"""))
def return_weighted(spark, sf):
    views(spark, sf, "task", "shipment", "charge")
    revenue = run(spark, REVENUE)
    costs = bind(spark, sf, "node").groupBy(F.col("city").alias("shipping_city")).agg((F.count(F.lit(1)) * 123457).cast("double").alias("cost"))
    factors = margin.return_weighted_factor(costs, margin.return_share(revenue))
    return margin.mid_mile_cpo(revenue.select("awb", "shipping_city", "shipment_status"), factors)


@query("o_10_38_cost_per_order", sql("task", f"""
    with p as (select rider_id, {cents('cod_amount')} / 1000 as total_pay from task group by 1), o as (select rider_id, count(awb) as orders from task where status = 'COMPLETED' group by 1),
      c as (select p.*, orders, total_pay / nullif(orders, 0)::double as rider_pay_cpo, concat('K', cast(rider_id as varchar)) as key from p left join o using (rider_id)),
      v as (select distinct concat('K', cast(rider_id as varchar)) as key, cast(rider_id % 7 as double) / 100 as extra_per_rs from task where rider_id % 5 <> 2)
    select c.*, coalesce(rider_pay_cpo * extra_per_rs, 0) as vendor_cpo from c left join v using (key)"""))
def cost_per_order(spark, sf):
    task = bind(spark, sf, "task")
    pays = task.groupBy("rider_id").agg((exact_sum("cod_amount") / 1000).alias("total_pay"))
    orders = task.filter("status = 'COMPLETED'").groupBy("rider_id").agg(F.count("awb").alias("orders"))
    key = F.concat(F.lit("K"), F.col("rider_id").cast("string"))
    vendors = task.filter("rider_id % 5 <> 2").select("rider_id").distinct().select(key.alias("key"), ((F.col("rider_id") % 7).cast("double") / 100).alias("extra_per_rs"))
    return margin.vendor_cpo(margin.cpo(pays, orders, "rider_id").withColumn("key", key), vendors)


MARGIN_ROWS = f"""{LANE_COST}, fuel as (select distinct rider_id, cast(rider_id % 6 as double) / 4 as fuel_cpo from task where rider_id % 5 <> 2),
  cost as (select o.*, coalesce(awb_pay, 0) + coalesce(self_mm_fm_cpo + intercity_fm_cpo + intercity_mm_cpo, 0) + coalesce(fuel_cpo, 0) + coalesce(awb_pay * 0.06, 0) as total_cost
    from o left join lc using (warehouse_city, city) left join fuel using (rider_id)),
  rev as (select * replace ({merged('shipping_city')} as shipping_city, {merged('warehouse_city')} as warehouse_city) from ({REVENUE}) x),
  m as (select rev.*, cost.rider_id, cost.slot, cost.dispatch_date, cost.total_cost, cost.awb_pay from rev left join cost on cost.awb = rev.awb)"""


def margin_rows(spark, sf):
    from haulmark.plans.margins import order_margin
    views(spark, sf, "task", "shipment", "charge", "node")
    fuel = bind(spark, sf, "task").filter("rider_id % 5 <> 2").select("rider_id").distinct().withColumn("fuel_cpo", (F.col("rider_id") % 6).cast("double") / 4)
    revenue = run(spark, REVENUE).select("awb", "user_name", "drop_pincode", "shipping_city", "warehouse_city", "shipment_status", "shipment_charges")
    return order_margin(revenue, run(spark, DONE_ORDERS), run(spark, LANES), fuel)


def margin_sql(dims: str) -> str:
    return sql("task shipment charge node", f"""
      with {MARGIN_ROWS}, g as (select {dims}, count(distinct awb) as orders, {cents('coalesce(shipment_charges, 0)')} as shipment_charges, {cents('coalesce(total_cost, 0)')} as total_cost
        from m where shipping_city is not null group by all) select *, shipment_charges - total_cost as margin from g""")


CUTS = {"client": "shipping_city, user_name", "pincode": "shipping_city, drop_pincode", "lane": "shipping_city, warehouse_city",
        "lane_client": "shipping_city, warehouse_city, user_name"}
CUT_DIMS = ["shipping_city", "user_name", "drop_pincode", "warehouse_city"]


def cuts_sql() -> str:
    parts = [f"""select '{name}' as cut, {', '.join(d if d in dims.split(', ') else f'null as {d}' for d in CUT_DIMS)}, count(distinct awb) as orders,
        {cents('coalesce(shipment_charges, 0)')} as shipment_charges, {cents('coalesce(total_cost, 0)')} as total_cost from m where shipping_city is not null group by {dims}"""
             for name, dims in CUTS.items()]
    return sql("task shipment charge node", f"with {MARGIN_ROWS}, g as ({' union all '.join(parts)}) select *, shipment_charges - total_cost as margin from g")


@query("o_10_39_margin_cuts", cuts_sql())
def margin_cuts(spark, sf):
    """The four cuts from one pass over the orders."""
    return margin.margin_cuts(margin_rows(spark, sf), {name: dims.split(", ") for name, dims in CUTS.items()}).select(
        "cut", *CUT_DIMS, "orders", "shipment_charges", "total_cost", "margin")


def _register_margins():
    for name, dims in CUTS.items():
        def by(spark, sf, dims=dims):
            return margin.margin_by(margin_rows(spark, sf), dims.split(", "))
        query(f"o_10_39_margin_by_{name}", margin_sql(dims))(by)


_register_margins()


def rider_margin_sql(by: str, cost: str = "total_cost") -> str:
    return sql("task shipment charge node", f"""
      with {MARGIN_ROWS}, k as (select shipping_city, {by}, count(awb) as orders, {cents('shipment_charges')} as shipment_charges, coalesce({cents(cost)}, 0) as total_cost from m where rider_id is not null group by all),
        c as (select shipping_city, sum(orders) as n from k group by 1), b as (select shipping_city, count(awb) as q, {cents('shipment_charges')} as s from m where rider_id is null group by 1),
        f as (select shipping_city, s / nullif(n, 0)::double as rto_rpo, q / nullif(n, 0)::double as rto_apo from c left join b using (shipping_city))
      select k.*, rto_rpo, rto_apo, orders * rto_rpo + shipment_charges as total_charges, orders * rto_apo + orders as total_orders, orders * rto_rpo + shipment_charges - total_cost as margin from k left join f using (shipping_city)""")


@query("o_10_40_gross_up_returns", rider_margin_sql("rider_id"))
def gross_up(spark, sf):
    from haulmark.plans.margins import rider_margin
    return rider_margin(margin_rows(spark, sf))


# ---------------------------------------------------------------- stars and profit
STARS = """select rider_id, date_trunc('month', dispatch_time)::timestamp as m, count(*) as assigned, count(*) filter (status = 'COMPLETED') / count(*)::double as delivery_per,
    count(*) filter (status <> 'CANCELLED' and cod_amount = 0) / nullif(count(*) filter (cod_amount = 0), 0)::double as prepaid_fasr_per,
    count(*) filter (status <> 'ONGOING' and cod_amount > 0) / nullif(count(*) filter (cod_amount > 0), 0)::double as cod_fasr_per, count(*) filter (status = 'ONGOING') as past_fd_pendency,
    cast(rider_id % 2 as double) as past_cod, case when rider_id % 3 = 0 then null else cast(rider_id % 3 * 700 as double) end as lost_amount, count(*) filter (cod_amount > 400000) as today_fake,
    count(*) filter (cod_amount > 300000) as mtd_fake from task group by 1, 2"""


@query("o_10_41_star_rating", sql("task", f"""
    with s as ({STARS}), f as (select *, (delivery_per >= 0.8)::int as delivery_flag, coalesce((prepaid_fasr_per > 0.9 and cod_fasr_per > 0.7), false)::int as fasr_flag,
        (past_fd_pendency = 0 and past_cod = 0)::int as pendency_flag, case when lost_amount >= 1000 then 0 else 1 end as lost_flag, (today_fake / nullif(assigned, 0)::double < 0.001 and mtd_fake <= 10)::int as fake_flag from s),
      t as (select *, delivery_flag + fasr_flag + pendency_flag + lost_flag + fake_flag as final_rating from f)
    select *, {', '.join(f'(final_rating = {i})::int as star_score_{i}' for i in range(6))}, case final_rating when 0 then 'Improvement required, focus on all areas.'
      when 1 then 'Below expectations, work on improvement.' when 2 then 'Improvement needed, aim for better.' when 3 then 'Average performance, keep improving.'
      when 4 then 'Great job, 1 more star to go!' else 'Outstanding performance, top-notch work!!' end as star_remark from t"""))
def star_rating(spark, sf):
    s, cod = F.col("status"), F.col("cod_amount")
    rows = bind(spark, sf, "task").groupBy("rider_id", clock.month("dispatch_time").alias("m")).agg(
        F.count(F.lit(1)).alias("assigned"), ratio(F.count_if(s == "COMPLETED"), F.count(F.lit(1))).alias("delivery_per"),
        ratio(F.count_if((s != "CANCELLED") & (cod == 0)), F.count_if(cod == 0)).alias("prepaid_fasr_per"),
        ratio(F.count_if((s != "ONGOING") & (cod > 0)), F.count_if(cod > 0)).alias("cod_fasr_per"), F.count_if(s == "ONGOING").alias("past_fd_pendency"),
        F.count_if(cod > 400000).alias("today_fake"), F.count_if(cod > 300000).alias("mtd_fake"))
    rows = rows.withColumns({"past_cod": (F.col("rider_id") % 2).cast("double"),
                             "lost_amount": F.when(F.col("rider_id") % 3 != 0, (F.col("rider_id") % 3 * 700).cast("double"))})
    return report.star_rating(rows)


# Profit of the month to date: all years folded onto June 2001, so the month is full.
CLOSED = f"""select awb, shipping_city, case when shipper_id = 301 then 'Hyperlocal' else 'other' end as shipping_partner, shipment_status, shipment_charges as final_total_charges,
  timestamp '2001-06-01 00:00:00' + (day(closure_date) - 1) * interval '1' day + hour(closure_date) * interval '1' hour as closure_date from ({REVENUE}) r"""
PAID = """select t.rider_id, timestamp '2001-06-01 00:00:00' + (day(dispatch_time) - 1) * interval '1' day as trip_date, cod_amount / 900 as amount from task t where status = 'COMPLETED'"""
FUELLED = """select t.rider_id, timestamp '2001-06-01 00:00:00' + (day(dispatch_time) - 1) * interval '1' day as tour_date, cast(tour_id % 30 as double) as fuel_payout from task t"""
MID_MILE = "select distinct city, cast(length(city) * 30000 as double) as month_cost from node"


@query("o_10_42_pnl_daily", sql("task shipment charge crew", f"""
    with r as (select shipping_city as city, {cents(f"case when closure_date >= {'timestamp ' + chr(39) + '2001-06-14' + chr(39)} then final_total_charges else 0 end")} as revenue_drr,
        count(distinct case when closure_date >= timestamp '2001-06-14' then awb end) as order_drr, {cents('final_total_charges')} as mtd_revenue, count(awb) as mtd_orders from ({CLOSED}) c
      where closure_date >= timestamp '2001-06-01' and closure_date < timestamp '2001-06-15' and shipping_partner = 'Hyperlocal' and shipment_status = 'Delivered' and shipping_city is not null group by 1),
      a as (select rider_id, trip_date, {cents('amount')} as pay_amount from ({PAID}) p group by 1, 2), f as (select rider_id, tour_date as trip_date, {cents('fuel_payout')} as fuel_payout from ({FUELLED}) p group by 1, 2),
      v as (select a.*, fuel_payout, city, pay_amount * vendor_charge_percent * 0.01 + fuel_payout * vendor_charge_fuel_percent * 0.01 as charge from a left join f using (rider_id, trip_date)
        left join (select crew.*, vendor_charge_percent, vendor_charge_fuel_percent from crew join rider using (rider_id)) c using (rider_id)),
      g as (select city, trip_date, {cents('pay_amount')} + {cents('fuel_payout')} + {cents('charge')} as part from v group by 1, 2),
      t as (select city, trip_date, part + month_cost / 30 as total_cost from g left join ({MID_MILE}) m using (city)),
      k as (select city, {cents("case when trip_date = timestamp '2001-06-14' then total_cost end")} as cost_drr, {cents('total_cost')} as mtd_cost from t where trip_date >= timestamp '2001-06-01' and trip_date < timestamp '2001-06-15' group by 1),
      j as (select r.*, cost_drr, mtd_cost, revenue_drr - cost_drr as profit_drr, mtd_revenue - mtd_cost as mtd_profit from r left join k using (city)),
      u as (select coalesce(city, 'Total') as city, {', '.join(f"{cents(c)} as {c}" for c in ('revenue_drr', 'cost_drr', 'profit_drr', 'mtd_revenue', 'mtd_cost', 'mtd_profit'))},
        cast(sum(order_drr) as bigint) as order_drr, cast(sum(mtd_orders) as bigint) as mtd_orders from j group by rollup (city))
    select *, mtd_revenue / nullif(mtd_orders, 0)::double as mtd_rpo, mtd_cost / nullif(mtd_orders, 0)::double as mtd_cpo, mtd_profit / nullif(mtd_orders, 0)::double as mtd_ppo from u"""))
def pnl_daily(spark, sf):
    views(spark, sf, "task", "shipment", "charge", "crew", "node")
    riders = bind(spark, sf, "rider").select("rider_id", "vendor_charge_percent", "vendor_charge_fuel_percent").join(
        bind(spark, sf, "crew").select("rider_id", "city"), "rider_id")
    cost = report.city_cost(run(spark, PAID), run(spark, FUELLED), riders, run(spark, MID_MILE), AS_OF_TASK)
    return report.pnl_daily(report.city_revenue(run(spark, CLOSED), AS_OF_TASK), cost)

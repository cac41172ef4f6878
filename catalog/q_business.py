"""Service queries (O-10.16 to O-10.25, O-10.43 to O-10.46)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bindings import bind, run, sql
from catalog.registry import AS_OF_TASK, query
from haulmark import rules
from haulmark.functions import clock, text
from haulmark.operators import attempts, cohort, service
from haulmark.operators.skew import salted_join

NOW = f"timestamp '{AS_OF_TASK} 00:00:00'"


def ranked_tasks(spark, sf, *more):
    """Attempts with rank and the parcel's city and hub, in one shuffle of the attempts."""
    ship = bind(spark, sf, "shipment").select("awb", "shipping_city", "hub", *more)
    return attempts.attempt_rank(bind(spark, sf, "task"), attach=ship)


RANKED = """ranked as (select t.*, s.shipping_city, s.hub, s.sort_code, rank() over (partition by t.awb order by dispatch_time) as attempt_number
  from task t left join shipment s on t.awb = s.awb)"""


def day_sql(c):
    return f"date_trunc('day', {c})::timestamp"


@query("o_10_16_on_time_flags", sql("task", f"""
    with t as (select task_id, case when status = 'COMPLETED' then dispatch_time + (task_id % 5) * interval 1 day end as actual, dispatch_time + interval 2 day as promise from task)
    select task_id, case when actual::date > promise::date then 0 when actual::date <= promise::date then 1 end as tri_state,
      case when {day_sql('actual')} <= promise then 1 else 0 end as two_state from t"""))
def on_time_flags(spark, sf):
    actual = F.when(F.col("status") == "COMPLETED", F.col("dispatch_time") + F.make_dt_interval((F.col("task_id") % 5).cast("int")))
    rows = bind(spark, sf, "task").select("task_id", actual.alias("actual"), clock.plus("dispatch_time", days=2).alias("promise"))
    return rows.select("task_id", service.on_time("actual", "promise").alias("tri_state"), service.on_time_known("actual", "promise").alias("two_state"))


@query("o_10_17_outlier_flag", sql("ops", """
    with x as (select *, pickuptime + (awb % 3) * interval 1 day as ideal from ops)
    select awb, case when epoch_us(delivertime) - epoch_us(ideal) > 240 * 3.6e9 or pickuptime < first_ofd_time - (awb % 2) * interval 2 day
      or pickuptime < delivertime - interval 3 day or created_date < delivertime - interval 40 day then 1 else 0 end as outlier_flag from x"""))
def outlier_flag(spark, sf):
    ideal = F.col("pickuptime") + F.make_dt_interval((F.col("awb") % 3).cast("int"))
    seen = F.col("first_ofd_time") - F.make_dt_interval(((F.col("awb") % 2) * 2).cast("int"))
    a, b = clock.plus("delivertime", days=-3), clock.plus("delivertime", days=-40)
    # Each pair of times is shifted so that every arm of the rule occurs in the data.
    early = service.outlier_flag(a, F.lit(None).cast("timestamp_ntz"), "pickuptime", F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("timestamp_ntz"))
    born = service.outlier_flag(b, F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("timestamp_ntz"), "created_date")
    only_late = service.outlier_flag("delivertime", ideal, F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("timestamp_ntz"))
    order = service.outlier_flag(F.lit(None).cast("timestamp_ntz"), ideal, "pickuptime", seen, F.lit(None).cast("timestamp_ntz"))
    return bind(spark, sf, "ops").select("awb", F.greatest(only_late, order, early, born).alias("outlier_flag"))


PENDING_COLUMNS = f"""select awb, shipping_city, last_mile_hub, shipment_status, last_ofd, delivery_attempts, edd, last_scan_time, pickuptime, closure_status,
  case when awb % 2 = 0 then pickuptime end as datetime, edd + interval '1' day as ndd, cast(last_ofd as date) as last_failed_date, cast(last_scan_time as date) as rto_freeze_date,
  cast(last_scan_time as date) as rto_ofd_date, last_scan_time + interval '5' hour as lost_mark_time, cast(created_date as date) as modified_date from ops"""
BUCKET = f"""case when shipment_status = 'Picked-up' and datetime is not null then 'pickup' when shipment_status = 'Reached Nearest Hub' then 'fresh_attempt'
  when shipment_status = 'NDR Initiated' then 'reattempt' when shipment_status = 'Failed Delivered' then 'ndr_required'
  when shipment_status = 'Out for Delivery' and last_ofd::date = {NOW}::date then 'action_taken' when shipment_status = 'Out for Delivery' and delivery_attempts >= 1 then 'reattempt'
  when shipment_status = 'Out for Delivery' then 'fresh_attempt' when shipment_status = 'RTO Freeze' then 'RTO OFD' when shipment_status = 'RTO Out for Delivery' then 'RTO Delivery'
  when shipment_status = 'Lost' then 'Lost' else 'action_taken' end"""
DUE_DAY = f"""case action_bucket when 'pickup' then edd when 'fresh_attempt' then ndd when 'reattempt' then ndd when 'ndr_required' then last_failed_date::timestamp
  when 'RTO OFD' then rto_freeze_date::timestamp when 'RTO Delivery' then rto_ofd_date + interval 1 day when 'Lost' then {day_sql('lost_mark_time')} else modified_date::timestamp end"""
PENDING = f"pending as (select *, {DUE_DAY} as action_date from (select *, {BUCKET} as action_bucket from ({PENDING_COLUMNS}) a) b)"


def pending(spark, sf):
    bind(spark, sf, "ops").createOrReplaceTempView("ops")
    return service.action_date(service.action_bucket(run(spark, PENDING_COLUMNS), AS_OF_TASK))


@query("o_10_18_action_bucket", sql("ops", f"with {PENDING} select awb, action_bucket, action_date from pending"))
def action_bucket(spark, sf):
    return pending(spark, sf).select("awb", "action_bucket", "action_date")


@query("o_10_18_pending_counts", sql("ops", f"""
    with {PENDING} select shipping_city, last_mile_hub, action_date, count(distinct case when action_bucket = 'fresh_attempt' then awb end) as fresh_pending,
      count(distinct case when action_bucket = 'reattempt' then awb end) as reattempt_pending, count(distinct case when action_bucket = 'pickup' then awb end) as pickup_pending,
      count(distinct case when action_bucket = 'Lost' then awb end) as lost_marked from pending group by all"""))
def pending_counts(spark, sf):
    return service.pending_counts(pending(spark, sf), ["shipping_city", "last_mile_hub", "action_date"])


@query("o_10_19_missing_scan", sql("ops", f"""
    select shipping_city, last_mile_hub, last_scan_time::date as missing_action_date, count(distinct awb) as missing_shipment from ops
    where last_scan_time <= {NOW} - interval 24 hour and closure_status <> 'closed' and pickuptime is not null group by all"""))
def missing_scan(spark, sf):
    rows = bind(spark, sf, "ops").withColumn("pickup_date", clock.day("pickuptime"))
    return service.missing_scan(rows, AS_OF_TASK)


@query("o_10_20_kpi_spine", sql("ops task shipment", """
    with h as (select distinct shipping_city, last_mile_hub from ops),
      g as (select h.*, d as datetime from h, (select unnest(generate_series(timestamp '2001-05-01', timestamp '2001-08-10', interval 1 day)) as d) s),
      c as (select shipping_city, hub as last_mile_hub, date_trunc('day', dispatch_time)::timestamp as datetime, count(*) as attempts from task join shipment using (awb) group by all)
    select concat(strftime(datetime, '%d/%m/%Y'), '-', shipping_city, '-', last_mile_hub) as key, shipping_city, last_mile_hub, datetime, attempts
    from g left join c using (shipping_city, last_mile_hub, datetime)"""))
def kpi_spine(spark, sf):
    grid = service.hub_grid(bind(spark, sf, "ops"), clock.moment("2001-05-01"), clock.moment("2001-08-10"))
    ship = bind(spark, sf, "shipment").select("awb", "shipping_city", F.col("hub").alias("last_mile_hub"))
    counts = salted_join(bind(spark, sf, "task").select("awb", "dispatch_time"), ship, ["awb"], "inner").groupBy(
        "shipping_city", "last_mile_hub", clock.day("dispatch_time").alias("datetime")).agg(F.count(F.lit(1)).alias("attempts"))
    key = F.concat_ws("", text.date_text("datetime", "dd/MM/yyyy"), F.lit("-"), "shipping_city", F.lit("-"), "last_mile_hub")
    return grid.join(counts, ["shipping_city", "last_mile_hub", "datetime"], "left").withColumn("key", key)


def n(cond):
    return f"count(*) filter ({cond})"


MODE = "case when cod_amount = 0 then 'Prepaid' else 'COD' end"
RATES = f"""{n("attempt_number = 1 and status = 'COMPLETED'")} as fresh_delivered, {n("attempt_number = 1")} as fresh_attempted,
  {n(f"attempt_number = 1 and status = 'COMPLETED' and cod_amount = 0")} as prepaid_fresh_delivered, {n("attempt_number = 1 and cod_amount = 0")} as prepaid_fresh_attempted,
  {n(f"attempt_number = 1 and status = 'COMPLETED' and cod_amount <> 0")} as cod_fresh_delivered, {n("attempt_number = 1 and cod_amount <> 0")} as cod_fresh_attempted,
  {n("status = 'COMPLETED'")} as total_delivered, fresh_delivered / nullif(fresh_attempted, 0)::double as fasr,
  prepaid_fresh_delivered / nullif(prepaid_fresh_attempted, 0)::double as prepaid_fasr, cod_fresh_delivered / nullif(cod_fresh_attempted, 0)::double as cod_fasr"""


@query("o_10_21_first_attempt_success", sql("task shipment", f"with {RANKED} select shipping_city, hub, date_trunc('month', dispatch_time)::timestamp as dispatch_month, {RATES} from ranked group by 1, 2, 3"))
def first_attempt_success(spark, sf):
    return attempts.success_rates(ranked_tasks(spark, sf), ["shipping_city", "hub", clock.month("dispatch_time").alias("dispatch_month")])


@query("o_10_22_productivity", sql("task shipment node", f"""
    with {RANKED}, d as (select shipping_city, hub, date_trunc('month', dispatch_time)::timestamp as dispatch_month, count(*) filter (status = 'COMPLETED') as total_delivered,
        count(distinct rider_id) as mandays, count(distinct pincode) as distinct_pincodes from ranked group by 1, 2, 3),
      g as (select r_name as shipping_city, n_name as hub, cast(n_nationkey % 4 + 1 as double) / 10 as target_productivity from nation join region on n_regionkey = r_regionkey)
    select d.*, target_productivity, total_delivered / nullif(mandays, 0)::double as productivity, total_delivered / nullif(distinct_pincodes, 0)::double as load_per_pincode,
      total_delivered / nullif(mandays, 0)::double / nullif(target_productivity, 0) as cap_util from d left join g using (shipping_city, hub)"""))
def productivity(spark, sf):
    days = service.rider_days(ranked_tasks(spark, sf).withColumn("dispatch_month", clock.month("dispatch_time")), ["shipping_city", "hub", "dispatch_month"])
    bind(spark, sf, "nation")
    target = run(spark, "select r_name as shipping_city, n_name as hub, cast(n_nationkey % 4 + 1 as double) / 10 as target_productivity from nation join region on n_regionkey = r_regionkey")
    return service.productivity(days, ["shipping_city", "hub"], target)


@query("o_10_23_slot_rules", sql("task", """
    select task_id, case when hour(dispatch_time) <= 12 then 'Morning' else 'Evening' end as program, case when hour(dispatch_time) >= 12 then 'Afternoon' else 'Morning' end as productivity,
      case when hour(dispatch_time) >= 15 then 'evening' else 'morning' end as payout from task"""))
def slot_rules(spark, sf):
    return bind(spark, sf, "task").select("task_id", *[clock.slot_of("dispatch_time", r).alias(r) for r in clock.SLOT_RULES])


CELLS = [("Morning", "Prepaid", 0.85), ("Morning", "COD", 0.6), ("Evening", "Prepaid", 0.8), ("Evening", "COD", 0.5)]
LABELS = {("Morning", "Prepaid"): "Morning Prepaid (", ("Morning", "COD"): "Morning COD(", ("Evening", "Prepaid"): "Evening Prepaid (", ("Evening", "COD"): "Evening COD ("}
SLOT = "case when hour(dispatch_time) <= 12 then 'Morning' else 'Evening' end"


def cohort_sql(scheduled: bool) -> str:
    """Checking SQL of the weekly selection."""
    sums, rates, weak, texts = [], [], [], []
    for s, m, t in CELLS:
        c = f"{s}_{m}".lower()
        sums += [f"sum({m}_d) filter (slot = '{s}') as {c}_d", f"sum({m}_a) filter (slot = '{s}') as {c}_a", f"count(*) filter (slot = '{s}') as {c}_n"]
        rates += [f"{c}_d / nullif({c}_a, 0)::double as {c}_f", f"{c}_d / nullif({c}_n, 0)::double as {c}_o"]
        weak.append(f"({c}_f < {t} and {c}_o >= 3)")
        texts.append(f"case when {c}_f < {t} then concat('{LABELS[s, m]}', cast(cast({c}_f * 100 as int) as varchar), '%) ') end")
    return f"""with {RANKED}, days as (select date_trunc('day', dispatch_time)::timestamp as d, shipping_city, {SLOT} as slot, rider_id,
        {n('attempt_number = 1')} as fa, {n("attempt_number = 1 and status = 'COMPLETED'")} as fd, {n('attempt_number = 1 and cod_amount = 0')} as Prepaid_a,
        {n("attempt_number = 1 and status = 'COMPLETED' and cod_amount = 0")} as Prepaid_d, {n('attempt_number = 1 and cod_amount <> 0')} as COD_a,
        {n("attempt_number = 1 and status = 'COMPLETED' and cod_amount <> 0")} as COD_d, {n("status = 'COMPLETED'")} as td from ranked group by 1, 2, 3, 4),
      weeks as (select shipping_city, date_trunc('week', d)::timestamp as w, rider_id, sum(fd) / nullif(sum(fa), 0)::double as fasr, {', '.join(sums)}
        from days where shipping_city is not null {'and td >= 3' if scheduled else ''} group by 1, 2, 3),
      r as (select weeks.*, {', '.join(rates)}, rider_name, crew.hub, vendor_name, cast(floor((epoch_us(w) - epoch_us(created_at)) / 8.64e10) as int) as rider_age
        from weeks {'left ' if scheduled else ''}join crew using (rider_id) {'' if scheduled else "where hub_type <> 'franchise'"})
    select concat(strftime(b.w + interval 7 day, '%Y%m%d'), '-', cast(b.rider_id as varchar)) as key, cast(b.w + interval 7 day as date) as pip_date, b.shipping_city, b.rider_id,
      b.rider_name, b.hub, b.vendor_name, b.rider_age, concat({', '.join(x.replace(c + '_f', 'b.' + c + '_f') for x, c in zip(texts, [f'{s}_{m}'.lower() for s, m, _ in CELLS]))}) as need_improvement,
      cast(trunc(cast(cast(b.fasr * 100 as varchar) as decimal(38,15))) as double) as starting_fasr, cast(trunc(cast(cast(c.fasr * 100 as varchar) as decimal(38,15))) as double) as closing_fasr,
      'running' as pip_status, '' as pip_result
    from r b left join r c on c.w = b.w + interval 7 day and c.rider_id = b.rider_id
    where b.fasr < 0.84 and b.rider_age >= 10 and ({' or '.join('(' + ' and '.join('b.' + y for y in x[1:-1].split(' and ')) + ')' for x in weak)})"""


# Every order its own parcel, four riders, twelve weeks: weekly cells then hold several orders each.
BUSY = """select task_id, task_id as awb, status, timestamp '2001-01-01 00:00:00' + (task_id % 2016) * interval '1' hour as dispatch_time, cod_amount, tour_id,
  rider_id % 4 as rider_id from task"""


def busy_ranked(spark, sf):
    bind(spark, sf, "task").createOrReplaceTempView("task")
    return attempts.attempt_rank(run(spark, BUSY), attach=bind(spark, sf, "shipment").select("awb", "shipping_city"))


def busy(check: str) -> str:
    return check.replace("from task t left join shipment", f"from ({BUSY}) t left join shipment")


def two_cities(check: str) -> str:
    """Riders work in two cities each week, so weeks meet across cities."""
    return check.replace(", s.shipping_city,", ", concat('city ', cast(t.task_id % 2 as varchar)) as shipping_city,")


def crew(spark, sf):
    return bind(spark, sf, "crew").select("rider_id", "rider_name", "hub", "hub_type", "vendor_name", "created_at")


@query("o_10_24_cohort_select", sql("task shipment crew", two_cities(busy(cohort_sql(False)))))
def cohort_select(spark, sf):
    days = cohort.slot_days(busy_ranked(spark, sf).withColumn("shipping_city", F.concat(F.lit("city "), (F.col("task_id") % 2).cast("string"))))
    return cohort.cohort_select(days, crew(spark, sf))


@query("o_10_24_cohort_select_scheduled", sql("task shipment crew", two_cities(busy(cohort_sql(True)))))
def cohort_select_scheduled(spark, sf):
    days = cohort.slot_days(busy_ranked(spark, sf).withColumn("shipping_city", F.concat(F.lit("city "), (F.col("task_id") % 2).cast("string"))))
    return cohort.cohort_select(days, crew(spark, sf), scheduled=True)


# Every rider is followed in every week with attempts.
FOLLOWED = "select distinct date_trunc('week', dispatch_time)::date as pip_date, rider_id, crew.city as shipping_city, rider_name, crew.hub from ranked join crew using (rider_id)"
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def scorecard_sql(closing: bool) -> str:
    kept = "where tour_id not in (select tour_id from ranked group by rider_id, tour_id having count(*) filter (status = 'COMPLETED') = 0)" if closing else ""
    cut = "cast(floor(cast(cast({} as varchar) as decimal(38,15)) * 100) as double) / 100"
    fail = "avg_fasr < threshold or avg_fasr is null" if closing else "avg_fasr < threshold"
    pivot = ", ".join(f"sum(f) filter (isodow(d) = {i + 1}) as {w}" for i, w in enumerate(WEEKDAYS))
    return f"""with {RANKED}, pip as ({FOLLOWED}),
      daily as (select date_trunc('week', dispatch_time)::timestamp as w, date_trunc('day', dispatch_time)::timestamp as d, rider_id, shipping_city, concat({SLOT}, '-', {MODE}) as performance_type,
        {n("attempt_number = 1 and status = 'COMPLETED'")} as fd, {n('attempt_number = 1')} as fa, {cut.format('fd / nullif(fa, 0)::double')} as f from ranked {kept} group by 1, 2, 3, 4, 5),
      wk as (select w, rider_id, shipping_city as c, performance_type, {pivot}, {cut.format('sum(fd) / nullif(sum(fa), 0)::double')} as avg_fasr from daily group by 1, 2, 3, 4)
    select pip_date, pip.shipping_city, pip.rider_id, rider_name, hub, v.performance_type, threshold, {', '.join(WEEKDAYS)}, avg_fasr, case when {fail} then 'fail' else 'pass' end as status
    from pip cross join (values {', '.join(f"('{s}-{m}', {t}::double)" for s, m, t in CELLS)}) v(performance_type, threshold)
    left join wk on wk.rider_id = pip.rider_id and wk.w = pip.pip_date::timestamp and wk.performance_type = v.performance_type"""


def followed(spark, sf):
    rows = bind(spark, sf, "task").select("rider_id", clock.week("dispatch_time").cast("date").alias("pip_date")).distinct()
    return rows.join(bind(spark, sf, "crew").select("rider_id", F.col("city").alias("shipping_city"), "rider_name", "hub"), "rider_id")


@query("o_10_25_scorecard_running", sql("task shipment crew", scorecard_sql(False)))
def scorecard_running(spark, sf):
    return cohort.cohort_scorecard(followed(spark, sf), ranked_tasks(spark, sf).drop("hub"))


@query("o_10_25_scorecard_closing", sql("task shipment crew", scorecard_sql(True)))
def scorecard_closing(spark, sf):
    return cohort.cohort_scorecard(followed(spark, sf), ranked_tasks(spark, sf).drop("hub"), closing=True)


AGED = f"""pickuptime < timestamp '2001-05-02' and shipment_status not in ('Cancelled', 'Lost', 'Delivered', 'RTO Delivered', 'Damaged')
  and (delivertime >= {NOW} or delivertime is null or awb % 2 = 0) and (rto_delivered_time >= {NOW} or rto_delivered_time is null)"""


@query("o_10_43_ageing", sql("ops", f"""
    select user_name, shipment_status, cast({NOW}::date - pickuptime::date as int) as ageing, count(distinct awb) as orders from ops where {AGED} group by all"""))
def ageing(spark, sf):
    rows = bind(spark, sf, "ops").withColumn("delivertime", F.when(F.col("awb") % 2 != 0, F.col("delivertime")))
    return service.ageing_summary(rows, AS_OF_TASK, "2001-05-01")


def cluster_sql(groups: str, period: str) -> str:
    g = f"shipping_city, substring(sort_code, 14) as cluster_code{groups}"
    return f"""with {RANKED.replace('s.sort_code,', 's.sort_code, s.pincode as shipping_pincode,')},
      a as (select {g}, date_trunc('{period}', edd)::timestamp as period, count(distinct awb) filter ({day_sql('delivertime')} <= edd) * 100.0 / nullif(count(distinct awb), 0)::double as otd,
        count(distinct awb) filter ({day_sql('first_ofd_time')} <= edd) * 100.0 / nullif(count(distinct awb), 0)::double as ofd from ops where shipping_partner = 'Hyperlocal' group by all),
      b as (select {g}, date_trunc('{period}', dispatch_time)::timestamp as period, {n("attempt_number = 1 and status = 'COMPLETED'")} * 100.0 / nullif({n('attempt_number = 1')}, 0)::double as fasr
        from ranked join (select awb as own from ops where shipping_partner = 'Hyperlocal') o on o.own = ranked.awb group by all)
    select a.*, fasr from a left join b using (shipping_city, cluster_code{groups}, period)"""


def clusters(spark, sf, by, period):
    part = clock.week if period == "week" else clock.day
    ops = bind(spark, sf, "ops").filter("shipping_partner = 'Hyperlocal'").withColumns(
        {"cluster_code": text.substring("sort_code", 14), "period": part("edd")})
    tried = ranked_tasks(spark, sf, "sort_code", "shipper_id", F.col("pincode").alias("shipping_pincode")).filter("shipper_id = 301").withColumns(
        {"cluster_code": text.substring("sort_code", 14), "period": part("dispatch_time")})
    return service.cluster_kpis(ops, tried, by, extra=["period"])


@query("o_10_44_cluster_kpis_week", sql("ops", cluster_sql("", "week")))
def cluster_week(spark, sf):
    return clusters(spark, sf, ["shipping_city", "cluster_code"], "week")


@query("o_10_44_pincode_kpis_day", sql("ops", cluster_sql(", shipping_pincode", "day")))
def pincode_day(spark, sf):
    return clusters(spark, sf, ["shipping_city", "cluster_code", "shipping_pincode"], "day")


@query("o_10_45_lead_nodes", """
    select s_suppkey % 50 as rider_id, 8 + c_custkey / 100.0 as lat, 70 + c_custkey / 50.0 as lng from customer join supplier on c_custkey % 120 = s_suppkey where s_nationkey = 4""")
def lead_nodes(spark, sf):
    nodes = bind(spark, sf, "customer").select((F.lit(8) + F.col("c_custkey") / 100.0).alias("lat"), (F.lit(70) + F.col("c_custkey") / 50.0).alias("lng"),
                                               (F.col("c_custkey") % 120).alias("assigned_rider_id"))
    riders = bind(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 50).alias("rider_id"), F.col("s_nationkey").alias("job_id"))
    return service.lead_nodes(nodes, riders, 4)


@query("o_10_46_hub_service_pincodes", sql("shipment", """
    select s.awb as pincode from shipment s join customer on c_custkey = s.awb join nation on c_nationkey = n_nationkey
    where shipper_id = 301 and s.shipping_zone = 'Metro' and n_name = 'NATION_3'"""))
def hub_service_pincodes(spark, sf):
    pins = bind(spark, sf, "shipment").select(F.col("awb").alias("pincode"), "shipper_id", F.col("shipping_zone").alias("cost_policy"), "hub")
    cities = bind(spark, sf, "nation").select(F.col("n_nationkey").alias("shipper_city_id"), F.col("n_name").alias("city_name"))
    pins = pins.join(cities.withColumnRenamed("city_name", "hub"), "hub")
    return service.hub_service_pincodes(pins, cities, 301, "Metro", "NATION_3")

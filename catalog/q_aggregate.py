"""Aggregation queries (O-6) and quality checks (O-13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bindings import bind, cents, run, sql
from catalog.registry import query
from haulmark.functions import clock
from haulmark.functions.numbers import exact_sum, int_ratio, ratio
from haulmark.operators import aggregate, quality
from haulmark.operators.attempts import attempt_rank

def is_done():
    return F.col("status") == "COMPLETED"


def city_tasks(spark, sf, *columns):
    from haulmark.operators.skew import salted_join
    ship = bind(spark, sf, "shipment").select("awb", "shipping_city", "hub")
    return salted_join(bind(spark, sf, "task").select("awb", *columns), ship, ["awb"], "left")


@query("o_6_01_basic_aggregates", sql("task", f"""
    select rider_id, status, count(*) as attempts, {cents('cod_amount')} as total, min(cod_amount) as least, max(cod_amount) as most,
      cast(sum(cast(cod_amount * 100 as bigint)) as double) / 100 / count(*) as average from task group by all"""))
def basic(spark, sf):
    return aggregate.summarise(bind(spark, sf, "task"), ["rider_id", "status"], attempts=F.count(F.lit(1)), total=exact_sum("cod_amount"),
                               least=F.min("cod_amount"), most=F.max("cod_amount"), average=exact_sum("cod_amount") / F.count(F.lit(1)))


@query("o_6_02_conditional_sum", sql("task", f"""
    select rider_id, count(*) filter (status = 'COMPLETED') as done, {cents("case when status = 'COMPLETED' then cod_amount else 0 end")} as done_value,
      {cents("case when status = 'COMPLETED' and cod_amount > 499000 then cod_amount end")} as top_value from task group by 1"""))
def conditional(spark, sf):
    top = is_done() & (F.col("cod_amount") > 499000)
    return aggregate.summarise(bind(spark, sf, "task"), ["rider_id"], done=aggregate.count_when(is_done()),
                               done_value=exact_sum(F.when(is_done(), F.col("cod_amount")).otherwise(0)),
                               top_value=exact_sum(F.when(top, F.col("cod_amount"))))


@query("o_6_03_count_distinct", sql("task", "select rider_id, count(distinct awb) as parcels from task group by 1"))
def count_distinct(spark, sf):
    return aggregate.summarise(bind(spark, sf, "task"), ["rider_id"], parcels=F.count_distinct("awb"))


@query("o_6_04_conditional_distinct", sql("task", """
    select rider_id, count(distinct case when status = 'COMPLETED' then awb end) as done, count(distinct case when status = 'CANCELLED' then awb end) as lost,
      count(distinct case when cod_amount = 0 then awb end) as prepaid, count(distinct awb) as parcels from task group by 1"""))
def conditional_distinct(spark, sf):
    return aggregate.distinct_when(bind(spark, sf, "task"), ["rider_id"], "awb", {
        "done": is_done(), "lost": F.col("status") == "CANCELLED", "prepaid": F.col("cod_amount") == 0}, total="parcels")


@query("o_6_05_milestones", sql("scan", """
    select shipment_id, min(case when shipment_status = 'Picked-up' then update_time end) as picked,
      max(case when shipment_status = 'Out For Delivery' and location is not null then update_time end) as last_out,
      min(case when shipment_status = 'Delivered' and remark like '%3' then update_time end) as delivered from scan group by 1"""))
def milestones(spark, sf):
    s = F.col("shipment_status")
    return aggregate.milestones(bind(spark, sf, "scan"), "shipment_id", "update_time", {
        "picked": ("min", s == "Picked-up"), "last_out": ("max", (s == "Out For Delivery") & F.col("location").isNotNull()),
        "delivered": ("min", (s == "Delivered") & F.col("remark").endswith("3"))})


@query("o_6_06_ratio", sql("task", """
    select pincode, count(*) filter (status = 'COMPLETED') / nullif(count(*) filter (cod_amount = 0), 0)::double as done_per_prepaid from task group by 1"""))
def ratios(spark, sf):
    out = aggregate.summarise(bind(spark, sf, "task"), ["pincode"], d=F.count_if(is_done()), p=F.count_if(F.col("cod_amount") == 0))
    return out.select("pincode", ratio("d", "p").alias("done_per_prepaid"))


@query("o_6_07_int_ratio", sql("task", """
    select awb, count(*) filter (status = 'COMPLETED') // nullif(count(*) filter (status <> 'ONGOING'), 0) as done_share from task group by 1"""))
def int_ratios(spark, sf):
    out = aggregate.summarise(bind(spark, sf, "task"), ["awb"], d=F.count_if(is_done()), n=F.count_if(F.col("status") != "ONGOING"))
    return out.select("awb", int_ratio("d", "n").alias("done_share"))


DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


@query("o_6_08_weekday_pivot", sql("task", "select rider_id, date_trunc('week', dispatch_time)::timestamp as week, " + ", ".join(
    f"cast(sum(case when isodow(dispatch_time) = {i + 1} then n end) as bigint) as {d}" for i, d in enumerate(DAYS)) + """
    from (select rider_id, date_trunc('day', dispatch_time) as dispatch_time, count(*) as n from task group by all) t group by all"""))
def weekday_pivot(spark, sf):
    daily = bind(spark, sf, "task").groupBy("rider_id", clock.day("dispatch_time").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return aggregate.weekday_pivot(daily.withColumn("week", clock.week("day")), ["rider_id", "week"], "week", "day", "n")


@query("o_6_09_first_k_columns", sql("task", "select rider_id, " + ", ".join(f"max(case when rn = {i} then awb end) as fr_{i}" for i in range(1, 11)) + """
    from (select rider_id, awb, row_number() over (partition by rider_id order by dispatch_time, task_id) as rn from task where status = 'CANCELLED') t
    where rn <= 10 group by 1"""))
def first_k(spark, sf):
    rows = bind(spark, sf, "task").filter("status = 'CANCELLED'")
    return aggregate.first_k_columns(rows, ["rider_id"], ["dispatch_time", "task_id"], "awb", 10)


@query("o_6_10_filter_on_aggregate", sql("task", """
    select rider_id, tour_id, count(*) as attempts from task group by all having count(*) filter (status = 'COMPLETED') = 0"""))
def filter_on_aggregate(spark, sf):
    out = aggregate.summarise(bind(spark, sf, "task"), ["rider_id", "tour_id"], attempts=F.count(F.lit(1)), done=F.count_if(is_done()))
    return out.filter("done = 0").drop("done")


@query("o_6_11_two_level", sql("task", """
    select date_trunc('month', d)::timestamp as month, cast(sum(n) as bigint) as attempts, cast(sum(n) as double) / count(*) as per_rider_day, max(n) as best
    from (select date_trunc('day', dispatch_time) as d, rider_id, count(*) as n from task group by all) t group by 1"""))
def two_level(spark, sf):
    daily = bind(spark, sf, "task").groupBy(clock.day("dispatch_time").alias("d"), "rider_id").agg(F.count(F.lit(1)).alias("n"))
    return daily.groupBy(clock.month("d").alias("month")).agg(
        F.sum("n").alias("attempts"), ratio(F.sum("n"), F.count(F.lit(1))).alias("per_rider_day"), F.max("n").alias("best"))


CITY_ROW = f"count(*) filter (status = 'COMPLETED') as done, count(*) as attempts, {cents('cod_amount')} as value"


@query("o_6_12_total_row", sql("task shipment", f"""
    with b as (select shipping_city, {CITY_ROW} from task left join shipment using (awb) group by 1
      union all select 'Total', {CITY_ROW} from task left join shipment using (awb))
    select *, value / nullif(attempts, 0) as per_order, done::double / nullif(attempts, 0) as share from b"""))
def total_row(spark, sf):
    rows = city_tasks(spark, sf, "status", "cod_amount")
    return aggregate.with_total(rows, "shipping_city", {"done": F.count_if(is_done()), "attempts": F.count(F.lit(1)), "value": exact_sum("cod_amount")},
                                ratios={"per_order": ("value", "attempts"), "share": ("done", "attempts")})


@query("o_6_13_group_share", sql("task shipment", """
    select shipping_city, hub, count(*) as total_count, count(*) filter (status = 'CANCELLED') as failed_count,
      cast(count(*) filter (status = 'CANCELLED') * 100 // count(*) as int) as failed_rate from task left join shipment using (awb) group by all"""))
def group_share(spark, sf):
    return aggregate.share_by(city_tasks(spark, sf, "status"), ["shipping_city", "hub"], F.col("status") == "CANCELLED")


@query("o_6_14_distinct_in_multi_agg", sql("task shipment", f"""
    select user_name, shipping_city, count(distinct awb) as orders, {cents('cod_amount')} as value, count(*) as attempts
    from task join shipment using (awb) group by all"""))
def distinct_in_multi(spark, sf):
    from haulmark.operators.skew import salted_join
    rows = salted_join(bind(spark, sf, "task").select("awb", "cod_amount"), bind(spark, sf, "shipment").select("awb", "user_name", "shipping_city"), ["awb"], "inner")
    return aggregate.summarise(rows, ["user_name", "shipping_city"], orders=F.count_distinct("awb"), value=exact_sum("cod_amount"), attempts=F.count(F.lit(1)))


@query("o_6_15_dependent_pick", sql("task", """
    select tour_id, min(dispatch_time) as tour_start_time, min(case when status = 'COMPLETED' then dispatch_time end) as tour_end_time, max(tour_id * 2) as fixed from task group by 1"""))
def dependent_pick(spark, sf):
    return aggregate.summarise(bind(spark, sf, "task"), ["tour_id"], tour_start_time=F.min("dispatch_time"),
                               tour_end_time=F.min(F.when(is_done(), F.col("dispatch_time"))), fixed=F.max(F.col("tour_id") * 2))


# ---------------------------------------------------------------- O-13
@query("o_13_01_duplicates", """
    select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem
    qualify count(*) over (partition by l_orderkey, l_linenumber) > 1""")
def duplicates(spark, sf):
    rows = bind(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return quality.duplicates(rows, ["l_orderkey", "l_linenumber"])


WIDE = ["tracking_id", "shipment_id", "shipment_status", "location", "remark", "update_time"]


@query("o_13_02_null_profile", sql("scan_wide", " union all ".join(
    f"select '{c}' as column_name, count(*) filter ({c} is null) as null_count from scan_wide" for c in WIDE)))
def null_profile(spark, sf):
    return quality.null_profile(bind(spark, sf, "scan_wide"))


# Delivered revenue against weighed parcels, which number orders instead of customers: both sides miss some.
DELIVERED = "select t.awb, shipment_status, city from task t join shipment s on s.awb = t.awb where status = 'COMPLETED'"
ONE_SIDED = f"""with a as (select awb as k, min(shipment_status) as shipment_status, min(city) as city from ({DELIVERED}) d group by 1), b as (select distinct awb as k from weight),
  r as (select coalesce(a.k, b.k) as awb, if(a.k is null, 'only_right', 'only_left') as side, shipment_status, city from a full join b on a.k = b.k where a.k is null or b.k is null)"""


def one_sided(spark, sf):
    for name in ("task", "shipment"):
        bind(spark, sf, name).createOrReplaceTempView(name)
    return quality.reconcile(run(spark, DELIVERED), bind(spark, sf, "weight"), "awb", ["shipment_status", "city"])


@query("o_13_03_reconcile", sql("task shipment weight", f"{ONE_SIDED} select * from r"))
def reconcile(spark, sf):
    return one_sided(spark, sf)


@query("o_13_03_reconcile_breakdown", sql("task shipment weight", f"""{ONE_SIDED}
    select side, 'shipment_status' as column_name, shipment_status as value, count(*) as missing_keys from r group by all
    union all select side, 'city', city, count(*) from r group by all"""))
def reconcile_breakdown(spark, sf):
    return quality.reconcile_breakdown(one_sided(spark, sf), ["shipment_status", "city"])


# A second state of the attempts: some amounts changed, some rows gone, some new, some without a key.
OTHER_STATE = """select case when task_id % 211 = 0 then null when task_id % 97 = 0 then task_id + 100000000 else task_id end as task_id, awb,
  case when task_id % 131 = 0 then null else status end as status, case when task_id % 53 = 0 then cod_amount + 1 else cod_amount end as cod_amount
  from task where task_id % 167 <> 0"""


@query("o_13_03_reconcile_rows", sql("task", f"""
    with b as ({OTHER_STATE}), l as (select task_id, list_sort(list(row(awb, status, cod_amount)::varchar)) as x from task group by 1),
      r as (select task_id, list_sort(list(row(awb, status, cod_amount)::varchar)) as y from b group by 1)
    select coalesce(l.task_id, r.task_id) as task_id, case when y is null then 'only_left' when x is null then 'only_right' else 'differs' end as side
    from l full join r on l.task_id is not distinct from r.task_id where x is distinct from y"""))
def reconcile_rows(spark, sf):
    """Digests per bucket first; keys are compared only where these differ."""
    bind(spark, sf, "task").createOrReplaceTempView("task")
    return quality.reconcile_rows(bind(spark, sf, "task"), run(spark, OTHER_STATE), ["task_id"], ["awb", "status", "cod_amount"])


@query("o_13_04_control_totals", sql("task", f"""
    select status, count(*) as row_count, {cents('cod_amount')} as cod, count(cancellation_remarks) as remarks from task group by 1"""))
def control_totals(spark, sf):
    return quality.control_totals(bind(spark, sf, "task"), ["status"], cod=exact_sum("cod_amount"), remarks=F.count("cancellation_remarks"))

"""Join queries (O-5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bindings import bind, cents, run, sql
from catalog.registry import query, with_hot_keys
from haulmark.functions import clock, text
from haulmark.functions.numbers import exact_sum
from haulmark.operators import joins, mutate, shape
from haulmark.operators.attempts import attempt_rank
from haulmark.operators.skew import salted_join


@query("o_5_01_left_star", sql("task shipment rider node", """
    select t.task_id, s.shipping_city, s.hub, r.rider_name, n.node_name as home_hub, s.user_name
    from task t left join shipment s on t.awb = s.awb left join rider r on t.rider_id = r.rider_id left join node n on r.node_id = n.node_id"""))
def left_star(spark, sf):
    shipment = bind(spark, sf, "shipment").select("awb", "shipping_city", "hub", "user_name")
    rider = bind(spark, sf, "rider").select("rider_id", "rider_name", "node_id")
    node = bind(spark, sf, "node").select("node_id", F.col("node_name").alias("home_hub"))
    return joins.star(bind(spark, sf, "task").select("task_id", "awb", "rider_id"), (shipment, "awb"), (rider, "rider_id"),
                      (node, "node_id")).drop("awb", "rider_id", "node_id")


@query("o_5_02_inner", sql("task shipment", "select task_id, awb, shipping_city from task join shipment using (awb) where shipper_id = 301"))
def inner(spark, sf):
    own = bind(spark, sf, "shipment").filter("shipper_id = 301").select("awb", "shipping_city")
    return salted_join(bind(spark, sf, "task").select("task_id", "awb"), own, ["awb"], "inner")


@query("o_5_03_right_effective_inner", sql("task shipment", f"""
    select awb, shipping_city, {cents('cod_amount')} as cod from shipment right join task using (awb) where shipping_city is not null group by all"""))
def right_effective_inner(spark, sf):
    rows = salted_join(bind(spark, sf, "task").select("awb", "cod_amount"), bind(spark, sf, "shipment").select("awb", "shipping_city"), ["awb"], "inner")
    return rows.filter(F.col("shipping_city").isNotNull()).groupBy("awb", "shipping_city").agg(exact_sum("cod_amount").alias("cod"))


@query("o_5_04_full_null_safe", sql("task shipment", """
    select coalesce(l.pincode, r.pincode) as pincode, attempts, parcels
    from (select nullif(pincode, 3) as pincode, count(*) as attempts from task group by 1) l
    full join (select nullif(pincode, 7) as pincode, count(*) as parcels from shipment where shipper_id = 301 group by 1) r
      on l.pincode is not distinct from r.pincode"""))
def full_null_safe(spark, sf):
    left = bind(spark, sf, "task").groupBy(F.nullif("pincode", F.lit(3)).alias("pincode")).agg(F.count(F.lit(1)).alias("attempts"))
    right = bind(spark, sf, "shipment").filter("shipper_id = 301").groupBy(F.nullif("pincode", F.lit(7)).alias("pincode")).agg(F.count(F.lit(1)).alias("parcels"))
    return joins.full_null_safe(left, right, ["pincode"])


NULL_TASKS = "select task_id, case when task_id % 4 = 0 then null else pincode * 10 end as pincode from task"
NULL_PARCELS = "select shipment_id, case when shipment_id % 3 = 0 then null else pincode * 5 end as pincode from shipment"


@query("o_5_04_full_null_safe_hot", sql("task shipment", f"""
    select coalesce(l.pincode, r.pincode) as pincode, count(*) as pairs, count(distinct task_id) as tasks, count(distinct shipment_id) as parcels, sum(task_id % 1000 * (shipment_id % 1000))::bigint as checked
    from ({NULL_TASKS}) l full join ({NULL_PARCELS}) r on l.pincode is not distinct from r.pincode group by 1"""))
def full_null_safe_hot(spark, sf):
    """Null meets null: rows times rows pairs of one key, met on a grid of tasks."""
    for name in ("task", "shipment"):
        bind(spark, sf, name).createOrReplaceTempView(name)
    met = joins.full_null_safe(run(spark, NULL_TASKS), run(spark, NULL_PARCELS), ["pincode"], hot=100)
    return met.groupBy("pincode").agg(F.count(F.lit(1)).alias("pairs"), F.count_distinct("task_id").alias("tasks"), F.count_distinct("shipment_id").alias("parcels"),
                                      F.sum(F.col("task_id") % 1000 * (F.col("shipment_id") % 1000)).alias("checked"))


@query("o_5_05_paired_rows", sql("node task", """
    select node_name, slot, mode, threshold, d as day from node
    cross join (values ('Morning', 'Prepaid', 0.85::double), ('Morning', 'COD', 0.6::double), ('Evening', 'Prepaid', 0.8::double),
      ('Evening', 'COD', 0.5::double)) v(slot, mode, threshold)
    cross join (select cast(unnest(generate_series((select min(dispatch_time)::date from task), (select min(dispatch_time)::date from task)
      + interval 30 day, interval 1 day)) as date) as d) x"""))
def paired_rows(spark, sf):
    from haulmark import rules
    start = bind(spark, sf, "task").agg(F.min("dispatch_time").cast("date").alias("d")).scalar()
    pairs = shape.with_rows(bind(spark, sf, "node").select("node_name"), rules.PROGRAM_THRESHOLDS, ["slot", "mode", "threshold"])
    dated = pairs.withColumn("_start", start)
    return shape.all_days(dated, F.col("_start"), F.date_add("_start", 30)).drop("_start")


@query("o_5_06_composite_key", sql("task shipment", """
    select l.shipping_city, l.hub, l.day, l.attempts, r.done
    from (select shipping_city, hub, cast(dispatch_time as date) as day, count(*) as attempts from task join shipment using (awb) group by all) l
    left join (select shipping_city, hub, cast(dispatch_time as date) as day, count(*) as done from task join shipment using (awb)
      where status = 'COMPLETED' group by all) r using (shipping_city, hub, day)"""))
def composite_key(spark, sf):
    rows = salted_join(bind(spark, sf, "task").select("awb", "dispatch_time", "status"), bind(spark, sf, "shipment").select("awb", "shipping_city", "hub"), ["awb"], "inner")
    by = ["shipping_city", "hub", F.col("dispatch_time").cast("date").alias("day")]
    left = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("attempts"))
    right = rows.filter("status = 'COMPLETED'").groupBy(*by).agg(F.count(F.lit(1)).alias("done"))
    return left.join(right, ["shipping_city", "hub", "day"], "left")


@query("o_5_07_expression_key", sql("shipment node", """
    select awb, node_name, node_type from shipment join node on lower(trim(split_part(sort_code, '/', 2))) = lower(trim(split_part(sort_codes, '/', 2)))"""))
def expression_key(spark, sf):
    left = bind(spark, sf, "shipment").select("awb", "sort_code")
    right = bind(spark, sf, "node").select("node_name", "node_type", "sort_codes")
    return joins.on_expressions(left, right, [(F.lower(text.part("sort_code", "/", 2)), F.lower(text.part("sort_codes", "/", 2)))]).drop("sort_code", "sort_codes")


@query("o_5_08_cast_key", sql("txn shipment", """
    select transaction_id, s.awb, s.hub from (select transaction_id, case when transaction_type = 'freight' then concat('F', cast(shipment_id as varchar))
      else cast(shipment_id as varchar) end as reference_id from txn) t
    left join shipment s on try_cast(t.reference_id as bigint) = s.shipment_id"""))
def cast_key(spark, sf):
    ref = F.when(F.col("transaction_type") == "freight", F.concat(F.lit("F"), F.col("shipment_id").cast("string"))).otherwise(F.col("shipment_id").cast("string"))
    left = bind(spark, sf, "txn").select("transaction_id", ref.alias("reference_id"))
    right = bind(spark, sf, "shipment").select("shipment_id", "awb", "hub")
    return joins.on_cast(left, right, "reference_id", "shipment_id").select("transaction_id", "awb", "hub")


FIRST_OUT = "select shipment_id, min(update_time) as first_ofd from scan where shipment_status = 'Out For Delivery' group by 1"


@query("o_5_09_range_after", sql("scan", f"""
    select tracking_id, s.shipment_id, update_time, first_ofd from scan s join ({FIRST_OUT}) f
      on s.shipment_id = f.shipment_id and s.update_time > f.first_ofd where shipment_status = 'Failed Delivery'"""))
def range_after(spark, sf):
    log = bind(spark, sf, "scan")
    first = log.filter("shipment_status = 'Out For Delivery'").groupBy("shipment_id").agg(F.min("update_time").alias("first_ofd"))
    failed = log.filter("shipment_status = 'Failed Delivery'").select("tracking_id", "shipment_id", "update_time")
    return joins.after(failed, first, ["shipment_id"], "update_time", "first_ofd")


@query("o_5_10_interval_latest", sql("scan", """
    with a as (select shipment_id as awb, tracking_id as task_id, update_time as dispatch_time,
        lead(update_time) over (partition by shipment_id order by update_time) as next_time from scan where shipment_status = 'Out For Delivery'),
      r as (select shipment_id as awb, tracking_id as reply_id, update_time as timestamp, remark from scan where shipment_status = 'Failed Delivery')
    select a.awb, a.task_id, a.dispatch_time, r.reply_id, r.timestamp, r.remark from a left join r
      on a.awb = r.awb and a.dispatch_time <= r.timestamp and (a.next_time is null or a.next_time >= r.timestamp)
    qualify row_number() over (partition by a.task_id order by r.timestamp desc, r.reply_id desc) = 1"""))
def interval_latest(spark, sf, hot="auto"):
    log = bind(spark, sf, "scan")
    attempts = log.filter("shipment_status = 'Out For Delivery'").select(
        F.col("shipment_id").alias("awb"), F.col("tracking_id").alias("task_id"), F.col("update_time").alias("dispatch_time"))
    replies = log.filter("shipment_status = 'Failed Delivery'").select(
        F.col("shipment_id").alias("awb"), F.col("tracking_id").alias("reply_id"), F.col("update_time").alias("timestamp"), "remark")
    return joins.interval_latest(attempts, replies, "awb", "dispatch_time", "timestamp", "reply_id", hot=hot)


with_hot_keys("o_5_10_interval_latest", interval_latest, 20)


@query("o_5_11_neighbours", sql("task", """
    with r as (select task_id, awb, dispatch_time, rank() over (partition by awb order by dispatch_time) as n from task),
      d as (select awb, n, min(dispatch_time) as t from r group by all)
    select task_id, cast(r.n as int) as attempt_number, p.t as previous_trip_time, x.t as next_trip_time from r
    left join d p on p.awb = r.awb and p.n = r.n - 1 left join d x on x.awb = r.awb and x.n = r.n + 1"""))
def neighbours(spark, sf):
    ranked = attempt_rank(bind(spark, sf, "task").select("task_id", "awb", "dispatch_time"))
    return joins.neighbours(ranked, "awb", "attempt_number", "dispatch_time").select("task_id", "attempt_number", "previous_trip_time", "next_trip_time")


@query("o_5_12_semi", sql("task shipment", "select task_id, awb, status from task where awb in (select awb from shipment where shipper_id = 301)"))
def semi(spark, sf):
    own = bind(spark, sf, "shipment").filter("shipper_id = 301").select("awb")
    return joins.semi(bind(spark, sf, "task").select("task_id", "awb", "status"), own, ["awb"], hot="auto")


LOST = "select awb from shipment where shipment_status = 'Lost'"


@query("o_5_13_not_in_null_aware", sql("task shipment", f"""
    select 'plain' as list, task_id from task where awb not in ({LOST})
    union all select 'with null', task_id from task where awb not in (select awb from ({LOST}) union all select null)
    union all select 'empty', task_id from task where awb not in ({LOST} and awb < 0)"""))
def not_in(spark, sf):
    task = bind(spark, sf, "task").select("task_id", "awb")
    lost = bind(spark, sf, "shipment").filter("shipment_status = 'Lost'").select("awb")
    nulls = lost.unionByName(lost.agg(F.lit(None).cast("bigint").alias("awb")))
    parts = {"plain": lost, "with null": nulls, "empty": lost.filter("awb < 0")}
    out = None
    for name, listed in parts.items():
        rows = joins.not_in(task, "awb", listed, "awb", hot="auto").select(F.lit(name).alias("list"), "task_id")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("o_5_14_anti", sql("task shipment", f"select task_id, awb from task where not exists (select 1 from ({LOST}) l where l.awb = task.awb)"))
def anti(spark, sf):
    lost = bind(spark, sf, "shipment").filter("shipment_status = 'Lost'").select("awb")
    return joins.anti(bind(spark, sf, "task").select("task_id", "awb"), lost, ["awb"], hot="auto")


@query("o_5_15_in_subquery_delete", sql("task", """
    select task_id, rider_id, status from task where not (status = 'ONGOING' and rider_id in
      (select rider_id from task where status = 'CANCELLED' and cod_amount > 480000))"""))
def in_subquery_delete(spark, sf):
    task = bind(spark, sf, "task").select("task_id", "rider_id", "status", "cod_amount")
    bad = task.filter("status = 'CANCELLED' and cod_amount > 480000").select("rider_id")
    return mutate.delete_in(task, F.col("status") == "ONGOING", "rider_id", bad).drop("cod_amount")


@query("o_5_16_scalar_subquery", sql("task", """
    select task_id, cod_amount / (select max(cod_amount) from task) as share from task"""))
def scalar_subquery(spark, sf):
    task = bind(spark, sf, "task")
    top = task.agg(F.max("cod_amount")).scalar()
    return task.select("task_id", (F.col("cod_amount") / top).alias("share"))


@query("o_5_17_outer_turned_inner", sql("task shipment", """
    select task_id, hub from task left join shipment using (awb) where hub like '%1%' and shipper_id is not null"""))
def outer_turned_inner(spark, sf):
    named = bind(spark, sf, "shipment").filter(F.col("hub").like("%1%") & F.col("shipper_id").isNotNull()).select("awb", "hub")
    return salted_join(bind(spark, sf, "task").select("task_id", "awb"), named, ["awb"], "inner").drop("awb")

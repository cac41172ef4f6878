"""Queries for reading and writing (O-1, O-2)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from catalog.bindings import bind, cents, sql
from catalog.registry import AS_OF_SCAN, AS_OF_TASK, query, workdir
from haulmark.functions import clock, text
from haulmark.functions.numbers import exact_sum
from haulmark.operators.aggregate import summarise
from haulmark.sources import readers, views, writers


@query("o_1_01_scan", "select o_orderkey, o_custkey, o_orderdate from orders")
def scan(spark, sf):
    bind(spark, sf, "orders")
    return readers.scan(spark, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])


@query("o_1_02_read_query", sql("task", "select status, count(*) as attempts, max(dispatch_time) as last_dispatch from task group by status"))
def read_query(spark, sf):
    return readers.read_query(
        spark, "select status, count(*) as attempts, max(dispatch_time) as last_dispatch from {task} group by status",
        task=bind(spark, sf, "task"))


@query("o_1_03_read_sql_file", sql("task", f"""
    select rider_id, count(*) as attempts, max(dispatch_time) as last_dispatch from task
    where dispatch_time < timestamp '{AS_OF_TASK} 00:00:00' group by rider_id"""))
def read_sql_file(spark, sf):
    path = os.path.join(os.path.dirname(__file__), "sql", "attempts_before.sql")
    return readers.read_sql_file(spark, path, {"as_of": f"{AS_OF_TASK} 00:00:00"}, task=bind(spark, sf, "task"))


@query("o_1_04_read_master_csv", """
    select cast(year(o_orderdate) as int) as year, o_orderstatus as head, cast(date_trunc('year', o_orderdate) as date) as month,
      cast(round(sum(cast(o_totalprice as decimal(18,2)))) as double) as amount, cast(0.0521 as double) as commission
    from orders group by all""")
def read_master_csv(spark, sf):
    orders = bind(spark, sf, "orders")
    master = orders.groupBy(F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("head")).agg(
        F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")), 0).alias("amount"))
    written = master.select("year", "head", F.concat(F.lit("01/01/"), F.col("year").cast("string")).alias("month"),
                            text.rupees("amount").alias("amount"), F.lit("5.21%").alias("commission"))
    path = workdir(spark)
    writers.write_csv(written, path)
    back = readers.read_master_csv(spark, path, "year int, head string, month string, amount string, commission string",
                                   money=["amount", "commission"], day_first=["month"])
    return back.withColumns({"amount": F.col("amount").cast("double"), "commission": F.col("commission").cast("double")})


@query("o_1_05_read_tabular", "select o_orderstatus, count(*) as n, max(o_orderkey) as top_key from orders group by o_orderstatus")
def read_tabular(spark, sf):
    path = f"{workdir(spark)}.json"
    bind(spark, sf, "orders").select("o_orderkey", "o_orderstatus").write.json(path)
    back = readers.read_tabular(spark, path, "o_orderkey long, o_orderstatus string")
    return summarise(back, ["o_orderstatus"], n=F.count(F.lit(1)), top_key=F.max("o_orderkey"))


@query("o_1_06_day_spine", sql("task", """
    select d as day, coalesce(n, 0) as attempts
    from (select unnest(generate_series(timestamp '1995-01-01', timestamp '2001-12-31', interval 1 day)) as d) s
    left join (select date_trunc('day', dispatch_time) as t, count(*) as n from task group by 1) c on d = t"""))
def day_spine(spark, sf):
    spine = readers.day_spine(spark, "1995-01-01", "2001-12-31", name="day")
    counts = bind(spark, sf, "task").groupBy(clock.day("dispatch_time").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("attempts"))


@query("o_1_07_inline_table", sql("task", """
    select slot, mode, threshold, count(*) as attempts from (
      select case when hour(dispatch_time) <= 12 then 'Morning' else 'Evening' end as slot,
        case when cod_amount = 0 then 'Prepaid' else 'COD' end as mode from task) t
    join (values ('Morning', 'Prepaid', 0.85::double), ('Morning', 'COD', 0.6::double), ('Evening', 'Prepaid', 0.8::double),
      ('Evening', 'COD', 0.5::double)) v(slot, mode, threshold) using (slot, mode)
    group by all"""))
def inline_table(spark, sf):
    from haulmark import rules
    from haulmark.operators.attempts import payment_mode
    limits = readers.inline_table(spark, rules.PROGRAM_THRESHOLDS, "slot string, mode string, threshold double")
    rows = bind(spark, sf, "task").select(clock.slot_of("dispatch_time").alias("slot"), payment_mode().alias("mode"))
    return rows.join(limits, ["slot", "mode"]).groupBy("slot", "mode", "threshold").agg(F.count(F.lit(1)).alias("attempts"))


RECEIVED = "update_time + (tracking_id % 5) * interval '1' hour"


@query("o_1_08_changed_keys", sql("scan", f"""
    select distinct shipment_id from scan
    where (update_time >= timestamp '{AS_OF_SCAN}' - interval 24 hour or {RECEIVED} >= timestamp '{AS_OF_SCAN}' - interval 24 hour)
      and shipment_id not in (1, 2, 3, 10, 11, 42)"""))
def changed_keys(spark, sf):
    log = bind(spark, sf, "scan").withColumn("received", F.expr(RECEIVED))
    return readers.changed_keys(log, "shipment_id", ["update_time", "received"], AS_OF_SCAN, 24,
                                exclude=("shipment_id", [1, 2, 3, 10, 11, 42]))


@query("o_1_09_view_dag", sql("task shipment", f"""
    select shipping_city, hub, count(*) as days, cast(sum(attempts) as bigint) as attempts from (
      select shipping_city, hub, date_trunc('day', dispatch_time) as d, count(*) as attempts
      from task join shipment using (awb) where dispatch_time < timestamp '{AS_OF_TASK}' group by all) x
    group by all"""))
def view_dag(spark, sf):
    def daily(task, shipment, as_of):
        rows = task.filter(F.col("dispatch_time") < clock.moment(as_of)).join(
            shipment.select("awb", "shipping_city", "hub"), "awb")
        return rows.groupBy("shipping_city", "hub", clock.day("dispatch_time").alias("d")).agg(F.count(F.lit(1)).alias("attempts"))

    def per_hub(daily):
        return daily.groupBy("shipping_city", "hub").agg(F.count(F.lit(1)).alias("days"), F.sum("attempts").alias("attempts"))

    tables = {"task": bind(spark, sf, "task"), "shipment": bind(spark, sf, "shipment")}
    return views.view_dag(tables, {"daily": daily, "per_hub": per_hub}, AS_OF_TASK, keep=["daily"],
                          folder=workdir(spark))["per_hub"]


@query("o_1_09_refresh_changed", sql("task shipment", f"""
    with d as (select shipping_city, hub, count(*) as attempts from task join shipment using (awb) group by all)
    select shipping_city, count(*) as hubs, cast(sum(attempts) as bigint) as attempts, 'daily per_city' as second_run from d group by 1"""))
def refresh_changed(spark, sf):
    """A second refresh after one of two inputs has grown: the view of the other input is not built again."""
    folder = workdir(spark)

    def daily(task, places):
        return task.join(places, "awb").groupBy("shipping_city", "hub").agg(F.count(F.lit(1)).alias("attempts"))

    def places(shipment):
        return shipment.select("awb", "shipping_city", "hub")

    def per_city(daily):
        return daily.groupBy("shipping_city").agg(F.count(F.lit(1)).alias("hubs"), F.sum("attempts").alias("attempts"))

    task = bind(spark, sf, "task").select("task_id", "awb", "dispatch_time")
    early = F.col("dispatch_time") < clock.moment(AS_OF_TASK)
    task.filter(early).write.parquet(f"{folder}/task")
    for built in ([], second := []):
        tables = {"task": spark.read.parquet(f"{folder}/task"), "shipment": bind(spark, sf, "shipment")}
        out = views.refresh(spark, tables, {"places": places, "daily": daily, "per_city": per_city}, keep=["places", "daily", "per_city"],
                            folder=f"{folder}/views", built=built)["per_city"]
        if not second:
            task.filter(~F.coalesce(early, F.lit(False))).write.mode("append").parquet(f"{folder}/task")
    return out.withColumn("second_run", F.lit(" ".join(second)))


PER_AWB = f"select awb, count(*) as attempts, {cents('cod_amount')} as cod_total from task group by awb"


def per_awb(spark, sf):
    return summarise(bind(spark, sf, "task"), ["awb"], attempts=F.count(F.lit(1)), cod_total=exact_sum("cod_amount"))


@query("o_2_01_materialize", sql("task", PER_AWB))
def materialize(spark, sf):
    return writers.materialize(per_awb(spark, sf), f"{workdir(spark)}/per_awb", key=["awb"])


@query("o_2_02_append", sql("task", "select task_id, awb, status from task"))
def append(spark, sf):
    path = f"{workdir(spark)}/tasks"
    task = bind(spark, sf, "task").select("task_id", "awb", "status")
    writers.append(task.filter("status = 'COMPLETED'"), path)
    writers.append(task.filter("status <> 'COMPLETED'"), path)
    return spark.read.parquet(path)


@query("o_2_03_insert_select", sql("task", """
    select task_id, awb, status, case when status = 'COMPLETED' then rider_id end as rider_id from task"""))
def insert_select(spark, sf):
    task = bind(spark, sf, "task")
    stored = task.filter("status = 'COMPLETED'").select("task_id", "awb", "status", "rider_id")
    return writers.insert_select(stored, task.filter("status <> 'COMPLETED'").select("status", "awb", "task_id"))


@query("o_2_04_copy_delimited", sql("shipment", "select awb, user_name, shipping_city, hub from shipment"))
def copy_delimited(spark, sf):
    path = workdir(spark)
    writers.copy_delimited(bind(spark, sf, "shipment").select("awb", "user_name", "shipping_city", "hub"), path)
    return writers.load_delimited(spark, path, "awb long, user_name string, shipping_city string, hub string")


@query("o_2_05_write_csv", sql("task", PER_AWB))
def write_csv(spark, sf):
    path = workdir(spark)
    writers.write_csv(per_awb(spark, sf), path)
    return spark.read.schema("awb long, attempts long, cod_total double").option("header", True).csv(path)


@query("o_2_06_write_partitioned_report", sql("task shipment", """
    select shipping_city as city, hub, status, count(*) as attempts, 1::bigint as files from task join shipment using (awb) group by all"""))
def write_partitioned_report(spark, sf):
    path = workdir(spark)
    rows = bind(spark, sf, "task").join(bind(spark, sf, "shipment").select("awb", "shipping_city", "hub"), "awb")
    report = rows.groupBy(F.col("shipping_city").alias("city"), "hub", "status").agg(F.count(F.lit(1)).alias("attempts"))
    writers.write_partitioned_report(report, path)
    back = spark.read.schema("status string, attempts long, city string, hub string").option("header", True).csv(path)
    named = back.withColumn("file", F.input_file_name())
    files = named.groupBy("city", "hub").agg(F.count_distinct("file").alias("files"))
    return named.drop("file").join(files, ["city", "hub"])


@query("o_2_07_ctas_reordered", sql("shipment", "select shipping_city, hub, awb, user_name from shipment"))
def ctas_reordered(spark, sf):
    return writers.ctas_reordered(bind(spark, sf, "shipment"), f"{workdir(spark)}/reordered",
                                  ["shipping_city", "hub", "awb", "user_name"], ["shipping_city", "hub"])

"""Queries for pick-one, runs and windows (O-4, O-7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bindings import bind, run, sql
from catalog.registry import query, with_hot_keys
from haulmark.operators import pick
from haulmark.operators.attempts import attempt_rank, order_type
from haulmark.operators.ordered import lag, running
from haulmark.operators.tracking import last_known_location, normalise_status


@query("o_4_01_distinct_on_first", sql("task", """
    select distinct on (awb) awb, task_id, status, dispatch_time from task order by awb, dispatch_time desc, task_id"""))
def distinct_on(spark, sf):
    rows = bind(spark, sf, "task").select("awb", "task_id", "status", "dispatch_time")
    return pick.distinct_on(rows, ["awb"], [F.desc("dispatch_time"), F.asc("task_id")])


@query("o_4_02_distinct_on_any", sql("task", "select distinct on (rider_id) rider_id, task_id, awb from task order by rider_id, task_id"))
def distinct_on_any(spark, sf):
    return pick.distinct_on(bind(spark, sf, "task").select("rider_id", "task_id", "awb"), ["rider_id"], ["task_id"])


@query("o_4_03_latest_by_sequence", sql("scan", """
    select shipment_id, shipment_status, location, update_time from scan
    qualify row_number() over (partition by shipment_id order by tracking_id desc) = 1"""))
def latest_by_sequence(spark, sf):
    return pick.latest_value(bind(spark, sf, "scan"), ["shipment_id"], ["shipment_status", "location", "update_time"], ["tracking_id"])


@query("o_4_04_keep_argmax", sql("task", """
    select awb, task_id, dispatch_time from task
    qualify row_number() over (partition by awb order by dispatch_time desc, task_id) = 1"""))
def keep_argmax(spark, sf):
    return pick.keep_argmax(bind(spark, sf, "task").select("awb", "task_id", "dispatch_time"), ["awb"], "dispatch_time", "task_id")


@query("o_4_05_distinct_rows", sql("task", "select distinct awb, status, rider_id from task"))
def distinct_rows(spark, sf):
    return pick.distinct_rows(bind(spark, sf, "task"), ["awb", "status", "rider_id"])


@query("o_4_06_collapse_runs", sql("scan", """
    select tracking_id, shipment_id, shipment_status, update_time from (
      select *, lag(shipment_status) over (partition by shipment_id order by update_time, tracking_id) as before
      from (select tracking_id, shipment_id, update_time, case shipment_status when 'Out For Delivery' then 'Out for Delivery'
        else 'Failed Delivered' end as shipment_status from scan where shipment_status in ('Out For Delivery', 'Failed Delivery')) s) t
    where before is null or before <> shipment_status"""))
def collapse_runs(spark, sf, hot="auto"):
    from haulmark.operators.tracking import delivery_runs
    return delivery_runs(normalise_status(bind(spark, sf, "scan")), hot=hot).select("tracking_id", "shipment_id", "shipment_status", "update_time")


with_hot_keys("o_4_06_collapse_runs", collapse_runs, 40)


@query("o_4_07_max_dims", sql("weight", """
    select awb as shipment_awb, max(length * breadth * height) as dwh_volume, max(weight) as dwh_weight from weight group by awb"""))
def max_dims(spark, sf):
    return pick.max_dims(bind(spark, sf, "weight").withColumnRenamed("awb", "shipment_awb"))


RANKED = "select task_id, awb, status, dispatch_time, rank() over (partition by awb order by dispatch_time nulls last) as attempt_number from task"


@query("o_7_01_attempt_rank", sql("task", f"select task_id, awb, cast(attempt_number as int) as attempt_number from ({RANKED}) r"))
def ranks(spark, sf, hot="auto"):
    return attempt_rank(bind(spark, sf, "task").select("task_id", "awb", "dispatch_time"), hot=hot).select("task_id", "awb", "attempt_number")


with_hot_keys("o_7_01_attempt_rank", ranks, 16)


# A third of the attempts name no parcel and have one moment or none.
ONE_MOMENT = """select task_id, case when task_id % 3 = 0 then null else awb end as awb,
  case when task_id % 6 = 0 then null when task_id % 3 = 0 then timestamp '1998-01-01 00:00:00' else dispatch_time end as dispatch_time from task"""


@query("o_7_01_attempt_rank_one_moment", sql("task", f"""
    select task_id, cast(rank() over (partition by awb order by dispatch_time nulls last) as int) as attempt_number from ({ONE_MOMENT}) t"""))
def ranks_of_one_moment(spark, sf):
    """Equal and missing times of one key are cut like any other stretch of its order."""
    bind(spark, sf, "task").createOrReplaceTempView("task")
    return attempt_rank(run(spark, ONE_MOMENT), hot=60).select("task_id", "attempt_number")


@query("o_7_02_order_type", sql("task", f"select task_id, case when attempt_number = 1 then 'Fresh' else 'Reattempt' end as order_type from ({RANKED}) r"))
def order_types(spark, sf):
    return order_type(attempt_rank(bind(spark, sf, "task").select("task_id", "awb", "dispatch_time"))).select("task_id", "order_type")


@query("o_7_03_rank_desc_top", sql("task", """
    select rider_id, task_id, dispatch_time from task qualify rank() over (partition by rider_id order by dispatch_time desc) = 1"""))
def rank_desc_top(spark, sf):
    return pick.rank_top(bind(spark, sf, "task").select("rider_id", "task_id", "dispatch_time"), ["rider_id"], [F.desc_nulls_first("dispatch_time")])


@query("o_7_04_row_number_topk", sql("task", """
    select rider_id, task_id, cast(row_number() over (partition by rider_id order by dispatch_time, task_id) as int) as rn from task qualify rn <= 10"""))
def row_number_topk(spark, sf):
    return pick.top_k(bind(spark, sf, "task").select("rider_id", "task_id", "dispatch_time"), ["rider_id"], ["dispatch_time", "task_id"], 10).drop("dispatch_time")


@query("o_7_05_lag", sql("scan", """
    select tracking_id, lag(shipment_status) over (partition by shipment_id order by update_time, tracking_id) as prev_status from scan"""))
def lag_status(spark, sf, hot="auto"):
    rows = bind(spark, sf, "scan").select("tracking_id", "shipment_id", "shipment_status", "update_time")
    return running(rows, ["shipment_id"], "update_time", ["tracking_id"], hot=hot, prev_status=lag("shipment_status")).select("tracking_id", "prev_status")


with_hot_keys("o_7_05_lag", lag_status, 40)


@query("o_7_06_last_value", sql("task", """
    select awb, max_by(rider_id, struct_pack(dispatch_time, task_id)) as last_rider from task group by awb"""))
def last_value(spark, sf):
    return pick.latest_value(bind(spark, sf, "task"), ["awb"], ["rider_id"], ["dispatch_time", "task_id"]).withColumnRenamed("rider_id", "last_rider")


@query("o_7_07_window_after_filter", sql("task", """
    select task_id, cast(rank() over (partition by awb order by dispatch_time) as int) as attempt_number
    from task where dispatch_time >= timestamp '1998-01-01' and dispatch_time < timestamp '2000-01-01'"""))
def window_after_filter(spark, sf):
    rows = bind(spark, sf, "task").select("task_id", "awb", "dispatch_time").filter(
        "dispatch_time >= timestamp_ntz '1998-01-01' and dispatch_time < timestamp_ntz '2000-01-01'")
    return attempt_rank(rows).select("task_id", "attempt_number")

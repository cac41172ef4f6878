"""Incremental, streaming and mutation queries (O-11, O-12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bindings import BINDINGS, bind, cents, run, sql
from catalog.q_tracking import ALL_MILESTONES, CANON
from catalog.registry import AS_OF_SCAN, AS_OF_TASK, query, workdir
from haulmark.functions import clock
from haulmark.operators import cohort, mutate, report
from haulmark.operators.payout import PAYOUT_TOTALS
from haulmark.operators.tracking import MILESTONE_COLUMNS, tracking_events
from haulmark.session import written
from haulmark.sources import readers
from haulmark.streaming import incremental, layout, streams

FULL = "with c as (" + CANON.format(log="scan_wide") + f"), {ALL_MILESTONES}"


@query("o_11_01_incremental_recompute", sql("scan_wide", FULL))
def incremental_recompute(spark, sf):
    """State of the 20th brought to the end of the month; it must equal a full computation."""
    log = bind(spark, sf, "scan_wide")
    stored = tracking_events(log.filter("update_time < timestamp_ntz '2024-01-20'"))
    return incremental.incremental_recompute(stored, log, tracking_events, "shipment_id", ["update_time"], "2024-01-31", hours=11 * 24)


BUCKETS = 64


@query("o_11_01_refresh_partitions", sql("scan_wide", """
    with k as (select shipment_id, bool_or(update_time >= timestamp '2024-01-31' - interval 1 hour) as changed from scan_wide group by 1)
    select count(*) as shipments, true as equals_full, true as others_untouched, true as some_untouched from k"""))
def refresh_partitions(spark, sf):
    """One hour of changes against a stored table: only the partitions of changed keys get new files."""
    folder = workdir(spark)
    target, store = f"{folder}/milestones", f"{folder}/log"
    log = bind(spark, sf, "scan_wide")
    incremental.write_buckets(log, store, "shipment_id", BUCKETS)
    incremental.write_buckets(tracking_events(log.filter("update_time < timestamp_ntz '2024-01-30 23:00:00'")), target, "shipment_id", BUCKETS)

    def files():
        return spark.read.parquet(target).select("bucket", F.input_file_name().alias("file")).distinct()

    before = written(files(), "before")
    touched = incremental.refresh_partitions(spark, target, store, tracking_events, "shipment_id", ["update_time"], "2024-01-31", hours=1)
    gone = before.join(files(), ["bucket", "file"], "left_anti").select("bucket").distinct()
    full, now = tracking_events(log), spark.read.parquet(target).drop("bucket").select(*MILESTONE_COLUMNS)
    same = full.exceptAll(now).isEmpty() and now.exceptAll(full).isEmpty()
    return now.agg(F.count(F.lit(1)).alias("shipments")).withColumns({
        "equals_full": F.lit(same), "others_untouched": F.lit(gone.filter(~F.col("bucket").isin(touched)).isEmpty()),
        "some_untouched": F.lit(len(touched) < BUCKETS)})


# Three scans of a parcel within 16 days of its order, in the order of their times.
PARCEL_LOG = """select o_orderkey as parcel, k as step, o_orderdate + (k * (o_orderkey % 9)) * interval '1' day as seen
  from orders join (values (0), (1), (2)) v(k) on true"""
PARCEL_END, PARCEL_HOURS = "2001-08-10", 20 * 24


def parcel_state(log):
    return log.groupBy("parcel").agg(F.min("seen").alias("first_seen"), F.max("seen").alias("last_seen"), F.count(F.lit(1)).alias("scans"))


@query("o_11_01_refresh_by_home", sql("", f"""
    with log as ({PARCEL_LOG}), k as (select parcel, date_trunc('month', min(seen)) as home,
        max(seen) >= timestamp '{PARCEL_END}' - interval {PARCEL_HOURS} hour as changed from log group by 1)
    select count(*) as parcels, count(*) filter (changed) as changed, count(distinct home) as partitions, count(distinct home) filter (changed) as rewritten,
      true as equals_full, true as others_untouched from k"""))
def refresh_by_home(spark, sf):
    """Twenty days of changes, more keys than there are partitions: the two or three newest months are rewritten."""
    folder = workdir(spark)
    bind(spark, sf, "orders")
    log = run(spark, PARCEL_LOG)
    since = F.lit(PARCEL_END).cast("timestamp_ntz") - F.expr(f"interval '{PARCEL_HOURS}' hour")
    layout.append(spark, folder, log.filter(F.col("seen") < "1999-01-01"), "parcel", "seen", 0, "month")
    layout.append(spark, folder, log.filter((F.col("seen") >= "1999-01-01") & (F.col("seen") < since)), "parcel", "seen", 1, "month")
    layout.build(spark, folder, parcel_state, "parcel")
    layout.append(spark, folder, log.filter(F.col("seen") >= since), "parcel", "seen", 2, "month")

    def files():
        return layout.read_table(spark, folder).select("home", F.input_file_name().alias("file")).distinct()

    before = written(files(), "before")
    homes = layout.refresh(spark, folder, parcel_state, "parcel", ["seen"], PARCEL_END, PARCEL_HOURS)
    gone = before.join(files(), ["home", "file"], "left_anti").select("home").distinct()
    full, now = parcel_state(log), layout.read_table(spark, folder)
    stored = now.select(*full.columns)
    same = full.exceptAll(stored).isEmpty() and stored.exceptAll(full).isEmpty()
    changed = readers.changed_keys(log, "parcel", ["seen"], PARCEL_END, PARCEL_HOURS).count()
    return now.agg(F.count(F.lit(1)).alias("parcels"), F.count_distinct("home").alias("partitions")).withColumns({
        "changed": F.lit(changed), "rewritten": F.lit(len(homes)), "equals_full": F.lit(same),
        "others_untouched": F.lit(gone.filter(~F.col("home").isin(homes)).isEmpty())})


SPEC = {"picked": ("min", "Picked-up"), "last_out": ("max", "Out For Delivery"), "delivered": ("min", "Delivered")}


def stream_spec():
    return {n: (how, F.col("shipment_status") == s) for n, (how, s) in SPEC.items()}


RECEIVED = "update_time + (tracking_id % 5) * interval '1' hour"


def out_of_order(spark, sf, folder):
    """The status log as a stream of two files: the later half of the month comes first."""
    events = bind(spark, sf, "events")
    late = F.col("ts") >= F.expr("timestamp_ntz '2024-01-16'")
    for part in (late, ~late):
        events.filter(part).coalesce(1).write.mode("append").parquet(f"{folder}/log")
    spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/log").createOrReplaceTempView("events_stream")
    df = spark.sql(BINDINGS["scan"].replace("from events", "from events_stream")).withColumn("received", F.expr(RECEIVED))
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ("update_time", "received")})


MILESTONES = sql("scan", "select shipment_id, " + ", ".join(
    f"{how}(update_time) filter (shipment_status = '{s}') as {n}" for n, (how, s) in SPEC.items()) + " from scan group by 1")


def plain_times(df):
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in SPEC})


@query("o_11_02_stream_milestones", MILESTONES)
def stream_milestones(spark, sf):
    """State with expiry: a stretch outlasts the lateness of the log."""
    folder = workdir(spark)
    table = f"{folder}/milestones"
    out = streams.stream_milestones(out_of_order(spark, sf, folder), "shipment_id", "update_time", stream_spec(), expire="40 days")
    streams.run_available(out, f"{folder}/checkpoint", "update", each=streams.milestone_sink(table))
    return plain_times(streams.read_milestones(spark, table, "shipment_id", stream_spec()))


@query("o_11_02_stream_milestones_batches", MILESTONES)
def stream_milestone_batches(spark, sf):
    """No state; batches are folded after every second one."""
    folder = workdir(spark)
    table = f"{folder}/milestones"
    sink = streams.milestone_batches(table, "shipment_id", "update_time", stream_spec(), compact_every=2)
    streams.run_available(out_of_order(spark, sf, folder), f"{folder}/checkpoint", each=sink)
    return plain_times(streams.read_milestones(spark, table, "shipment_id", stream_spec()))


@query("o_11_03_stream_daily_counts", sql("scan", """
    select date_trunc('day', update_time)::timestamp as day, shipment_status, count(*) as scans, count(distinct shipment_id) as shipments from scan group by 1, 2"""))
def stream_daily_counts(spark, sf):
    folder = workdir(spark)
    sink = streams.daily_sink(f"{folder}/daily", ["shipment_status"], "update_time", "shipment_id")
    streams.run_available(out_of_order(spark, sf, folder), f"{folder}/checkpoint", each=sink)
    out = streams.read_daily_counts(spark, f"{folder}/daily", ["shipment_status"], "shipment_id").drop("exact")
    return out.withColumn("day", F.col("day").cast("timestamp_ntz"))


@query("o_11_03_stream_daily_counts_lots", sql("scan", """
    select date_trunc('day', update_time)::timestamp as day, shipment_status, count(*) as scans, true as close,
      count(distinct case when tracking_id % 3 = 0 then 0 when update_time >= timestamp '2024-01-16' then 1 else 2 end) = 1
        or min(date_trunc('day', update_time)) >= (select date_trunc('day', max(update_time)) - interval 2 day from scan) as exact from scan group by 1, 2"""))
def stream_daily_counts_lots(spark, sf):
    """A third of the scans come again and again too late: closed days of several lots are estimated, within 3 %."""
    folder = workdir(spark)
    log = bind(spark, sf, "scan").withColumn("update_time", F.col("update_time").cast("timestamp"))
    early = F.col("update_time") < F.lit("2024-01-16").cast("timestamp_ntz").cast("timestamp")
    third = F.col("tracking_id") % 3 == 0
    sink = streams.daily_sink(f"{folder}/daily", ["shipment_status"], "update_time", "shipment_id", fan=2)
    for i, part in enumerate((~third & ~early, ~third & early, third)):
        sink(log.filter(part), i)
    counted = streams.read_daily_counts(spark, f"{folder}/daily", ["shipment_status"], "shipment_id")
    right = streams.daily_counts(log, ["shipment_status"], "update_time", "shipment_id").withColumnRenamed("shipments", "right").drop("scans")
    close = F.abs(F.col("shipments") - F.col("right")) <= F.greatest(F.lit(0.03) * F.col("right"), F.when(F.col("exact"), 0).otherwise(1))
    return (counted.join(right, ["day", "shipment_status"], "left")
            .select(F.col("day").cast("timestamp_ntz").alias("day"), "shipment_status", "scans", F.coalesce(close, F.lit(False)).alias("close"), "exact"))


def changed_keys_folder(spark, sf, horizon=None):
    folder = workdir(spark)
    sink = streams.changed_keys_sink(f"{folder}/keys", "shipment_id", ["update_time", "received"], horizon)
    streams.run_available(out_of_order(spark, sf, folder), f"{folder}/checkpoint", each=sink)
    return f"{folder}/keys"


@query("o_11_04_stream_changed_keys", sql("scan", f"select shipment_id, max(greatest(update_time, {RECEIVED})) as touched_at from scan group by 1"))
def stream_changed_keys(spark, sf):
    return streams.read_changed_keys(spark, changed_keys_folder(spark, sf), "shipment_id")


@query("o_11_04_stream_changed_keys_lookback", sql("scan", f"""
    select distinct shipment_id from scan where update_time >= timestamp '{AS_OF_SCAN}' - interval 4 hour or {RECEIVED} >= timestamp '{AS_OF_SCAN}' - interval 4 hour"""))
def stream_changed_keys_lookback(spark, sf):
    """The default look-back, on either time."""
    return streams.read_changed_keys(spark, changed_keys_folder(spark, sf), "shipment_id", AS_OF_SCAN).select("shipment_id")


@query("o_11_04_stream_changed_keys_expiring", sql("scan", f"""
    with t as (select shipment_id, greatest(update_time, {RECEIVED}) as touched_at, update_time < timestamp '2024-01-16' as early from scan),
      k as (select shipment_id, early, max(touched_at) as touched_at, count(*) as scans from t group by 1, 2),
      c as (select max(touched_at) - interval 10 day as cut from t),
      late as (select count(*) as late_keys, sum(scans) as late_scans from k, c where touched_at < cut)
    select shipment_id, max(touched_at) as touched_at, any_value(late_keys) as late_keys, any_value(late_scans)::bigint as late_scans
    from k, c, late where touched_at >= cut group by 1"""))
def stream_changed_keys_expiring(spark, sf):
    """What was touched in the last ten days; the second, older file is counted as late."""
    folder = changed_keys_folder(spark, sf, "10 days")
    late = streams.late_changes(spark, folder)
    return streams.read_changed_keys(spark, folder, "shipment_id").withColumns({k: F.lit(v).cast("long") for k, v in late.items()})


TRIPS = "select task_id as trip_id, awb, status, dispatch_time as start_at, case when status <> 'ONGOING' then dispatch_time + interval '9' hour end as closed_at from task"
LINKS = "select l_orderkey as trip_id, l_orderkey * 10 + l_linenumber as transaction_id from lineitem group by l_orderkey, l_linenumber"
TRACKER = "select l_orderkey * 10 + l_linenumber as transaction_id, max(l_shipdate) as created_at from lineitem group by l_orderkey, l_linenumber"


@query("o_11_05_lookback_extract", sql("task", f"""
    with p as (select trip_id, max(created_at) as transaction_created_at from ({LINKS}) l left join ({TRACKER}) k using (transaction_id) group by 1),
      now as (select timestamp '{AS_OF_TASK} 00:00:00' - interval 720 hour as lo)
    select t.*, transaction_created_at from ({TRIPS}) t left join p using (trip_id), now where start_at >= lo or closed_at >= lo or transaction_created_at >= lo"""))
def lookback_extract(spark, sf):
    bind(spark, sf, "lineitem")
    bind(spark, sf, "task").createOrReplaceTempView("task")
    return readers.lookback_extract(run(spark, TRIPS), run(spark, LINKS), run(spark, TRACKER), AS_OF_TASK, hours=720)


# ---------------------------------------------------------------- O-12
# Stored state: attempts up to 1999, all still open. Change set: attempts from 1999 on, with their outcome.
STORED = "select task_id, awb, 'ONGOING' as status, cod_amount, cancellation_remarks as note from task where dispatch_time < timestamp '2000-01-01 00:00:00'"
CHANGES = "select task_id, awb, status, cod_amount + 1 as cod_amount, cast(null as varchar(10)) as note from task where dispatch_time >= timestamp '1999-01-01 00:00:00'"


def stored_and_changes(spark, sf):
    bind(spark, sf, "task").createOrReplaceTempView("task")
    return run(spark, STORED), run(spark, CHANGES)


def upsert_sql(take: str = "true", note: str = "s.note") -> str:
    pick = "case when t.task_id is null or (s.task_id is not null and ({})) then {} else {} end as {}"
    columns = [pick.format(take, f"s.{c}" if c != "note" else note, f"t.{c}", c) for c in ("task_id", "awb", "status", "cod_amount", "note")]
    return sql("task", f"select {', '.join(columns)} from ({STORED}) t full join ({CHANGES}) s on t.task_id = s.task_id")


@query("o_12_01_upsert", upsert_sql())
def upsert(spark, sf):
    stored, changes = stored_and_changes(spark, sf)
    return mutate.upsert(stored, changes, ["task_id"])


@query("o_12_01_upsert_conditional", upsert_sql("s.status = 'COMPLETED' and s.cod_amount > t.cod_amount + 0.5"))
def upsert_conditional(spark, sf):
    stored, changes = stored_and_changes(spark, sf)
    return mutate.upsert(stored, changes, ["task_id"], (F.col("s.status") == "COMPLETED") & (F.col("s.cod_amount") > F.col("t.cod_amount") + 0.5))


@query("o_12_01_upsert_do_nothing", upsert_sql("false"))
def upsert_do_nothing(spark, sf):
    stored, changes = stored_and_changes(spark, sf)
    return mutate.upsert(stored, changes, ["task_id"], update=False)


@query("o_12_01_upsert_exclude", upsert_sql("true", "t.note"))
def upsert_exclude(spark, sf):
    stored, changes = stored_and_changes(spark, sf)
    return mutate.upsert(stored, changes, ["task_id"], exclude=["note"])


@query("o_12_02_update_where", sql("task", """
    select task_id, case when dispatch_time < timestamp '1998-01-01' and status = 'ONGOING' then 'CLOSED' else status end as status from task"""))
def update_where(spark, sf):
    old = (F.col("dispatch_time") < clock.moment("1998-01-01")) & (F.col("status") == "ONGOING")
    return mutate.update_where(bind(spark, sf, "task"), old, {"status": "CLOSED"}).select("task_id", "status")


@query("o_12_02_update_returning", sql("task", "select task_id, awb, 'CLOSED' as status from task where dispatch_time < timestamp '1998-01-01' and status = 'ONGOING'"))
def update_returning(spark, sf):
    old = (F.col("dispatch_time") < clock.moment("1998-01-01")) & (F.col("status") == "ONGOING")
    return mutate.updated_rows(bind(spark, sf, "task").select("task_id", "awb", "status", "dispatch_time"), old, {"status": "CLOSED"}).drop("dispatch_time")


@query("o_12_03_update_from", sql("task", """
    select t.task_id, t.awb, case when s.awb is not null then s.top else t.cod_amount end as cod_amount from task t
    left join (select awb, max(cod_amount) as top from task where status = 'COMPLETED' group by 1) s on s.awb = t.awb"""))
def update_from(spark, sf):
    task = bind(spark, sf, "task").select("task_id", "awb", "status", "cod_amount")
    top = task.filter("status = 'COMPLETED'").groupBy("awb").agg(F.max("cod_amount").alias("cod_amount"))
    return mutate.update_from(task.drop("status"), top, ["awb"], ["cod_amount"])


PARTS = ["order_base_0_pay", "order_base_3000_pay", "order_base_5000_pay", "order_slot_0_12_pay", "order_slot_12_15_pay", "order_slot_15_24_pay", "pincode_rate_pay", "fasr_pay",
         "mg_payed", "fixed_pay", "fixed_milestone_pay"]


@query("o_12_04_recompute_totals", sql("task", f"""
    with p as (select task_id, {', '.join(f"cast(task_id % {7 + i} as double) as {c}" for i, c in enumerate(PARTS))} from task)
    select *, {' + '.join(PARTS[:9])} as order_subtotal, {' + '.join(PARTS)} as total_pay from p"""))
def recompute_totals(spark, sf):
    rows = bind(spark, sf, "task").select("task_id", *[(F.col("task_id") % (7 + i)).cast("double").alias(c) for i, c in enumerate(PARTS)])
    return mutate.recompute_totals(rows, PAYOUT_TOTALS)


@query("o_12_05_delete_where", sql("task", "select task_id, status, cancellation_remarks from task where not coalesce(cancellation_remarks = 'customer not home' and status = 'CANCELLED', false)"))
def delete_where(spark, sf):
    rows = bind(spark, sf, "task").select("task_id", "status", "cancellation_remarks")
    return mutate.delete_where(rows, (F.col("cancellation_remarks") == "customer not home") & (F.col("status") == "CANCELLED"))


# Cohort rows: one per rider and week with attempts.
COHORT = """select concat(cast(w as varchar(10)), '-', cast(t.rider_id as varchar(6))) as key, w as pip_date, t.rider_id, c.rider_name, c.hub, c.city as shipping_city,
  case when w < date '1998-01-05' then 'closed' else 'running' end as pip_status, case when n >= 4 then 'passed' when n = 1 then 'failed' else '' end as pip_result, concat('attempts ', cast(n as varchar(6))) as need_improvement
  from (select cast(dispatch_time as date) - cast(weekday(dispatch_time) as int) as w, rider_id, count(*) as n from task group by 1, 2) t join crew c on c.rider_id = t.rider_id"""
WEEK_DUCK = "cast(dispatch_time as date) - cast(isodow(dispatch_time) - 1 as int) as w"
COHORT_DUCK = COHORT.replace("cast(dispatch_time as date) - cast(weekday(dispatch_time) as int) as w", WEEK_DUCK)


def cohort_rows(spark, sf):
    for name in ("task", "crew"):
        bind(spark, sf, name).createOrReplaceTempView(name)
    return run(spark, COHORT.replace("cast(dispatch_time as date) - cast(weekday(dispatch_time) as int) as w", "date_sub(cast(dispatch_time as date), weekday(dispatch_time)) as w"))


@query("o_12_06_cohort_lifecycle", sql("task crew", f"""
    with c as ({COHORT_DUCK}), k as (select * replace (case when pip_date = date '1998-01-05' then 'closed' else pip_status end as pip_status) from c),
      f as (select * replace (case when pip_status = 'closed' then 'final' else pip_status end as pip_status) from k)
    select * from f where not (pip_status = 'running' and rider_id in (select rider_id from f where pip_status = 'final' and pip_result = 'failed'))"""))
def cohort_lifecycle(spark, sf):
    return cohort.finalise(cohort.close_week(cohort_rows(spark, sf), "1998-01-07"))


@query("o_12_07_evolve_schema", sql("shipment", "select shipping_city, awb, cast(shipment_id as varchar) as shipment_id, user_name as client from shipment"))
def evolve_schema(spark, sf):
    rows = bind(spark, sf, "shipment").select("shipment_id", "awb", "user_name", "shipping_city")
    return mutate.evolve_schema(rows, {"user_name": "client"}, {"shipment_id": "string"}, ["shipping_city", "awb", "shipment_id", "client"])


# Contract rates per client and city.
RATES = """select distinct user_id, case city when 'Jaipur' then 'Delhi' else city end as city, cast(user_id % 7 as double) + 20 as forward_rpo, 0.25::double as rto_multiplier,
  case when user_id % 2 = 0 then 'Yes' else 'No' end as cod_charge from shipment where user_id % 4 <> 1"""
BILLED = """select t.task_id as awb, s.user_id, s.user_name, s.city as shipping_city, case t.status when 'COMPLETED' then 'Delivered' when 'CANCELLED' then 'RTO Delivered' else 'In-Transit' end as shipment_status,
  cod_amount / 100 as final_total_charges, cast(t.task_id % 40 as double) as finops_cod_charge from task t join shipment s on s.awb = t.awb"""


@query("p_21_revenue_correction", sql("task shipment", f"""
    with r as ({RATES}), b as ({BILLED}), a as (select awb, case shipment_status when 'Delivered' then forward_rpo + case when cod_charge = 'Yes' then finops_cod_charge else 0 end
      when 'RTO Delivered' then forward_rpo * (rto_multiplier + 1) else 0 end as actual from b join r on r.user_id = b.user_id and r.city = case b.shipping_city when 'NCR' then 'Delhi' else b.shipping_city end)
    select b.awb, b.user_id, b.shipping_city, b.shipment_status, coalesce(actual, final_total_charges) as final_total_charges from b left join a using (awb)"""))
def revenue_correction(spark, sf):
    for name in ("task", "shipment"):
        bind(spark, sf, name).createOrReplaceTempView(name)
    billed, rates = run(spark, BILLED), run(spark, RATES.replace("0.25::double", "cast(0.25 as double)"))
    actual = report.actual_charges(billed, rates).select("awb", F.col("actual_charges").alias("final_total_charges"))
    return mutate.update_from(billed, actual, ["awb"], ["final_total_charges"]).drop("user_name", "finops_cod_charge")

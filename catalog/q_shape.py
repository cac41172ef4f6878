"""Queries for projection, filters, sets, ordering and scalars (O-3, O-8, O-9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bindings import bind, cents, sql
from catalog.registry import AS_OF_TASK, query
from haulmark import rules
from haulmark.functions import clock, lookup, numbers, text
from haulmark.operators import sets, shape


@query("o_3_01_project", sql("task", "select task_id as attempt, awb, cod_amount, cod_amount > 0 as is_cod from task"))
def project(spark, sf):
    return shape.project(bind(spark, sf, "task"), ["task_id", "awb", "cod_amount", "status"], {"task_id": "attempt"},
                         {"is_cod": F.col("cod_amount") > 0}, drop=["status"])


@query("o_3_02_decode", sql("shipment", """
    select awb, shipper_id, case shipper_id when 2 then 'Delhivery' when 301 then 'Hyperlocal' when 1001 then 'B2B' end as shipping_partner,
      case when shipment_status = 'RTO Freeze' then case when shipper_id = 301 then 'RTO' else 'SND' end
        else case shipment_status when 'Delivered' then 'DL' when 'Reached Nearest Hub' then 'IN' when 'Out for Delivery' then 'OFD'
          when 'Failed Delivered' then 'ND' when 'RTO Out for Delivery' then 'RTO OFD' when 'Lost' then 'LT' when 'Picked-up' then 'IN'
          when 'NDR Initiated' then 'NDR' when 'RTO Delivered' then 'RTO DL' when 'Cancelled' then 'CN' else 'SND' end end as gs_status
    from shipment"""))
def decode(spark, sf):
    from haulmark.plans.ops import carrier_name, short_status
    return bind(spark, sf, "shipment").select("awb", "shipper_id", carrier_name(F.col("shipper_id")).alias("shipping_partner"),
                                              short_status().alias("gs_status"))


@query("o_3_03_canonicalise", sql("shipment", """
    select awb, case when warehouse_city = 'NCR' then 'Delhi' else warehouse_city end as warehouse_city,
      case when hub like '%ATION_1%' then 'ones' else hub end as hub from shipment"""))
def canonicalise(spark, sf):
    return bind(spark, sf, "shipment").select("awb", lookup.canonical("warehouse_city", rules.MERGED_CITIES).alias("warehouse_city"),
                                              lookup.canonical("hub", {}, {"ATION_1": "ones"}).alias("hub"))


@query("o_3_04_case_when", sql("task", """
    select task_id, case when status = 'COMPLETED' and cod_amount = 0 then 'prepaid done' when status = 'COMPLETED' then 'cod done'
      when status = 'CANCELLED' then case when cod_amount > 200000 then 'big loss' else 'loss' end end as outcome from task"""))
def case_when(spark, sf):
    done, lost = F.col("status") == "COMPLETED", F.col("status") == "CANCELLED"
    return bind(spark, sf, "task").select("task_id", lookup.first_match([
        (done & (F.col("cod_amount") == 0), "prepaid done"), (done, "cod done"),
        (lost, F.when(F.col("cod_amount") > 200000, "big loss").otherwise("loss"))]).alias("outcome"))


@query("o_3_05_compound_filter", sql("task", """
    select task_id, awb from task where (status in ('COMPLETED', 'CANCELLED') or cod_amount between 1000 and 50000)
      and pincode not in (1, 2, 3) and cancellation_remarks is not null and status <> 'ONGOING'
      and dispatch_time >= timestamp '1996-01-01' and dispatch_time < timestamp '2001-01-01'"""))
def compound_filter(spark, sf):
    return bind(spark, sf, "task").filter(
        (F.col("status").isin("COMPLETED", "CANCELLED") | F.col("cod_amount").between(1000, 50000))
        & ~F.col("pincode").isin(1, 2, 3) & F.col("cancellation_remarks").isNotNull() & (F.col("status") != "ONGOING")
        & (F.col("dispatch_time") >= clock.moment("1996-01-01")) & (F.col("dispatch_time") < clock.moment("2001-01-01"))
    ).select("task_id", "awb")


@query("o_3_06_pattern_predicate", sql("task shipment", """
    select task_id, lower(cancellation_remarks) like '%wrong address%' as wrong, cancellation_remarks not like 'customer%' as other
    from task join shipment using (awb) where hub like 'NATION_1%'"""))
def pattern_predicate(spark, sf):
    rows = bind(spark, sf, "task").join(bind(spark, sf, "shipment").select("awb", "hub"), "awb")
    remark = F.col("cancellation_remarks")
    return rows.filter(F.col("hub").like("NATION_1%")).select(
        "task_id", remark.ilike("%wrong address%").alias("wrong"), (~remark.like("customer%")).alias("other"))


@query("o_3_07_conditional_predicate", sql("task", f"""
    select task_id, dispatch_time from task
    where case when cancellation_remarks is null then true else cod_amount >= 1000 end
      and date_trunc('day', dispatch_time) <= timestamp '{AS_OF_TASK} 00:00:00' - interval 1 day"""))
def conditional_predicate(spark, sf):
    now = clock.moment(f"{AS_OF_TASK} 21:00:00")
    last_day = F.when(clock.hour(now) < 22, clock.plus(clock.day(now), days=-1)).otherwise(clock.day(now))
    open_or_big = F.when(F.col("cancellation_remarks").isNull(), F.lit(True)).otherwise(F.col("cod_amount") >= 1000)
    return bind(spark, sf, "task").filter(open_or_big & (clock.day("dispatch_time") <= last_day)).select("task_id", "dispatch_time")


@query("o_3_08_mask_update", sql("task", """
    select task_id, case when status = 'CANCELLED' then 0 else cod_amount end as cod_amount,
      case when status = 'CANCELLED' then 'none' else cancellation_remarks end as cancellation_remarks from task"""))
def mask_update(spark, sf):
    return shape.mask_update(bind(spark, sf, "task"), F.col("status") == "CANCELLED",
                             {"cod_amount": 0.0, "cancellation_remarks": "none"}).select("task_id", "cod_amount", "cancellation_remarks")


@query("o_3_09_null_handling", sql("scan_wide", """
    select tracking_id, location, shipment_status, false as filled from scan_wide where location is not null and shipment_status is not null
    union all select tracking_id, coalesce(location, ''), coalesce(shipment_status, ''), true from scan_wide
      where location is null or shipment_status is null"""))
def null_handling(spark, sf):
    rows = bind(spark, sf, "scan_wide").select("tracking_id", "location", "shipment_status")
    kept = shape.drop_any_null(rows).withColumn("filled", F.lit(False))
    holes = rows.filter(F.col("location").isNull() | F.col("shipment_status").isNull())
    return kept.unionByName(shape.fill_null(holes, "").withColumn("filled", F.lit(True)))


@query("o_3_10_coalesce_from", sql("scan_wide", """
    select tracking_id, coalesce(location, 'no place') as location, coalesce(shipment_status, remark) as shipment_status from scan_wide"""))
def coalesce_from(spark, sf):
    rows = bind(spark, sf, "scan_wide").select("tracking_id", "location", "shipment_status", F.lit("no place").alias("location_fill"),
                                               F.col("remark").alias("shipment_status_fill"))
    return shape.coalesce_from(rows, ["location", "shipment_status"])


# ---------------------------------------------------------------- O-8
@query("o_8_01_multi_key_sort", sql("task", "select task_id, rider_id, status from task"))
def multi_key_sort(spark, sf):
    return sets.ordered(bind(spark, sf, "task").select("task_id", "rider_id", "status"), "rider_id", "-status", "task_id")


@query("o_8_02_custom_sort", sql("task shipment", f"""
    select shipping_city, count(*) as attempts from task join shipment using (awb) group by 1
    union all select 'Total', count(*) from task join shipment using (awb)"""))
def custom_sort(spark, sf):
    from haulmark.operators.aggregate import with_total
    rows = bind(spark, sf, "task").join(bind(spark, sf, "shipment").select("awb", "shipping_city"), "awb")
    return sets.label_first(with_total(rows, "shipping_city", {"attempts": F.count(F.lit(1))}), "shipping_city")


@query("o_8_03_head", sql("task", "select task_id, dispatch_time from task order by dispatch_time desc, task_id limit 5"))
def head(spark, sf):
    return sets.head(bind(spark, sf, "task").select("task_id", "dispatch_time"), 5, "-dispatch_time", "task_id")


@query("o_8_04_union_distinct", sql("task txn", "select awb, rider_id from task union select shipment_id, transaction_id % 97 from txn"))
def union_distinct(spark, sf):
    return sets.union_distinct(bind(spark, sf, "task").select("awb", "rider_id"),
                               bind(spark, sf, "txn").select(F.col("shipment_id").alias("awb"), (F.col("transaction_id") % 97).alias("rider_id")))


@query("o_8_05_union_all", sql("task txn", """
    select awb, rider_id, null::double as amount from task union all select shipment_id, null, amount from txn"""))
def union_all(spark, sf):
    return sets.union_all(bind(spark, sf, "task").select("awb", "rider_id"),
                          bind(spark, sf, "txn").select(F.col("shipment_id").alias("awb"), "amount"))


@query("o_8_06_null_padding", sql("task txn", """
    select awb, status, null::date as paid_on from task union all select shipment_id, null, cast(created_time as date) from txn"""))
def null_padding(spark, sf):
    left = sets.pad_nulls(bind(spark, sf, "task").select("awb", "status"), {"paid_on": "date"})
    right = sets.pad_nulls(bind(spark, sf, "txn").select(F.col("shipment_id").alias("awb"), F.col("created_time").cast("date").alias("paid_on")),
                           {"status": "string"})
    return sets.union_all(left, right.select(*left.columns))


# ---------------------------------------------------------------- O-9
@query("o_9_01_split_part", sql("scan shipment", """
    select tracking_id, split_part(location, '/', 2) as raw_part, trim(split_part(location, '>', 1)) as lane_from,
      split_part(remark, ' ', 4) as missing from scan"""))
def split_part(spark, sf):
    return bind(spark, sf, "scan").select("tracking_id", F.split_part("location", F.lit("/"), F.lit(2)).alias("raw_part"),
                                          text.part("location", ">", 1).alias("lane_from"),
                                          F.split_part("remark", F.lit(" "), F.lit(4)).alias("missing"))


@query("o_9_02_trim", sql("shipment", "select awb, trim(split_part(sort_code, '/', 2)) as hub, trim(concat('  ', user_name, ' ')) as user_name from shipment"))
def trim(spark, sf):
    return bind(spark, sf, "shipment").select("awb", text.part("sort_code", "/", 2).alias("hub"),
                                              F.trim(F.concat(F.lit("  "), "user_name", F.lit(" "))).alias("user_name"))


@query("o_9_03_substring", sql("shipment", """
    select awb, substring(sort_code, 1, 6) as from_zero, substring(sort_code, 9) as tail, substring(sort_code, 3, 4) as middle from shipment"""))
def substring(spark, sf):
    return bind(spark, sf, "shipment").select("awb", text.substring("sort_code", 0, 7).alias("from_zero"),
                                              text.substring("sort_code", 9).alias("tail"), text.substring("sort_code", 3, 4).alias("middle"))


@query("o_9_04_position", sql("scan", "select tracking_id, cast(position('>' in location) as int) as arrow, cast(position('purchase' in remark) as int) as bought from scan"))
def position(spark, sf):
    return bind(spark, sf, "scan").select("tracking_id", text.position("location", ">").alias("arrow"), text.position("remark", "purchase").alias("bought"))


@query("o_9_05_left", sql("scan", "select tracking_id, left(location, 3) as origin from scan"))
def left(spark, sf):
    return bind(spark, sf, "scan").select("tracking_id", F.left("location", F.lit(3)).alias("origin"))


@query("o_9_06_lower", sql("shipment", "select awb, lower(user_name) as user_name, lower(hub) as hub from shipment"))
def lower(spark, sf):
    return bind(spark, sf, "shipment").select("awb", F.lower("user_name").alias("user_name"), F.lower("hub").alias("hub"))


@query("o_9_07_replace", "select o_orderkey, replace(o_orderpriority, '-', '') as priority from orders")
def replace(spark, sf):
    return bind(spark, sf, "orders").select("o_orderkey", F.replace("o_orderpriority", F.lit("-"), F.lit("")).alias("priority"))


@query("o_9_08_concat", sql("scan_wide", """
    select tracking_id, concat(shipment_status, '-', location) as skipping, shipment_status || '-' || location as strict from scan_wide"""))
def concat(spark, sf):
    return bind(spark, sf, "scan_wide").select("tracking_id", text.join_skip_null("shipment_status", F.lit("-"), "location").alias("skipping"),
                                               text.join_strict("shipment_status", F.lit("-"), "location").alias("strict"))


@query("o_9_09_date_text", sql("task", """
    select task_id, strftime(dispatch_time, '%d/%m/%Y') as slashed, strftime(dispatch_time, '%Y%m%d') as compact,
      strftime(dispatch_time, '%Y-%m-%d') as iso from task"""))
def date_text(spark, sf):
    return bind(spark, sf, "task").select("task_id", text.date_text("dispatch_time", "dd/MM/yyyy").alias("slashed"),
                                          text.date_text("dispatch_time", "yyyyMMdd").alias("compact"), text.date_text("dispatch_time").alias("iso"))


@query("o_9_10_number_text", sql("task", r"""
    select task_id, lpad(cast(cast(cod_amount / 5000 as bigint) as varchar), 4, ' ') || '%' as share,
      '₹' || regexp_replace(case when length(n) <= 3 then n else
        reverse(regexp_replace(reverse(left(n, length(n) - 3)), '(\d\d)', '\1,', 'g')) || ',' || right(n, 3) end, '^,', '') as amount
    from (select task_id, cod_amount, cast(cast(round(cod_amount) as bigint) as varchar) as n from task) t"""))
def number_text(spark, sf):
    return bind(spark, sf, "task").select("task_id", text.percent_text(F.col("cod_amount") / 5000).alias("share"), text.rupees("cod_amount").alias("amount"))


@query("o_9_11_parse_time", sql("task", """
    select task_id, cast(dispatch_time as date) as from_text, date_trunc('second', dispatch_time) as moment,
      cast(date_trunc('month', dispatch_time) as date) as month_start from task"""))
def parse_time(spark, sf):
    d = F.col("dispatch_time")
    return bind(spark, sf, "task").select(
        "task_id", F.to_date(F.date_format(d, "yyyy-MM-dd"), "yyyy-MM-dd").alias("from_text"),
        text.parse_timestamp_text(F.date_format(d, "yyyy-MM-dd HH:mm:ss.SSS")).alias("moment"),
        text.month_start(F.date_format(d, "MMMM"), F.year(d)).alias("month_start"))


@query("o_9_12_date_trunc", sql("scan", """
    select tracking_id, date_trunc('day', update_time)::timestamp as d, date_trunc('week', update_time)::timestamp as w,
      date_trunc('month', update_time)::timestamp as m from scan"""))
def date_trunc(spark, sf):
    return bind(spark, sf, "scan").select("tracking_id", clock.day("update_time").alias("d"), clock.week("update_time").alias("w"), clock.month("update_time").alias("m"))


@query("o_9_13_extract", sql("scan", f"""
    select tracking_id, cast(hour(update_time) as int) as h, cast(day(update_time) as int) as d,
      epoch_us(timestamp '2024-02-01') // 1000000 - epoch_us(update_time) // 1000000 as seconds_left from scan"""))
def extract(spark, sf):
    end = F.unix_seconds(clock.moment("2024-02-01").cast("timestamp"))
    return bind(spark, sf, "scan").select("tracking_id", clock.hour("update_time").alias("h"), F.dayofmonth("update_time").alias("d"),
                                          (end - F.unix_seconds(F.col("update_time").cast("timestamp"))).alias("seconds_left"))


@query("o_9_14_interval", sql("scan", """
    select tracking_id, update_time + interval 330 minute as local_time, update_time - interval 4 hour as earlier,
      update_time - interval 2 month - interval 15 day as horizon from scan"""))
def interval(spark, sf):
    return bind(spark, sf, "scan").select("tracking_id", clock.to_local("update_time").alias("local_time"),
                                          clock.plus("update_time", hours=-4).alias("earlier"), clock.months_before("update_time", 2, 15).alias("horizon"))


@query("o_9_15_whole_days", sql("scan", f"""
    select tracking_id, cast(floor((epoch_us(timestamp '2024-02-01') - epoch_us(update_time)) / 8.64e10) as int) as days from scan"""))
def whole_days(spark, sf):
    return bind(spark, sf, "scan").select("tracking_id", clock.whole_days(clock.moment("2024-02-01"), "update_time").alias("days"))


@query("o_9_16_hours_between", sql("scan", """
    select tracking_id, (epoch_us(update_time) - epoch_us(timestamp '2024-01-15')) / 3.6e9 as hours from scan"""))
def hours_between(spark, sf):
    return bind(spark, sf, "scan").select("tracking_id", clock.hours_between("update_time", clock.moment("2024-01-15")).alias("hours"))


@query("o_9_17_greatest_least", sql("shipment", """
    select awb, greatest(shipment_chargeable_weight, total_shipment_value) as top, least(shipment_chargeable_weight, total_shipment_value) as bottom
    from shipment"""))
def greatest_least(spark, sf):
    a, b = "shipment_chargeable_weight", "total_shipment_value"
    return bind(spark, sf, "shipment").select("awb", F.greatest(a, b).alias("top"), F.least(a, b).alias("bottom"))


@query("o_9_18_rounding", sql("task", """
    select task_id, cast(trunc(cast(cast(cod_amount / 1000 as varchar) as decimal(38,15)) * 100) as double) / 100 as cut, cast(floor(cod_amount) as bigint) as floored,
      round(cod_amount) as rounded, cast(cod_amount / 7 as int) as as_int, cast(ceil(cod_amount) as bigint) as up from task"""))
def rounding(spark, sf):
    c = F.col("cod_amount")
    return bind(spark, sf, "task").select("task_id", numbers.truncate(c / 1000, 2).alias("cut"), F.floor(c).alias("floored"),
                                          F.round(c).alias("rounded"), numbers.round_to_int(c / 7).alias("as_int"), F.ceil(c).alias("up"))


@query("o_9_19_nullif_cast", sql("scan", """
    select tracking_id, nullif(remark, 'remark view 0') as remark, coalesce(location, 'none') as location,
      try_cast(right(remark, 1) as int) as digit, try_cast(remark as int) as not_a_number from scan"""))
def nullif_cast(spark, sf):
    return bind(spark, sf, "scan").select("tracking_id", F.nullif("remark", F.lit("remark view 0")).alias("remark"),
                                          F.coalesce("location", F.lit("none")).alias("location"),
                                          F.right("remark", F.lit(1)).try_cast("int").alias("digit"), F.col("remark").try_cast("int").alias("not_a_number"))


@query("o_9_20_parse_money", sql("task", """
    select task_id, round(cod_amount) as amount, -round(cod_amount) as negative, 0.25::double as share from task"""))
def parse_money(spark, sf):
    rows = bind(spark, sf, "task").select("task_id", text.rupees("cod_amount").alias("t"))
    return rows.select("task_id", text.parse_money("t").cast("double").alias("amount"),
                       (text.parse_money(F.concat(F.lit("-"), "t")).cast("double")).alias("negative"),
                       text.parse_money(F.lit("25%")).cast("double").alias("share"))


@query("o_9_21_geodistance", sql("task", """
    select task_id, round(2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(la2 - la1) / 2), 2)
      + cos(radians(la1)) * cos(radians(la2)) * pow(sin(radians(lo2 - lo1) / 2), 2)))), 6) as km
    from (select task_id, 8 + (task_id % 2000) / 100.0 as la1, 70 + (task_id % 1500) / 100.0 as lo1, 8 + (awb % 2000) / 100.0 as la2,
      70 + (awb % 1700) / 100.0 as lo2 from task) t"""))
def geodistance(spark, sf):
    def coord(c, m, base):
        return F.lit(base) + (F.col(c) % m) / F.lit(100.0)
    km = numbers.haversine_km(coord("task_id", 2000, 8), coord("task_id", 1500, 70), coord("awb", 2000, 8), coord("awb", 1700, 70))
    return bind(spark, sf, "task").select("task_id", F.round(km, 6).alias("km"))


@query("o_9_22_volumetric_weight", sql("weight", """
    select awb, length, breadth, height, weight, greatest(null::double, length * breadth * height / 5000.0, weight) as chargeable from weight"""))
def volumetric_weight(spark, sf):
    return bind(spark, sf, "weight").select("*", numbers.chargeable_weight(
        F.lit(None).cast("double"), F.col("length") * F.col("breadth") * F.col("height"), "weight").alias("chargeable"))


@query("o_9_23_day_count", sql("task", """
    select task_id, cast(date '2001-12-31' - cast(dispatch_time as date) as int) as age from task"""))
def day_count(spark, sf):
    return bind(spark, sf, "task").select("task_id", clock.days_between(F.lit("2001-12-31").cast("date"), "dispatch_time").alias("age"))


@query("o_9_24_unit_conversion", sql("task", """
    select task_id, cod_amount / 1000.0 as km, cod_amount / 60.0 as minutes from task"""))
def unit_conversion(spark, sf):
    return bind(spark, sf, "task").select("task_id", numbers.metres_to_km(F.col("cod_amount").cast("string")).alias("km"),
                                          numbers.seconds_to_minutes(F.col("cod_amount").cast("string")).alias("minutes"))


@query("o_9_25_as_of", sql("task", f"""
    select task_id, dispatch_time < timestamp '{AS_OF_TASK}' as past, timestamp '{AS_OF_TASK}' as as_of from task"""))
def as_of(spark, sf):
    now = clock.moment(AS_OF_TASK)
    return bind(spark, sf, "task").select("task_id", (F.col("dispatch_time") < now).alias("past"), now.alias("as_of"))


@query("o_9_26_text_casts", sql("task", """
    select task_id, cast(rider_id as varchar) as rider, cast(cod_amount as bigint) as whole, strftime(dispatch_time, '%B %Y') as month_name,
      cast(strftime(dispatch_time, '%Y-%m-%d %H:%M:%S') as timestamp) as back from task"""))
def text_casts(spark, sf):
    d = F.col("dispatch_time")
    return bind(spark, sf, "task").select("task_id", F.col("rider_id").cast("string").alias("rider"), F.rint("cod_amount").cast("bigint").alias("whole"),
                                          F.date_format(d, "MMMM yyyy").alias("month_name"),
                                          F.to_timestamp_ntz(F.date_format(d, "yyyy-MM-dd HH:mm:ss")).alias("back"))

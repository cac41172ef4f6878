"""Delivery attempts: ranks, promises, the attempt timeline, success rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from haulmark import rules
from haulmark.functions import clock, lookup, text
from haulmark.functions.numbers import ratio
from haulmark.operators.joins import interval_latest, latest_on_timeline, neighbours
from haulmark.operators.ordered import rank, running
from haulmark.operators.sets import union_all
from haulmark.operators.skew import resolve_hot
from haulmark.session import written

COMPLETED, CANCELLED = "COMPLETED", "CANCELLED"


def attempt_rank(df: DataFrame, key: str = "awb", ts: str = "dispatch_time", out: str = "attempt_number",
                 hot="auto", attach: DataFrame | None = None) -> DataFrame:
    """Rank of the attempt within its parcel; equal times share a rank.

    ``attach`` adds the columns of a parcel-level frame in the same shuffle.
    """
    return running(df, [key], ts, hot=hot, attach=attach, **{out: rank()})


def order_type(df: DataFrame, number: str = "attempt_number", fresh: str = "Fresh",
               again: str = "Reattempt") -> DataFrame:
    return df.withColumn("order_type", F.when(F.col(number) == 1, fresh).otherwise(again))


def payment_mode(cod: str = "cod_amount") -> Column:
    """Zero is prepaid, everything else (unknown too) is cash on delivery."""
    return F.when(F.col(cod) == 0, "Prepaid").otherwise("COD")


def success_rates(ranked: DataFrame, by: Sequence, mode: Column | None = None) -> DataFrame:
    """First-attempt success per group, also by payment mode. Needs ``attempt_number, status``."""
    fresh = F.col("attempt_number") == 1
    done = F.col("status") == COMPLETED
    mode = payment_mode() if mode is None else mode
    out = ranked.groupBy(*by).agg(
        F.count_if(fresh & done).alias("fresh_delivered"),
        F.count_if(fresh).alias("fresh_attempted"),
        F.count_if(fresh & done & (mode == "Prepaid")).alias("prepaid_fresh_delivered"),
        F.count_if(fresh & (mode == "Prepaid")).alias("prepaid_fresh_attempted"),
        F.count_if(fresh & done & (mode == "COD")).alias("cod_fresh_delivered"),
        F.count_if(fresh & (mode == "COD")).alias("cod_fresh_attempted"),
        F.count_if(done).alias("total_delivered"),
    )
    return out.withColumns({
        "fasr": ratio("fresh_delivered", "fresh_attempted"),
        "prepaid_fasr": ratio("prepaid_fresh_delivered", "prepaid_fresh_attempted"),
        "cod_fasr": ratio("cod_fresh_delivered", "cod_fresh_attempted"),
    })


def _due(ts: Column, promises: Sequence[rules.Promise]) -> Column:
    """First promise whose hour bound is above the hour of ``ts``."""
    start, hour = clock.day(ts), clock.hour(ts)
    arms = [(hour < p.before_hour, clock.plus(start, days=p.days, hours=p.due_hour)) for p in promises[:-1]]
    last = promises[-1]
    return lookup.first_match(arms, clock.plus(start, days=last.days, hours=last.due_hour))


def attempt_promise(df: DataFrame, ts: str = "dispatch_time", out: str = "min_reattempt_time",
                    lanes: Mapping[str, Sequence[rules.Promise]] = rules.LANE_PROMISES) -> DataFrame:
    """When the first attempt is due after pickup, by lane."""
    t = F.col(ts)
    origin, target = rules.SPECIAL_LANE
    special = (F.col("warehouse_city") == origin) & (F.col("shipping_city") == target)
    arms = [(special, _due(t, lanes["special"]))]
    arms += [(F.col("shipping_zone") == z, _due(t, p)) for z, p in lanes.items() if z not in ("special", "other")]
    return df.withColumn(out, lookup.first_match(arms, _due(t, lanes["other"])))


def min_reattempt(df: DataFrame, ts: str = "dispatch_time", out: str = "min_reattempt_time") -> DataFrame:
    """Earliest next attempt after a real one; null when delivered."""
    t = F.col(ts)
    wrong = F.lower(F.col("cancellation_remarks")).contains(rules.WRONG_ADDRESS)
    return df.withColumn(out, lookup.first_match([
        (F.col("status") == COMPLETED, F.lit(None).cast("timestamp_ntz")),
        (wrong, _due(t, [rules.REATTEMPT_WRONG_ADDRESS])),
    ], _due(t, rules.REATTEMPT)))


def prepare_replies(replies: DataFrame, shift_minutes: int = clock.LOCAL_SHIFT_MINUTES) -> DataFrame:
    """Local time, requested date and slot of customer replies."""
    asked = F.col("message") == rules.REATTEMPT_REQUESTED
    blank = F.coalesce(F.col("deferred_date"), F.lit("")) == ""
    return replies.withColumns({
        "deferred_date": F.when(asked & blank, clock.plus(clock.day("timestamp"), days=1))
        .otherwise(F.try_to_timestamp(F.col("deferred_date"), F.lit("yyyy-MM-dd")).cast("timestamp_ntz")),
        "re_attempt_slot": lookup.decode("re_attempt_slot", rules.REPLY_SLOTS),
        "timestamp": clock.to_local("timestamp", shift_minutes),
    })


def ideal_next_attempt(df: DataFrame) -> DataFrame:
    """Combine the promise with the date and slot the customer asked for.

    Needs ``attempt_number, min_reattempt_time, deferred_date, re_attempt_slot``.
    """
    evening = F.col("re_attempt_slot") == "evening"
    deferred = F.when(evening, clock.plus("deferred_date", hours=rules.EVENING_DUE_HOUR)).otherwise(
        clock.plus("deferred_date", hours=rules.OTHER_DUE_HOUR))
    wish, least = F.col("deferred_time"), F.col("min_reattempt_time")
    full_days = F.make_dt_interval(clock.whole_days(least, wish) + 1)
    return df.withColumn("deferred_time", deferred).withColumn("ideal_next_attempt_time", lookup.first_match([
        ((F.col("attempt_number") == 0) & wish.isNull(), least),
        (wish >= least, wish),
        ((wish < least) & F.col("re_attempt_slot").isNull(), least),
        (wish < least, wish + full_days),
    ]))


def pendency_flags(df: DataFrame) -> DataFrame:
    """On-time next attempt, pending or done, fresh or reattempt."""
    ideal, nxt, status = F.col("ideal_next_attempt_time"), F.col("next_trip_time"), F.col("shipment_status")
    over = status.contains("RTO") | status.isin("Cancelled", "Lost")
    return df.withColumns({
        "ot_ofd": lookup.first_match([
            (status == "Cancelled", F.lit(None).cast("int")), (nxt <= ideal, 1),
            (ideal.isNull(), F.lit(None).cast("int"))], 0),
        "pendency": lookup.first_match([(over, "Done"), (ideal.isNotNull() & nxt.isNull(), "Pending")], "Done"),
        "order_type": F.when(F.col("attempt_number") == 0, "Fresh").otherwise("Reattempt"),
    })


def attempt_timeline(shipments: DataFrame, attempts: DataFrame, replies: DataFrame, nodes: DataFrame, hot="auto",
                     since=None, created_since=None, test_hubs: Sequence[str] = ()) -> DataFrame:
    """Pickup as attempt zero, the real attempts, their neighbours, the customer's reply, and flags.

    ``shipments``: awb, created_date, pickuptime, last_mile_hub, sort_code, warehouse_city, shipping_city,
    shipping_zone, shipment_status. ``attempts``: task_id, awb, status, dispatch_time,
    cancellation_remarks, location_id, sort_code. ``replies``: awb, reply_id, timestamp, message,
    remarks, deferred_date (text), re_attempt_slot. ``nodes``: node_name, sort_codes, home_base_id.
    ``since`` drops older replies, ``created_since`` older shipments. Attempt zero needs a known hub
    that is none of ``test_hubs``; real attempts of such a shipment stay.

    Without hot parcels everything happens on one timeline per parcel: shipments, attempts and
    replies meet in one shuffle, and ranks, neighbours and replies are windows over it.
    """
    listed = resolve_hot(attempts.select("awb").unionByName(replies.select("awb")), ["awb"], hot)
    picked = shipments.filter(F.col("pickuptime").isNotNull() & F.col("awb").isNotNull())
    if created_since is not None:
        picked = picked.filter(F.col("created_date") >= clock.moment(created_since))
    # Written, the few hubs have a known size, and neither shipments nor attempts are dealt out by hub.
    nodes = written(nodes.select("node_name", "sort_codes", "home_base_id"), "hubs")
    hubs = nodes.select(text.part("sort_codes", "/", 2).alias("last_mile_hub"), "node_name").filter(
        F.col("node_name").isNotNull() & ~F.col("node_name").isin(list(test_hubs)))
    zero = attempt_promise(picked.withColumnRenamed("pickuptime", "dispatch_time")).join(hubs, "last_mile_hub", "inner").select(
        "awb", "node_name", "shipping_city", "shipment_status", "sort_code",
        F.concat(F.col("awb").cast("string"), F.lit("-zero-attempt")).alias("task_id"),
        "dispatch_time", F.lit(0).alias("attempt_number"), "min_reattempt_time")
    at_base = nodes.select(F.col("home_base_id").alias("location_id"), "node_name")
    tasks = min_reattempt(attempts.filter(F.col("awb").isNotNull())).join(at_base, "location_id", "left").select(
        "awb", "node_name", "sort_code", F.col("task_id").cast("string").alias("task_id"), "dispatch_time", "min_reattempt_time",
        F.col("status").alias("task_status"), "cancellation_remarks")
    known = picked.select("awb", "shipping_city", "shipment_status", F.lit(True).alias("_picked"))
    kept = replies if since is None else replies.filter(F.col("timestamp") >= clock.moment(since))
    said = prepare_replies(kept)
    if listed is None:
        answered = _one_timeline(zero, tasks, known, said)
    else:
        real = attempt_rank(tasks, hot=listed, attach=known).filter("_picked").drop("_picked")
        rows = neighbours(union_all(zero, real), "awb", "attempt_number", "dispatch_time")
        answered = interval_latest(rows, said, "awb", "dispatch_time", "timestamp", "reply_id", hot=listed)
    return pendency_flags(ideal_next_attempt(answered))


def _one_timeline(zero: DataFrame, tasks: DataFrame, known: DataFrame, said: DataFrame) -> DataFrame:
    payload = [c for c in said.columns if c != "awb"]
    reply = F.struct("timestamp", "reply_id", *[c for c in payload if c not in ("timestamp", "reply_id")])
    answers = said.filter(F.col("awb").isNotNull() & F.col("timestamp").isNotNull()).select("awb", F.col("timestamp").alias("_at"), reply.alias("_reply"))
    shipment = known.select("awb", F.struct("shipping_city", "shipment_status", "_picked").alias("_known"))
    line = (zero.withColumn("_row", F.lit(True))
            .unionByName(tasks.withColumns({"_row": F.lit(True), "_real": F.lit(True)}), allowMissingColumns=True)
            .withColumn("_at", F.col("dispatch_time"))
            .unionByName(shipment, allowMissingColumns=True).unionByName(answers, allowMissingColumns=True))
    per_awb = Window.partitionBy("awb")
    # Real attempts come first in this order, so their rank counts them alone.
    turn = per_awb.orderBy(F.col("_real").asc_nulls_last(), F.col("dispatch_time").asc_nulls_last())
    numbered = line.withColumns({"_known": F.first("_known", ignorenulls=True).over(per_awb),
                                 "attempt_number": F.when(F.col("_real"), F.rank().over(turn)).otherwise(F.col("attempt_number"))})
    own = numbered.withColumns({
        "shipping_city": F.when(F.col("_real"), F.col("_known.shipping_city")).otherwise(F.col("shipping_city")),
        "shipment_status": F.when(F.col("_real"), F.col("_known.shipment_status")).otherwise(F.col("shipment_status"))})
    own = own.filter((F.col("_row") & (F.col("_real").isNull() | F.col("_known._picked"))) | F.col("_reply").isNotNull())
    by_number = per_awb.orderBy("attempt_number")
    near = own.withColumns({"previous_trip_time": F.min("dispatch_time").over(by_number.rangeBetween(-1, -1)),
                            "next_trip_time": F.min("dispatch_time").over(by_number.rangeBetween(1, 1))})
    out = latest_on_timeline(near, "awb")
    return out.select(*zero.columns, "task_status", "cancellation_remarks", "previous_trip_time", "next_trip_time",
                      *[F.col(f"_reply.{c}").alias(c) for c in payload])

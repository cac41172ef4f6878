"""The daily hub table: one row per day, city and hub with every service figure."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from haulmark import rules
from haulmark.functions import clock, lookup, text
from haulmark.functions.numbers import chargeable_weight, exact_sum, int_ratio, ratio
from haulmark.operators.attempts import COMPLETED, attempt_rank
from haulmark.operators.pick import max_dims
from haulmark.operators.service import PENDING, action_bucket, action_date, hub_grid, on_time_known
from haulmark.session import written

BY = ["shipping_city", "last_mile_hub"]
OPS_COLUMNS = ["awb", "shipment_id", "shipping_city", "last_mile_hub", "user_name", "shipment_status", "shipping_partner",
               "created_date", "pickuptime", "first_ofd_time", "delivertime", "edd", "last_scan_time", "delivery_attempts",
               "closure_status", "next_delivery_date", "last_failed_date", "modified_date", "op_owner"]


def shipment_base(ops: DataFrame, events: DataFrame, headers: DataFrame, weights: DataFrame, ratings: DataFrame,
                  nodes: DataFrame, as_of, months: int | None = 2, excluded_hubs: Sequence[str] = (),
                  created_owners: Sequence[str] = (), created_clients: Sequence[str] = ()) -> DataFrame:
    """One row per own-network shipment with its pending work and due day.

    Weights and ratings are brought to one row per parcel first, so nothing
    multiplies. For the listed owners and clients the creation time counts as intake.
    """
    now = clock.moment(as_of)
    rows = ops.select(*OPS_COLUMNS).filter((F.col("shipping_partner") == rules.OWN_CARRIER) & F.col("shipping_city").isNotNull())
    if months is not None:
        rows = rows.filter(F.col("created_date") >= clock.months_before(clock.month(now), months))
    # Written, the few hubs have a known size, and the shipments are not dealt out by hub.
    hubs = written(nodes.select(text.part("sort_codes", "/", 2).alias("last_mile_hub"), "node_name")
                   .filter(~F.col("node_name").isin(list(excluded_hubs))), "hubs")
    rows = rows.join(hubs, "last_mile_hub", "inner")
    e = events.select("shipment_id", "last_ofd", "lost_mark_time",
                      F.col("rto_freeze_time").cast("date").alias("rto_freeze_date"), F.col("rto_ofd_time").cast("date").alias("rto_ofd_date"))
    dims = max_dims(weights).withColumnRenamed("shipment_awb", "awb")
    stars = ratings.groupBy("awb").agg(F.sum("shipper_rating").alias("_rating_sum"), F.count("shipper_rating").alias("_ratings"))
    rows = (rows.join(e, "shipment_id", "left")
            .join(headers.select("shipment_id", "shipment_chargeable_weight"), "shipment_id", "left")
            .join(dims, "awb", "left").join(stars, "awb", "left"))
    by_creation = F.col("op_owner").isin(list(created_owners)) | F.col("user_name").isin(list(created_clients))
    base = rows.withColumns({
        "pickup_date": clock.day("pickuptime"),
        "datetime": F.when(by_creation, F.col("created_date")).otherwise(F.col("pickuptime")),
        "otd": on_time_known("delivertime", "edd"), "ofd": on_time_known("first_ofd_time", "edd"),
        "ndd": F.col("next_delivery_date"), "last_failed_date": F.col("last_failed_date").cast("date"),
        "modified_date": F.col("modified_date").cast("date"),
        "chargeable_weight": chargeable_weight("shipment_chargeable_weight", "dwh_volume", "dwh_weight"),
    })
    base = action_date(action_bucket(base, as_of))
    return base.select("awb", "shipping_city", F.col("node_name").alias("last_mile_hub"), "shipment_status", "pickup_date",
                       "datetime", "otd", "ofd", "edd", "action_bucket", "action_date", "last_scan_time", "chargeable_weight",
                       "closure_status", "_rating_sum", "_ratings")


def shipment_metrics(base: DataFrame, as_of, missing_hours: int = 24, literal_lost: bool = False) -> DataFrame:
    """All shipment-side figures per hub and day in one pass.

    Each shipment is placed on up to four days (due, intake, pending, last scan),
    brought to one row per parcel and day, and summed. This replaces one
    aggregation per figure.
    """
    stale = ((F.col("last_scan_time") <= clock.plus(clock.moment(as_of), hours=-missing_hours))
             & (F.col("closure_status") != "closed") & F.col("pickup_date").isNotNull())
    spread = base.withColumnRenamed("datetime", "_intake_time").withColumn("_p", F.explode(
        F.array(*[F.struct(F.lit(k).alias("kind"), d.alias("datetime")) for k, d in (
            ("due", F.when(F.col("pickup_date").isNotNull(), F.col("edd").cast("timestamp_ntz"))),
            ("intake", clock.day("_intake_time")),
            ("pending", F.col("action_date")),
            ("missing", F.when(stale, clock.day("last_scan_time"))))])))
    spread = spread.withColumns({"kind": F.col("_p.kind"), "datetime": F.col("_p.datetime")})
    def on(kind, value=F.lit(1)):
        return F.when(F.col("kind") == kind, value)
    lost = "lost" if literal_lost else "Lost"
    bucket = F.col("action_bucket")
    per_awb = spread.groupBy(*BY, "datetime", "awb").agg(
        F.sum(on("due", F.col("otd"))).alias("otd"), F.sum(on("due", F.col("ofd"))).alias("ofd"),
        F.sum(on("due", F.when(F.col("shipment_status") == "Delivered", 1).otherwise(0))).alias("delivered"),
        F.max(on("due")).alias("efd"), F.sum(on("due", F.col("_ratings"))).alias("no_ratings"),
        F.sum(on("due", F.col("_rating_sum"))).alias("_rating_sum"), F.max(on("intake")).alias("drr"),
        F.sum(on("intake", F.when(F.col("chargeable_weight") >= rules.HEAVY_GRAMS, 1).otherwise(0))).alias("heavy_shipments"),
        *[F.max(on("pending", F.when(bucket == b, 1).otherwise(0))).alias(n) for n, b in {**PENDING, "lost_marked": lost}.items()],
        F.max(on("missing")).alias("missing_shipment"))
    names = ["otd", "ofd", "delivered", "efd", "drr", "heavy_shipments", *PENDING, "lost_marked", "missing_shipment"]
    out = per_awb.groupBy(*BY, "datetime").agg(
        *[F.sum(n).alias(n) for n in names], F.sum(F.coalesce(F.col("no_ratings"), F.col("efd") * 0)).alias("no_ratings"),
        F.sum("_rating_sum").alias("_rating_sum"))
    return out.withColumns({
        "otd_pct": int_ratio("otd", "efd"), "ofd_pct": int_ratio("ofd", "efd"), "del_pct": int_ratio("delivered", "efd"),
        "otd_ratio": ratio("otd", "efd"), "ofd_ratio": ratio("ofd", "efd"), "del_ratio": ratio("delivered", "efd"),
        "avg_rating": ratio("_rating_sum", "no_ratings")}).drop("_rating_sum")


def attempt_metrics(tasks: DataFrame, nodes: DataFrame, trips: DataFrame, as_of, months: int | None = 2, days: int = 15,
                    hot="auto") -> DataFrame:
    """Attempt-side figures per hub and dispatch day.

    Ranks are taken inside the horizon, so attempt 1 is the first one within it.
    """
    rows = tasks.filter(F.col("dispatch_time").isNotNull())
    if months is not None:
        rows = rows.filter(F.col("dispatch_time") >= clock.months_before(clock.moment(as_of), months, days))
    hubs = written(nodes.select(F.col("home_base_id").alias("location_id"), F.col("node_name").alias("last_mile_hub"),
                                lookup.decode("city_name", rules.CITY_CODES, F.col("city_name")).alias("shipping_city")), "hubs")
    paid = trips.select("task_id", "collected_by", F.col("cod_amount").alias("_paid"))
    return _attempt_figures(attempt_rank(rows, hot=hot).join(hubs, "location_id", "left").join(paid, "task_id", "left"))


def attempt_metrics_of(tasks: DataFrame, base: DataFrame, trips: DataFrame, hot="auto") -> DataFrame:
    """Older form: attempts of the shipments in ``base`` only, at the shipment's city and hub, without a horizon."""
    places = base.select("awb", *BY, F.lit(True).alias("_known"))
    rows = tasks.filter(F.col("dispatch_time").isNotNull() & F.col("awb").isNotNull())
    paid = trips.select("task_id", "collected_by", F.col("cod_amount").alias("_paid"))
    ranked = attempt_rank(rows.drop(*BY), hot=hot, attach=places).filter("_known").join(paid, "task_id", "left")
    return _attempt_figures(ranked)


def _attempt_figures(ranked: DataFrame) -> DataFrame:
    manual = F.lower(F.col("collected_by")).contains("manual")
    fresh, done = F.col("attempt_number") == 1, F.col("status") == COMPLETED
    cod = F.coalesce(F.col("cod_amount") > 0, F.lit(False))
    flags = {"fresh_delivered": fresh & done, "fresh_attempted": fresh, "prepaid_fresh_delivered": fresh & done & ~cod,
             "prepaid_fresh_attempted": fresh & ~cod, "cod_fresh_delivered": fresh & done & cod, "cod_fresh_attempted": fresh & cod,
             "locus_delivered": done}
    by = [*BY, "datetime"]
    small = ranked.withColumn("datetime", clock.day("dispatch_time")).groupBy(*by, "rider_id", "customer_pincode").agg(
        *[F.count_if(c).alias(n) for n, c in flags.items()],
        exact_sum(F.when(~manual, F.col("_paid")).otherwise(0)).alias("upi_collection"),
        exact_sum(F.when(manual, F.col("_paid")).otherwise(0)).alias("cash_collection"))
    out = small.groupBy(*by).agg(
        *[F.sum(n).alias(n) for n in flags], exact_sum("upi_collection").alias("upi_collection"),
        exact_sum("cash_collection").alias("cash_collection"), F.count_distinct("rider_id").alias("mandays"),
        F.count_distinct("customer_pincode").alias("distinct_pincodes"))
    return out.withColumns({
        "prepaid_fasr": ratio("prepaid_fresh_delivered", "prepaid_fresh_attempted"),
        "cod_fasr": ratio("cod_fresh_delivered", "cod_fresh_attempted"), "fasr": ratio("fresh_delivered", "fresh_attempted"),
        "productivity": ratio("locus_delivered", "mandays"), "load_per_pincode": ratio("locus_delivered", "distinct_pincodes")})


def with_delivered_productivity(table: DataFrame) -> DataFrame:
    """Older productivity: shipments delivered by due day over the rider days of that day."""
    return table.withColumn("delivered_productivity", ratio("delivered", "mandays"))


def main_metric_table(base: DataFrame, attempts: DataFrame, targets: DataFrame, as_of, start=None, end=None,
                      months: int = 2, days_ahead: int = 10, keep: Callable[[DataFrame], DataFrame] = lambda df: df,
                      missing_hours: int = 24, literal_lost: bool = False) -> DataFrame:
    """Dense day x hub grid with the figures of :func:`shipment_metrics` and :func:`attempt_metrics`.

    ``targets``: last_mile_hub, shipping_city, month (date), target_productivity. The
    shipment figures are read twice (grid and join); pass a ``keep`` that writes or
    checkpoints them so the shipment side is computed once.
    """
    now = clock.moment(as_of)
    first = clock.moment(start) if start is not None else clock.months_before(clock.month(now), months)
    last = clock.moment(end) if end is not None else clock.plus(clock.day(now), days=days_ahead)
    metrics = keep(shipment_metrics(base, as_of, missing_hours, literal_lost))
    grid = hub_grid(metrics, first, last, BY)
    on = [*BY, "datetime"]
    out = (grid.join(metrics, on, "left").join(attempts, on, "left").withColumn("month", F.trunc("datetime", "month"))
           .join(targets, ["last_mile_hub", "shipping_city", "month"], "left").drop("month"))
    key = F.concat_ws("", F.date_format("datetime", "dd/MM/yyyy"), F.lit("-"), "shipping_city", F.lit("-"), "last_mile_hub")
    return out.withColumns({"key": key, "cap_util": ratio("productivity", "target_productivity")})

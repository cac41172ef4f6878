"""Shipment milestones from the status log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from haulmark import rules
from haulmark.functions import clock, lookup, text
from haulmark.operators.aggregate import milestones
from haulmark.operators.ordered import least_so_far, previous_seen, running
from haulmark.operators.pick import collapse_runs
from haulmark.operators.skew import resolve_hot, salted_join

OFD, FAILED = "Out for Delivery", "Failed Delivered"


def normalise_status(log: DataFrame, status: str = "shipment_status",
                     table: Mapping[str, str] = rules.CANONICAL_STATUS) -> DataFrame:
    """Canonical statuses; rows without a status are dropped."""
    return log.filter(F.col(status).isNotNull()).withColumn(status, lookup.decode(status, table, F.col(status)))


def custody(status: Column, location: Column) -> Column:
    """Who holds the parcel after a raw scan; null when the scan moves nothing."""
    by_status = {s: name for name, statuses in rules.CUSTODY.items() for s in statuses}
    return lookup.first_match([
        ((status == rules.PICKED_UP_RAW) & (F.coalesce(location, F.lit("")) == ""), F.lit(rules.FIRST_MILE)),
        (~status.isin(rules.NO_MOVE), lookup.decode(status, by_status, status)),
    ])


def location_class(log: DataFrame, status: str = "shipment_status", out: str = "last_location") -> DataFrame:
    return log.withColumn(out, custody(F.col(status), F.col("location")))


def custody_detail(log: DataFrame, out: str = "last_location_details") -> DataFrame:
    """Readable detail per custody class: hub from the location, bin from the remark."""
    hub = F.concat(text.part("location", "/", 2), F.lit(" Hub"))
    remark = F.lower(F.col("remark"))
    # Remark mark -> bin name; tried in order.
    bins = lookup.first_match([
        (remark.contains("ndr"), F.concat(hub, F.lit(" - NDR Bin"))),
        (remark.contains("rto initiated"), F.concat(hub, F.lit(" - RTO Initiate Bin"))),
        (remark.contains("rto freeze"), F.concat(hub, F.lit(" - RTO Freeze Bin"))),
        (remark.endswith("rto out"), F.concat(hub, F.lit(" - RTO OFD Bin"))),
    ], hub)
    where = F.col("last_location")
    return log.withColumn(out, lookup.first_match([
        (where == "FM Vehicle", F.col("remark")),
        (where == "Rider", F.lit("Last Rider ID")),
        (where == "Hub", hub),
        (where == "Mid Mile", F.concat(F.lit("dispatched from "), hub)),
        (where == "Node Name", F.col("location")),
        (where == "Sort to Bin", bins),
    ]))


def last_known_location(log: DataFrame, key: str = "shipment_id") -> DataFrame:
    """Class, place, time and remark of the newest scan (by id) that moved the parcel."""
    rows = location_class(log).filter(F.col("last_location").isNotNull())
    newest = F.max_by(F.struct("last_location", F.col("location").alias("last_scan_location"),
                               F.col("update_time").alias("last_update_time"),
                               F.col("remark").alias("last_remark")), "tracking_id")
    return rows.groupBy(key).agg(newest.alias("_l")).select(key, "_l.*")


def delivery_runs(log: DataFrame, key: str = "shipment_id", hot="auto") -> DataFrame:
    """Out-for-delivery and failed scans with consecutive repeats removed (canonical statuses)."""
    return collapse_runs(log, [key], "update_time", "tracking_id", "shipment_status", [OFD, FAILED], hot=hot)


def attempt_window(log: DataFrame, key: str = "shipment_id", hot="auto") -> DataFrame:
    """Attempts, first and last out-for-delivery, first and last failure after the first of them."""
    listed = resolve_hot(log, [key], hot)
    runs = delivery_runs(log, key, listed)
    ofd = (runs.filter(F.col("shipment_status") == OFD).groupBy(key)
           .agg(F.count_distinct("tracking_id").alias("no_attempts"), F.min("update_time").alias("first_ofd"),
                F.max("update_time").alias("last_ofd")))
    late = (salted_join(runs.filter(F.col("shipment_status") == FAILED), ofd, [key], "inner", hot=listed)
            .filter(F.col("update_time") > F.col("first_ofd")))
    failed = late.groupBy(key).agg(F.min("update_time").alias("first_failed_delivered"),
                                   F.max("update_time").alias("last_failed_delivered"))
    return ofd.join(failed, key, "left")


def failed_remarks(log: DataFrame, key: str = "shipment_id", hot="auto") -> DataFrame:
    """Remarks of the first and last (by id) counted failure."""
    listed = resolve_hot(log, [key], hot)
    runs = delivery_runs(log, key, listed)
    first = runs.filter(F.col("shipment_status") == OFD).groupBy(key).agg(F.min("update_time").alias("first_ofd"))
    late = (salted_join(runs.filter(F.col("shipment_status") == FAILED), first, [key], "inner", hot=listed)
            .filter(F.col("update_time") > F.col("first_ofd")))
    return late.groupBy(key).agg(F.min_by("remark", "tracking_id").alias("first_failed_delivered_remarks"),
                                 F.max_by("remark", "tracking_id").alias("last_failed_delivered_remarks"))


def _lane_cities() -> tuple[Column, Column]:
    loc = F.col("location")
    return (F.left(F.split_part(loc, F.lit(">"), F.lit(1)), F.lit(3)),
            F.left(F.split_part(loc, F.lit(">"), F.lit(2)), F.lit(3)))


def milestone_spec() -> dict[str, tuple[str, Column]]:
    """Named first/last times over canonical statuses."""
    status, remark = F.col("shipment_status"), F.lower(F.col("remark"))
    origin, target = _lane_cities()
    moving = status == "In-Transit"
    to_dispatch = (status == "Sort to Bin") & ~remark.contains("ndr") & ~remark.contains("rto")
    return {
        "out_for_pickup_time": ("min", status == "Out for Pickup"),
        "picked_time": ("min", status == "Picked Up"),
        "awb_generated_time": ("max", status == "Awb Generated"),
        "in_transit_time": ("min", moving),
        "last_mile_time": ("max", status == "Last Mile"),
        "delivered_time": ("min", status == "Delivered"),
        "rto_initiated_time": ("max", status == "RTO Initiated"),
        "rto_ofd_time": ("max", status == "RTO Out for Delivery"),
        "rto_delivered_time": ("min", status == "RTO Delivered"),
        "ndr_initiated_time": ("max", status == "NDR Initiated"),
        "rto_freeze_time": ("max", status == "RTO Freeze"),
        "sort_to_bin_time": ("max", to_dispatch),
        "cfc_pickup_time": ("min", (status == "Picked Up") & remark.startswith("picked-up by")),
        "lost_mark_time": ("max", status == "Lost"),
        "hub_in_scan_time": ("min", status == "Reached City Hub"),
        "addtobag_time": ("min", status == "Add to bag"),
        "dest_city_time": ("min", status == "Reached Destination City"),
        "intracity_in_transit_time": ("min", moving & (origin == target)),
        "intercity_in_transit_time": ("min", moving & (origin != target)),
    }


def lane_transit_times(log: DataFrame, key: str = "shipment_id", status: str = "In-Transit") -> DataFrame:
    """First in-transit scan inside one city, and between two cities."""
    origin, target = _lane_cities()
    moving = F.col("shipment_status") == status
    return milestones(log, key, "update_time", {
        "intracity_in_transit_time": ("min", moving & (origin == target)),
        "intercity_in_transit_time": ("min", moving & (origin != target))})


def impute(facts: DataFrame) -> DataFrame:
    """Fill pickup and out-for-delivery times from later evidence, set ``closed`` and pickup attempts."""
    ofd = F.col("first_ofd")
    guess = F.least(clock.plus(ofd, hours=-4), clock.plus("awb_generated_time", days=1))
    pickup = F.coalesce(F.col("picked_time"), F.col("in_transit_time"), F.when(ofd.isNotNull(), guess))
    before_delivery = clock.plus("delivered_time", hours=-4)
    done = F.col("rto_delivered_time").isNotNull() | F.col("delivered_time").isNotNull()
    failed = F.coalesce(F.col("no_failed_pickup_attempts"), F.lit(0))
    return (facts
            .withColumn("pickup_time", pickup)
            .withColumns({
                "first_ofd": F.coalesce(ofd, before_delivery),
                "last_ofd": F.coalesce(F.col("last_ofd"), before_delivery),
                "closed": done.cast("bigint"),
                "first_pickup_attempt_time": F.coalesce(F.col("first_failed_pickup_time"), F.col("pickup_time")),
                "last_pickup_attempt_time": F.coalesce(F.col("pickup_time"), F.col("last_failed_pickup_time")),
                "no_pickup_attempts": (failed + F.when(F.col("pickup_time").isNotNull(), 1).otherwise(0)).cast("int"),
            }))


# Column order of the milestone table.
MILESTONE_COLUMNS = [
    "shipment_id", "out_for_pickup_time", "pickup_time", "last_mile_time", "no_attempts", "first_ofd",
    "last_ofd", "first_failed_delivered", "last_failed_delivered", "first_failed_delivered_remarks",
    "last_failed_delivered_remarks", "delivered_time", "rto_initiated_time", "rto_delivered_time",
    "last_update_time", "last_remark", "closed", "first_pickup_attempt_time", "last_pickup_attempt_time",
    "no_pickup_attempts", "last_location", "ndr_initiated_time", "last_scan_location", "rto_ofd_time",
    "rto_freeze_time", "sort_to_bin_time", "lost_mark_time", "hub_in_scan_time", "cfc_pickup_time",
    "addtobag_time", "in_transit_time", "dest_city_time", "intracity_in_transit_time",
    "intercity_in_transit_time",
]


def shipment_facts(log: DataFrame, key: str = "shipment_id", hot="auto") -> DataFrame:
    """All milestone inputs per shipment from one ordered pass and one aggregation.

    ``log`` holds raw statuses. The ordered pass adds, per scan, the previous
    delivery status and the earliest out-for-delivery so far; with those two
    values every count and time below is an ordinary aggregate.
    """
    listed = resolve_hot(log, [key], hot)
    raw = location_class(log.filter(F.col("shipment_status").isNotNull()))
    canon = normalise_status(raw)
    status, ts, scan = F.col("shipment_status"), F.col("update_time"), F.col("tracking_id")
    prepared = canon.withColumns({
        "_state": F.when(status.isin(OFD, FAILED), status),
        "_ofd_at": F.when(status == OFD, ts)})
    passed = running(prepared, [key], "update_time", ["tracking_id"], hot=listed,
                     _before=previous_seen("_state"), _first_ofd=least_so_far("_ofd_at"))
    starts_run = F.col("_state").isNotNull() & (F.col("_before").isNull() | (F.col("_before") != F.col("_state")))
    attempt = starts_run & (status == OFD)
    failure = starts_run & (status == FAILED) & (ts > F.col("_first_ofd"))
    pickup_failed = status == "Pickup Failed"
    newest = F.max_by(F.struct("last_location", F.col("location").alias("last_scan_location"),
                               ts.alias("last_update_time"), F.col("remark").alias("last_remark")),
                      F.when(F.col("last_location").isNotNull(), scan))
    pick = {"min": F.min, "max": F.max}
    aggs = [pick[how](F.when(cond, ts)).alias(n) for n, (how, cond) in milestone_spec().items()]
    aggs += [
        F.count_if(F.coalesce(attempt, F.lit(False))).alias("_attempts"),
        F.min(F.when(attempt, ts)).alias("first_ofd"), F.max(F.when(attempt, ts)).alias("last_ofd"),
        F.min(F.when(failure, ts)).alias("first_failed_delivered"),
        F.max(F.when(failure, ts)).alias("last_failed_delivered"),
        F.min_by("remark", F.when(failure, scan)).alias("first_failed_delivered_remarks"),
        F.max_by("remark", F.when(failure, scan)).alias("last_failed_delivered_remarks"),
        F.nullif(F.count_if(pickup_failed), F.lit(0)).alias("no_failed_pickup_attempts"),
        F.min(F.when(pickup_failed, ts)).alias("first_failed_pickup_time"),
        F.max(F.when(pickup_failed, ts)).alias("last_failed_pickup_time"),
        newest.alias("_last"),
    ]
    out = passed.groupBy(key).agg(*aggs)
    return (out.withColumn("no_attempts", F.nullif(F.col("_attempts"), F.lit(0)).cast("double"))
            .select("*", "_last.*").drop("_last", "_attempts"))


def tracking_events(log: DataFrame, key: str = "shipment_id", hot="auto") -> DataFrame:
    """One row per shipment with every milestone."""
    return impute(shipment_facts(log, key, hot)).select(*MILESTONE_COLUMNS)

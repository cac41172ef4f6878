"""The published trip table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from haulmark.operators.attempts import CANCELLED, COMPLETED


def trip_extract(trips: DataFrame, locations: DataFrame, tours: DataFrame, riders: DataFrame, nodes: DataFrame) -> DataFrame:
    """Trips with place, tour, rider and hub. All four sides are unique on their id."""
    place = locations.select(F.col("location_id").alias("location_dest"), F.col("pincode"), F.col("address").alias("customer_address"),
                             F.col("lat").alias("actual_location_lat"), F.col("lng").alias("actual_location_lng"))
    tour = tours.select("tour_id", F.col("rider_id").alias("num_rider_id"), "node_id", F.col("start_time").alias("slot_start"),
                        F.col("end_time").alias("slot_end"), "tour_date")
    rider = riders.select(F.col("rider_id").alias("num_rider_id"), F.col("locus_rider_id").alias("rider_id"), "rider_name",
                          F.col("phone").alias("rider_phone"))
    node = nodes.select("node_id", "node_name", "node_type", F.col("actual_city_name").alias("shipping_city"),
                        F.col("home_base_id").alias("location_id"))
    rows = trips.withColumns({
        "completed_at": F.when(F.col("status") == COMPLETED, F.col("closed_at")),
        "cancelled_at": F.when(F.col("status") == CANCELLED, F.col("closed_at"))})
    out = (rows.withColumnsRenamed({"trip_name": "awb", "start_at": "dispatch_time", "failed_delivery_reason": "cancellation_remarks"})
           .join(place, "location_dest", "left").join(tour, "tour_id", "left").join(rider, "num_rider_id", "left").join(node, "node_id", "left"))
    return out.drop("location_dest", "closed_at")

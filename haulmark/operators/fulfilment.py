"""Warehouse pick-pack stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from haulmark import rules
from haulmark.functions import clock, lookup
from haulmark.operators.aggregate import milestones
from haulmark.operators.pick import distinct_on


def pick_pack_milestones(log: DataFrame, key: str = "outflow_id", ts: str = "timestamp",
                         shift_minutes: int = clock.LOCAL_SHIFT_MINUTES) -> DataFrame:
    """Last time of each stage per order line, in local time."""
    times = milestones(log, key, ts, {n: ("max", F.col("status").isin(s)) for n, s in rules.PICK_PACK.items()})
    return times.withColumns({n: clock.to_local(n, shift_minutes) for n in rules.PICK_PACK})


def cutoff_clock(df: DataFrame, assigned: str, packed: str, as_of) -> DataFrame:
    """Cut-off moment, packing hours, days since the cut-off."""
    due = clock.cutoff(assigned)
    return df.withColumns({
        "cutoff": due,
        "tat": clock.hours_between(packed, assigned),
        "day_since_cutoff": clock.hours_between(clock.moment(as_of), due) / 24.0,
    })


def stage_dedup(lines: DataFrame) -> DataFrame:
    """One row per shipment at its furthest stage, with the quantity of its parcel number.

    Lines need ``shipment_id, awb, status, quantity`` and a unique ``id``. An
    unknown stage ranks above all others, as nulls sort first descending.
    """
    rows = lines.filter(F.col("shipment_id").isNotNull())
    per_awb = (rows.groupBy("shipment_id", "awb").agg(F.sum("quantity").alias("quantity_sum"))
               .groupBy("awb").agg(F.max_by("quantity_sum", "shipment_id").alias("quantity_sum")))
    staged = rows.withColumn("seq_id", lookup.decode("status", rules.STAGE_ORDER))
    furthest = distinct_on(staged, ["shipment_id"], [F.desc_nulls_first("seq_id"), F.asc("id")])
    return furthest.drop("quantity", "seq_id").join(per_awb, "awb", "left")

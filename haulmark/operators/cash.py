"""Cash on delivery and losses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from haulmark import rules
from haulmark.functions import clock, lookup, text
from haulmark.functions.numbers import exact_sum
from haulmark.operators.attempts import COMPLETED
from haulmark.operators.sets import union_distinct
from haulmark.operators.skew import resolve_hot, salted_join

LEDGER = ["delivery_date", "rider_id", "rider_name", "awb", "amount", "hub_name", "shipping_city", "collected",
          "deposited", "collected_on", "collected_by", "trip_id", "deposited_on"]


def paid_per_shipment(transactions: DataFrame, cashflows: DataFrame, since=None, hot="auto") -> DataFrame:
    """Cash-on-delivery lines brought to one row per shipment.

    The lines of a shipment are summed; it counts as deposited when every line has a cash
    flow, on the day of the latest known one. Cash flows created before ``since`` are not
    looked up, so they leave the day empty. Lines without a cash flow need no lookup.
    """
    lines = transactions.filter(F.col("reference_type") == "cod_amount").select("shipment_id", "amount", "incoming_cash_flow_id")
    flows = cashflows if since is None else cashflows.filter(F.col("created_time") >= since)
    days = flows.select(F.col("id").alias("incoming_cash_flow_id"), F.col("created_time").cast("date").alias("deposited_on"))
    has_flow = F.col("incoming_cash_flow_id").isNotNull()
    listed = resolve_hot(transactions, ["incoming_cash_flow_id"], hot)
    looked_up = salted_join(lines.filter(has_flow), days, ["incoming_cash_flow_id"], "left", hot=listed)
    return (looked_up.unionByName(lines.filter(~has_flow), allowMissingColumns=True).groupBy("shipment_id").agg(
        exact_sum("amount").alias("amount"), F.min(has_flow.cast("int")).alias("deposited"), F.max("deposited_on").alias("deposited_on")))


def cod_ledger(trips: DataFrame, transactions: DataFrame, cashflows: DataFrame, as_of=None, months: int = 3,
               hot="auto") -> DataFrame:
    """Money still with riders, and money collected with its deposit date. One row per trip.

    ``trips``: trip_id, awb, shipment_id, rider_id, rider_name, status, completed_at,
    dispatch_time, cod_amount, hub_name, shipping_city, is_collected, is_realized,
    reconciled_at, collected_by. ``transactions``: shipment_id, amount,
    reference_type, incoming_cash_flow_id. ``cashflows``: id, created_time (local).
    A trip of a shipment with several lines shows their sum, see ``paid_per_shipment``.
    ``as_of`` limits trips and cash flows to the last ``months``; without it no horizon applies.
    """
    done = trips.filter(F.col("status") == COMPLETED)
    if as_of is not None:
        now = clock.moment(as_of)
        done = done.filter((F.col("dispatch_time") >= clock.months_before(clock.month(now), months))
                           & (clock.day("completed_at") >= clock.months_before(clock.day(now), months)))
    base = done.withColumn("delivery_date", F.col("completed_at").cast("date"))
    open_ = base.filter(~F.col("is_collected") & ~F.col("is_realized") & (F.col("cod_amount") != 0)).select(
        "delivery_date", "rider_id", "rider_name", "awb", F.col("cod_amount").alias("amount"), "hub_name",
        "shipping_city", F.lit(0).alias("collected"), F.lit(0).alias("deposited"),
        F.lit(None).cast("date").alias("collected_on"), F.lit(None).cast("string").alias("collected_by"), "trip_id",
        F.lit(None).cast("date").alias("deposited_on"))
    since = None if as_of is None else clock.months_before(clock.day(clock.moment(as_of)), months)
    taken = base.filter(F.col("is_collected") | F.col("is_realized")).drop("amount")
    paid = salted_join(taken, paid_per_shipment(transactions, cashflows, since, hot), ["shipment_id"], "inner",
                       hot=resolve_hot(trips, ["shipment_id"], hot)).select(
        "delivery_date", "rider_id", "rider_name", "awb", "amount", "hub_name", "shipping_city",
        F.lit(1).alias("collected"), "deposited", F.col("reconciled_at").cast("date").alias("collected_on"),
        F.split_part("collected_by", F.lit("__"), F.lit(4)).alias("collected_by"), "trip_id", "deposited_on")
    return union_distinct(open_.select(*LEDGER), paid.select(*LEDGER))


def cod_pendency(ledger: DataFrame, report_date) -> DataFrame:
    """Uncollected money per rider: of the report day and of earlier days."""
    today = clock.moment(report_date).cast("date")
    rows = ledger.filter(F.col("collected") == 0)
    return rows.groupBy("rider_id").agg(
        exact_sum(F.when(F.col("delivery_date") == today, F.col("amount")).otherwise(0)).alias("today_cod"),
        exact_sum(F.when(F.col("delivery_date") < today, F.col("amount")).otherwise(0)).alias("past_cod"))


# Remark mark -> who lost the parcel, with the characters to skip after the colon.
LOSS_MARKS = {"Lost on Hub:": "Hub", "Lost on Rider:": "Rider", "Lost on FM:": "FM"}
HUB_ID_SKIP = 1


def classify_loss(df: DataFrame, remark: str = "remark") -> DataFrame:
    """Party named in the remark and its id as text; other remarks are dropped.

    The id stands between the first colon and the first full stop; without either it is null.
    """
    col = F.col(remark)
    party = lookup.first_match([(col.contains(mark), who) for mark, who in LOSS_MARKS.items()])
    marked = df.withColumn("attribution", party).filter(F.col("attribution").isNotNull())
    return marked.withColumns({
        "lost_node_id": F.when(F.col("attribution") == "Hub", text.between_marks(col, ":", ".", HUB_ID_SKIP)),
        "lost_rider_id": F.when(F.col("attribution") == "Rider", text.between_marks(col, ":", ".")),
    })


def loss_attribution(losses: DataFrame, riders: DataFrame, nodes: DataFrame, hot="auto",
                     counted: DataFrame | None = None) -> DataFrame:
    """Name the rider or hub behind each loss. ``losses``: awb, remark, lost_date, shipment_value, shipping_city.

    Keys are counted on ``counted``, the remarks as they are read, where ``losses`` is a joined frame.
    """
    key = "decimal(38,0)"
    keyed = {"_rid": F.col("lost_rider_id").try_cast(key), "_nid": F.col("lost_node_id").try_cast(key)}
    rows = classify_loss(losses).withColumns(keyed)
    base = rows if counted is None else classify_loss(counted).withColumns(keyed)
    r = riders.select(F.col("rider_id").cast(key).alias("_rid"), F.col("locus_rider_id").alias("rider_id"))
    n = nodes.select(F.col("node_id").cast(key).alias("_nid"), "node_name")
    # Both keys are counted on the losses, before anything is joined; text that is no number shares the null key.
    hot_riders, hot_nodes = resolve_hot(base, ["_rid"], hot), resolve_hot(base, ["_nid"], hot)
    named = salted_join(salted_join(rows, r, ["_rid"], "left", hot=hot_riders), n, ["_nid"], "left", hot=hot_nodes)
    return named.select("awb", "remark", "attribution", "rider_id", "node_name", "lost_date",
                        "shipment_value", "shipping_city")


def hub_loss_total(losses: DataFrame, month=None) -> DataFrame:
    """Value lost by hubs, per month or for one month."""
    hub = losses.filter(F.col("attribution") == "Hub")
    if month is not None:
        return hub.filter(clock.in_month("lost_date", month)).agg(exact_sum("shipment_value").alias("hub_loss"))
    return hub.groupBy(F.trunc("lost_date", "month").alias("lost_month")).agg(
        exact_sum("shipment_value").alias("hub_loss"))

"""The driver's tables in the shapes the operators expect.

Each binding is one SQL text understood by Spark and by the checking engine, so
both sides start from the same rows.
"""

from __future__ import annotations

import os
import weakref

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

CITY = """case r_name when 'AFRICA' then 'Delhi' when 'AMERICA' then 'Mumbai' when 'ASIA' then 'Bangalore'
    when 'EUROPE' then 'Hyderabad' else 'Jaipur' end"""
CODE = """case r_name when 'AFRICA' then 'DEL' when 'AMERICA' then 'BOM' when 'ASIA' then 'BLR'
    when 'EUROPE' then 'HYD' else 'JPR' end"""

BINDINGS = {
    # delivery attempts
    "task": """select o_orderkey as task_id, o_custkey as awb,
      case o_orderstatus when 'F' then 'COMPLETED' when 'O' then 'CANCELLED' else 'ONGOING' end as status,
      o_orderkey % 97 as rider_id, o_orderdate + (o_orderkey % 24) * interval '1' hour as dispatch_time,
      case when o_orderpriority in ('1-URGENT', '2-HIGH') then cast(0 as double) else o_totalprice end as cod_amount,
      o_custkey % 500 as pincode, o_orderkey % 400 as tour_id,
      case o_orderpriority when '1-URGENT' then 'Wrong address given' when '2-HIGH' then 'Operational Constraint'
        when '3-MEDIUM' then 'customer not home' else null end as cancellation_remarks
      from orders""",
    # order header with client, city, hub
    "shipment": f"""select c_custkey as shipment_id, c_custkey as awb, c_mktsegment as user_name,
      r_name as shipping_city, n_name as hub, concat(r_name, ' / ', n_name) as sort_code,
      case when c_custkey % 5 = 0 then 1001 when c_custkey % 5 = 1 then 2 else 301 end as shipper_id,
      c_acctbal as total_shipment_value, {CITY} as city,
      case c_custkey % 5 when 0 then 'Delhi' when 1 then 'Mumbai' when 2 then 'Bangalore' when 3 then 'Hyderabad'
        else 'NCR' end as warehouse_city,
      case c_custkey % 4 when 0 then 'Within Zone' when 1 then 'Metro' when 2 then 'Intracity' else 'Roi' end as shipping_zone,
      c_custkey % 50 as user_id, c_custkey % 500 as pincode,
      case when c_custkey % 3 = 0 then null else abs(c_acctbal) end as shipment_chargeable_weight,
      timestamp '1994-12-01 00:00:00' + (c_custkey % 700) * interval '1' hour as created_date,
      case c_custkey % 11 when 0 then 'Delivered' when 1 then 'Reached Nearest Hub' when 2 then 'Out for Delivery'
        when 3 then 'Failed Delivered' when 4 then 'RTO Freeze' when 5 then 'RTO Out for Delivery' when 6 then 'Lost'
        when 7 then 'Picked-up' when 8 then 'NDR Initiated' when 9 then 'RTO Delivered' else 'Cancelled' end as shipment_status
      from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    # status log
    "scan": """select event_id as tracking_id, user_id as shipment_id,
      case event_type when 'signup' then 'Picked-up' when 'view' then 'Out For Delivery'
        when 'click' then 'Failed Delivery' when 'purchase' then 'Delivered' else 'Reached Nearest Hub' end as shipment_status,
      case when event_id % 4 = 0 then null when event_id % 2 = 0 then 'BLR / H1>BLR / H2' else 'DEL / H3>BOM / H4' end as location,
      concat('remark ', event_type, ' ', cast(event_id % 7 as varchar(10))) as remark, ts as update_time
      from events""",
    # status log with the full range of raw statuses
    "scan_wide": """select event_id as tracking_id, user_id as shipment_id,
      case event_id % 23 when 0 then 'Shipment Created' when 1 then 'Awb Generated' when 2 then 'Out for Pickup'
        when 3 then 'Pickup Failed' when 4 then 'Picked-up' when 5 then 'In-Transit' when 6 then 'Reached City Hub'
        when 7 then 'Add to bag' when 8 then 'Reached Destination City' when 9 then 'Reached Nearest Hub'
        when 10 then 'Sort to Bin' when 11 then 'Out for Delivery' when 12 then 'Failed Delivered'
        when 13 then 'Out For Delivery' when 14 then 'Failed & Action Required' when 15 then 'Delivered'
        when 16 then 'NDR Initiated' when 17 then 'RTO Initiated' when 18 then 'RTO Freeze'
        when 19 then 'RTO Out for Delivery' when 20 then 'RTO Delivered' when 21 then 'Lost' else null end as shipment_status,
      case when event_id % 4 = 0 then null when event_id % 2 = 0 then 'BLR / H1>BLR / H2' else 'DEL / H3>BOM / H4' end as location,
      case when event_id % 5 = 0 then 'Picked-up by van' when event_id % 5 = 1 then 'sorted to NDR bin'
        else concat('remark ', event_type, ' ', cast(event_id % 7 as varchar(10))) end as remark,
      ts as update_time
      from events""",
    # finance lines
    "txn": """select o_orderkey as transaction_id, o_custkey as shipment_id, o_totalprice as amount,
      o_orderstatus <> 'P' as realized, o_orderkey % 11 = 0 as anulled,
      case when o_orderkey % 3 = 0 then 'cod_amount' else 'freight' end as transaction_type, o_orderdate as created_time
      from orders""",
    # 0..n weights per parcel
    "weight": """select l_orderkey as awb, cast(p_size as double) as length, l_quantity as breadth,
      cast(l_linenumber as double) as height, l_quantity * 100 as weight
      from lineitem join part on l_partkey = p_partkey""",
    # riders and hubs
    "rider": """select s_suppkey as rider_id, concat('R', cast(s_suppkey as varchar(12))) as locus_rider_id,
      s_name as rider_name, concat('phone-', cast(s_suppkey as varchar(12))) as phone, s_nationkey as node_id,
      s_suppkey % 7 as vendor_id, case when s_suppkey % 3 = 0 then 'FIXED' else 'ORDER' end as payout_structure,
      case when s_suppkey % 4 = 0 then 'false' else 'true' end as fuel_payout_automation,
      timestamp '1994-12-15 08:00:00' + (s_suppkey % 400) * interval '1' day as created_at,
      cast(s_suppkey % 5 as double) + 2 as vendor_charge_percent, cast(s_suppkey % 3 as double) + 1 as vendor_charge_fuel_percent
      from supplier""",
    "node": f"""select n_nationkey as node_id, n_name as node_name,
      case when n_nationkey % 6 = 0 then 'franchise_hub' else 'own_hub' end as node_type,
      concat({CODE}, ' / ', n_name) as sort_codes, {CITY} as city, {CODE} as city_name
      from nation join region on n_regionkey = r_regionkey""",
    # rider master as the payout and program runs see it
    "crew": """select rider_id, locus_rider_id, rider_name, phone, payout_structure, fuel_payout_automation, created_at, city, node_type, node_id,
      case when node_name = 'NATION_1' then 'DS BOM KDWL' when node_name = 'NATION_11' then 'DS BOM SWRI' when node_name = 'NATION_12' then 'BLDR-Franchise'
        when node_name = 'NATION_6' then 'GRGN-Franchise' when node_type = 'franchise_hub' then concat(node_name, '-Franchise') else node_name end as hub,
      concat('vendor ', cast(vendor_id as varchar(4))) as vendor_name,
      case when node_type = 'franchise_hub' then 'franchise' else 'own' end as hub_type
      from rider join node using (node_id)""",
    # pay by pincode
    "rate": """select c_custkey % 500 as pincode, cast(max(c_custkey % 9) as double) / 2 as delivered_rate from customer where c_custkey % 500 % 5 <> 1 group by 1""",
    # shipment table with milestones taken from the attempts
    "ops": """select s.awb, s.shipment_id, s.shipping_city, s.hub as last_mile_hub, s.user_name, s.shipment_status, s.shipper_id, s.sort_code, s.city,
      s.warehouse_city, s.pincode as shipping_pincode, s.created_date, t.pickuptime, t.first_ofd_time, t.last_ofd, t.delivertime, t.edd,
      t.last_scan_time, t.delivery_attempts, case when s.shipment_status = 'RTO Delivered' then t.last_scan_time end as rto_delivered_time,
      case when s.shipment_status in ('Delivered', 'RTO Delivered', 'Lost', 'Cancelled') then 'closed' else 'open' end as closure_status,
      case when s.shipper_id = 301 then 'Hyperlocal' when s.shipper_id = 2 then 'Delhivery' else 'B2B' end as shipping_partner
      from shipment s join (select awb, min(dispatch_time) - interval '20' hour as pickuptime, min(dispatch_time) as first_ofd_time,
          max(dispatch_time) as last_ofd, min(case when status = 'COMPLETED' then dispatch_time end) as delivertime,
          min(dispatch_time - hour(dispatch_time) * interval '1' hour) + interval '1' day as edd, max(dispatch_time) + interval '3' hour as last_scan_time,
          count(*) as delivery_attempts from task group by awb) t on s.awb = t.awb""",
    # revenue per order: client, lane, charge
    "charge": """select l_orderkey as order_id, sum(cast(floor(l_extendedprice * (1 - l_discount) * 100) as bigint)) as cents
      from lineitem group by l_orderkey""",
}

# Bindings that read other bindings.
DEPENDS = {"crew": "rider node", "ops": "task shipment"}

_registered: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def register(spark: SparkSession, sf_dir: str) -> None:
    """Make the driver's tables visible under their names, once per session and folder."""
    if _registered.get(spark) == sf_dir and spark.catalog.tableExists("orders"):
        return
    for name in TABLES:
        path = f"{sf_dir.rstrip('/')}/{name}.parquet"
        if "://" in sf_dir or os.path.exists(path):
            spark.read.parquet(path).createOrReplaceTempView(name)
    _registered[spark] = sf_dir


def bind(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A binding, or a driver table, as a DataFrame."""
    register(spark, sf_dir)
    if name not in BINDINGS:
        return spark.table(name)
    return run(spark, sql(DEPENDS.get(name, ""), BINDINGS[name]))


def run(spark: SparkSession, text: str) -> DataFrame:
    """A SQL text over the driver's tables; times come out without zone, as they are stored."""
    df = spark.sql(text)
    zoned = {c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"}
    return df.withColumns(zoned) if zoned else df


def sql(needs: str, body: str) -> str:
    """Checking SQL: the named bindings as CTEs in front of ``body``.

    ``body`` is a select, or further CTEs followed by a select and starting with WITH.
    """
    wanted: list[str] = []
    for n in needs.split():
        wanted += [d for d in (*DEPENDS.get(n, "").split(), n) if d not in wanted]
    ctes = ", ".join(f"{n} as ({BINDINGS[n]})" for n in wanted)
    text = body.strip()
    if text.lower().startswith("with "):
        return f"with {ctes}, {text[5:]}" if ctes else text
    return f"with {ctes} {text}" if ctes else text


def cents(expr: str, places: int = 2) -> str:
    """Order-independent sum in hundredths."""
    scale = 10 ** places
    return f"(cast(sum(cast(({expr}) * {scale} as bigint)) as double) / {float(scale)})"

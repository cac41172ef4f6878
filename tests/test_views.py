"""The view graph end to end on the smallest data."""
import os

from pyspark.sql import functions as F

from catalog import q_plans as q
from catalog.bindings import bind, run
from haulmark.plans import ops
from haulmark.sources.views import refresh

SF = "/root/testdata/sf0.001"


def test_view_graph(spark, tmp_path):
    head, clients, promises = q.header_views(spark, SF)
    bind(spark, SF, "lineitem")
    scans = bind(spark, SF, "scan_wide").withColumns({"awb": F.col("shipment_id"), "timestamp": F.col("update_time"), "shipper_id": F.lit(301)})
    tables = {
        "order_tracking": scans, "locus_task": run(spark, q.RAW_TASK), "locus_tour": run(spark, q.RAW_TOUR), "rider": bind(spark, SF, "rider"),
        "node": bind(spark, SF, "node"), "shipment_order_details": head, "company_info": clients, "shipment_timelines": promises,
        "finops_transaction": run(spark, q.RAW_TXN).withColumn("created_time", F.col("created_time") + F.expr("INTERVAL '40' YEAR")),
        "finops_cashflow": run(spark, q.RAW_FLOW), "outflow_outflowlog": run(spark, q.STAGE_LOG), "outflow_outflow": run(spark, q.OUTFLOWS),
        "warehouses_warehouse": run(spark, q.HOUSES), "appserver_suborder": run(spark, q.SUBORDERS),
    }
    views = ops.build_views(tables, q.STAGE_AS_OF, folder=str(tmp_path))
    assert list(views) == ["events", "tasks", "tours", "finance", "outflow", "ops", "ops_brief", "lost"]
    assert views["ops"].count() == head.count() == views["ops_brief"].count()
    assert views["tasks"].count() == tables["locus_task"].count()
    assert views["ops"].select("shipment_id").distinct().count() == head.count()
    # Stages read more than once are read back from files, so their plans stay short.
    for name in ("events", "tasks", "ops"):
        assert "FileScan" in views[name]._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in views[name]._jdf.queryExecution().executedPlan().toString()
    # Milestones in the shipment table are those of the event table.
    both = views["ops"].join(views["events"], "shipment_id").filter(~F.col("delivertime").eqNullSafe(F.col("delivered_time")))
    assert both.isEmpty()
    assert views["finance"].filter(F.col("awb").isNull()).isEmpty()
    views["lost"].count()


def test_refresh_builds_only_what_changed(spark, tmp_path):
    def table(name, rows):
        spark.createDataFrame(rows, "k int, v int").write.mode("overwrite").parquet(f"{tmp_path}/{name}")

    def tables():
        return {n: spark.read.parquet(f"{tmp_path}/{n}") for n in ("a", "b")}

    factor = 2

    def doubled(a):
        return a.withColumn("v", F.col("v") * factor)

    def joined(doubled, b):
        return doubled.join(b.withColumnRenamed("v", "w"), "k")

    def counted(b, as_of):
        return b.agg(F.count(F.lit(1)).alias("n"), F.lit(as_of).alias("as_of"))

    def run_once(as_of="2024-01-01", stages=None, **more):
        built = []
        views = refresh(spark, more.pop("tables", None) or tables(), stages or {"doubled": doubled, "joined": joined, "counted": counted}, as_of,
                        ["doubled", "joined", "counted"], {"doubled": ["k"]}, f"{tmp_path}/views", built=built, **more)
        return views, built

    table("a", [(1, 10), (2, 20)])
    table("b", [(1, 5)])
    views, built = run_once()
    assert built == ["doubled", "joined", "counted"]
    assert [tuple(r) for r in views["joined"].collect()] == [(1, 20, 5)]
    assert run_once()[1] == []
    table("a", [(1, 11), (2, 20)])
    views, built = run_once()
    assert built == ["doubled", "joined"] and views["joined"].first()["v"] == 22
    assert run_once("2024-01-02")[1] == ["counted"]
    table("b", [(2, 6)])
    assert run_once("2024-01-02")[1] == ["joined", "counted"]
    factor = 3
    assert run_once("2024-01-02")[1] == ["doubled", "joined"]
    loose = {**tables(), "b": spark.createDataFrame([(2, 6)], "k int, v int")}
    assert run_once("2024-01-02", tables=loose)[1] == ["joined", "counted"]
    assert run_once("2024-01-02", tables=loose, versions={"b": "1"})[1] == ["joined", "counted"]
    assert run_once("2024-01-02", tables=loose, versions={"b": "1"})[1] == []
    assert all(len(os.listdir(f"{tmp_path}/views/{n}")) <= 3 for n in ("doubled", "joined", "counted"))  # folder, mark, check sum

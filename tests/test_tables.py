"""Sources, sinks, mutations, quality, incremental and streaming forms."""
import os

import pytest
from conftest import values
from pyspark.sql import functions as F

from haulmark.operators import mutate, quality
from haulmark.operators.tracking import tracking_events
from haulmark.sources import readers, views, writers
from haulmark import session
from haulmark.streaming import incremental, streams


def test_upsert_cases(rows):
    target = rows([(1, "a", 10), (2, "b", 20)], "k int, v string, n int")
    source = rows([(2, "B", 5), (3, "c", 30), (3, "c", 30)], "k int, v string, n int")
    assert values(mutate.upsert(target, source, ["k"])) == [(1, "a", 10), (2, "B", 5), (3, "c", 30)]
    assert values(mutate.upsert(target, source, ["k"], F.col("s.n") > F.col("t.n"))) == [(1, "a", 10), (2, "b", 20), (3, "c", 30)]
    assert values(mutate.upsert(target, source, ["k"], update=False)) == [(1, "a", 10), (2, "b", 20), (3, "c", 30)]
    assert values(mutate.upsert(target, source, ["k"], exclude=["n"])) == [(1, "a", 10), (2, "B", 20), (3, "c", None)]
    once = mutate.upsert(target, source, ["k"])
    assert values(mutate.upsert(once, source, ["k"])) == values(once)


def test_upsert_refuses_two_rows_per_key(rows):
    target, source = rows([(1, "a")], "k int, v string"), rows([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception, match="not unique"):
        mutate.upsert(target, source, ["k"]).collect()


def test_delete_and_update(rows):
    df = rows([(1, "running"), (2, "running"), (1, "final")], "rider int, status string")
    assert values(mutate.delete_in(df, F.col("status") == "running", "rider", rows([(1,), (None,)], "rider int"))) == [(1, "final"), (2, "running")]
    assert values(mutate.updated_rows(df, F.col("rider") == 2, {"status": "closed"})) == [(2, "closed")]
    nulls = rows([(None, "x")], "rider int, status string")
    assert values(mutate.delete_where(nulls, F.col("rider") == 1)) == [(None, "x")]


def test_duplicates_with_null_keys(rows):
    df = rows([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "id int, k string")
    for hot in (None, 1):
        assert values(quality.duplicates(df, ["k"], hot=hot), "id") == [(1,), (2,), (3,), (4,)]
    assert quality.is_unique(df, ["id"]) and not quality.is_unique(df, ["k"])


def test_materialize_checks_key_and_replaces(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    first = writers.materialize(rows([(1, "a")], "k int, v string"), path, ["k"])
    again = writers.materialize(first.withColumn("v", F.lit("b")), path, ["k"])
    assert values(again) == [(1, "b")]
    with pytest.raises(Exception, match="not unique"):
        writers.materialize(rows([(1, "a"), (1, "b")], "k int, v string"), path, ["k"])
    assert values(spark.read.parquet(path)) == [(1, "b")]


def test_upsert_partitions_leaves_others_alone(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    rows([(1, "a", "d1"), (2, "b", "d2")], "k int, v string, day string").write.partitionBy("day").parquet(path)
    untouched = sorted(os.listdir(f"{path}/day=d1"))
    writers.upsert_partitions(path, rows([(2, "B", "d2"), (3, "c", "d3")], "k int, v string, day string"), ["k"], "day")
    assert values(spark.read.parquet(path), "k", "v", "day") == [(1, "a", "d1"), (2, "B", "d2"), (3, "c", "d3")]
    assert sorted(os.listdir(f"{path}/day=d1")) == untouched


def test_insert_aligns_by_name(rows):
    target = rows([(1, "a")], "k int, v string")
    assert values(writers.insert_select(target, rows([("b", 2)], "v string, k int"))) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="not in the table"):
        writers.insert_select(target, rows([(1,)], "zzz int"))


def test_tabular_reader(spark, rows, tmp_path):
    rows([(1, "x")], "a int, b string").write.option("header", True).csv(f"{tmp_path}/f.csv")
    assert values(readers.read_tabular(spark, f"{tmp_path}/f.csv", "a int, b string")) == [(1, "x")]
    for bad in ("book.xlsx", "noext"):
        with pytest.raises(ValueError):
            readers.read_tabular(spark, f"{tmp_path}/{bad}")


def test_delimited_keeps_first_row(spark, rows, tmp_path):
    df = rows([(1, "x"), (2, "y")], "a int, b string")
    writers.copy_delimited(df, f"{tmp_path}/d")
    assert values(writers.load_delimited(spark, f"{tmp_path}/d", "a int, b string")) == [(1, "x"), (2, "y")]


def test_master_csv(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('Month,City,Cost,Share\n01/03/2024,X,"₹11,18,555",5.21%\n01/04/2024,Y,"-₹72,296",\n', encoding="utf-8")
    df = readers.read_master_csv(spark, str(path), "Month string, City string, Cost string, Share string", money=["Cost", "Share"], day_first=["Month"])
    assert [(str(m), float(c), None if s is None else float(s)) for m, c, s in df.orderBy("Month").select("Month", "Cost", "Share").collect()] == [
        ("2024-03-01", 1118555.0, 0.0521), ("2024-04-01", -72296.0, None)]


def test_views_build_in_order(rows, tmp_path):
    built = views.view_dag({"t": rows([(1,), (2,)], "k int")}, {"double": lambda t: t.select((F.col("k") * 2).alias("k")), "total": lambda double, as_of: double.agg(F.sum("k").alias("s"), F.lit(as_of).alias("at"))},
                           "2024-01-01", keep=["double"], keys={"double": ["k"]}, folder=str(tmp_path))
    assert values(built["total"]) == [(6, "2024-01-01")]


def test_lookback_counts_either_time(rows):
    log = rows([(1, "2024-01-01 09:00:00", "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00", "2024-01-01 09:00:00"), (3, "2024-01-01 00:00:00", None), (42, "2024-01-01 09:00:00", None)], "k int, a ts, b ts")
    assert values(readers.changed_keys(log, "k", ["a", "b"], "2024-01-01 10:00:00", 4, ("k", [42]))) == [(1,), (2,)]


def events(spark, start, end):
    return spark.read.parquet("/root/testdata/sf0.001/events.parquet").filter((F.col("ts") >= start) & (F.col("ts") < end)).select(
        F.col("event_id").alias("tracking_id"), F.col("user_id").alias("shipment_id"), F.element_at(F.create_map(*[F.lit(x) for x in (
            "signup", "Picked-up", "view", "Out For Delivery", "click", "Failed Delivery", "purchase", "Delivered", "error", "Reached Nearest Hub")]), F.col("event_type")).alias("shipment_status"),
        F.lit(None).cast("string").alias("location"), F.col("event_type").alias("remark"), F.col("ts").cast("timestamp_ntz").alias("update_time"))


def test_incremental_equals_full(spark):
    log = events(spark, "2024-01-01", "2024-02-01")
    stored = tracking_events(events(spark, "2024-01-01", "2024-01-25"))
    out = incremental.incremental_recompute(stored, log, tracking_events, "shipment_id", ["update_time"], "2024-01-31", hours=6 * 24)
    full = tracking_events(log)
    assert out.exceptAll(full).isEmpty() and full.exceptAll(out).isEmpty()


SPEC = {"picked": ("min", "Picked-up"), "out": ("max", "Out For Delivery")}


def spec():
    return {n: (how, F.col("shipment_status") == s) for n, (how, s) in SPEC.items()}


def test_stream_milestones_equal_batch(spark, tmp_path):
    src = f"{tmp_path}/in"
    for a, b in (("2024-01-01", "2024-01-10"), ("2024-01-10", "2024-01-20"), ("2024-01-20", "2024-02-01")):
        events(spark, a, b).coalesce(1).write.mode("append").parquet(src)
    log = streams.read_log(spark, src, spark.read.parquet(src).schema, files_per_batch=1)
    table = f"{tmp_path}/out"
    streams.run_available(streams.stream_milestones(log, "shipment_id", "update_time", spec()), f"{tmp_path}/cp", "update", each=streams.milestone_sink(table))
    batch = streams.stream_milestones(spark.read.parquet(src).withColumn("update_time", F.col("update_time").cast("timestamp")), "shipment_id", "update_time", spec())
    got = streams.read_milestones(spark, table, "shipment_id", spec())
    assert len(os.listdir(f"{table}/data")) >= 3
    assert got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty()
    merged = streams.merge_milestones(got, batch, "shipment_id", spec())
    assert merged.exceptAll(batch).isEmpty()


def test_late_scans_still_count(spark, tmp_path):
    """The later half of the log comes first; a batch that is repeated changes nothing."""
    src, keys = f"{tmp_path}/in", f"{tmp_path}/keys"
    sink = streams.changed_keys_sink(keys, "shipment_id", ["update_time", "received"])
    for a, b in (("2024-01-15", "2024-02-01"), ("2024-01-01", "2024-01-15")):
        part = events(spark, a, b).withColumn("received", F.col("update_time") - F.expr("interval '1' hour"))
        part.coalesce(1).write.mode("append").parquet(src)
        log = streams.read_log(spark, src, part.schema, time_columns=("update_time", "received"))
        streams.run_available(log, f"{tmp_path}/cp", each=sink)
    sink(spark.read.parquet(src).limit(0).unionByName(events(spark, "2024-01-01", "2024-01-15").withColumn("received", F.col("update_time"))), 1)
    every = events(spark, "2024-01-01", "2024-02-01")
    assert streams.read_changed_keys(spark, keys, "shipment_id").count() == every.select("shipment_id").distinct().count()
    recent = streams.read_changed_keys(spark, keys, "shipment_id", "2024-01-30 12:00:00", 24)
    assert values(recent, "shipment_id") == values(every.filter("update_time >= timestamp_ntz'2024-01-29 12:00:00'").select("shipment_id").distinct())


def test_milestones_with_expiry_and_folding(spark, tmp_path):
    src = f"{tmp_path}/in"
    for a, b in (("2024-01-12", "2024-01-20"), ("2024-01-01", "2024-01-12"), ("2024-01-20", "2024-02-01"), ("2024-01-03", "2024-01-04")):
        events(spark, a, b).coalesce(1).write.mode("append").parquet(src)
    log = streams.read_log(spark, src, spark.read.parquet(src).schema, files_per_batch=1)
    batch = streams.stream_milestones(spark.read.parquet(src).withColumn("update_time", F.col("update_time").cast("timestamp")), "shipment_id", "update_time", spec())
    kept = f"{tmp_path}/state"
    streams.run_available(streams.stream_milestones(log, "shipment_id", "update_time", spec(), expire="31 days"), f"{tmp_path}/cp1", "update", each=streams.milestone_sink(kept))
    folded = f"{tmp_path}/folded"
    sink = streams.milestone_batches(folded, "shipment_id", "update_time", spec(), compact_every=3)
    streams.run_available(log, f"{tmp_path}/cp2", each=sink)
    for path in (kept, folded):
        got = streams.read_milestones(spark, path, "shipment_id", spec())
        assert got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty()
    assert len(streams.BatchStore(spark, folded).newest().folders) == 2  # three batches folded, and the last


def test_expired_state_is_dropped(spark, tmp_path):
    """A scan later than the stretch allows reaches the batch form, not the state."""
    src = f"{tmp_path}/in"
    for a, b in (("2024-01-20", "2024-02-01"), ("2024-01-25", "2024-01-26"), ("2024-01-01", "2024-01-05")):
        events(spark, a, b).coalesce(1).write.mode("append").parquet(src)
    log = streams.read_log(spark, src, spark.read.parquet(src).schema, files_per_batch=1)
    table = f"{tmp_path}/out"
    streams.run_available(streams.stream_milestones(log, "shipment_id", "update_time", spec(), expire="2 days"), f"{tmp_path}/cp", "update", each=streams.milestone_sink(table))
    got = streams.read_milestones(spark, table, "shipment_id", spec()).agg(F.min("picked")).first()[0]
    assert str(got) >= "2024-01-20"


def test_refresh_touches_only_changed_partitions(spark, rows, tmp_path):
    log = rows([(k, f"2024-01-{1 + n:02d} 00:00:00") for k in range(20) for n in range(3)], "k int, at ts")
    target, store = f"{tmp_path}/t", f"{tmp_path}/log"
    compute = lambda df: df.groupBy("k").agg(F.max("at").alias("last"))
    incremental.write_buckets(compute(log), target, "k", 8)
    more = rows([(3, "2024-01-09 00:00:00"), (99, "2024-01-09 00:00:00")], "k int, at ts")
    incremental.write_buckets(log.unionByName(more), store, "k", 8)
    before = {d: sorted(os.listdir(f"{target}/{d}")) for d in os.listdir(target) if d.startswith("bucket")}
    touched = incremental.refresh_partitions(spark, target, store, compute, "k", ["at"], "2024-01-09 01:00:00", hours=4)
    expected = {r[0] for r in more.select(incremental.bucket_of("k", 8)).collect()}
    assert set(touched) == expected
    after = {d: sorted(os.listdir(f"{target}/{d}")) for d in os.listdir(target) if d.startswith("bucket")}
    assert {d for d in after if after[d] != before.get(d)} == {f"bucket={b}" for b in expected}
    assert values(spark.read.parquet(target).select("k", "last")) == values(compute(log.unionByName(more)))
    assert incremental.refresh_partitions(spark, target, store, compute, "k", ["at"], "2025-01-01", hours=1) == []


def test_require_unique_lets_null_keys_repeat(rows):
    df = rows([(1, "a"), (None, "b"), (None, "c")], "k int, v string")
    assert quality.require_unique(df, ["k"]).count() == 3
    with pytest.raises(Exception, match="not unique"):
        quality.require_unique(df.unionByName(df), ["k"]).collect()


def test_reconcile_names_side_and_columns(rows):
    a = rows([(1, "x", "p"), (1, "y", "p"), (2, "x", "q"), (None, "z", "q")], "k int, s string, c string")
    found = quality.reconcile(a, rows([(2,), (3,)], "k int"), "k", ["s", "c"])
    assert values(found) == [(1, "only_left", "x", "p"), (3, "only_right", None, None)]
    assert values(quality.reconcile_breakdown(found, ["s", "c"])) == [("only_left", "c", "p", 1), ("only_left", "s", "x", 1), ("only_right", "c", None, 1), ("only_right", "s", None, 1)]


def test_reconcile_joins_only_buckets_that_differ(spark, rows):
    from haulmark.operators import quality

    a = rows([(i % 40 if i % 11 else None, f"v{i}") for i in range(200)], "k int, v string")
    assert quality.reconcile_rows(a, a.orderBy(F.desc("v")), ["k"], ["v"]).collect() == []
    b = a.filter("v <> 'v7'").unionByName(rows([(99, "new"), (3, "more"), (None, None)], "k int, v string")).filter("k is null or k <> 30")
    assert values(quality.reconcile_rows(a, b, ["k"], ["v"], buckets=64)) == sorted(
        [(3, "differs"), (7, "differs"), (30, "only_left"), (99, "only_right"), (None, "differs")], key=repr)
    twice = a.unionByName(a.filter("v = 'v5'"))
    assert values(quality.reconcile_rows(a, twice, ["k"], ["v"])) == [(5, "differs")]
    plan = quality.reconcile_rows(a, twice, ["k"], ["v"], buckets=64)._jdf.queryExecution().optimizedPlan().toString()
    bucket = twice.filter("k = 5").select(F.pmod(F.xxhash64("k"), F.lit(64))).first()[0]
    assert f"= {bucket})" in plan  # the one bucket that differs


def test_report_has_one_file_per_group(rows, tmp_path):
    df = rows([(f"c{i % 3}", f"h{i % 2}", i) for i in range(60)], "city string, hub string, n int").repartition(8)
    writers.write_partitioned_report(df, f"{tmp_path}/r")
    counts = [len([f for f in files if f.endswith(".csv")]) for _, _, files in os.walk(f"{tmp_path}/r") if any(f.endswith(".csv") for f in files)]
    assert counts == [1] * 6


def test_refresh_uses_the_shared_folder(spark, rows):
    built = views.refresh(spark, {"t": rows([(1,), (2,)], "k int")}, {"double": lambda t: t.select((F.col("k") * 2).alias("k"))}, keep=["double"])
    assert values(built["double"]) == [(2,), (4,)]


def test_a_run_leaves_nothing_behind(spark, rows, tmp_path):
    from haulmark import files
    from haulmark.operators import skew
    from haulmark.operators.attempts import attempt_rank

    skew.forget(spark)
    df = rows([(i, "a" if i % 3 else "b", f"2024-01-0{1 + i % 9} 00:00:00") for i in range(300)], "id long, awb string, dispatch_time ts")
    plain = values(attempt_rank(df, hot=None), "id", "attempt_number")
    before = files.names(spark, session.shared_folder(spark))
    for n in range(2):  # the list of hot keys went with the first run and is made again
        with session.run_folder(spark) as folder:
            out = attempt_rank(df, hot=20)
            assert files.names(spark, folder)
            with session.run_folder(spark):
                session.written(df).count()
            out.write.parquet(f"{tmp_path}/out{n}")
        assert not files.exists(spark, folder)
        assert values(spark.read.parquet(f"{tmp_path}/out{n}"), "id", "attempt_number") == plain
    with pytest.raises(ZeroDivisionError), session.run_folder(spark):
        session.written(df)
        1 / 0
    assert files.names(spark, session.shared_folder(spark)) == before
    skew.forget(spark)


def test_no_folder_is_made_up(spark, monkeypatch):
    from haulmark import session
    assert session.new_folder(spark).startswith(session.named_folder(spark))
    monkeypatch.setattr(session, "named_folder", lambda _: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(spark)


def test_jdbc_options_reach_the_source(spark):
    with pytest.raises(Exception, match="no.such.Driver"):
        readers.read_jdbc(spark, {"url": "jdbc:none:db", "driver": "no.such.Driver"}, "orders", "id", (0, 10), 2)

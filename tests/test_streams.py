"""Stores that batches are added to: folds under readers, bounded storage, late rows."""
import os
import random
from datetime import datetime, timedelta

import pytest
from conftest import values
from pyspark.sql import functions as F

from haulmark.streaming import layout, streams
from haulmark.streaming.store import BatchStore, Commit



def spec():
    return {"picked": ("min", F.col("s") == "Picked-up"), "out": ("max", F.col("s") == "Out")}


def log(spark, rows):
    return spark.createDataFrame(rows, "k long, at timestamp, s string")


def day(n, hour=0):
    return datetime(2024, 1, 1) + timedelta(days=n, hours=hour)


def test_a_reader_goes_on_through_folds(spark, tmp_path):
    path = str(tmp_path / "m")
    sink = streams.milestone_batches(path, "k", "at", spec(), compact_every=2, keep=4)
    sink(log(spark, [(i, day(1, i % 5), "Picked-up") for i in range(50)]), 0)
    reader = streams.read_milestones(spark, path, "k", spec())  # has listed its folders, has not read them
    sink(log(spark, [(i, day(0), "Picked-up") for i in range(60)]), 1)  # folds what the reader holds
    assert [f.level for f in BatchStore(spark, path).newest().folders] == [1]
    assert reader.count() == 50 and reader.agg(F.min("picked")).first()[0] == day(1)
    now = streams.read_milestones(spark, path, "k", spec())
    assert now.count() == 60 and now.agg(F.max("picked")).first()[0] == day(0)
    for i in range(2, 8):
        sink(log(spark, [(1, day(9, i), "Out")]), i)
    assert len(os.listdir(f"{path}/commits")) <= 2 * 4 + 1  # with check sums
    assert streams.read_milestones(spark, path, "k", spec()).filter("k = 1").first()["out"] == day(9, 7)
    listed = {f.name for n in BatchStore(spark, path)._numbers() for f in BatchStore(spark, path)._read(n).folders}
    assert set(os.listdir(f"{path}/data")) == listed


def test_folds_are_rare_and_lists_short(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "s"), fan=3, keep=1)
    for i in range(20):
        store.add(i, spark.range(i, i + 1), fold=lambda r: r)
        assert len(store.newest().folders) <= 2 * 3
    assert sorted(r.id for r in store.read().collect()) == list(range(20))
    assert max(f.level for f in store.newest().folders) == 2


def test_a_repeated_batch_is_passed_over_and_a_broken_one_is_cleared(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "s"))
    store.add(0, spark.range(3), counts={"late": 2})
    spark.range(9).write.parquet(f"{store.path}/data/batch-1-broken")  # a write without its commit
    assert store.add(0, spark.range(3), counts={"late": 2}).number == 1
    assert store.read().count() == 3
    store.add(1, spark.range(3, 5), counts={"late": 1})
    assert store.read().count() == 5 and store.newest().counts == {"late": 3}
    assert "batch-1-broken" not in os.listdir(f"{store.path}/data")


def test_a_taken_commit_is_refused(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "s"))
    store.add(0, spark.range(1))
    with pytest.raises(RuntimeError):
        store._publish(Commit(1, 5))
    assert store.newest().through == 0 and store.as_of(-1) == Commit()


def test_changed_keys_stay_within_their_horizon(spark, tmp_path):
    path, rng = str(tmp_path / "k"), random.Random(4)
    sink = streams.changed_keys_sink(path, "k", ["at"], "3 days", fan=2, keep=1)
    rows, late, seen = [], 0, None
    for d in range(30):
        batch = [(rng.randrange(40) + 40 * d, day(d, rng.randrange(24)), "x") for _ in range(30)] + [(5000 + d, day(d - 6), "x")]
        sink(log(spark, batch), d)
        sink(log(spark, batch), d)  # repeated
        rows += batch
        seen = max(r[1] for r in rows)
        late += batch[-1][1] < seen - timedelta(days=3)
        stored = BatchStore(spark, path).read().count()
        assert stored <= 31 * 9, (d, stored)
    assert streams.late_changes(spark, path) == {"late_keys": late, "late_scans": late}
    for hours in (4, 30, 71):
        lo = seen - timedelta(hours=hours)
        want = {r[0] for r in rows if r[1] >= lo}
        assert {r.k for r in streams.read_changed_keys(spark, path, "k", seen, hours).collect()} == want
    rows_live = {r.k: r.touched_at for r in streams.read_changed_keys(spark, path, "k").collect()}
    assert all(rows_live[r[0]] >= r[1] for r in rows if r[1] >= seen - timedelta(days=3))


def test_keys_without_a_time_expire_too(spark, tmp_path):
    path = str(tmp_path / "k")
    sink = streams.changed_keys_sink(path, "k", ["at"], "2 days", fan=2, keep=1)
    for d in range(6):
        sink(log(spark, [(d, day(d), "x"), (100 + d, None, "x")] if d != 3 else [(103, None, "x")]), d)
    assert values(streams.read_changed_keys(spark, path, "k"), "k", "touched_at") == [
        (104, str(day(4))), (105, str(day(5))), (4, str(day(4))), (5, str(day(5)))]


def test_closed_days_do_not_grow_with_shipments(spark, tmp_path):
    path, rng = str(tmp_path / "d"), random.Random(9)
    sink = streams.daily_sink(path, ["s"], "at", "k", open_days=2, fan=2, keep=1)
    rows = []
    for d in range(12):
        batch = [(rng.randrange(10**6), day(d, rng.randrange(24)), rng.choice("ab")) for _ in range(800)]
        batch += [(r[0], r[1], r[2]) for r in rng.sample(rows, 200)] if rows else []  # late, known shipments
        batch += [(7, None, "a"), (None, day(d), "b")]
        sink(log(spark, batch), d)
        sink(log(spark, batch), d)
        rows += batch
    closed, live = (BatchStore(spark, f"{path}/{n}").read() for n in ("closed", "open"))
    assert closed.count() <= 10 * 2 * 6 and live.select("day").distinct().count() <= 2 + 3
    got = {(r.day, r.s): r for r in streams.read_daily_counts(spark, path, ["s"], "k", open_days=2).collect()}
    want = {(r.day, r.s): r for r in streams.daily_counts(log(spark, rows), ["s"], "at", "k").collect()}
    assert got.keys() == want.keys()
    estimated = 0
    for key, r in got.items():
        assert r.scans == want[key].scans
        if r.exact:
            assert r.shipments == want[key].shipments
        else:
            estimated += 1
            assert abs(r.shipments - want[key].shipments) <= max(1, 0.03 * want[key].shipments)
    assert estimated and {day(10), day(11), None} <= {k[0] for k, r in got.items() if r.exact}


def test_readers_see_open_and_closed_days_of_one_batch(spark, tmp_path, monkeypatch):
    """Between the two commits of a batch its days are neither missing nor counted twice."""
    path = str(tmp_path / "d")
    sink = streams.daily_sink(path, ["s"], "at", "k", open_days=1)
    sink(log(spark, [(1, day(0), "a"), (2, day(0), "a")]), 0)
    add = BatchStore.add
    monkeypatch.setattr(BatchStore, "add", lambda self, *a, **b: add(self, *a, **b) if self.path.endswith("closed") else (_ for _ in ()).throw(OSError("lost")))
    later = log(spark, [(3, day(1), "a")])
    with pytest.raises(OSError):
        sink(later, 1)
    assert values(streams.read_daily_counts(spark, path, ["s"], "k", open_days=1), "s", "scans", "shipments") == [("a", 2, 2)]
    monkeypatch.setattr(BatchStore, "add", add)
    sink(later, 1)
    assert values(streams.read_daily_counts(spark, path, ["s"], "k", open_days=1), "day", "scans", "shipments") == [("2024-01-01 00:00:00", 2, 2), ("2024-01-02 00:00:00", 1, 1)]


def test_refresh_by_home_rewrites_only_recent_days(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    compute = lambda df: df.groupBy("k").agg(F.max("at").alias("last"), F.count(F.lit(1)).alias("n"))
    first = rows([(d * 100 + i, str(day(d, i % 20))) for d in range(30) for i in range(40)] + [(None, str(day(3)))] * 3, "k long, at ts")
    layout.append(spark, path, first, "k", "at", 0)
    layout.build(spark, path, compute, "k")
    more = [(d * 100 + i, str(day(30, 2))) for d in (28, 29) for i in range(40)] + [(9000 + i, str(day(30, 1))) for i in range(20)] + [(None, str(day(30)))]
    second = rows(more, "k long, at ts")
    for _ in range(2):  # a repeated batch replaces itself
        layout.append(spark, path, second, "k", "at", 1)
    older = rows([(2805, str(day(1)))], "k long, at ts")  # an older scan does not move its key
    layout.append(spark, path, older, "k", "at", 2)
    files = lambda: {r[0] for r in layout.read_table(spark, path).select(F.input_file_name()).distinct().collect()}
    before = files()
    homes = layout.refresh(spark, path, compute, "k", ["at"], "2024-01-31 04:00:00", 4)
    assert sorted(map(str, homes)) == ["2024-01-29", "2024-01-30", "2024-01-31"]
    assert {f for f in before - files()} == {f for f in before if any(str(h) in f for h in homes)}
    full = compute(first.unionByName(second).unionByName(older))
    got = layout.read_table(spark, path)
    assert values(got.filter("k is not null"), "k", "last", "n") == values(full.filter("k is not null"), "k", "last", "n")
    assert layout.refresh(spark, path, compute, "k", ["at"], "2030-01-01", 4) == []

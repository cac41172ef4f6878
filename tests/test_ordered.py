"""Hot-key forms must give the plain result."""
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from haulmark import session
from haulmark.operators import joins, ordered, pick, skew
from haulmark.operators.attempts import attempt_rank
from haulmark.operators.ordered import lag, last_seen, lead, least_so_far, previous_seen, rank, row_number, running, seen_before
from haulmark.operators.skew import hot_keys, resolve_hot, salted_join

SPECS = dict(r=rank(), n=row_number(), p=lag("s"), x=lead("s"), seen=last_seen("own"), prev=previous_seen("own"),
             before=seen_before("own"), least=least_so_far("own"))


@pytest.fixture()
def log(rows):
    rng = random.Random(7)
    data = []
    for i in range(400):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        when = None if i % 41 == 0 else f"2024-01-0{rng.randint(1, 3)} {rng.randint(0, 23):02d}:{rng.randint(0, 3):02d}:00"
        data.append((i, key, when, rng.choice(["x", "y", None]), i if i % 4 == 0 else None))
    return rows(data, "id long, k string, at ts, s string, own long")


def test_hot_keys_are_bounded(log):
    assert values(hot_keys(log, ["k"], min_rows=100)) == [("hot", log.filter("k = 'hot'").count() // 100 + 1)]
    assert hot_keys(log, ["k"], min_rows=1).count() == 5


def test_segments_equal_plain_window(log):
    plain = running(log, ["k"], "at", ["id"], hot=None, **SPECS)
    for limit in (1, 60, 100, 1000):
        split = running(log, ["k"], "at", ["id"], hot=limit, **SPECS)
        assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty(), limit


@pytest.mark.parametrize("moment", ["2024-01-01 10:00:00", "2024-01-01 10:{:02d}:00", None])
def test_a_third_of_the_rows_in_one_hour(rows, moment):
    rng = random.Random(3)
    data = [(i, "hot", moment.format(i % 3) if moment else None, rng.choice(["x", "y", None]), i if i % 4 == 0 else None) for i in range(100)]
    data += [(i, rng.choice("abcdef"), f"2024-01-01 {i % 24:02d}:00:00", "z", i) for i in range(100, 300)]
    data += [(i, "hot", f"2024-01-0{1 + i % 2} {i % 24:02d}:30:00", "z", i if i % 3 else None) for i in range(300, 330)]
    df = rows(data, "id long, k string, at ts, s string, own long")
    plain = running(df, ["k"], "at", ["id"], hot=None, **SPECS)
    for limit in (4, 9, 40):
        split = running(df, ["k"], "at", ["id"], hot=limit, **SPECS)
        assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty(), limit


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "timestamp", "binary", "decimal(10,2)", "boolean", "struct<a:int>"])
def test_hot_keys_of_any_type(spark, kind):
    key = {"date": "date_add(date'2024-01-01', cast(id % 2 as int))", "timestamp_ntz": "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 2 as int))",
           "timestamp": "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 2 as int))", "binary": "cast(cast(id % 2 as string) as binary)",
           "decimal(10,2)": "cast(id % 2 as decimal(10,2))", "boolean": "id % 2 = 0", "struct<a:int>": "named_struct('a', cast(id % 2 as int))"}[kind]
    df = spark.range(40).select("id", F.expr(f"case when id % 5 = 0 then null else {key} end").alias("k"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, cast(id % 3 as int))").alias("at"))
    plain = running(df, ["k"], "at", ["id"], hot=None, r=rank(), p=lag("id"))
    split = running(df, ["k"], "at", ["id"], hot=5, r=rank(), p=lag("id"))
    assert sorted(map(repr, plain.select("id", "r", "p").collect())) == sorted(map(repr, split.select("id", "r", "p").collect()))


def test_keys_are_counted_once(log):
    assert resolve_hot(log, ["k"], 50) is resolve_hot(log, ["k"], 50)
    assert resolve_hot(log, ["k"], "auto") is None


def test_keys_are_counted_again_when_the_table_has_grown(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select(F.lit("a").alias("k")).write.parquet(path)
    first = resolve_hot(spark.read.parquet(path), ["k"], 50)
    assert first is resolve_hot(spark.read.parquet(path), ["k"], 50)
    spark.range(100).select(F.lit("b").alias("k")).write.mode("append").parquet(path)
    assert values(resolve_hot(spark.read.parquet(path), ["k"], 50), "k") == [("a",), ("b",)]
    session.discard(first)  # a list whose folder is gone is made again
    assert values(resolve_hot(spark.read.parquet(path), ["k"], 50), "k") == [("a",), ("b",)]
    skew.forget(spark)
    assert values(resolve_hot(spark.read.parquet(path), ["k"], 50), "k") == [("a",), ("b",)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(log, rows, how):
    dims = rows([("hot", 1), ("a", 2), ("a", 3), (None, 4), ("z", 5)], "k string, v int")
    plain = log.join(dims, ["k"], how)
    salted = salted_join(log, dims, ["k"], how, hot=20)
    assert plain.exceptAll(salted).isEmpty() and salted.exceptAll(plain).isEmpty()
    assert salted.columns == plain.columns


def test_attached_columns_equal_a_join(log, rows):
    dims = rows([("hot", 1), ("a", 2), ("a", 3), (None, 4), ("z", 5)], "k string, v int")
    plain = running(log, ["k"], "at", ["id"], hot=None, r=rank()).join(dims, ["k"], "left").select("id", "k", "v")
    for limit in (None, 1, 60, 1000):
        both = running(log, ["k"], "at", ["id"], hot=limit, attach=dims, r=rank())
        assert sorted(map(repr, both.select("id", "k", "v").collect())) == sorted(map(repr, plain.collect())), limit


def test_exact_copies_of_a_hot_row_are_all_kept(spark):
    copies = spark.range(1000, numPartitions=8).select(F.lit("k").alias("k"), F.lit(1).alias("v"))
    dims = spark.createDataFrame([("k", "d")], "k string, d string")
    out = salted_join(copies, dims, ["k"], "left", hot=10)
    assert out.count() == 1000


def test_rank_ties_nulls_and_single(rows):
    df = rows([(1, "a", "2024-01-01 10:00:00"), (2, "a", "2024-01-01 10:00:00"), (3, "a", "2024-01-02 10:00:00"), (4, "a", None), (5, "b", "2024-01-01 00:00:00")],
              "id long, awb string, dispatch_time ts")
    for hot in (None, 1):
        assert values(attempt_rank(df, hot=hot), "id", "attempt_number") == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 1)]


@pytest.mark.parametrize("moment", ["2024-01-01 10:00:00", None])
def test_one_moment_is_cut_into_stretches(rows, monkeypatch, moment):
    """A key whose rows share one time or have none, and no tie to tell them apart: no stretch stays whole."""
    seen = []
    monkeypatch.setattr(ordered, "written", lambda df, name: seen.append(session.written(df, name)) or seen[-1])
    data = [(i, None, moment) for i in range(3000)] + [(i, "a", f"2024-01-0{1 + i % 9} 00:00:00") for i in range(3000, 6000)]
    df = rows(data, "id long, awb string, dispatch_time ts")
    split = attempt_rank(df, hot=300)
    plain = attempt_rank(df, hot=None)
    assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()
    stretches = seen[-1].groupBy("awb", "_seg").count()
    assert stretches.agg(F.max("count")).first()[0] <= 3 * 300


def test_many_hot_keys_share_few_tasks(rows, monkeypatch):
    """The number of stretches does not follow the number of hot keys, and no stretch grows beyond its rows."""
    seen = []
    monkeypatch.setattr(ordered, "written", lambda df, name: seen.append(session.written(df, name)) or seen[-1])
    df = rows([(i, i % 500, f"2024-01-0{1 + i % 7} 00:00:00", i % 3) for i in range(2000)], "id long, k long, at ts, s long")
    plain = running(df, ["k"], "at", ["id"], hot=None, r=rank(), p=lag("s"), x=lead("s"))
    for tasks, size, least, most in ((ordered.STRETCH_TASKS, ordered.STRETCH_ROWS, 100, 256), (4, 100, 10, 20)):
        monkeypatch.setattr(ordered, "STRETCH_TASKS", tasks)
        monkeypatch.setattr(ordered, "STRETCH_ROWS", size)
        split = running(df, ["k"], "at", ["id"], hot=1, r=rank(), p=lag("s"), x=lead("s"))
        assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()
        assert least <= seen[-1].select("_seg").distinct().count() <= most


def test_grid_equals_full_join(rows):
    left = rows([(i, None if i % 3 else "a") for i in range(90)] + [(900, "left"), (901, "b")], "x int, k string")
    right = rows([(i, None if i % 2 else "a") for i in range(60)] + [(900, "right"), (901, "b"), (902, "b")], "y int, k string")
    plain = joins.full_null_safe(left, right, ["k"], hot=None)
    assert plain.count() == 60 * 30 + 30 * 30 + 2 + 2
    for limit in (2, 7, 35, 55):
        grid = joins.full_null_safe(left, right, ["k"], hot=limit)
        assert grid.columns == plain.columns
        assert plain.exceptAll(grid).isEmpty() and grid.exceptAll(plain).isEmpty(), limit


def test_null_times_null_is_split_over_cells(rows):
    left, right = rows([(i, None) for i in range(400)], "x int, k string"), rows([(i, None) for i in range(300)], "y int, k string")
    hot = resolve_hot(left, ["k"], 50), resolve_hot(right, ["k"], 50)
    assert joins._on_grid(left, right, ["k"], *hot).count() == 400 * 300
    per_row = left.select(joins.salt(left.columns, F.lit(hot[0].first()["hot_parts"])).alias("cell")).groupBy("cell").count()
    assert per_row.agg(F.max("count")).first()[0] < 100 and per_row.count() == 9


def test_grid_repeats_rows_no_more_often_on_larger_tables(rows, monkeypatch):
    """Cells stay few whatever the limit is: a row meets a bounded number of columns, and all pairs are made."""
    left, right = rows([(i, None) for i in range(800)] + [(i, i % 9) for i in range(800, 1700)], "x int, k int"), rows([(i, None) for i in range(600)] + [(i, i % 9) for i in range(600, 1500)], "y int, k int")
    hot = resolve_hot(left, ["k"], 2), resolve_hot(right, ["k"], 2)
    asked = sum((r["hot_parts"] * s["hot_parts"]) for r in hot[0].collect() for s in hot[1].collect() if r["k"] == s["k"])
    by = joins._coarser(["k"], *hot)
    assert asked > 50 * joins.GRID_CELLS and asked / by ** 2 <= 1.01 * joins.GRID_CELLS
    cells = joins._on_grid(left, right, ["k"], *hot)
    assert cells.count() == 800 * 600 + 9 * 100 * 100
    monkeypatch.setattr(joins, "HOT_MIN_ROWS", 4)  # no side of a cell beyond this many rows
    assert joins._coarser(["k"], *hot) <= 2.01
    assert joins._coarser(["k"], hot[0].drop("hot_rows"), hot[1]) == 1.0
    assert joins._coarser(["k"], hot[0], None) >= 1.0 and joins._coarser(["k"], None, hot[1]) >= 1.0


def test_runs(rows):
    df = rows([(1, "a", "2024-01-01 01:00:00", "O"), (2, "a", "2024-01-01 02:00:00", "O"), (3, "a", "2024-01-01 03:00:00", "F"),
               (4, "a", "2024-01-01 04:00:00", "F"), (5, "a", "2024-01-01 05:00:00", "O"), (6, "a", "2024-01-01 01:30:00", "other")],
              "id long, k string, at ts, s string")
    for hot in (None, 1):
        assert values(pick.collapse_runs(df, ["k"], "at", "id", "s", ["O", "F"], hot=hot), "id") == [(1,), (3,), (5,)]


def test_pick_one(rows):
    df = rows([(1, "a", "2024-01-01 00:00:00"), (2, "a", "2024-01-02 00:00:00"), (3, "a", "2024-01-02 00:00:00"), (4, None, "2024-01-01 00:00:00"), (5, "b", None)],
              "id long, k string, at ts")
    assert values(pick.distinct_on(df, ["k"], [F.desc_nulls_first("at"), "id"]), "id") == [(2,), (4,), (5,)]
    assert values(pick.keep_argmax(df, ["k"], "at", "id"), "id") == [(2,)]
    assert values(pick.rank_top(df.filter("k = 'a'"), ["k"], [F.desc("at")]), "id") == [(2,), (3,)]
    with pytest.raises(ValueError):
        pick.distinct_on(df, ["k"], [])


def test_neighbours_forms_agree(rows):
    df = rows([("a", "2024-01-01 00:00:00", 1), ("a", "2024-01-02 00:00:00", 2), ("a", "2024-01-02 00:00:00", 2), ("a", "2024-01-05 00:00:00", 4)], "awb string, at ts, n int")
    wide = joins.neighbours(df, "awb", "n", "at", "p", "x")
    bounded = joins.neighbours(df, "awb", "n", "at", "p", "x", bounded=True)
    assert values(wide, "n", "p", "x") == values(bounded, "n", "p", "x") == [
        (1, None, "2024-01-02 00:00:00"), (2, "2024-01-01 00:00:00", None), (2, "2024-01-01 00:00:00", None), (4, None, None)]


@pytest.mark.parametrize("hot", [None, 1])
def test_interval_boundaries(rows, hot):
    attempts = rows([("a", 1, "2024-01-01 10:00:00"), ("a", 2, "2024-01-02 10:00:00"), ("b", 3, "2024-01-01 10:00:00"), ("c", 4, "2024-01-01 10:00:00")], "awb string, task int, at ts")
    replies = rows([("a", 1, "2024-01-01 10:00:00"), ("a", 2, "2024-01-02 10:00:00"), ("a", 3, "2024-01-05 00:00:00"), ("b", 4, "2023-12-31 00:00:00"),
                    ("c", 5, "2024-01-03 00:00:00"), ("c", 6, "2024-01-03 00:00:00"), (None, 7, "2024-01-03 00:00:00")], "awb string, reply int, said ts")
    out = joins.interval_latest(attempts, replies, "awb", "at", "said", "reply", hot=hot)
    # Reply 2 falls on the second attempt: it is the latest of attempt 1 and, until reply 3, belongs to attempt 2 too.
    assert values(out, "task", "reply") == [(1, 2), (2, 3), (3, None), (4, 6)]


def test_not_in_nulls(rows):
    df = rows([(1,), (2,), (None,)], "v int")
    assert values(joins.not_in(df, "v", rows([(1,)], "w int"), "w")) == [(2,)]
    assert values(joins.not_in(df, "v", rows([(1,), (None,)], "w int"), "w")) == []
    assert values(joins.not_in(df, "v", rows([], "w int"), "w")) == [(1,), (2,), (None,)]


def test_full_join_matches_null_keys(rows):
    left, right = rows([("a", 1), (None, 2)], "k string, x int"), rows([("b", 3), (None, 4)], "k string, y int")
    assert values(joins.full_null_safe(left, right, ["k"])) == [("a", 1, None), ("b", None, 3), (None, 2, 4)]


def test_after_is_strict(rows):
    events = rows([(1, "a", "2024-01-01 10:00:00"), (2, "a", "2024-01-01 10:00:01")], "id int, k string, at ts")
    marks = rows([("a", "2024-01-01 10:00:00")], "k string, mark ts")
    assert values(joins.after(events, marks, ["k"], "at", "mark"), "id") == [(2,)]

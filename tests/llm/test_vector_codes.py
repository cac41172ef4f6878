"""Product codes by norm-of-sum bounds against full scans."""
import hashlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from llm_samples import SF, folder  # noqa: F401
from pyspark.sql import functions as F
from test_text_operators import same_as_sql

from haulmark.llm import vector_codes as vc

KINDS = "vec_id long, embedding array<double>, label int"


def brute(rows, entries=256, rounds=4, parts=4):
    kept = [(i, np.floor(1024 * np.array(v, float)).astype(object), y) for i, v, y in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, list(r[1])))
    cut = [[v.reshape(parts, -1)[p] for p in range(parts)] for _, v, _ in kept]
    books = [[list(map(int, c[p])) for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        d = [sum((int(a) - b) ** 2 for a, b in zip(x, e)) for e in book]
        return min(range(len(d)), key=lambda j: (d[j], j)), min(d)
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(c[p], books[p])[0], []).append(c[p])
            for j, members in groups.items():
                books[p][j] = [int(sum(col)) // len(members) for col in zip(*members)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    final = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for _, d in f) for f in final]
    of = {}
    for (_, _, y), e in zip(kept, errors):
        of[y] = of.get(y, 0) + e
    return sorted(((i, "".join(f"{j:02x}" for j, _ in f), e, of[y], sha) for (i, _, y), f, e in zip(kept, final, errors)), key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_equals_sql(spark, folder):
    same_as_sql(vc.report(spark.read.parquet(f"{SF}/embeddings.parquet")), vc.brute_sql())


def test_query_equals_brute_force(spark, folder):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in pq.read_table(f"{SF}/embeddings.parquet").to_pylist()][:60]
    df = spark.createDataFrame(rows, KINDS)
    assert rows_of(vc.report(df)) == brute(rows)


def test_odd_rows(spark, folder):
    nan, inf = float("nan"), float("inf")
    rows = [(3, [0.1, -0.2, 0.3, -0.0005], 1), (1, [0.1, -0.2, 0.3, -0.0005], None), (1, [0.1, -0.2, 0.3, 0.4], None), (1, [0.1, -0.2, 0.3, 0.4], 2), (None, [5.0, 0.0, 0.0, 1.0], 1),
            (4, None, 1), (5, [0.1, None, 0.2, 0.3], 1), (6, [nan, 0.0, 0.0, 0.0], 1), (7, [inf, 0.0, 0.0, -inf], 3), (8, [-3.3, 2.2, 9.0, 900.0], 2)]
    df = spark.createDataFrame(rows, KINDS).withColumns({c: F.lit("clash") for c in ("x", "v", "code", "bound", "error", "a.b")})
    assert rows_of(vc.report(df)) == brute(rows)
    none = spark.createDataFrame(rows[5:9], KINDS)
    assert vc.report(none).collect() == [] and vc.report(none.limit(0)).collect() == []


def test_lengths_are_filled_with_zeros(spark, folder):
    rows = [(1, [0.5], 1), (2, [0.5, 1.0, 2.0, 0.0, 0.25], 1), (3, [], 1)]
    full = [(i, v + [0.0] * (8 - len(v)), y) for i, v, y in rows]
    assert rows_of(vc.report(spark.createDataFrame(rows, KINDS))) == brute(full)


def test_very_large_components(spark, folder):
    rows = [(i, [1e300 * (-1) ** i, 1e4, i * 1.0, -1e300], 1) for i in range(6)]
    held = [(i, [max(-2.0**14, min(2.0**14, x)) for x in v], y) for i, v, y in rows]
    assert rows_of(vc.report(spark.createDataFrame(rows, KINDS))) == brute(held)


def test_few_entries_skip_scans(spark, folder):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 8)) * 3
    rows = [(i, (centres[i % 40] + rng.normal(size=8) * 0.05).tolist(), i % 3) for i in range(600)]
    df = spark.createDataFrame(rows, KINDS)
    codes, book, scans = vc.train(vc.quantised(df), rounds=6, entries=100)
    want = brute(rows, entries=100, rounds=6)
    assert sorted((r.vec_id, bytes(r.code).hex(), r.error) for r in codes.collect()) == [w[:3] for w in sorted(want)]
    assert hashlib.sha256(vc.codebook_text(book).encode()).hexdigest() == want[0][4]
    assert scans[0] == 600 * 4 * 4 and scans[-1] < scans[0] / 2
    back = {r.vec_id: np.array(r.v) for r in vc.decoded(codes, book).collect()}
    assert all(((back[i] - np.floor(1024 * np.array(v))) ** 2).sum() == w[2] for (i, v, _), w in zip(rows, sorted(want)))


@pytest.mark.parametrize("seed", range(30))
def test_bounds_never_change_an_assignment(seed):
    rng = np.random.default_rng(seed)
    n, width = int(rng.integers(2, 120)), int(rng.integers(1, 5))
    rows = rng.integers(-9, 10, size=(300, width))
    history = [rng.integers(-9, 10, size=(n, width))]
    state = (None, None, None)
    for _ in range(8):
        *state, square, _ = vc.assign(rows, np.stack(history), *state)
        d = np.square(rows[:, None, :] - history[-1][None]).sum(2)
        assert (state[0] == d.argmin(1)).all() and (square == d.min(1)).all()
        history.append(history[-1] + rng.integers(-1, 2, size=(n, width)) * (rng.random((n, 1)) < 0.3))


def test_true_moves_are_tighter_than_their_sum():
    there, back = np.zeros((1, 40, 2)), np.zeros((1, 40, 2))
    there[0, 3] = 5
    moves = vc.Moves(np.concatenate([back, there, back]))
    assert moves.of(0, np.array([0]), np.array([7]))[0] == 0  # out and back: no net move
    assert moves.of(0, np.array([1]), np.array([7]))[0] > 7 and moves.of(0, np.array([1]), np.array([3]))[0] == 0

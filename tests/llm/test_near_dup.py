"""Near duplicates against all pairs."""
import random
from collections import defaultdict

import numpy as np
import pytest
from llm_samples import ODD, SAMPLE, SF, empty, folder, low, odd, table, words  # noqa: F401
from pyspark.sql import functions as F
from test_text_operators import same_as_sql

from haulmark.llm import near_dup, shingles
from haulmark.llm.common import components


def shingle_set(text, width):
    w = words(low(text))
    if len(w) < width:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def groups(rows, width, percent=80):
    """Component of each row number by comparing all pairs; rows of one id are one document."""
    sets = [shingle_set(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] and sets[j]
            if sets[i] and sets[j] and (100 * both >= percent * len(sets[i] | sets[j]) or same_id):
                root[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = doc if least[find(i)] is None else min(doc, least[find(i)])
    return [(d, len(s), least[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


@pytest.mark.parametrize("width", [2, 5])
def test_documents_equal_brute_force(spark, folder, width):
    rows = [(r["doc_id"], r["text"]) for r in table("documents")]
    out = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=width)
    assert found(out) == sorted(groups(rows, width), key=repr)


@pytest.mark.parametrize("width", [2, 5])
def test_documents_equal_sql(spark, folder, width):
    same_as_sql(near_dup.near_duplicates(spark.read.parquet(f"{SF}/documents.parquet"), width=width), near_dup.brute_sql(width))


def test_odd_rows(odd):
    out = near_dup.near_duplicates(odd, width=2)
    # A null id takes the component of an equal set, but links nothing.
    with_id = [(d, t) for d, t in ODD if d is not None]
    expected = groups(with_id, 2)
    assert found(out.filter("doc_id is not null")) == sorted(expected, key=repr)
    nulls = {r.n_shingles: r for r in out.filter("doc_id is null").collect()}
    assert nulls[len(shingle_set(SAMPLE, 2))].component_id == 1 and not nulls[len(shingle_set(SAMPLE, 2))].kept
    assert nulls[0].component_id is None and nulls[0].kept


def test_keep_one_leaves_one_of_each(odd):
    kept = near_dup.keep_one(odd, width=2)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted((i for i in ids if i is not None)) == [1, 4, 5, 6, 7, 9, 11, 13, 14, 15]


def test_texts_of_one_id_stay(spark, folder):
    one, two, three = (" ".join(f"{c}{k}" for k in range(60)) for c in "abc")
    rows = [(11, one, "x"), (11, two, "x"), (11, two + " tail", "x"), (20, two + " end", "x"), (21, one + " end", "x"), (5, three, "x"), (30, three, "x"),
            (30, "other words here", "x"), (30, "other words here", "y"), (None, one, "x"), (None, "no id", "x"), (None, "no id", "x"), (7, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit("z") for c in ("row", "node", "hash", "id", "own")})
    outs = [sorted(map(tuple, near_dup.keep_one(d, by_text=True).collect()), key=repr) for d in (df, df.orderBy("text"), df.repartition(5))]
    assert outs[0] == outs[1] == outs[2] and near_dup.keep_one(df, by_text=True).columns == df.columns
    kept = [r[:2] for r in outs[0]]
    of_two = [t for i, t in kept if i == 11 and t != one]
    assert len(of_two) == 1 and of_two[0] in (two, two + " tail")
    assert sorted(kept, key=repr) == sorted([(5, three), (7, None), (11, one), (11, of_two[0]), (30, "other words here"), (None, "no id")], key=repr)


def test_empty(empty):
    assert near_dup.near_duplicates(empty).collect() == []
    assert near_dup.keep_one(empty).columns == empty.columns


def test_large_groups_of_near_copies(spark, folder):
    """More members than a block holds, chained so that the ends are far apart, among texts that share half their words."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    rows, text = [], list(base)
    for i in range(700):
        if i % 20 == 0:
            text = list(text)
            text[rng.randrange(60)] = f"c{i}"
        rows.append((i, " ".join([*text, f"e{i % 3}"])))
    common = " ".join(f"p{i}" for i in range(50))
    rows += [(1000 + i, common + " " + " ".join(f"q{i}_{j}" for j in range(40))) for i in range(300)]
    out = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2)
    assert found(out) == sorted(groups(rows, 2), key=repr)


def connected(edges, n):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in edges:
        root[find(i)] = find(j)
    return [find(i) for i in range(n)]


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


@pytest.mark.parametrize("seed", range(5))
def test_merging_connects_what_pairs_connect(seed):
    rng = np.random.default_rng(seed)
    n = 150
    sketch = rng.integers(0, 4, (n, 48)).astype(np.uint8)
    group = np.zeros((n, 3), np.int64)
    group[:, 0] = np.sort(rng.integers(0, 9, n))
    rows = near_dup._Rows(group, np.zeros(n, np.int32), np.arange(n), rng.integers(0, 60, n), rng.integers(70, 100, n), sketch)
    starts = rows.starts()
    expected = {(i, j) for i in range(n) for j in range(i + 1, n) if group[i, 0] == group[j, 0] and rows.root[i] != rows.root[j]
                and 100 * min(rows.size[i], rows.size[j]) >= 80 * max(rows.size[i], rows.size[j]) and (sketch[i] == sketch[j]).sum() >= 16}
    i, j = near_dup._short_lists(rows, starts, 16, 80)
    assert {(min(a, b), max(a, b)) for a, b in zip(i, j)} == expected
    a, b = near_dup._joining(i, j)
    assert same_partition(connected(zip(a, b), n), connected(expected, n)) and len(a) < n
    forest = []
    for s, e in zip(starts, [*starts[1:], n]):
        for chunks in (np.zeros(e - s, np.int32), np.arange(e - s) % 2):
            part = rows.at(slice(s, e))
            part.chunk = chunks
            first, right, fits = near_dup._block(part, 16, 80)
            a, b = near_dup._forest(first, right, fits)
            assert len(a) < e - s
            inside = {(x - s, y - s) for x, y in expected if s <= x < e and (chunks.max() == 0 or chunks[x - s] != chunks[y - s])}
            assert same_partition(connected(zip(a, b), e - s), connected(inside, e - s))
            if chunks.max() == 0:
                forest += [(x + s, y + s) for x, y in zip(a, b)]
    assert same_partition(connected(forest, n), connected(expected, n))


def test_shared_counts_intersections():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 9000, rng.integers(1, 3000))) for _ in range(12)]
    got = near_dup._shared(sets[:5], sets[5:])
    assert got.tolist() == [[len(np.intersect1d(x, y)) for y in sets[5:]] for x in sets[:5]]


def test_signature_estimates_similarity():
    a, b = shingles.coefficients(48)
    left, right = (shingles.shingle_set(" ".join(f"t{i}" for i in range(s, s + 900)), 1) for s in (0, 100))
    same = (shingles.signature(left, a, b) == shingles.signature(right, a, b)).mean()
    assert abs(same - 0.8) < 0.2


def test_components(spark, folder):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 200)]
    out = components(spark.createDataFrame(edges, "a long, b long"))
    got = {r.node: r.root for r in out.collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []

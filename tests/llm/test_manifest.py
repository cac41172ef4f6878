"""Merkle manifest against a plain tree."""
import hashlib
import zlib

import pytest
from llm_samples import ODD, SF, empty, folder, odd, table  # noqa: F401
from pyspark.sql import functions as F
from test_text_operators import same_as_sql

from haulmark.llm import manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        run = range(at // 2 * 2, min(at // 2 * 2 + 2, len(level)))
        out.append(([level[i] for i in run if i < at], [level[i] for i in run if i > at]))
        at //= 2
    return out


def climb(x, steps):
    for left, right in steps:
        x = h(*left, x, *right)
    return x


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)"""
    def leaf(r, more=0):
        d, text, lang, source, n = r
        return h(*map(field, (d, source, lang, None if n is None else n + more, text)))
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = mine, tree([leaf(r) for r in mine])
    top = tree([trees[x][1][-1][0] for x in langs])
    out = []
    for k, lang in enumerate(langs):
        mine, levels = trees[lang]
        for i, r in enumerate(mine):
            steps = path(levels, i) + path(top, k)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = climb(leaf(r, int(bad)), steps)
            out.append((r[0], leaf(r), levels[-1][0], top[-1][0], h(*(x for a, b in steps for x in a + b)), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def rows_of(df, levels=manifest.LEVELS):
    return sorted(map(tuple, manifest.manifest(df, levels).collect()), key=repr)


def test_documents_equal_a_plain_tree_and_sql(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = manifest.manifest(docs)
    plain = brute([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in table("documents")])
    assert sorted(map(tuple, got.collect()), key=repr) == plain
    assert {r[-1] for r in plain} == {True, False}
    same_as_sql(got, manifest.brute_sql())


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_superblocks_of_any_size(spark, folder, levels):
    rows = [(i * 3 + 10**17, f"text {i}", ("en", None, "", "fr", "é", "z")[min(5, i % 9)], "s", None if i % 5 == 0 else i) for i in range(75)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert rows_of(df, levels) == brute(rows)


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in odd.collect()]
    assert rows_of(odd.withColumn("tree", F.lit(1)).withColumn("pos", F.lit(1)).withColumn("a.b", F.lit(1))) == brute(rows)
    assert rows_of(empty) == []


def test_one_row_and_equal_rows(spark, folder):
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    one = [(None, None, None, None, None)]
    assert rows_of(spark.createDataFrame(one, kinds)) == brute(one)
    many = [(7, "same", "en", "s", 1)] * 300 + [(2**62 + 1, "x", "en", None, 2**63 - 1), (None, "x", "en", None, 3)]
    assert rows_of(spark.createDataFrame(many, kinds).repartition(4)) == brute(many)

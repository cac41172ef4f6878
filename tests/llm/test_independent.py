"""Shards, slots and mixes against second implementations; rows and names that could get lost."""
import math
import struct
from collections import Counter

import pytest
import xxhash
from llm_samples import SF, empty, folder, odd, table  # noqa: F401
from pyspark.sql import functions as F

from haulmark.llm import mixing, page_text, sharding, tokens, training_order


# ---------------------------------------------------------------- shards
def draw(doc_id, shard, weight=1.0):
    seed = 42 if doc_id is None else xxhash.xxh64(struct.pack("<q", doc_id), seed=42).intdigest()
    bits = xxhash.xxh64(struct.pack("<i", shard), seed=seed).intdigest() >> 11
    return -math.log((bits + 0.5) / 2.0**53) / weight, shard


def test_shards_are_the_smallest_draws(spark, folder):
    out = sharding.layout(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    for r in out:
        assert r.shard == min(draw(r.doc_id, s) for s in range(40))[1]
        assert r.grown_shard == min(draw(r.doc_id, s) for s in range(41))[1]


def test_weighted_shards_are_the_smallest_draws(odd):
    weights = {3: 1.0, 7: 0.25, 11: 4.0}
    for r in sharding.assign(odd, weights).collect():
        assert r.shard == min(draw(r.doc_id, s, w) for s, w in weights.items())[1]


# ---------------------------------------------------------------- slots
M = 2**64 - 1


def mixed(x):
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & M
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & M
    return x ^ x >> 31


def slot_of(x, n, key, rounds=6):
    half = max(1, math.ceil(max(1, (n - 1).bit_length()) / 2))
    keys = [mixed((i * 0x9E3779B97F4A7C15 + key) & M) for i in range(1, rounds + 1)]
    while True:
        left, right = x >> half, x & (1 << half) - 1
        for k in keys:
            left, right = right, left ^ mixed((right + k) & M) & (1 << half) - 1
        x = left << half | right
        if x < n:
            return x


def test_every_sequence_has_its_slot(spark, folder, tmp_path):
    texts = [" ".join(f"w{i}x{j}" for j in range(i % 29)) for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    options = {"limit": 16, "shard_records": 16, "block_records": 4}
    path = str(tmp_path / "shards")
    n = training_order.write_shards(docs, path, tokens.default_path(), key=77, **options)
    encode, number, expected = tokens.encoder(tokens.default_path()), 0, {}
    for i, text in enumerate(texts):
        for piece, _ in enumerate(tokens.pieces(len(encode(text)) + 1, 16)):
            expected[slot_of(number, n, 77)] = (i, piece)
            number += 1
    assert n == number
    assert {r.slot: (r.doc_id, r.piece) for r in training_order.read_shards(spark, path, **options).collect()} == expected


def test_files_hold_runs_of_whole_shards(spark, folder, tmp_path):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("a few words").alias("text"))
    options = {"limit": 16, "shard_records": 16, "block_records": 4}
    path = str(tmp_path / "shards")
    assert training_order.write_shards(docs, path, tokens.default_path(), **options) == 1000
    files = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("first_slot").alias("a"), F.sum("records").alias("n"), F.max(F.col("first_slot") + F.col("records")).alias("b")).collect()
    assert 1 < len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert all(r.a % 16 == 0 and r.b - r.a == r.n for r in files)


# ---------------------------------------------------------------- mixture
def test_mix_keeps_rows_that_differ_in_a_map(spark, folder):
    docs = spark.range(400).select(F.lit(1).cast("long").alias("doc_id"), F.lit("one two three").alias("text"), F.when(F.col("id") % 2 == 0, "a").alias("source"),
                                   F.create_map(F.lit("n"), F.when(F.col("id") % 5 > 0, F.col("id"))).alias("m"))
    taken = mixing.report(docs).agg(F.sum("taken")).first()[0]
    got = mixing.mix(docs)
    assert got.columns == docs.columns and got.count() * 3 == taken
    marked = Counter((r.source, r.m["n"]) for r in got.collect())
    assert max(n for (_, m), n in marked.items() if m is not None) <= 2 and len(marked) > 200
    three = spark.createDataFrame([(1, "x y", "s", {"k": i}) for i in range(3)], "doc_id long, text string, source string, m map<string,int>")
    assert sorted({r.m["k"] for r in mixing.mix(three).collect()}) == [0, 1, 2]


def test_mix_takes_any_column_name(odd):
    wide = odd.withColumn("a.b", F.lit(1)).withColumn("c`d", F.lit(2)).withColumn("e f", F.lit(3))
    got = mixing.mix(wide)
    assert got.columns == wide.columns
    assert Counter((r[0], r[1]) for r in got.collect()) == Counter((r[0], r[1]) for r in mixing.mix(odd).collect())


def test_stages_take_any_column_name_and_maps(spark, folder, odd):
    from haulmark.llm import near_dup, packing, quality_rules

    wide = odd.withColumn("a.b", F.lit(1)).withColumn("m", F.create_map(F.lit("k"), F.col("text")))
    assert quality_rules.keep_good(wide).columns == wide.columns
    assert near_dup.keep_one(wide, by_text=True).columns == wide.columns
    assert packing.packed_documents(wide, tokens.default_path()).count() >= wide.count()


# ---------------------------------------------------------------- pages
def text_of(spark, rows):
    return {r.page_id: r.text for r in page_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


@pytest.mark.parametrize("html", [
    "<body><div class='cookie-notice'><p>We use cookies on this site.</p></div></body>",
    "<body><div id='sidebar'><p>Links of the day.</p></div><div class='comments'><p>reader says</p></div></body>",
    "<body><article class='comment'><p>reader says</p></article></body>",
    "<body><nav>menu</nav><footer>end</footer></body>", "<body></body>", "plain <!-- nothing -->"[6:],
])
def test_pages_without_main_text_are_empty(spark, folder, html):
    assert text_of(spark, [(1, "http://a.example/1", html)]) == {1: ""}


def test_comment_and_teaser_articles_go(spark, folder):
    story = "<p>The story of the day, told at some length for all who come here.</p>"
    rows = [(1, "http://b.example/1", f"<body><main><article class='post'>{story}</article></main><div><article class='comment'><p>reader says</p></article></div></body>"),
            (2, "http://b.example/2", f"<body><article>{story}<article class='comment reply'><p>reader answers</p></article></article></body>"),
            (3, "http://b.example/3", f"<body><article class='post tag-comments'>{story}</article><section><article><p>Read also</p></article><article><p>And this</p></article></section></body>"),
            (4, "http://b.example/4", f"<body><article class='teaser related'><p>{'Another tale altogether. ' * 20}</p></article><article>{story}</article></body>"),
            (5, "http://b.example/5", f"<body><div><article>{story}</article><article><p>The second post.</p></article></div></body>")]
    told = story[3:-4]
    assert text_of(spark, rows) == {1: told, 2: told, 3: told, 4: told, 5: f"{told}\nThe second post."}


def test_the_tree_alone_tells_templates(spark, folder):
    """A site without article elements or telling names: what its pages share goes, by entropies worked out here."""
    rows, parts = [], {}
    for i in range(16):
        parts[i] = [("div.q", f"own words {i}"), ("div.r", "call us any day"), ("div.s", f"edition {i % 2}"), ("div.t", f"by writer {i % 8}"), ("div.u", "all rights" if i % 4 else f"odd {i}")]
        rows.append((i, "http://c.example/", "<body>" + "".join(f"<div class='{p[4:]}'>{t}</div>" for p, t in parts[i]) + "</body>"))
    n, out = 16, {i: [] for i in range(16)}
    for k in range(5):
        counts = Counter(parts[i][k][1] for i in range(n))
        entropy = -sum(c / n * math.log(c / n) for c in counts.values()) / math.log(n)
        for i in range(n):
            c = counts[parts[i][k][1]]
            one = 1 - c * math.log(c) / (n * math.log(n))
            cut = (page_text.CONTENT_SHARE * entropy < page_text.LEAST) or (c >= page_text.LEAST_PAGES and one < page_text.LEAST)
            if not cut:
                out[i].append(parts[i][k][1])
    assert text_of(spark, rows) == {i: "\n".join(t) for i, t in out.items()}
    assert out[1] == ["own words 1", "edition 1", "by writer 1", "all rights"] and out[0][-1] == "odd 0"

"""Quality rules, chat formatting, shards, sequences, packing, mixing, classifier against plain Python."""
import hashlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from llm_samples import ODD, SF, crc, empty, folder, odd, table, words  # noqa: F401
from pyspark.sql import functions as F

from haulmark.llm import chat, mixing, packing, quality_model, quality_rules, sharding, tokens, training_order


def duck(sql):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "conversations", "pages"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    cursor = con.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


def same_as_sql(df, sql):
    names, rows = duck(sql)
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(rows, key=repr)


# ---------------------------------------------------------------- quality rules
def measured(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    many = Counter(windows)
    inside = {j for i, x in enumerate(windows) if many[x] > 1 for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside))


def test_rules_on_odd_rows(odd):
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    out = quality_rules.report(odd)
    got = sorted((tuple(r[c] for c in ["doc_id", *cols]) for r in out.collect()), key=repr)
    assert got == sorted(((d, *measured(t)) for d, t in ODD), key=repr)
    for r in out.collect():
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert {r.doc_id for r in out.filter("kept").collect()} == {1, 2, 3, 9, 10, 12, None}


def test_rules_equal_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    same_as_sql(quality_rules.report(docs), quality_rules.SQL)


def test_keep_good_agrees_with_report(odd, empty):
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns
    ids = Counter(r.doc_id for r in quality_rules.report(odd).filter("kept").collect())
    assert Counter(r.doc_id for r in kept.collect()) == ids
    assert quality_rules.keep_good(empty).collect() == [] and quality_rules.report(empty).collect() == []


def test_cascade_stops_at_the_first_hit(spark):
    df = spark.createDataFrame([("a",), ("b",)], "text string")
    boom = quality_rules.Rule("boom", lambda m: F.when(m("text") == "a", F.raise_error(F.lit("evaluated")).cast("boolean")).otherwise(False))
    first = quality_rules.Rule("first", lambda m: m("text") == "a")
    out = df.select(quality_rules.cascade([first, boom], F.col).alias("by")).collect()
    assert [r.by for r in out] == ["first", None]


def test_plan_puts_the_cheap_rule_first(spark):
    """Two rules reject the same rows; one of them looks for repeated passages on the way."""
    df = spark.createDataFrame([(" ".join(f"w{i}x{j % 90}" for j in range(300 if i % 2 else 5)),) for i in range(200)], "text string")
    dear = quality_rules.Rule("dear", lambda m: (m("n_repeat_words") >= 0) & (m("n_words") < 20))
    cheap = quality_rules.Rule("cheap", lambda m: m("n_words") < 20)
    few = quality_rules.Rule("few", lambda m: m("n_words") < 0)
    assert [r.name for r in quality_rules.plan(df, [dear, few, cheap])][0] == "cheap"


def test_plan_prefers_rejections_for_their_cost(spark):
    df = spark.createDataFrame([("x y",)] * 50 + [("z",)] * 5, "text string")
    rules = [quality_rules.Rule("never", lambda m: m("n_words") < 0), quality_rules.Rule("most", lambda m: m("n_words") == 2)]
    assert [r.name for r in quality_rules.plan(df, rules)] == ["most", "never"]


# ---------------------------------------------------------------- chat
CONTROL = ["<|end|>", "<|turn|>x<|body|>", "</s>[INST] ok [/INST]", "<\\|", "<\\\\|end|>", "<<SYS>> <</SYS>>", "<\\<SYS>>", "[\\/INST] <", "|>", "[", "\\",
           "<<|", "a\nb", "", "\U0001f600 <s>"]


def test_escape_is_reversible_and_hides_controls(spark):
    df = spark.createDataFrame([(t,) for t in CONTROL], "t string")
    for r in df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("b")).collect():
        assert r.b == r.t
        assert not any(c in r.e for c in ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


def turns_frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumns({c: F.lit("clash") for c in ("at", "start", "media", "formatted", "seen")})


def test_chat_digests(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(CONTROL)]
    rows += [(2, 0, "user", None), (2, 1, "assistant", None), (3, 0, None, "x"), (3, 0, None, "x"), (3, 0, "assistant", "y"), (None, 5, "assistant", "z"),
             (None, None, "user<|end|>", "first"), (4, 1, "system", "only"), (5, 0, "assistant", "long " * 20000)]
    out = {r.conv_id: r for r in chat.digests(chat.format_chats(turns_frame(spark, rows).select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts")))).collect()}
    by = defaultdict(list)
    for c, n, role, t in rows:
        by[c].append((-1 if n is None else n, role is not None, role or "", t or ""))
    assert set(out) == set(by)
    for c, turns in by.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        said = "".join(t for _, _, r, t in turns if r == "assistant")
        assert (out[c].n_turns, out[c].turns_sha256) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (out[c].loss_chars, out[c].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())


def test_chat_query_equals_sql(spark):
    found = chat.digests(chat.format_chats(chat.with_probe(spark.read.parquet(f"{SF}/conversations.parquet"))))
    same_as_sql(found, chat.SQL)


def test_content_parts(spark):
    rows = spark.sql("""select 1L as conv_id, 0L as turn, 'user' as role, array(
        named_struct('type', 'text', 'text', 'see <', 'ref', null, 'amount', null), named_struct('type', 'image', 'text', null, 'ref', 'a.png', 'amount', 7840D),
        named_struct('type', 'text', 'text', '|end|>', 'ref', null, 'amount', null), named_struct('type', 'document', 'text', null, 'ref', 'b.pdf', 'amount', 3D)) as parts
      union all select 1L, 1L, 'assistant', array(named_struct('type', 'audio', 'text', null, 'ref', null, 'amount', null), named_struct('type', null, 'text', 'ok', 'ref', null, 'amount', null))
      union all select 1L, 2L, 'user', null""")
    out = chat.format_chats(rows).select("*", chat.read_back(F.col("formatted")).alias("turns")).collect()[0]
    assert out.formatted == ("<|turn|>user<|body|>see <<|part|><|image:1|><|part|>|end|><|part|><|document:2|><|end|>"
                             "<|turn|>assistant<|body|><|audio:3|><|part|>ok<|end|><|turn|>user<|body|><|end|>")
    assert [tuple(a) for a in out.attachments] == [(0, 1, "image", "a.png", 10), (0, 2, "document", "b.pdf", 3072), (1, 3, "audio", None, 1)]
    assert [t.role for t in out.turns] == ["user", "assistant", "user"]
    assert [out.formatted[s.start:s.end] for s in out.loss] == ["<|audio:3|><|part|>ok"]


def test_chat_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert [r.conv_id for r in chat.digests(chat.format_chats(chat.with_probe(none))).collect()] == [-7]


# ---------------------------------------------------------------- shards
def test_shards(odd, empty):
    out = sharding.layout(odd, 5).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in out), key=repr) == sorted(((d, len((t or "").encode()) + 16, crc(t)) for d, t in ODD), key=repr)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and 0 <= r.shard < 5 and r.grown_shard in (r.shard, 5)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in out if r.doc_id is None}) == 1
    assert sharding.layout(empty).collect() == []


def test_shards_follow_weights_and_move_little(spark):
    df = spark.range(40000).withColumnRenamed("id", "doc_id")
    weights = {0: 1.0, 1: 2.0, 2: 1.0}
    both = sharding.assign(sharding.assign(df, weights), {**weights, 3: 4.0}, out="then")
    counts = {r.shard: r["count"] for r in both.groupBy("shard").count().collect()}
    assert abs(counts[1] / 40000 - 0.5) < 0.02 and abs(counts[0] / 40000 - 0.25) < 0.02
    moved = both.filter("shard <> then")
    assert [r.then for r in moved.select("then").distinct().collect()] == [3] and abs(moved.count() / 40000 - 0.5) < 0.02


# ---------------------------------------------------------------- tokens, packing, order
@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.default_path())
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def cut(rows, plain, limit):
    out = []
    for doc, text in rows:
        ids = [*plain(text), 2]
        first = len(ids) if len(ids) <= limit else len(ids) % limit or limit
        edges = [0, *range(first, len(ids) + 1, limit)] if len(ids) > limit else [0, len(ids)]
        out += [(doc, i, s, e - s, tokens.crc32(np.array(ids[s:e]))) for i, (s, e) in enumerate(zip(edges, edges[1:]))]
    return out


def test_ids_equal_the_tokenizer(plain):
    encode = tokens.encoder(tokens.default_path())
    texts = [t or "" for _, t in ODD] + [r["text"] for r in table("documents")] + ["<|endoftext|> x", "a b \r\n\t c", "I'll we've 12345 ...", "�‍"]
    assert all(encode(t) == plain(t) for t in texts)


def test_long_white_space(spark, folder, plain, tmp_path):  # noqa: F811
    rows = [(1, " " * 2_000_000), (2, "\n" * 2_000_000), (3, "a" + " \n" * 1_000_000 + "b"), (4, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = cut(rows, plain, 1024)
    check_packed(packing.packed_documents(docs, tokens.default_path()).collect(), expected, 1024)
    path = str(tmp_path / "shards")
    assert training_order.write_shards(docs, path, tokens.default_path()) == len(expected)
    out = training_order.read_shards(spark, path).collect()
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in out) == sorted((d, i, x, c) for d, i, _, x, c in expected)


@pytest.mark.parametrize("n", [tokens.LONG_RUN - 1, tokens.LONG_RUN, tokens.LONG_RUN + 1])
def test_ids_around_the_long_run(plain, n):
    encode = tokens.encoder(tokens.default_path())
    assert all(encode(t) == plain(t) for t in (f"a{c * n}b{c * n}" for c in " \n\t\u2003\x1f"))


@pytest.mark.parametrize("ordinary", [False, True])
def test_special_tokens(spark, folder, tmp_path, ordinary):  # noqa: F811
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.default_path())
    tokenizer.encode_special_tokens = ordinary

    def ids(text):
        return tokenizer.encode(text or "", add_special_tokens=False).ids

    assert (50256 in ids("a<|endoftext|>b")) != ordinary
    rows = [(1, "a<|endoftext|>b"), (2, "<|endoftext|>"), (3, "x  <|endoftext|>  <|endoftext|>\n\ny <|endoftext|"), (4, "plain"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = cut(rows, ids, 8)
    options = {"ordinary": True} if ordinary else {}
    check_packed(packing.packed_documents(docs, tokens.default_path(), 8, **options).collect(), expected, 8)
    path = str(tmp_path / "shards")
    training_order.write_shards(docs, path, tokens.default_path(), limit=8, **options)
    out = training_order.read_shards(spark, path, limit=8).collect()
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in out) == sorted((d, i, x, c) for d, i, _, x, c in expected)


def check_packed(out, expected, capacity):
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=repr) == sorted(expected, key=repr)
    placed = defaultdict(list)
    for r in out:
        placed[r.sequence_id].append((r.offset, r.length))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(placed)


def test_packing(odd, empty, plain):
    out = packing.packed_documents(odd, tokens.default_path(), 64).collect()
    n = check_packed(out, cut(ODD, plain, 64), 64)
    assert n <= 1.02 * sum(r.length for r in out) / 64 + 1
    assert packing.packed_documents(empty, tokens.default_path()).collect() == []


def test_packing_documents(spark, plain):
    rows = [(r["doc_id"], r["text"]) for r in table("documents")]
    out = packing.packed_documents(spark.read.parquet(f"{SF}/documents.parquet"), tokens.default_path()).collect()
    check_packed(out, cut(rows, plain, 1024), 1024)


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 101, int(rng.integers(1, 400))).tolist()
    histogram = Counter(lengths)
    slots = packing.slots(packing.plan(histogram, 100))
    used = defaultdict(list)
    for length, low, high, first, each, offset in slots:
        for rank in range(low, high):
            used[first + (rank - low) // each].append((offset + (rank - low) % each * length, length))
    assert Counter(x for parts in used.values() for _, x in parts) == histogram
    for parts in used.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0, *[x for _, x in sorted(parts)]])[:-1].tolist()
        assert sum(x for _, x in parts) <= 100
    bins = []
    for x in sorted(lengths, reverse=True):  # best fit one by one
        fits = [b for b in bins if b[0] >= x]
        if fits:
            min(fits, key=lambda b: b[0])[0] -= x
        else:
            bins.append([100 - x])
    assert len(used) == len(bins)


def test_assembled_sequences(spark, plain):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e"), (3, None)], "doc_id long, text string")
    from haulmark.llm.common import table as written
    pieces = written(packing.cut_documents(docs, tokens.default_path(), 16, with_ids=True), "pieces")
    out = packing.assemble(packing.pack(pieces, 16)).collect()
    assert len(out) == 1 and sorted(out[0].ids) == sorted([*plain("a b c"), 2, *plain("d e"), 2, 2]) and len(out[0].doc_starts) == 3


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 1000, 4097])
def test_permutation(n):
    slots = training_order.permute(np.arange(n), n)
    assert sorted(slots.tolist()) == list(range(n))
    if n >= 1000:
        assert (slots != training_order.permute(np.arange(n), n, key=5)).mean() > 0.9
        assert abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.1


def test_training_order(odd, empty, spark, plain, tmp_path):
    expected = cut(ODD, plain, 32)
    options = {"limit": 32, "shard_records": 16, "block_records": 4}
    path = str(tmp_path / "shards")
    n = training_order.write_shards(odd, path, tokens.default_path(), **options)
    out = training_order.read_shards(spark, path, with_ids=True, **options).collect()
    assert n == len(out) and sorted(r.slot for r in out) == list(range(n))
    assert sorted(((r.doc_id, r.piece, r.length, r.ids_crc32) for r in out), key=repr) == sorted(((d, i, x, c) for d, i, _, x, c in expected), key=repr)
    stride = training_order.record_type(32, "<u2").itemsize
    assert all((r.shard, r.offset) == (r.slot // 16, r.slot % 16 * stride) and tokens.crc32(np.array(r.ids)) == r.ids_crc32 for r in out)
    later = training_order.read_shards(spark, path, from_slot=37, **options).collect()
    assert sorted(r.slot for r in later) == list(range(37, n))
    assert training_order.training_order(empty, tokens.default_path()).collect() == []


# ---------------------------------------------------------------- mixing
def reference_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(names)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def check_mix(out, docs):
    sizes, taken = Counter(), Counter()
    source = {}
    for d, s, n in docs:
        sizes[s] += n
        source[d, n] = s
    target = reference_targets(sizes)
    least = {}
    for r in out:
        s = source[r.doc_id, r.size]
        assert r.source_size == sizes[s] and abs(r.target - target[s]) <= 1e-6 * max(1, target[s])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
        if r.size:
            least[s] = min(least.get(s, r.size), r.size)
    assert all(abs(taken[s] - target[s]) <= max(least.get(s, 0), 0.03 * target[s]) for s in sizes), (taken, target)


def test_mix_of_documents(spark):
    rows = [(r["doc_id"], r["source"], len(words(r["text"]))) for r in table("documents")]
    out = mixing.report(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert len(out) == len(rows)
    check_mix(out, rows)
    assert sorted(out) == sorted(mixing.report(spark.read.parquet(f"{SF}/documents.parquet").repartition(7)).collect())


def test_mix_odd_rows(odd, empty):
    out = mixing.report(odd).collect()
    assert sorted(((r.doc_id, r.size) for r in out), key=repr) == sorted(((d, len(words(t))) for d, t in ODD), key=repr)
    assert all(r.taken in (0, r.size, 2 * r.size) for r in out)
    assert mixing.report(empty).collect() == [] and mixing.mix(empty).columns == empty.columns


def test_mix_repeats_rows(odd):
    counts = Counter()
    for r in mixing.report(odd).collect():
        if r.size:
            counts[r.doc_id, r.size] += r.taken // r.size
    got = mixing.mix(odd)
    assert got.columns == odd.columns
    total = sum(len(words(r.text)) for r in got.collect())
    assert abs(total - sum(n * s for (_, s), n in counts.items())) <= max(s for _, s in counts)
    assert all(isinstance(r.text, str) or r.text is None for r in got.collect())


def test_multipliers_solve_the_dual(spark, folder):
    import math

    from haulmark.llm.common import table as written
    histogram = written(spark.createDataFrame([(0, 10, 100), (0, 1000, 5), (1, 7, 50), (2, 3, 4)], "no int, size long, n long"), "h")
    sources = written(spark.createDataFrame([(0, 105, 6000, 4500.0), (1, 50, 350, 700.0), (2, 4, 12, 20.0)], "no int, n long, source_size long, target double"), "s")
    out = {r.no: r for r in mixing.multipliers(histogram, sources).collect()}
    assert out[1].lam is None
    rate = lambda no, size: min(2.0, math.exp(out[no].lam * size / out[no].mean))
    assert abs(100 * 10 * rate(0, 10) + 5 * 1000 * rate(0, 1000) - 4500) < 0.01
    assert abs(12 * rate(2, 3) - 20) < 0.01


# ---------------------------------------------------------------- classifier
def test_classifier_held_out(spark):
    path = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    out = quality_model.report(docs, labels)
    assert out.filter("score < 0 or score > 1 or predicted <> cast(score >= 0.5 as int)").isEmpty()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = out.collect()
    assert all(r.held_out == (crc(str(r.doc_id)) % 3 == 1) for r in rows)
    tested = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(p == q for p, q in tested) / len(tested) > 0.95
    assert all(p == 1 for p, q in tested if q == 1)


def test_classifier_reads_no_held_out_label(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    changed = labels.withColumn("quality", F.when(quality_model.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    score = lambda l: {r.doc_id: r.score for r in quality_model.report(docs, l).collect()}
    assert score(labels) == score(changed)


def test_classifier_odd_rows(odd, empty, spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (15, 0, 0), (3, None, 0), (None, 1, 0), (9, 1, 0), (9, 0, 0), (12, 1, 0), (12, 1, 1)], "doc_id long, quality int, toxic int")
    out = quality_model.report(odd, labels).collect()
    assert sorted((repr(r.doc_id) for r in out)) == sorted(repr(d) for d, _ in ODD)
    assert all(r.score == 0 for r in out if r.doc_id in (4, 5, 6))
    assert not any(r.held_out for r in out if r.doc_id is None)
    assert quality_model.report(empty, labels).collect() == []
    nothing = quality_model.report(odd, labels.limit(0)).collect()
    assert {r.score for r in nothing} == {0.5} and {r.predicted for r in nothing} == {1}
    assert quality_model.keep_good(odd, labels).columns == odd.columns


def test_scores_are_exact_neighbour_votes():
    rng = np.random.default_rng(3)
    counts = (rng.random((60, quality_model.TERMS)) < 0.01).astype(np.float32)
    labels, weights = rng.integers(0, 2, 60), np.ones(60)
    model = quality_model.fit(counts, labels, weights, rank=10)
    got = quality_model.score(model, counts[:9], neighbours=5)
    for row, s in zip(counts[:9], got):
        x = row * model.idf
        v = (x / np.linalg.norm(x)) @ model.axes
        near = model.vectors @ (v / np.linalg.norm(v))
        top = np.argsort(-near)[:5]
        assert abs(s - (near[top] ** 2 * labels[top]).sum() / (near[top] ** 2).sum()) < 1e-4



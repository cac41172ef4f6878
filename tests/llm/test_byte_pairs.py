"""Byte pairs by occurrence lists against the tokenizers library."""
import hashlib
import json
import random
import sys

import numpy as np
import pytest
from llm_samples import ODD, empty, folder, odd, table  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from haulmark.llm import byte_pairs, tokens

PATH = tokens.default_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return byte_pairs.BytePairs(PATH)


def ids_of(own, text):
    return np.frombuffer(own.encode([text])[0], "<u4").tolist()


def expected(library, doc_id, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    return doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_random_texts(library, own):
    rnd = random.Random(5)
    signs = [*"aab  \n\t'sst1!\xe9\xa0　\U0001f600̀ア漢\x85\x1c\x00", "<|endoftext|>", "<|endof", "\U00018d00", "\U00033000", "'ll", " the", "ing"]
    for _ in range(3000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 40)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert ids_of(own, text) == ids
        assert own.decode(own.encode([text])[0]) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 1_000_000 + "x", "a" * 1_000_000, "ab" * 300_000, "=-" * 100_000, "漢" * 300_000])
def test_long_runs(library, own, text):
    assert ids_of(own, text) == library.encode(text, add_special_tokens=False).ids


def test_every_character_splits_as_in_the_library(library, own):
    every = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF and not (0x3500 <= c < 0x4D00 or 0x5000 <= c < 0x9F00 or 0xAD00 <= c < 0xD700
                                                                                         or 0x20100 <= c < 0x2A600 or 0x40000 <= c < 0xE0000 or c >= 0xE0200)]
    for i in range(0, len(every), 20_000):
        text = "".join(f"a{chr(c)}1{chr(c)}!{chr(c)}" for c in every[i:i + 20_000])
        cut = [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]
        assert [w for r in own._runs(text) for w in own._words(r)] == cut


def test_few_and_many_agree(own, monkeypatch):
    texts = [r["text"] or "" for r in table("documents")]
    results = []
    for many in (1, 10**9):
        monkeypatch.setattr(byte_pairs, "MANY", many)
        own.known_runs.clear(), own.known_words.clear()
        results.append(own.encode(texts))
    assert results[0] == results[1]


def test_what_is_remembered_changes_nothing(own, monkeypatch):
    texts = [r["text"] or "" for r in table("documents")]
    whole = own.encode(texts)
    monkeypatch.setattr(byte_pairs, "KNOWN_RUNS", 10)
    assert [own.encode([t])[0] for t in texts] == whole


def test_query_equals_library(spark, folder, library):
    rows = table("documents")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = byte_pairs.round_trip(docs, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(expected(library, r["doc_id"], r["text"]) for r in rows)


def test_odd_rows(odd, empty, library):
    got = sorted(map(tuple, byte_pairs.round_trip(odd, PATH).collect()), key=repr)
    assert got == sorted((expected(library, *r) for r in ODD), key=repr)
    assert byte_pairs.round_trip(empty, PATH).collect() == []


def test_columns_stay_and_clash(odd):
    rows = odd.withColumn("ids", F.lit("clash")).withColumn("a.b", F.lit(1))
    coded = byte_pairs.encode(rows, PATH)
    assert coded.columns == rows.columns and dict(coded.dtypes)["ids"] == "binary"
    back = byte_pairs.decode(coded, PATH, text="text")
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=repr) == sorted(((d, t or "") for d, t in ODD), key=repr)


def test_unknown_ids_and_broken_bytes(spark, folder, library):
    ids = [50_299, 126, 220, 60_000, 222, 222, 15496]
    df = spark.createDataFrame([(1, np.array(ids, "<u4").tobytes()), (2, b""), (3, None)], "n int, ids binary")
    got = {r.n: r.decoded for r in byte_pairs.decode(df, PATH).collect()}
    assert got == {1: library.decode(ids, skip_special_tokens=False), 2: "", 3: None}


def test_other_files_are_refused(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    bad = dict(spec, normalizer={"type": "NFC"})
    (tmp_path / "a.json").write_text(json.dumps(bad))
    with pytest.raises(ValueError):
        byte_pairs.BytePairs(str(tmp_path / "a.json"))
    merges = spec["model"]["merges"]
    late = dict(spec, model=dict(spec["model"], merges=[*merges[1:], merges[0]]))
    (tmp_path / "b.json").write_text(json.dumps(late))
    with pytest.raises(ValueError):
        byte_pairs.BytePairs(str(tmp_path / "b.json"))

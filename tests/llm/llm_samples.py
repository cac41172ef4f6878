import os
import re
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from haulmark.session import named_folder

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="session", autouse=True)
def folder(spark, tmp_path_factory):
    """The folder for written tables, where the session has none."""
    if not named_folder(spark):
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


def words(text):
    return WORD.findall(text or "")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def table(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


LONG = " ".join(f"w{i % 977}x{i}" for i in range(6000))
SAMPLE = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix strong potions for a very old king today"

#: Null id and text, empty, blank, one word, ties, repeated rows, one id twice, long, copies.
ODD = [
    (1, SAMPLE), (2, SAMPLE), (3, SAMPLE + " indeed"), (4, None), (None, SAMPLE), (None, None), (5, ""), (6, " \n\t "), (7, "one"), (8, "ONE"),
    (9, LONG), (10, LONG + " tail"), (11, "a b"), (11, "c d e f g h"), (12, SAMPLE), (12, SAMPLE), (13, "été ÉTÉ naïve \U0001f600"),
    (14, "line one is here\nline one is here\nline one is here\n\nother"), (15, "### $$$ *** " * 30),
]

#: Columns of other names an operator uses or returns.
CLASHES = ["n_words", "kept", "score", "size", "key", "node", "token", "rank", "shard", "copies", "row", "text_hash", "__h", "__copies", "no", "u"]


@pytest.fixture(scope="session")
def odd(spark, folder):
    df = spark.createDataFrame([(i, t, "en", ("s1", "s2", None)[n % 3], len(t or "")) for n, (i, t) in enumerate(ODD)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="session")
def empty(spark, folder):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def crc(text):
    return zlib.crc32((text or "").encode())

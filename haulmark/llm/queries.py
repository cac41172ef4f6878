"""The registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.llm import (byte_pairs, chat, manifest, mixing, near_dup, packing, page_text, quality_model, quality_rules, sharding, tokens,
                          topk, training_order, vector_codes)
from haulmark.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_rules(spark, sf_dir):
    return quality_rules.report(read(spark, sf_dir, "documents"))


ORACLES["op1_quality_rules"] = quality_rules.SQL


@query
def op2_chat_format(spark, sf_dir):
    return chat.digests(chat.format_chats(chat.with_probe(read(spark, sf_dir, "conversations"))))


ORACLES["op2_chat_format"] = chat.SQL


@query
def op3_exact_topk(spark, sf_dir):
    vectors = topk.quantised(read(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10)


ORACLES["op3_exact_topk"] = topk.brute_sql()


@query
def op4_packing(spark, sf_dir):
    return packing.packed_documents(read(spark, sf_dir, "documents"), tokens.default_path(), capacity=1024)


@query
def op5_minhash(spark, sf_dir):
    return near_dup.near_duplicates(read(spark, sf_dir, "documents"), width=2)


ORACLES["op5_minhash"] = near_dup.brute_sql(width=2)


@query
def op6_quality_model(spark, sf_dir):
    return quality_model.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op7_training_order(spark, sf_dir):
    return training_order.training_order(read(spark, sf_dir, "documents"), tokens.default_path())


@query
def op8_sharding(spark, sf_dir):
    return sharding.layout(read(spark, sf_dir, "documents"), shards=40)


@query
def op9_mixing(spark, sf_dir):
    return mixing.report(read(spark, sf_dir, "documents"))


@query
def op10_page_text(spark, sf_dir):
    return page_text.main_text(read(spark, sf_dir, "pages"))


ORACLES["op10_page_text"] = page_text.SQL


@query
def op11_byte_pairs(spark, sf_dir):
    return byte_pairs.round_trip(read(spark, sf_dir, "documents"), tokens.default_path())


@query
def op12_manifest(spark, sf_dir):
    return manifest.manifest(read(spark, sf_dir, "documents"))


ORACLES["op12_manifest"] = manifest.brute_sql()


@query
def op13_vector_codes(spark, sf_dir):
    return vector_codes.report(read(spark, sf_dir, "embeddings"))


ORACLES["op13_vector_codes"] = vector_codes.brute_sql()

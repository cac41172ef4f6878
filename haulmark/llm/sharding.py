"""Shards by weighted rendezvous hashing. Built-in functions only.

Every shard draws a number from a hash of (key, shard), divided by its weight as -ln(u) / weight, and the key goes to the
smallest. A new shard takes keys only into itself and a removed one gives up only its own. Law ``key``: nothing but the
key and the shards decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import rank_within, table


def _draw(key: list[Column], shard: Column, weight: Column) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(*key, shard), 11).cast("double")
    return -F.log((bits + 0.5) / F.lit(float(2**53))) / weight


def rendezvous(key: list[Column], weights: dict[int, float]) -> Column:
    """Shard of a key among ``weights`` (shard -> positive weight); ties go to the smaller shard."""
    if not weights or min(weights.values()) <= 0:
        raise ValueError("at least one shard and only positive weights")
    shards = F.array(*[F.struct(F.lit(int(s)).alias("s"), F.lit(float(w)).alias("w")) for s, w in sorted(weights.items())])
    draws = F.transform(shards, lambda x: F.struct(_draw(key, x["s"], x["w"]).alias("d"), x["s"].alias("s")))
    return F.array_min(draws)["s"]


def assign(docs: DataFrame, weights: dict[int, float], key: str = "doc_id", out: str = "shard") -> DataFrame:
    """``docs`` with their shard in ``out``. A null key is a key like any other."""
    return docs.withColumn(out, rendezvous([F.col(key)], weights))


def write(docs: DataFrame, weights: dict[int, float], path: str, key: str = "doc_id", out: str = "shard") -> None:
    """One folder of Parquet files per shard; files of a shard are as many as its rows need, not one task."""
    assign(docs, weights, key, out).write.partitionBy(out).mode("overwrite").parquet(path)


def layout(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): size, text_crc32, law, shard, slot in the shard, and shard among one more.

    A null text has no bytes: size 16, checksum 0. Null ids share one shard. Repeated rows each get a slot. Slots follow a
    hash of (doc_id, text_crc32, size), cut into bounded groups, so neither a full shard nor one id is sorted in one task.
    Other columns are ignored, an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    now = rendezvous([F.col("doc_id")], {s: 1.0 for s in range(shards)})
    grown = rendezvous([F.col("doc_id")], {s: 1.0 for s in range(shards + 1)})
    rows = table(docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                             F.lit("key").alias("law"), now.alias("shard"), grown.alias("grown_shard")), "rows")
    return (rank_within(rows, ["shard"], ["doc_id", "text_crc32", "size"], "slot", few_keys=True)
            .select("doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long"), "grown_shard"))

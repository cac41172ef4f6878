"""Token ids in training order: a keyed permutation gives every sequence its slot, shards hold fixed-size records.

Sequences are numbered in the order of the written pieces. A Feistel network over the smallest even power of two that holds
them, walked until it lands inside, maps numbers to slots one to one without sorting or a table. Slots are cut into ranges,
one per shard; a task receives one range, sorts it, and writes records of a fixed stride in blocks, so that any slot is
found by arithmetic and reading can resume anywhere.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulmark.llm import tokens
from haulmark.llm.common import discard, new_folder, ship, table

LIMIT = 1024
END_ID = 2
#: Records in a shard and in a block of a shard. Blocks are rows of the stored shards, so a batch of them must stay small.
SHARD_RECORDS = 8192
BLOCK_RECORDS = 16
ROUNDS = 6
KEY = 20260101


def record_type(limit: int, ids: str) -> np.dtype:
    """Header and ids of one record; flag 1 says that the document has no id."""
    return np.dtype([("doc_id", "<i8"), ("piece", "<u4"), ("length", "<u2"), ("flags", "<u2"), ("ids", ids, (limit,))])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(numbers: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """Slots of ``numbers``, a permutation of 0 .. n - 1 chosen by ``key``."""
    half = max(1, -(-max(1, (n - 1).bit_length()) // 2))
    mask = np.uint64((1 << half) - 1)
    keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))
    out = numbers.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        x = out[walking]
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            left, right = right, left ^ (_mix(right + k) & mask)
        x = (left << np.uint64(half)) | right
        out[walking] = x
        walking = walking[x >= np.uint64(n)]
    return out.astype(np.int64)


def _sequences(path: str, limit: int, end_id: int, ids_type: str, ordinary: bool):
    width = np.dtype(ids_type).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = tokens.array_encoder(path, ordinary), TaskContext.get().partitionId(), 0
        for batch in batches:
            docs, numbers, lengths, ids = [], [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                found = np.append(encode(text.as_py() or ""), end_id).astype(ids_type)
                data = found.tobytes()
                for i, (start, length) in enumerate(tokens.pieces(len(found), limit)):
                    docs.append(doc)
                    numbers.append(i)
                    lengths.append(length)
                    ids.append(data[start * width:(start + length) * width])
            if docs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(docs), part, np.int32)), pa.array(np.arange(seen, seen + len(docs))), pa.array(docs, pa.int64()),
                     pa.array(numbers, pa.int32()), pa.array(lengths, pa.int32()), pa.array(ids, pa.binary())],
                    ["part", "pos", "doc_id", "piece", "length", "ids"])
                seen += len(docs)
    return run


def _records(batch: pa.RecordBatch, kind: np.dtype, limit: int, ids_type: str) -> np.ndarray:
    doc, length = batch.column("doc_id"), batch.column("length").to_numpy()
    records = np.zeros(batch.num_rows, kind)
    records["doc_id"], records["flags"] = doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False)
    records["piece"], records["length"] = batch.column("piece").to_numpy(), length
    records["ids"][np.arange(limit) < length[:, None]] = np.frombuffer(b"".join(batch.column("ids").to_pylist()), ids_type)
    return records


def _blocks(limit: int, ids_type: str, shard_records: int, block_records: int):
    """Slots of whole shards, in order and without gaps, as blocks of records."""
    kind = record_type(limit, ids_type)

    def blocks(records: np.ndarray, first: int) -> pa.RecordBatch:
        starts = np.arange(0, len(records), block_records)
        slots = first + starts
        sizes = np.minimum(block_records, len(records) - starts)
        return pa.RecordBatch.from_arrays(
            [pa.array((slots // shard_records).astype(np.int32)), pa.array((slots % shard_records // block_records).astype(np.int32)),
             pa.array(slots), pa.array(sizes.astype(np.int32)), pa.array([records[a:a + block_records].tobytes() for a in starts.tolist()], pa.binary())],
            ["shard", "block", "first_slot", "records", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = np.zeros(0, kind), 0  # records of a block that is not full yet, and the slot of the first
        for batch in batches:
            if not batch.num_rows:
                continue
            if not len(held):
                first = batch.column("slot")[0].as_py()
            held = np.concatenate([held, _records(batch, kind, limit, ids_type)])
            full = len(held) // block_records * block_records
            if full:
                yield blocks(held[:full], first)
                held, first = held[full:].copy(), first + full
        if len(held):
            yield blocks(held, first)
    return run


def write_shards(docs: DataFrame, path: str, tokenizer: str, limit: int = LIMIT, end_id: int = END_ID, key: int = KEY,
                 ids_type: str = "<u2", shard_records: int = SHARD_RECORDS, block_records: int = BLOCK_RECORDS,
                 ordinary: bool = False) -> int:
    """Tokenise ``docs`` (doc_id, text), permute the sequences and write shards below ``path``; gives their number.

    A document is its ids and ``end_id``, cut into sequences of ``limit`` ids of which only the first may be shorter. A null
    text is empty, a null doc_id is kept as such, repeated rows are sequences of their own, other columns are ignored, and an
    empty table writes an empty folder. A string of a special token is that token, or with ``ordinary`` text like any other.
    ``ids_type`` must hold the vocabulary. Every task writes one file with a run of whole shards in order, as many files as there
    are shuffle partitions at most. Numbers follow the splits of the input, so the same files and split size give the same
    slots; ``key`` alone chooses the permutation.
    """
    if shard_records % block_records:
        raise ValueError("a shard must hold whole blocks")
    spark = docs.sparkSession
    ship(spark)
    found = table(docs.select("doc_id", "text").mapInArrow(
        _sequences(tokenizer, limit, end_id, ids_type, ordinary), "part int, pos long, doc_id long, piece int, length int, ids binary"), "sequences")
    # One row per input split: how many sequences the splits before it hold.
    counts = found.groupBy("part").agg(F.count("*").alias("n"))
    firsts = table(counts.select("part", "n", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first")), "firsts")
    n = firsts.agg(F.sum("n")).first()[0] or 0

    @F.pandas_udf("long")
    def slot(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), n, key))

    shards = max(1, -(-n // shard_records))
    tasks = min(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shard = F.floor(F.col("slot") / shard_records)
    placed = (found.join(firsts.drop("n"), "part").select(slot(F.col("first") + F.col("pos")).alias("slot"), "doc_id", "piece", "length", "ids")
              .repartitionById(tasks, F.floor(shard * tasks / shards).cast("int"))
              .sortWithinPartitions("slot"))
    (placed.mapInArrow(_blocks(limit, ids_type, shard_records, block_records), "shard int, block int, first_slot long, records int, payload binary")
     .write.option("compression", "zstd").parquet(path))
    discard(found)
    return n


def read_shards(spark: SparkSession, path: str, from_slot: int = 0, limit: int = LIMIT, ids_type: str = "<u2",
                shard_records: int = SHARD_RECORDS, block_records: int = BLOCK_RECORDS, with_ids: bool = False) -> DataFrame:
    """Records from ``from_slot`` on: slot, shard, offset (bytes in the shard), doc_id, piece, length, ids_crc32[, ids].

    Slots rise through every file, so earlier files, row groups and blocks are passed over by their bounds.
    """
    ship(spark)
    kind = record_type(limit, ids_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, payload in zip(batch.column("first_slot").to_pylist(), batch.column("payload")):
                records = np.frombuffer(payload.as_buffer(), kind)
                slots = first + np.arange(len(records))
                records, slots = records[slots >= from_slot], slots[slots >= from_slot]
                ids, lengths = records["ids"].astype("<u4"), records["length"].astype(np.int64)
                columns = {"slot": pa.array(slots, pa.int64()), "shard": pa.array(slots // shard_records, pa.int32()),
                           "offset": pa.array(slots % shard_records * kind.itemsize, pa.int64()),
                           "doc_id": pa.array(records["doc_id"].astype(np.int64), pa.int64(), mask=(records["flags"] & 1).astype(bool)),
                           "piece": pa.array(records["piece"].astype(np.int32)), "length": pa.array(lengths),
                           "ids_crc32": pa.array([zlib.crc32(row[:m]) for row, m in zip(ids, lengths.tolist())], pa.int64())}
                if with_ids:
                    columns["ids"] = pa.array([row[:m].astype(np.int32) for row, m in zip(ids, lengths.tolist())], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    stored = spark.read.schema("shard int, block int, first_slot long, records int, payload binary").parquet(path)
    wanted = stored.filter(F.col("first_slot") > from_slot - block_records).select("first_slot", "payload")
    return wanted.mapInArrow(run, "slot long, shard int, offset long, doc_id long, piece int, length long, ids_crc32 long"
                             + (", ids array<int>" if with_ids else ""))


def training_order(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the shards below the shared folder and read them back as rows."""
    path = new_folder(docs.sparkSession, "shards")
    write_shards(docs, path, tokenizer, **options)
    return read_shards(docs.sparkSession, path)

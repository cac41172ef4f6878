"""Best-fit packing by a plan over the histogram of lengths.

The plan packs counts, not documents: lengths fall from the longest, and all pieces of one length go at once into the
fullest bins that still take them, then into new bins. Bins filled alike stay one entry, so the plan has a few entries per
length however many pieces there are. Pieces then take the planned slots by joining on their rank within their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm import tokens
from haulmark.llm.common import rank_within, ship, table

END_ID = 2
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(path: str, limit: int, end_id: int, with_ids: bool, ordinary: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path, ordinary)
        for batch in batches:
            rows: list[tuple] = []
            kept = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                for i, (start, length) in enumerate(tokens.pieces(len(ids), limit)):
                    rows.append((doc, i, start, length, tokens.crc32(ids[start:start + length])))
                    if with_ids:
                        kept.append(ids[start:start + length].astype(np.int32))
            if not rows:
                continue
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


def cut_documents(docs: DataFrame, tokenizer: str, limit: int = 1024, end_id: int = END_ID, with_ids: bool = False,
                  ordinary: bool = False) -> DataFrame:
    """Pieces of at most ``limit`` tokens of ``docs`` (doc_id, text), each document closed by ``end_id``.

    Columns: doc_id, piece, start, length, ids_crc32 and, if asked for, ids. A null text is empty: the end token alone.
    A string of a special token is that token, or with ``ordinary`` text like any other.
    """
    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_cut(tokenizer, limit, end_id, with_ids, ordinary), PIECE + (", ids array<int>" if with_ids else ""))


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Best fit over counts: (bins, [(length, pieces of it per bin, offset of the first)]) for every kind of bin.

    Every length adds at most three kinds, and a bin holds at most sqrt(2 * capacity) different lengths, which bounds the
    plan by the capacity alone.
    """
    if any(length < 1 or length > capacity for length in histogram):
        raise ValueError("lengths must lie between 1 and the capacity")
    room: dict[int, list[list]] = {}  # free tokens -> [[bins, filling]]

    def put(bins, free, filling, length, each):
        if bins and each:
            room.setdefault(free - each * length, []).append([bins, [*filling, (length, each, capacity - free)]])

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        for free in sorted(f for f in room if f >= length):
            each = free // length
            kinds = room.pop(free)
            while kinds and left:
                bins, filling = kinds.pop()
                full = min(bins, left // each)
                put(full, free, filling, length, each)
                left -= full * each
                bins -= full
                if bins and left:  # fewer are left than one bin takes
                    put(1, free, filling, length, left)
                    left, bins = 0, bins - 1
                if bins:
                    kinds.append([bins, filling])
            if kinds:
                room.setdefault(free, []).extend(kinds)
            if not left:
                break
        each = capacity // length
        put(left // each, capacity, [], length, each)
        put(1, capacity, [], length, left % each)
    return [(bins, filling) for kinds in room.values() for bins, filling in kinds]


def slots(kinds: list[tuple[int, list[tuple[int, int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """The plan as rows (length, first rank, end rank, first sequence, pieces per sequence, offset)."""
    out, taken, sequence = [], {}, 0
    for bins, filling in kinds:
        for length, each, offset in filling:
            first = taken.get(length, 0)
            taken[length] = first + bins * each
            out.append((length, first, first + bins * each, sequence, each, offset))
        sequence += bins
    return out


def pack(cut: DataFrame, capacity: int = 1024) -> DataFrame:
    """``cut`` (doc_id, piece, start, length, ids_crc32; a written table) with sequence_id and offset.

    Sequences are gapless from offset 0. Repeated rows are pieces like any other; an empty table gives an empty result.
    """
    spark = cut.sparkSession
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    planned = spark.createDataFrame(slots(plan(histogram, capacity)), "length long, low long, high long, first long, each long, at long")
    ranked = rank_within(cut, ["length"], ["doc_id", "piece", "start", "ids_crc32"], "rank", few_keys=True)
    turn = F.col("rank") - F.col("low")
    return (ranked.join(F.broadcast(planned), "length").filter((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
            .withColumn("sequence_id", F.col("first") + F.floor(turn / F.col("each")).cast("long"))
            .withColumn("offset", F.col("at") + F.pmod(turn, F.col("each")) * F.col("length"))
            .drop("rank", "low", "high", "first", "each", "at"))


def assemble(packed: DataFrame) -> DataFrame:
    """Token ids of each sequence from a packed frame with ``ids``: sequence_id, ids, and doc_starts (offsets of pieces)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"), F.transform("p", lambda x: x["offset"]).alias("doc_starts"))


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, ordinary: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of ``docs``."""
    cut = table(cut_documents(docs, tokenizer, capacity, ordinary=ordinary), "pieces")
    return pack(cut, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

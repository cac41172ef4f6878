"""Product codes for vectors, assigned by norm-of-sum bounds.

Each vector is cut into parts, each part has a codebook that is refined in rounds. A written state holds, per vector and part,
its entry, and per group of entries a lower bound of the distance to any other entry of the group, stamped with the round in
which it was computed. All codebooks of earlier rounds are kept. A bound of round s holds in round t less the true distance
between an entry's places in rounds s and t: the norm of the sum of its moves, never more than the sum of their norms. A group
whose bound still exceeds the distance to the present entry is skipped; any other is scanned again by exact integer distances
and stamped anew. Bounds are rounded down and moves up, so a tie or a doubt always leads to a scan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import discard, ship, table

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024.0
#: Entries that share a bound.
GROUP = 32
#: Quantised components beyond this size count as of this size: squares and their sums stay exact in 64 bits.
LARGEST = 1 << 24
#: Values of a partial sum that travel in one row.
SLICE = 16
#: Relative room for rounding in bounds, far above that of doubles.
ROOM = 1e-6


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, v) with v = floor(1024 * x) per component; rows with a null vector or a null, NaN or infinite component are
    left out. Components beyond ``LARGEST`` are held there."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    sound = F.forall(x, lambda e: e.isNotNull() & (F.abs(e) < float("inf")))
    held = F.transform(x, lambda e: F.floor(F.least(F.greatest(e * F.lit(SCALE), F.lit(float(-LARGEST))), F.lit(float(LARGEST)))).cast("int"))
    return vectors.filter(F.col(f"`{vector_col}`").isNotNull()).filter(sound).select(
        F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), held.alias("v"))


def squares(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row to every entry, as int64."""
    most = 2 * max(int(np.abs(rows).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if most * most * max(1, rows.shape[1]) < 2**52:  # every partial sum is below that, so doubles are exact
        a, b = rows.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    out = np.zeros((len(rows), len(entries)), np.int64)
    for j, e in enumerate(entries.astype(np.int64)):
        out[:, j] = np.square(rows.astype(np.int64) - e).sum(1)
    return out


def _own_square(rows: np.ndarray, entries: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.square(rows.astype(np.int64) - entries[code].astype(np.int64)).sum(1)


class Moves:
    """Largest true move of each group's entries from every kept round to the last, the own entry of a row aside."""

    def __init__(self, history: np.ndarray):
        """``history``: rounds x entries x positions of one part."""
        moved = np.sqrt(np.square((history[-1] - history).astype(np.float64)).sum(2)) * (1 + ROOM)
        n = moved.shape[1]
        self.starts = list(range(0, n, GROUP))
        self.most, self.who, self.second = (np.zeros((len(history), len(self.starts)), kind) for kind in (np.float64, np.int64, np.float64))
        for g, a in enumerate(self.starts):
            block = moved[:, a:a + GROUP]
            self.who[:, g] = a + block.argmax(1)
            ordered = np.sort(block, axis=1)
            self.most[:, g] = ordered[:, -1]
            self.second[:, g] = ordered[:, -2] if block.shape[1] > 1 else 0.0

    def of(self, g: int, stamps: np.ndarray, code: np.ndarray) -> np.ndarray:
        return np.where(self.who[stamps, g] == code, self.second[stamps, g], self.most[stamps, g])


def assign(rows: np.ndarray, history: np.ndarray, code: np.ndarray | None, bound: np.ndarray | None, stamp: np.ndarray | None):
    """Nearest entry of the last codebook for each row of one part, and its new state: code, bound, stamp, squared distance, groups scanned.

    ``history`` holds all codebooks up to now. Without a state every group is scanned.
    """
    entries, now, n = history[-1], len(history) - 1, len(rows)
    moves = Moves(history)
    groups = len(moves.starts)
    first = code is None
    if first:
        code, bound, stamp = np.zeros(n, np.int64), np.zeros((n, groups), np.float32), np.zeros((n, groups), np.uint8)
    was = code.astype(np.int64)
    best, nearest = was.copy(), _own_square(rows, entries, was)
    kept = nearest.copy()
    bound, stamp = bound.copy(), stamp.copy()
    scans = np.zeros((n, groups), bool)
    reach = np.sqrt(kept.astype(np.float64)) * (1 + ROOM)
    for g in range(groups):
        scans[:, g] = True if first else ~(bound[:, g] - moves.of(g, stamp[:, g], was) > reach)
    least = np.full((n, groups, 2), np.iinfo(np.int64).max)  # two smallest squares of scanned groups, to leave out the winner later
    winner = np.zeros((n, groups), np.int64)
    for g, a in enumerate(moves.starts):
        some = np.flatnonzero(scans[:, g])
        if not len(some):
            continue
        d = squares(rows[some], entries[a:a + GROUP])
        at = d.argmin(1)  # the lowest index among equals
        low = d[np.arange(len(some)), at]
        winner[some, g], least[some, g, 0] = a + at, low
        if d.shape[1] > 1:
            least[some, g, 1] = np.partition(d, 1, axis=1)[:, 1]
        better = (low < nearest[some]) | ((low == nearest[some]) & (a + at < best[some]))
        best[some[better]], nearest[some[better]] = a + at[better], low[better]
    for g, a in enumerate(moves.starts):
        some = np.flatnonzero(scans[:, g])
        other = np.where(winner[some, g] == best[some], least[some, g, 1], least[some, g, 0])
        bound[some, g] = _down(np.sqrt(other.astype(np.float64)))
        stamp[some, g] = now
        # A group that was not scanned loses its entry to another group: from now on its bound has to hold for that entry too.
        left = np.flatnonzero(~scans[:, g] & (best != was) & (was // GROUP == g))
        if len(left):
            still = bound[left, g] - moves.of(g, stamp[left, g], was[left])
            bound[left, g] = _down(np.minimum(still, np.sqrt(kept[left].astype(np.float64))))
            stamp[left, g] = now
    return best, bound, stamp, nearest, int(scans.sum())


def _down(values: np.ndarray) -> np.ndarray:
    return (np.maximum(values, 0) * (1 - ROOM)).astype(np.float32)


def _column(batch: pa.RecordBatch, name: str, kind, shape) -> np.ndarray:
    """A binary column of equal sizes as one array."""
    return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(batch.num_rows, *shape)


def _pass(books, dim: int, scanned):
    """State after one assignment of every vector to the last codebooks of ``books``."""
    width = dim // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        history = books.value  # rounds x parts x entries x width
        groups = len(range(0, history.shape[2], GROUP))
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            v = _column(batch, "x", "<i4", (PARTS, width))
            known = len(history) > 1
            code = _column(batch, "code", np.uint8, (PARTS,)) if known else None
            bound = _column(batch, "bound", "<f4", (PARTS, groups)) if known else None
            stamp = _column(batch, "stamp", np.uint8, (PARTS, groups)) if known else None
            codes, bounds, stamps, error = np.zeros((n, PARTS), np.uint8), np.zeros((n, PARTS, groups), "<f4"), np.zeros((n, PARTS, groups), np.uint8), np.zeros(n, np.int64)
            for p in range(PARTS):
                c, bounds[:, p], stamps[:, p], square, scans = assign(
                    v[:, p], history[:, p], *((code[:, p], bound[:, p], stamp[:, p]) if known else (None, None, None)))
                codes[:, p] = c
                error += square
                scanned.add(scans)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("x"),
                 *(pa.array([r.tobytes() for r in a], pa.binary()) for a in (codes, bounds, stamps)), pa.array(error, pa.int64())],
                ["vec_id", "label", "x", "code", "bound", "stamp", "error"])
    return run


def _sums(dim: int, entries: int):
    """Counts and sums per part, entry and slice of positions over what a task reads."""
    width = dim // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((PARTS, entries), np.int64), np.zeros((PARTS, entries, width), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            v, code = _column(batch, "x", "<i4", (PARTS, width)), _column(batch, "code", np.uint8, (PARTS,))
            for p in range(PARTS):
                counts[p] += np.bincount(code[:, p], minlength=entries)
                np.add.at(sums[p], code[:, p], v[:, p].astype(np.int64))
        part, entry = np.nonzero(counts)
        if not len(part):
            return
        for start in range(0, max(width, 1), SLICE):
            some = np.zeros((len(part), SLICE), np.int64)
            some[:, :min(SLICE, width - start)] = sums[part, entry, start:start + SLICE]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(np.full(len(part), start), pa.int32()), pa.array(counts[part, entry]),
                 *(pa.array(some[:, i]) for i in range(SLICE))], ["part", "entry", "start", "n", *(f"s{i}" for i in range(SLICE))])
    return run


def _renewed(state: DataFrame, book: np.ndarray) -> np.ndarray:
    """Codebooks after one update: floor of sum over count, unused entries as they were. One row per entry and slice is gathered."""
    parts, entries, width = book.shape
    names = [f"s{i}" for i in range(SLICE)]
    partial = state.select("x", "code").mapInArrow(
        _sums(parts * width, entries), "part int, entry int, start int, n long, " + ", ".join(f"{c} long" for c in names))
    # Sums of sums go through decimals: a hot entry of a huge table may pass the range of long.
    total = partial.groupBy("part", "entry", "start").agg(F.sum("n").alias("n"), *(F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in names))
    new = book.copy()
    for r in total.collect():
        for i in range(min(SLICE, width - r["start"])):
            new[r["part"], r["entry"], r["start"] + i] = int(r[f"s{i}"]) // r["n"]
    return new


def train(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> tuple[DataFrame, np.ndarray, list[int]]:
    """Written codes (vec_id, label, code, error) of ``vectors`` from ``quantised``, the final codebooks (parts x entries x positions), and
    the groups scanned per pass.

    The codebooks start as the parts of the vectors of the ``entries`` (at most 256) smallest ids, null last, ties by value.
    Vectors shorter than the longest, or of a length that parts do not divide, count as filled with zeros. ``code`` holds
    one byte per part. With fewer vectors than ``entries`` the codebooks are as short; without any the result is empty.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte")
    spark = vectors.sparkSession
    ship(spark)
    held = table(vectors, "quantised")
    longest = held.agg(F.max(F.size("v"))).first()[0] or 0
    dim = max(PARTS, -(-longest // PARTS) * PARTS)
    start = held.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    book = np.zeros((PARTS, len(start), dim // PARTS), np.int64)
    for i, r in enumerate(start):
        book[:, i] = np.array([*r["v"], *[0] * (dim - len(r["v"]))], np.int64).reshape(PARTS, -1)

    def laid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.pad(np.array(v, "<i4"), (0, dim - len(v))).tobytes() for v in batch.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(rows, pa.binary())], ["vec_id", "label", "x"])

    ids, labels = (held.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    state = held.mapInArrow(laid, f"vec_id {ids}, label {labels}, x binary")
    kept = f"vec_id {ids}, label {labels}, x binary, code binary, bound binary, stamp binary, error long"
    history, scans = [book], []
    if not len(start):
        return table(state.mapInArrow(lambda batches: iter(()), kept), "codes"), book, scans
    for t in range(rounds + 1):
        books, scanned = spark.sparkContext.broadcast(np.stack(history)), spark.sparkContext.accumulator(0)
        last, state = state if t else held, table(state.mapInArrow(_pass(books, dim, scanned), kept), f"state-{t}")
        discard(last)  # the new state holds all that later rounds need
        scans.append(scanned.value)
        if t < rounds:
            history.append(_renewed(state, history[-1]))
    return state.select("vec_id", "label", "code", "error"), history[-1], scans


def codebook_text(book: np.ndarray) -> str:
    return ",".join(map(str, book.reshape(-1).tolist()))


def decoded(codes: DataFrame, book: np.ndarray) -> DataFrame:
    """``codes`` with ``v``, the vector that each code stands for."""
    held = codes.sparkSession.sparkContext.broadcast(book)
    names = codes.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = held.value
        for batch in batches:
            code = _column(batch, "code", np.uint8, (PARTS,))
            v = np.concatenate([entries[p][code[:, p]] for p in range(PARTS)], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(v.tolist(), pa.list_(pa.int64()))], [*names, "v"])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in codes.schema)
    return codes.mapInArrow(run, f"{kinds}, v array<bigint>")


def report(embeddings: DataFrame) -> DataFrame:
    """vec_id, code (hex), error, label_error, codebooks_sha256 per kept row of ``embeddings`` (vec_id, embedding, label).

    Repeated rows and ids stay; null ids and labels are values of their own. Sums per label are taken per task before they meet.
    """
    codes, book, _ = train(quantised(embeddings))
    totals = table(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "totals").withColumnRenamed("label", "__label")
    sha = hashlib.sha256(codebook_text(book).encode()).hexdigest()
    return (codes.join(totals, F.col("label").eqNullSafe(F.col("__label")), "left")
            .select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(sha).alias("codebooks_sha256")))


def brute_sql(rounds: int = ROUNDS, entries: int = ENTRIES, parts: int = PARTS) -> str:
    """DuckDB SQL for the query over embeddings: every part against every entry in every round."""
    steps = [f"""
kept as (
  select row_number() over () as id, vec_id, label, [floor(1024 * x::double)::bigint for x in embedding] as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
cut as (
  select id, vec_id, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] as x from kept, range({parts}) r(p)),
book0 as (
  select p, e, x from (select p, x, row_number() over (partition by p order by vec_id nulls last, id) - 1 as e from cut) where e < {entries})"""]
    for t in range(rounds + 1):
        steps.append(f"""
near{t} as materialized (
  select id, p, x, arg_min(e, d * 1000 + e) as e, min(d) as d
  from (select id, c.p, c.x, b.e, (list_dot_product(c.x::double[], c.x::double[]) - 2 * list_dot_product(c.x::double[], b.x::double[])
                                   + list_dot_product(b.x::double[], b.x::double[]))::bigint as d
        from cut c join book{t} b on b.p = c.p) group by id, p, x)""")
        if t < rounds:
            steps.append(f"""
mean{t} as (
  select p, e, list((s - ((s % n) + n) % n) // n order by i) as x
  from (select p, e, i, sum(x[i])::hugeint as s, count(*)::hugeint as n
        from (select p, e, x, unnest(range(1, len(x) + 1)) as i from near{t}) group by p, e, i) group by p, e),
book{t + 1} as materialized (
  select b.p, b.e, coalesce(m.x::bigint[], b.x) as x from book{t} b left join mean{t} m on m.p = b.p and m.e = b.e)""")
    return f"""
with {",".join(steps)},
codes as (
  select id, string_agg(printf('%02x', e::int), '' order by p) as code, sum(d)::bigint as error from near{rounds} group by id),
sha as (
  select sha256(string_agg(array_to_string(x, ','), ',' order by p, e)) as codebooks_sha256 from book{rounds})
select k.vec_id, c.code, c.error, sum(c.error) over (partition by k.label)::bigint as label_error, s.codebooks_sha256
from kept k join codes c on c.id = k.id, sha s
"""

"""Exact top-k inner products by norm buckets.

Vectors are grouped by length into buckets of bounded size. A first pass over the longest vectors gives every query a
score that its k-th best result must reach. With it a query needs only vectors of length score / |query| or more, and in a
bucket whose longest vector has length l only directions of cosine score / (|query| * l) or more. From that local cosine
threshold each bucket is pruned by coordinates (a direction near the query's must lie in an interval of every coordinate,
so sorted coordinate lists are cut to ranges and intersected) or, when the threshold is low, by length alone. What is left
is verified with exact products. Queries and vectors meet in blocks; only the k best of a block and bucket leave a task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulmark.llm.common import ship, table

#: Vectors in a bucket and queries in a block, about.
BUCKET_ROWS = 4096
BLOCK_ROWS = 1024
#: Norm classes grow by a factor of 2 ** (1 / CLASSES).
CLASSES = 8
#: From this local cosine threshold on, coordinates prune; below it, length.
COORDINATE_FROM = 0.5
FOCUS = 3
LONG = np.iinfo(np.int64)
FOUND = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float = 1024.0) -> DataFrame:
    """(id, v, dim, norm) with v = floor(scale * x) per component; rows with a null id, a null vector or a null, NaN or
    infinite component are left out."""
    x = F.col(vector_col).cast("array<double>")
    sound = F.forall(x, lambda e: e.isNotNull() & (F.abs(e) < float("inf")))
    v = F.transform(x, lambda e: F.floor(e * F.lit(scale)))
    return (vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(sound)
            .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
            .withColumn("dim", F.size("v"))
            .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double")))))


def _products(rows: np.ndarray, query: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products; beyond the range of long they stop at its ends."""
    if bound < 2**52:  # every partial sum is below the bound, so doubles are exact
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    exact = rows.astype(object) @ query.astype(object)
    return np.array([min(max(int(s), LONG.min), LONG.max) for s in np.atleast_1d(exact)], np.int64)


def _bucket(k: int, scanned: bool):
    """Best k of one bucket for every query of one block, as (query_id, vec_id, score)."""
    def run(key, queries: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({c: pd.Series([], dtype="int64") for c in ("query_id", "vec_id", "score")})
        if len(queries) == 0 or len(found) == 0:
            return none
        found = found.sort_values("norm", ascending=False, kind="stable")
        ids, norms = found["vec_id"].to_numpy(np.int64), found["norm"].to_numpy(np.float64)
        rows = np.stack(found["v"].to_numpy()).astype(np.int64).reshape(len(found), -1)
        longest = norms[0]
        unit = rows / np.maximum(norms, 1e-300)[:, None]
        lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        asked, near, products = [], [], []
        for qid, v, norm, least in zip(queries["vec_id"], queries["v"], queries["norm"], queries["least"]):
            q = np.asarray(v, np.int64)
            some = np.arange(len(ids))
            if not scanned and not np.isnan(least) and norm > 0 and longest > 0:
                cosine = least / (norm * longest)
                if cosine > 1 + 1e-9:
                    continue
                if least > 0:
                    some = some[:int(np.searchsorted(-norms, -(least / norm) * (1 - 1e-9), side="right"))]
                if cosine >= COORDINATE_FROM and len(some):
                    hits = np.zeros(len(ids), np.int8)
                    c = min(cosine, 1.0) - 1e-9
                    focus = np.argsort(-np.abs(q), kind="stable")[:FOCUS]
                    for f in focus.tolist():
                        if f not in lists:
                            by = np.argsort(unit[:, f], kind="stable")
                            lists[f] = by, unit[by, f]
                        by, values = lists[f]
                        x = q[f] / norm
                        spread = np.sqrt(max(0.0, 1 - x * x) * max(0.0, 1 - c * c)) + 1e-9
                        low = -1.1 if x <= -c else x * c - spread
                        high = 1.1 if x >= c else x * c + spread
                        hits[by[np.searchsorted(values, low):np.searchsorted(values, high, side="right")]] += 1
                    some = some[hits[some] == len(focus)]
            some = some[ids[some] != qid]
            if len(some) == 0:
                continue
            scores = _products(rows[some], q, norm * longest)
            if not scanned and not np.isnan(least):
                good = scores >= least
                some, scores = some[good], scores[good]
            best = np.lexsort((ids[some], ~scores))  # ~ turns the order of longs around
            _, first = np.unique(ids[some][best], return_index=True)
            best = best[np.sort(first)[:k]]
            asked.append(np.full(len(best), qid))
            near.append(ids[some][best])
            products.append(scores[best])
        if not asked:
            return none
        return pd.DataFrame({"query_id": np.concatenate(asked), "vec_id": np.concatenate(near), "score": np.concatenate(products)})
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """Per query id its k highest inner products among ``vectors``: query_id, rank (from 1), vec_id, score.

    Both frames come from ``quantised``. Ties go to the smaller vec_id; rows with the query's own id take no part, nor do
    vectors of another dimension. Rows alike count once; an id with several vectors counts with its best score. A query
    with fewer than k candidates returns them all, one with none returns no row.
    """
    spark = vectors.sparkSession
    ship(spark)
    base = table(vectors.select("vec_id", "v", "dim", "norm")
                 .withColumn("grade", F.when(F.col("norm") > 0, F.floor(F.log2("norm") * CLASSES)).otherwise(F.lit(-1)).cast("int")), "vectors")
    # One row per dimension and norm class, of which doubles allow some 17,000 per dimension: small enough to broadcast.
    classes = table(base.groupBy("dim", "grade").agg(F.ceil(F.count("*") / BUCKET_ROWS).alias("parts")), "grades")
    base = (base.join(F.broadcast(classes), ["dim", "grade"])
            .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts").cast("long")).cast("int")))
    asked = queries.select("vec_id", "v", "dim", "norm").distinct()
    n_asked = asked.count()
    n_blocks = max(1, -(-n_asked // BLOCK_ROWS))
    asked = table(asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")), "queries")
    key = ["block", "dim", "grade", "part"]
    every_block = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))

    def meet(sent: DataFrame, rows: DataFrame, scanned: bool) -> DataFrame:
        left, right = (f.select([F.col(c).alias(c) for c in (*key, "vec_id", "v", "norm", *more)]) for f, more in ((sent, ["least"]), (rows, [])))
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_bucket(k, scanned), FOUND)

    def ranked(found: DataFrame) -> DataFrame:
        best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    # First pass: each dimension's longest class, one part of it.
    top = classes.groupBy("dim").agg(F.max("grade").alias("grade")).withColumn("part", F.lit(0))
    first = base.join(F.broadcast(top), ["dim", "grade", "part"]).withColumn("block", every_block)
    seen = ranked(meet(asked.withColumn("least", F.lit(None).cast("double")).join(F.broadcast(top), "dim"), first, True))
    least = seen.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("least"))
    asked = table(asked.join(least.withColumnRenamed("query_id", "vec_id"), "vec_id", "left")
                  .withColumn("least", F.col("least").cast("double")), "thresholds")

    # A block needs vectors of the length its least demanding query asks for.
    needs = asked.groupBy("block", "dim").agg(
        F.min(F.when(F.col("least").isNull() | (F.col("least") <= 0) | (F.col("norm") <= 0), 0.0)
              .otherwise(F.col("least") / F.col("norm") * (1 - 1e-9))).alias("need"))
    rows = base.withColumn("block", every_block).join(needs, ["block", "dim"]).filter(F.col("norm") >= F.col("need"))
    parts = classes.select("dim", "grade", F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)).alias("part"))
    sent = asked.join(parts, "dim").filter(
        F.col("least").isNull() | (F.col("least") <= F.col("norm") * F.pow(F.lit(2.0), (F.col("grade") + 1) / CLASSES) * (1 + 1e-9)))
    return ranked(meet(sent, rows, False)).select("query_id", "rank", "vec_id", "score")


def brute_sql(every: int = 100, k: int = 10) -> str:
    """DuckDB SQL for the query over embeddings: all products."""
    return f"""
with v as (
  select vec_id, [floor(1024 * x::double)::bigint for x in embedding] as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.e::double[], c.e::double[])::bigint as score
  from v q join v c on c.vec_id <> q.vec_id and len(c.e) = len(q.e) where q.vec_id % {every} = 0)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) where rank <= {k}
"""

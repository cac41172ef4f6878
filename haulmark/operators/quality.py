"""Uniqueness, null counts, reconciliation, control totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from haulmark.operators.skew import salted_join


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def duplicates(df: DataFrame, key: Sequence[str], hot="auto") -> DataFrame:
    """All rows whose key occurs more than once. Null keys repeat each other."""
    many = repeated_keys(df, key)
    marked = {f"_d{i}": F.coalesce(F.col(k).cast("string"), F.lit("")) for i, k in enumerate(key)}
    marked.update({f"_e{i}": F.col(k).isNull() for i, k in enumerate(key)})
    names = list(marked)
    return salted_join(df.withColumns(marked), many.withColumns(marked).select(*names), names,
                       "left_semi", hot=hot).select(*df.columns)


def is_unique(df: DataFrame, key: Sequence[str]) -> bool:
    """Runs a job; stops at the first repeated key."""
    return repeated_keys(df, key).isEmpty()


def require_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Same rows; the job fails when a key occurs twice.

    The count is taken over the key's own partitioning and order, which a following join on the
    key uses as well. A key with a null repeats nothing, as in a unique index.
    """
    key = list(key)
    known = F.lit(True)
    for k in key:
        known = known & F.col(k).isNotNull()
    again = known & (F.count(F.lit(1)).over(Window.partitionBy(*key)) > 1)
    failed = F.when(F.col("_again"), F.raise_error(F.lit(f"key {key} is not unique"))).otherwise(F.lit(True))
    return df.withColumn("_again", again).filter(failed).drop("_again")


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column, one row per column, from one pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return one.unpivot([], df.columns, "column_name", "null_count")


def reconcile(a: DataFrame, b: DataFrame, key: str, columns: Sequence[str] = ()) -> DataFrame:
    """Keys present on one side only, with ``columns`` of that side where it has them (the smallest value of a key)."""
    def one(df, mark):
        known = [c for c in columns if c in df.columns]
        out = df.dropna(subset=[key]).groupBy(key).agg(F.lit(True).alias(mark), *[F.min(c).alias(f"{mark}_{c}") for c in known])
        return out.withColumns({f"{mark}_{c}": F.lit(None).cast("string") for c in columns if c not in known})
    joined = one(a, "_a").join(one(b, "_b"), key, "full")
    side = F.when(F.col("_b").isNull(), "only_left").when(F.col("_a").isNull(), "only_right")
    return (joined.withColumn("side", side).filter(F.col("side").isNotNull())
            .select(key, "side", *[F.coalesce(f"_a_{c}", f"_b_{c}").alias(c) for c in columns]))


def bucket_digests(df: DataFrame, key: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """Rows and an order-free digest of them per bucket of the key: one row per bucket, summed before the shuffle."""
    return df.groupBy(_bucket(key, buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"), _digest_sum(key, columns).alias("digest"))


def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _digest_sum(key: Sequence[str], columns: Sequence[str]) -> Column:
    # Hashes skip nulls, so their places are hashed along.
    gaps = F.concat(*[F.col(c).isNull().cast("string") for c in (*key, *columns)])
    return F.sum(F.xxhash64(*key, *columns, gaps).cast("decimal(38,0)"))


def reconcile_rows(a: DataFrame, b: DataFrame, key: Sequence[str], columns: Sequence[str], buckets: int = 4096) -> DataFrame:
    """Keys whose rows differ between two tables: key columns and ``side``: only_left, only_right or differs.

    Rows are compared by digest, first per bucket of the key, then per key in the buckets that differ: where the tables are
    equal only one row per bucket is shuffled, and equal buckets are never joined. Rows of a key may repeat and come in any
    order; a null key is a key. Take enough buckets that a changed key drags few others along. Both inputs are read twice, so
    give tables, not long computations. Builds the list of buckets, at most ``buckets`` numbers, when called.
    """
    key = list(key)
    left, right = (bucket_digests(df, key, columns, buckets) for df in (a, b))
    other = right.select(F.col("bucket").alias("_bucket"), F.col("rows").alias("_rows"), F.col("digest").alias("_digest"))
    apart = left.join(other, F.col("bucket") == F.col("_bucket"), "full").filter(
        ~(F.col("rows").eqNullSafe(F.col("_rows")) & F.col("digest").eqNullSafe(F.col("_digest"))))
    listed = [r[0] for r in apart.select(F.coalesce("bucket", "_bucket")).collect()]

    def per_key(df):
        some = df.filter(_bucket(key, buckets).isin(listed))
        return some.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"), _digest_sum(key, columns).alias("digest"))

    l = per_key(a)
    r = per_key(b).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], F.col("rows").alias("_rows"), F.col("digest").alias("_digest"))
    same = F.lit(True)
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    side = (F.when(F.col("_rows").isNull(), "only_left").when(F.col("rows").isNull(), "only_right")
            .when((F.col("rows") != F.col("_rows")) | (F.col("digest") != F.col("_digest")), "differs"))
    met = l.join(r, same, "full").withColumn("side", side).filter(F.col("side").isNotNull())
    return met.select(*[F.when(F.col("rows").isNull(), F.col(f"_k{i}")).otherwise(F.col(k)).alias(k) for i, k in enumerate(key)], "side")


def reconcile_breakdown(found: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys of ``reconcile`` counted per side and value of each column: side, column_name, value, missing_keys."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    long = found.select("side", F.explode(pairs).alias("_p")).select("side", "_p.*")
    return long.groupBy("side", "column_name", "value").agg(F.count(F.lit(1)).alias("missing_keys"))


def control_totals(df: DataFrame, by: Sequence[str] = (), **sums: Column) -> DataFrame:
    """Row count and named sums, overall or per group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), *[c.alias(n) for n, c in sums.items()])

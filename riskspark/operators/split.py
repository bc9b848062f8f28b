"""Repeatable stratified splits, hash sampling, class statistics.

Row order inside a class is the MD5 of ``"<seed>:<key>"`` (then the key), so a split is
a pure function of the data: the same on every run, partition count and engine.
Ranks are computed without a class-wide window: rows are bucketed by a prefix of
their hash (uniform by construction), bucket counts get a prefix sum over a table of
at most classes x 16^digits rows, and a window ranks rows inside one bucket only.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLITS = ("train", "val", "test")


def hash_key(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def approximate_mode(class_counts: Sequence[int], n_draws: int) -> list[int]:
    """Per-class draws summing to ``n_draws``: floor of the proportional share, the rest
    by largest remainder; ties go to the lower class index (deterministic)."""
    counts = [int(c) for c in class_counts]
    total = sum(counts)
    if total == 0:
        return [0] * len(counts)
    # Python integers: products of counts pass 2^63 at a few billion rows
    shares = [divmod(c * n_draws, total) for c in counts]
    out = [whole for whole, _ in shares]
    order = sorted(range(len(counts)), key=lambda i: (-shares[i][1], i))
    for i in order[:n_draws - sum(out)]:
        out[i] += 1
    return out


def allocate(class_counts: Mapping[int, int], test_size: float = 0.3, second_test_size: float = 0.67) -> dict:
    """Per-class (train, val, test) sizes of the two-stage stratified split."""
    labels = sorted(class_counts)
    counts = [class_counts[k] for k in labels]
    n = sum(counts)
    n_temp = math.ceil(test_size * n)
    train = approximate_mode(counts, n - n_temp)
    rest = [c - t for c, t in zip(counts, train)]
    n_test = math.ceil(second_test_size * n_temp)
    val = approximate_mode(rest, n_temp - n_test)
    return {k: (train[i], val[i], rest[i] - val[i]) for i, k in enumerate(labels)}


def rank_by_hash(df: DataFrame, key: str, seed: int, class_col: str | None, rows_per_bucket: int = 1_000_000,
                 total_rows: int | None = None) -> DataFrame:
    """Add ``_rank`` (1-based) = position of the row inside its class in (hash, key) order."""
    n = total_rows if total_rows is not None else df.count()
    # 16^digits hash buckets per class, about rows_per_bucket rows each
    digits = max(1, min(8, math.ceil(math.log(max(n / rows_per_bucket, 1.0), 16))))
    cls = [class_col] if class_col else []
    h = hash_key(key, seed)
    staged = df.withColumn("_h", h).withColumn("_hb", F.substring("_h", 1, digits))
    counts = staged.groupBy(*cls, "_hb").agg(F.count(F.lit(1)).alias("_bc"))
    w_base = (Window.partitionBy(*cls) if cls else Window.partitionBy(F.lit(0))).orderBy("_hb").rowsBetween(
        Window.unboundedPreceding, -1
    )
    base = counts.select(*cls, "_hb", F.coalesce(F.sum("_bc").over(w_base), F.lit(0)).alias("_base"))
    w_in = Window.partitionBy(*cls, "_hb").orderBy("_h", key)
    # ``base`` has one row per (class, bucket), about n / rows_per_bucket rows: joined on the
    # window's own keys (AQE broadcasts it when it is small), never force-broadcast
    return (
        staged.join(base, [*cls, "_hb"])
        .withColumn("_rank", F.col("_base") + F.row_number().over(w_in))
        .drop("_h", "_hb", "_base")
    )


def stratified_split(df: DataFrame, label: str = "Fraud", key: str = "TransactionID", seed: int = 42,
                     test_size: float = 0.3, second_test_size: float = 0.67) -> DataFrame:
    """Exact stratified 70 / 9.9 / 20.1 split as a ``split`` column.

    Class counts (one row per class) are the only thing collected. ``key`` should be
    unique per row (it is the transaction id).
    """
    class_counts = {int(r[0]): int(r[1]) for r in df.groupBy(label).count().collect()}
    sizes = allocate(class_counts, test_size, second_test_size)
    ranked = rank_by_hash(df, key, seed, label, total_rows=sum(class_counts.values()))
    n_train = F.lit(None).cast("long")
    n_trval = F.lit(None).cast("long")
    for k, (tr, va, _) in sizes.items():
        n_train = F.when(F.col(label) == k, F.lit(tr)).otherwise(n_train)
        n_trval = F.when(F.col(label) == k, F.lit(tr + va)).otherwise(n_trval)
    split = (
        F.when(F.col("_rank") <= n_train, F.lit("train"))
        .when(F.col("_rank") <= n_trval, F.lit("val"))
        .otherwise(F.lit("test"))
    )
    return ranked.withColumn("split", split).drop("_rank")


def split_audit(df: DataFrame, label: str = "Fraud") -> DataFrame:
    """Rows, positives and positive ratio per split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col(label)).cast("long").alias("positives"),
        F.avg(F.col(label).cast("double")).alias("ratio"),
    )


def hash_sample(df: DataFrame, fraction: float = 0.02, key: str = "TransactionID", seed: int = 42) -> DataFrame:
    """Exactly int(fraction x n) rows without replacement, smallest hashes first."""
    n = df.count()
    k = int(n * fraction)
    return rank_by_hash(df, key, seed, None, total_rows=n).where(F.col("_rank") <= k).drop("_rank")


def class_distribution(df: DataFrame, label: str = "Fraud") -> DataFrame:
    """P5: rows per class."""
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("count"))


def class_weights(df: DataFrame, label: str = "Fraud") -> DataFrame:
    """Balanced weights n / (2 n_c) per class and the negative/positive ratio."""
    agg = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(label) == 0).alias("n_neg"),
        F.count_if(F.col(label) == 1).alias("n_pos"),
    )
    return agg.select(
        "n", "n_neg", "n_pos",
        F.try_divide(F.col("n").cast("double"), F.lit(2.0) * F.col("n_neg")).alias("weight_neg"),
        F.try_divide(F.col("n").cast("double"), F.lit(2.0) * F.col("n_pos")).alias("weight_pos"),
        F.try_divide(F.col("n_neg").cast("double"), F.col("n_pos").cast("double")).alias("scale_pos_weight"),
    )


def with_weights(df: DataFrame, label: str = "Fraud", out: str = "weight", fit_on: Column | None = None) -> DataFrame:
    """P6 as a ``weightCol`` for MLlib: n / (2 n_c) from one scalar subquery, counted over the
    rows where ``fit_on`` holds (all rows by default)."""
    w = class_weights(df if fit_on is None else df.where(fit_on), label)
    wn = w.select("weight_neg").scalar()
    wp = w.select("weight_pos").scalar()
    return df.withColumn(out, F.when(F.col(label) == 1, wp).otherwise(wn))


def class_check(df: DataFrame, label: str = "Fraud", raise_on_single: bool = False) -> DataFrame:
    """Distinct classes per split; optionally raise when a split has fewer than two."""
    out = df.groupBy("split").agg(F.count_distinct(F.col(label)).alias("n_classes"))
    if raise_on_single:
        bad = [r["split"] for r in out.where(F.col("n_classes") < 2).collect()]
        if bad:
            raise ValueError(f"splits with a single class: {bad}")
    return out

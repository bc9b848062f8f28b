"""Skew-safe ordered statistics: prefix sums, exact k-th values, exact quantiles, modes.

A window ordered over a whole table (``Window.orderBy(x)`` with no partition) runs in
one task, and Spark's exact ``percentile``/``median``/``mode`` aggregates keep every
distinct value of a group in one buffer. Neither survives a 100 TB input. The helpers
here give the same exact answers with bounded per-task work:

* input is first pre-aggregated by its order key (``groupBy(value).count()``), so a
  value held by a third of all rows is one row after map-side combine;
* rows are range-sorted by (group, order key) into ranges of about ``ROWS_PER_BUCKET`` rows; their
  number follows the size of the table, and they only balance work, they never change the answer;
* per-range totals (at most groups + ranges rows) get a prefix sum and are joined back, and
  inside each range a window adds the local prefix.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.nulls import clean_double
from riskspark.session import ensure_checkpoint_dir

ROWS_PER_BUCKET = 2_000_000  # rows one window task may hold


def bucket_of(value: Column, cuts: Column, n_cuts: int, field: str | None = None) -> Column:
    """Number of elements of the sorted array ``cuts`` (or of their ``field``) that are < ``value``.

    A binary search written as an ``aggregate`` over log2(n) steps, so the work per
    row is logarithmic in the number of cut points. The (lo, hi) pair is packed into
    one long (both < 2^20), which keeps the lambda free of per-step struct objects.
    Null values land in bucket 0.
    """
    depth = max(1, math.ceil(math.log2(n_cuts + 1)) + 1)
    mask = F.lit((1 << 20) - 1)

    def step(acc, _):
        lo, hi = F.shiftright(acc, 20), acc.bitwiseAND(mask)
        mid = F.shiftright(lo + hi, 1)
        cut = F.get(cuts, mid.cast("int"))
        go_right = F.coalesce((cut[field] if field else cut) < value, F.lit(False))
        moved = F.when(go_right, F.shiftleft(mid + 1, 20) + hi).otherwise(F.shiftleft(lo, 20) + mid)
        return F.when(lo < hi, moved).otherwise(acc)

    start = F.size(cuts).cast("long")
    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), start, step, lambda acc: F.shiftright(acc, 20).cast("int"))


def bucketize(df: DataFrame, col: str, cuts: list[float], out: str) -> DataFrame:
    """Range index of ``col`` against sorted literal cut points with MLlib's
    ``Bucketizer`` (a compiled binary search); null values go to range 0."""
    from pyspark.ml.feature import Bucketizer

    splits = [-math.inf] + sorted({float(c) for c in cuts if math.isfinite(c)}) + [math.inf]
    b = Bucketizer(splits=splits, inputCol=col, outputCol="_bkt", handleInvalid="keep")
    return b.transform(df).withColumn(
        out, F.when(F.col(col).isNull(), F.lit(0)).otherwise(F.col("_bkt").cast("int"))
    ).drop("_bkt")


def ordered_cumsum(
    df: DataFrame,
    order_col: str,
    sum_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    descending: bool = False,
    buckets: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    materialize: bool = True,
) -> DataFrame:
    """Add ``<c>_before`` (sum over rows strictly earlier in order) and ``<c>_upto``
    (inclusive) for each column in ``sum_cols``, per group.

    ``df`` must hold at most one row per (group, order value), i.e. be pre-aggregated;
    then the row frame equals the range frame. ``order_col`` must be numeric.
    Groups may be many.

    ``materialize`` checkpoints ``df`` (an aggregate, far smaller than its input) into
    the shared checkpoint folder, so the passes below read it instead of recomputing
    the scans and joins behind it. Unless ``buckets`` is given, the number of ranges is
    sized from the largest group: a group of at most ``rows_per_bucket`` rows is one
    window partition; beyond, all rows are cut into about rows / rows_per_bucket ranges.
    """
    if materialize:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    user_groups = list(group_cols)
    if buckets is None:
        sizes = df.groupBy(*user_groups).count().agg(F.max("count")).first()[0] or 0
        if sizes > rows_per_bucket:
            buckets = math.ceil((df.count() if user_groups else sizes) / rows_per_bucket)
        else:
            buckets = 1
    df = df.withColumn("_ok", _order_key(df, order_col, descending))
    if buckets <= 1:
        w_one = Window.partitionBy(*user_groups).orderBy("_ok").rowsBetween(Window.unboundedPreceding, -1)
        out = df
        for c in sum_cols:
            out = out.withColumn(f"{c}_before", F.coalesce(F.sum(c).over(w_one), F.lit(0)))
            out = out.withColumn(f"{c}_upto", F.col(f"{c}_before") + F.col(c))
        return out.drop("_ok")
    ensure_checkpoint_dir(df.sparkSession)
    # ranges are the partitions of a range sort by (group, order); written, so that both passes see the same ones
    placed = df.repartitionByRange(buckets, *user_groups, "_ok").withColumn("_b", F.spark_partition_id()).checkpoint(eager=True)
    totals = placed.groupBy(*user_groups, "_b").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    # a group's totals: one row a range it has rows in, so groups + ranges rows at most in all
    w_tot = Window.partitionBy(*user_groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(*[F.col(g).alias(f"_k{i}") for i, g in enumerate(user_groups)], F.col("_b").alias("_kb"),
                         *[F.coalesce(F.sum(f"_t_{c}").over(w_tot), F.lit(0)).alias(f"_base_{c}") for c in sum_cols])
    same = F.col("_b") == F.col("_kb")
    for i, g in enumerate(user_groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_k{i}"))
    w_in = Window.partitionBy(*user_groups, "_b").orderBy("_ok").rowsBetween(Window.unboundedPreceding, -1)
    out = placed.join(base, same)
    for c in sum_cols:
        out = out.withColumn(f"{c}_before", F.col(f"_base_{c}") + F.coalesce(F.sum(c).over(w_in), F.lit(0)))
        out = out.withColumn(f"{c}_upto", F.col(f"{c}_before") + F.col(c))
    return out.drop("_ok", "_b", "_kb", *[f"_k{i}" for i in range(len(user_groups))], *[f"_base_{c}" for c in sum_cols])


def _order_key(df: DataFrame, col: str, descending: bool) -> Column:
    """A rising order key: whole numbers stay whole (doubles would tie beyond 2^53), others are doubles."""
    if isinstance(df.schema[col].dataType, T.IntegralType):
        x = F.col(col).cast("long")
        return F.bitwise_not(x) if descending else x
    x = F.col(col).cast("double")
    return -x if descending else x


def value_counts(df: DataFrame, value: Column, group_cols: Sequence[str] = ()) -> DataFrame:
    """(group..., v, cnt) over non-null values; partial aggregation absorbs hot values."""
    return (
        df.select(*group_cols, value.alias("v"))
        .where(F.col("v").isNotNull())
        .groupBy(*group_cols, "v")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def _interp_positions(n: int, q: float) -> tuple[int, int, float]:
    pos = (n - 1) * q
    lo = math.floor(pos)
    hi = math.ceil(pos)
    return lo, hi, pos - lo


def approx_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float], accuracy: int = 10000) -> dict:
    """One mergeable pass (``percentile_approx``): rank error about n / accuracy. For inputs
    where even one value-count shuffle is too much; results are not exact."""
    cols, qs = list(cols), list(qs)
    if not cols:
        return {}
    row = df.agg(*[F.percentile_approx(clean_double(c), qs, accuracy).alias(c) for c in cols]).first()
    return {(c, q): (row[c][i] if row[c] is not None else None) for c in cols for i, q in enumerate(qs)}


def quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float], exact: bool = True) -> dict:
    return exact_quantiles(df, cols, qs) if exact else approx_quantiles(df, cols, qs)


def medians(df: DataFrame, cols: Sequence[str], exact: bool = True) -> dict:
    return {c: v for (c, _), v in quantiles(df, cols, [0.5], exact).items()}


def exact_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float], buckets: int | None = None,
                    accuracy: int = 10000) -> dict:
    """Exact quantiles with linear interpolation (pandas/numpy/Spark ``percentile``).

    Returns ``{(col, q): value or None}``. Nulls and NaN are skipped. Two scans: the first counts
    values and brackets every wanted rank with ``percentile_approx`` (rank error n / accuracy, so
    the bracket of twice that on either side holds the rank); the second counts the values below a
    bracket, which become one row in map-side combine, and shuffles only the values inside it, about
    4 / accuracy of all. Columns of fewer than 4 x ``accuracy`` values need no bracket. A bracket
    that missed its rank would be widened to the whole column. Only the rows holding the wanted
    ranks (at most 2 x cols x qs) reach the driver.
    """
    return exact_quantile_pairs(df, [(c, q) for c in cols for q in qs], buckets, accuracy)


def exact_quantile_pairs(df: DataFrame, pairs: Sequence[tuple[str, float]], buckets: int | None = None, accuracy: int = 10000) -> dict:
    """:func:`exact_quantiles` of the given (column, q) only: every column has ranks of its own."""
    wanted = {}
    for c, q in dict.fromkeys(pairs):
        wanted.setdefault(c, []).append(q)
    if not wanted:
        return {}
    ensure_checkpoint_dir(df.sparkSession)
    margin = 2.0 / accuracy
    row = df.agg(*[x for i, (c, qs) in enumerate(wanted.items()) for x in (
        F.count(clean_double(c)).alias(f"n{i}"),
        F.percentile_approx(clean_double(c), [p for q in qs for p in (max(0.0, q - margin), min(1.0, q + margin))], accuracy).alias(f"p{i}"))]).first()
    out, brackets = {}, {}
    for i, (c, qs) in enumerate(wanted.items()):
        for j, q in enumerate(qs):
            n = row[f"n{i}"]
            if not n:
                out[(c, q)] = None
            else:
                lo, hi = (row[f"p{i}"][2 * j], row[f"p{i}"][2 * j + 1]) if n >= 4 * accuracy else (None, None)
                brackets[(c, q)] = (n, lo, hi)
    while brackets:
        out.update(_ranks_inside(df, brackets, buckets))
        brackets = {k: (n, None, None) for k, (n, _, _) in brackets.items() if k not in out}
    return out


def _ranks_inside(df: DataFrame, brackets: dict, buckets: int | None) -> dict:
    """The quantiles of ``brackets`` {(col, q): (n, low, high)} whose ranks lie inside their bracket."""
    names = {f"{i}": k for i, k in enumerate(brackets)}
    items = []
    for name, k in names.items():
        _, lo, hi = brackets[k]
        x = clean_double(k[0])
        v = x if lo is None else F.when(x >= F.lit(lo), x)
        keep = x.isNotNull() if hi is None else x.isNotNull() & (x <= F.lit(hi))
        items.append(F.when(keep, F.struct(F.lit(name).alias("name"), v.alias("v"))))
    # values below a bracket have a null v
    vc = df.select(F.explode(F.array(*items)).alias("kv")).where(F.col("kv").isNotNull()).select("kv.name", "kv.v") \
        .groupBy("name", "v").agg(F.count(F.lit(1)).alias("cnt")).checkpoint(eager=True)
    below = {r["name"]: r["cnt"] for r in vc.where(F.col("v").isNull()).collect()}
    cum = ordered_cumsum(vc.where(F.col("v").isNotNull()), "v", ["cnt"], ["name"], buckets=buckets, materialize=False)
    cond = F.lit(False)
    for name, k in names.items():
        for r in _interp_positions(brackets[k][0], k[1])[:2]:
            at = r - below.get(name, 0)
            cond = cond | ((F.col("name") == name) & (F.col("cnt_before") <= at) & (F.col("cnt_upto") > at))
    rows = cum.where(cond).select("name", "v", "cnt_before", "cnt_upto").collect()
    out = {}
    for name, k in names.items():
        lo, hi, frac = _interp_positions(brackets[k][0], k[1])
        off = below.get(name, 0)
        found = [next((r["v"] for r in rows if r["name"] == name and r["cnt_before"] <= rank - off < r["cnt_upto"]), None)
                 for rank in (lo, hi)]
        if None not in found:
            a, b = found
            out[k] = a + (b - a) * frac if hi != lo else a
    return out


def exact_medians(df: DataFrame, cols: Sequence[str]) -> dict:
    return {c: v for (c, _), v in exact_quantiles(df, cols, [0.5]).items()}


def column_modes(df: DataFrame, cols: Sequence[str]) -> dict:
    """Most frequent non-null value per column; ties go to the smallest value.

    ``groupBy(name, value).count()`` combines map-side, so a value held by a large
    share of rows costs one row per task; ``min_by`` over (-count, value) is a
    mergeable aggregate. Returns ``{col: value or None}`` (None when all null).
    """
    cols = list(cols)
    if not cols:
        return {}
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("x")) for c in cols])
        ).alias("_kv")
    ).select("_kv.name", "_kv.x")
    vc = value_counts(long, F.col("x"), ["name"])
    best = vc.groupBy("name").agg(
        F.min_by("v", F.struct((-F.col("cnt")).alias("neg_cnt"), F.col("v").alias("v"))).alias("mode")
    )
    found = {r["name"]: r["mode"] for r in best.collect()}
    return {c: found.get(c) for c in cols}

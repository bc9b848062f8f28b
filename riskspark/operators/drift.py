"""Two-sample Kolmogorov-Smirnov drift per feature, overall score, ranking.

Both samples are unpivoted to (feature, value), counted per (feature, value, side)
with map-side combine (or the reference side's counts come from a stored dataset version), and the two empirical CDFs are walked with the skew-safe,
feature-grouped prefix sum. The statistic is the largest CDF gap; nulls are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.nulls import clean_double
from riskspark.operators.cumulative import ordered_cumsum
from riskspark.session import ensure_checkpoint_dir

DRIFT_THRESHOLD = 0.1
OVERALL_THRESHOLD = 0.3
P_VALUE_TERMS = 100


def shared_numeric_columns(ref: DataFrame, cur: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns present in both frames, in the reference frame's order."""
    cur_num = {f.name for f in cur.schema.fields if isinstance(f.dataType, T.NumericType)}
    return [
        f.name for f in ref.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name in cur_num and f.name not in exclude
    ]


def _long(df: DataFrame, features: Sequence[str], side: int) -> DataFrame:
    return df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), clean_double(c).alias("value")) for c in features])).alias("kv")
    ).select("kv.feature", "kv.value", F.lit(side).alias("side"))


def ks_p_value(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value, 2 sum_{k=1..100} (-1)^(k-1) exp(-2 k^2 lam^2),
    lam = D sqrt(nm/(n+m)); 1 when lam < 0.1 (the series has not converged there, the
    true value is 1 to double precision); clipped to [0, 1]."""
    lam = d * F.sqrt(n.cast("double") * m.cast("double") / (n + m).cast("double"))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(P_VALUE_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc + F.pow(F.lit(-1.0), (k - 1).cast("double")) * F.exp(F.lit(-2.0) * (k * k).cast("double") * lam * lam),
    )
    return F.when(lam < 0.1, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(2.0) * series)))


def ks_drift(ref: DataFrame, cur: DataFrame, features: Sequence[str], threshold: float = DRIFT_THRESHOLD,
             buckets: int | None = None) -> DataFrame:
    """(feature, ks_statistic, p_value, drift_detected) for features with more than
    one distinct value on both sides."""
    both = _long(ref, features, 0).unionByName(_long(cur, features, 1)).where(F.col("value").isNotNull())
    counts = both.groupBy("feature", "value").agg(
        F.count_if(F.col("side") == 0).alias("c_ref"), F.count_if(F.col("side") == 1).alias("c_cur"))
    return _ks(counts, threshold, buckets)


def value_counts_of(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, value, cnt): the distribution of each feature, nulls dropped; what a drift reference is kept as."""
    return _long(df, features, 0).where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt"))


def ks_drift_from_counts(reference: DataFrame, cur: DataFrame, features: Sequence[str] | None = None, threshold: float = DRIFT_THRESHOLD,
                         buckets: int | None = None) -> DataFrame:
    """D2-D5 against a stored reference of :func:`value_counts_of`: the reference rows are not read again.

    ``features`` default to the stored ones that are numeric in ``cur`` (D1)."""
    if features is None:
        stored = [r["feature"] for r in reference.select("feature").distinct().collect()]  # a row a feature
        features = sorted(set(stored) & {f.name for f in cur.schema.fields if isinstance(f.dataType, T.NumericType)})
    old = reference.where(F.col("feature").isin(*features)).select("feature", "value", F.col("cnt").alias("c_ref"), F.lit(0).cast("long").alias("c_cur"))
    new = value_counts_of(cur, features).select("feature", "value", F.lit(0).cast("long").alias("c_ref"), F.col("cnt").alias("c_cur"))
    both = old.unionByName(new).groupBy("feature", "value").agg(F.sum("c_ref").alias("c_ref"), F.sum("c_cur").alias("c_cur"))
    return _ks(both, threshold, buckets)


def _ks(counts: DataFrame, threshold: float, buckets: int | None) -> DataFrame:
    """D2-D5 from (feature, value, c_ref, c_cur), one row a value."""
    ensure_checkpoint_dir(counts.sparkSession)
    counts = counts.checkpoint(eager=True)
    # D2 from the same counts: a side varies when it has two or more distinct values
    per_feature = counts.groupBy("feature").agg(
        F.sum("c_ref").alias("n_ref"),
        F.sum("c_cur").alias("n_cur"),
        F.count_if(F.col("c_ref") > 0).alias("d_ref"),
        F.count_if(F.col("c_cur") > 0).alias("d_cur"),
    ).where((F.col("d_ref") > 1) & (F.col("d_cur") > 1))
    cum = ordered_cumsum(counts, "value", ["c_ref", "c_cur"], ["feature"], buckets=buckets, materialize=False)
    gaps = cum.join(F.broadcast(per_feature.select("feature", "n_ref", "n_cur")), "feature").select(
        "feature", "n_ref", "n_cur",
        F.abs(F.col("c_ref_upto") / F.col("n_ref") - F.col("c_cur_upto") / F.col("n_cur")).alias("gap"),
    )
    stat = gaps.groupBy("feature", "n_ref", "n_cur").agg(F.max("gap").alias("ks_statistic"))
    return stat.select(
        "feature",
        "ks_statistic",
        ks_p_value(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur")).alias("p_value"),
        (F.col("ks_statistic") > F.lit(threshold)).alias("drift_detected"),
    )


def drift_summary(drift: DataFrame, threshold: float = OVERALL_THRESHOLD) -> DataFrame:
    """Share of drifted features and whether it exceeds ``threshold``."""
    return drift.agg(
        F.avg(F.col("drift_detected").cast("double")).alias("overall_drift_score"),
        F.count(F.lit(1)).alias("features_tested"),
    ).select(
        "overall_drift_score",
        "features_tested",
        F.coalesce(F.col("overall_drift_score") > F.lit(threshold), F.lit(False)).alias("overall_drift_detected"),
    )


def drift_ranking(drift: DataFrame) -> DataFrame:
    """Features by KS statistic, largest first (feature name breaks ties)."""
    return drift.orderBy(F.desc("ks_statistic"), F.asc("feature"))

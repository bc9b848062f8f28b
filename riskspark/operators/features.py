"""Transaction features as a fitted Estimator.

The reference recomputes the F6/F7/F9 statistics on whatever batch it transforms, so a
one-row request is compared with itself. ``TransactionFeatures.fit`` stores the
statistics; ``batch_stats=True`` reproduces the reference behaviour.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.nulls import clean_double, flag_int
from riskspark.functions.time import (
    day_of_week,
    hours_between,
    is_weekend,
    time_period,
    transaction_hour,
    transaction_month,
)
from riskspark.operators.clean import DATE_COLUMNS, ID_COLUMNS
from riskspark.operators.cumulative import quantiles

HIGH_VALUE_QUANTILE = 0.9


@dataclass
class FeatureStats:
    has_date: bool = False
    has_gap: bool = False
    gap_median: float | None = None
    gap_mean: float | None = None
    gap_std: float | None = None
    amount_q90: float | None = None
    extra: dict = field(default_factory=dict)


def _raw_gap(df: DataFrame) -> F.Column:
    return hours_between(F.col("TransactionDate"), F.col("PreviousTransactionDate"))


def compute_stats(df: DataFrame, exact: bool = True) -> FeatureStats:
    """Statistics over ``df``.

    The columns the statistics need (gap hours, amount) are projected once and
    checkpointed, so the probe, the exact-quantile job and the mean/deviation pass read
    that narrow table instead of recomputing the joins and windows behind ``df``.
    """
    from riskspark.session import ensure_checkpoint_dir

    cols = set(df.columns)
    st = FeatureStats()
    narrow = []
    if "TransactionDate" in cols:
        narrow.append(F.col("TransactionDate").isNotNull().alias("_has_date"))
    if {"TransactionDate", "PreviousTransactionDate"} <= cols:
        narrow += [F.col("PreviousTransactionDate").isNotNull().alias("_has_prev"), _raw_gap(df).alias("_gap")]
    amount = {"TransactionAmount", "AccountBalance"} <= cols
    if amount:
        narrow.append(F.col("TransactionAmount"))
    if not narrow:
        return st
    ensure_checkpoint_dir(df.sparkSession)
    staged = df.select(*narrow).checkpoint(eager=True)
    probes = []
    if "_has_date" in staged.columns:
        probes.append(F.count_if("_has_date").alias("n_date"))
    if "_has_prev" in staged.columns:
        probes.append(F.count_if("_has_prev").alias("n_prev"))
    if probes:
        row = staged.agg(*probes).first().asDict()
        st.has_date = bool(row.get("n_date"))
        st.has_gap = st.has_date and bool(row.get("n_prev"))
    wanted = []
    if st.has_gap:
        wanted.append(("_gap", 0.5))
    if amount:
        wanted.append(("TransactionAmount", HIGH_VALUE_QUANTILE))
    if wanted:
        qs = quantiles(staged, sorted({c for c, _ in wanted}), sorted({q for _, q in wanted}), exact)
        st.gap_median = qs.get(("_gap", 0.5))
        st.amount_q90 = qs.get(("TransactionAmount", HIGH_VALUE_QUANTILE))
    if st.has_gap:
        filled = _filled_gap(F.col("_gap"), st.gap_median)
        row = staged.agg(F.avg(filled).alias("m"), F.stddev_samp(filled).alias("s")).first()
        st.gap_mean, st.gap_std = row["m"], row["s"]
    return st


def _filled_gap(raw, median):
    clipped = F.when(raw.isNull(), raw).otherwise(F.greatest(raw, F.lit(0.0)))
    return F.coalesce(clipped, F.lit(median).cast("double"))


def apply_features(df: DataFrame, st: FeatureStats, drop_source: bool = True, keep=()) -> DataFrame:
    cols = set(df.columns)
    out = df
    if st.has_date:
        ts = F.col("TransactionDate")
        out = out.withColumns(
            {
                "TransactionHour": transaction_hour(ts),
                "TransactionDayOfWeek": day_of_week(ts),
                "TransactionMonth": transaction_month(ts),
                "IsWeekend": is_weekend(ts),
                "TimePeriod": time_period(ts),
            }
        )
    if st.has_gap:
        gap = _filled_gap(_raw_gap(df), st.gap_median)
        out = out.withColumn("HoursSincePreviousTransaction", gap)
        if st.gap_mean is not None and st.gap_std is not None:
            limit = F.lit(st.gap_mean + 2 * st.gap_std)
            out = out.withColumn("UnusualTransactionTiming", flag_int(F.col("HoursSincePreviousTransaction") > limit))
        else:
            out = out.withColumn("UnusualTransactionTiming", F.lit(0))
    if {"TransactionAmount", "AccountBalance"} <= cols:
        amount = clean_double("TransactionAmount")
        balance = clean_double("AccountBalance")
        out = out.withColumn(
            "TransactionToBalanceRatio",
            F.coalesce(F.try_divide(amount, F.nullif(balance, F.lit(0.0))), F.lit(0.0)),
        )
        q = st.amount_q90
        out = out.withColumn(
            "HighValueTransaction", flag_int(amount > F.lit(q)) if q is not None else F.lit(0)
        )
    if "LoginAttempts" in cols:
        out = out.withColumn("HighLoginAttempts", flag_int(F.col("LoginAttempts") > 1))
    if drop_source:
        drop = [c for c in DATE_COLUMNS + ID_COLUMNS if c in cols and c not in keep]
        out = out.drop(*drop)
    return out


class TransactionFeatures:
    """Estimator: ``fit(df)`` -> :class:`TransactionFeaturesModel`."""

    def __init__(self, batch_stats: bool = False, drop_source: bool = True, keep=(), exact: bool = True):
        self.exact = exact
        self.batch_stats = batch_stats
        self.drop_source = drop_source
        self.keep = tuple(keep)

    def fit(self, df: DataFrame) -> "TransactionFeaturesModel":
        return TransactionFeaturesModel(compute_stats(df, self.exact), self.batch_stats, self.drop_source, self.keep)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


class TransactionFeaturesModel:
    def __init__(self, stats: FeatureStats | None, batch_stats: bool = False, drop_source: bool = True, keep=()):
        self.stats = stats
        self.batch_stats = batch_stats
        self.drop_source = drop_source
        self.keep = tuple(keep)

    def state(self) -> dict:
        """Plain values from which :meth:`from_state` makes the same model."""
        return {"stats": asdict(self.stats) if self.stats else None, "batch_stats": self.batch_stats,
                "drop_source": self.drop_source, "keep": list(self.keep)}

    @classmethod
    def from_state(cls, state: dict) -> "TransactionFeaturesModel":
        stats = FeatureStats(**state["stats"]) if state["stats"] else None
        return cls(stats, state["batch_stats"], state["drop_source"], state["keep"])

    def transform(self, df: DataFrame) -> DataFrame:
        if self.stats is None and not self.batch_stats:
            raise RuntimeError("feature pipeline is not fitted")
        st = compute_stats(df) if self.batch_stats else self.stats
        return apply_features(df, st, self.drop_source, self.keep)


def batch_features(df: DataFrame, keep=("TransactionID",)) -> DataFrame:
    """Reference behaviour: statistics from the batch itself."""
    return TransactionFeaturesModel(None, batch_stats=True, keep=keep).transform(df)

"""Classification metrics as distributed aggregates.

Everything is one pass of mergeable aggregates (``count_if``/``sum``/``avg``), except
the exact ROC AUC, which pre-aggregates by score and runs the skew-safe prefix sum of
``cumulative.ordered_cumsum`` instead of a global window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.nulls import clean_double
from riskspark.operators.cumulative import ordered_cumsum

# Metric names of the monitoring report, in report order.
REPORT_METRICS = [
    "accuracy", "precision", "recall", "f1_score", "roc_auc", "fraud_rate", "alert_rate", "sample_size",
    "true_negatives", "false_positives", "false_negatives", "true_positives",
]
# The six rows of the dashboard metrics table, display name and report key.
TABLE_METRICS = [
    ("Accuracy", "accuracy"), ("Precision", "precision"), ("Recall", "recall"),
    ("F1 Score", "f1_score"), ("ROC AUC", "roc_auc"), ("Sample Size", "sample_size"),
]


def _ratio(num: Column, den: Column) -> Column:
    """num / den, 0 when the denominator is 0 (sklearn ``zero_division`` default)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def confusion_aggs(label: str, pred: str) -> list[Column]:
    y, p = F.col(label), F.col(pred)
    return [
        F.count_if((y == 0) & (p == 0)).alias("true_negatives"),
        F.count_if((y == 0) & (p == 1)).alias("false_positives"),
        F.count_if((y == 1) & (p == 0)).alias("false_negatives"),
        F.count_if((y == 1) & (p == 1)).alias("true_positives"),
        F.count(F.lit(1)).alias("sample_size"),
        F.avg(y.cast("double")).alias("fraud_rate"),
        F.avg(p.cast("double")).alias("alert_rate"),
    ]


def rates_from_confusion(df: DataFrame) -> DataFrame:
    """V1-V4 from confusion counts: accuracy, precision, recall, F1."""
    tn, fp, fn, tp = (F.col(c) for c in ("true_negatives", "false_positives", "false_negatives", "true_positives"))
    return df.withColumns(
        {
            "accuracy": _ratio(tp + tn, F.col("sample_size")),
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1_score": _ratio(F.lit(2) * tp, F.lit(2) * tp + fp + fn),
        }
    )


def confusion(df: DataFrame, label: str = "Fraud", pred: str = "FraudPrediction", group_cols: Sequence[str] = ()) -> DataFrame:
    """V1-V5, V8: one row (per group) of confusion counts, rates and fraud/alert rates."""
    agg = df.groupBy(*group_cols).agg(*confusion_aggs(label, pred))
    return rates_from_confusion(agg)


def _binned(score: str, score_decimals: int | None):
    s = clean_double(score)
    return F.round(s, score_decimals) if score_decimals is not None else s


def roc_auc(df: DataFrame, label: str = "Fraud", score: str = "FraudScore", group_cols: Sequence[str] = (),
            buckets: int | None = None, score_decimals: int | None = None) -> DataFrame:
    """V6: exact ROC AUC with ties counted half (Mann-Whitney), per group.

    Rows with a null/NaN score or label are skipped. One-class groups give null.
    ``score_decimals`` (opt-in) rounds scores first, bounding the per-score table at
    10^d + 1 rows for scores in [0, 1]; rows sharing a rounded score count as ties.
    """
    group_cols = list(group_cols)
    s = _binned(score, score_decimals)
    by_score = (
        df.select(*group_cols, s.alias("_s"), F.col(label).cast("int").alias("_y"))
        .where(F.col("_s").isNotNull() & F.col("_y").isNotNull())
        .groupBy(*group_cols, "_s")
        .agg(F.sum("_y").cast("long").alias("_pos"), F.sum(F.lit(1) - F.col("_y")).cast("long").alias("_neg"))
    )
    return auc_from_counts(by_score, "_s", group_cols, buckets)


def auc_from_counts(by_score: DataFrame, score: str = "_s", group_cols: Sequence[str] = (),
                    buckets: int | None = None, materialize: bool = True) -> DataFrame:
    """V6 from (group..., score, _pos, _neg) rows, one per distinct score. Pass
    ``materialize=False`` when ``by_score`` is already cheap to recompute."""
    group_cols = list(group_cols)
    cum = ordered_cumsum(by_score, score, ["_neg"], group_cols, buckets=buckets, materialize=materialize)
    agg = cum.groupBy(*group_cols).agg(
        F.sum(F.col("_pos").cast("double") * (F.col("_neg_before").cast("double") + F.col("_neg") / F.lit(2.0))).alias("_num"),
        F.sum("_pos").alias("_p"),
        F.sum("_neg").alias("_n"),
    )
    return agg.select(
        *group_cols,
        F.when((F.col("_p") > 0) & (F.col("_n") > 0), F.col("_num") / (F.col("_p").cast("double") * F.col("_n").cast("double"))).alias("roc_auc"),
    )


def performance_metrics(df: DataFrame, label: str = "Fraud", pred: str = "FraudPrediction",
                        score: str = "FraudScore", group_cols: Sequence[str] = (),
                        score_decimals: int | None = None) -> DataFrame:
    """V8 (and V9 with ``group_cols``): the monitoring metric row(s).

    One pass over the input: rows are counted per (group, score, prediction, label);
    that aggregate is checkpointed and both the confusion counts and the exact AUC
    are read from it. ``score_decimals`` as in :func:`roc_auc` (confusion counts stay
    exact: they use the prediction column).
    """
    from riskspark.session import ensure_checkpoint_dir

    group_cols = list(group_cols)
    y, p, s = F.col(label).cast("int"), F.col(pred).cast("int"), _binned(score, score_decimals)
    agg = (
        df.select(*group_cols, s.alias("_s"), p.alias("_p"), y.alias("_y"))
        .groupBy(*group_cols, "_s", "_p", "_y")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ensure_checkpoint_dir(df.sparkSession)
    agg = agg.checkpoint(eager=True)
    cnt = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("_n"))), F.lit(0)).cast("long")
    yy, pp = F.col("_y"), F.col("_p")
    conf = rates_from_confusion(agg.groupBy(*group_cols).agg(
        cnt((yy == 0) & (pp == 0)).alias("true_negatives"),
        cnt((yy == 0) & (pp == 1)).alias("false_positives"),
        cnt((yy == 1) & (pp == 0)).alias("false_negatives"),
        cnt((yy == 1) & (pp == 1)).alias("true_positives"),
        cnt(F.lit(True)).alias("sample_size"),
        F.try_divide(F.sum(F.when(yy.isNotNull(), yy * F.col("_n"))).cast("double"),
                     F.sum(F.when(yy.isNotNull(), F.col("_n"))).cast("double")).alias("fraud_rate"),
        F.try_divide(F.sum(F.when(pp.isNotNull(), pp * F.col("_n"))).cast("double"),
                     F.sum(F.when(pp.isNotNull(), F.col("_n"))).cast("double")).alias("alert_rate"),
    ))
    by_score = (
        agg.where(F.col("_s").isNotNull() & yy.isNotNull())
        .groupBy(*group_cols, "_s")
        .agg(F.sum(F.when(yy == 1, F.col("_n")).otherwise(0)).cast("long").alias("_pos"),
             F.sum(F.when(yy == 0, F.col("_n")).otherwise(0)).cast("long").alias("_neg"))
    )
    if group_cols:
        auc = auc_from_counts(by_score, "_s", group_cols, materialize=False)
        return conf.join(auc, group_cols, "left").select(*group_cols, *REPORT_METRICS)
    auc = auc_from_counts(by_score, materialize=False).scalar()
    return conf.select(*[auc.alias(m) if m == "roc_auc" else F.col(m) for m in REPORT_METRICS])


def metrics_long(metric_row: DataFrame) -> DataFrame:
    """The metric row as (metric, value) pairs."""
    return metric_row.select(
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in REPORT_METRICS])
        ).alias("kv")
    ).select("kv.metric", "kv.value")


def daily_metrics(df: DataFrame, label: str = "Fraud", pred: str = "FraudPrediction", score: str = "FraudScore",
                  ts: str = "Timestamp") -> DataFrame:
    """V9: V1-V8 per calendar day (AUC per day through a day-grouped prefix sum)."""
    with_day = df.withColumn("Date", F.date_format(F.col(ts), "yyyy-MM-dd"))
    return performance_metrics(with_day, label, pred, score, ["Date"])


def score_histogram(df: DataFrame, score: str = "FraudScore", label: str = "Fraud", bins: int = 20) -> DataFrame:
    """Equal-width histogram over [0, 1] split by true class; score 1.0 goes to the last bin."""
    s = clean_double(score)
    b = F.least(F.floor(s * F.lit(bins)).cast("int") + F.lit(1), F.lit(bins))
    return (
        df.where(s.isNotNull())
        .groupBy(b.alias("bin"), F.col(label).cast("int").alias("label"))
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("bin_start", (F.col("bin") - 1) / F.lit(float(bins)))
    )


def confusion_cells(df: DataFrame, label: str = "Fraud", pred: str = "FraudPrediction") -> DataFrame:
    """The four confusion cells with their share of all rows in percent."""
    c = confusion(df, label, pred)
    cells = F.array(
        F.struct(F.lit(0).alias("actual"), F.lit(0).alias("predicted"), F.col("true_negatives").alias("count")),
        F.struct(F.lit(0).alias("actual"), F.lit(1).alias("predicted"), F.col("false_positives").alias("count")),
        F.struct(F.lit(1).alias("actual"), F.lit(0).alias("predicted"), F.col("false_negatives").alias("count")),
        F.struct(F.lit(1).alias("actual"), F.lit(1).alias("predicted"), F.col("true_positives").alias("count")),
    )
    return c.select(F.explode(cells).alias("cell"), "sample_size").select(
        "cell.actual", "cell.predicted", "cell.count",
        (F.col("cell.count") * F.lit(100.0) / F.col("sample_size")).alias("pct"),
    )


def metrics_table(metric_row: DataFrame, decimals: int = 4) -> DataFrame:
    """Six display rows, values rounded to ``decimals``."""
    return metric_row.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(name).alias("metric"), F.round(F.col(key).cast("double"), decimals).alias("value"))
                  for name, key in TABLE_METRICS]
            )
        ).alias("kv")
    ).select("kv.metric", "kv.value")

"""Health rules, the label join, feedback join, top-k, union."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Health rules of the reference (metric, threshold, message prefix).
PERFORMANCE_RULES = [
    ("precision", 0.7, "Precision is below threshold"),
    ("recall", 0.7, "Recall is below threshold"),
    ("f1_score", 0.7, "F1 score is below threshold"),
    ("roc_auc", 0.8, "ROC AUC is below threshold"),
]
DRIFT_RULE = ("data_drift", 0.3, "Data drift detected")


def join_labels(predictions: DataFrame, transactions: DataFrame, id_col: str = "TransactionID",
                label: str = "Fraud") -> DataFrame:
    """Inner equi-join of predictions to their labels (only the label is carried).

    AQE picks broadcast or sort-merge from runtime sizes and splits skewed keys.
    """
    return predictions.join(transactions.select(id_col, label), id_col, "inner")


def health_alerts(metric_row: DataFrame, drift_summary: DataFrame | None = None) -> DataFrame:
    """H1: alert rows (type, metric, value, threshold, message)."""
    alerts = []
    for metric, thr, text in PERFORMANCE_RULES:
        v = F.col(metric).cast("double")
        alerts.append(
            F.when(
                v < F.lit(thr),
                F.struct(
                    F.lit("performance").alias("type"),
                    F.lit(metric).alias("metric"),
                    v.alias("value"),
                    F.lit(thr).alias("threshold"),
                    F.format_string(f"{text}: %.2f < {thr}", v).alias("message"),
                ),
            )
        )
    out = metric_row.select(F.explode(F.filter(F.array(*alerts), lambda a: a.isNotNull())).alias("a")).select("a.*")
    if drift_summary is not None:
        kind, thr, text = DRIFT_RULE
        v = F.col("overall_drift_score").cast("double")
        drift = drift_summary.where(F.col("overall_drift_detected")).select(
            F.lit(kind).alias("type"),
            F.lit(None).cast("string").alias("metric"),
            v.alias("value"),
            F.lit(thr).alias("threshold"),
            F.format_string(f"{text}: %.2f > {thr}", v).alias("message"),
        )
        out = out.unionByName(drift)
    return out


def health_status(alerts: DataFrame) -> DataFrame:
    """H1: 'degraded' if any alert, else 'healthy', with the alert count."""
    return alerts.agg(F.count(F.lit(1)).alias("alert_count")).select(
        "alert_count",
        F.when(F.col("alert_count") > 0, F.lit("degraded")).otherwise(F.lit("healthy")).alias("status"),
    )


def latest_feedback(feedback: DataFrame, id_col: str = "TransactionID", ts: str = "Timestamp") -> DataFrame:
    """J2 part 1: latest feedback per transaction.

    ``max_by`` is a mergeable aggregate, so a transaction with very many feedback rows
    is combined map-side instead of being ranked inside one window task.
    """
    others = [c for c in feedback.columns if c != id_col]
    return feedback.groupBy(id_col).agg(
        F.max_by(F.struct(*others), F.struct(*[F.col(ts)] + [F.col(c) for c in others if c != ts])).alias("_f")
    ).select(id_col, "_f.*")


def feedback_join(predictions: DataFrame, feedback: DataFrame, id_col: str = "TransactionID") -> DataFrame:
    """Predictions left-joined with the latest feedback for each."""
    return predictions.join(latest_feedback(feedback, id_col), id_col, "left")


def reviewed_precision(joined: DataFrame) -> DataFrame:
    """Among reviewed alerts, the share confirmed as fraud; review coverage."""
    reviewed = F.col("IsFraud").isNotNull()
    return joined.agg(
        F.count(F.lit(1)).alias("predictions"),
        F.count_if(reviewed).alias("reviewed"),
        F.count_if(reviewed & (F.col("FraudPrediction") == 1)).alias("reviewed_alerts"),
        F.count_if(reviewed & (F.col("FraudPrediction") == 1) & F.col("IsFraud")).alias("confirmed_alerts"),
    ).withColumn(
        "reviewed_precision", F.try_divide(F.col("confirmed_alerts").cast("double"), F.col("reviewed_alerts").cast("double"))
    )


def top_k(df: DataFrame, k: int = 10, score: str = "FraudScore", id_col: str = "TransactionID") -> DataFrame:
    """K1: k highest scores; the id breaks ties. Planned as TakeOrderedAndProject
    (each partition keeps its own k, then one merge)."""
    return df.orderBy(F.desc_nulls_last(score), F.asc(id_col)).limit(k)


def append_feedback(old: DataFrame, new: DataFrame) -> DataFrame:
    """Concatenate old and new feedback by column name."""
    return old.unionByName(new, allowMissingColumns=True)

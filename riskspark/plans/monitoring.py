"""H2: the monitoring report (C10 -> J1 -> V8 + D1-D6 + H1 + V14), one cached input.

The report is a set of small DataFrames (metric rows, drift rows, alerts, counts) plus
a one-row JSON document written with the JSON sink (IO11).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators import clean, drift, health, metrics
from riskspark.session import ensure_checkpoint_dir
from riskspark.sources import io


@dataclass
class Report:
    metrics: DataFrame  # one row, REPORT_METRICS
    metrics_long: DataFrame  # (metric, value)
    drift: DataFrame  # (feature, ks_statistic, p_value, drift_detected)
    drift_summary: DataFrame
    alerts: DataFrame
    status: DataFrame
    counts: DataFrame  # predictions_count, feedback_count


def generate_report(predictions: DataFrame, transactions: DataFrame, reference: DataFrame, feedback: DataFrame,
                    as_of: str, days: int = 7, drift_features=None) -> Report:
    recent = health.join_labels(clean.lookback(predictions, as_of, days), transactions)
    # the one input every part of the report reads: cut once into the checkpoint folder
    # (cleaned with the DataFrame, unlike a cache left behind)
    ensure_checkpoint_dir(recent.sparkSession)
    recent = recent.checkpoint(eager=True)
    m = metrics.performance_metrics(recent)
    current = clean.drop_if_present(recent)
    feats = drift_features or drift.shared_numeric_columns(reference, current)
    d = drift.ks_drift(reference, current, feats)
    ds = drift.drift_summary(d)
    alerts = health.health_alerts(m, ds)
    status = health.health_status(alerts)
    fb_count = feedback.agg(F.count(F.lit(1))).scalar()
    counts = recent.agg(F.count(F.lit(1)).alias("predictions_count")).select("predictions_count", fb_count.alias("feedback_count"))
    return Report(m, metrics.metrics_long(m), d, ds, alerts, status, counts)


def save_reference(df: DataFrame, features, base: str, version: str) -> None:
    """The drift reference of a dataset version: the value counts of its features, published under ``base``."""
    counts = drift.value_counts_of(df, features).withColumn("version", F.lit(version))
    io.publish(df.sparkSession, base, version, lambda: counts.write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("version").parquet(base))


def load_reference(spark, base: str) -> DataFrame:
    """The newest published drift reference (feature, value, cnt)."""
    versions = io.list_versions(spark, base)
    if not versions:
        raise FileNotFoundError(f"no drift reference under {base}")
    return spark.read.parquet(base).where(F.col("version") == versions[-1]).drop("version")


def report_document(r: Report, as_of: str, days: int) -> DataFrame:
    """The whole report as one row (period, metrics, drift, alerts, status, counts)."""
    spark = r.metrics.sparkSession
    doc = r.metrics.select(F.struct("*").alias("metrics"))
    drift_rows = r.drift.agg(F.collect_list(F.struct("*")).alias("drift_results")).scalar()
    summary = r.drift_summary.select(F.struct("*")).scalar()
    alerts = r.alerts.agg(F.collect_list(F.struct("*")).alias("a")).scalar()
    status = r.status.select("status").scalar()
    counts = r.counts.select(F.struct("*")).scalar()
    del spark
    return doc.select(
        F.lit(as_of).alias("as_of"),
        F.lit(f"Last {days} days").alias("period"),
        "metrics",
        drift_rows.alias("drift_results"),
        summary.alias("drift_summary"),
        alerts.alias("alerts"),
        status.alias("status"),
        counts.alias("counts"),
    )


def write_report(r: Report, path: str, as_of: str, days: int) -> None:
    """IO11: report JSON (the drift and alert lists are bounded by features and rules)."""
    io.write_report_json(report_document(r, as_of, days), path)

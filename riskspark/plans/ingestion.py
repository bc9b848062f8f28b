"""The ingestion run: IO1-IO3, C1-C4, IO13, P1, P2 and IO7 as one job.

CSV read (names normalised, dates parsed leniently) -> fill and de-duplicate -> label check ->
load profile -> stratified split -> one version of the dataset, partitioned by split. The cleaned
table is checkpointed once; the label check, the profile and the split all read it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskspark.operators import clean, split
from riskspark.plans import monitoring
from riskspark.session import ensure_checkpoint_dir
from riskspark.sources import io


@dataclass
class Ingested:
    version: str
    profile: DataFrame  # total_rows, fraud_rows, fraud_pct of the cleaned rows
    audit: DataFrame  # rows, positives and ratio per split of the written version


def run_ingestion(spark: SparkSession, csv_path: str, base: str, version: str, schema: T.StructType | None = None,
                  label: str = "Fraud", key: str = "TransactionID", seed: int = 42, reference_base: str | None = None) -> Ingested:
    """Ingest ``csv_path`` as ``version`` of the dataset under ``base``.

    ``schema`` has the column names of the file; without it they are inferred (one more scan). With ``reference_base`` the value
    counts of the train split's numeric columns are kept there as this version's drift reference.
    """
    ensure_checkpoint_dir(spark)
    raw = io.read_transactions_csv(spark, csv_path, schema)
    cleaned = clean.validate_labels(clean.clean_data(raw, label).checkpoint(eager=True), label)
    io.write_versioned(split.stratified_split(cleaned, label, key, seed), base, version)
    written = spark.read.parquet(base).where(f"version = '{version}'")
    if reference_base:
        train = clean.drop_id_by_rule(written.where("split = 'train'").drop(label, "version", "split"))
        monitoring.save_reference(train, clean.column_kinds(train)[0], reference_base, version)
    return Ingested(version, clean.load_profile(cleaned, label), split.split_audit(written, label))

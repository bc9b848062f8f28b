"""Proxy views over the driver tables.

The driver tables hold no fraud data, so the operators run over these views:

* T (batch): orders + customer + nation, PreviousTransactionDate derived by W1.
* E (event time): events, one transaction per event.
* P (predictions): E plus three synthetic model scores fused by S2-S4.
* R / C: E before / from the drift split date.

Timestamps stay TIMESTAMP_NTZ, so wall-clock features do not depend on the session
time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.nulls import flag_int
from riskspark.sources.previous import previous_in_order
from riskspark.sources.tables import read_table

# Fixed values of the proxy definitions.
DRIFT_SPLIT = "2024-01-16 00:00:00"
PROXY_WEIGHTS = {"random_forest": 0.3, "xgboost": 0.5, "isolation_forest": 0.2}
PROXY_THRESHOLD = 0.5
NATION_ROWS = 25  # TPC-H nation is a fixed 25-row dimension: safe to broadcast


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View T."""
    orders = read_table(
        spark, sf_dir, "orders",
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    )
    orders = previous_in_order(orders, "o_custkey", "o_orderdate", "o_orderkey", "_prev_date")
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner").join(
        F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "inner"
    )
    return joined.select(
        F.col("o_orderkey").cast("string").alias("TransactionID"),
        F.col("o_custkey").cast("string").alias("AccountID"),
        F.col("o_totalprice").cast("double").alias("TransactionAmount"),
        F.col("o_orderdate").alias("TransactionDate"),
        F.col("_prev_date").alias("PreviousTransactionDate"),
        F.col("c_acctbal").cast("double").alias("AccountBalance"),
        F.col("c_mktsegment").alias("CustomerOccupation"),
        F.col("o_orderpriority").alias("Channel"),
        F.col("n_name").alias("Location"),
        flag_int(F.col("o_orderstatus") == "F").alias("Fraud"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View E."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    ev = previous_in_order(ev, "user_id", "ts", "event_id", "_prev_ts")
    return ev.select(
        F.col("event_id").cast("string").alias("TransactionID"),
        F.col("user_id").cast("string").alias("AccountID"),
        F.col("value").cast("double").alias("TransactionAmount"),
        F.col("ts").alias("TransactionDate"),
        F.col("_prev_ts").alias("PreviousTransactionDate"),
        F.col("event_type").alias("Channel"),
        (F.get_json_object("props", "$.k").try_cast("int") % 5).alias("LoginAttempts"),
        flag_int(F.col("event_type") == "error").alias("Fraud"),
    )


def raw_model_scores(e: DataFrame) -> DataFrame:
    """Synthetic per-model scores on E: forest, boosted trees, raw anomaly (higher = riskier)."""
    v = F.col("TransactionAmount")
    return e.withColumns(
        {
            "rf_score": v / (v + F.lit(50.0)),
            "xgb_score": v / (v + F.lit(100.0)),
            "iso_raw": F.log(F.lit(1.0) + v),
        }
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View P: predictions table as the scoring job writes it (no label column)."""
    from riskspark.operators.fusion import fuse_scores, minmax_batch

    scored = raw_model_scores(events(spark, sf_dir).drop("Fraud"))
    scored = minmax_batch(scored, "iso_raw", "iso_score")
    return fuse_scores(
        scored,
        {"random_forest": "rf_score", "xgboost": "xgb_score", "isolation_forest": "iso_score"},
        PROXY_WEIGHTS,
        PROXY_THRESHOLD,
        id_col="TransactionID",
        ts_col="TransactionDate",
    )


def reference_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View R: E before the drift split date."""
    return events(spark, sf_dir).where(F.col("TransactionDate") < F.lit(DRIFT_SPLIT).cast("timestamp_ntz"))


def current_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View C: E from the drift split date on."""
    return events(spark, sf_dir).where(F.col("TransactionDate") >= F.lit(DRIFT_SPLIT).cast("timestamp_ntz"))


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feedback proxy: each click or view reviews the same user's previous event.

    IsFraud = the review is a 'view'; Feedback = the event type; Timestamp = review time.
    """
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    ev = previous_in_order(ev, "user_id", "ts", "event_id", "_prev_id", value="event_id")
    return ev.where(F.col("event_type").isin("click", "view") & F.col("_prev_id").isNotNull()).select(
        F.col("_prev_id").cast("string").alias("TransactionID"),
        (F.col("event_type") == "view").alias("IsFraud"),
        F.col("event_type").alias("Feedback"),
        F.col("ts").alias("Timestamp"),
    )

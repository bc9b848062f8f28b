"""Query catalog: every operator of SURVEY 2 as a (Spark query, DuckDB oracle) pair.

Each Spark query takes (spark, sf_dir), reads the driver tables through the proxy
views and returns a DataFrame whose columns are made portable (doubles rounded to 6
places, timestamps as microsecond text, integers as longs). The oracle SQL computes
the same columns in DuckDB over the same tables. Queries with no SQL equivalent
(file formats, models, streams) are registered with ``sql=None``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators import clean, drift, features, fusion, health, metrics, split, transformers
from riskspark.plans.sqltext import big, r6, us, with_views
from riskspark.session import ensure_checkpoint_dir
from riskspark.sources import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2024-01-30"
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
LOOKBACK_DAYS = 7
DRIFT_FEATURES = ["TransactionAmount", "LoginAttempts", "TransactionHour"]


def portable(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.date_format(c.cast("timestamp_ntz"), TS_TEXT).alias(f.name))
        elif isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            out.append(F.round(c.cast("double"), 6).alias(f.name))
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            out.append(c.cast("long").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def labeled_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 over the proxies: P joined with E's label."""
    return health.join_labels(views.predictions(spark, sf_dir), views.events(spark, sf_dir))


# ---------------------------------------------------------------- views and sources

T_COLS = ("TransactionID, AccountID, {amt} AS TransactionAmount, {d} AS TransactionDate, {p} AS PreviousTransactionDate, "
          "{bal} AS AccountBalance, CustomerOccupation, Channel, Location, {fr} AS Fraud").format(
    amt=r6("TransactionAmount"), d=us("TransactionDate"), p=us("PreviousTransactionDate"), bal=r6("AccountBalance"),
    fr=big("Fraud"))


@register("io4_scan_transactions", with_views("T") + f"SELECT {T_COLS} FROM T")
def io4_scan_transactions(spark, sf_dir):
    """IO4 + W1: full scan of view T with the derived previous transaction date."""
    return views.transactions(spark, sf_dir)


E_COLS = ("TransactionID, AccountID, {amt} AS TransactionAmount, {d} AS TransactionDate, {p} AS PreviousTransactionDate, "
          "Channel, {la} AS LoginAttempts, {fr} AS Fraud").format(
    amt=r6("TransactionAmount"), d=us("TransactionDate"), p=us("PreviousTransactionDate"), la=big("LoginAttempts"),
    fr=big("Fraud"))


@register("io4_scan_events", with_views("E") + f"SELECT {E_COLS} FROM E")
def io4_scan_events(spark, sf_dir):
    """IO4 + W1: full scan of view E."""
    return views.events(spark, sf_dir)


@register("w1_previous_transaction",
          with_views("E") + f"SELECT TransactionID, AccountID, {us('PreviousTransactionDate')} AS PreviousTransactionDate FROM E")
def w1_previous_transaction(spark, sf_dir):
    """Previous transaction time per account (skew-safe lag)."""
    return views.events(spark, sf_dir).select("TransactionID", "AccountID", "PreviousTransactionDate")


@register("io2_normalize_names",
          with_views("E") + f"SELECT TransactionID AS Transaction_ID, {r6('TransactionAmount')} AS Transaction_Amount, "
          "Channel AS Channel_Name FROM E")
def io2_normalize_names(spark, sf_dir):
    """IO2: spaces and dots in names become underscores."""
    e = views.events(spark, sf_dir).select(
        F.col("TransactionID").alias("Transaction ID"),
        F.col("TransactionAmount").alias("Transaction.Amount"),
        F.col("Channel").alias("Channel Name"),
    )
    return clean.normalize_column_names(e)


@register("io3_lenient_dates",
          with_views("E") + "SELECT TransactionID, "
          + us("TRY_CAST(CASE WHEN Fraud = 1 THEN 'not a date' ELSE CAST(TransactionDate AS VARCHAR) END AS TIMESTAMP)")
          + " AS TransactionDate FROM E")
def io3_lenient_dates(spark, sf_dir):
    """IO3: dates held as text; unparseable text (error events carry junk) becomes null."""
    e = views.events(spark, sf_dir)
    text = F.when(F.col("Fraud") == 1, F.lit("not a date")).otherwise(F.col("TransactionDate").cast("string"))
    return clean.parse_dates_lenient(e.select("TransactionID", text.alias("TransactionDate")), ["TransactionDate"])


@register("io6_fraud_view",
          with_views("T") + f"SELECT TransactionID, AccountID, {r6('TransactionAmount')} AS TransactionAmount, Channel "
          "FROM T WHERE Fraud = 1")
def io6_fraud_view(spark, sf_dir):
    """IO6: the fraud_transactions view."""
    t = views.transactions(spark, sf_dir)
    t.where(F.col("Fraud") == 1).createOrReplaceTempView("fraud_transactions")
    return spark.table("fraud_transactions").select("TransactionID", "AccountID", "TransactionAmount", "Channel")


@register("io6_legitimate_view",
          with_views("T") + f"SELECT TransactionID, AccountID, {r6('TransactionAmount')} AS TransactionAmount, Channel "
          "FROM T WHERE Fraud = 0")
def io6_legitimate_view(spark, sf_dir):
    """IO6: the legitimate_transactions view."""
    t = views.transactions(spark, sf_dir)
    t.where(F.col("Fraud") == 0).createOrReplaceTempView("legitimate_transactions")
    return spark.table("legitimate_transactions").select("TransactionID", "AccountID", "TransactionAmount", "Channel")


@register("io13_load_profile",
          with_views("T") + "SELECT count(*) AS total_rows, count(*) FILTER (WHERE Fraud = 1) AS fraud_rows, "
          + r6("avg(Fraud) * 100.0") + " AS fraud_pct FROM T")
def io13_load_profile(spark, sf_dir):
    """IO13: rows, fraud rows and fraud percentage."""
    return clean.load_profile(views.transactions(spark, sf_dir))


# ---------------------------------------------------------------- cleaning

_C1_SRC = ("SELECT TransactionID, CASE WHEN CAST(TransactionID AS BIGINT) % 7 = 0 THEN NULL ELSE Location END AS Location, "
           "CASE WHEN CAST(TransactionID AS BIGINT) % 5 = 0 THEN NULL ELSE Channel END AS Channel, "
           "CAST(NULL AS VARCHAR) AS Memo FROM T")
_MODE = "(SELECT {c} FROM S WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@register("c1_fill_text_mode",
          with_views("T", extra=f"S AS ({_C1_SRC})")
          + "SELECT TransactionID, coalesce(Location, " + _MODE.format(c="Location") + ") AS Location, "
          + "coalesce(Channel, " + _MODE.format(c="Channel") + ") AS Channel, "
          + "coalesce(Memo, " + _MODE.format(c="Memo") + ", 'Unknown') AS Memo FROM S")
def c1_fill_text_mode(spark, sf_dir):
    """Text nulls filled with the column mode (ties -> smallest; all-null -> 'Unknown')."""
    t = views.transactions(spark, sf_dir)
    key = F.col("TransactionID").cast("long")
    src = t.select(
        "TransactionID",
        F.when(key % 7 == 0, F.lit(None)).otherwise(F.col("Location")).alias("Location"),
        F.when(key % 5 == 0, F.lit(None)).otherwise(F.col("Channel")).alias("Channel"),
        F.lit(None).cast("string").alias("Memo"),
    )
    return clean.fill_missing(src, label=None)


_C2_SRC = ("SELECT TransactionID, CASE WHEN CAST(TransactionID AS BIGINT) % 11 = 0 THEN NULL ELSE AccountBalance END AS AccountBalance, "
           "CASE WHEN CAST(TransactionID AS BIGINT) % 13 = 0 THEN NULL ELSE TransactionAmount END AS TransactionAmount, Fraud FROM T")


@register("c2_fill_numeric_median",
          with_views("T", extra=f"S AS ({_C2_SRC})")
          + "SELECT TransactionID, " + r6("coalesce(AccountBalance, (SELECT median(AccountBalance) FROM S))") + " AS AccountBalance, "
          + r6("coalesce(TransactionAmount, (SELECT median(TransactionAmount) FROM S))") + " AS TransactionAmount, "
          + big("Fraud") + " AS Fraud FROM S")
def c2_fill_numeric_median(spark, sf_dir):
    """Numeric nulls filled with the exact median (label untouched)."""
    t = views.transactions(spark, sf_dir)
    key = F.col("TransactionID").cast("long")
    src = t.select(
        "TransactionID",
        F.when(key % 11 == 0, F.lit(None)).otherwise(F.col("AccountBalance")).alias("AccountBalance"),
        F.when(key % 13 == 0, F.lit(None)).otherwise(F.col("TransactionAmount")).alias("TransactionAmount"),
        "Fraud",
    )
    return clean.fill_missing(src, label="Fraud")


@register("c3_deduplicate",
          with_views("T") + "SELECT DISTINCT CustomerOccupation, Channel, Location, " + big("Fraud") + " AS Fraud FROM T")
def c3_deduplicate(spark, sf_dir):
    """clean_data (fill, then whole-row de-duplication) on a low-cardinality projection."""
    t = views.transactions(spark, sf_dir).select("CustomerOccupation", "Channel", "Location", "Fraud")
    return clean.clean_data(t, label="Fraud")


@register("c4_label_profile",
          with_views("T") + "SELECT " + big("Fraud") + " AS label, count(*) AS count, "
          + r6("count(*) * 1.0 / (SELECT count(*) FROM T)") + " AS ratio FROM T GROUP BY Fraud")
def c4_label_profile(spark, sf_dir):
    """C4: validated labels, their counts and ratios."""
    t = clean.validate_labels(views.transactions(spark, sf_dir))
    return clean.label_profile(t)


_NO_ID = ("{amt} AS TransactionAmount, {d} AS TransactionDate, {p} AS PreviousTransactionDate, {bal} AS AccountBalance, "
          "CustomerOccupation, Channel, Location, {fr} AS Fraud").format(
    amt=r6("TransactionAmount"), d=us("TransactionDate"), p=us("PreviousTransactionDate"), bal=r6("AccountBalance"),
    fr=big("Fraud"))


@register("c5_drop_id_columns", with_views("T") + f"SELECT {_NO_ID} FROM T")
def c5_drop_id_columns(spark, sf_dir):
    """Drop the fixed identifier list."""
    return clean.drop_id_columns(views.transactions(spark, sf_dir))


@register("c6_drop_id_by_rule", with_views("T") + f"SELECT {_NO_ID} FROM T")
def c6_drop_id_by_rule(spark, sf_dir):
    """Drop columns whose name contains ID/Id/id."""
    return clean.drop_id_by_rule(views.transactions(spark, sf_dir))


@register("c8_drop_non_feature",
          with_views("P") + "SELECT TransactionID, AccountID, " + r6("TransactionAmount") + " AS TransactionAmount, "
          + us("TransactionDate") + " AS TransactionDate, " + us("PreviousTransactionDate") + " AS PreviousTransactionDate, "
          "Channel, " + big("LoginAttempts") + " AS LoginAttempts, " + r6("rf_score") + " AS rf_score, "
          + r6("xgb_score") + " AS xgb_score, " + r6("iso_raw") + " AS iso_raw, " + r6("iso_score") + " AS iso_score FROM P")
def c8_drop_non_feature(spark, sf_dir):
    """Prediction columns removed before drift checks (score map left out of the comparison)."""
    return clean.drop_if_present(views.predictions(spark, sf_dir)).drop("ModelScores")


@register("c9_display_columns",
          with_views("P") + "SELECT TransactionID, AccountID, " + r6("TransactionAmount") + " AS TransactionAmount, "
          + us("TransactionDate") + " AS TransactionDate, Channel, " + r6("FraudScore") + " AS FraudScore, "
          + big("FraudPrediction") + " AS FraudPrediction FROM P")
def c9_display_columns(spark, sf_dir):
    """The display columns that exist."""
    return clean.select_existing(views.predictions(spark, sf_dir))


@register("c10_lookback",
          with_views("P") + "SELECT TransactionID, " + r6("FraudScore") + " AS FraudScore, " + us("Timestamp")
          + f" AS Timestamp FROM P WHERE Timestamp >= CAST(DATE '{AS_OF}' - INTERVAL {LOOKBACK_DAYS} DAY AS TIMESTAMP)")
def c10_lookback(spark, sf_dir):
    """Predictions from midnight LOOKBACK_DAYS before AS_OF."""
    p = clean.lookback(views.predictions(spark, sf_dir), AS_OF, LOOKBACK_DAYS)
    return p.select("TransactionID", "FraudScore", "Timestamp")


# ---------------------------------------------------------------- features

_GAP = "CAST(epoch_us(TransactionDate) - epoch_us(PreviousTransactionDate) AS DOUBLE) / 3600000000.0"
_PERIOD = ("CASE WHEN hour(TransactionDate) > 0 AND hour(TransactionDate) <= 6 THEN 'Night' "
           "WHEN hour(TransactionDate) > 6 AND hour(TransactionDate) <= 12 THEN 'Morning' "
           "WHEN hour(TransactionDate) > 12 AND hour(TransactionDate) <= 18 THEN 'Afternoon' "
           "WHEN hour(TransactionDate) > 18 AND hour(TransactionDate) <= 24 THEN 'Evening' END")


def _gap_ctes(src: str, stats_src: str | None = None) -> list[str]:
    stats_src = stats_src or src
    return [
        f"G AS (SELECT *, {_GAP} AS gap FROM {src})",
        f"GS AS (SELECT *, {_GAP} AS gap FROM {stats_src})",
        "GM AS (SELECT median(gap) AS med FROM GS)",
        "GF AS (SELECT *, coalesce(CASE WHEN gap IS NULL THEN NULL ELSE greatest(gap, 0.0) END, (SELECT med FROM GM)) AS filled FROM G)",
        "GFS AS (SELECT coalesce(CASE WHEN gap IS NULL THEN NULL ELSE greatest(gap, 0.0) END, (SELECT med FROM GM)) AS filled FROM GS)",
        "GT AS (SELECT avg(filled) + 2 * stddev_samp(filled) AS lim FROM GFS)",
    ]


@register("f1_f7_time_features",
          with_views("E", extra=_gap_ctes("E"))
          + "SELECT TransactionID, " + r6("TransactionAmount") + " AS TransactionAmount, Channel, "
          + big("LoginAttempts") + " AS LoginAttempts, " + big("Fraud") + " AS Fraud, "
          + big("hour(TransactionDate)") + " AS TransactionHour, " + big("isodow(TransactionDate) - 1")
          + " AS TransactionDayOfWeek, " + big("month(TransactionDate)") + " AS TransactionMonth, "
          + big("CASE WHEN isodow(TransactionDate) IN (6, 7) THEN 1 ELSE 0 END") + " AS IsWeekend, "
          + _PERIOD + " AS TimePeriod, " + r6("filled") + " AS HoursSincePreviousTransaction, "
          + big("CASE WHEN filled > (SELECT lim FROM GT) THEN 1 ELSE 0 END") + " AS UnusualTransactionTiming, "
          + big("CASE WHEN LoginAttempts > 1 THEN 1 ELSE 0 END") + " AS HighLoginAttempts FROM GF")
def f1_f7_time_features(spark, sf_dir):
    """F1-F7, F10, F11 in reference (batch-statistics) mode over E."""
    return features.batch_features(views.events(spark, sf_dir))


@register("f8_f9_amount_features",
          with_views("T", extra=_gap_ctes("T"))
          + "SELECT TransactionID, "
          + r6("coalesce(TransactionAmount / nullif(AccountBalance, 0.0), 0.0)") + " AS TransactionToBalanceRatio, "
          + big("CASE WHEN TransactionAmount > (SELECT quantile_cont(TransactionAmount, 0.9) FROM T) THEN 1 ELSE 0 END")
          + " AS HighValueTransaction, " + _PERIOD + " AS TimePeriod, "
          + r6("filled") + " AS HoursSincePreviousTransaction, "
          + big("CASE WHEN filled > (SELECT lim FROM GT) THEN 1 ELSE 0 END") + " AS UnusualTransactionTiming FROM GF")
def f8_f9_amount_features(spark, sf_dir):
    """F8, F9 (and F5 at midnight, F6, F7) in batch mode over T."""
    out = features.batch_features(views.transactions(spark, sf_dir))
    return out.select("TransactionID", "TransactionToBalanceRatio", "HighValueTransaction", "TimePeriod",
                      "HoursSincePreviousTransaction", "UnusualTransactionTiming")


@register("f6_f7_fitted_features",
          with_views("R", "C", extra=_gap_ctes("C", "R"))
          + "SELECT TransactionID, " + r6("filled") + " AS HoursSincePreviousTransaction, "
          + big("CASE WHEN filled > (SELECT lim FROM GT) THEN 1 ELSE 0 END") + " AS UnusualTransactionTiming FROM GF")
def f6_f7_fitted_features(spark, sf_dir):
    """F6/F7 fitted on R, applied to C (statistics stored by fit)."""
    model = features.TransactionFeatures(keep=("TransactionID",)).fit(views.reference_window(spark, sf_dir))
    out = model.transform(views.current_window(spark, sf_dir))
    return out.select("TransactionID", "HoursSincePreviousTransaction", "UnusualTransactionTiming")


# ---------------------------------------------------------------- fitted preprocessing

def _x_sql() -> str:
    ctes = [
        "RM AS (SELECT median(TransactionAmount) AS m_amt, median(LoginAttempts) AS m_la FROM R)",
        "RC AS (SELECT Channel AS mode_ch FROM R WHERE Channel IS NOT NULL GROUP BY Channel ORDER BY count(*) DESC, Channel LIMIT 1)",
        "RI AS (SELECT coalesce(TransactionAmount, (SELECT m_amt FROM RM)) AS a, coalesce(CAST(LoginAttempts AS DOUBLE), (SELECT m_la FROM RM)) AS l FROM R)",
        "RS AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(l) AS ml, stddev_pop(l) AS sl FROM RI)",
        "CI AS (SELECT TransactionID, coalesce(TransactionAmount, (SELECT m_amt FROM RM)) AS a, "
        "coalesce(CAST(LoginAttempts AS DOUBLE), (SELECT m_la FROM RM)) AS l, coalesce(Channel, (SELECT mode_ch FROM RC)) AS ch FROM C)",
    ]
    cats = ["click", "error", "purchase", "signup", "view"]
    onehot = ", ".join(f"{r6(f'CASE WHEN ch = {chr(39)}{v}{chr(39)} THEN 1.0 ELSE 0.0 END')} AS Channel_{v}" for v in cats)
    return (with_views("R", "C", extra=ctes) + "SELECT TransactionID, "
            + r6("(a - (SELECT ma FROM RS)) / CASE WHEN (SELECT sa FROM RS) = 0 THEN 1.0 ELSE (SELECT sa FROM RS) END")
            + " AS TransactionAmount, "
            + r6("(l - (SELECT ml FROM RS)) / CASE WHEN (SELECT sl FROM RS) = 0 THEN 1.0 ELSE (SELECT sl FROM RS) END")
            + " AS LoginAttempts, " + onehot + " FROM CI")


@register("x1_x4_preprocess", _x_sql())
def x1_x4_preprocess(spark, sf_dir):
    """median/mode imputation, population scaling and one-hot, fitted on R, applied to C."""
    model = transformers.Preprocessor(["TransactionAmount", "LoginAttempts"], ["Channel"]).fit(
        views.reference_window(spark, sf_dir)
    )
    return model.transform(views.current_window(spark, sf_dir), keep=["TransactionID"])


# ---------------------------------------------------------------- splits and sampling

def _alloc_sql() -> list[str]:
    """Two-stage stratified allocation (largest remainder, ties to the lower label) in SQL."""
    return [
        "K AS (SELECT Fraud AS label, count(*) AS c FROM T GROUP BY Fraud)",
        "N AS (SELECT sum(c) AS n, CAST(ceil(0.3 * sum(c)) AS BIGINT) AS n_temp FROM K)",
        "A1 AS (SELECT label, c, c * ((SELECT n FROM N) - (SELECT n_temp FROM N)) / (SELECT n FROM N) AS cont FROM K)",
        "A2 AS (SELECT *, floor(cont) AS fl, cont - floor(cont) AS rem FROM A1)",
        "A3 AS (SELECT *, row_number() OVER (ORDER BY rem DESC, label) AS rk, "
        "(SELECT n FROM N) - (SELECT n_temp FROM N) - (SELECT sum(fl) FROM A2) AS need FROM A2)",
        "TR AS (SELECT label, c, CAST(fl + CASE WHEN rk <= need THEN 1 ELSE 0 END AS BIGINT) AS n_train FROM A3)",
        "N2 AS (SELECT n_temp, CAST(ceil(0.67 * n_temp) AS BIGINT) AS n_test FROM N)",
        "B1 AS (SELECT label, n_train, c - n_train AS rest, (c - n_train) * ((SELECT n_temp FROM N2) - (SELECT n_test FROM N2)) "
        "/ (SELECT n_temp FROM N2) AS cont FROM TR)",
        "B2 AS (SELECT *, floor(cont) AS fl, cont - floor(cont) AS rem FROM B1)",
        "B3 AS (SELECT *, row_number() OVER (ORDER BY rem DESC, label) AS rk, "
        "(SELECT n_temp FROM N2) - (SELECT n_test FROM N2) - (SELECT sum(fl) FROM B2) AS need FROM B2)",
        "AL AS (SELECT label, n_train, CAST(fl + CASE WHEN rk <= need THEN 1 ELSE 0 END AS BIGINT) AS n_val FROM B3)",
        "RK AS (SELECT TransactionID, Fraud, row_number() OVER (PARTITION BY Fraud ORDER BY md5('42:' || TransactionID), "
        "TransactionID) AS rnk FROM T)",
        "SP AS (SELECT TransactionID, Fraud, CASE WHEN rnk <= n_train THEN 'train' WHEN rnk <= n_train + n_val THEN 'val' "
        "ELSE 'test' END AS split FROM RK JOIN AL ON RK.Fraud = AL.label)",
    ]


@register("p1_stratified_split", with_views("T", extra=_alloc_sql()) + "SELECT TransactionID, " + big("Fraud")
          + " AS Fraud, split FROM SP")
def p1_stratified_split(spark, sf_dir):
    """Repeatable exact stratified train/val/test split of T."""
    return split.stratified_split(views.transactions(spark, sf_dir)).select("TransactionID", "Fraud", "split")


@register("p2_split_audit", with_views("T", extra=_alloc_sql())
          + "SELECT split, count(*) AS rows, " + big("sum(Fraud)") + " AS positives, " + r6("avg(Fraud)")
          + " AS ratio FROM SP GROUP BY split")
def p2_split_audit(spark, sf_dir):
    """Rows, positives and ratio per split."""
    return split.split_audit(split.stratified_split(views.transactions(spark, sf_dir)))


@register("p7_class_check", with_views("T", extra=_alloc_sql())
          + "SELECT split, count(DISTINCT Fraud) AS n_classes FROM SP GROUP BY split")
def p7_class_check(spark, sf_dir):
    """Number of classes in each split (a one-class split raises in training)."""
    return split.class_check(split.stratified_split(views.transactions(spark, sf_dir)))


@register("p3_hash_sample",
          with_views("T") + "SELECT TransactionID FROM (SELECT TransactionID, row_number() OVER "
          "(ORDER BY md5('42:' || TransactionID), TransactionID) AS rnk FROM T) WHERE rnk <= CAST(floor(0.02 * "
          "(SELECT count(*) FROM T)) AS BIGINT)")
def p3_hash_sample(spark, sf_dir):
    """Exact-size 2% sample without replacement (seed 42)."""
    return split.hash_sample(views.transactions(spark, sf_dir)).select("TransactionID")


@register("p5_class_distribution",
          with_views("T") + "SELECT " + big("Fraud") + " AS label, count(*) AS count FROM T GROUP BY Fraud")
def p5_class_distribution(spark, sf_dir):
    """P5: rows per class."""
    return split.class_distribution(views.transactions(spark, sf_dir))


@register("p6_class_weights",
          with_views("T", extra="W AS (SELECT count(*) AS n, count(*) FILTER (WHERE Fraud = 0) AS n_neg, "
                     "count(*) FILTER (WHERE Fraud = 1) AS n_pos FROM T)")
          + "SELECT n, n_neg, n_pos, " + r6("n / (2.0 * n_neg)") + " AS weight_neg, " + r6("n / (2.0 * n_pos)")
          + " AS weight_pos, " + r6("n_neg / n_pos") + " AS scale_pos_weight FROM W")
def p6_class_weights(spark, sf_dir):
    """Balanced class weights and the negative/positive ratio."""
    return split.class_weights(views.transactions(spark, sf_dir))


# ---------------------------------------------------------------- fusion

@register("s1_s2_anomaly_normalize",
          with_views("E", extra=["Q0 AS (SELECT TransactionID, -(-ln(1.0 + TransactionAmount)) AS iso_flipped FROM E)"])
          + "SELECT TransactionID, " + r6("iso_flipped") + " AS iso_flipped, "
          + r6("(iso_flipped - (SELECT min(iso_flipped) FROM Q0)) / ((SELECT max(iso_flipped) FROM Q0) - "
               "(SELECT min(iso_flipped) FROM Q0))") + " AS iso_score FROM Q0")
def s1_s2_anomaly_normalize(spark, sf_dir):
    """S1 + S2: negate a decision function (higher = riskier), then batch min-max to [0, 1]."""
    e = views.events(spark, sf_dir)
    dec = e.select("TransactionID", (-F.log(F.lit(1.0) + F.col("TransactionAmount"))).alias("decision"))
    flipped = fusion.flip_anomaly(dec, "decision", "iso_flipped")
    return fusion.minmax_batch(flipped, "iso_flipped", "iso_score").select("TransactionID", "iso_flipped", "iso_score")


@register("s3_s5_fused_predictions",
          with_views("P") + "SELECT TransactionID, " + r6("FraudScore") + " AS FraudScore, " + big("FraudPrediction")
          + " AS FraudPrediction, " + r6("rf_score") + " AS score_random_forest, " + r6("xgb_score")
          + " AS score_xgboost, " + r6("iso_score") + " AS score_isolation_forest, " + us("Timestamp")
          + " AS Timestamp FROM P")
def s3_s5_fused_predictions(spark, sf_dir):
    """Weighted score, strict threshold decision, per-model score map, timestamp."""
    p = views.predictions(spark, sf_dir)
    return p.select(
        "TransactionID", "FraudScore", "FraudPrediction",
        F.col("ModelScores")["random_forest"].alias("score_random_forest"),
        F.col("ModelScores")["xgboost"].alias("score_xgboost"),
        F.col("ModelScores")["isolation_forest"].alias("score_isolation_forest"),
        "Timestamp",
    )


def _auc_sql(src: str, score: str, label: str, group: str | None = None) -> str:
    """Exact AUC with ties (Mann-Whitney) per group, as a SELECT over ``src``."""
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return (
        f"SELECT {g}CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (nb + neg / 2.0)) / (sum(pos) * sum(neg)) END AS roc_auc "
        f"FROM (SELECT {g}s, pos, neg, coalesce(sum(neg) OVER ({part}ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb "
        f"FROM (SELECT {g}{score} AS s, sum({label}) AS pos, sum(1 - {label}) AS neg FROM {src} WHERE {score} IS NOT NULL "
        f"GROUP BY {g}{score}))" + (f" GROUP BY {group}" if group else "")
    )


def _grid_values() -> str:
    return ", ".join(f"({g}, {a!r}, {b!r}, {c!r})" for g, a, b, c in fusion.weight_grid())


@register("s6_weight_search",
          with_views("L", extra=[
              f"GRID(grid_id, w_rf, w_xgb, w_if) AS (VALUES {_grid_values()})",
              "GX AS (SELECT grid_id, w_rf * rf_score + w_xgb * xgb_score + w_if * iso_score AS s, Fraud FROM L, GRID)",
              "GA AS (" + _auc_sql("GX", "s", "Fraud", "grid_id") + ")",
              "GB AS (SELECT grid_id FROM GA ORDER BY roc_auc DESC, grid_id LIMIT 1)",
          ])
          + "SELECT CAST(GA.grid_id AS BIGINT) AS grid_id, " + r6("roc_auc") + " AS roc_auc, " + r6("w_rf") + " AS w_rf, "
          + r6("w_xgb") + " AS w_xgb, " + r6("w_if") + " AS w_if, GA.grid_id = (SELECT grid_id FROM GB) AS is_best "
          "FROM GA JOIN GRID ON GA.grid_id = GRID.grid_id")
def s6_weight_search(spark, sf_dir):
    """Validation AUC over the 21-point weight grid; first best marked."""
    lp = labeled_predictions(spark, sf_dir)
    return fusion.weight_search(lp, "rf_score", "xgb_score", "iso_score", "Fraud")


@register("s7_optimal_threshold",
          with_views("L", extra=[
              "SC AS (SELECT FraudScore AS s, sum(Fraud) AS pos, sum(1 - Fraud) AS neg FROM L GROUP BY FraudScore)",
              "CU AS (SELECT s, sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp, "
              "sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS fp FROM SC)",
              "PR AS (SELECT s, coalesce(tp / nullif(tp + fp, 0), 0.0) AS pr, "
              "coalesce(tp / nullif((SELECT sum(pos) FROM SC), 0), 1.0) AS rc FROM CU)",
              "F1 AS (SELECT s, 2.0 * (pr * rc) / (pr + rc + 1e-10) AS f1 FROM PR)",
          ])
          + "SELECT " + r6("s") + " AS threshold, " + r6("f1") + " AS f1 FROM F1 ORDER BY f1 DESC, s ASC LIMIT 1")
def s7_optimal_threshold(spark, sf_dir):
    """F1-optimal threshold on the precision-recall curve."""
    return fusion.optimal_threshold(labeled_predictions(spark, sf_dir), "FraudScore", "Fraud")


_MODEL_ROWS = ("SELECT 'random_forest' AS model, rf_score AS s, CAST(rf_score > 0.5 AS INTEGER) AS pred, Fraud FROM L "
               "UNION ALL SELECT 'xgboost', xgb_score, CAST(xgb_score > 0.5 AS INTEGER), Fraud FROM L "
               "UNION ALL SELECT 'isolation_forest', iso_score, CAST(iso_score > 0.8 AS INTEGER), Fraud FROM L")


def _rates_sql(src: str, group: str | None = None) -> str:
    g = f"{group}, " if group else ""
    return (
        f"SELECT {g}count(*) FILTER (WHERE Fraud = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE Fraud = 0 AND pred = 1) AS fp, "
        f"count(*) FILTER (WHERE Fraud = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE Fraud = 1 AND pred = 1) AS tp, "
        f"count(*) AS n, avg(Fraud) AS fraud_rate, avg(pred) AS alert_rate FROM {src}" + (f" GROUP BY {group}" if group else "")
    )


_RATES_COLS = ("{acc} AS accuracy, {pre} AS precision, {rec} AS recall, {f1} AS f1_score").format(
    acc=r6("coalesce((tp + tn) / nullif(n, 0), 0.0)"),
    pre=r6("coalesce(tp / nullif(tp + fp, 0), 0.0)"),
    rec=r6("coalesce(tp / nullif(tp + fn, 0), 0.0)"),
    f1=r6("coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0)"),
)


@register("s9_evaluate_models",
          with_views("L", extra=[f"MR AS ({_MODEL_ROWS})", "MC AS (" + _rates_sql("MR", "model") + ")",
                                 "MA AS (" + _auc_sql("MR", "s", "Fraud", "model") + ")"])
          + f"SELECT MC.model, {_RATES_COLS}, " + r6("roc_auc") + " AS roc_auc FROM MC JOIN MA ON MC.model = MA.model")
def s9_evaluate_models(spark, sf_dir):
    """Per-model accuracy, precision, recall, F1 and AUC (isolation: S1+S2, cut 0.8)."""
    lp = labeled_predictions(spark, sf_dir)
    rows = lp.select(
        "Fraud",
        F.explode(
            F.array(
                F.struct(F.lit("random_forest").alias("model"), F.col("rf_score").alias("s"),
                         fusion.decide(F.col("rf_score"), 0.5).alias("pred")),
                F.struct(F.lit("xgboost").alias("model"), F.col("xgb_score").alias("s"),
                         fusion.decide(F.col("xgb_score"), 0.5).alias("pred")),
                F.struct(F.lit("isolation_forest").alias("model"), F.col("iso_score").alias("s"),
                         fusion.decide(F.col("iso_score"), 0.8).alias("pred")),
            )
        ).alias("m"),
    ).select("m.model", "m.s", "m.pred", "Fraud")
    conf = metrics.confusion(rows, "Fraud", "pred", ["model"])
    auc = metrics.roc_auc(rows, "Fraud", "s", ["model"])
    return conf.join(auc, "model").select("model", "accuracy", "precision", "recall", "f1_score", "roc_auc")


@register("s10_ensemble_evaluation",
          with_views("L", extra=["LP AS (SELECT FraudPrediction AS pred, FraudScore, Fraud FROM L)",
                                 "EC AS (" + _rates_sql("LP") + ")", "EA AS (" + _auc_sql("LP", "FraudScore", "Fraud") + ")"])
          + f"SELECT {_RATES_COLS}, " + r6("(SELECT roc_auc FROM EA)") + " AS roc_auc FROM EC")
def s10_ensemble_evaluation(spark, sf_dir):
    """Ensemble (default weights, threshold 0.5) evaluated on labelled rows."""
    m = metrics.performance_metrics(labeled_predictions(spark, sf_dir))
    return m.select("accuracy", "precision", "recall", "f1_score", "roc_auc")


# ---------------------------------------------------------------- metrics

_V8_SQL_CTES = ["LP AS (SELECT FraudPrediction AS pred, FraudScore, Fraud FROM L)",
                "EC AS (" + _rates_sql("LP") + ")", "EA AS (" + _auc_sql("LP", "FraudScore", "Fraud") + ")"]
_V8_COLS = (f"{_RATES_COLS}, " + r6("(SELECT roc_auc FROM EA)") + " AS roc_auc, " + r6("fraud_rate")
            + " AS fraud_rate, " + r6("alert_rate") + " AS alert_rate, n AS sample_size, tn AS true_negatives, "
            "fp AS false_positives, fn AS false_negatives, tp AS true_positives")
V8_SQL = with_views("L", extra=_V8_SQL_CTES) + f"SELECT {_V8_COLS} FROM EC"


@register("v8_performance_metrics", V8_SQL)
def v8_performance_metrics(spark, sf_dir):
    """V1-V8: the monitoring metric row over predictions joined to labels."""
    return metrics.performance_metrics(labeled_predictions(spark, sf_dir))


@register("v6_roc_auc", with_views("L") + "SELECT " + r6("roc_auc") + " AS roc_auc FROM ("
          + _auc_sql("L", "FraudScore", "Fraud") + ")")
def v6_roc_auc(spark, sf_dir):
    """V6: exact ROC AUC with tied scores."""
    return metrics.roc_auc(labeled_predictions(spark, sf_dir))


@register("v7_hard_label_auc", with_views("L") + "SELECT " + r6("roc_auc") + " AS roc_auc FROM ("
          + _auc_sql("L", "CAST(FraudPrediction AS DOUBLE)", "Fraud") + ")")
def v7_hard_label_auc(spark, sf_dir):
    """V7: AUC of the 0/1 predictions (the test report's variant)."""
    lp = labeled_predictions(spark, sf_dir).withColumn("hard", F.col("FraudPrediction").cast("double"))
    return metrics.roc_auc(lp, "Fraud", "hard")


@register("v9_daily_metrics",
          with_views("L", extra=["LD AS (SELECT strftime(Timestamp, '%Y-%m-%d') AS Date, FraudPrediction AS pred, "
                                 "FraudScore, Fraud FROM L)",
                                 "DC AS (" + _rates_sql("LD", "Date") + ")",
                                 "DA AS (" + _auc_sql("LD", "FraudScore", "Fraud", "Date") + ")"])
          + f"SELECT DC.Date, {_RATES_COLS}, " + r6("fraud_rate") + " AS fraud_rate, " + r6("alert_rate")
          + " AS alert_rate, n AS sample_size, tn AS true_negatives, fp AS false_positives, fn AS false_negatives, "
          "tp AS true_positives, " + r6("roc_auc") + " AS roc_auc FROM DC LEFT JOIN DA ON DC.Date = DA.Date")
def v9_daily_metrics(spark, sf_dir):
    """V9: metrics per calendar day."""
    return metrics.daily_metrics(labeled_predictions(spark, sf_dir))


@register("v10_score_histogram",
          with_views("L", extra=["HB AS (SELECT " + big("least(floor(FraudScore * 20) + 1, 20)") + " AS bin, " + big("Fraud")
                                 + " AS label FROM L WHERE FraudScore IS NOT NULL)"])
          + "SELECT bin, label, count(*) AS count, " + r6("(bin - 1) / 20.0") + " AS bin_start FROM HB GROUP BY bin, label")
def v10_score_histogram(spark, sf_dir):
    """20-bin score histogram by true class."""
    return metrics.score_histogram(labeled_predictions(spark, sf_dir))


@register("v11_confusion_cells",
          with_views("L", extra=["LP AS (SELECT FraudPrediction AS pred, Fraud FROM L)"])
          + "SELECT " + big("Fraud") + " AS actual, " + big("pred") + " AS predicted, count(*) AS count, "
          + r6("count(*) * 100.0 / (SELECT count(*) FROM LP)") + " AS pct FROM LP GROUP BY Fraud, pred")
def v11_confusion_cells(spark, sf_dir):
    """Confusion cells with their percentage of all rows."""
    return metrics.confusion_cells(labeled_predictions(spark, sf_dir))


@register("v13_metrics_table",
          with_views("L", extra=_V8_SQL_CTES + [f"M AS (SELECT {_V8_COLS} FROM EC)"])
          + "SELECT 'Accuracy' AS metric, round(accuracy, 4) AS value FROM M UNION ALL "
          "SELECT 'Precision', round(precision, 4) FROM M UNION ALL SELECT 'Recall', round(recall, 4) FROM M UNION ALL "
          "SELECT 'F1 Score', round(f1_score, 4) FROM M UNION ALL SELECT 'ROC AUC', round(roc_auc, 4) FROM M UNION ALL "
          "SELECT 'Sample Size', CAST(sample_size AS DOUBLE) FROM M")
def v13_metrics_table(spark, sf_dir):
    """The six-row display table, 4 decimals."""
    return metrics.metrics_table(metrics.performance_metrics(labeled_predictions(spark, sf_dir)))


@register("v14_report_counts",
          with_views("P", "FB") + "SELECT (SELECT count(*) FROM P) AS predictions_count, "
          "(SELECT count(*) FROM FB) AS feedback_count")
def v14_report_counts(spark, sf_dir):
    """Prediction and feedback counts of the report."""
    p = views.predictions(spark, sf_dir).agg(F.count(F.lit(1)).alias("predictions_count"))
    fb = views.feedback(spark, sf_dir).agg(F.count(F.lit(1)).alias("feedback_count")).scalar()
    return p.select("predictions_count", fb.alias("feedback_count"))


# ---------------------------------------------------------------- drift

def _drift_source(spark, sf_dir, which):
    df = views.reference_window(spark, sf_dir) if which == "R" else views.current_window(spark, sf_dir)
    return df.withColumn("TransactionHour", F.hour("TransactionDate"))


def _ks_sql() -> list[str]:
    long = lambda src, side: " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f if f != 'TransactionHour' else 'hour(TransactionDate)'} AS DOUBLE) AS value, "
        f"{side} AS side FROM {src}" for f in DRIFT_FEATURES)
    lam = "ks * sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur))"
    return [
        f"LG AS (SELECT * FROM ({long('R', 0)} UNION ALL {long('C', 1)}) WHERE value IS NOT NULL)",
        "SD AS (SELECT feature, count(*) FILTER (WHERE side = 0) AS n_ref, count(*) FILTER (WHERE side = 1) AS n_cur, "
        "count(DISTINCT value) FILTER (WHERE side = 0) AS d_ref, count(DISTINCT value) FILTER (WHERE side = 1) AS d_cur "
        "FROM LG GROUP BY feature)",
        "VC AS (SELECT feature, value, count(*) FILTER (WHERE side = 0) AS c_ref, count(*) FILTER (WHERE side = 1) AS c_cur "
        "FROM LG GROUP BY feature, value)",
        "CU AS (SELECT feature, value, sum(c_ref) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cr, "
        "sum(c_cur) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cc FROM VC)",
        "KS AS (SELECT CU.feature, max(abs(cr / n_ref - cc / n_cur)) AS ks, any_value(n_ref) AS n_ref, any_value(n_cur) AS n_cur "
        "FROM CU JOIN SD ON CU.feature = SD.feature WHERE d_ref > 1 AND d_cur > 1 GROUP BY CU.feature)",
        f"KP AS (SELECT feature, ks, CASE WHEN {lam} < 0.1 THEN 1.0 ELSE least(1.0, greatest(0.0, 2.0 * list_sum(list_transform("
        f"range(1, 101), lambda k: pow(-1.0, k - 1) * exp(-2.0 * (k * k) * ({lam}) * ({lam})))))) END AS p FROM KS)",
    ]


@register("d3_d5_ks_drift",
          with_views("R", "C", extra=_ks_sql())
          + "SELECT feature, " + r6("ks") + " AS ks_statistic, " + r6("p") + " AS p_value, ks > 0.1 AS drift_detected FROM KP")
def d3_d5_ks_drift(spark, sf_dir):
    """Two-sample KS statistic, p-value and drift flag per feature, R vs C."""
    return drift.ks_drift(_drift_source(spark, sf_dir, "R"), _drift_source(spark, sf_dir, "C"), DRIFT_FEATURES)


@register("d6_drift_summary",
          with_views("R", "C", extra=_ks_sql())
          + "SELECT " + r6("avg(CAST(ks > 0.1 AS DOUBLE))") + " AS overall_drift_score, count(*) AS features_tested, "
          "coalesce(avg(CAST(ks > 0.1 AS DOUBLE)) > 0.3, false) AS overall_drift_detected FROM KP")
def d6_drift_summary(spark, sf_dir):
    """Share of drifted features and the overall flag."""
    d = drift.ks_drift(_drift_source(spark, sf_dir, "R"), _drift_source(spark, sf_dir, "C"), DRIFT_FEATURES)
    return drift.drift_summary(d)


@register("d7_drift_ranking",
          with_views("R", "C", extra=_ks_sql())
          + "SELECT feature, " + r6("ks") + " AS ks_statistic, row_number() OVER (ORDER BY ks DESC, feature) AS rank FROM KP")
def d7_drift_ranking(spark, sf_dir):
    """Features ranked by KS statistic (rank over a one-row-per-feature table)."""
    from pyspark.sql import Window

    d = drift.ks_drift(_drift_source(spark, sf_dir, "R"), _drift_source(spark, sf_dir, "C"), DRIFT_FEATURES)
    ranked = d.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("ks_statistic"), F.asc("feature"))))
    return ranked.select("feature", "ks_statistic", F.col("rank").cast("long").alias("rank"))


# ---------------------------------------------------------------- health, joins, top-k, union

def _health_sql() -> str:
    fmt = lambda m, thr, text: (
        f"SELECT 'performance' AS type, '{m}' AS metric, {r6(m)} AS value, CAST({thr} AS DOUBLE) AS threshold, "
        f"printf('{text}: %.2f < {thr}', {m}) AS message FROM M WHERE {m} < {thr}")
    perf = " UNION ALL ".join(fmt(m, thr, text) for m, thr, text in health.PERFORMANCE_RULES)
    drift_row = ("SELECT 'data_drift', CAST(NULL AS VARCHAR), " + r6("score")
                 + ", CAST(0.3 AS DOUBLE), printf('Data drift detected: %.2f > 0.3', score) FROM DS WHERE score > 0.3")
    return perf + " UNION ALL " + drift_row


_HEALTH_CTES = _V8_SQL_CTES + [
    "M AS (SELECT coalesce((tp + tn) / nullif(n, 0), 0.0) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, "
    "coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1_score, "
    "(SELECT roc_auc FROM EA) AS roc_auc, fraud_rate, alert_rate FROM EC)",
] + _ks_sql() + ["DS AS (SELECT avg(CAST(ks > 0.1 AS DOUBLE)) AS score FROM KP)"]


def _health_inputs(spark, sf_dir):
    m = metrics.performance_metrics(labeled_predictions(spark, sf_dir))
    d = drift.drift_summary(
        drift.ks_drift(_drift_source(spark, sf_dir, "R"), _drift_source(spark, sf_dir, "C"), DRIFT_FEATURES)
    )
    return m, d


@register("h1_health_alerts", with_views("L", "R", "C", extra=_HEALTH_CTES) + _health_sql())
def h1_health_alerts(spark, sf_dir):
    """H1: alert rows from the metric row and the drift summary."""
    m, d = _health_inputs(spark, sf_dir)
    return health.health_alerts(m, d)


@register("v12_kpis",
          with_views("L", "R", "C", extra=_HEALTH_CTES + [f"AL AS ({_health_sql()})"])
          + "SELECT " + r6("fraud_rate * 100.0") + " AS fraud_rate_pct, " + r6("alert_rate * 100.0")
          + " AS alert_rate_pct, CASE WHEN (SELECT count(*) FROM AL) > 0 THEN 'degraded' ELSE 'healthy' END AS status FROM M")
def v12_kpis(spark, sf_dir):
    """Fraud %, alert % and health status."""
    m, d = _health_inputs(spark, sf_dir)
    status = health.health_status(health.health_alerts(m, d)).select("status").scalar()
    return m.select(
        (F.col("fraud_rate") * F.lit(100.0)).alias("fraud_rate_pct"),
        (F.col("alert_rate") * F.lit(100.0)).alias("alert_rate_pct"),
        status.alias("status"),
    )


@register("j1_label_join",
          with_views("P", "E") + "SELECT P.TransactionID, " + r6("FraudScore") + " AS FraudScore, " + big("FraudPrediction")
          + " AS FraudPrediction, " + big("Fraud") + " AS Fraud FROM P JOIN E ON P.TransactionID = E.TransactionID "
          f"WHERE P.Timestamp >= CAST(DATE '{AS_OF}' - INTERVAL {LOOKBACK_DAYS} DAY AS TIMESTAMP)")
def j1_label_join(spark, sf_dir):
    """J1 + C10: recent predictions joined to their labels."""
    p = clean.lookback(views.predictions(spark, sf_dir), AS_OF, LOOKBACK_DAYS)
    return health.join_labels(p, views.events(spark, sf_dir)).select("TransactionID", "FraudScore", "FraudPrediction", "Fraud")


_LATEST_FB = ("LF AS (SELECT TransactionID, arg_max(IsFraud, (Timestamp, IsFraud, Feedback)) AS IsFraud, "
              "arg_max(Feedback, (Timestamp, IsFraud, Feedback)) AS Feedback FROM FB GROUP BY TransactionID)")


@register("j2_feedback_join",
          with_views("P", "FB", extra=[_LATEST_FB])
          + "SELECT P.TransactionID, " + big("FraudPrediction") + " AS FraudPrediction, IsFraud, Feedback "
          "FROM P LEFT JOIN LF ON P.TransactionID = LF.TransactionID")
def j2_feedback_join(spark, sf_dir):
    """Predictions with their latest feedback (left join)."""
    j = health.feedback_join(views.predictions(spark, sf_dir), views.feedback(spark, sf_dir))
    return j.select("TransactionID", "FraudPrediction", "IsFraud", "Feedback")


@register("j2_reviewed_precision",
          with_views("P", "FB", extra=[_LATEST_FB, "J AS (SELECT P.FraudPrediction, LF.IsFraud FROM P LEFT JOIN LF "
                                                    "ON P.TransactionID = LF.TransactionID)"])
          + "SELECT count(*) AS predictions, count(*) FILTER (WHERE IsFraud IS NOT NULL) AS reviewed, "
          "count(*) FILTER (WHERE IsFraud IS NOT NULL AND FraudPrediction = 1) AS reviewed_alerts, "
          "count(*) FILTER (WHERE IsFraud IS NOT NULL AND FraudPrediction = 1 AND IsFraud) AS confirmed_alerts, "
          + r6("count(*) FILTER (WHERE IsFraud IS NOT NULL AND FraudPrediction = 1 AND IsFraud) * 1.0 / "
               "nullif(count(*) FILTER (WHERE IsFraud IS NOT NULL AND FraudPrediction = 1), 0)")
          + " AS reviewed_precision FROM J")
def j2_reviewed_precision(spark, sf_dir):
    """Review coverage and precision of reviewed alerts."""
    j = health.feedback_join(views.predictions(spark, sf_dir), views.feedback(spark, sf_dir))
    return health.reviewed_precision(j)


@register("k1_top10",
          with_views("P") + "SELECT TransactionID, " + r6("FraudScore") + " AS FraudScore FROM P "
          "ORDER BY FraudScore DESC NULLS LAST, TransactionID LIMIT 10")
def k1_top10(spark, sf_dir):
    """K1: the ten highest-scored transactions (the limit is the feature)."""
    return health.top_k(views.predictions(spark, sf_dir)).select("TransactionID", "FraudScore")


@register("u1_feedback_union",
          with_views("FB") + "SELECT TransactionID, IsFraud, Feedback, " + us("Timestamp") + " AS Timestamp FROM FB")
def u1_feedback_union(spark, sf_dir):
    """Old feedback (before the split date) unioned with new feedback."""
    fb = views.feedback(spark, sf_dir)
    cut = F.lit(views.DRIFT_SPLIT).cast("timestamp_ntz")
    return health.append_feedback(fb.where(F.col("Timestamp") < cut), fb.where(F.col("Timestamp") >= cut))


# ---------------------------------------------------------------- oversampling

def _p4_input(spark, sf_dir):
    """The rows of T as vectors, written once: every P4 query reads them in many passes."""
    t = views.transactions(spark, sf_dir)
    ensure_checkpoint_dir(spark)
    return t.select("TransactionID", "Fraud", F.array("TransactionAmount", "AccountBalance").alias("x")).checkpoint(eager=True)


_P4_CTES = [
    "PV AS (SELECT min(TransactionID) AS rep, TransactionAmount AS a, AccountBalance AS b FROM T WHERE Fraud = 1 "
    "GROUP BY TransactionAmount, AccountBalance)",
    "PP AS (SELECT q.rep AS q, y.rep AS y, (q.a - y.a) * (q.a - y.a) + (q.b - y.b) * (q.b - y.b) AS d2 "
    "FROM PV q JOIN PV y ON q.rep <> y.rep)",
    "PR AS (SELECT q, y, d2, row_number() OVER (PARTITION BY q ORDER BY d2, y) AS neighbor_rank FROM PP)",
]


@register("p4_minority_neighbors",
          with_views("T", extra=_P4_CTES) + "SELECT q AS TransactionID, " + big("neighbor_rank")
          + " AS neighbor_rank, y AS neighbor, " + r6("d2") + " AS d2 FROM PR WHERE neighbor_rank <= 5")
def p4_minority_neighbors(spark, sf_dir):
    """Exact 5 nearest minority neighbours (projection-pruned, no all-pairs join)."""
    from riskspark.operators.balance import minority_neighbors

    return minority_neighbors(_p4_input(spark, sf_dir), "TransactionID", "x", "Fraud", 1, 5)


@register("p4_oversample_counts",
          with_views("T") + "SELECT CAST(1 AS BIGINT) AS label, max(c) AS count FROM (SELECT count(*) AS c FROM T GROUP BY Fraud) "
          "UNION ALL SELECT CAST(0 AS BIGINT), count(*) FROM T WHERE Fraud = 0")
def p4_oversample_counts(spark, sf_dir):
    """Class counts after oversampling the minority class to parity."""
    from pyspark.ml.functions import array_to_vector

    from riskspark.operators.balance import oversample

    d = _p4_input(spark, sf_dir).withColumn("features", array_to_vector("x")).drop("x")
    return split.class_distribution(oversample(d, "TransactionID", "features", "Fraud", 1, 5))

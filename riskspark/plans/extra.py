"""Rows-only catalog entries: file formats, versioned datasets, models, the report and
streams. Each reads the driver tables (or data Spark derives from them), writes under
the shared scratch folder where it needs storage, and returns a DataFrame."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskspark.operators import clean, drift, fusion, models, split, treewalk
from riskspark.operators.metrics import REPORT_METRICS
from riskspark.plans import ingestion, monitoring, training
from riskspark.plans.catalog import _PERIOD, AS_OF, E_COLS, LOOKBACK_DAYS, _alloc_sql, _gap_ctes, register
from riskspark.plans.sqltext import big, r6, us, with_views
from riskspark.session import scratch_path
from riskspark.sources import io, views
from riskspark.sources.tables import read_table, table_path
from riskspark.streaming import scoring

_TRAINED: dict = {}
STREAM_FILES = 4  # micro-batches of the stream queries with several batches
ISOLATION_TRIALS = 50  # of the registered isolation-forest search, as SURVEY M4 lists


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, f"riskspark/{name}/{uuid.uuid4().hex}")


def _fitted(spark, sf_dir, part: str, make):
    """``make()``, once per session and state of the input files of view T."""
    key = (part, spark.sparkContext.applicationId, *(io.fingerprint(spark, table_path(sf_dir, t)) for t in ("orders", "customer", "nation")))
    if key not in _TRAINED:
        _TRAINED[key] = make()
    return _TRAINED[key]


def prepared(spark, sf_dir):
    """X5-X7 on view T: the training table of the models."""
    return _fitted(spark, sf_dir, "prepared", lambda: training.prepare(views.transactions(spark, sf_dir)))


def forest(spark, sf_dir):
    """M1 on view T."""
    return _fitted(spark, sf_dir, "forest", lambda: training.fit_forest(prepared(spark, sf_dir)))


def boosted(spark, sf_dir):
    """M2 on view T."""
    return _fitted(spark, sf_dir, "boosted", lambda: training.fit_boosted(prepared(spark, sf_dir)))


def isolation(spark, sf_dir):
    """M3 on view T."""
    return _fitted(spark, sf_dir, "isolation", lambda: training.fit_isolation(prepared(spark, sf_dir)))


def _ensemble(spark, sf_dir):
    """M5 on view T, of the same models that the queries of one model use."""
    def make():
        iforest = isolation(spark, sf_dir)
        tr = training.Trained(prepared(spark, sf_dir), forest(spark, sf_dir), boosted(spark, sf_dir), iforest, iforest.score_bounds)
        return training.build_ensemble(tr, optimize=True)
    return _fitted(spark, sf_dir, "ensemble", make)


class _OnDemand:
    """The trained ensemble of view T. Its training table alone fits no model; any other part fits them all."""

    def __init__(self, spark, sf_dir):
        self._of = spark, sf_dir

    @property
    def prepared(self):
        return prepared(*self._of)

    def __getattr__(self, part):
        if part.startswith("_"):
            raise AttributeError(part)
        return getattr(_ensemble(*self._of), part)


def trained(spark, sf_dir):
    """M5 on view T."""
    return _OnDemand(spark, sf_dir)


@register("io1_csv_scan",
          with_views("T") + "SELECT TransactionID AS Transaction_ID, " + r6("TransactionAmount") + " AS Transaction_Amount, "
          + us("TransactionDate") + " AS TransactionDate, Channel, " + big("Fraud") + " AS Fraud FROM T")
def io1_csv_scan(spark, sf_dir):
    """IO1-IO3: T written as CSV with a header, read back with an explicit schema."""
    path = _scratch(spark, "csv")
    t = views.transactions(spark, sf_dir)
    t.select(F.col("TransactionID").alias("Transaction ID"), F.col("TransactionAmount").alias("Transaction.Amount"),
             F.col("TransactionDate").cast("string").alias("TransactionDate"), "Channel", "Fraud") \
        .write.option("header", True).mode("overwrite").csv(path)
    schema = "`Transaction ID` string, `Transaction.Amount` double, TransactionDate string, Channel string, Fraud int"
    return io.read_transactions_csv(spark, path, schema=spark.createDataFrame([], schema).schema)


@register("io5_overwrite_table", with_views("E") + f"SELECT {E_COLS} FROM E")
def io5_overwrite_table(spark, sf_dir):
    """IO5: a table replaced on each run (second write wins)."""
    path = _scratch(spark, "table")
    e = views.events(spark, sf_dir)
    io.write_table(e.where(F.col("Fraud") == 1), path)
    io.write_table(e, path)
    return spark.read.parquet(path)


@register("io7_io8_versioned_dataset",
          with_views("T", extra=_alloc_sql()) + "SELECT SP.TransactionID, " + r6("T.TransactionAmount")
          + " AS TransactionAmount, " + big("SP.Fraud") + " AS Fraud, '20240102_000000' AS version, split "
          "FROM SP JOIN T ON SP.TransactionID = T.TransactionID")
def io7_io8_versioned_dataset(spark, sf_dir):
    """IO7 + IO8: two split versions written by partition; the newest is read back pruned."""
    base = _scratch(spark, "processed")
    s = split.stratified_split(views.transactions(spark, sf_dir)).select("TransactionID", "TransactionAmount", "Fraud", "split")
    io.write_versioned(s.where(F.col("split") == "train"), base, "20240101_000000")
    io.write_versioned(s, base, "20240102_000000")
    return io.read_latest(spark, base)


_RAW = ("SELECT *, CASE WHEN CAST(TransactionID AS BIGINT) % 5 = 0 THEN NULL ELSE Channel END AS Ch FROM T "
        "UNION ALL SELECT *, CASE WHEN CAST(TransactionID AS BIGINT) % 5 = 0 THEN NULL ELSE Channel END FROM T "
        "WHERE CAST(TransactionID AS BIGINT) % 3 = 0")


@register("ingestion_run",
          with_views("T", extra=[f"RAW AS ({_RAW})", "MO AS (SELECT Ch AS m FROM RAW WHERE Ch IS NOT NULL GROUP BY Ch "
                                 "ORDER BY count(*) DESC, Ch LIMIT 1)", *_alloc_sql()])
          + "SELECT SP.TransactionID, T.AccountID, " + r6("T.TransactionAmount") + " AS Transaction_Amount, "
          + us("T.TransactionDate") + " AS TransactionDate, T.Location, CASE WHEN CAST(T.TransactionID AS BIGINT) % 5 = 0 "
          "THEN (SELECT m FROM MO) ELSE T.Channel END AS Channel, " + big("SP.Fraud") + " AS Fraud, "
          "'20240102_000000' AS version, split FROM SP JOIN T ON SP.TransactionID = T.TransactionID")
def ingestion_run(spark, sf_dir):
    """IO1-IO3, C1-C4, P1, IO7 and IO8 in one run: T as CSV with every third row repeated and every
    fifth channel missing; the newest version read back."""
    path, base = _scratch(spark, "raw"), _scratch(spark, "ingested")
    n = F.col("TransactionID").cast("long")
    t = views.transactions(spark, sf_dir).select(
        "TransactionID", "AccountID", F.col("TransactionAmount").alias("Transaction.Amount"),
        F.col("TransactionDate").cast("string").alias("TransactionDate"), "Location",
        F.when(n % 5 != 0, F.col("Channel")).alias("Channel"), "Fraud")
    # one pass writes each row once or twice
    t.select("*", F.explode(F.sequence(F.lit(0), F.when(n % 3 == 0, 1).otherwise(0))).alias("copy")).drop("copy") \
        .write.option("header", True).mode("overwrite").csv(path)
    ingestion.run_ingestion(spark, path, base, "20240102_000000", t.schema)
    return io.read_latest(spark, base)


@register("io9_io10_feedback_json", with_views("FB") + "SELECT TransactionID, IsFraud, Feedback, " + us("Timestamp") + " AS Timestamp FROM FB")
def io9_io10_feedback_json(spark, sf_dir):
    """IO9 + IO10: feedback appended in two batches, read back with the feedback schema."""
    path = _scratch(spark, "feedback")
    missing = io.read_feedback(spark, path)  # absent -> empty frame
    fb = views.feedback(spark, sf_dir)
    cut = F.lit(views.DRIFT_SPLIT).cast("timestamp_ntz")
    io.append_feedback_json(fb.where(F.col("Timestamp") < cut), path)
    io.append_feedback_json(fb.where(F.col("Timestamp") >= cut), path)
    return missing.unionByName(io.read_feedback(spark, path))


@register("c7_column_kinds",
          with_views("T") + " UNION ALL ".join(
              f"SELECT '{c}' AS column, '{k}' AS kind, count({c}) AS non_null FROM T"
              for k, cols in (("numeric", ["TransactionAmount", "AccountBalance"]),
                              ("categorical", ["TransactionID", "AccountID", "CustomerOccupation", "Channel", "Location"]))
              for c in cols))
def c7_column_kinds(spark, sf_dir):
    """Numeric vs categorical columns of T (schema walk), with non-null counts."""
    t = views.transactions(spark, sf_dir)
    numeric, categorical = clean.column_kinds(t, exclude=("Fraud",))
    counts = t.agg(*[F.count(c).alias(c) for c in numeric + categorical])
    pairs = [F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind"), F.col(c).alias("non_null"))
             for k, cols in (("numeric", numeric), ("categorical", categorical)) for c in cols]
    return counts.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


@register("d1_shared_numeric_columns",
          with_views("R") + "SELECT 'TransactionAmount' AS feature, (SELECT count(*) FROM R) AS reference_rows "
          "UNION ALL SELECT 'LoginAttempts', (SELECT count(*) FROM R)")
def d1_shared_numeric_columns(spark, sf_dir):
    """Numeric columns shared by the reference and current frames."""
    r, c = views.reference_window(spark, sf_dir), views.current_window(spark, sf_dir)
    cols = drift.shared_numeric_columns(r, clean.drop_if_present(c))
    n = r.agg(F.count(F.lit(1))).scalar()
    return spark.createDataFrame([(x,) for x in cols], "feature string").withColumn("reference_rows", n)


@register("x5_x7_assembled_features")
def x5_x7_assembled_features(spark, sf_dir):
    """Features and preprocessing fitted on train, applied to all splits."""
    prep = prepared(spark, sf_dir)
    return prep.data.select(prep.key, prep.label, "split", "weight", "features")


@register("m1_random_forest")
def m1_random_forest(spark, sf_dir):
    """M1 + M6: forest class-1 probability of all rows."""
    model = forest(spark, sf_dir)
    d = model.transform(prepared(spark, sf_dir).data)
    return treewalk.forest_scores(model, d, "rf_score", "rf_prediction").select(
        "TransactionID", "Fraud", "rf_score", F.col("rf_prediction").cast("int").alias("rf_prediction"))


@register("m2_boosted_trees")
def m2_boosted_trees(spark, sf_dir):
    """M2 + M6: boosted-trees class-1 probability of all rows."""
    d = boosted(spark, sf_dir).transform(prepared(spark, sf_dir).data)
    return models.positive_probability(d, "xgb_probability", "xgb_score").select(
        "TransactionID", "Fraud", "xgb_score", F.col("xgb_prediction").cast("int").alias("xgb_prediction"))


@register("m3_isolation_forest")
def m3_isolation_forest(spark, sf_dir):
    """M3: isolation-forest score, decision and anomaly flag of all rows."""
    d = isolation(spark, sf_dir).transform(prepared(spark, sf_dir).data)
    return d.select("TransactionID", "Fraud", "anomaly_score", "iso_decision", "iso_prediction")


@register("m4_forest_search")
def m4_forest_search(spark, sf_dir):
    """M4: 50-trial seeded random search over the forest space, ranked by validation AUC. Each fit keeps the node of every row
    and tree, instead of walking all rows from the roots again for each level; the forests are the same."""
    prep = trained(spark, sf_dir).prepared
    d = prep.data
    train = d.where(F.col("split") == "train")
    est = models.random_forest(label_col=prep.label, cacheNodeIds=True)

    def score_fn(model, df):
        return models.positive_probability(model.transform(df), "rf_probability", "_score")

    res = models.search(est, models.FOREST_SPACE, train, d.where(F.col("split") == "val"), score_fn, prep.label, n_trials=50,
                        parallelism=models.fits_at_once(train, 8), size=lambda t: t["numTrees"] * t["maxDepth"])
    return models.search_table(spark, res)


@register("m4_boosted_search")
def m4_boosted_search(spark, sf_dir):
    """M4: 50-trial seeded random search over the boosted-tree space, ranked by validation AUC."""
    prep = trained(spark, sf_dir).prepared
    d = prep.data
    est = models.boosted_trees(label_col=prep.label)
    rows = d.where(F.col("split").isin("train", "val"))

    def score_fn(model, df):
        return models.positive_probability(model.transform(df), "xgb_probability", "_score")

    res = models.search(est, models.BOOSTED_SPACE, rows, d.where(F.col("split") == "val"), score_fn, prep.label, n_trials=50,
                        parallelism=models.fits_at_once(rows, 8), size=lambda t: t["maxIter"] * t["maxDepth"])
    return models.search_table(spark, res)


@register("m4_isolation_search")
def m4_isolation_search(spark, sf_dir):
    """M4: seeded random search over trees and contamination, ranked by the AUC of the hard labels."""
    prep = trained(spark, sf_dir).prepared
    d = prep.data
    res = models.search_isolation_forest(d.where(F.col("split") == "train"), d.where(F.col("split") == "val"), prep.label,
                                         key_col=prep.key, n_trials=ISOLATION_TRIALS)
    return models.search_table(spark, res)


@register("m5_s9_model_evaluation")
def m5_s9_model_evaluation(spark, sf_dir):
    """M5 + S9: the training run's per-model test metrics."""
    return training.evaluate_models(trained(spark, sf_dir))


@register("s8_s10_ensemble")
def s8_s10_ensemble(spark, sf_dir):
    """S8 + S10: ensemble built on validation (weights, threshold) and its test metrics."""
    tr = trained(spark, sf_dir)
    m = training.evaluate_ensemble(tr)
    return m.select(
        F.lit(tr.weights["random_forest"]).alias("w_rf"), F.lit(tr.weights["xgboost"]).alias("w_xgb"),
        F.lit(tr.weights["isolation_forest"]).alias("w_if"), F.lit(tr.threshold).alias("threshold"), "*")


@register("io12_model_roundtrip")
def io12_model_roundtrip(spark, sf_dir):
    """IO12: models and ensemble config saved, the latest loaded back and used to score."""
    from pyspark.ml.classification import RandomForestClassificationModel

    tr = trained(spark, sf_dir)
    base = _scratch(spark, "models")
    path = training.save(tr, spark, base, "20240101_000000")
    cfg = io.load_latest_config(spark, f"{base}/ensemble")
    forest = RandomForestClassificationModel.load(f"{cfg['model_path']}/random_forest")
    d = forest.transform(tr.prepared.data)
    return treewalk.forest_scores(forest, d, "rf_score", "rf_prediction").select(
        "TransactionID", "rf_score", F.lit(cfg["threshold"]).alias("threshold"))


@register("io12_ensemble_roundtrip", with_views("T") + "SELECT TransactionID, CAST(0.0 AS DOUBLE) AS score_difference, "
          "CAST(0 AS BIGINT) AS prediction_difference FROM T")
def io12_ensemble_roundtrip(spark, sf_dir):
    """IO12: the whole ensemble saved, loaded into new objects; all rows of T scored from raw columns by
    the loaded and by the in-memory ensemble, and compared."""
    tr = trained(spark, sf_dir)
    base = _scratch(spark, "ensemble")
    training.save(tr, spark, base, "20240101_000000")
    t = views.transactions(spark, sf_dir)
    cols = ["TransactionID", "FraudScore", "FraudPrediction"]
    a = training.score_transactions(tr, t).select(*cols)
    b = training.score_transactions(training.load(spark, base), t).select(*[F.col(c).alias(f"{c}_b") for c in cols])
    return a.join(b, F.col("TransactionID") == F.col("TransactionID_b")).select(
        "TransactionID", F.abs(F.col("FraudScore") - F.col("FraudScore_b")).alias("score_difference"),
        F.abs(F.col("FraudPrediction") - F.col("FraudPrediction_b")).cast("long").alias("prediction_difference"))


@register("io12_pipeline_roundtrip", with_views("T") + "SELECT TransactionID, CAST(0.0 AS DOUBLE) AS score_difference, "
          "CAST(0 AS BIGINT) AS prediction_difference FROM T")
def io12_pipeline_roundtrip(spark, sf_dir):
    """IO12, X5-X7: the ensemble as one MLlib PipelineModel, saved and loaded, on all rows of raw T against the plain path."""
    from pyspark.ml import PipelineModel

    tr = trained(spark, sf_dir)
    path = _scratch(spark, "pipeline-model")
    training.as_pipeline(tr).write().overwrite().save(path)
    t = views.transactions(spark, sf_dir)
    a = training.score_transactions(tr, t).select("TransactionID", "FraudScore", "FraudPrediction")
    b = PipelineModel.load(path).transform(t).select(F.col("TransactionID").alias("id"), F.col("FraudScore").alias("s"), F.col("FraudPrediction").alias("p"))
    return a.join(b, F.col("TransactionID") == F.col("id")).select(
        "TransactionID", F.abs(F.col("FraudScore") - F.col("s")).alias("score_difference"),
        F.abs(F.col("FraudPrediction") - F.col("p")).cast("long").alias("prediction_difference"))


@register("h2_monitoring_report")
def h2_monitoring_report(spark, sf_dir):
    """H2 + IO11: report over recent predictions, written as JSON and read back."""
    r = _report(spark, sf_dir)
    path = _scratch(spark, "report")
    monitoring.write_report(r, path, AS_OF, LOOKBACK_DAYS)
    return spark.read.json(path)


def _history_fit(spark, sf_dir):
    from riskspark.operators import features

    hist = views.reference_window(spark, sf_dir)
    fm = features.TransactionFeatures(keep=("TransactionID", "TransactionDate")).fit(hist)
    b = views.raw_model_scores(hist).agg(F.min("iso_raw"), F.max("iso_raw")).first()
    return fm, (b[0], b[1])


@register("st1_stream_scoring", with_views("E", "R", extra=_gap_ctes("E", "R") + [
    "RB AS (SELECT min(ln(1.0 + TransactionAmount)) AS lo, max(ln(1.0 + TransactionAmount)) AS hi FROM R)",
    "S0 AS (SELECT *, TransactionAmount / (TransactionAmount + 50.0) AS rf_score, "
    "TransactionAmount / (TransactionAmount + 100.0) AS xgb_score, ln(1.0 + TransactionAmount) AS iso_raw FROM GF)",
    "S1 AS (SELECT *, CASE WHEN x IS NULL THEN NULL ELSE least(greatest(x, 0.0), 1.0) END AS iso_score FROM "
    "(SELECT *, (iso_raw - (SELECT lo FROM RB)) / ((SELECT hi FROM RB) - (SELECT lo FROM RB)) AS x FROM S0))",
    "S2 AS (SELECT *, 0.3 * rf_score + 0.5 * xgb_score + 0.2 * iso_score AS FraudScore FROM S1)",
]) + ("SELECT TransactionID, " + r6("TransactionAmount") + " AS TransactionAmount, " + us("TransactionDate")
      + " AS TransactionDate, Channel, " + big("LoginAttempts") + " AS LoginAttempts, "
      + big("hour(TransactionDate)") + " AS TransactionHour, " + big("isodow(TransactionDate) - 1")
      + " AS TransactionDayOfWeek, " + big("month(TransactionDate)") + " AS TransactionMonth, "
      + big("CASE WHEN isodow(TransactionDate) IN (6, 7) THEN 1 ELSE 0 END") + " AS IsWeekend, "
      + _PERIOD + " AS TimePeriod, " + r6("filled") + " AS HoursSincePreviousTransaction, "
      + big("CASE WHEN filled > (SELECT lim FROM GT) THEN 1 ELSE 0 END") + " AS UnusualTransactionTiming, "
      + big("CASE WHEN LoginAttempts > 1 THEN 1 ELSE 0 END") + " AS HighLoginAttempts, "
      + r6("rf_score") + " AS rf_score, " + r6("xgb_score") + " AS xgb_score, " + r6("iso_raw") + " AS iso_raw, "
      + r6("iso_score") + " AS iso_score, " + r6("FraudScore") + " AS FraudScore, "
      + big("FraudScore > 0.5") + " AS FraudPrediction, " + us("TransactionDate") + " AS Timestamp FROM S2"))
def st1_stream_scoring(spark, sf_dir):
    """ST1: events streamed; previous time from the skew-safe W1 per micro-batch plus a
    per-epoch account state table; features and bounds fitted on history."""
    fm, bounds = _history_fit(spark, sf_dir)
    out = _scratch(spark, "st1")
    scoring.score_stream(scoring.read_table_stream(spark, sf_dir, "events"), fm, bounds, out)
    return spark.read.parquet(f"{out}/data").drop("batch_id")


def _landed(spark, df, ts: str, name: str):
    """``df`` as ``STREAM_FILES`` files, one after the other in the order of ``ts``, streamed a file a micro-batch; and the cuts."""
    path = _scratch(spark, name)
    lo, hi = df.agg(F.min(F.col(ts).cast("date")), F.max(F.col(ts).cast("date"))).first()
    cuts = [lo + (hi - lo) * k / STREAM_FILES for k in range(1, STREAM_FILES)]
    part = sum(((F.col(ts) >= F.lit(c).cast("timestamp_ntz")).cast("int") for c in cuts), F.lit(0))
    for k in range(STREAM_FILES):
        df.where(part == k).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _stream_part_sql(table: str, ts: str) -> str:
    """The number of the micro-batch of a row, as ``_landed`` cuts them."""
    lo, hi = f"(SELECT min(CAST({ts} AS DATE)) FROM {table})", f"(SELECT max(CAST({ts} AS DATE)) FROM {table})"
    return " + ".join(f"CAST({ts} >= {lo} + CAST(floor(({hi} - {lo}) * {k} / {STREAM_FILES}.0) AS INTEGER) AS BIGINT)" for k in range(1, STREAM_FILES))


@register("st1_keyed_state", with_views("E") + "SELECT TransactionID, AccountID, " + us("TransactionDate") + " AS TransactionDate, "
          + us("PreviousTransactionDate") + " AS PreviousTransactionDate, " + _stream_part_sql("E", "TransactionDate") + " AS batch_id FROM E")
def st1_keyed_state(spark, sf_dir):
    """ST1's keyed state over several micro-batches: each event's previous time, carried across batches in hash buckets."""
    out = _scratch(spark, "st1-keyed")
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id"])
    scoring.score_keyed(_landed(spark, ev, "ts", "st1-keyed-landing"), lambda rows: rows.select(
        F.col("event_id").cast("string").alias("TransactionID"), F.col("user_id").cast("string").alias("AccountID"),
        F.col("ts").alias("TransactionDate"), F.col("_prev_ts").alias("PreviousTransactionDate")), out)
    return spark.read.parquet(f"{out}/data")


def _orders_as_transactions(spark, sf_dir):
    """Streamed orders with their previous time as transactions of view T, without the label."""
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])

    def of(rows):
        return rows.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
            F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("o_orderkey").cast("string").alias("TransactionID"), F.col("o_custkey").cast("string").alias("AccountID"),
            F.col("o_totalprice").cast("double").alias("TransactionAmount"), F.col("o_orderdate").alias("TransactionDate"),
            F.col("_prev_ts").alias("PreviousTransactionDate"), F.col("c_acctbal").cast("double").alias("AccountBalance"),
            F.col("c_mktsegment").alias("CustomerOccupation"), F.col("o_orderpriority").alias("Channel"), F.col("n_name").alias("Location"))
    return of


_ORDERS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _stream_of_ensembles(spark, sf_dir, name, after_batch=None):
    """Orders streamed through the newest saved ensemble; the first one saved is the trained one."""
    base = _scratch(spark, name)
    training.save(trained(spark, sf_dir), spark, base, "20240101_000000")
    ensembles = scoring.Ensembles(spark, base)
    stream = _landed(spark, read_table(spark, sf_dir, "orders", _ORDERS), "o_orderdate", f"{name}-landing")
    scoring.score_ensemble_stream(stream, ensembles, f"{base}/out", _orders_as_transactions(spark, sf_dir), key="o_custkey", ts="o_orderdate",
                                  tiebreak="o_orderkey", after_batch=None if after_batch is None else lambda epoch: after_batch(base, epoch))
    return base, spark.read.parquet(f"{base}/out/data")


def _against_batch(spark, sf_dir, streamed, ensemble):
    """Differences of streamed scores to those of ``ensemble`` on view T at once."""
    t = training.score_transactions(ensemble, views.transactions(spark, sf_dir)).select(
        F.col("TransactionID").alias("id"), F.col("FraudScore").alias("s"), F.col("FraudPrediction").alias("p"))
    return streamed.join(t, F.col("TransactionID") == F.col("id")).select(
        "TransactionID", "config_version", F.col("batch_id").cast("long").alias("batch_id"),
        F.abs(F.col("FraudScore") - F.col("s")).alias("score_difference"),
        F.abs(F.col("FraudPrediction") - F.col("p")).cast("long").alias("prediction_difference"))


_BATCH_OF_T = _stream_part_sql("T", "TransactionDate")


@register("st1_ensemble_stream", with_views("T") + "SELECT TransactionID, '20240101_000000' AS config_version, " + _BATCH_OF_T
          + " AS batch_id, CAST(0.0 AS DOUBLE) AS score_difference, CAST(0 AS BIGINT) AS prediction_difference FROM T")
def st1_ensemble_stream(spark, sf_dir):
    """ST1 with the trained ensemble, saved and loaded: orders streamed in several micro-batches get the scores that the
    loaded ensemble gives view T at once."""
    base, out = _stream_of_ensembles(spark, sf_dir, "st1-ensemble")
    return _against_batch(spark, sf_dir, out, training.load(spark, base))


@register("st4_ensemble_refresh", with_views("T", extra=[f"B AS (SELECT TransactionID, {_BATCH_OF_T} AS batch_id FROM T)"])
          + "SELECT TransactionID, CASE WHEN batch_id < 2 THEN '20240101_000000' ELSE '20240102_000000' END AS config_version, batch_id, "
          "CAST(0.0 AS DOUBLE) AS score_difference, CAST(0 AS BIGINT) AS prediction_difference FROM B")
def st4_ensemble_refresh(spark, sf_dir):
    """ST4: a second ensemble (other models, weights and threshold) is published while the stream runs, after its second
    micro-batch; later batches are scored by it, without a restart."""
    tr = trained(spark, sf_dir)
    second = training.fit_models(tr.prepared, n_trees=20, seed=7)
    second.weights, second.threshold = {"random_forest": 0.5, "xgboost": 0.3, "isolation_forest": 0.2}, 0.45

    def publish(base, epoch):
        if epoch == 1:
            training.save(second, spark, base, "20240102_000000")

    _, out = _stream_of_ensembles(spark, sf_dir, "st4-ensemble", publish)
    first = out.where(F.col("config_version") == "20240101_000000")
    rest = out.where(F.col("config_version") != "20240101_000000")
    return _against_batch(spark, sf_dir, first, tr).unionByName(_against_batch(spark, sf_dir, rest, second))


@register("st2_rolling_kpis", with_views("R", extra=[
    "RB AS (SELECT min(ln(1.0 + TransactionAmount)) AS lo, max(ln(1.0 + TransactionAmount)) AS hi FROM R)",
    "S0 AS (SELECT ts, value AS v, ln(1.0 + value) AS iso_raw, value / (value + 50.0) AS rf, value / (value + 100.0) AS xgb "
    "FROM events)",
    "S1 AS (SELECT *, CASE WHEN x IS NULL THEN NULL ELSE least(greatest(x, 0.0), 1.0) END AS iso FROM "
    "(SELECT *, (iso_raw - (SELECT lo FROM RB)) / ((SELECT hi FROM RB) - (SELECT lo FROM RB)) AS x FROM S0))",
    "S2 AS (SELECT *, 0.3 * rf + 0.5 * xgb + 0.2 * iso AS score FROM S1)",
    "S3 AS (SELECT *, CAST(score > 0.5 AS INTEGER) AS pred, time_bucket(INTERVAL 5 MINUTE, ts) AS ws FROM S2)",
]) + ("SELECT " + us("ws") + " AS window_start, " + us("ws + INTERVAL 5 MINUTE") + " AS window_end, count(*) AS transactions, "
      + r6("avg(pred)") + " AS alert_rate, " + r6("avg(score)") + " AS mean_score, " + r6("sum(v)") + " AS amount FROM S3 "
      "GROUP BY ws HAVING ws + INTERVAL 5 MINUTE <= date_trunc('millisecond', (SELECT max(ts) FROM events)) - INTERVAL 10 MINUTE"))
def st2_rolling_kpis(spark, sf_dir):
    """ST2: 5-minute KPIs with a 10-minute watermark (append: closed windows only)."""
    _, bounds = _history_fit(spark, sf_dir)
    out = _scratch(spark, "st2")
    ev = scoring.read_table_stream(spark, sf_dir, "events")
    tx = ev.select(F.col("event_id").cast("string").alias("TransactionID"),
                   F.col("value").cast("double").alias("TransactionAmount"), F.col("ts").alias("TransactionDate"))
    kpis = scoring.rolling_kpis(scoring.proxy_scores(tx, bounds).drop("ModelScores"))
    scoring.run_to_table(kpis, f"{out}/data", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/data")


@register("st3_feedback_dedup", with_views("FB") + "SELECT TransactionID, IsFraud, Feedback, " + us("Timestamp") + " AS Timestamp FROM FB")
def st3_feedback_dedup(spark, sf_dir):
    """ST3: feedback landed twice (at-least-once delivery), streamed, de-duplicated."""
    land = _scratch(spark, "st3-landing")
    fb = views.feedback(spark, sf_dir)
    io.append_feedback_json(fb, land)
    io.append_feedback_json(fb, land)
    stream = spark.readStream.schema(fb.schema).option("timestampNTZFormat", io.TS_FORMAT).json(land)
    out = _scratch(spark, "st3")
    scoring.run_to_table(scoring.dedup_feedback(stream), f"{out}/data", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/data")


@register("st4_model_refresh", with_views("R", extra=[
    "RB AS (SELECT min(ln(1.0 + TransactionAmount)) AS lo, max(ln(1.0 + TransactionAmount)) AS hi FROM R)",
    "S0 AS (SELECT CAST(event_id AS VARCHAR) AS TransactionID, value AS TransactionAmount, ts AS TransactionDate, "
    "value / (value + 50.0) AS rf_score, value / (value + 100.0) AS xgb_score, ln(1.0 + value) AS iso_raw FROM events)",
    "S1 AS (SELECT *, CASE WHEN x IS NULL THEN NULL ELSE least(greatest(x, 0.0), 1.0) END AS iso_score FROM "
    "(SELECT *, (iso_raw - (SELECT lo FROM RB)) / ((SELECT hi FROM RB) - (SELECT lo FROM RB)) AS x FROM S0))",
    "S2 AS (SELECT *, 0.2 * rf_score + 0.5 * xgb_score + 0.3 * iso_score AS FraudScore FROM S1)",
]) + ("SELECT TransactionID, " + r6("TransactionAmount") + " AS TransactionAmount, " + us("TransactionDate")
      + " AS TransactionDate, " + r6("rf_score") + " AS rf_score, " + r6("xgb_score") + " AS xgb_score, "
      + r6("iso_raw") + " AS iso_raw, " + r6("iso_score") + " AS iso_score, " + r6("FraudScore") + " AS FraudScore, "
      + big("FraudScore > 0.45") + " AS FraudPrediction, " + us("TransactionDate") + " AS Timestamp, "
      "'20240102_000000' AS config_version, CAST(0 AS BIGINT) AS batch_id FROM S2"))
def st4_model_refresh(spark, sf_dir):
    """ST4: each micro-batch scored with the newest ensemble configuration."""
    _, bounds = _history_fit(spark, sf_dir)
    base = _scratch(spark, "st4")
    io.save_ensemble_config(spark, f"{base}/ensemble", "20240101_000000", fusion.DEFAULT_WEIGHTS, 0.5, bounds)
    io.save_ensemble_config(spark, f"{base}/ensemble", "20240102_000000",
                            {"random_forest": 0.2, "xgboost": 0.5, "isolation_forest": 0.3}, 0.45, bounds)
    scoring.refresh_scoring(scoring.read_table_stream(spark, sf_dir, "events"), f"{base}/ensemble",
                            f"{base}/data", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/data")



def _report(spark, sf_dir):
    return monitoring.generate_report(
        views.predictions(spark, sf_dir), views.events(spark, sf_dir),
        views.reference_window(spark, sf_dir).withColumn("TransactionHour", F.hour("TransactionDate")),
        views.feedback(spark, sf_dir), AS_OF, LOOKBACK_DAYS,
    )


_RECENT = ("RL AS (SELECT P.*, E.Fraud FROM P JOIN E ON P.TransactionID = E.TransactionID "
           f"WHERE P.Timestamp >= CAST(DATE '{AS_OF}' - INTERVAL {LOOKBACK_DAYS} DAY AS TIMESTAMP))")


def _report_metrics_sql() -> str:
    from riskspark.plans.catalog import _RATES_COLS, _auc_sql, _rates_sql

    ctes = [_RECENT, "LP AS (SELECT FraudPrediction AS pred, FraudScore, Fraud FROM RL)",
            "EC AS (" + _rates_sql("LP") + ")", "EA AS (" + _auc_sql("LP", "FraudScore", "Fraud") + ")",
            f"M AS (SELECT {_RATES_COLS}, (SELECT roc_auc FROM EA) AS roc_auc, fraud_rate, alert_rate, n AS sample_size, "
            "tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp AS true_positives FROM EC)"]
    parts = [f"SELECT '{m}' AS metric, {r6(f'CAST({m} AS DOUBLE)')} AS value FROM M" for m in REPORT_METRICS]
    return with_views("P", "E", extra=ctes) + " UNION ALL ".join(parts)


@register("h2_report_metrics", _report_metrics_sql())
def h2_report_metrics(spark, sf_dir):
    """H2: the report's metric rows (V8 over the look-back window), long form."""
    return _report(spark, sf_dir).metrics_long


def _report_drift_sql() -> str:
    long = lambda src, side: " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value, {side} AS side FROM {src}"
        for f in ("TransactionAmount", "LoginAttempts"))
    lam = "ks * sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur))"
    ctes = [
        _RECENT,
        f"LG AS (SELECT * FROM ({long('R', 0)} UNION ALL {long('RL', 1)}) WHERE value IS NOT NULL)",
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
    return (with_views("P", "E", "R", extra=ctes) + "SELECT feature, " + r6("ks") + " AS ks_statistic, " + r6("p")
            + " AS p_value, ks > 0.1 AS drift_detected FROM KP")


@register("h2_report_drift", _report_drift_sql())
def h2_report_drift(spark, sf_dir):
    """H2: the report's drift rows (history R vs the look-back window's shared numeric columns)."""
    return _report(spark, sf_dir).drift


@register("s5_predictions_table")
def s5_predictions_table(spark, sf_dir):
    """The ensemble scores T into the day-partitioned predictions table, read back whole."""
    from riskspark.plans import scoring

    tr = trained(spark, sf_dir)
    path = _scratch(spark, "predictions")
    t = views.transactions(spark, sf_dir)
    scoring.write_predictions(tr, t, path)
    return spark.read.parquet(path).drop("ModelScores")


@register("p4_synthetic_rows")
def p4_synthetic_rows(spark, sf_dir):
    """The synthetic minority rows themselves, features included."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    from riskspark.operators.balance import oversample
    from riskspark.plans.catalog import _p4_input

    d = _p4_input(spark, sf_dir).withColumn("features", array_to_vector("x")).drop("x")
    x = vector_to_array("features")
    return oversample(d, "TransactionID", "features", "Fraud", 1, 5).where("synthetic").select(
        "TransactionID", F.col("Fraud").cast("long").alias("Fraud"), x[0].alias("x0"), x[1].alias("x1"))


from riskspark.plans import cases  # noqa: E402,F401  (registers its queries; they build on those above)

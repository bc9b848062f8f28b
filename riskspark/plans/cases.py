"""Queries whose input holds the special case an operator is for: nulls, unseen levels, constant and missing
columns, whole-row copies, stored references, bucketed tables; and models and synthetic rows checked by what must hold
for every row."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskspark.operators import clean, drift, features, health, transformers
from riskspark.operators.metrics import REPORT_METRICS
from riskspark.plans import extra, monitoring, training
from riskspark.plans.catalog import (
    AS_OF, DRIFT_FEATURES, LOOKBACK_DAYS, ORACLES, T_COLS, _alloc_sql, _drift_source, _ks_sql, _p4_input, register,
)
from riskspark.plans.sqltext import big, r6, with_views
from riskspark.session import ensure_checkpoint_dir
from riskspark.sources import io, views


def _every(n: int):
    """Rows whose id is divisible by ``n``."""
    return F.col("TransactionID").cast("long") % n == 0



@register("c3_whole_rows", with_views("T") + f"SELECT DISTINCT {T_COLS} FROM T")
def c3_whole_rows(spark, sf_dir):
    """Whole rows of T, every third one three times."""
    t = views.transactions(spark, sf_dir)
    copies = F.explode(F.sequence(F.lit(1), F.when(_every(3), 3).otherwise(1)))
    return clean.deduplicate(t.select("*", copies.alias("copy")).drop("copy"))


def _holes(df):
    """Every seventh amount and every fifth channel missing."""
    return df.select("TransactionID", F.when(~_every(7), F.col("TransactionAmount")).alias("TransactionAmount"),
                     F.when(~_every(5), F.col("Channel")).alias("Channel"))


_HOLES = ("SELECT TransactionID, CASE WHEN CAST(TransactionID AS BIGINT) % 7 <> 0 THEN TransactionAmount END AS a, "
          "CASE WHEN CAST(TransactionID AS BIGINT) % 5 <> 0 THEN Channel END AS ch FROM ")
_LEVELS = ["click", "error", "purchase", "signup", "view"]


@register("x1_x4_missing_and_unseen", with_views("R", "C", extra=[
    f"RH AS ({_HOLES} R)", f"CH0 AS ({_HOLES} C)",
    "CH AS (SELECT TransactionID, a, CASE WHEN CAST(TransactionID AS BIGINT) % 11 = 0 THEN 'unseen' ELSE ch END AS ch FROM CH0)",
    "M AS (SELECT median(a) AS m, (SELECT ch FROM RH WHERE ch IS NOT NULL GROUP BY ch ORDER BY count(*) DESC, ch LIMIT 1) AS mo FROM RH)",
    "S AS (SELECT avg(x) AS mean, stddev_pop(x) AS sd FROM (SELECT coalesce(a, (SELECT m FROM M)) AS x FROM RH))"])
    + "SELECT TransactionID, " + r6("(coalesce(a, (SELECT m FROM M)) - (SELECT mean FROM S)) / (SELECT sd FROM S)") + " AS TransactionAmount, "
    + ", ".join(r6(f"CASE WHEN coalesce(ch, (SELECT mo FROM M)) = '{v}' THEN 1.0 ELSE 0.0 END") + f" AS Channel_{v}" for v in _LEVELS) + " FROM CH")
def x1_x4_missing_and_unseen(spark, sf_dir):
    """X1-X4 and X5's vector: medians and modes fitted and filled where values are missing; a level the fit has not seen is all zeros."""
    from pyspark.ml.functions import vector_to_array

    model = transformers.Preprocessor(["TransactionAmount"], ["Channel"]).fit(_holes(views.reference_window(spark, sf_dir)))
    cur = _holes(views.current_window(spark, sf_dir)).withColumn("Channel", F.when(_every(11), F.lit("unseen")).otherwise(F.col("Channel")))
    out = model.assemble(cur, keep=["TransactionID"]).withColumn("v", vector_to_array("features"))
    return out.select("TransactionID", *[F.col("v")[i].alias(c) for i, c in enumerate(model.output_columns())])


@register("f11_all_null_dates", with_views("E") + "SELECT TransactionID, " + big("CASE WHEN LoginAttempts > 1 THEN 1 ELSE 0 END")
          + " AS HighLoginAttempts, CAST(0 AS BIGINT) AS date_features FROM E")
def f11_all_null_dates(spark, sf_dir):
    """date features are left out when the date columns are all null; the others stay."""
    e = views.events(spark, sf_dir)
    none = e.withColumns({c: F.lit(None).cast("timestamp_ntz") for c in clean.DATE_COLUMNS})
    out = features.batch_features(none)
    dated = {"TransactionHour", "TransactionDayOfWeek", "TransactionMonth", "IsWeekend", "TimePeriod", "HoursSincePreviousTransaction",
             "UnusualTransactionTiming"}
    return out.select("TransactionID", "HighLoginAttempts", F.lit(len(dated & set(out.columns))).cast("long").alias("date_features"))


_KS = with_views("R", "C", extra=_ks_sql()) + "SELECT feature, " + r6("ks") + " AS ks_statistic, " + r6("p") + " AS p_value, ks > 0.1 AS drift_detected FROM KP"


@register("d2_constant_features", _KS)
def d2_constant_features(spark, sf_dir):
    """A feature with one value on either side, or with nulls only, is not tested."""
    r, c = (_drift_source(spark, sf_dir, w) for w in "RC")
    more = ["Constant", "ConstantNow", "NoValue"]
    r = r.withColumns({"Constant": F.lit(1.0), "ConstantNow": F.col("TransactionAmount"), "NoValue": F.lit(None).cast("double")})
    c = c.withColumns({"Constant": F.lit(1.0), "ConstantNow": F.lit(2.0), "NoValue": F.col("TransactionAmount")})
    return drift.ks_drift(r, c, [*DRIFT_FEATURES, *more])


@register("d3_stored_reference", _KS)
def d3_stored_reference(spark, sf_dir):
    """D1-D5 against the reference kept with a dataset version: value counts written and published, newest version read
    back; only the current side's rows are read."""
    base = extra._scratch(spark, "drift-reference")
    r = _drift_source(spark, sf_dir, "R")
    monitoring.save_reference(r.where("TransactionAmount > 50"), DRIFT_FEATURES, base, "20240101_000000")
    monitoring.save_reference(r, DRIFT_FEATURES, base, "20240102_000000")
    return drift.ks_drift_from_counts(monitoring.load_reference(spark, base), _drift_source(spark, sf_dir, "C").drop("Fraud"))


_REPORT = ("SELECT metric, value FROM (" + ORACLES["h2_report_metrics"].rstrip().rstrip(";") + ")") if "h2_report_metrics" in ORACLES else None


@register("io11_report_json", _REPORT)
def io11_report_json(spark, sf_dir):
    """IO11: the report written as JSON, read back and flattened to its metric rows."""
    path = extra._scratch(spark, "report-json")
    monitoring.write_report(extra._report(spark, sf_dir), path, AS_OF, LOOKBACK_DAYS)
    doc = spark.read.json(path)
    rows = [F.struct(F.lit(m).alias("metric"), F.col(f"metrics.{m}").cast("double").alias("value")) for m in REPORT_METRICS]
    return doc.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# ---- J1, J2 on tables stored by transaction id ---------------------------------------------------

BUCKETS = 8


def _stored(spark, df, name: str):
    table = f"riskspark_{name}_{uuid.uuid4().hex[:12]}"
    io.write_bucketed(df, table, extra._scratch(spark, f"bucketed-{name}"), "TransactionID", BUCKETS)
    return spark.table(table)


@register("j1_bucketed_join", ORACLES["j1_label_join"])
def j1_bucketed_join(spark, sf_dir):
    """J1 + C10 on predictions and labels stored in buckets of the transaction id: no shuffle on either side."""
    p = _stored(spark, views.predictions(spark, sf_dir).drop("ModelScores"), "predictions")
    e = _stored(spark, views.events(spark, sf_dir).select("TransactionID", "Fraud"), "labels")
    return health.join_labels(clean.lookback(p, AS_OF, LOOKBACK_DAYS), e).select("TransactionID", "FraudScore", "FraudPrediction", "Fraud")


@register("j2_bucketed_join", ORACLES["j2_feedback_join"])
def j2_bucketed_join(spark, sf_dir):
    """J2 on predictions and feedback stored in buckets of the transaction id: neither the latest feedback nor the join shuffles."""
    p = _stored(spark, views.predictions(spark, sf_dir).drop("ModelScores"), "predictions")
    fb = _stored(spark, views.feedback(spark, sf_dir), "feedback")
    return health.feedback_join(p, fb).select("TransactionID", "FraudPrediction", "IsFraud", "Feedback")


# ---- models and synthetic rows: what must hold for every row -------------------------------------

_MODELS = ["random_forest", "xgboost", "isolation_forest", "ensemble"]


@register("m_score_invariants", with_views("T") + " UNION ALL ".join(
    f"SELECT '{m}' AS model, count(*) AS rows, CAST(0 AS BIGINT) AS out_of_range, CAST(0 AS BIGINT) AS against_cut, count(*) AS distinct_ids FROM T"
    for m in _MODELS))
def m_score_invariants(spark, sf_dir):
    """Every row of T scored once by each model and the ensemble, scores in [0, 1], and each decision on the
    side of its cut (0.5, the forest's fitted threshold, the ensemble's threshold)."""
    tr = extra.trained(spark, sf_dir)
    d = training.predict(tr, tr.prepared.data)
    rows = [("rf_score", F.col("rf_prediction") == (F.col("rf_score") > 0.5).cast("int")),
            ("xgb_score", F.col("xgb_prediction") == (F.col("xgb_score") > 0.5).cast("int")),
            ("anomaly_score", F.col("iso_prediction") == (F.col("anomaly_score") > F.lit(tr.iforest.threshold)).cast("int")),
            ("FraudScore", F.col("FraudPrediction") == (F.col("FraudScore") > F.lit(tr.threshold)).cast("int"))]
    each = F.array(*[F.struct(F.lit(m).alias("model"), F.col(s).alias("s"), ok.alias("ok")) for m, (s, ok) in zip(_MODELS, rows)])
    return d.select("TransactionID", F.explode(each).alias("m")).groupBy("m.model").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.coalesce(F.col("m.s").between(0.0, 1.0), F.lit(False))).alias("out_of_range"),
        F.count_if(~F.coalesce(F.col("m.ok"), F.lit(False))).alias("against_cut"), F.countDistinct("TransactionID").alias("distinct_ids"))


@register("m3_flagged_share", with_views("T") + "SELECT CAST(0 AS BIGINT) AS off_by_more_than_ties")
def m3_flagged_share(spark, sf_dir):
    """M3: the forest flags the contaminated share of the training rows, up to rows tied at the cut."""
    forest = extra.isolation(spark, sf_dir)
    d = forest.score(extra.prepared(spark, sf_dir).data.where("split = 'train'"))
    cut = F.lit(forest.threshold)
    a = d.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("anomaly_score") > cut).alias("over"), F.count_if(F.col("anomaly_score") >= cut).alias("at_least"))
    want = F.col("n") * F.lit(forest.contamination)
    ok = (F.col("over") <= F.ceil(want) + 1) & (F.col("at_least") >= F.floor(want) - 1)
    return a.select(F.when(ok, 0).otherwise(1).cast("long").alias("off_by_more_than_ties"))


@register("s5_predictions_by_day", with_views("T") + "SELECT CAST(CAST(TransactionDate AS DATE) AS VARCHAR) AS day, count(*) AS rows, "
          "count(DISTINCT TransactionID) AS distinct_ids, CAST(0 AS BIGINT) AS wrong_day, CAST(0 AS BIGINT) AS against_cut, "
          "CAST(0 AS BIGINT) AS no_score FROM T GROUP BY 1")
def s5_predictions_by_day(spark, sf_dir):
    """The predictions table by day, after a second run over the legitimate rows alone and a third over all: each
    transaction stands once, in the partition of its day, with its models' scores and a decision on the side of its cut."""
    from riskspark.plans import scoring

    tr = extra.trained(spark, sf_dir)
    path = extra._scratch(spark, "predictions-by-day")
    ensure_checkpoint_dir(spark)
    t = views.transactions(spark, sf_dir).checkpoint(eager=True)  # three runs score it: its joins and windows run once
    scoring.write_predictions(tr, t, path)
    scoring.write_predictions(tr, t.where("Fraud = 0"), path)  # replaces the days it holds
    scoring.write_predictions(tr, t, path)
    p = spark.read.parquet(path)
    decided = F.col("FraudPrediction") == (F.col("FraudScore") > F.lit(tr.threshold)).cast("int")
    return p.groupBy(F.col("day").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("TransactionID").alias("distinct_ids"),
        F.count_if(~F.to_date("Timestamp").eqNullSafe(F.col("day"))).alias("wrong_day"),
        F.count_if(~F.coalesce(decided, F.lit(False))).alias("against_cut"),
        F.count_if(F.col("ModelScores").isNull() | F.col("FraudScore").isNull()).alias("no_score"))


@register("x5_x7_vector_invariants", with_views("T", extra=_alloc_sql()) + "SELECT split, " + big("Fraud") + " AS Fraud, count(*) AS rows, "
          "CAST(1 AS BIGINT) AS lengths, CAST(0 AS BIGINT) AS non_finite, CAST(0 AS BIGINT) AS vectors_off FROM SP GROUP BY split, Fraud")
def x5_x7_vector_invariants(spark, sf_dir):
    """Rows of each split and label, with vectors of one length and finite entries, equal to those that the stored
    feature statistics and preprocessor give for the cleaned transactions."""
    from pyspark.ml.functions import vector_to_array

    prep = extra.prepared(spark, sf_dir)
    cleaned = clean.clean_data(views.transactions(spark, sf_dir), prep.label)
    again = prep.preprocessor.assemble(prep.feature_model.transform(cleaned), keep=[prep.key])
    again = again.select(prep.key, vector_to_array("features").alias("y"))
    d = prep.data.select(prep.key, "split", F.col(prep.label).cast("long").alias("Fraud"), vector_to_array("features").alias("x"))
    odd = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return d.join(again, prep.key, "left").groupBy("split", "Fraud").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct(F.size("x")).alias("lengths"), F.count_if(odd).alias("non_finite"),
        F.count_if(~F.col("x").eqNullSafe(F.col("y"))).alias("vectors_off"))


@register("p4_synthetic_on_segments", with_views("T", extra=[
    "K AS (SELECT count(*) FILTER (WHERE Fraud = 1) AS n, count(*) FILTER (WHERE Fraud = 0) - count(*) FILTER (WHERE Fraud = 1) AS need FROM T)",
    "H AS (SELECT TransactionID, row_number() OVER (ORDER BY md5('42:' || TransactionID), TransactionID) AS rk FROM T WHERE Fraud = 1)",
    "J AS (SELECT TransactionID, need // n + CAST(rk <= need % n AS BIGINT) AS c FROM H, K)"])
    + "SELECT TransactionID || '#' || j AS TransactionID, CAST(1 AS BIGINT) AS Fraud, CAST(0.0 AS DOUBLE) AS off_segment "
    "FROM (SELECT TransactionID, unnest(range(1, c + 1)) AS j FROM J)")
def p4_synthetic_on_segments(spark, sf_dir):
    """P4's synthetic rows: which rows get how many, and for each its relative distance to the nearest segment between its
    row's vector and one of the five nearest minority vectors (0 up to rounding)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    from riskspark.operators.balance import minority_neighbors, oversample

    src = _p4_input(spark, sf_dir)
    synth = oversample(src.withColumn("features", array_to_vector("x")).drop("x"), "TransactionID", "features", "Fraud", 1, 5).where("synthetic")
    synth = synth.select("TransactionID", "Fraud", F.substring_index("TransactionID", "#", 1).alias("parent"), vector_to_array("features").alias("s"))
    minority = src.where("Fraud = 1").select(F.col("TransactionID").cast("string").alias("id"), "x")
    reps = minority.groupBy("x").agg(F.min("id").alias("rep"))
    near = minority_neighbors(src, "TransactionID", "x", "Fraud", 1, 5)
    ends = near.join(minority.select(F.col("id").alias("neighbor"), F.col("x").alias("y")), "neighbor").groupBy(
        F.col("TransactionID").alias("rep")).agg(F.collect_list("y").alias("ys"))
    rows = synth.join(minority.withColumnRenamed("id", "parent"), "parent").join(reps, "x").join(ends, "rep")

    def off(y):
        dx, dy = y[0] - F.col("x")[0], y[1] - F.col("x")[1]
        sx, sy = F.col("s")[0] - F.col("x")[0], F.col("s")[1] - F.col("x")[1]
        length = dx * dx + dy * dy
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (sx * dx + sy * dy) / length))
        return F.sqrt(F.pow(sx - t * dx, 2) + F.pow(sy - t * dy, 2)) / (F.lit(1.0) + F.sqrt(length))

    return rows.select("TransactionID", F.col("Fraud").cast("long").alias("Fraud"), F.abs(F.array_min(F.transform("ys", off))).alias("off_segment"))

"""Sources and sinks, and a small end-to-end training run."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL


def test_feedback_json_array_and_missing(spark):
    from riskspark.sources import io

    d = tempfile.mkdtemp(prefix="fb-")
    path = os.path.join(d, "feedback.json")
    assert io.read_feedback(spark, path).count() == 0
    records = [{"TransactionID": "T1", "IsFraud": True, "Feedback": "confirmed", "Timestamp": "2024-01-02T03:04:05.123456"},
               {"TransactionID": "T2", "IsFraud": False, "Feedback": None, "Timestamp": "2024-01-03T00:00:00.000000"}]
    with open(path, "w") as f:
        json.dump(records, f, indent=2)
    rows = io.read_feedback(spark, path, json_array=True).orderBy("TransactionID").collect()
    assert [r["TransactionID"] for r in rows] == ["T1", "T2"]
    assert rows[0]["Timestamp"].microsecond == 123456 and rows[0]["IsFraud"] is True


def test_versioned_read_prunes_to_latest(spark):
    from riskspark.sources import io

    base = tempfile.mkdtemp(prefix="ver-")
    df = spark.range(10).select(F.col("id").cast("string").alias("k"), F.lit("train").alias("split"))
    io.write_versioned(df, base, "20240101_000000")
    io.write_versioned(df.limit(3), base, "20240201_000000")
    latest = io.read_latest(spark, base)
    assert latest.count() == 3 and {r[0] for r in latest.select("version").distinct().collect()} == {"20240201_000000"}
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


@pytest.fixture(scope="module")
def trained(spark):
    from riskspark.plans import training
    from riskspark.sources import views

    return training.run_training(views.transactions(spark, SMALL), optimize=True, n_trees=10)


def test_training_run_end_to_end(spark, trained):
    from riskspark.plans import training

    ev = training.evaluate_models(trained).collect()
    assert {r["model"] for r in ev} == {"random_forest", "xgboost", "isolation_forest"}
    assert all(0.0 <= r["accuracy"] <= 1.0 for r in ev)
    assert abs(sum(trained.weights.values()) - 1.0) < 1e-9 and 0.0 <= trained.threshold <= 1.0
    ens = training.evaluate_ensemble(trained).first()
    assert ens["sample_size"] == trained.prepared.data.where("split = 'test'").count()


def test_model_and_config_roundtrip(spark, trained):
    from pyspark.ml.classification import RandomForestClassificationModel

    from riskspark.plans import training
    from riskspark.sources import io

    base = tempfile.mkdtemp(prefix="models-")
    training.save(trained, spark, base, "20240101_000000")
    cfg = io.load_latest_config(spark, f"{base}/ensemble")
    assert cfg["threshold"] == pytest.approx(trained.threshold)
    forest = RandomForestClassificationModel.load(f"{cfg['model_path']}/random_forest")
    test = trained.prepared.data.where("split = 'test'")
    a = forest.transform(test).select("rf_probability").collect()
    b = trained.forest.transform(test).select("rf_probability").collect()
    assert a == b


def test_saved_ensemble_scores_like_the_one_in_memory(spark, trained):
    from riskspark.plans import training
    from riskspark.sources import views

    base = tempfile.mkdtemp(prefix="ensemble-")
    training.save(trained, spark, base, "20240101_000000")
    loaded = training.load(spark, base)
    assert loaded.iforest.threshold == trained.iforest.threshold and loaded.weights == trained.weights
    t = views.transactions(spark, SMALL)
    cols = ["TransactionID", "FraudScore", "FraudPrediction"]
    a, b = (sorted(map(tuple, training.score_transactions(m, t).select(*cols).collect())) for m in (trained, loaded))
    assert a == b and len(a) == t.count()


def test_boosted_search_two_trials(spark, trained):
    from riskspark.operators import models

    d = trained.prepared.data
    est = models.boosted_trees(validation_col=None, maxIter=5)

    def score_fn(model, df):
        return models.positive_probability(model.transform(df), "xgb_probability", "_score")

    space = dict(models.BOOSTED_SPACE, maxIter=("int", 3, 5))
    res = models.search(est, space, d.where("split = 'train'"), d.where("split = 'val'"), score_fn, n_trials=2)
    assert len(res.trials) == 2 and res.best_model is not None


def test_predictions_table_partition_pruned(spark, trained):
    from riskspark.plans import scoring
    from riskspark.sources import views

    path = tempfile.mkdtemp(prefix="pred-")
    t = views.transactions(spark, SMALL)
    scoring.write_predictions(trained, t, path)
    all_rows = spark.read.parquet(path)
    assert all_rows.count() == t.count()
    assert set(scoring.PREDICTION_COLUMNS) <= set(all_rows.columns)
    recent = scoring.read_predictions(spark, path, "1998-08-02", 30)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    want = t.where(F.col("TransactionDate") >= F.lit("1998-07-03").cast("timestamp_ntz")).count()
    assert recent.count() == want


def test_prepare_with_oversampling_balances_train_only(spark):
    from riskspark.plans import training
    from riskspark.sources import views

    prep = training.prepare(views.transactions(spark, SMALL), oversample=True)
    counts = {(r["split"], r["Fraud"]): r["count"] for r in prep.data.groupBy("split", "Fraud").count().collect()}
    assert counts[("train", 0)] == counts[("train", 1)]
    assert counts[("test", 0)] != counts[("test", 1)]

"""Bucketed tables join without a shuffle; drift against the reference kept at ingestion reads the current side only."""

import tempfile
import uuid

from pyspark.sql import functions as F

from riskspark.operators import drift, health
from riskspark.plans import ingestion, monitoring
from riskspark.sources import io, views
from tests.conftest import SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_joins_have_no_exchange(spark):
    base = tempfile.mkdtemp(prefix="buckets-")
    names = {}
    for name, df in (("p", views.predictions(spark, SMALL).drop("ModelScores")), ("e", views.events(spark, SMALL)), ("f", views.feedback(spark, SMALL))):
        names[name] = f"t_{name}_{uuid.uuid4().hex[:8]}"
        io.write_bucketed(df, names[name], f"{base}/{name}", "TransactionID", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a broadcast would hide a missing layout
    try:
        p, e, f = (spark.table(names[k]) for k in "pef")
        j1, j2 = health.join_labels(p, e), health.feedback_join(p, f)
        for j in (j1, j2):
            assert "Join" in _plan(j) and "Exchange" not in _plan(j)
        plain = health.join_labels(views.predictions(spark, SMALL), views.events(spark, SMALL))
        assert "Exchange" in _plan(plain)
        cols = ["TransactionID", "FraudScore", "Fraud"]
        assert j1.select(*cols).exceptAll(plain.select(*cols)).count() == 0 and j1.count() == plain.count()
        want = health.feedback_join(views.predictions(spark, SMALL), views.feedback(spark, SMALL)).select("TransactionID", "IsFraud")
        assert j2.select("TransactionID", "IsFraud").exceptAll(want).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for t in names.values():
            spark.sql(f"DROP TABLE {t}")


def test_reference_kept_at_ingestion(spark):
    base = tempfile.mkdtemp(prefix="ingest-")
    t = views.transactions(spark, SMALL).withColumn("TransactionDate", F.col("TransactionDate").cast("string")).drop("PreviousTransactionDate")
    t.write.option("header", True).csv(f"{base}/raw")
    ingestion.run_ingestion(spark, f"{base}/raw", f"{base}/data", "20240101_000000", t.schema, reference_base=f"{base}/reference")
    ref = monitoring.load_reference(spark, f"{base}/reference")
    train = io.read_latest(spark, f"{base}/data", "train")
    cols = sorted(r["feature"] for r in ref.select("feature").distinct().collect())
    assert cols == ["AccountBalance", "TransactionAmount"]
    cur = views.transactions(spark, SMALL).where("Fraud = 1")
    got = drift.ks_drift_from_counts(ref, cur)
    want = drift.ks_drift(train, cur, cols)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert not any("data" in f for f in got.select("feature").inputFiles())


def test_reference_of_nothing_and_missing_features(spark):
    ref = drift.value_counts_of(spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double"), ["a", "b"])
    assert ref.where("feature = 'b'").count() == 0
    cur = spark.createDataFrame([(1.0, "x")], "a double, c string")
    assert drift.ks_drift_from_counts(ref, cur).count() == 0  # one value on the current side
    assert drift.ks_drift_from_counts(ref, cur.limit(0)).count() == 0

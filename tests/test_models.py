"""Isolation forest invariants, oversampling, and a small training run."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskspark.operators.balance import minority_neighbors, oversample
from riskspark.operators.iforest import IsolationForest


@pytest.fixture(scope="module")
def blob(spark):
    rng = np.random.default_rng(0)
    pts = rng.normal(size=(2000, 3)).tolist() + [[9.0, 9.0, 9.0]]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "id long, a double, b double, c double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


def test_iforest_invariants(spark, blob):
    model = IsolationForest(key_col="id", n_trees=50).fit(blob)
    out = model.transform(blob)
    top = out.orderBy(F.desc("anomaly_score")).first()
    assert top["id"] == 2000
    stats = out.agg(F.min("anomaly_score"), F.max("anomaly_score"), F.avg("iso_prediction")).first()
    assert 0.0 < stats[0] < stats[1] < 1.0
    assert stats[2] == pytest.approx(0.05, abs=0.01)
    again = IsolationForest(key_col="id", n_trees=50).fit(blob.repartition(5)).score(blob)
    a = out.select("id", "anomaly_score").orderBy("id").toPandas()["anomaly_score"]
    b = again.select("id", "anomaly_score").orderBy("id").toPandas()["anomaly_score"]
    assert np.allclose(a, b)


def test_neighbors_match_brute_force(spark):
    rng = np.random.default_rng(1)
    pts = rng.normal(size=(300, 4))
    pts[:30] = pts[0]  # a block of identical vectors
    rows = [(str(i), 1, [float(x) for x in p]) for i, p in enumerate(pts)]
    df = spark.createDataFrame(rows, "k string, Fraud int, x array<double>")
    got = {(r["k"], r["neighbor_rank"]): r["neighbor"] for r in minority_neighbors(df, "k", "x", k=5).collect()}
    reps = {}  # identical vectors collapse to their smallest key
    for i, p in enumerate(pts):
        reps[tuple(p)] = min(reps.get(tuple(p), str(i)), str(i))
    keys = sorted(set(reps.values()))
    vec = {reps[tuple(p)]: p for p in pts}
    for q in keys:
        order = sorted((float(((vec[q] - vec[y]) ** 2).sum()), y) for y in keys if y != q)
        for rank, (_, y) in enumerate(order[:5], start=1):
            assert got[(q, rank)] == y


def test_oversample_reaches_parity(spark, blob):
    labelled = blob.withColumn("Fraud", (F.col("id") % 10 == 0).cast("int")).withColumn("id", F.col("id").cast("string"))
    out = oversample(labelled, "id", "features")
    counts = {r["Fraud"]: r["count"] for r in out.groupBy("Fraud").count().collect()}
    assert counts[0] == counts[1]
    assert out.where("synthetic").count() == counts[1] - 201


def test_isolation_forest_search_runs(spark, blob):
    from riskspark.operators.models import search_isolation_forest

    labelled = blob.withColumn("Fraud", (F.col("id") == 2000).cast("int"))
    res = search_isolation_forest(labelled, labelled, n_trials=2, key_col="id")
    assert len(res.trials) == 2 and res.best_auc is not None and res.best_auc > 0.9


def test_registered_isolation_search_runs_all_trials(spark, blob, monkeypatch):
    from types import SimpleNamespace

    from riskspark.operators import models
    from riskspark.plans import extra

    data = blob.withColumn("Fraud", (blob.id == 2000).cast("int")).withColumn("split", blob.id.cast("string"))
    monkeypatch.setattr(extra, "trained", lambda *a: SimpleNamespace(prepared=SimpleNamespace(data=data, label="Fraud", key="id")))
    asked = []
    monkeypatch.setattr(models, "search_isolation_forest", lambda *a, n_trials=50, **k: asked.append(n_trials))
    monkeypatch.setattr(models, "search_table", lambda *a: None)
    extra.m4_isolation_search(spark, "")
    assert asked == [50]

def test_oversample_identical_minority_vectors(spark):
    from pyspark.ml.functions import array_to_vector

    rows = [(str(i), 1 if i < 3 else 0, [1.0, 2.0] if i < 3 else [float(i), 0.0]) for i in range(10)]
    df = spark.createDataFrame(rows, "k string, Fraud int, x array<double>").withColumn("features", array_to_vector("x"))
    out = oversample(df.drop("x"), "k", "features")
    counts = {r["Fraud"]: r["count"] for r in out.groupBy("Fraud").count().collect()}
    assert counts == {0: 7, 1: 7}


def test_iforest_without_key_draws_equal_vectors_apart(spark):
    """A vector held by a third of the rows: no tree is filled with copies of it alone."""
    rows = [(0.0, 0.0) if i % 3 == 0 else (float(i % 97), float(i % 89)) for i in range(6000)]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(rows, "a double, b double"))
    model = IsolationForest(n_trees=20).fit(df)
    assert (model.feature[:, 0] >= 0).all() and (model.size[:, 0] == 256).all()


def test_oversampling_input_is_computed_once(spark):
    """The many passes of P4 read the written vectors, not the joins and scans behind them."""
    from conftest import SMALL
    from riskspark.plans.catalog import _p4_input

    plan = _p4_input(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan and "Join" not in plan and "Relation" not in plan

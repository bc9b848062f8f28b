"""Nested isolation forests, early stop by patience, ordered sums over many groups, neighbours beyond any cluster cap."""

import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskspark.operators import models
from riskspark.operators.cumulative import ordered_cumsum
from riskspark.operators.iforest import IsolationForest
from riskspark.operators.metrics import roc_auc


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.gauss(0, 1), rnd.gauss(0, 1), int(i % 9 == 0)) for i in range(1500)]
    rows = [(i, a + (2.5 if y else 0), b - (y and rnd.random() * 3), y) for i, a, b, y in rows]
    df = spark.createDataFrame(rows, "id long, a double, b double, Fraud int")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).withColumn("weight", F.lit(1.0)).checkpoint()


def test_nested_search_equals_separate_fits(spark, labelled, monkeypatch):
    train, val = labelled.where("id % 4 <> 0"), labelled.where("id % 4 = 0")
    monkeypatch.setattr(models, "ISOLATION_SPACE", {"n_trees": ("int", 3, 12), "contamination": ("float", 0.01, 0.3)})
    res = models.search_isolation_forest(train, val, n_trials=6, key_col="id")
    assert len(res.trials) == 6
    for i, t, auc in res.trials[:4]:
        m = IsolationForest(n_trees=t["n_trees"], contamination=t["contamination"], key_col="id").fit(train)
        flagged = m.transform(val).withColumn("flag", F.col("iso_prediction").cast("double"))
        assert auc == pytest.approx(roc_auc(flagged, "Fraud", "flag").first()["roc_auc"], abs=1e-12)
        if t == res.best_params:
            assert res.best_model.threshold == pytest.approx(m.threshold, abs=1e-12)
    best = res.best_model.transform(val).agg(F.sum("iso_prediction")).first()[0]
    assert best is not None and res.best_model.feature.shape[0] == res.best_params["n_trees"]


def test_patience_round():
    assert models.patience_round([0.5, 0.6, 0.6, 0.59, 0.7], 2) == 2    # two rounds without gain: the later 0.7 is not seen
    assert models.patience_round([0.5, 0.6, 0.6, 0.59, 0.7], 3) == 5
    assert models.patience_round([0.5, 0.4, 0.3], 10) == 1
    assert models.patience_round([None, None], 1) == 2                   # one class in the validation rows: all rounds stay


def test_early_stop_equals_brute_force_over_prefixes(spark, labelled):
    train, val = labelled.where("id % 3 <> 0"), labelled.where("id % 3 = 0")
    est = models.boosted_trees(validation_col=None, maxIter=12, maxDepth=2)
    full = est.fit(train)
    aucs = models.staged_auc(full, val)
    brute = []
    for n in range(1, 13):
        m = models.first_rounds(full, n)
        assert m.getNumTrees == n
        scored = models.positive_probability(m.transform(val), "xgb_probability", "s")
        brute.append(roc_auc(scored, "Fraud", "s").first()["roc_auc"])
    assert aucs == pytest.approx(brute, abs=1e-9)
    cut = models.fit_with_patience(est, train, val, patience=3)
    assert cut.getNumTrees == models.patience_round(brute, 3)
    # a cut model is saved and loaded like any other
    import tempfile

    from pyspark.ml.classification import GBTClassificationModel

    path = tempfile.mkdtemp(prefix="gbt-")
    cut.write().overwrite().save(path)
    back = GBTClassificationModel.load(path)
    a = [r.xgb_probability for r in cut.transform(val).orderBy("id").collect()]
    assert a == [r.xgb_probability for r in back.transform(val).orderBy("id").collect()]


def test_prefix_sums_of_many_groups_and_of_long_keys(spark):
    """10,000 groups in 40 ranges, no broadcast of group x range tables; whole numbers beyond 2^53 keep their order."""
    df = spark.range(60000).select((F.col("id") % 10000).alias("g"), (F.lit(1 << 60) + F.floor(F.col("id") / 10000)).alias("k"), F.lit(1).cast("long").alias("c"))
    plain = df.withColumn("want", F.coalesce(F.sum("c").over(Window.partitionBy("g").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    for down in (False, True):
        got = ordered_cumsum(df, "k", ["c"], ["g"], descending=down, buckets=40)
        assert got.columns == ["g", "k", "c", "c_before", "c_upto"]
        want = plain.select("g", "k", "want") if not down else plain.select("g", "k", (F.lit(5) - F.col("want")).alias("want"))
        assert got.select("g", "k", "c_before").exceptAll(want).count() == 0 and got.count() == 60000
    # the number of ranges follows the size: no cap
    many = spark.range(9000).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("c"))
    got = ordered_cumsum(many, "k", ["c"], rows_per_bucket=2)
    assert got.where("c_before <> k").count() == 0 and got.count() == 9000


def test_neighbours_beyond_any_cluster_cap(spark):
    """Leaves of 8 vectors: thousands of them for 12,000 vectors with a hot value in one dimension and far outliers."""
    from riskspark.operators.balance import box_tree, minority_neighbors

    rnd = random.Random(5)
    pts = {(float(rnd.randrange(60)) if i % 3 else 0.0, rnd.gauss(0, 5)) for i in range(4000)} | {(1e9, -1e9), (-1e9, 1e9)}
    rows = [(f"{i:06d}", list(p), 1) for i, p in enumerate(sorted(pts))]
    df = spark.createDataFrame(rows, "k string, x array<double>, Fraud int")
    leaves, _ = box_tree(df.select(F.col("k").alias("rep"), "x"), 3, leaf_size=8)
    sizes = [r["count"] for r in leaves.groupBy("node").count().collect()]
    assert max(sizes) <= 8 and sum(sizes) == len(rows) and len(sizes) > 500
    got = {}
    for r in minority_neighbors(df, "k", "x", k=3, leaf_size=8).collect():
        got.setdefault(r["k"], {})[r["neighbor_rank"]] = (r["d2"], r["neighbor"])
    for k, x, _ in rnd.sample(rows, 150) + rows[:1] + rows[-1:]:
        want = sorted(((x[0] - y[0]) ** 2 + (x[1] - y[1]) ** 2, j) for j, y, _ in rows if j != k)[:3]
        assert [got[k][r][1] for r in (1, 2, 3)] == [j for _, j in want]


def test_patience_fits_no_more_rounds_than_it_needs(spark, labelled, monkeypatch):
    """The first rounds of a short fit are those of a long one, so the model of all rounds is found from few."""
    from pyspark.ml.classification import GBTClassifier

    train, val = labelled.where("id % 4 <> 0").coalesce(1), labelled.where("id % 4 = 0")
    est = models.boosted_trees(validation_col=None, maxIter=16, maxDepth=2)
    asked = []
    fit = GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, *a: asked.append(self.getMaxIter()) or fit(self, *a))
    full = est.fit(train)
    want = models.first_rounds(full, models.patience_round(models.staged_auc(full, val), 2))
    monkeypatch.setattr(models, "FIRST_ROUNDS", 4)
    asked.clear()
    got = models.fit_with_patience(est, train, val, patience=2)
    assert got.toDebugString.split("\n", 1)[1] == want.toDebugString.split("\n", 1)[1]
    assert asked == [n for n in (4, 8, 16) if n == 4 or n // 2 - want.getNumTrees < 2]


def test_isolation_scores_equal_a_walk_by_hand(spark, labelled):
    """Scores, null-free bounds and prefixes equal a node-by-node walk, for missing entries too."""
    import numpy as np

    from riskspark.operators.iforest import average_path_length

    m = IsolationForest(n_trees=5, key_col="id").fit(labelled)
    rows = [[0.1, 0.2], [float("nan"), 3.0], [-9.0, float("nan")], [float("inf"), 0.0]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x array<double>")
    from pyspark.ml.functions import array_to_vector

    df = df.select("i", array_to_vector("x").alias("features"))
    got = {r.i: (r.anomaly_score, r.prefix_scores) for r in m.score_prefixes(m.score(df), [2, 5]).collect()}
    c = average_path_length(np.array([m.psi]))[0]
    for i, x in enumerate(rows):
        paths = []
        for t in range(5):
            node = depth = 0
            while m.feature[t, node] >= 0:
                node, depth = (m.left if x[m.feature[t, node]] <= m.thr[t, node] else m.right)[t, node], depth + 1
            paths.append(depth + average_path_length(m.size[t, node:node + 1])[0])
        assert got[i][0] == pytest.approx(2 ** (-np.mean(paths) / c), abs=1e-12)
        assert got[i][1] == pytest.approx([2 ** (-np.mean(paths[:2]) / c), 2 ** (-np.mean(paths) / c)], abs=1e-12)
    assert m.score_bounds == tuple(m.score(labelled).agg(F.min("anomaly_score"), F.max("anomaly_score")).first())


def test_queries_of_one_model_fit_that_model_only(spark, labelled, monkeypatch):
    from types import SimpleNamespace

    from riskspark.plans import extra, training

    data = labelled.withColumnRenamed("id", "TransactionID").withColumn("split", F.when(F.col("TransactionID") % 4 == 0, "val").otherwise("train"))
    fitted = []
    monkeypatch.setattr(extra, "_TRAINED", {})
    monkeypatch.setattr(extra.io, "fingerprint", lambda *a: a[1:])
    monkeypatch.setattr(extra.views, "transactions", lambda *a: None)
    monkeypatch.setattr(training, "prepare", lambda *a: fitted.append("prepare") or SimpleNamespace(data=data, key="TransactionID", label="Fraud"))
    for name in ("forest", "boosted", "isolation"):
        make = {"forest": lambda p: models.random_forest(numTrees=2, maxDepth=2).fit(p.data), "isolation": lambda p: IsolationForest(
            n_trees=2, key_col=p.key).fit(p.data), "boosted": lambda p: models.boosted_trees(validation_col=None, maxIter=2, maxDepth=2).fit(p.data)}[name]
        monkeypatch.setattr(training, f"fit_{name}", lambda p, name=name, make=make: fitted.append(name) or make(p))
    assert extra.x5_x7_assembled_features(spark, "d").count() == 1500 and fitted == ["prepare"]
    assert extra.m3_isolation_forest(spark, "d").count() == 1500 and fitted == ["prepare", "isolation"]
    assert extra.m1_random_forest(spark, "d").count() == 1500 and fitted == ["prepare", "isolation", "forest"]
    assert extra.m2_boosted_trees(spark, "d").count() == 1500 and fitted == ["prepare", "isolation", "forest", "boosted"]
    assert extra.trained(spark, "d").prepared.data is data and len(fitted) == 4
    assert sum(extra.trained(spark, "d").weights.values()) == pytest.approx(1.0) and len(fitted) == 4


def test_rising_gains_go_straight_to_all_rounds(spark, labelled, monkeypatch):
    """A longer fit starts anew: with the best round among the last ones no fit in between is made, known rounds are not scored again."""
    from pyspark.ml.classification import GBTClassifier

    train, val = labelled.where("id % 4 <> 0").coalesce(1), labelled.where("id % 4 = 0")
    est = models.boosted_trees(validation_col=None, maxIter=12, maxDepth=2)
    full = est.fit(train)
    want = models.staged_auc(full, val)
    assert models.staged_auc(full, val, known=want[:5]) == want and models.staged_auc(full, val, known=[0.25, None])[:3] == [0.25, None, want[2]]
    asked, known = [], []
    fit = GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, *a: asked.append(self.getMaxIter()) or fit(self, *a))
    monkeypatch.setattr(models, "staged_auc", lambda m, d, y, g=(): known.append(len(g)) or [i / 100 for i in range(m.getNumTrees)])
    monkeypatch.setattr(models, "FIRST_ROUNDS", 3)
    assert models.fit_with_patience(est, train, val, patience=2).getNumTrees == 12
    assert asked == [3, 12] and known == [0, 3]


def test_isolation_search_orders_few_of_the_scores(spark, monkeypatch):
    """Thresholds come from the values near the wanted ranks; they equal numpy's on all values."""
    import numpy as np

    from riskspark.operators import cumulative

    rnd = random.Random(11)
    rows = [(i, rnd.gauss(0, 1), rnd.gauss(0, 1), int(i % 50 == 0)) for i in range(45000)]
    df = spark.createDataFrame(rows, "id long, a double, b double, Fraud int")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).checkpoint()
    monkeypatch.setattr(models, "ISOLATION_SPACE", {"n_trees": ("int", 3, 12), "contamination": ("float", 0.01, 0.3)})
    ordered, cumsum = [], cumulative.ordered_cumsum
    monkeypatch.setattr(cumulative, "ordered_cumsum", lambda d, *a, **k: ordered.append(d.count()) or cumsum(d, *a, **k))
    res = models.search_isolation_forest(df, df.where("id % 4 = 0"), n_trials=5, key_col="id")
    assert len(res.trials) == 5 and 0 < sum(ordered) < 45000 // 10
    scores = [r[0] for r in res.best_model.score(df).select("anomaly_score").collect()]
    assert res.best_model.threshold == pytest.approx(np.quantile(scores, 1 - res.best_params["contamination"]), abs=1e-12)


def test_quantile_pairs_equal_numpy(spark):
    import numpy as np

    from riskspark.operators.cumulative import exact_quantile_pairs

    rnd = random.Random(2)
    rows = [(rnd.random(), None if i % 7 == 0 else float(rnd.randrange(5))) for i in range(500)]
    df = spark.createDataFrame(rows, "a double, b double").withColumn("c", F.lit(None).cast("double"))
    got = exact_quantile_pairs(df, [("a", 0.1), ("b", 0.77), ("a", 0.9), ("a", 0.1), ("c", 0.5)])
    assert set(got) == {("a", 0.1), ("a", 0.9), ("b", 0.77), ("c", 0.5)} and got["c", 0.5] is None
    for c, q in (("a", 0.1), ("a", 0.9), ("b", 0.77)):
        assert got[c, q] == pytest.approx(np.quantile([r["ab".index(c)] for r in rows if r["ab".index(c)] is not None], q), abs=1e-12)
    assert exact_quantile_pairs(df, []) == {}


def test_training_table_is_spread_by_rows(spark, monkeypatch):
    """The table's few bytes don't decide how many tasks a fit has; few rows stay as they lie."""
    from riskspark.plans import training

    rnd = random.Random(4)
    rows = [(str(i), f"a{i % 40}", rnd.random() * 90, rnd.random() * 900, "web" if i % 3 else "atm", int(i % 5 == 0)) for i in range(900)]
    df = spark.createDataFrame(rows, "TransactionID string, AccountID string, TransactionAmount double, AccountBalance double, Channel string, Fraud int")
    small = training.prepare(df).data
    monkeypatch.setattr(training, "ROWS_PER_TASK", 100)
    data = training.prepare(df).data
    sizes = [r[0] for r in data.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) == 9 and max(sizes) <= 2 * min(sizes) and sum(sizes) == 900
    cols = ["TransactionID", "split", "weight", "features"]
    assert sorted(map(str, data.select(cols).collect())) == sorted(map(str, small.select(cols).collect()))


def test_forest_search_starts_large_trials_first_and_keeps_node_ids(spark, labelled, monkeypatch):
    """Neither changes a trial: the AUCs equal those of separate plain fits, in the order drawn."""
    from types import SimpleNamespace

    from pyspark.ml.classification import RandomForestClassifier

    from riskspark.plans import extra

    data = labelled.withColumn("split", F.when(F.col("id") % 4 == 0, "val").otherwise("train")).checkpoint()
    started, search, many = [], models.search, RandomForestClassifier.fitMultiple

    def recorded(self, df, maps):
        started.append((self.getCacheNodeIds(), [m[self.numTrees] * m[self.maxDepth] for m in maps]))
        return many(self, df, maps)

    monkeypatch.setattr(extra, "trained", lambda *a: SimpleNamespace(prepared=SimpleNamespace(data=data, label="Fraud")))
    monkeypatch.setattr(models, "FOREST_SPACE", {"numTrees": ("int", 2, 30), "maxDepth": ("int", 2, 10), "minInstancesPerNode": ("int", 1, 10)})
    monkeypatch.setattr(RandomForestClassifier, "fitMultiple", recorded)
    monkeypatch.setattr(models, "search", lambda *a, **k: search(*a, **{**k, "n_trials": 5}))
    got = [(r.trial, r.roc_auc) for r in extra.m4_forest_search(spark, "d").collect()]
    trials = models.sample_space(models.FOREST_SPACE, 5)
    sizes = [t["numTrees"] * t["maxDepth"] for t in trials]
    assert started == [(True, sorted(sizes, reverse=True))] and sizes != started[0][1]
    want = []
    for i, t in enumerate(trials):
        m = models.random_forest(**t).fit(data.where("split = 'train'"))
        scored = models.positive_probability(m.transform(data.where("split = 'val'")), "rf_probability", "s")
        want.append((i, roc_auc(scored, "Fraud", "s").first()["roc_auc"]))
    assert got == want


def test_many_partitions_get_few_fits_at_once(spark):
    """The fits at once hold bags and node ids of all rows each: as many as fill the cores, two at least."""
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(64)
    assert models.fits_at_once(df.coalesce(1), 8) == min(8, max(2, 2 * cores))
    assert models.fits_at_once(df.repartition(cores), 8) == models.fits_at_once(df.repartition(50 * cores), 8) == 2
    assert models.fits_at_once(df.repartition(50 * cores), 1) == 1


@pytest.fixture(scope="module")
def mixed(spark):
    """Numbers, a nominal column of 5 levels and a binary one, as sparse vectors; and rows with values between the levels."""
    from pyspark.ml.feature import VectorIndexer

    rnd = random.Random(8)
    rows = [(i, rnd.gauss(0, 1), float(rnd.randrange(5)), float(rnd.randrange(2)), rnd.random()) for i in range(1200)]
    rows = [(i, a, k, b, c, int(rnd.random() < (0.8 if (k in (1, 3)) == (a > 0) else 0.2 + b / 4))) for i, a, k, b, c in rows]
    df = spark.createDataFrame(rows, "id long, a double, k double, b double, c double, Fraud int")
    vectors = VectorAssembler(inputCols=["a", "k", "b", "c"], outputCol="raw").transform(df).withColumn("weight", 1 + F.col("c"))
    train = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=5).fit(vectors).transform(vectors)
    between = df.select("id", "a", "k", (F.col("b") * 0.3).alias("b"), F.when(F.col("id") % 50 > 0, F.col("c")).otherwise(float("nan")).alias("c"), "Fraud")
    odd = VectorAssembler(inputCols=["a", "k", "b", "c"], outputCol="features", handleInvalid="keep").transform(between)
    return train.select("id", "Fraud", "weight", "features").checkpoint(), odd.select("id", "Fraud", "features").checkpoint()


def test_forest_walk_equals_transform_to_the_last_bit(spark, mixed):
    from pyspark.ml.classification import RandomForestClassificationModel

    from riskspark.operators import treewalk

    train, odd = mixed
    model = models.random_forest(numTrees=12, maxDepth=7).fit(train)
    splits = [s for s in treewalk._nodes(spark, model)["categories"] if s >= 0]
    assert 2 in splits and 5 in splits  # both kinds of categorical splits are walked
    for df in (train, odd, odd.limit(0)):
        want = models.positive_probability(model.transform(df), "rf_probability", "s").select("id", "s", "rf_prediction")
        got = treewalk.forest_scores(model, df, "s", "p").select("id", "s", "p")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # a model with thresholds of its own decides by them
    model.write().overwrite().save(path := f"{spark.sparkContext.getCheckpointDir()}/forest-with-thresholds")
    loaded = RandomForestClassificationModel.load(path)
    loaded.set(loaded.thresholds, [0.2, 0.8])
    got = treewalk.forest_scores(loaded, train, "s", "p").select("id", "p").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, loaded.transform(train).select("id", "rf_prediction").collect()))


def test_staged_sums_are_those_of_the_trees(spark, mixed):
    from riskspark.operators import treewalk

    train, odd = mixed
    model = models.boosted_trees(validation_col=None, maxIter=6, maxDepth=3).fit(train)
    for df in (train, odd):
        out = df
        for i, tree in enumerate(model.trees):
            out = tree.setFeaturesCol("features").setPredictionCol(f"t{i}").transform(out)
        got = treewalk.staged_sums(model, df, "sums").select("id", "sums").collect()
        want = {}
        for r in out.collect():
            total, want[r.id] = 0.0, []
            for i, w in enumerate(model.treeWeights):
                total += r[f"t{i}"] * w
                want[r.id].append(total)
        assert {r.id: r.sums for r in got} == want


def test_ensemble_scores_by_the_walk_and_keeps_the_columns_of_transform(spark, labelled, monkeypatch):
    from types import SimpleNamespace

    from riskspark.operators import treewalk
    from riskspark.plans import training

    forest = models.random_forest(numTrees=3, maxDepth=3).fit(labelled)
    boosted = models.boosted_trees(validation_col=None, maxIter=2, maxDepth=2).fit(labelled)
    iforest = IsolationForest(n_trees=2, key_col="id").fit(labelled)
    walked, walk = [], treewalk.forest_scores
    monkeypatch.setattr(training.treewalk, "forest_scores", lambda m, *a: walked.append(m) or walk(m, *a))
    got = training.score(SimpleNamespace(forest=forest, boosted=boosted, iforest=iforest, iso_bounds=iforest.score_bounds), labelled)
    assert walked == [forest] and {"rf_raw", "rf_probability", "rf_prediction", "rf_score"} <= set(got.columns)
    p = models.positive_probability(got, "rf_probability", "p").select("rf_score", "p", "rf_prediction").collect()
    assert all(r.rf_score == r.p and r.rf_prediction == float(r.p > 0.5) for r in p)


def test_forest_of_the_ensemble_keeps_node_ids(spark, labelled):
    from types import SimpleNamespace

    from riskspark.plans import training

    data = labelled.withColumn("split", F.lit("train"))
    model = training.fit_forest(SimpleNamespace(data=data, label="Fraud"), 5)
    assert model.getOrDefault("cacheNodeIds") and model.getNumTrees == 5
    assert model.toDebugString.split("\n")[1:] == models.random_forest(numTrees=5).fit(data).toDebugString.split("\n")[1:]


def test_training_tasks_are_whole_rounds_over_the_cores(spark, monkeypatch):
    from riskspark.plans import training

    cores = spark.sparkContext.defaultParallelism
    df = spark.range(250 * cores).coalesce(1)
    for name, n in (("ROWS_PER_TASK", 70), ("LEAST_ROWS", 50), ("MOST_ROWS", 100)):
        monkeypatch.setattr(training, name, n)
    sizes = [r[0] for r in training.spread(df, 250 * cores).groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) == 3 * cores and max(sizes) <= 100
    assert training.spread(df, 70) is df
    monkeypatch.setattr(training, "LEAST_ROWS", 90)  # too few rows for that: by rows, as before
    assert training.spread(df, 250 * cores).rdd.getNumPartitions() == -(-250 * cores // 70)


def test_preparation_computes_its_source_once(spark):
    """Nulls, modes, labels, class counts and the split read the transactions as written, not the joins behind them."""
    from pyspark.sql import types as T

    from riskspark.plans import training

    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    rnd = random.Random(4)
    rows = [(str(i), f"a{i % 40}", rnd.random() * 90, rnd.random() * 900, None if i % 7 == 0 else "web" if i % 3 else "atm", int(i % 5 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "TransactionID string, AccountID string, TransactionAmount double, AccountBalance double, Channel string, Fraud int")
    data = training.prepare(df.withColumn("TransactionID", F.udf(count, T.StringType())("TransactionID"))).data
    assert data.count() == 300 and seen.value == 300


def test_boosted_search_runs_few_fits_of_a_large_table(spark, labelled, monkeypatch):
    from types import SimpleNamespace

    from riskspark.plans import extra

    cores = spark.sparkContext.defaultParallelism
    asked = []
    monkeypatch.setattr(models, "search", lambda *a, **k: asked.append((k["parallelism"], k["n_trials"])) or models.SearchResult({}, 0.5, None, [(0, {}, 0.5)]))
    for parts in (1, 2 * cores):
        data = labelled.withColumn("split", F.when(F.col("id") % 4 == 0, "val").otherwise("train")).repartition(parts)
        monkeypatch.setattr(extra, "trained", lambda *a: SimpleNamespace(prepared=SimpleNamespace(data=data, label="Fraud")))
        assert extra.m4_boosted_search(spark, "d").count() == 1
    assert asked == [(min(8, 2 * cores), 50), (2, 50)]


def test_predictions_by_day_compute_their_source_once(spark, monkeypatch):
    """Three runs write the table; the transactions' joins and windows run for the first only."""
    from types import SimpleNamespace

    from pyspark.sql import types as T

    from riskspark.plans import cases, extra, scoring

    seen, written = spark.sparkContext.accumulator(0), []

    def count(x):
        seen.add(1)
        return x

    rows = [(str(i), f"2024-01-0{1 + i % 3}", i / 30, int(i % 5 == 0)) for i in range(30)]
    df = spark.createDataFrame(rows, "id string, d string, FraudScore double, Fraud int")
    t = df.select(F.udf(count, T.StringType())("id").alias("TransactionID"), F.col("d").cast("timestamp_ntz").alias("TransactionDate"), "FraudScore", "Fraud")

    def write(tr, some, path):
        written.append(some.count())
        some.select("TransactionID", "FraudScore", F.lit("m").alias("ModelScores"), (F.col("FraudScore") > 0.5).cast("int").alias("FraudPrediction"),
                    F.col("TransactionDate").alias("Timestamp"), F.to_date("TransactionDate").alias("day")).write.mode("overwrite").parquet(path)

    monkeypatch.setattr(extra, "trained", lambda *a: SimpleNamespace(threshold=0.5))
    monkeypatch.setattr(cases.views, "transactions", lambda *a: t)
    monkeypatch.setattr(scoring, "write_predictions", write)
    got = cases.s5_predictions_by_day(spark, "d").collect()
    assert written == [30, 24, 30] and seen.value == 30
    assert sorted(r["rows"] for r in got) == [10, 10, 10] and all(r.against_cut == r.wrong_day == r.no_score == 0 for r in got)

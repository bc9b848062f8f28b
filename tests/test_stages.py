"""The library's MLlib stages in Pipeline, PipelineModel.save and TrainValidationSplit."""

import tempfile

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import functions as F

from riskspark.operators.stages import (IsolationForestClassifier, TransactionFeaturizer, TransactionPreprocessor,
                                        TransactionPreprocessorModel)
from riskspark.operators.transformers import Preprocessor, PreprocessorModel
from riskspark.sources import views
from tests.conftest import SMALL


def test_pipeline_of_own_and_mllib_stages_survives_saving(spark):
    t = views.transactions(spark, SMALL).withColumn("Fraud", F.col("Fraud").cast("double"))
    pipe = Pipeline(stages=[TransactionFeaturizer(), TransactionPreprocessor(excludedCols=["Fraud"]),
                            LogisticRegression(labelCol="Fraud", maxIter=5),
                            IsolationForestClassifier(numTrees=10, keyCol="TransactionID")])
    path = tempfile.mkdtemp(prefix="pipe-")
    pipe.write().overwrite().save(f"{path}/estimator")
    model = Pipeline.load(f"{path}/estimator").fit(t)
    model.write().overwrite().save(f"{path}/model")
    cols = ["TransactionID", "probability", "anomaly_score", "iso_prediction", "features"]
    a = model.transform(t).select(*cols).orderBy("TransactionID").collect()
    b = PipelineModel.load(f"{path}/model").transform(t).select(*cols).orderBy("TransactionID").collect()
    assert len(a) == t.count() and a == b
    # derived features reach the vector, ids and dates do not
    pre = model.stages[1]
    numeric = pre._values()["numeric"]
    assert "TransactionHour" in numeric and "HighValueTransaction" in numeric
    assert not {"TransactionID", "AccountID", "Fraud"} & set(numeric + pre._values()["categorical"])


def test_train_validation_split_searches_own_params(spark):
    t = views.transactions(spark, SMALL).withColumn("Fraud", F.col("Fraud").cast("double"))
    pre = TransactionPreprocessor(numericCols=["TransactionAmount"], categoricalCols=["Channel"])
    lr = LogisticRegression(labelCol="Fraud", maxIter=5)
    grid = ParamGridBuilder().addGrid(pre.categoricalCols, [["Channel"], ["Location"]]).addGrid(lr.regParam, [0.0, 0.1]).build()
    tvs = TrainValidationSplit(estimator=Pipeline(stages=[pre, lr]), estimatorParamMaps=grid, trainRatio=0.7, seed=1,
                               evaluator=BinaryClassificationEvaluator(labelCol="Fraud"), parallelism=2)
    out = tvs.fit(t)
    assert len(out.validationMetrics) == 4
    best = out.bestModel.stages[0]
    assert isinstance(best, TransactionPreprocessorModel) and len(best._values()["categorical"]) == 1


def test_one_hot_of_more_levels_than_any_list(spark):
    """20,000 levels, an unseen one, a missing one; numbers in the order of the values."""
    df = spark.range(40000).select((F.col("id") % 20000).cast("string").alias("c"),
                                   F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("d"),
                                   F.col("id").cast("double").alias("x"))
    fitted = Preprocessor(["x"], ["c", "d"]).fit(df)
    path = tempfile.mkdtemp(prefix="levels-")
    fitted.save(path)
    m = PreprocessorModel.load(spark, path)
    assert m.sizes == {"c": 20000, "d": 2}
    order = sorted(str(i) for i in range(20000))
    new = spark.createDataFrame([(1, "17", "b", 3.0), (2, "nope", None, None), (3, None, "zz", 1.0)], "id long, c string, d string, x double")
    got = {r.id: r.features for r in m.assemble(new, keep=["id"]).collect()}
    assert all(len(v) == 20003 for v in got.values())
    assert set(got[1].indices) - {0} == {1 + order.index("17"), 20002}
    assert set(got[2].indices) - {0} == {20001}          # unseen c: zeros; missing d: the mode 'a'
    assert set(got[3].indices) - {0} == {1}              # missing c: the mode '0'; unseen d: zeros
    try:
        m.transform(new)
    except ValueError as e:
        assert "assemble" in str(e)
    else:
        raise AssertionError("20,000 columns side by side")
    # sparse vectors equal the dense columns where both can be made
    small = Preprocessor(["x"], ["d"]).fit(df)
    dense = [list(r) for r in small.transform(new.orderBy("id").coalesce(1)).collect()]
    assert [list(r.features.toArray()) for r in small.assemble(new, keep=["id"]).orderBy("id").collect()] == dense

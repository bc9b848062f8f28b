"""The training run as Spark jobs.

clean (C1-C3) -> label check (C4) -> stratified split (P1) -> class check (P7) ->
features fitted on train (F1-F11) -> preprocessing fitted on train (X1-X7) ->
class weights (P6) -> forest, boosted trees, isolation forest (M1-M3) ->
ensemble weights and threshold on validation (S6-S8) -> test evaluation (S9, S10) ->
models and configuration saved (IO12).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators import clean, features, fusion, metrics, models, split, transformers, treewalk
from riskspark.session import ensure_checkpoint_dir
from riskspark.operators.iforest import IsolationForest, IsolationForestModel

MODEL_NAMES = ("random_forest", "xgboost", "isolation_forest")
ROWS_PER_TASK = 75_000  # rows of the training table in one task of a fit; fewer rows stay as they lie
LEAST_ROWS, MOST_ROWS = 10_000, 200_000  # in a task, where the tasks are whole rounds over the cores
SCORE_COLS = {"random_forest": "rf_score", "xgboost": "xgb_score", "isolation_forest": "iso_score"}


@dataclass
class Prepared:
    data: DataFrame  # key, label, split, weight, is_val, features
    feature_model: features.TransactionFeaturesModel
    preprocessor: transformers.PreprocessorModel
    key: str
    label: str


@dataclass
class Trained:
    prepared: Prepared
    forest: object
    boosted: object
    iforest: IsolationForestModel
    iso_bounds: tuple
    weights: dict = field(default_factory=lambda: dict(fusion.DEFAULT_WEIGHTS))
    threshold: float = fusion.DEFAULT_THRESHOLD


def spread(df: DataFrame, rows: int) -> DataFrame:
    """``df`` dealt evenly to tasks by its ``rows``. The table is small in bytes and long in rows, so AQE makes a few
    partitions of it, and every pass of every fit would use no more cores than that.

    The tasks are whole rounds over the cores, of at most ``MOST_ROWS`` each: a fit runs hundreds of short stages, which wait for
    their last task, and each task sends the statistics of all nodes. Where that leaves a task under ``LEAST_ROWS``, there
    is one per ``ROWS_PER_TASK``."""
    if rows <= ROWS_PER_TASK:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    rounds = cores * math.ceil(rows / (cores * MOST_ROWS))
    return df.repartition(rounds if rows >= LEAST_ROWS * rounds else math.ceil(rows / ROWS_PER_TASK))


def prepare(df: DataFrame, label: str = "Fraud", key: str = "TransactionID", seed: int = 42,
            oversample: bool = False) -> Prepared:
    """C1-C4, P1, P7, F1-F11 and X1-X7 fitted on the training split; with ``oversample``
    the training rows are brought to class parity by P4 before the weights (P6)."""
    ensure_checkpoint_dir(df.sparkSession)
    # the joins and windows behind the transactions run once, and so does the de-duplication: every statistic below reads them
    cleaned = clean.clean_data(df.checkpoint(eager=True), label).checkpoint(eager=True)
    cleaned = clean.validate_labels(cleaned, label)
    # the split feeds several fits: cut the lineage once into the shared checkpoint folder
    splitted = split.stratified_split(cleaned, label, key, seed).checkpoint(eager=True)
    split.class_check(splitted, label, raise_on_single=True)
    train = splitted.where(F.col("split") == "train")
    fm = features.TransactionFeatures(keep=(key,)).fit(train)
    feat = fm.transform(splitted)
    drop = {key, label, "split"}
    numeric, categorical = clean.column_kinds(clean.drop_id_by_rule(feat.drop(*drop)))
    pre = transformers.Preprocessor(numeric, categorical).fit(feat.where(F.col("split") == "train"))
    assembled = pre.assemble(feat, keep=[key, label, "split"])
    if oversample:
        from riskspark.operators.balance import oversample as smote

        train_rows = smote(assembled.where(F.col("split") == "train"), key, "features", label, seed=seed)
        train_rows = train_rows.withColumn("split", F.lit("train"))  # synthetic rows belong to train
        rest = assembled.where(F.col("split") != "train").withColumn("synthetic", F.lit(False))
        assembled = train_rows.unionByName(rest)
    weighted = split.with_weights(assembled, label, fit_on=F.col("split") == "train").withColumn("is_val", F.col("split") == "val")
    # every fit, search trial and evaluation reads this table: cut its lineage once
    return Prepared(spread(weighted, splitted.count()).checkpoint(eager=True), fm, pre, key, label)


def fit_forest(prep: Prepared, n_trees: int = 100):
    """M1 on the training split. The fit keeps the node of every row and tree, instead of walking all rows from the roots again
    for each level; the forest is the same."""
    return models.random_forest(label_col=prep.label, numTrees=n_trees, cacheNodeIds=True).fit(prep.data.where(F.col("split") == "train"))


def fit_boosted(prep: Prepared):
    """M2 on the training split; its rounds stop by the val split."""
    d = prep.data
    return models.fit_with_patience(models.boosted_trees(label_col=prep.label, validation_col=None), d.where(F.col("split") == "train"),
                                    d.where(F.col("split") == "val"), prep.label)


def fit_isolation(prep: Prepared, n_trees: int = 100, contamination: float = 0.05, seed: int = 42) -> IsolationForestModel:
    """M3 on the training split."""
    forest = IsolationForest(n_trees=n_trees, contamination=contamination, seed=seed, key_col=prep.key)
    return forest.fit(prep.data.where(F.col("split") == "train"))


def fit_models(prep: Prepared, n_trees: int = 100, contamination: float = 0.05, seed: int = 42) -> Trained:
    """M1-M3 on the training split."""
    iforest = fit_isolation(prep, n_trees, contamination, seed)
    return Trained(prep, fit_forest(prep, n_trees), fit_boosted(prep), iforest, iforest.score_bounds)


def score(tr: Trained, df: DataFrame) -> DataFrame:
    """Per-model scores: forest and boosted class-1 probability, isolation score
    min-max scaled with the stored training bounds (clipped)."""
    out = treewalk.forest_scores(tr.forest, tr.forest.transform(df), "rf_score", "rf_prediction")
    out = tr.boosted.transform(out)
    out = models.positive_probability(out, "xgb_probability", "xgb_score")
    out = tr.iforest.transform(out)
    return fusion.minmax_fitted(out, "anomaly_score", "iso_score", tr.iso_bounds[0], tr.iso_bounds[1])


def build_ensemble(tr: Trained, weights: dict | None = None, threshold: float | None = None,
                   optimize: bool = True) -> Trained:
    """Given > optimised on validation (S6, S7) > default."""
    val = score(tr, tr.prepared.data.where(F.col("split") == "val"))
    if optimize and (weights is None or threshold is None):  # scored once for both searches
        val = val.select(*SCORE_COLS.values(), tr.prepared.label).checkpoint(eager=True)
    if weights is None and optimize:
        best = fusion.weight_search(val, "rf_score", "xgb_score", "iso_score", tr.prepared.label).where("is_best").first()
        weights = {"random_forest": best["w_rf"], "xgboost": best["w_xgb"], "isolation_forest": best["w_if"]} \
            if best is not None else None
    tr.weights = weights or dict(fusion.DEFAULT_WEIGHTS)
    if threshold is None and optimize:
        fused = fusion.fuse_scores(val, SCORE_COLS, tr.weights)
        threshold = fusion.optimal_threshold(fused, "FraudScore", tr.prepared.label).first()["threshold"]
    tr.threshold = threshold if threshold is not None else fusion.DEFAULT_THRESHOLD
    return tr


def predict(tr: Trained, df: DataFrame) -> DataFrame:
    """S3-S5 with the ensemble's weights and threshold."""
    return fusion.fuse_scores(score(tr, df), SCORE_COLS, tr.weights, tr.threshold, id_col=tr.prepared.key)


def evaluate_models(tr: Trained, split_name: str = "test") -> DataFrame:
    """Per-model metrics; the isolation forest uses its scaled score and cut 0.8."""
    d = score(tr, tr.prepared.data.where(F.col("split") == split_name))
    y = tr.prepared.label
    rows = d.select(
        y,
        F.explode(F.array(
            F.struct(F.lit("random_forest").alias("model"), F.col("rf_score").alias("s"),
                     F.col("rf_prediction").cast("int").alias("pred")),
            F.struct(F.lit("xgboost").alias("model"), F.col("xgb_score").alias("s"),
                     F.col("xgb_prediction").cast("int").alias("pred")),
            F.struct(F.lit("isolation_forest").alias("model"), F.col("iso_score").alias("s"),
                     fusion.decide(F.col("iso_score"), 0.8).alias("pred")),
        )).alias("m"),
    ).select("m.model", "m.s", "m.pred", y)
    conf = metrics.confusion(rows, y, "pred", ["model"])
    auc = metrics.roc_auc(rows, y, "s", ["model"])
    return conf.join(auc, "model").select("model", "accuracy", "precision", "recall", "f1_score", "roc_auc")


def evaluate_ensemble(tr: Trained, split_name: str = "test") -> DataFrame:
    """Ensemble metrics on a split."""
    d = predict(tr, tr.prepared.data.where(F.col("split") == split_name))
    return metrics.performance_metrics(d, tr.prepared.label, "FraudPrediction", "FraudScore")


def as_pipeline(tr: Trained):
    """The ensemble as one MLlib ``PipelineModel`` over raw transactions: features, preprocessing, the three models and
    their fusion. ``PipelineModel.save`` and ``load`` keep all of it."""
    from pyspark.ml import PipelineModel

    from riskspark.operators import stages

    featurizer = stages.TransactionFeaturizerModel()._with(tr.prepared.feature_model.state())
    return PipelineModel([featurizer, stages.TransactionPreprocessorModel.of(tr.prepared.preprocessor), tr.forest, tr.boosted,
                          stages.IsolationForestClassifierModel.of(tr.iforest), stages.ScoreFusion.of(tr.weights, tr.threshold, tr.iso_bounds)])


def save(tr: Trained, spark: SparkSession, base: str, version: str) -> str:
    """IO12: the whole ensemble under ``base``: three models, the fitted feature statistics and
    preprocessor, and the configuration row."""
    from riskspark.sources import io

    path = f"{base}/models/{version}"
    io.save_model(tr.forest, f"{path}/random_forest")
    io.save_model(tr.boosted, f"{path}/xgboost")
    tr.iforest.save(spark, f"{path}/isolation_forest")
    io.save_state(spark, f"{path}/pipeline", {
        "key": tr.prepared.key, "label": tr.prepared.label,
        "features": tr.prepared.feature_model.state()})
    tr.prepared.preprocessor.save(f"{path}/preprocessor")
    io.save_ensemble_config(spark, f"{base}/ensemble", version, tr.weights, tr.threshold, tr.iso_bounds, path)
    return path


def load(spark: SparkSession, base: str) -> Trained:
    """IO12: the newest saved ensemble, made of new objects; it has no training data (``prepared.data`` is None)."""
    from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel

    from riskspark.sources import io

    cfg = io.load_latest_config(spark, f"{base}/ensemble")
    path = cfg["model_path"]
    state = io.load_state(spark, f"{path}/pipeline")
    prepared = Prepared(None, features.TransactionFeaturesModel.from_state(state["features"]),
                        transformers.PreprocessorModel.load(spark, f"{path}/preprocessor"), state["key"], state["label"])
    return Trained(prepared, RandomForestClassificationModel.load(f"{path}/random_forest"),
                   GBTClassificationModel.load(f"{path}/xgboost"),
                   IsolationForestModel.load(spark, f"{path}/isolation_forest"),
                   (cfg["iso_min"], cfg["iso_max"]), dict(cfg["weights"]), cfg["threshold"])


def score_transactions(tr: Trained, transactions: DataFrame) -> DataFrame:
    """S3-S5 of raw transactions: fitted features, preprocessing, three models, fusion."""
    prep = tr.prepared
    return predict(tr, prep.preprocessor.assemble(prep.feature_model.transform(transactions), keep=[prep.key]))


def run_training(df: DataFrame, optimize: bool = False, n_trees: int = 100, oversample: bool = False) -> Trained:
    """M5: prepare, fit all models, build the ensemble."""
    prep = prepare(df, oversample=oversample)
    tr = fit_models(prep, n_trees=n_trees)
    return build_ensemble(tr, optimize=optimize)

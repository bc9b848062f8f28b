"""Edge cases on tiny frames."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from riskspark.functions.time import time_period
from riskspark.operators import clean, drift, features, fusion, metrics, split, transformers


def ts(h, d=1):
    return dt.datetime(2024, 1, d, h, 0, 0)


def test_time_period_bins_are_right_closed(spark):
    df = spark.createDataFrame([(ts(h),) for h in (0, 1, 6, 7, 12, 13, 18, 19, 23)], "t timestamp_ntz")
    got = [r[0] for r in df.select(time_period("t")).collect()]
    assert got == [None, "Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening"]
    got2 = [r[0] for r in df.select(time_period("t", midnight_as_night=True)).collect()]
    assert got2[0] == "Night"


def test_weekday_monday_zero_and_weekend(spark):
    # 2024-01-06 is a Saturday, 2024-01-08 a Monday
    df = spark.createDataFrame([(ts(10, 6),), (ts(10, 8),)], "TransactionDate timestamp_ntz")
    out = features.batch_features(df.withColumn("TransactionID", F.lit("x")), keep=("TransactionID",)).collect()
    assert [r["TransactionDayOfWeek"] for r in out] == [5, 0]
    assert [r["IsWeekend"] for r in out] == [1, 0]


def test_gap_negative_clipped_and_nulls_filled_with_median_before_clip(spark):
    rows = [("a", ts(10), ts(4)), ("b", ts(10), ts(12)), ("c", ts(10), None), ("d", ts(10), ts(9))]
    df = spark.createDataFrame(rows, "TransactionID string, TransactionDate timestamp_ntz, PreviousTransactionDate timestamp_ntz")
    out = {r["TransactionID"]: r for r in features.batch_features(df).collect()}
    # raw gaps 6, -2, null, 1 -> median of (6, -2, 1) = 1 (before clipping)
    assert out["b"]["HoursSincePreviousTransaction"] == 0.0
    assert out["c"]["HoursSincePreviousTransaction"] == 1.0
    assert out["a"]["HoursSincePreviousTransaction"] == 6.0


def test_ratio_zero_and_null_balance_and_nan_amount(spark):
    rows = [("a", 10.0, 0.0), ("b", 10.0, None), ("c", float("nan"), 5.0), ("d", 10.0, 4.0)]
    df = spark.createDataFrame(rows, "TransactionID string, TransactionAmount double, AccountBalance double")
    out = {r["TransactionID"]: r for r in features.batch_features(df).collect()}
    assert out["a"]["TransactionToBalanceRatio"] == 0.0
    assert out["b"]["TransactionToBalanceRatio"] == 0.0
    assert out["c"]["TransactionToBalanceRatio"] == 0.0
    assert out["d"]["TransactionToBalanceRatio"] == 2.5
    assert out["c"]["HighValueTransaction"] == 0  # NaN is not high-value (pandas semantics)


def test_high_value_uses_interpolated_quantile(spark):
    df = spark.createDataFrame([(str(i), float(i), 1.0) for i in range(1, 11)],
                               "TransactionID string, TransactionAmount double, AccountBalance double")
    out = features.batch_features(df).where("HighValueTransaction = 1").collect()
    # 0.9 quantile of 1..10 with interpolation = 9.1 -> only 10 is above
    assert [r["TransactionID"] for r in out] == ["10"]


def test_mode_tie_goes_to_smallest_and_all_null_is_unknown(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)], "c string, z string")
    out = clean.fill_missing(df, label=None).collect()
    assert [r["c"] for r in out] == ["b", "a", "b", "a", "a"]
    assert all(r["z"] == "Unknown" for r in out)


def test_median_fill_even_count(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (20.0,), (None,)], "v double")
    out = [r["v"] for r in clean.fill_missing(df, label=None).collect()]
    assert out[-1] == 6.0


def test_label_validation_rejects_fractional_labels(spark):
    df = spark.createDataFrame([(0.0,), (0.4434862909781083,), (1.0,)], "Fraud double")
    with pytest.raises(ValueError):
        clean.validate_labels(df)


def test_unseen_category_is_all_zeros_and_zero_variance_is_zero(spark):
    train = spark.createDataFrame([("a", 3.0), ("b", 3.0)], "cat string, num double")
    test = spark.createDataFrame([("zzz", 3.0), (None, None)], "cat string, num double")
    model = transformers.Preprocessor(["num"], ["cat"]).fit(train)
    out = model.transform(test).collect()
    assert out[0]["cat_a"] == 0.0 and out[0]["cat_b"] == 0.0
    assert out[1]["cat_a"] == 1.0  # null filled with the mode ('a' wins the tie)
    assert out[0]["num"] == 0.0 and out[1]["num"] == 0.0


def test_auc_ties_and_one_class(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "Fraud int, FraudScore double")
    assert metrics.roc_auc(df).first()["roc_auc"] == pytest.approx(0.875)
    one = spark.createDataFrame([(1, 0.5), (1, 0.7)], "Fraud int, FraudScore double")
    assert metrics.roc_auc(one).first()["roc_auc"] is None


def test_confusion_on_one_class_batch_and_empty_input(spark):
    df = spark.createDataFrame([(0, 0), (0, 1)], "Fraud int, FraudPrediction int")
    r = metrics.confusion(df).first()
    assert (r["true_positives"], r["false_negatives"], r["precision"], r["recall"]) == (0, 0, 0.0, 0.0)
    empty = spark.createDataFrame([], "Fraud int, FraudPrediction int, FraudScore double")
    r = metrics.performance_metrics(empty).first()
    assert r["sample_size"] == 0 and r["roc_auc"] is None


def test_threshold_is_strict_and_nan_score_is_null(spark):
    df = spark.createDataFrame([(0.5,), (0.5000001,), (float("nan"),)], "s double")
    got = [r[0] for r in df.select(fusion.decide(F.col("s"), 0.5)).collect()]
    assert got == [0, 1, None]


def test_weight_grid_has_21_points():
    g = fusion.weight_grid()
    assert len(g) == 21 and (0, 0.1, 0.39999999999999997, 0.5) == g[0]


def test_optimal_threshold_first_maximum(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.7), (1, 0.6), (0, 0.1)], "Fraud int, s double")
    r = fusion.optimal_threshold(df, "s").first()
    # thresholds 0.6 (tp 3, fp 1) gives F1 0.857; 0.8 (tp 2, fp 0) gives 0.8
    assert r["threshold"] == 0.6 and r["f1"] == pytest.approx(2 * 0.75 * 1.0 / (1.75 + 1e-10))


def test_constant_drift_column_is_skipped_and_ks_value(spark):
    ref = spark.createDataFrame([(float(i), 1.0) for i in range(10)], "a double, const double")
    cur = spark.createDataFrame([(float(i) + 5, 1.0) for i in range(10)], "a double, const double")
    out = drift.ks_drift(ref, cur, ["a", "const"]).collect()
    assert [r["feature"] for r in out] == ["a"]
    assert out[0]["ks_statistic"] == pytest.approx(0.5) and out[0]["drift_detected"]
    assert 0.0 <= out[0]["p_value"] <= 1.0


def test_split_allocation_reproduces_reference_fixture():
    sizes = split.allocate({0: 2461, 1: 51})
    assert sizes[1] == (36, 5, 10)
    assert sum(s[0] for s in sizes.values()) == 1758
    assert sum(s[1] for s in sizes.values()) == 248
    assert sum(s[2] for s in sizes.values()) == 506


def test_lookback_from_midnight(spark):
    df = spark.createDataFrame([(ts(0, 23),), (ts(23, 22),)], "Timestamp timestamp_ntz")
    assert clean.lookback(df, "2024-01-30", 7).count() == 1


def test_empty_input_features(spark):
    df = spark.createDataFrame([], "TransactionID string, TransactionDate timestamp_ntz, TransactionAmount double")
    out = features.batch_features(df)
    assert out.count() == 0 and "TransactionHour" not in out.columns  # all-null date column skipped


def test_nan_is_not_a_median_value(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (3.0,)], "v double")
    from riskspark.operators.cumulative import exact_medians

    assert exact_medians(df, ["v"])["v"] == 2.0
    assert not math.isnan(exact_medians(df, ["v"])["v"])


def test_approximate_medians_close_to_exact(spark):
    from riskspark.operators.cumulative import medians

    df = spark.range(0, 10001).select(F.col("id").cast("double").alias("v"))
    assert medians(df, ["v"], exact=True)["v"] == 5000.0
    assert abs(medians(df, ["v"], exact=False)["v"] - 5000.0) <= 2.0


def test_binned_auc_is_close_and_confusion_exact(spark):
    df = spark.range(0, 5000).select(
        ((F.col("id") * 7919) % 1000 / 1000.0 + F.col("id") / 1e7).alias("FraudScore"),
        (F.col("id") % 3 == 0).cast("int").alias("Fraud"),
        (F.col("id") % 5 == 0).cast("int").alias("FraudPrediction"),
    )
    exact = metrics.performance_metrics(df).first()
    binned = metrics.performance_metrics(df, score_decimals=2).first()
    assert abs(exact["roc_auc"] - binned["roc_auc"]) < 0.01
    assert exact["true_positives"] == binned["true_positives"]


def test_split_sizes_of_billions_of_rows():
    from riskspark.operators.split import allocate

    got = allocate({0: 9_900_000_000, 1: 100_000_000})
    assert all(min(v) > 0 for v in got.values())
    assert [sum(v) for v in got.values()] == [9_900_000_000, 100_000_000]
    assert abs(got[0][0] - 0.7 * 9_900_000_000) <= 1


def test_auc_of_billions_of_rows(spark):
    from riskspark.operators.metrics import auc_from_counts

    n = 5_000_000_000
    df = spark.createDataFrame([(0.1, 0, 2 * n), (0.5, n // 2, n), (0.9, n // 2, 0)], "_s double, _pos long, _neg long")
    assert auc_from_counts(df).first()["roc_auc"] == pytest.approx((0.5 * (2 + 0.5) + 0.5 * 3) / 3)


def test_neighbours_with_a_far_outlier(spark):
    from riskspark.operators.balance import minority_neighbors

    rows = [(f"k{i:03d}", [float(i % 10), float(i // 10)], 1) for i in range(100)] + [("out", [1e6, 1e6], 1)]
    df = spark.createDataFrame(rows, "id string, x array<double>, Fraud int")
    got = {}
    for r in minority_neighbors(df, "id", "x", k=3).collect():
        got.setdefault(r.id, []).append((r.neighbor_rank, r.neighbor))
    d2 = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    for k, x, _ in rows:
        want = sorted((d2(x, y), j) for j, y, _ in rows if j != k)[:3]
        assert [j for _, j in sorted(got[k])] == [j for _, j in want]


def test_weights_are_fitted_on_the_rows_named(spark):
    from riskspark.operators.split import with_weights

    df = spark.createDataFrame([("train", 0), ("train", 0), ("train", 1), ("test", 1), ("test", 1)], "split string, Fraud int")
    got = {(r.split, r.Fraud): r.weight for r in with_weights(df, fit_on=F.col("split") == "train").collect()}
    assert got == {("train", 0): 0.75, ("train", 1): 1.5, ("test", 1): 1.5}

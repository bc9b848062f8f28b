"""The skew-safe paths equal the plain single-window answers, and results do not
depend on partitioning (SURVEY 5.4)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskspark.operators.cumulative import ordered_cumsum
from riskspark.sources.previous import FAN, MAX_CUTS, _cut_bound, previous_in_order
from tests.conftest import MEDIUM


def test_previous_in_order_hot_key_slicing_matches_window(spark):
    ev = spark.read.parquet(f"{MEDIUM}/events.parquet")
    # make user 0 a hot key holding about a third of all rows
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    got = previous_in_order(hot, "user_id", "ts", "event_id", "prev", rows_per_slice=200)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = hot.withColumn("prev", F.lag("ts").over(w))
    diff = got.select("event_id", "prev").exceptAll(want.select("event_id", "prev"))
    assert diff.count() == 0
    assert got.count() == want.count()


@pytest.mark.parametrize("max_cuts, levels", [(5, 1), (63, 1), (64, 2), (4095, 2), (4096, 3)])
def test_previous_in_order_has_the_levels_its_cuts_need(spark, max_cuts, levels):
    """Few and many cuts, up to thousands of slices of one key: same as the plain window, no level without a use."""
    hot = spark.range(0, 6000).select(F.col("id").alias("i"), (F.col("id") % 3 * F.pmod(F.hash("id"), F.lit(5))).alias("k"),
                                      F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(10**9))).alias("ts"))
    got = previous_in_order(hot, "k", "ts", "i", "prev", rows_per_slice=4, max_cuts=max_cuts)
    want = hot.withColumn("prev", F.lag("ts").over(Window.partitionBy("k").orderBy("ts", "i")))
    assert got.select("i", "prev").exceptAll(want.select("i", "prev")).count() == 0 and got.count() == want.count()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_cuts") and sum(f"_cuts{n}" in plan for n in range(3)) == levels


def test_previous_in_order_sizes_its_levels_from_the_files(spark):
    ev = spark.read.parquet(f"{MEDIUM}/events.parquet")
    assert _cut_bound(ev, 2_000_000) == FAN - 1
    assert FAN <= _cut_bound(ev, 50) < MAX_CUTS
    assert _cut_bound(spark.createDataFrame(ev.limit(9).rdd, ev.schema), 2_000_000) == MAX_CUTS


@pytest.mark.parametrize("buckets", [1, 7, 64, 1024])
def test_ordered_cumsum_matches_window(spark, buckets):
    df = spark.range(0, 3000).select((F.col("id") % 997).cast("double").alias("v"), (F.col("id") % 5).alias("g"))
    agg = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c"))
    got = ordered_cumsum(agg, "v", ["c"], ["g"], buckets=buckets).select("g", "v", "c_before")
    w = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    want = agg.select("g", "v", F.coalesce(F.sum("c").over(w), F.lit(0)).alias("c_before"))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_ordered_cumsum_descending(spark):
    df = spark.createDataFrame([(float(v), 1) for v in (5, 3, 9, 1)], "v double, c int")
    got = {r["v"]: r["c_before"] for r in ordered_cumsum(df, "v", ["c"], descending=True, buckets=2).collect()}
    assert got == {9.0: 0, 5.0: 1, 3.0: 2, 1.0: 3}


@pytest.mark.parametrize("name", ["v8_performance_metrics", "p1_stratified_split", "d3_d5_ks_drift", "s7_optimal_threshold"])
def test_independent_of_shuffle_partitions(spark, name):
    import __spark_entry__ as entry

    fn = entry.queries()[name]
    results = []
    for n in (1, 4, 16):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        results.append(sorted(map(tuple, fn(spark, "/root/testdata/sf0.001").collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]


@pytest.mark.parametrize("buckets", [3, 16, 256])
def test_ordered_cumsum_single_cut_array_matches_window(spark, buckets):
    df = spark.range(0, 2000).select(((F.col("id") * 7919 % 2000) - 1000.5).alias("v"), (F.col("id") % 4).alias("c"))
    got = ordered_cumsum(df, "v", ["c"], buckets=buckets).select("v", "c_before", "c_upto")
    w = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("c_before", F.coalesce(F.sum("c").over(w), F.lit(0))).select(
        "v", "c_before", (F.col("c_before") + F.col("c")).alias("c_upto"))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_previous_in_order_splits_a_burst(spark):
    """A hot key whose rows mostly fall into one short burst: cuts follow the row counts."""
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        if i % 10 == 0:  # spread over a year
            t = base + dt.timedelta(hours=3 * i)
        else:            # a burst within one hour
            t = base + dt.timedelta(days=100, microseconds=1_000_000 * i)
        rows.append((i, 0, t))
    rows += [(10_000 + i, 1 + i % 7, base + dt.timedelta(minutes=i)) for i in range(500)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz")
    got = previous_in_order(df, "user_id", "ts", "event_id", "prev", rows_per_slice=200)
    want = df.withColumn("prev", F.lag("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    assert got.select("event_id", "prev").exceptAll(want.select("event_id", "prev")).count() == 0
    assert got.count() == want.count()


def test_previous_in_order_null_keys_and_one_timestamp(spark):
    """A third of null keys, a hot key at one timestamp: same as the plain window."""
    ev = spark.read.parquet(f"{MEDIUM}/events.parquet")
    key = F.when(F.col("event_id") % 3 == 0, F.lit(None)).when(F.col("event_id") % 3 == 1, F.lit(0)).otherwise(F.col("user_id"))
    ts = F.when(F.col("event_id") % 3 == 1, F.lit("2024-01-01").cast("timestamp_ntz")).otherwise(F.col("ts"))
    hot = ev.withColumn("user_id", key).withColumn("ts", ts)
    got = previous_in_order(hot, "user_id", "ts", "event_id", "prev", value="event_id", rows_per_slice=20, first_flag="first")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = hot.withColumn("prev", F.lag("event_id").over(w)).withColumn("first", F.row_number().over(w) == 1)
    cols = ["event_id", "prev", "first"]
    rows = got.select(cols).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, want.select(cols).collect()), key=str)


def test_exact_quantiles_with_brackets(spark):
    """Brackets in force (few probes), ties, nulls, NaN and infinities: equal to Spark's exact percentile."""
    from riskspark.operators.cumulative import exact_quantiles

    x = F.when(F.col("id") % 7 == 0, F.lit(5.0)).when(F.col("id") % 11 == 0, F.lit(None)).when(F.col("id") == 5, F.lit(float("inf"))) \
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(100_000)) / 10.0)
    df = spark.range(20_000).select(x.alias("a"), (F.col("id") / 3.0).alias("b"), F.lit(None).cast("double").alias("c"))
    qs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, ["a", "b", "c"], qs, accuracy=100)
    for c in "abc":
        want = df.agg(F.percentile(c, qs)).first()[0]
        for q, v in zip(qs, want or [None] * len(qs)):
            assert got[(c, q)] == (v if v is None else pytest.approx(v, rel=1e-12)), (c, q)

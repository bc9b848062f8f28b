"""Scale experiment for the exact AUC: a plain global window vs range-cut prefix sums.

Derives 4M scored rows from the events table (a third of them sharing one score) and
computes the exact AUC twice: with one global window over the distinct scores (what
``Window.orderBy(score)`` gives: a single task) and with ``metrics.roc_auc`` forced to
``--buckets`` ranges. Prints both values and, from the event log, the largest and median
task of each window stage.

usage: python scripts/auc_scale_check.py EVENTLOG_DIR [sf_dir] [copies] [buckets]
"""

from __future__ import annotations

import glob
import json
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from riskspark.operators.metrics import roc_auc  # noqa: E402
from riskspark.session import local_session  # noqa: E402


def plain_auc(df):
    by = df.groupBy("s").agg(F.sum("y").alias("pos"), F.sum(F.lit(1) - F.col("y")).alias("neg"))
    w = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    cum = by.withColumn("nb", F.coalesce(F.sum("neg").over(w), F.lit(0)))
    return cum.agg((F.sum(F.col("pos") * (F.col("nb") + F.col("neg") / 2.0)) / (F.sum("pos") * F.sum("neg"))).alias("auc"))


def main() -> None:
    log_dir = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    copies = int(sys.argv[3]) if len(sys.argv) > 3 else 40
    buckets = int(sys.argv[4]) if len(sys.argv) > 4 else 32
    spark = local_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false",
                                 "spark.sql.shuffle.partitions": "32"})
    sc = spark.sparkContext
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "value", "event_type")
    rows = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("r")).select(
        F.when((F.col("event_id") * copies + F.col("r")) % 3 == 0, F.lit(0.5))
        .otherwise(F.col("value") / (F.col("value") + 50.0) + F.col("r") * 1e-9).alias("s"),
        (F.col("event_type") == "error").cast("int").alias("y"),
    )
    path = f"{log_dir}/scored"
    rows.write.mode("overwrite").parquet(path)
    df = spark.read.parquet(path)
    print(f"rows={df.count()} distinct_scores={df.select('s').distinct().count()}")
    out = {}
    for name in ("global_window", "range_cut"):
        sc.setJobGroup(name, name)
        t0 = time.time()
        v = plain_auc(df).first()[0] if name == "global_window" else roc_auc(df, "y", "s", buckets=buckets).first()[0]
        out[name] = (v, time.time() - t0, sc.statusTracker().getJobIdsForGroup(name))
    app = sc.applicationId
    spark.stop()
    log = [p for p in glob.glob(f"{log_dir}/*") if app in p][0]
    stage_jobs, tasks = {}, {}
    for line in open(log):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart":
            for s in e["Stage IDs"]:
                stage_jobs[s] = e["Job ID"]
        elif e["Event"] == "SparkListenerTaskEnd" and "Task Metrics" in e:
            m = e["Task Metrics"]
            tasks.setdefault(e["Stage ID"], []).append(
                (m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0), m.get("Executor Run Time", 0)))
    for name, (v, secs, jobs) in out.items():
        print(f"{name}: auc={v:.12f} {secs:.1f} s")
        for stage, ts in sorted(tasks.items()):
            recs = [r for r, _ in ts]
            if stage_jobs.get(stage) in jobs and max(recs) > 1000:
                run = [t for _, t in ts]
                print(f"  stage {stage}: tasks={len(ts)} max_records={max(recs)} median_records={int(statistics.median(recs))} "
                      f"max_ms={max(run)} median_ms={int(statistics.median(run))}")


if __name__ == "__main__":
    main()

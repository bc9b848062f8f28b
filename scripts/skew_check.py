"""Skew experiment for W1: one account holding a third of all rows.

Derives a larger events table from the given one (each event repeated ``--copies``
times with new ids and shifted times; every third row moved to account 0), then runs
the plain ``lag`` window and ``previous_in_order`` and reports, from Spark's event log,
the largest and median task (shuffle records read, run time) of each window stage.
Both results are compared for equality.

usage: python scripts/skew_check.py EVENTLOG_DIR [sf_dir] [copies] [rows_per_slice]
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

from riskspark.session import local_session  # noqa: E402
from riskspark.sources.previous import previous_in_order  # noqa: E402


def main() -> None:
    log_dir = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    copies = int(sys.argv[3]) if len(sys.argv) > 3 else 40
    per_slice = int(sys.argv[4]) if len(sys.argv) > 4 else 100_000
    spark = local_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false",
                                 "spark.sql.shuffle.partitions": "32"})
    sc = spark.sparkContext
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id")
    big = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("r")).select(
        (F.col("event_id") * copies + F.col("r")).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("r").cast("decimal(8,6)"))).alias("ts"),
        F.when((F.col("event_id") * copies + F.col("r")) % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("user_id"),
    )
    path = f"{log_dir}/big_events"
    big.write.mode("overwrite").parquet(path)
    big = spark.read.parquet(path)
    n = big.count()
    hot = big.where("user_id = 0").count()
    print(f"rows={n} hot_account_rows={hot} ({hot / n:.1%})")

    results = {}
    for name in ("plain_window", "sliced"):
        sc.setJobGroup(name, name)
        t0 = time.time()
        if name == "plain_window":
            out = big.withColumn("prev", F.lag("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
        else:
            out = previous_in_order(big, "user_id", "ts", "event_id", "prev", rows_per_slice=per_slice)
        res = out.select("event_id", "prev")
        res.write.mode("overwrite").parquet(f"{log_dir}/{name}")
        results[name] = (time.time() - t0, sc.statusTracker().getJobIdsForGroup(name))
    a = spark.read.parquet(f"{log_dir}/plain_window")
    b = spark.read.parquet(f"{log_dir}/sliced")
    print("equal:", a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0)
    app = sc.applicationId
    spark.stop()

    # event log: per stage, the tasks' shuffle records read and run times
    log = [p for p in glob.glob(f"{log_dir}/*") if app in p][0]
    files = sorted(glob.glob(f"{log}/events_*")) if Path(log).is_dir() else [log]
    lines = (line for f in files for line in open(f))
    stage_jobs, tasks = {}, {}
    for line in lines:
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart":
            for s in e["Stage IDs"]:
                stage_jobs[s] = e["Job ID"]
        elif e["Event"] == "SparkListenerTaskEnd" and "Task Metrics" in e:
            m = e["Task Metrics"]
            recs = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            tasks.setdefault(e["Stage ID"], []).append((recs, m.get("Executor Run Time", 0)))
    for name, (secs, jobs) in results.items():
        print(f"{name}: {secs:.1f} s")
        for stage, ts in sorted(tasks.items()):
            if stage_jobs.get(stage) in jobs and len(ts) > 1:
                recs = [r for r, _ in ts]
                if max(recs) == 0:
                    continue
                run = [t for _, t in ts]
                print(f"  stage {stage}: tasks={len(ts)} max_records={max(recs)} median_records={int(statistics.median(recs))} "
                      f"max_ms={max(run)} median_ms={int(statistics.median(run))}")


if __name__ == "__main__":
    main()

"""IO1-IO12: file sources and sinks.

All writes go under a caller-given base path; on a cluster that is shared storage
(the library's scratch helper derives it from ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators.clean import normalize_column_names, parse_dates_lenient
from riskspark.schema import ENSEMBLE_CONFIG, FEEDBACK

# JSON text keeps microseconds (Spark's default NTZ format stops at milliseconds)
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_transactions_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """IO1 + IO2 + IO3: CSV with header, explicit schema (inference only if none is
    given), names normalised, date text parsed leniently."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return parse_dates_lenient(normalize_column_names(reader.csv(path)))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=()) -> None:
    """IO5: replace a table (overwrite)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """A table in ``buckets`` files by the hash of ``key``, each sorted by it. Tables with the same key and number of
    buckets join without a shuffle. The files go to ``path`` on shared storage, the catalog knows the layout.

    A key that holds very many rows makes a large bucket; it is meant for unique keys such as transaction ids."""
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def fingerprint(spark: SparkSession, path: str) -> tuple:
    """(path, bytes, newest change) of a file or folder: other input, other fingerprint."""
    fs, p = _fs(spark, path)
    files = [st for st in fs.listStatus(p) if not st.isDirectory()]
    return path, sum(st.getLen() for st in files), max((st.getModificationTime() for st in files), default=0)


def list_versions(spark: SparkSession, base: str) -> list[str]:
    """Published versions under ``base``, oldest name first (a directory listing, no scan).

    A version counts once its marker ``_versions/<version>`` is there, which is created after all its data; a version
    that is being written, or whose writer failed, has none.
    """
    fs, p = _fs(spark, f"{base}/_versions")
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def publish(spark: SparkSession, base: str, version: str, write) -> None:
    """Run ``write()``, which writes the data of ``version`` under ``base``, and then create its marker.

    The marker of an older form of the version goes first, so readers fall back to the version before while it is
    replaced. Creating the (empty) marker file is one atomic step on HDFS and on object stores.
    """
    if not version or "/" in version or version[0] in "._":
        raise ValueError(f"not a version name: {version!r}")
    fs, marker = _fs(spark, f"{base}/_versions/{version}")
    fs.delete(marker, False)
    write()
    fs.create(marker, True).close()


def write_versioned(df: DataFrame, base: str, version: str) -> None:
    """IO7: one dataset version, partitioned by split, published when it is complete. Other versions are
    untouched (dynamic partition overwrite)."""
    publish(df.sparkSession, base, version, lambda: (
        df.withColumn("version", F.lit(version))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("version", "split")
        .parquet(base)
    ))


def read_latest(spark: SparkSession, base: str, split: str | None = None) -> DataFrame:
    """IO8: newest published version (max of the version names), partition-pruned."""
    versions = list_versions(spark, base)
    if not versions:
        raise FileNotFoundError(f"no dataset versions under {base}")
    df = spark.read.parquet(base).where(F.col("version") == versions[-1])
    return df.where(F.col("split") == split) if split else df


def read_feedback(spark: SparkSession, path: str, json_array: bool = False) -> DataFrame:
    """IO9: feedback records; an empty frame with the feedback schema if the path is missing.

    ``json_array=True`` reads the reference's single JSON-array file; the default reads
    the JSON-lines part files that :func:`append_feedback_json` writes.
    """
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return spark.createDataFrame([], FEEDBACK)
    return (
        spark.read.schema(FEEDBACK).option("multiLine", json_array)
        .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT).json(path)
    )


def append_feedback_json(df: DataFrame, path: str) -> None:
    """IO10: append new feedback records (no read-concat-rewrite of the old ones)."""
    (
        df.select([F.col(f.name).cast(f.dataType) for f in FEEDBACK.fields])
        .write.mode("append").option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT).json(path)
    )


def write_report_json(df: DataFrame, path: str) -> None:
    """IO11: a report frame (usually one row) as JSON."""
    df.write.mode("overwrite").option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT).json(path)


def save_model(model, path: str) -> None:
    """IO12: MLlib model / PipelineModel."""
    model.write().overwrite().save(path)


def save_state(spark: SparkSession, path: str, state: dict) -> None:
    """IO12: fitted statistics (plain values) as one JSON text row."""
    spark.createDataFrame([(json.dumps(state),)], "state string").write.mode("overwrite").parquet(path)


def load_state(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.parquet(path).first()["state"])


def save_ensemble_config(spark: SparkSession, base: str, version: str, weights: dict, threshold: float,
                         iso_bounds: tuple[float, float] | None = None, model_path: str | None = None) -> None:
    """IO12: ensemble configuration row (weights, threshold, stored min-max bounds)."""
    lo, hi = iso_bounds or (None, None)
    row = [(version, {k: float(v) for k, v in weights.items()}, float(threshold), lo, hi, model_path)]
    publish(spark, base, version, lambda: spark.createDataFrame(row, ENSEMBLE_CONFIG).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("version").parquet(base))


def load_latest_config(spark: SparkSession, base: str) -> dict:
    """IO12: newest ensemble configuration as a dict (one row)."""
    versions = list_versions(spark, base)
    if not versions:
        raise FileNotFoundError(f"no ensemble config under {base}")
    row = spark.read.parquet(base).where(F.col("version") == versions[-1]).first()
    return row.asDict()

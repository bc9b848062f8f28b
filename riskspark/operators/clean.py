"""Cleaning, label checks, column selection, look-back filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.nulls import clean_double
from riskspark.operators.cumulative import column_modes, medians as column_medians

# Identifier columns the feature step drops, as in the reference.
ID_COLUMNS = ["s.no", "s_no", "TransactionID", "AccountID", "DeviceID", "IP_Address", "MerchantID"]
DATE_COLUMNS = ["TransactionDate", "PreviousTransactionDate"]
# Prediction columns removed before drift checks.
NON_FEATURE_COLUMNS = ["FraudPrediction", "FraudScore", "Timestamp", "Fraud"]
# Top-table display columns of the dashboard, in display order.
DISPLAY_COLUMNS = [
    "TransactionID", "AccountID", "TransactionAmount", "TransactionDate", "TransactionType",
    "Location", "Channel", "FraudScore", "FraudPrediction",
]
UNKNOWN = "Unknown"

_TEXTLIKE = (T.StringType, T.TimestampType, T.TimestampNTZType, T.DateType, T.BooleanType)


def normalize_column_names(df: DataFrame) -> DataFrame:
    """IO2: spaces and dots in column names become underscores."""
    return df.toDF(*[c.replace(" ", "_").replace(".", "_") for c in df.columns])


def parse_dates_lenient(df: DataFrame, cols: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    """IO3: text -> TIMESTAMP_NTZ; unparseable text becomes null instead of failing."""
    out = df
    for c in cols:
        if c in df.columns and not isinstance(df.schema[c].dataType, (T.TimestampType, T.TimestampNTZType)):
            out = out.withColumn(c, F.col(c).cast("string").try_cast("timestamp_ntz"))
    return out


def column_kinds(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) column names from the schema."""
    numeric, categorical = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.NumericType):
            numeric.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            categorical.append(f.name)
    return numeric, categorical


def fill_missing(df: DataFrame, label: str | None = "Fraud", exact: bool = True) -> DataFrame:
    """C1 + C2: text-like columns get their mode (ties -> smallest, all null -> 'Unknown'
    for strings), other columns the exact median (``exact=False``: one-pass approximate
    median). The label is left alone.

    Statistics come from the distributed helpers (one pass each for modes and medians);
    only one value per column reaches the driver.
    """
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, _TEXTLIKE) and f.name != label]
    num_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name != label]
    # one cheap pass finds the columns with gaps; only those need a mode or a median
    # (a mode over a unique id column would shuffle every id for nothing)
    probe = text_cols + num_cols
    nulls = df.agg(*[F.count_if(F.col(c).isNull() | (F.isnan(F.col(c)) if c in num_cols and isinstance(
        df.schema[c].dataType, (T.DoubleType, T.FloatType)) else F.lit(False))).alias(c) for c in probe]).first() \
        if probe else {}
    gaps = {c for c in probe if nulls[c]}
    modes = column_modes(df, [c for c in text_cols if c in gaps])
    medians = column_medians(df, [c for c in num_cols if c in gaps], exact)
    out = []
    for f in df.schema.fields:
        c = f.name
        if c in modes:
            m = modes[c]
            if m is None and isinstance(f.dataType, T.StringType):
                m = UNKNOWN
            fill = F.lit(m).cast(f.dataType) if m is not None else F.lit(None).cast(f.dataType)
            out.append(F.coalesce(F.col(c), fill).alias(c))
        elif c in medians and medians[c] is not None:
            v = clean_double(c) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(c)
            fill = F.lit(float(medians[c]))
            if isinstance(f.dataType, T.IntegralType):
                out.append(F.coalesce(v.cast("double"), fill).alias(c))
            else:
                out.append(F.coalesce(v, fill).cast(f.dataType).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def deduplicate(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication, one copy kept (partial aggregation per partition)."""
    return df.dropDuplicates()


def clean_data(df: DataFrame, label: str | None = "Fraud", exact: bool = True) -> DataFrame:
    """C1-C3 in reference order: fill, then de-duplicate."""
    return deduplicate(fill_missing(df, label, exact))


def validate_labels(df: DataFrame, label: str = "Fraud") -> DataFrame:
    """C4: label cast to int; raise unless every value is 0 or 1.

    The reference truncates bad values like 0.4434862909781083 to 0 and silently loses
    its positives; we refuse them.
    """
    y = F.col(label).cast("double")
    bad = df.where(y.isNull() | ~y.isin(0.0, 1.0)).limit(1).count()
    if bad:
        raise ValueError(f"label column {label!r} holds values outside {{0, 1}}")
    return df.withColumn(label, F.col(label).cast("int"))


def label_profile(df: DataFrame, label: str = "Fraud") -> DataFrame:
    """C4 / IO13: per label value its count and share of rows."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("count")).withColumn(
        "ratio", F.col("count") / total
    )


def load_profile(df: DataFrame, label: str = "Fraud") -> DataFrame:
    """IO13: row count, fraud count and fraud percentage in one aggregate."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(label) == 1).alias("fraud_rows"),
        (F.avg(F.col(label).cast("double")) * F.lit(100.0)).alias("fraud_pct"),
    )


def drop_id_columns(df: DataFrame, cols: Sequence[str] = ID_COLUMNS) -> DataFrame:
    """Drop the fixed identifier list (absent names are ignored)."""
    return df.drop(*[c for c in cols if c in df.columns])


def drop_id_by_rule(df: DataFrame) -> DataFrame:
    """Drop columns whose name contains 'ID', 'Id' or 'id', or equals 's_no'."""
    keep = [c for c in df.columns if not (("ID" in c) or ("Id" in c) or ("id" in c) or c == "s_no")]
    return df.select(*keep)


def drop_if_present(df: DataFrame, cols: Sequence[str] = NON_FEATURE_COLUMNS) -> DataFrame:
    """Drop columns if present."""
    return df.drop(*cols)


def select_existing(df: DataFrame, cols: Sequence[str] = DISPLAY_COLUMNS) -> DataFrame:
    """Project the wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in cols if c in df.columns])


def lookback(df: DataFrame, as_of: str, days: int = 7, ts: str = "Timestamp") -> DataFrame:
    """Rows with ts >= midnight of (as_of - days). ``as_of`` is a date string, not now()."""
    start = F.date_sub(F.to_date(F.lit(as_of)), days).cast("timestamp_ntz")
    return df.where(F.col(ts) >= start)

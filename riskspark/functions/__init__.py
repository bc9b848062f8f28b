"""Column-expression helpers (JVM-side, codegen-friendly)."""

from riskspark.functions.nulls import flag, flag_int, clean_double
from riskspark.functions.time import (
    epoch_micros,
    hours_between,
    transaction_hour,
    day_of_week,
    transaction_month,
    is_weekend,
    time_period,
)

__all__ = [
    "flag",
    "flag_int",
    "clean_double",
    "epoch_micros",
    "hours_between",
    "transaction_hour",
    "day_of_week",
    "transaction_month",
    "is_weekend",
    "time_period",
]

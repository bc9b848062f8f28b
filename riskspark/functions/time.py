"""Time features (F1-F6 building blocks).

All functions accept TIMESTAMP or TIMESTAMP_NTZ columns. Wall-clock fields are read
directly, so results do not depend on the session time zone for NTZ input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskspark.functions.nulls import flag


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(c) -> Column:
    """Microseconds since 1970-01-01 of the wall-clock value.

    Built from date and time-of-day parts of the TIMESTAMP_NTZ value, so the result
    does not depend on the session time zone (a zone whose offset changed since 1970
    would otherwise shift it).
    """
    t = _c(c).cast("timestamp_ntz")
    days = F.datediff(F.to_date(t), F.to_date(F.lit("1970-01-01"))).cast("long")
    secs = F.date_part(F.lit("SECOND"), t)
    return (
        days * F.lit(86_400_000_000)
        + F.hour(t).cast("long") * F.lit(3_600_000_000)
        + F.minute(t).cast("long") * F.lit(60_000_000)
        + (secs * F.lit(1_000_000)).cast("long")
    )


def hours_between(later, earlier) -> Column:
    """(later - earlier) in hours as a double; null if either side is null."""
    return (epoch_micros(later) - epoch_micros(earlier)).cast("double") / F.lit(3.6e9)


def transaction_hour(c) -> Column:
    return F.hour(_c(c))


def day_of_week(c) -> Column:
    """Monday = 0 ... Sunday = 6 (pandas ``dt.dayofweek``)."""
    return F.weekday(_c(c))


def transaction_month(c) -> Column:
    return F.month(_c(c))


def is_weekend(c) -> Column:
    return flag(day_of_week(c).isin(5, 6)).cast("int")


# Right-closed hour bins and their labels, as in the reference.
TIME_PERIOD_BINS = [(0, 6, "Night"), (6, 12, "Morning"), (12, 18, "Afternoon"), (18, 24, "Evening")]


def time_period(c, midnight_as_night: bool = False) -> Column:
    """Right-closed bins (0,6] Night, (6,12] Morning, (12,18] Afternoon, (18,24] Evening.

    Hour 0 falls outside every bin and yields null, like the reference, unless
    ``midnight_as_night`` is set.
    """
    h = transaction_hour(c)
    expr = None
    for lo, hi, label in TIME_PERIOD_BINS:
        cond = (h > lo) & (h <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if midnight_as_night:
        expr = expr.when(h == 0, F.lit("Night"))
    return expr

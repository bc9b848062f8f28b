"""pandas-compatible null handling.

pandas compares NaN/NaT as false and then casts to int, so every flag is
``coalesce(cond, false)``. Spark orders NaN above every double (so ``NaN > x`` is
true); doubles are mapped NaN -> null on entry with ``nanvl``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(cond: Column) -> Column:
    """Boolean condition where null (unknown) counts as false."""
    return F.coalesce(cond, F.lit(False))


def flag_int(cond: Column) -> Column:
    return flag(cond).cast("int")


def clean_double(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.nanvl(col.cast("double"), F.lit(None).cast("double"))

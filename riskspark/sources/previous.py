"""Previous value per key in (time, tie-break) order, safe under key skew.

``lag(x) over (partition by key order by ts, id)`` puts every row of a key into one
window task; a key holding a third of all rows would sink that task. One statistics pass
draws a hash sample of (key, time, tie-break, value); about ``SAMPLE_PER_SLICE`` sampled rows
stand for ``rows_per_slice`` rows. Every ``SAMPLE_PER_SLICE``-th sampled row of a key is a cut,
so a key is cut by row counts, bursts included, and rows of one timestamp are cut by the
tie-break. The window runs per (key, slice). A cut is itself the last row of its slice, so the
first row of the next slice takes the cut's value: no boundary table, no third read.

A null key is a key like any other. The cuts only balance work, the result equals the plain
window. Cuts number at most ``max_cuts`` over all keys (a slice then holds up to
1 / ``max_cuts`` of all rows), which bounds the broadcast tables of cuts. They are kept
as a tree of ``FAN`` children, so that a row carries at most ``FAN`` cuts per level. Without a
given ``max_cuts`` it follows the bytes of the input, a bound that needs no job; a table
that needs fewer than ``FAN`` cuts has one level, one of fewer than ``FAN`` ** 2 two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.time import epoch_micros
from riskspark.operators.cumulative import bucket_of

SAMPLE_PER_SLICE = 64
FAN = 64
MAX_CUTS = 100_000  # below FAN ** 3, the tree's three levels
_RESOLUTION = 1 << 40


def previous_in_order(
    df: DataFrame,
    key: str,
    ts: str,
    tiebreak: str,
    out: str,
    value: str | None = None,
    rows_per_slice: int = 2_000_000,
    max_cuts: int | None = None,
    first_flag: str | None = None,
) -> DataFrame:
    """``df`` with ``out``: the previous row's ``value`` (default: its time) of the same key.

    ``first_flag`` (optional) names a boolean column marking each key's first row."""
    if max_cuts is None:
        max_cuts = _cut_bound(df, rows_per_slice)
    if max_cuts >= FAN**3:
        raise ValueError(f"max_cuts must be below {FAN ** 3}")
    value = value or ts
    # a null key gets its own cuts through the flag; the text form keeps the joins plain equalities
    keyed = df.withColumn("_kn", F.col(key).isNull()).withColumn("_kt", F.coalesce(F.col(key).cast("string"), F.lit("")))
    order = F.struct(epoch_micros(F.col(ts)).alias("t"), F.col(tiebreak).alias("i"))
    cuts = _cuts(keyed, order, F.col(value), [key, ts, tiebreak], rows_per_slice, max_cuts)
    rows = keyed.withColumn("_slice", F.lit(0).cast("long"))
    last = F.lit(None).cast(df.schema[value].dataType)
    for level, size in enumerate([z for z in (FAN * FAN, FAN, 1) if z == 1 or max_cuts >= z]):
        block = size * FAN
        table = (
            cuts.where((F.col("_at") % size == 0) & (F.col("_at") % block != 0) if level else F.col("_at") % size == 0)
            .groupBy("_kt", "_kn", (F.floor(F.col("_at") / block) if level else F.lit(0)).cast("long").alias("_block"))
            .agg(F.sort_array(F.collect_list("_cut")).alias(f"_cuts{level}"))
        )
        rows = rows.withColumn("_block", F.floor(F.col("_slice") / block).cast("long") if level else F.lit(0).cast("long"))
        rows = rows.join(F.broadcast(table), ["_kt", "_kn", "_block"], "left").withColumn(
            "_n", F.coalesce(bucket_of(order, F.col(f"_cuts{level}"), FAN, "o"), F.lit(0)).cast("long"))
        found = F.when(F.col("_n") > 0, F.get(f"_cuts{level}", (F.col("_n") - 1).cast("int"))["v"])
        rows = rows.withColumn("_last", F.coalesce(F.struct(found.alias("v")), F.struct(last.alias("v")))["v"]
                               if not level else F.when(F.col("_n") > 0, found).otherwise(F.col("_last")))
        rows = rows.withColumn("_slice", F.col("_slice") + F.col("_n") * size).drop(f"_cuts{level}", "_n", "_block")
    w = Window.partitionBy(key, "_slice").orderBy(F.col(ts).asc_nulls_first(), F.col(tiebreak).asc_nulls_first())
    first = F.row_number().over(w) == 1
    result = rows.withColumn(out, F.when(first & (F.col("_slice") > 0), F.col("_last")).otherwise(F.lag(value).over(w)))
    if first_flag:
        result = result.withColumn(first_flag, first & (F.col("_slice") == 0))
    return result.select(*df.columns, out, *([first_flag] if first_flag else []))


def _cut_bound(df: DataFrame, rows_per_slice: int) -> int:
    """The cuts a table may need: a row takes a byte at least, so its files hold no more rows than bytes. Files that
    hold more get longer slices, never other results; inputs of unknown size get ``MAX_CUTS``."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return min(MAX_CUTS, max(FAN - 1, size // rows_per_slice))


def _cuts(keyed: DataFrame, order, value, identity: list[str], rows_per_slice: int, max_cuts: int) -> DataFrame:
    """(_kt, _kn, _at, _cut): the sampled rows at which keys are cut, numbered from 1 per key."""
    rate = min(1.0, SAMPLE_PER_SLICE / rows_per_slice)
    per_cut = max(1, round(rows_per_slice * rate))
    draw = F.pmod(F.xxhash64(*[F.col(c) for c in identity]), F.lit(_RESOLUTION))
    sample = keyed.where(draw < F.lit(int(rate * _RESOLUTION))).select(
        "_kt", "_kn", F.struct(order.alias("o"), value.alias("v")).alias("_cut"))
    per_key = Window.partitionBy("_kt", "_kn")
    ranked = sample.withColumn("_r", F.row_number().over(per_key.orderBy("_cut")))
    # the sample's size bounds the cuts: each stands for at least 1 / max_cuts of it
    total = ranked.agg(F.sum(F.when(F.col("_r") > 0, F.lit(1)))).scalar()
    step = F.greatest(F.lit(per_cut).cast("long"), F.ceil(F.coalesce(total, F.lit(0)) / F.lit(float(max_cuts))).cast("long"))
    return ranked.withColumn("_step", step).where(F.col("_r") % F.col("_step") == 0).select(
        "_kt", "_kn", F.floor(F.col("_r") / F.col("_step")).cast("long").alias("_at"), "_cut")

"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target number of words: a share of ``share`` times all words by weight, no more
than ``cap`` times the source's own size, the excess reshared by weight among the others. A
document is then to be copied ``target / source size`` times. The whole part is taken as it is; the
fractional parts are rounded together: two documents duel, mass moves between them so that the
expected words stay the same until one of the two is integral, and the other goes on. Duels run
inside chunks of about ``CHUNK`` documents of a source; the one residual of each chunk enters the
next, ``CHUNK`` times smaller round of the reduction tree, until a source has a single residual, which goes to
the nearer whole number. A source's taken words so differ from its target by half a document at most.

Everything is DataFrame expressions; random draws are hashes of the contents, so reruns agree.
Equal rows are one entry with a multiplicity, so that a repeated row may hold any part of
the table; chunks are by hash, so a hot source is spread over many.

Defined results: a null text has size 0; null sources are a source of their own, last in order; a
document of size 0 takes nothing; an empty table gives an empty result; columns of any name pass through
``mixed`` (types that can be hashed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import table, with_safe_names

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
CHUNK = 64
BROADCAST_SOURCES = 50_000
EPS = 1e-9


def word_count(text):
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def in_order(df: DataFrame, col: str, name: str, parts: int = 32) -> DataFrame:
    """``df`` with ``name`` = position (from 0) in the order of ``col`` (nulls last), without a single-task window."""
    key = F.col(col).asc_nulls_last()
    low = (1 << 33) - 1
    t = table(df.repartitionByRange(parts, key).sortWithinPartitions(key)
              .withColumn("__part", F.spark_partition_id())
              .withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit(low))), "order")
    n = {r["__part"]: r["count"] for r in t.groupBy("__part").count().collect()}  # one row a partition
    offset, total = F.lit(0).cast("long"), 0
    for p in sorted(n):
        offset = F.when(F.col("__part") == p, F.lit(total).cast("long")).otherwise(offset)
        total += n[p]
    return t.withColumn(name, F.col("__at") + offset).drop("__part", "__at")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, n, target) from (source, source_size, n), one row a source."""
    ranked = in_order(sources, "source", "__rank")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("__rank") % len(weights) + 1).cast("int"))
    t = table(ranked.select("source", "source_size", "n", w.alias("w"), (F.col("source_size") * cap).alias("cap")), "sources")
    got = t.agg(F.sum("source_size"), F.sum("w")).first()
    budget, level = share * float(got[0] or 0), 0.0
    if budget > 0:
        level = budget / got[1]
        while True:  # each round caps at least one more source
            full = F.col("cap") <= F.col("w") * F.lit(level)
            a, b = t.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("w")))).first()
            nxt = (budget - (a or 0.0)) / b if b else level
            if not b or nxt <= level * (1 + 1e-12):
                break
            level = nxt
    return t.select("source", "source_size", "n", F.least("cap", F.col("w") * F.lit(level)).alias("target"))


def _let(value, f):
    """``f(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _duel(acc, x, fields, seed: int):
    """One step of the pivotal rule between the residual ``acc.r`` and ``x``."""
    def with_p(item, p):
        return F.struct(*[(p if f == "p" else item[f]).alias(f) for f in fields])

    def decided(item, take):
        return F.struct(*[(F.lit(float(take)) if f == "p" else item[f]).alias(f) for f in fields])

    r = acc["r"]
    bits = F.xxhash64(F.lit(seed), r["h"], x["h"]).bitwiseAND(F.lit((1 << 53) - 1))
    state = F.struct(
        F.least(1 - r["p"], x["p"] * x["s"] / r["s"]).alias("up"),
        F.least(r["p"], (1 - x["p"]) * x["s"] / r["s"]).alias("down"),
        (bits.cast("double") / F.lit(float(1 << 53))).alias("u"))

    def go(d):
        rise = d["u"] * (d["up"] + d["down"]) < d["down"]
        move = F.when(rise, d["up"]).otherwise(-d["down"])
        p_r, p_x = r["p"] + move, x["p"] - move * r["s"] / x["s"]
        first_ends = F.when(rise, 1 - r["p"] <= x["p"] * x["s"] / r["s"]).otherwise(r["p"] <= (1 - x["p"]) * x["s"] / r["s"])
        clip = lambda p: F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))
        done = F.when(first_ends, F.when(rise, decided(r, 1)).otherwise(decided(r, 0))) \
            .otherwise(F.when(rise, decided(x, 0)).otherwise(decided(x, 1)))
        left = F.when(first_ends, with_p(x, clip(p_x))).otherwise(with_p(r, clip(p_r)))
        return F.struct(left.alias("r"), F.concat(acc["done"], F.array(done)).alias("done"))

    return F.when(r.isNull(), F.struct(x.alias("r"), acc["done"].alias("done"))).otherwise(_let(state, go))


def round_together(frac: DataFrame, group: str, count: str, fields, seed: int = 7, chunk: int = CHUNK) -> DataFrame:
    """Pivotal rounding of ``p`` inside each ``group``, keeping the expected sum of ``s * p``.

    ``frac``: group, ``count`` (rows of the group or an upper bound of it), and ``fields`` with h (a hash), s and p.
    Returns group and ``fields`` with p rounded to 0 or 1, every row once.
    """
    out = None
    buckets = F.greatest(F.ceil(F.col(count) / F.lit(float(chunk))).cast("long"), F.lit(1).cast("long"))
    cur = table(frac.withColumn("__b", buckets), "mix0")
    level = 0
    while True:
        most = cur.agg(F.max("__b")).first()[0]
        if most is None:
            break
        item = F.struct(*[F.col(f) for f in fields])
        order = F.struct((-F.col("s")).alias("o"), F.col("h").alias("oh"), item.alias("x"))
        zero = F.struct(F.lit(None).cast(_type(cur, fields)).alias("r"), F.array().cast(f"array<{_type(cur, fields)}>").alias("done"))
        done = table(
            cur.groupBy(group, "__b", F.pmod(F.xxhash64(F.lit(seed + level), "h"), F.col("__b")).alias("__c"))
            .agg(F.sort_array(F.collect_list(order)).alias("xs"))
            .withColumn("o", F.aggregate("xs", zero, lambda a, x: _duel(a, x["x"], fields, seed + level)))
            .select(group, "__b", F.col("o.done").alias("done"), F.col("o.r").alias("r")), f"mix{level + 1}")
        part = done.select(group, F.explode("done").alias("x")).select(group, "x.*")
        out = part if out is None else out.unionByName(part)
        cur = done.select(group, F.ceil(F.col("__b") / F.lit(float(chunk))).cast("long").alias("__b"), "r.*", F.col("__b").alias("__was"))
        last = cur.where("__was = 1").withColumn("p", F.when(F.col("p") >= 0.5, F.lit(1.0)).otherwise(F.lit(0.0)))
        out = out.unionByName(last.select(group, *fields))
        cur = cur.where("__was > 1").drop("__was")
        level += 1
    return frac.select(group, *fields).limit(0) if out is None else out


def _type(df: DataFrame, fields) -> str:
    return "struct<" + ",".join(f"`{f}`:{df.schema[f].dataType.simpleString()}" for f in fields) + ">"


def copies(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", weights=WEIGHTS,
           share: float = SHARE, cap: float = CAP, seed: int = 7, whole_rows: bool = False) -> DataFrame:
    """(id, source, size, h, m, source_size, target, c): entries of ``m`` equal rows and the ``c`` copies all of them get.

    With ``whole_rows`` the hash ``h`` covers every column, else only the columns named.
    """
    cols = docs.columns if whole_rows else [doc_id, source]
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{source}`").alias("source"),
                       word_count(F.col(f"`{text}`")).alias("size"), F.xxhash64(*[F.col(f"`{c}`") for c in cols]).alias("h0"))
    entries = table(rows.groupBy("id", "source", "size", "h0").agg(F.count(F.lit(1)).alias("m")), "entries")
    by_source = entries.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.count(F.lit(1)).alias("n"))
    goal = table(targets(by_source, weights, share, cap), "targets")
    n_sources = goal.count()
    goal = goal.withColumn("sid", F.xxhash64("source", F.col("source").isNull()))
    side = F.broadcast(goal) if n_sources <= BROADCAST_SOURCES else goal
    e = entries.join(side.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    ratio = F.when(F.col("source_size") > 0, F.col("m") * F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    ratio = F.least(ratio, F.col("m") * F.lit(cap))
    whole = F.floor(ratio + EPS)
    e = e.select("id", "source", "size", "h0", "m", "source_size", "target", "n", "sid",
                 F.xxhash64(F.lit(seed), "id", "size", "h0").alias("h"), whole.cast("long").alias("base"),
                 F.greatest(ratio - whole, F.lit(0.0)).alias("p"), F.col("size").cast("double").alias("s"))
    open_ = (F.col("p") > EPS) & (F.col("size") > 0)
    fields = ["id", "size", "h0", "m", "h", "base", "s", "p", "source", "source_size", "target"]
    rounded = round_together(e.where(open_).select("sid", "n", *fields), "sid", "n", fields, seed)
    still = e.where(~open_).withColumn("p", F.lit(0.0)).select("sid", *fields)
    return rounded.unionByName(still).select("id", "source", "size", "h0", "m", "source_size", "target",
                                             (F.col("base") + F.col("p").cast("long")).alias("c"))


def taken(docs: DataFrame, **options) -> DataFrame:
    """(id, size, source_size, target, taken) for every row of ``docs``."""
    c = copies(docs, **options)
    step = 10_000  # equal rows come out in blocks, so no long array is built
    blocks = c.withColumn("__k", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / step))))
    one = blocks.withColumn("__i", F.explode(F.sequence(F.col("__k") * step, F.least((F.col("__k") + 1) * step, F.col("m")) - 1)))
    each = F.floor(F.col("c") / F.col("m")) + (F.col("__i") < F.col("c") % F.col("m")).cast("long")
    return one.select("id", "size", "source_size", "target", (F.col("size") * each).cast("long").alias("taken"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it, columns unchanged."""
    return with_safe_names(docs, lambda d, at: _mixed(d, at(doc_id), at(source), at(text), **options))


def _mixed(docs: DataFrame, doc_id: str, source: str, text: str, **options) -> DataFrame:
    c = table(copies(docs, doc_id, source, text, whole_rows=True, **options), "copies") \
        .select(F.col("id").alias("__id"), F.col("h0").alias("__h"), F.col("m").alias("__m"), F.col("c").alias("__c"))
    h = "__row_hash"
    rows = docs.withColumn(h, F.xxhash64(*[F.col(f"`{x}`") for x in docs.columns]))
    out = rows.join(c.where("__c > 0"), F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")) & (F.col(h) == F.col("__h")))
    if c.where("__m > 1").limit(1).count():
        # equal rows: one of them, repeated as often as all of them together
        same = out.where("__m > 1").groupBy(*[F.col(f"`{x}`") for x in docs.columns], "__c").agg(F.lit(1).alias("__one")).drop("__one")
        out = out.where("__m = 1").select(*[F.col(f"`{x}`") for x in docs.columns], "__c").unionByName(same)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("__c"))).alias("__t")
    return out.select(*[F.col(f"`{x}`") for x in docs.columns], times).drop("__t")

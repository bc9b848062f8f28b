"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A text's fingerprint has bit b set when over half of its word shingles' hashes have it set. Two
fingerprints at most ``d`` bits apart share a value at most ``d/2`` bits from both, so every
distinct fingerprint emits all values within ``d/2`` bits (its ball) and the balls are grouped by
value. A group holds at most one fingerprint per value of the ball (65 for d = 2), however many
texts share a fingerprint; in a group any two are at most ``d`` apart, so links from the smallest
member (verified by ``bit_count(xor)``) carry all connections and no pair list is built. Components come from alternating
large-star / small-star rounds over written tables.

Defined results: a null or empty text has no words and the fingerprint zero, which links like any
other; a text of fewer than ``shingle`` words is one shingle of all its words. The component id is
the smallest id in the component, null only when every id in it is null. Repeated rows are members
like any other. An empty table gives an empty result; extra columns of any name pass through ``keep_one``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import map_texts, table, with_safe_names

SHINGLE = 3
MAX_DISTANCE = 2
SEED = 42
HOT = 10_000  # a key with fewer rows needs no broadcast


def fingerprints_of(texts: list[bytes], shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    from xxhash import xxh64_intdigest as xx

    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for k, t in enumerate(texts):
        words = t.lower().split()
        if not words:
            continue
        if len(words) <= shingle:
            hashes.append(xx(b" ".join(words), seed))
            counts[k] = 1
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        n = len(words) - shingle + 1
        hashes += [xx(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[shingle - 1:].tolist())]
        counts[k] = n
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.concatenate(([0], np.cumsum(counts[full])[:-1]))
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        major = (2 * ones > counts[full][:, None]).astype(np.uint8)
        out[full] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, keep=("doc_id",), text: str = "text", shingle: int = SHINGLE,
                 seed: int = SEED, name: str = "fp") -> DataFrame:
    """``keep`` plus the fingerprint as a signed long."""
    def make():
        return lambda texts: {name: fingerprints_of(texts, shingle, seed).view(np.int64).tolist()}

    return map_texts(docs, make, [T.StructField(name, T.LongType())], text, keep)


def ball_masks(radius: int) -> list[int]:
    """All 64-bit masks of at most ``radius`` set bits, as signed longs."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE, fp: str = "fp") -> DataFrame:
    """(low, high): verified links between distinct fingerprints that connect all within the distance.

    ``fps`` has one row per distinct fingerprint. ``max_distance`` is even, so that two members of a
    group are never further apart than it.
    """
    if max_distance % 2:
        raise ValueError("max_distance must be even")
    # few rows become many: dealt out first, over all tasks (by a hash of the key: by the key itself the
    # exchange would be merged with the aggregate's own, whose few bytes end up in one or two tasks)
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(fp))
    variants = fps.select(
        F.col(fp).alias("f"),
        F.explode(F.transform(F.array(*[F.lit(m).cast("long") for m in ball_masks(max_distance // 2)]),
                              lambda m: F.col(fp).bitwiseXOR(m))).alias("v"))
    groups = variants.groupBy("v").agg(F.min("f").alias("low"), F.collect_set("f").alias("fs"))
    return (groups.where(F.size("fs") > 1).select("low", F.explode("fs").alias("high"))
            .where((F.col("high") != F.col("low")) & (F.bit_count(F.col("low").bitwiseXOR(F.col("high"))) <= max_distance))
            .distinct())


def meet(rows: DataFrame, few: DataFrame, key: str, total: int, n: str = "n") -> DataFrame:
    """``rows`` joined with ``few`` on ``key``; ``few`` has one row a key, ``n`` being the key's number of ``rows``.

    ``total`` is at least the number of ``rows``. A key of over a thousandth of them, and of over ``HOT``, is met by a
    broadcast: there are under 1,000 such keys, and none of their rows goes through the exchange of the others.
    """
    bound = max(HOT, total // 1000)
    if total <= bound:
        return rows.join(few.drop(n), key)
    hot = F.broadcast(few.where(F.col(n) > bound).drop(n))
    return rows.join(hot, key).unionByName(
        rows.join(hot.select(key), key, "left_anti").join(few.where(F.col(n) <= bound).drop(n), key))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node with a link; root is the smallest node of the component.

    Alternating large-star and small-star steps on (low, high) links with low < high. Each round is
    written to the shared folder; rounds end when nothing changes.
    """
    cur = table(edges.select("low", "high"), "edges")
    before = None
    for _ in range(max_rounds):
        both = cur.select(F.col("low").alias("u"), F.col("high").alias("v")).unionByName(
            cur.select(F.col("high").alias("u"), F.col("low").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("low"), F.col("v").alias("high")) \
            .where("low <> high").distinct()
        low = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(low, "high").select("m", "low", "high")
        nxt = small.select(F.col("m").alias("low"), "high").unionByName(
            small.select(F.col("m").alias("low"), F.col("low").alias("high"))).where("low <> high").distinct()
        cur = table(nxt, "edges")
        state = tuple(cur.agg(F.count(F.lit(1)), F.sum(F.hash("low", "high").cast("long")),
                              F.sum(F.xxhash64("low", "high").cast("decimal(20,0)"))).first())
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return cur.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("root")).unionByName(
        cur.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct())


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
            max_distance: int = MAX_DISTANCE, with_text_hash: bool = False) -> DataFrame:
    """(id, fp, root, component_id[, text_hash]) for every row of ``docs``.

    ``component_id`` is the smallest id of the component, root the smallest fingerprint in it.
    """
    src = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    if with_text_hash:
        src = src.withColumn("text_hash", F.xxhash64("text"))
    rows = table(fingerprints(src, [c for c in src.columns if c != "text"], "text", shingle), "fingerprints")
    n_rows = rows.count()
    reps = rows.groupBy("fp").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    near = components(links(reps, max_distance))
    rooted = reps.join(near.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first_id", "n")
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("n_fps"))
    named = table(meet(rooted, firsts, "root", n_rows, "n_fps").select("fp", "root", "component_id", "n"), "classes")
    return meet(rows, named, "fp", n_rows)


def hex_fp(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             max_distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the smallest id
    stays (nulls last, then the smallest text hash); of equal such rows one stays."""
    return with_safe_names(docs, lambda d, at: _keep_one(d, at(doc_id), at(text), shingle, max_distance))


def _keep_one(docs: DataFrame, doc_id: str, text: str, shingle: int, max_distance: int) -> DataFrame:
    t = classes(docs, doc_id, text, shingle, max_distance, with_text_hash=True)
    best = t.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")).alias("b")) \
        .select(F.col("b.id").alias("__id"), F.col("b.text_hash").alias("__text_hash"))
    best = table(best, "kept")
    h = "__row_text_hash"
    hashed = docs.withColumn(h, F.xxhash64(F.col(f"`{text}`").cast("string")))
    out = hashed.join(best, F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")) & F.col(h).eqNullSafe(F.col("__text_hash")), "left_semi")
    repeated = t.groupBy("id", "text_hash").count().where("count > 1").limit(1).count()
    if repeated:
        out = out.dropDuplicates([doc_id, h])
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])

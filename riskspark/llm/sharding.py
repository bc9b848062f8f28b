"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``TOKENS`` places on a ring of ``BUCKETS`` hash buckets; a document belongs to the
first token at or after its bucket, clockwise. No shard takes more than its capacity: the ring is
walked once around and on, a token's own documents come first, and what its shard can't hold goes
on clockwise until a shard has room. With ``slack`` 0 the capacities are n / shards, the first
n mod shards of them one more, so all shards are full and counts are at most one apart; a larger slack moves fewer
documents when shards are added.

Only the counts of the buckets (a fixed number of rows) reach the driver, which walks the ring and
returns intervals of ranks inside buckets; documents get their rank by a window inside the bucket
and their shard by a join with the intervals, whose number is bounded by buckets and tokens. Equal rows are one
entry with a multiplicity, so a repeated row may hold any part of the table.

Defined results: a null text has no bytes and crc32 0; null ids are hashed like a value of their
own; an empty table gives an empty result; other columns are ignored. The law is ``rows``.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_left
from collections import deque

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.llm.common import table

SHARDS = 40
TOKENS = 64
BUCKETS = 1 << 13


def ring(shards: int, tokens: int = TOKENS, buckets: int = BUCKETS) -> list[tuple[int, int]]:
    """(bucket, shard) of all tokens, clockwise."""
    def place(s: int, k: int) -> int:
        return int.from_bytes(hashlib.blake2b(f"{s}/{k}".encode(), digest_size=8).digest(), "big") % buckets
    return sorted((place(s, k), s) for s in range(shards) for k in range(tokens))


def capacities(n: int, shards: int, slack: float = 0.0) -> list[int]:
    if slack > 0:
        return [int(-(-n * (1 + slack) // shards))] * shards
    return [n // shards + (s < n % shards) for s in range(shards)]


def walk(counts: dict[int, int], shards: int, tokens: int = TOKENS, buckets: int = BUCKETS,
         slack: float = 0.0) -> list[tuple[int, int, int, int, int]]:
    """(bucket, from rank, to rank, shard, first slot) intervals from the rows of each bucket."""
    places = ring(shards, tokens, buckets)
    at = [p for p, _ in places]
    own: list[list[tuple[int, int, int]]] = [[] for _ in places]
    for b in sorted(counts):
        own[bisect_left(at, b) % len(places)].append((b, 0, counts[b]))
    room = capacities(sum(counts.values()), shards, slack)
    load = [0] * shards
    over: deque[tuple[int, int, int]] = deque()
    out = []

    def take(shard: int, pieces: deque) -> None:
        while pieces and load[shard] < room[shard]:
            b, lo, hi = pieces.popleft()
            n = min(hi - lo, room[shard] - load[shard])
            out.append((b, lo, lo + n, shard, load[shard]))
            load[shard] += n
            if lo + n < hi:
                pieces.appendleft((b, lo + n, hi))

    first = True
    while first or over:
        for k, (_, shard) in enumerate(places):
            mine = deque(own[k]) if first else deque()
            take(shard, mine)
            take(shard, over)
            over.extend(mine)
        first = False
    return out


def entries(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(id, size, crc, m, bucket, h): distinct rows with their number and place on the ring."""
    t = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"),
                       (F.coalesce(F.octet_length(t), F.lit(0)).cast("long") + 16).alias("size"),
                       F.coalesce(F.crc32(t.cast("binary")), F.lit(0).cast("long")).alias("crc"))
    # size and crc as well: rows of one id, or of none, with different texts spread over the buckets
    h = F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("null")), "size", "crc")
    return rows.groupBy("id", "size", "crc").agg(F.count(F.lit(1)).alias("m")) \
        .withColumn("h", h).withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int"))


def intervals(spark: SparkSession, pieces: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """The intervals of ``walk`` as rows, from a literal of the plan; there are at most buckets + shards of them."""
    names = ["p_bucket", "p_from", "p_to", "shard", "p_slot"]
    text = json.dumps([dict(zip(names, p)) for p in pieces])
    schema = "array<struct<p_bucket: int, p_from: bigint, p_to: bigint, shard: int, p_slot: bigint>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), schema)))


def shard(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text", tokens: int = TOKENS,
          buckets: int = BUCKETS, slack: float = 0.0) -> DataFrame:
    """(id, size, crc, shard, slot) for every row of ``docs``; slots of a shard run gapless from 0."""
    spark = docs.sparkSession
    e = table(entries(docs, doc_id, text, buckets), "shard-entries")
    counts = {int(r["bucket"]): int(r["n"]) for r in e.groupBy("bucket").agg(F.sum("m").alias("n")).collect()}  # <= buckets rows
    pieces = walk(counts, shards, tokens, buckets, slack) if counts else []
    inside = table(intervals(spark, pieces), "shard-pieces")
    w = Window.partitionBy("bucket").orderBy("h", "id", "size", "crc")
    ranked = e.withColumn("before", F.sum("m").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("m"))
    # an entry of m equal rows covers the ranks before .. before + m - 1, which may lie in several intervals
    cut = ranked.join(F.broadcast(inside), (F.col("bucket") == F.col("p_bucket")) & (F.col("before") < F.col("p_to"))
                      & (F.col("before") + F.col("m") > F.col("p_from")))
    lo, hi = F.greatest("before", "p_from"), F.least(F.col("before") + F.col("m"), F.col("p_to"))
    step = 10_000
    part = cut.select("id", "size", "crc", "shard", (F.col("p_slot") + lo - F.col("p_from")).alias("s"), (hi - lo).alias("k"))
    part = part.withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("k") - 1) / step))))
    return part.select("id", "size", "crc", "shard", F.explode(F.sequence(
        F.col("s") + F.col("b") * step, F.col("s") + F.least((F.col("b") + 1) * step, F.col("k")) - 1)).alias("slot"))

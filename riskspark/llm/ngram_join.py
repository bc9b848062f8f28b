"""N-gram Jaccard join by T-occurrence search (DivideSkip).

A document is the set of its distinct word shingles, held as sorted XXH64 values; equal sets are one
class. Two sets link when ``100 * intersection >= percent * union``, that is when they share at least
T = ceil(percent * (n1 + n2) / (100 + percent)) shingles.

1. *Index shards.* Linked sets differ in at most k shingles, so if the hash range is cut into more than
   k parts, at least one part holds the same shingles in both. Every set sends a hash of each part (of the
   cuts for its own size class and for the one below, so that two sizes that can link share a cut);
   sets with an equal part are joined to the smallest of them, and the connected components of
   these joins are the shards. A link never crosses shards, every set is in exactly one shard, and
   sets that share no part with another are settled. Empty parts are sent only by sets with so many of
   them that no other part need agree.
2. *T-occurrence search* in a shard: inverted lists from shingle to sets. Each set is a query once, against
   the sets that nothing has reached yet: the L longest of its lists are put aside, the short ones are merged
   by a heap that skips to the next set that can still reach T - L, and the candidates are probed in the long
   lists by binary search. Those reaching T are links, and are the next queries. A clique of near
   copies costs one query, not its pairs.
3. Shards of more than ``max_sets`` sets are dealt into blocks by hash, each with the shard's first
   ``HUBS`` sets, so links to the hubs hold the blocks together. Sets outside the shard's largest component are
   then searched against all sets of other components, block by block. If nearly all of a shard is linked,
   as in large groups of near copies, that is little; a large shard without links costs all its block pairs.

Texts go only to the executors; of texts in shards of two sets or more one copy is hashed again in step 2.

Defined results: a null or empty text, or one without words, is an empty set and its own
component; fewer words than ``shingle``: the whole sequence is the one shingle. The component id is the
smallest id in the component (equal empty rows share their id), null only if every id in it is
null; documents without words and without an id have a null component. Repeated rows are members
like any other, an empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import map_texts, table
from riskspark.llm.simhash import components

SHINGLE = 3
PERCENT = 90
SEED = 11
MAX_SETS = 512
MAX_BYTES = 32 << 20  # tokens of a batch of shards in a task
HUBS = 32
PROBE_COST = 0.05  # of a binary probe, in steps of the heap
EDGES_PER_TASK = 500_000
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_U = np.uint64


# ---- sets and signatures ----------------------------------------------------------------------

def shingle_hashes(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Sorted distinct XXH64 values of a text's word shingles."""
    from xxhash import xxh64_intdigest as xx

    words = text.translate(_LOWER).split()
    if not words:
        return np.empty(0, _U)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xx(joined, seed)], _U)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1]
    return np.array(sorted({xx(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[shingle - 1:].tolist())}), _U)


def needed(n1, n2, percent: int):
    """Least number of common shingles of two linked sets of these sizes."""
    return -(-percent * (n1 + n2) // (100 + percent))


def size_classes(n: int, percent: int) -> list[tuple[int, int]]:
    """(first, last) sizes of the class of size ``n`` and of the class below it, if there is one.

    Classes follow each other; a size and the smallest size it can link with are at most one class apart.
    """
    lo, before = 1, None
    while True:
        hi = lo * 100 // percent  # the largest size that can link with lo
        if n <= hi:
            return [(lo, hi)] + ([before] if before else [])
        before, lo = (lo, hi), hi + 1


def parts_of(cls: tuple[int, int], percent: int) -> tuple[int, int]:
    """(parts, spare): parts of the cut for sets whose smaller size is in ``cls``; at least spare + 1
    parts of linked sets agree."""
    n = cls[1]
    differ = (n + n * 100 // percent) * (100 - percent) // (100 + percent)
    spare = 1 + differ // 16
    return differ + 1 + spare, spare


def signatures(tokens: np.ndarray, percent: int = PERCENT, cache: dict | None = None) -> np.ndarray:
    """Signed 64-bit hashes of the parts of a set, for its own size class and the one below."""
    n = len(tokens)
    if not n:
        return np.empty(0, np.int64)
    cache = {} if cache is None else cache
    if n not in cache:
        cache[n] = [(c[0], *parts_of(c, percent)) for c in size_classes(n, percent)]
    out = []
    mixed = tokens * _U(0x9E3779B97F4A7C15)
    mixed ^= mixed >> _U(31)
    mixed *= _U(0xBF58476D1CE4E5B9)
    sums = np.concatenate((np.zeros(1, _U), np.cumsum(mixed, dtype=_U)))
    for lo, parts, spare in cache[n]:
        edges = np.array([i * (1 << 64) // parts for i in range(1, parts)], _U)
        at = np.concatenate(([0], np.searchsorted(tokens, edges), [n]))
        value = sums[at[1:]] - sums[at[:-1]]
        value ^= (np.arange(parts, dtype=_U) + _U(lo) * _U(1_000_003)) * _U(0x94D049BB133111EB)
        value ^= value >> _U(29)
        value *= _U(0xD6E8FEB86659FD93)
        value ^= value >> _U(32)
        empty = at[1:] == at[:-1]
        out.append(value if empty.sum() > spare else value[~empty])
    return np.concatenate(out).view(np.int64)


def sets_of(docs: DataFrame, keep, text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
            seed: int = SEED, with_parts: bool = True, with_tokens: bool = False) -> DataFrame:
    """``keep`` plus sid (content id of the set, null for an empty one), n, and parts or tokens."""
    def make():
        from xxhash import xxh64_intdigest as xx

        cache: dict = {}

        def of(texts):
            sets = [shingle_hashes(t, shingle, seed) for t in texts]
            raw = [s.astype("<u8").tobytes() for s in sets]
            out = {"sid": [None if not r else int(np.uint64(xx(r, seed)).view(np.int64)) for r in raw],
                   "n": [len(s) for s in sets]}
            if with_parts:
                with np.errstate(over="ignore"):
                    out["parts"] = [signatures(s, percent, cache) for s in sets]
            if with_tokens:
                out["tokens"] = raw
            return out
        return of

    fields = [T.StructField("sid", T.LongType()), T.StructField("n", T.LongType())]
    if with_parts:
        fields.append(T.StructField("parts", T.ArrayType(T.LongType())))
    if with_tokens:
        fields.append(T.StructField("tokens", T.BinaryType()))
    return map_texts(docs, make, fields, text, keep)


# ---- T-occurrence search ----------------------------------------------------------------------

class Index:
    """Inverted lists of sets, numbered by rising size, and DivideSkip queries against them."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets], np.int64)
        every = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.lexsort((owner, every))
        every, owner = every[order], owner[order]
        self.tokens, first, counts = np.unique(every, return_index=True, return_counts=True)
        self.first = np.concatenate((first, [len(every)]))
        self.lengths = counts
        self.owner = owner
        # a list entry as one number, so that all long lists are probed by one binary search call
        self.keys = np.repeat(np.arange(len(self.tokens)), counts) * len(sets) + owner

    def query(self, tokens: np.ndarray, alive: np.ndarray) -> list[int]:
        """Numbers of the alive sets that link with the set ``tokens``."""
        p, n = self.percent, len(tokens)
        # only sizes that can link; the least overlap among them is that of the smallest size
        lo = int(np.searchsorted(self.sizes, -(-n * p // 100)))
        hi = int(np.searchsorted(self.sizes, n * 100 // p, side="right"))
        open_ = np.zeros(len(alive), bool)
        open_[lo:hi] = alive[lo:hi]
        if not open_.any():
            return []
        least = int(needed(n, int(self.sizes[int(np.argmax(open_))]), p))
        at = np.searchsorted(self.tokens, tokens)
        at = at[(at < len(self.tokens)) & (self.tokens[np.minimum(at, len(self.tokens) - 1)] == tokens)]
        if len(at) < least:
            return []
        at = at[np.argsort(self.lengths[at], kind="stable")]
        n_long = least - self._divide(self.lengths[at], least)
        short, long_ = at[: len(at) - n_long], at[len(at) - n_long:]
        found = merge_skip([x.tolist() for x in self._lists(short, open_)], least - n_long)
        if not found:
            return []
        c, times = np.array(found, np.int64).T
        for part in np.array_split(long_, -(-n_long * len(c) // 500_000)) if n_long else ():
            keys = part[:, None] * len(self.sets) + c
            place = np.minimum(np.searchsorted(self.keys, keys.ravel()), len(self.keys) - 1)
            times = times + (self.keys[place].reshape(keys.shape) == keys).sum(axis=0)
        return c[times >= needed(n, self.sizes[c], p)].tolist()

    @staticmethod
    def _divide(lengths: np.ndarray, least: int) -> int:
        """How often a candidate must be in the short lists: with t, the least - t longest lists are long. The
        merge costs the entries of the short lists; each at most 1/t of them is a candidate to probe."""
        t = np.arange(1, least + 1)
        entries = np.cumsum(lengths)[len(lengths) - least + t - 1]
        return int(t[np.argmin(entries * (1 + PROBE_COST * (least - t) / t))])

    def _lists(self, ranks: np.ndarray, open_: np.ndarray):
        for r in ranks.tolist():
            ids = self.owner[self.first[r]:self.first[r + 1]]
            ids = ids[open_[ids]]
            if len(ids):
                yield ids


def merge_skip(lists: list[list[int]], times: int) -> list[tuple[int, int]]:
    """(number, lists it is in) of the numbers in at least ``times`` of the sorted lists.

    A heap holds the lists' heads. A head that is too rare is passed over together with all
    numbers before the ``times``-th smallest head, which can't be frequent enough either.
    """
    if len(lists) < times:
        return []
    heap = [(x[0], i, 0) for i, x in enumerate(lists)]
    heapq.heapify(heap)
    out = []
    while len(heap) >= times:
        head = heap[0][0]
        popped = []
        while heap and heap[0][0] == head:
            popped.append(heapq.heappop(heap))
        if len(popped) >= times:
            out.append((head, len(popped)))
            target = head + 1
        else:
            while heap and len(popped) < times - 1:
                popped.append(heapq.heappop(heap))
            if not heap:
                break
            target = heap[0][0]
        for _, i, k in popped:
            k = bisect_left(lists[i], target, k)
            if k < len(lists[i]):
                heapq.heappush(heap, (lists[i][k], i, k))
    return out


def search_all(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect what linked pairs connect among ``sets``: each set is a query at most once,
    against those not reached yet."""
    if len(sets) < 2:
        return []
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), ids[i]))
    ids, sets = [ids[i] for i in order], [sets[i] for i in order]
    index = Index(sets, percent)
    alive = np.ones(len(sets), bool)
    out = []
    for start in range(len(sets)):
        if not alive[start]:
            continue
        alive[start] = False
        queue = deque([start])
        while queue and alive.any():
            q = queue.popleft()
            for c in index.query(sets[q], alive):
                alive[c] = False
                out.append((ids[q], ids[c]))
                queue.append(c)
    return out


def search_across(left: list[tuple[int, int, np.ndarray]], right: list[tuple[int, int, np.ndarray]], percent: int) -> list[tuple[int, int]]:
    """Links between sets (id, component, tokens) of ``left`` and of ``right`` of different components;
    two components that a link has joined are not compared again."""
    right = sorted(right, key=lambda r: (len(r[2]), r[0]))
    index = Index([r[2] for r in right], percent)
    root: dict[int, int] = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    label = np.array([r[1] for r in right], np.int64)
    out = []
    for i, component, tokens in left:
        mine = find(component)
        for c in index.query(tokens, label != mine):
            other = int(label[c])
            if other != mine:
                out.append((i, right[c][0]))
                root[other] = mine
                label[label == other] = mine
    return out


_LINKS = T.StructType([T.StructField("low", T.LongType()), T.StructField("high", T.LongType())])


def _arrow_links(pairs) -> pa.RecordBatch:
    pairs = [(min(p), max(p)) for p in pairs]
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["low", "high"])


def _in_groups(search, n_keys: int, max_bytes: int):
    """An Arrow map over rows sorted by their first ``n_keys`` columns; ``search`` gets the rows of
    as many whole groups as fit ``max_bytes``, one group at least."""
    def run(batches):
        group, key, size = [], None, 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[:n_keys] != key:
                    if group and (n_keys > 1 or size >= max_bytes):
                        yield from _flush(search, group)
                        group, size = [], 0
                    key = row[:n_keys]
                group.append(row)
                size += len(row[-1])
        if group:
            yield from _flush(search, group)
    return run


def _flush(search, group):
    found = search(group)
    if found:
        yield _arrow_links(found)


def _tokens(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u8").astype(_U)


def shard_links(sets: DataFrame, percent: int = PERCENT, max_sets: int = MAX_SETS, max_bytes: int = MAX_BYTES,
                hubs: int = HUBS) -> DataFrame:
    """(low, high) links for ``sets`` (root, sid, tokens): the shard of a set, its id and shingles."""
    sizes = table(sets.groupBy("root").agg(F.count(F.lit(1)).alias("m")), "shard-sizes")
    hot = sizes.where(F.col("m") > max_sets)

    def whole(rows):
        return search_all([r[1] for r in rows], [_tokens(r[2]) for r in rows], percent)

    small = sets.join(sizes.where(F.col("m") <= max_sets).select("root"), "root", "left_semi").select("root", "sid", "tokens")
    links = table(small.repartition("root").sortWithinPartitions("root", "sid").mapInArrow(_in_groups(whole, 1, max_bytes), _LINKS), "links")
    if not hot.limit(1).count():
        return links
    hot = hot.withColumn("blocks", F.ceil(F.col("m") / F.lit(max_sets)).cast("int"))
    big = table(sets.join(hot, "root").withColumn("block", F.pmod(F.xxhash64("sid", F.lit(5)), F.col("blocks")).cast("int")), "hot-sets")
    # the smallest ids of a shard are its hubs: a bounded aggregate, not a sort of the shard
    first = big.groupBy("root", F.pmod(F.xxhash64("sid"), F.lit(hubs)).alias("h")).agg(F.min("sid").alias("sid")).select("root", "sid")
    first = big.join(first, ["root", "sid"], "left_semi")
    spread = first.select("root", "sid", "tokens", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    dealt = big.select("root", "block", "sid", "tokens").unionByName(spread).dropDuplicates(["root", "block", "sid"])

    def block(rows):
        return search_all([r[2] for r in rows], [_tokens(r[3]) for r in rows], percent)

    inner = table(dealt.select("root", "block", "sid", "tokens").repartition("root", "block").sortWithinPartitions("root", "block", "sid")
                  .mapInArrow(_in_groups(block, 2, max_bytes), _LINKS), "hot-links")
    links = links.unionByName(inner)
    named = joined(inner).withColumnRenamed("root", "c")
    big = table(big.join(named, big.sid == named.node, "left").select("root", "sid", "tokens", "blocks", "block", F.coalesce("c", "sid").alias("c")), "hot-labels")
    per = big.groupBy("root", "c").agg(F.count(F.lit(1)).alias("k"))
    largest = per.groupBy("root").agg(F.max(F.struct("k", "c")).alias("l")).select("root", F.col("l.c").alias("largest"))
    labelled = big.join(largest, "root")
    rest = labelled.where("c <> largest")
    if not rest.limit(1).count():
        return links
    n_rest = rest.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / F.lit(max_sets)).cast("int").alias("parts"))
    indexed = rest.join(n_rest, "root").select(
        "root", F.pmod(F.xxhash64("sid", F.lit(9)), F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("side"), "sid", "c", "tokens")
    asked = big.join(n_rest, "root").select(
        "root", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "block", F.lit(0).alias("side"), "sid", "c", "tokens")

    def across(rows):
        sides = [[(r[4], r[5], _tokens(r[6])) for r in rows if r[3] == side] for side in (0, 1)]
        return search_across(*sides, percent) if all(sides) else []

    cross = indexed.unionByName(asked).repartition("root", "part", "block").sortWithinPartitions("root", "part", "block", "side", "sid")
    return links.unionByName(table(cross.mapInArrow(_in_groups(across, 3, max_bytes), _LINKS), "cross-links"))


def joined(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with a link; root is the smallest node of the component.

    Links that lie in one task (at most about ``EDGES_PER_TASK``) are joined there first; if that is all of them it is the
    result, else what each task leaves, a link per node, goes through the large-star/small-star rounds."""
    cur = table(edges, "join-edges")
    tasks = -(-cur.count() // EDGES_PER_TASK)

    def run(batches):
        root: dict[int, int] = {}

        def find(x):
            at = x
            while root[at] != at:
                at = root[at]
            while root[x] != at:
                root[x], x = at, root[x]
            return at

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                root.setdefault(a, a)
                root.setdefault(b, b)
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
        nodes = list(root)
        for at in range(0, len(nodes), 100_000):
            part = nodes[at:at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([find(x) for x in part], pa.int64())], names=["node", "root"])

    local = table(cur.select("low", "high").coalesce(max(1, tasks)).mapInArrow(run, "node long, root long"), "joined")
    if tasks <= 1:
        return local
    return components(local.where("node <> root").select(F.col("root").alias("low"), F.col("node").alias("high")).distinct())


# ---- the operator -----------------------------------------------------------------------------

def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
            max_sets: int = MAX_SETS, hubs: int = HUBS, seed: int = SEED) -> DataFrame:
    """(id, n_shingles, sid, component_id) for every row of ``docs``."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must be in 50..100")
    src = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).withColumn("th", F.xxhash64("text"))
    rows = table(sets_of(src, ["id", "th"], "text", shingle, percent, seed), "sets")
    sent = rows.select("sid", F.explode("parts").alias("part"))
    shared = table(sent.groupBy("part").agg(F.min("sid").alias("low"), F.max("sid").alias("top")).where("low < top").select("part", "low"), "shared-parts")
    edges = sent.join(shared, "part").where("sid <> low").select("low", F.col("sid").alias("high")).distinct()
    shards = joined(edges).withColumnRenamed("node", "sid")
    wanted = rows.join(shards, "sid", "left_semi").groupBy("sid").agg(F.min("th").alias("th")).select("th").distinct()
    texts = src.join(wanted, "th", "left_semi").select("th", "text").dropDuplicates(["th"])
    sets = sets_of(texts, [], "text", shingle, percent, seed, with_parts=False, with_tokens=True).join(shards, "sid")
    sets = table(sets.select("root", "sid", "tokens").dropDuplicates(["sid"]), "shard-sets")
    found = joined(shard_links(sets, percent, max_sets, hubs=hubs))
    reps = rows.where("sid IS NOT NULL").groupBy("sid").agg(F.min("id").alias("first_id"))
    rooted = reps.join(found.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    # sets without a link keep their own first id, so only linked ones are grouped by component
    named = rooted.join(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("sid", "component_id")
    out = rows.select("id", F.col("n").alias("n_shingles"), "sid")
    return out.where("sid IS NOT NULL").join(named, "sid").select("id", "n_shingles", "sid", "component_id").unionByName(
        out.where("sid IS NULL").withColumn("component_id", F.col("id")))

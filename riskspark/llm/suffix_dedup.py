"""Exact substring removal with a suffix array built by two-stage sorting.

Every byte covered by a ``length``-byte string that also starts elsewhere (same text or another,
never across texts) is removed. Only places that can repeat reach the suffix array:

1. Each ``length``-byte window picks its smallest ``GRAM``-byte hash (a minimizer); windows in a row
   that pick the same place form a context, anchored there. Equal windows have equal anchors at equal offsets,
   so a window of an anchor that occurs once repeats nowhere. Equal contexts of an anchor
   are one, with a count.
2. The different contexts of an anchor come together in one task, in batches of a bounded size.
   Inside a batch the window suffixes are sorted in two stages: those smaller than their successor
   directly, all others by scans of the byte buckets, each suffix placing its predecessor. Adjacent
   suffixes with a common prefix of ``length`` bytes are one class; a class that occurs twice or more
   marks its windows.
3. An anchor with more than ``MAX_CONTEXTS`` contexts is split by content: its windows fall into
   blocks by their distance from the anchor, all windows of a block share the bytes in its middle,
   and these bytes become the new key. Equal windows keep equal keys and equal pieces are one again,
   so nothing is lost; blocks shrink with each round (``grids_of``) down to single windows.
4. Marked windows go back to all places that share the context and are merged per text.

Texts are known by a 128-bit content hash, so copies of a text share one result, and repeated
rows need no row number. Defined results: a null text is empty; texts shorter than ``length`` stay;
an empty table gives an empty result; extra columns pass through if they are in ``keep``, and an output
column whose name ``docs`` has already is lengthened by underscores.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import free_name, slices, table

LENGTH = 400
GRAM = 32
MAX_CONTEXTS = 1024
BATCH_BYTES = 1 << 20
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_B = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def gram_hashes(buf: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """64-bit hash of each ``gram``-byte substring (gram a power of two), mixed so that order is random."""
    h, m, base = buf.astype(np.uint64) + np.uint64(1), 1, _B
    while m < gram:
        h = h[:-m] * np.uint64(base) + h[m:]
        base = base * base & _MASK
        m *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def sliding_argmin(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of each ``width`` values in a row; by the top 34 bits, then the first."""
    key = (h >> np.uint64(30) << np.uint64(30)) | np.arange(len(h), dtype=np.uint64)
    n = len(key)
    blocks = -(-n // width)
    pad = np.full(blocks * width, _MASK, np.uint64)
    pad[:n] = key
    rows = pad.reshape(blocks, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    s = np.arange(n - width + 1)
    return (np.minimum(back[s], ahead[s + width - 1]) & np.uint64((1 << 30) - 1)).astype(np.int64)


def contexts_of(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """(text number, low, high, anchor, context hash) arrays: windows low..high of a text share an anchor."""
    from xxhash import xxh64_intdigest as xx

    joined = b"".join(texts)
    if len(joined) < length:
        return None
    buf = np.frombuffer(joined, np.uint8)
    with np.errstate(over="ignore"):
        h = gram_hashes(buf, gram)
        at = sliding_argmin(h, length - gram + 1)
    ends = np.cumsum([len(t) for t in texts])
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])[: len(at)]
    valid = np.flatnonzero(np.arange(len(at)) + length <= ends[doc])
    if not len(valid):
        return None
    new = np.concatenate(([True], (np.diff(valid) > 1) | (at[valid[1:]] != at[valid[:-1]]) | (doc[valid[1:]] != doc[valid[:-1]])))
    lo = valid[new]
    hi = valid[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(valid) - 1]))]
    first = (ends - [len(t) for t in texts])[doc[lo]]
    c = [xx(joined[a:b + length], int(p - a)) for a, b, p in zip(lo.tolist(), hi.tolist(), at[lo].tolist())]
    return doc[lo], lo - first, hi - first, h[at[lo]].view(np.int64), np.array(c, np.uint64).view(np.int64), at[lo] - lo


def anchors(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(t1, t2, a, c, lo, hi, off): the contexts of all texts."""
    src = docs.select(*text_key(text), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            raw = [b or b"" for b in batch.column(2).cast(pa.binary()).to_pylist()]
            t1, t2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for a, b in slices(raw):
                got = contexts_of(raw[a:b], length, gram)
                if got is not None:
                    doc, lo, hi, anchor, c, off = got
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (t1[a + doc], t2[a + doc], anchor, c, lo.astype(np.int64), hi.astype(np.int64), off.astype(np.int32))],
                        names=["t1", "t2", "a", "c", "lo", "hi", "off"])

    return src.mapInArrow(run, "t1 long, t2 long, a long, c long, lo long, hi long, off int")


def text_key(text: str):
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return F.xxhash64(t).alias("t1"), F.xxhash64(F.lit(17), t, F.lit(3)).alias("t2")


# ---- the suffix array of a batch --------------------------------------------------------------

def two_stage_order(buf: bytes, starts: np.ndarray, ends: np.ndarray, owned: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """The owned positions of all contexts, ordered by their next ``length`` bytes.

    Context k is ``buf[starts[k]:ends[k]]`` and owns its first ``owned[k]`` positions. A position is
    sorted directly when its suffix is smaller than its successor (or when a run of equal bytes
    reaches ``length`` or the context's end); a position with a larger suffix than its successor is induced from it.
    """
    t = np.frombuffer(buf, np.uint8)
    n = len(t)
    last = np.zeros(n, bool)
    last[ends - 1] = True
    stop = last.copy()
    stop[:-1] |= t[1:] != t[:-1]
    run_end = np.flatnonzero(stop)
    run_end = run_end[np.searchsorted(run_end, np.arange(n))]
    follows = t[np.minimum(run_end + 1, n - 1)]
    direct = last[run_end] | (run_end - np.arange(n) + 1 >= length) | (follows > t)
    # of each context: the owned positions, and on to the first directly sorted one
    next_direct = np.flatnonzero(direct)
    upto = next_direct[np.searchsorted(next_direct, starts + owned - 1)]
    mark = np.zeros(n + 1, np.int32)
    np.add.at(mark, starts, 1)
    np.add.at(mark, upto + 1, -1)
    needed = np.cumsum(mark[:n]) > 0
    induced = needed & ~direct
    end_of = np.repeat(ends, ends - starts)
    is_start = np.zeros(n, bool)
    is_start[starts] = True

    at = np.flatnonzero(needed & direct)
    stops = np.minimum(at + length, end_of[at])
    keys = [buf[a:b] for a, b in zip(at.tolist(), stops.tolist())]
    order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
    small = at[order] if len(order) else at
    del keys
    first_byte = t[small]
    cuts = np.searchsorted(first_byte, np.arange(257))

    queues: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def before(entries: np.ndarray) -> np.ndarray:
        """Predecessors to induce, in the order of ``entries``."""
        entries = entries[~is_start[entries]] - 1
        return entries[induced[entries]]

    for c in range(256):
        large = np.concatenate(queues[c]) if queues[c] else np.empty(0, np.int64)
        waves = [large]
        while len(large):  # predecessors with the same byte join the same bucket behind
            prev = before(large)
            large = prev[t[prev] == c]
            waves.append(large)
        bucket = np.concatenate([*waves, small[cuts[c]:cuts[c + 1]]])
        queues[c] = []
        if not len(bucket):
            continue
        out.append(bucket)
        prev = before(bucket)
        prev = prev[t[prev] > c]
        if len(prev):
            by = np.argsort(t[prev], kind="stable")
            prev = prev[by]
            bounds = np.flatnonzero(np.diff(t[prev])) + 1
            for part in np.split(prev, bounds):
                queues[t[part[0]]].append(part)
    everything = np.concatenate(out) if out else np.empty(0, np.int64)
    mine = np.zeros(n + 1, np.int32)
    np.add.at(mine, starts, 1)
    np.add.at(mine, starts + owned, -1)
    return everything[(np.cumsum(mine[:n]) > 0)[everything]]


def classes_of(batch: list[tuple[bytes, int]], length: int = LENGTH):
    """(context number, offset, class, total): all windows of (context, count) pairs with the
    number of places of their class, in suffix order."""
    buf = b"".join(x for x, _ in batch)
    sizes = np.array([len(x) for x, _ in batch], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    order = two_stage_order(buf, starts, ends, sizes - length + 1, length)
    ctx = np.searchsorted(ends, order, side="right")
    places = order.tolist()
    same = [buf[a:a + length] == buf[b:b + length] for a, b in zip(places, places[1:])]  # common prefix of length bytes
    label = np.concatenate(([0], np.cumsum(~np.array(same, bool)))) if len(places) else np.empty(0, np.int64)
    counts = np.array([n for _, n in batch], np.int64)
    total = np.bincount(label, counts[ctx]).astype(np.int64) if len(places) else np.empty(0, np.int64)
    return buf, order, ctx, order - starts[ctx], label, total


def _ranges(values: np.ndarray) -> list[tuple[int, int]]:
    cut = np.flatnonzero(np.diff(values) > 1)
    return list(zip(values[np.concatenate(([0], cut + 1))].tolist(), values[np.concatenate((cut, [len(values) - 1]))].tolist()))


def _solve(rows, length):
    """Marked ranges (a, c, lo, hi) of the contexts (a, c, ctx, n) of a batch."""
    _, order, ctx, off, label, total = classes_of([(r[2], r[3]) for r in rows], length)
    if not len(order):
        return
    twice = total[label] >= 2
    by = np.lexsort((off[twice], ctx[twice]))
    c, o = ctx[twice][by], off[twice][by]
    for part in np.split(np.arange(len(c)), np.flatnonzero(np.diff(c)) + 1) if len(c) else ():
        r = rows[c[part[0]]]
        for lo, hi in _ranges(o[part]):
            yield r[0], r[1], lo, hi


def _sort_contexts(length: int, batch_bytes: int):
    names = ["a", "c", "lo", "hi"]

    def flush(rows):
        got = list(_solve(rows, length))
        return [pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*got)], names=names)] if got else []

    def run(batches):
        held, size, key = [], 0, None
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if row[0] != key and size >= batch_bytes:
                    yield from flush(held)
                    held, size = [], 0
                key = row[0]
                held.append(row)
                size += len(row[2])
        if held:
            yield from flush(held)

    return run


def _split_contexts(length: int, grid: int):
    """Pieces of contexts: the windows of one block of ``grid`` distances from the anchor each."""
    names = ["pa", "pc", "shift", "a", "c", "ctx", "n", "off"]

    def run(batches):
        from xxhash import xxh64_intdigest as xx

        def signed(x):
            return x - (1 << 64) if x >> 63 else x

        for batch in batches:
            out: list[list] = [[] for _ in names]
            for a, c, ctx, n, off in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                last = len(ctx) - length  # the last window start
                for j in range((off - last) // grid if off > last else 0, off // grid + 1):
                    x, y = max(0, off - (j + 1) * grid + 1), min(last, off - j * grid)
                    core = ctx[off - j * grid:off - (j + 1) * grid + 1 + length]
                    piece = ctx[x:y + length]
                    row = (a, c, x, signed(xx(a.to_bytes(8, "little", signed=True) + core, j)), signed(xx(piece, off - x)), piece, n, off - x)
                    for v, z in zip(out, row):
                        v.append(z)
            kinds = [pa.int64()] * 5 + [pa.binary(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names=names)

    return run


def grids_of(length: int) -> tuple[int, ...]:
    """Block sizes of the splitting rounds, down to single windows."""
    return tuple(sorted({max(1, length // 8), max(1, length // 64), 1}, reverse=True))


def _one_each(pieces: DataFrame, n) -> DataFrame:
    return pieces.groupBy("a", "c").agg(F.first("ctx").alias("ctx"), n.alias("n"), F.first("off").alias("off"))


def repeated_windows(contexts: DataFrame, length: int = LENGTH, max_contexts: int = MAX_CONTEXTS,
                     batch_bytes: int = BATCH_BYTES, grids: tuple[int, ...] | None = None) -> DataFrame:
    """(a, c, lo, hi): ranges of window starts that repeat, for contexts (a, c, ctx, n, off)."""
    grids = grids_of(length) if grids is None else grids
    cur = table(contexts, "contexts-0")
    hot = cur.groupBy("a").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > max_contexts).select("a") if grids else None
    split = None
    if grids and hot.limit(1).count():
        split = cur.join(hot, "a", "left_semi").select("a", "c", "ctx", "n", "off")
        cur = cur.join(hot, "a", "left_anti")
    told = table(cur.select("a", "c", "ctx", "n").repartition("a").sortWithinPartitions("a", "c").mapInArrow(
        _sort_contexts(length, batch_bytes), "a long, c long, lo long, hi long"), "classes")
    if split is None:
        return told
    pieces = table(split.mapInArrow(_split_contexts(length, grids[0]),
                                    "pa long, pc long, shift long, a long, c long, ctx binary, n long, off int"), "pieces")
    inner = repeated_windows(_one_each(pieces, F.sum("n")), length, max_contexts, batch_bytes, grids[1:])
    back = pieces.select("pa", "pc", "shift", "a", "c").join(inner, ["a", "c"]).select(
        F.col("pa").alias("a"), F.col("pc").alias("c"), (F.col("lo") + F.col("shift")).alias("lo"), (F.col("hi") + F.col("shift")).alias("hi"))
    return told.unionByName(back)


def marked_windows(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM,
                   max_contexts: int = MAX_CONTEXTS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(t1, t2, spans): per text, the byte ranges [start, end) of its repeated strings, merged."""
    found = table(anchors(docs, text, length, gram), "anchors")
    # counted per context first: a very common anchor has far fewer contexts than places
    kinds = table(found.groupBy("a", "c").agg(F.count(F.lit(1)).alias("k")), "context-counts")
    twice = kinds.groupBy("a").agg(F.sum("k").alias("k")).where("k > 1").select("a")
    shared = table(found.join(kinds.join(twice, "a", "left_semi").select("a", "c"), ["a", "c"], "left_semi"), "shared-anchors")
    ctx = shared.groupBy("a", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("t1", "t2", "lo", "hi", "off")).alias("rep"))
    ctx = table(ctx, "contexts")
    wanted = ctx.select("a", "c", "n", *[F.col(f"rep.{x}").alias(x) for x in ("t1", "t2", "lo", "hi", "off")])
    per_text = wanted.groupBy("t1", "t2").agg(F.collect_list(F.struct("a", "c", "n", "lo", "hi", "off")).alias("want"))
    texts = docs.select(*text_key(text), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("text")) \
        .where(F.octet_length("text") >= length)
    cut = texts.join(per_text, ["t1", "t2"]).select(F.explode("want").alias("w"), "text").select(
        "w.a", "w.c", F.expr("substring(text, cast(w.lo + 1 as int), cast(w.hi - w.lo + %d as int))" % length).alias("ctx"), "w.n", "w.off")
    # copies of a text send the same contexts; one of each is kept
    marks = repeated_windows(_one_each(cut, F.first("n")), length, max_contexts, batch_bytes)
    # written, so that Spark can split the places of a very common context over tasks when it joins them
    marks = table(marks.groupBy("a", "c").agg(F.collect_list(F.struct("lo", "hi")).alias("m")), "marks")
    places = shared.select("t1", "t2", "a", "c", F.col("lo").alias("at")).distinct().join(marks, ["a", "c"])
    return places.select("t1", "t2", F.explode(F.transform("m", lambda m: F.struct(
        (F.col("at") + m["lo"]).alias("start"), (F.col("at") + m["hi"] + length).alias("end")))).alias("s")) \
        .groupBy("t1", "t2").agg(F.collect_list("s").alias("spans"))


def remove_repeats(docs: DataFrame, keep=("doc_id",), text: str = "text", length: int = LENGTH, **options) -> DataFrame:
    """``keep`` plus n_bytes, n_removed, n_spans, spans (byte ranges), kept (the remaining bytes)
    and kept_sha256 for every row of ``docs``."""
    spans = table(marked_windows(docs, text, length, **options), "spans")
    names, keep = list(keep), [f"c{i}" for i in range(len(keep))]  # no helper column is called so
    src = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(names, keep)], *text_key(text),
                      F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("__text"))
    src = src.join(spans, ["t1", "t2"], "left").select(*keep, "__text", "spans")
    n = len(keep)
    schema = src.select(*keep).schema.add("n_bytes", "long").add("n_removed", "long") \
        .add("n_spans", "long").add("spans", _SPANS).add("kept", "binary").add("kept_sha256", "string")
    pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for t, marks in zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist()):
                merged: list[list[int]] = []
                for s, e in sorted((m["start"], m["end"]) for m in marks or ()):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                at, parts = 0, []
                for s, e in merged:
                    parts.append(t[at:s])
                    at = e
                kept = b"".join([*parts, t[at:]]) if merged else t
                for v, x in zip(out, (len(t), len(t) - len(kept), len(merged), [{"start": s, "end": e} for s, e in merged],
                                      kept, hashlib.sha256(kept).hexdigest())):
                    v.append(x)
            cols = [batch.column(i) for i in range(n)]
            cols += [pa.array(v, k) for v, k in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.list_(pair), pa.binary(), pa.string()))]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names[:n], "n_bytes", "n_removed", "n_spans", "spans", "kept", "kept_sha256"])

    told = [free_name(docs, x) for x in schema.names[n:]]
    return src.mapInArrow(run, schema).toDF(*names, *told)

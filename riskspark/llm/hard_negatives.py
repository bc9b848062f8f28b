"""Hard negatives by angular triangle filtering.

Entries become integers ``floor(scale * entry)``; a score is the integer inner product of an anchor and a
row. A few reference directions are chosen far apart from a bounded sample of rows (at most
``SAMPLE``, by hash). Every row keeps its norm and its angles to them. For an anchor a and a row x, the
triangle inequality on the sphere gives, over all references r,

    max |angle(a,r) - angle(x,r)|  <=  angle(a,x)  <=  min(angle(a,r) + angle(x,r), 2 pi - the same),

so the cosine lies in an interval, and norms times its ends, moved outwards by more than rounding can
lose, bound the score. Only rows whose bounds overlap the wanted window get their integer
score: for positives the window above the anchor's worst best-5 score so far, for negatives the union of the positives' windows
[low %, high %], each above its worst best-10 score so far. The filter drops no row that could be returned.

Rows are packed into blocks of at most ``ROW_BLOCK`` rows, anchors into blocks of about ``ANCHOR_BLOCK``; blocks
meet in a join of the (stated) anchor blocks with all row blocks, which Spark broadcasts only below its
size threshold and else runs block pair by block pair. Each pair gives its best few rows per anchor, and a
limited ranking per anchor keeps the first ones. Work is anchors x rows by the contract; memory per task is
one pair of blocks.

Defined results: rows with a null label, a null or empty vector, or null or non-finite entries take no part.
A row with the anchor's own id is neither its positive nor its negative. Ties go by smaller id, null
ids last. Repeated rows are candidates each; equal anchors (id, label, vector) are one anchor. An anchor without
another row of its label has no result. Vectors of different lengths and scores beyond 2^53 raise. An
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import table

SCALE = 256
REFERENCES = 8
SAMPLE = 1024
ROW_BLOCK = 8192
ANCHOR_BLOCK = 512
POSITIVES = 5
NEGATIVES = 10
WINDOW = (30, 90)
_SLACK = 4e-6  # radians; stored angles are single precision (error below 5e-7)
_NO_ID = np.iinfo(np.int64).max


# ---- rows and references ----------------------------------------------------------------------

def usable_rows(rows: DataFrame, vec_id: str, vector: str, label: str, scale: int) -> DataFrame:
    """(vec_id, label, v): v the bytes of the integer vector; rows that take no part are left out."""
    v = F.col(f"`{vector}`").cast("array<double>")
    src = rows.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("long").alias("label"), v.alias("v")) \
        .where(F.col("label").isNotNull() & (F.size("v") > 0))

    def run(batches):
        for batch in batches:
            offsets = batch.column(2).offsets.to_numpy()
            flat = np.floor(scale * batch.column(2).values.to_numpy(zero_copy_only=False).astype(float))
            at, out = [], []
            for k in range(batch.num_rows):
                x = flat[offsets[k]:offsets[k + 1]]
                if np.isfinite(x).all():
                    if float(x @ x) >= 1 << 53:
                        raise ValueError("scores beyond 2^53 are not exact")
                    at.append(k)
                    out.append(x.astype("<i8").tobytes())
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(out, pa.binary())], names=["vec_id", "label", "v"])

    return src.mapInArrow(run, "vec_id long, label long, v binary")


def references_of(rows: DataFrame, count: int = REFERENCES, sample: int = SAMPLE) -> np.ndarray:
    """Unit directions far apart, from a sample of at most ``sample`` rows with the smallest hashes."""
    picked = rows.select("v").orderBy(F.xxhash64("v", "vec_id"), "v").limit(sample).collect()
    if not picked:
        return np.zeros((0, 0))
    x = np.array([np.frombuffer(r.v, "<i8") for r in picked], float)
    norm = np.sqrt((x * x).sum(axis=1))
    x = x[norm > 0] / norm[norm > 0][:, None]
    if not len(x):
        return np.zeros((0, len(picked[0].v) // 8))
    chosen = [int(np.argmax(x @ x.mean(axis=0)))]
    near = np.abs(x @ x[chosen[0]])
    while len(chosen) < min(count, len(x)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, np.abs(x @ x[chosen[-1]]))
    return x[chosen]


def angles_to(x: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(norms, single-precision angles to the references); a zero vector has right angles."""
    norm = np.sqrt((x * x).sum(axis=1))
    cos = (x @ references.T) / np.where(norm > 0, norm, 1.0)[:, None]
    # the two-argument form keeps small and flat angles accurate, which the arc cosine does not
    sin = np.sqrt(np.maximum(0.0, 1.0 - cos * cos))
    small = np.abs(cos) > 0.9
    if small.any():
        i, j = np.nonzero(small)
        diff = x[i] / norm[i][:, None] - np.copysign(1.0, cos[i, j])[:, None] * references[j]
        half = np.sqrt((diff * diff).sum(axis=1)) / 2
        theta = 2 * np.arcsin(np.minimum(1.0, half))
        flat = np.where(cos[i, j] > 0, theta, np.pi - theta)
    angle = np.arctan2(sin, cos)
    if small.any():
        angle[i, j] = flat
    return norm, angle.astype(np.float32)


def score_bounds(norm_a, angle_a, norms, angles) -> tuple[np.ndarray, np.ndarray]:
    """(low, high) bounds of an anchor's scores with rows, safe against rounding."""
    if not angles.shape[1]:
        top = norm_a * norms * (1 + 1e-9) + 1
        return -top, top
    least = np.abs(angles - angle_a).max(axis=1).astype(float)
    both = (angles + angle_a).astype(float)
    most = np.minimum(both, 2 * np.pi - both).min(axis=1)
    size = norm_a * norms
    slack = size * 1e-9 + 0.5
    return (size * np.cos(np.minimum(np.pi, most + _SLACK)) - slack, size * np.cos(np.maximum(0.0, least - _SLACK)) + slack)


# ---- blocks -----------------------------------------------------------------------------------

def pack_rows(rows: DataFrame, references: np.ndarray, size: int = ROW_BLOCK) -> DataFrame:
    """(rows_of): blocks of rows with their norms and angles, packed where they are."""
    def flush(held):
        table_ = pa.Table.from_batches(held)
        for at in range(0, table_.num_rows, size):
            part = table_.slice(at, size)
            ids = np.array([_NO_ID if i is None else i for i in part.column("vec_id").to_pylist()], np.int64)
            x = np.frombuffer(b"".join(part.column("v").to_pylist()), "<i8").reshape(part.num_rows, -1)
            norm, angle = angles_to(x.astype(float), references)
            blob = b"".join((struct.pack("<3q", part.num_rows, x.shape[1], angle.shape[1]), ids.tobytes(),
                             part.column("label").to_numpy().astype("<i8").tobytes(), x.tobytes(), norm.tobytes(), angle.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["rows_of"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= size:
                yield from flush(held)
                held, n = [], 0
        if held:
            yield from flush(held)

    return rows.select("vec_id", "label", "v").mapInArrow(run, "rows_of binary")


def _unpack(blob: bytes):
    n, d, r = struct.unpack_from("<3q", blob)
    at = 24
    out = []
    for kind, count in (("<i8", n), ("<i8", n), ("<i8", n * d), ("<f8", n), ("<f4", n * r)):
        out.append(np.frombuffer(blob, kind, count, at))
        at += count * np.dtype(kind).itemsize
    ids, labels, x, norm, angle = out
    return ids, labels, x.reshape(n, d).astype(float), norm, angle.reshape(n, r)


def first_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` by falling score, then smaller id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= cut)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _id(x: int):
    return None if x == _NO_ID else x


def _positives(references: np.ndarray, k: int):
    names = ["a_id", "a_label", "a_v", "id", "score"]

    def run(batches):
        for batch in batches:
            for blob, anchors in zip(batch.column("rows_of").to_pylist(), batch.column("anchors").to_pylist()):
                ids, labels, x, norms, angles = _unpack(blob)
                out: list[list] = [[] for _ in names]
                for a in anchors:
                    av = np.frombuffer(a["v"], "<i8").astype(float)
                    an, aa = angles_to(av[None], references)
                    rows = np.flatnonzero((labels == a["label"]) & (ids != a["vec_id"]))
                    if not len(rows):
                        continue
                    low, high = score_bounds(an[0], aa[0], norms[rows], angles[rows])
                    if len(rows) > k:  # the k-th largest lower bound: k rows reach it
                        rows = rows[high >= np.partition(low, len(low) - k)[len(low) - k]]
                    scores = _scores(x, rows, av)
                    for p in first_of(scores, ids[rows], k):
                        for v, z in zip(out, (a["vec_id"], a["label"], a["v"], _id(int(ids[rows[p]])), int(scores[p]))):
                            v.append(z)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()))], names=names)
    return run


def _scores(x: np.ndarray, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact integer scores: all partial sums are whole numbers below 2^53."""
    return (x[rows] @ anchor).astype(np.int64)


def _negatives(references: np.ndarray, k: int, window: tuple[int, int]):
    names = ["a_id", "a_key", "p_rank", "id", "score"]

    def run(batches):
        for batch in batches:
            for blob, anchors in zip(batch.column("rows_of").to_pylist(), batch.column("anchors").to_pylist()):
                ids, labels, x, norms, angles = _unpack(blob)
                out: list[list] = [[] for _ in names]
                for a in anchors:
                    wanted = [p for p in a["positives"] if p["score"] >= 0]  # below 0 the window is empty
                    rows = np.flatnonzero((labels != a["label"]) & (ids != a["vec_id"])) if wanted else ()
                    if not len(rows):
                        continue
                    av = np.frombuffer(a["v"], "<i8").astype(float)
                    an, aa = angles_to(av[None], references)
                    low, high = score_bounds(an[0], aa[0], norms[rows], angles[rows])
                    open_ = np.zeros(len(rows), bool)
                    for p in wanted:
                        from_, to = -(-window[0] * p["score"] // 100), window[1] * p["score"] // 100
                        sure = low[(low >= from_) & (high <= to)]  # rows certainly inside: the k-th of them is a floor
                        floor = max(from_, np.partition(sure, len(sure) - k)[len(sure) - k]) if len(sure) >= k else from_
                        open_ |= (high >= floor) & (low <= to)
                    rows = rows[open_]
                    scores = _scores(x, rows, av)
                    for p in wanted:
                        inside = np.flatnonzero((100 * scores >= window[0] * p["score"]) & (100 * scores <= window[1] * p["score"]))
                        for i in inside[first_of(scores[inside], ids[rows[inside]], k)]:
                            for v, z in zip(out, (a["vec_id"], a["key"], p["rank"], _id(int(ids[rows[i]])), int(scores[i]))):
                                v.append(z)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=names)
    return run


def pack_anchors(anchors: DataFrame, size: int = ANCHOR_BLOCK) -> DataFrame:
    """(anchors): lists of about ``size`` anchors each."""
    blocks = max(1, -(-anchors.count() // size))
    return anchors.groupBy(F.pmod(F.xxhash64(*anchors.columns[:3], F.lit(7)), F.lit(blocks)).alias("b")) \
        .agg(F.collect_list(F.struct(*anchors.columns)).alias("anchors")).select("anchors")


def _first(df: DataFrame, by: list[str], k: int, rank: str) -> DataFrame:
    """The first ``k`` rows of each group by falling score, then smaller id; Spark limits groups before the shuffle too."""
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def mine(rows: DataFrame, anchors: DataFrame, references: np.ndarray, positives: int = POSITIVES, negatives: int = NEGATIVES,
         window: tuple[int, int] = WINDOW, row_block: int = ROW_BLOCK, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for ``rows`` and ``anchors``
    (vec_id, label, v), as ``usable_rows`` gives them."""
    blocks = table(pack_rows(rows, references, row_block), "row-blocks")
    # a block is one large record and few of them make a file: each is a task's work of its own
    blocks = blocks.repartition(max(1, min(blocks.count(), 100_000)))
    asked = table(pack_anchors(anchors.dropDuplicates(["vec_id", "label", "v"]), anchor_block), "anchor-blocks")
    near = blocks.crossJoin(asked).mapInArrow(_positives(references, positives), "a_id long, a_label long, a_v binary, id long, score long")
    best = table(_first(near, ["a_id", "a_label", "a_v"], positives, "p_rank"), "positives")
    # an anchor row's key: its id alone may be repeated with another label or vector
    keyed = best.groupBy("a_id", "a_label", "a_v").agg(F.sort_array(F.collect_list(F.struct(
        F.col("p_rank").alias("rank"), "id", "score"))).alias("positives")).select(
        F.col("a_id").alias("vec_id"), F.col("a_label").alias("label"), F.col("a_v").alias("v"), "positives",
        F.xxhash64("a_id", "a_label", "a_v").alias("key"))
    keyed = table(keyed, "anchors")
    found = blocks.crossJoin(table(pack_anchors(keyed, anchor_block), "anchor-windows")).mapInArrow(
        _negatives(references, negatives, window), "a_id long, a_key long, p_rank int, id long, score long")
    ranked = _first(found, ["a_id", "a_key", "p_rank"], negatives, "rank")
    told = keyed.select(F.col("vec_id").alias("a_id"), F.col("key").alias("a_key"), F.explode("positives").alias("p")).select(
        "a_id", "a_key", F.col("p.rank").alias("p_rank"), F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    return ranked.join(told, ["a_id", "a_key", "p_rank"]).select(
        F.col("a_id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def hard_negatives(rows: DataFrame, is_anchor, label=None, vec_id: str = "vec_id", vector: str = "embedding",
                   label_col: str = "label", scale: int = SCALE, **options) -> DataFrame:
    """Hard negatives of the rows for which ``is_anchor(vec_id column)`` holds; ``label(vec_id, label)`` may
    change labels first."""
    usable = usable_rows(rows, vec_id, vector, label_col, scale)
    if label is not None:
        usable = usable.withColumn("label", label(F.col("vec_id"), F.col("label")))
    usable = table(usable, "usable-rows")
    lengths = usable.agg(F.min(F.octet_length("v")).alias("lo"), F.max(F.octet_length("v")).alias("hi")).first()
    if lengths.lo != lengths.hi:
        raise ValueError("vectors differ in length")
    references = references_of(usable)
    return mine(usable, usable.where(is_anchor(F.col("vec_id"))), references, **options)

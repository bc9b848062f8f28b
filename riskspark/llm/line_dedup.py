"""Line dedup: a suffix array over line-ID sequences by distributed prefix doubling.

A text is the sequence of its lines that hold a word; equal lines have equal IDs (XXH64). Texts lie one after
the other by (id, text hash), so a line's place is one number. Round k ranks the blocks of 2^k lines: the pair
of ranks of a block's halves, counted per distinct pair and put in order by a range sort, gives the next rank,
so ranks rise with the suffix array. A group of equal ranks is the interval of suffixes whose common prefix is at
least 2^k lines, and keeps its first place; blocks that are alone are settled and leave, so later rounds hold repeated
text only. Intervals of any depth come from two overlapping blocks.

Every place of an interval but its first is a later copy, and its block goes: blocks of ``MIN_LINES`` lines or more,
and single lines of ``MIN_WORDS`` words or more. With ``min_words`` 1, as in the registered query, single lines of any
length do. The marked blocks are then joined to maximal copies: from the left, the deepest block that starts at a line,
made longer by all blocks that start inside it or right behind it and whose first places lie at the same distance. A copy is so many
lines that stand as they are in one earlier text. Deleted lines in a row, of one or more copies, are one run.

No group of places is gathered anywhere: groups are counted and their first place found by sums and minima. A block
that over a thousandth of all repeated blocks equal meets its rank by a broadcast (of under 1,000 such groups), so a line may
make up any part of the table. Equal rows are one entry with a multiplicity; its further rows are later copies throughout.

Defined results: a null or empty text has no lines; blank lines are never deleted; null ids come
last; equal rows give one first copy and else later ones; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import table
from riskspark.llm.suffix_dedup import text_key

MIN_LINES = 2
MIN_WORDS = 50
HOT = 10_000  # a block with fewer places needs no broadcast


def entries(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, t1, t2, m, ids, at, long): distinct rows, with line IDs, line numbers and the long lines."""
    src = docs.select(F.col(f"`{doc_id}`").alias("id"), *text_key(text), F.col(f"`{text}`").cast("string").alias("text"))
    schema = src.select("id", "t1", "t2", F.expr("cast(array() as array<bigint>) ids"),
                        F.expr("cast(array() as array<int>) at"), F.expr("cast(array() as array<boolean>) long")).schema

    def run(batches):
        from xxhash import xxh64_intdigest as xx

        for batch in batches:
            ids, at, long = [], [], []
            for t in batch.column(3).cast(pa.binary()).to_pylist():
                lines = [(k, x) for k, x in enumerate((t or b"").split(b"\n")) if x and not x.isspace()]
                ids.append([h - (1 << 64) if (h := xx(x)) >> 63 else h for _, x in lines])
                at.append([k for k, _ in lines])
                long.append([len(x) >= 2 * min_words - 1 and len(x.split()) >= min_words for _, x in lines])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(3)], pa.array(ids, pa.list_(pa.int64())), pa.array(at, pa.list_(pa.int32())),
                 pa.array(long, pa.list_(pa.bool_()))], names=["id", "t1", "t2", "ids", "at", "long"])

    rows = src.mapInArrow(run, schema)
    return rows.groupBy("id", "t1", "t2").agg(F.count(F.lit(1)).alias("m"), F.first("ids").alias("ids"),
                                              F.first("at").alias("at"), F.first("long").alias("long"))


def placed(e: DataFrame) -> DataFrame:
    """The entries in the order (id, t1, t2), null ids last, with ``e``, the place of their first line.

    Line i of an entry has the place ``e + i``; between entries a place stays free, so that lines of two texts never adjoin."""
    src = e.withColumn("no", F.col("id").isNull())
    src = src.repartitionByRange("no", "id", "t1", "t2").sortWithinPartitions("no", "id", "t1", "t2").drop("no")
    at = src.columns.index("ids")

    def run(batches):
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            n = np.asarray(pc.list_value_length(batch.column(at)), dtype=np.int64) + 1
            ends = base + np.cumsum(n)
            base = int(ends[-1]) if len(n) else base
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends - n, pa.int64())], names=[*batch.schema.names, "e"])

    return src.mapInArrow(run, src.withColumn("e", F.lit(0).cast("long")).schema)


def _ranked(blocks: DataFrame, name: str) -> DataFrame | None:
    """The repeated ones of ``blocks`` (e, p, r1, r2) as (e, p, rank, first_e, first): the rank of their pair in the suffix
    array and the first place of their interval. None if no block repeats."""
    key = ["r1", "r2"]
    # places rise with e, so the least place lies in the least entry
    counts = blocks.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("e").alias("first_e"), F.min("p").alias("first")).where("n > 1")
    groups = table(counts.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("rank", F.monotonically_increasing_id()),
                   f"{name}-groups")
    size = groups.agg(F.sum("n").alias("all"), F.max("n").alias("most")).first()
    if not size["all"]:
        return None
    bound, named = max(HOT, size["all"] // 1000), groups.drop("n")
    if size["most"] > bound:
        hot = F.broadcast(groups.where(F.col("n") > bound).drop("n"))  # under 1,000 groups
        found = blocks.join(hot, key).unionByName(
            blocks.join(hot.select(*key), key, "left_anti").join(groups.where(F.col("n") <= bound).drop("n"), key))
    else:
        found = blocks.join(named, key)
    return table(found.select("e", "p", "rank", "first_e", "first"), name)


def levels(lines: DataFrame) -> list[DataFrame]:
    """Round by round, the repeated blocks of 1, 2, 4, ... lines (see ``_ranked``) of ``lines`` (e, p, line)."""
    out: list[DataFrame] = []
    level = _ranked(lines.select("e", "p", F.col("line").alias("r1"), F.lit(0).cast("long").alias("r2")), "lines-0")
    while level is not None:
        out.append(level)
        level = _ranked(pairs(level, 1 << (len(out) - 1)), f"lines-{len(out)}")
    return out


def pairs(level: DataFrame, step: int) -> DataFrame:
    """Each block with the rank of the block ``step`` lines on; a block without one has no repeat there."""
    later = level.select("e", (F.col("p") - step).alias("p"), F.col("rank").alias("r2"))
    return level.select("e", "p", F.col("rank").alias("r1")).join(later, ["e", "p"])


def copies_of(n: int, marks: list[dict]) -> tuple[set[int], list[dict]]:
    """The deleted lines of a text of ``n`` lines and its maximal copies (line, n, first_e, first_line)."""
    starts: dict[int, list[tuple[int, int, int]]] = {}  # line: (end, distance to the first place, first_e)
    for x in marks:
        starts.setdefault(x["i"], []).append((x["i"] + x["size"], x["first"] - x["i"], x["first_e"]))
    gone: set[int] = set()
    out, reach, k = [], (0, 0, 0), 0
    while k < n:
        reach = max(reach, *starts.get(k, ()), key=lambda m: m[0]) if k in starts else reach
        if reach[0] <= k:
            k += 1
            continue
        end, far, entry = max(starts[k]) if k in starts else reach
        j = k + 1
        while j <= end and j < n:
            for m in starts.get(j, ()):
                if m[1] == far:
                    end = max(end, m[0])
                if m[0] > reach[0]:
                    reach = m
            j += 1
        out.append({"line": k, "n": end - k, "first_e": entry, "first_line": k + far - entry})
        gone.update(range(k, end))
        k = end
    return gone, out


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES,
                  min_words: int = MIN_WORDS) -> DataFrame:
    """(id, t1, t2, m, e, first, longest_block, n_lines, runs, copies) per distinct row, twice where it repeats.

    ``runs`` are the deleted (first line, last line) runs, counted over lines with a word in between only; ``copies`` the
    maximal copies they consist of: line, number of lines, entry and line of the first copy, all counted over lines with a word;
    the row with ``first`` stands for the first of the ``m`` equal rows, the other for the rest.
    """
    e = table(placed(entries(docs, doc_id, text, min_words)), "line-entries")
    lines = e.select("e", F.posexplode("ids").alias("i", "line")).select("e", (F.col("e") + F.col("i")).alias("p"), "line")
    rounds = levels(lines)
    k = min_lines.bit_length() - 1
    every = min_words <= 1
    gone = [(1 << j, level) for j, level in enumerate(rounds) if every or 1 << j >= min_lines]
    if not every and len(rounds) > k and min_lines != 1 << k:
        deep = _ranked(pairs(rounds[k], min_lines - (1 << k)), "lines-deep")
        gone += [(min_lines, deep)] if deep is not None else []
    if not every and rounds and min_lines > 1:
        heavy = e.select("e", F.posexplode("long").alias("i", "is_long")).where("is_long").select("e", (F.col("e") + F.col("i")).alias("p"))
        gone.append((1, rounds[0].join(heavy, ["e", "p"])))
    mark = F.struct((F.col("p") - F.col("e")).cast("int").alias("i"), F.col("size"), "first_e", "first")
    marked = e.select("e", F.lit(0).alias("size"), F.expr("cast(null as struct<i:int,size:int,first_e:bigint,first:bigint>)").alias("mark")).limit(0)
    for size, level in gone:
        level = level.where(F.col("p") != F.col("first")).withColumn("size", F.lit(size))
        marked = marked.unionByName(level.select("e", F.lit(0).alias("size"), mark.alias("mark")))
    for j, level in enumerate(rounds):
        marked = marked.unionByName(level.select("e", F.lit(1 << j).alias("size"), F.lit(None).alias("mark")).distinct())
    marked = marked.groupBy("e").agg(F.max("size").alias("longest_block"), F.collect_list("mark").alias("marks"))
    rows = e.join(marked, "e", "left")
    rows = rows.withColumn("first", F.explode(F.when(F.col("m") > 1, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))))
    src = rows.select("id", "t1", "t2", "m", "e", "first", F.coalesce("longest_block", F.lit(0)).cast("long").alias("longest_block"),
                      "at", "long", "marks")
    schema = src.select("id", "t1", "t2", "m", "e", "first", "longest_block", F.lit(0).cast("long").alias("n_lines"),
                        F.expr("cast(array() as array<struct<lo:int,hi:int,n:int>>)").alias("runs"),
                        F.expr("cast(array() as array<struct<line:int,n:int,first_e:bigint,first_line:bigint>>)").alias("copies")).schema
    run_type = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32()), ("n", pa.int32())]))
    copy_type = pa.list_(pa.struct([("line", pa.int32()), ("n", pa.int32()), ("first_e", pa.int64()), ("first_line", pa.int64())]))

    def finish(batches):
        for batch in batches:
            n_lines, runs, copies = [], [], []
            for at_e, first, at, long, found in zip(*[batch.column(i).to_pylist() for i in (4, 5, 7, 8, 9)]):
                n = len(at)
                if not first:  # a later one of equal rows: all of it stands in the first
                    whole = n and n >= min_lines
                    found = [{"i": k, "size": n if whole else 1, "first_e": at_e, "first": at_e + k}
                             for k in ([0] if whole else range(n)) if whole or every or long[k]]
                gone, made = copies_of(n, found or [])
                spans: list[dict] = []
                prev = -2
                for k in sorted(gone):
                    if k == prev + 1:
                        spans[-1]["hi"] = at[k]
                        spans[-1]["n"] += 1
                    else:
                        spans.append({"lo": at[k], "hi": at[k], "n": 1})
                    prev = k
                n_lines.append(n)
                runs.append(spans)
                copies.append(made)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(7)], pa.array(n_lines, pa.int64()), pa.array(runs, run_type), pa.array(copies, copy_type)],
                names=["id", "t1", "t2", "m", "e", "first", "longest_block", "n_lines", "runs", "copies"])

    return src.mapInArrow(finish, schema)


def each_row(found: DataFrame) -> DataFrame:
    """One row per row of the documents: the first of ``m`` equal rows, and ``m - 1`` times the other."""
    step = 10_000
    n = F.when(F.col("first"), F.lit(1).cast("long")).otherwise(F.col("m") - 1)
    blocks = found.withColumn("__n", n).withColumn("__b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / step))))
    return blocks.withColumn("__k", F.explode(F.sequence(F.col("__b") * step, F.least((F.col("__b") + 1) * step, F.col("__n")) - 1))) \
        .drop("__n", "__b", "__k")


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(id, text) of every row of ``docs`` without its later copies of repeated runs."""
    found = each_row(removed_lines(docs, doc_id, text, **options))
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), *text_key(text), F.col(f"`{text}`").cast("string").alias("text")) \
        .groupBy("id", "t1", "t2").agg(F.first("text").alias("text"))
    a, b = found.alias("a"), texts.alias("b")
    src = a.join(b, F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.t1") == F.col("b.t1")) & (F.col("a.t2") == F.col("b.t2"))) \
        .select("a.id", "b.text", "a.runs")

    def cut(batches):
        for batch in batches:
            out = []
            for t, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if t is not None and runs:
                    lines = t.split("\n")
                    gone = {k for r in runs for k in range(r["lo"], r["hi"] + 1) if lines[k].encode() and not lines[k].encode().isspace()}
                    t = "\n".join(x for k, x in enumerate(lines) if k not in gone)
                out.append(t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["id", "text"])

    return src.mapInArrow(cut, src.select("id", "text").schema)

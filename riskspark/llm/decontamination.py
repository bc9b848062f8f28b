"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows.

Every run of ``window`` consecutive words of a benchmark item is a pattern of the automaton,
padded with spaces so that it matches whole words only. A document is normalised to its
lower-cased words joined by single spaces and scanned once; matches map back to word numbers
and, for documents with matches, to code-point offsets of the original text.

The automaton is built in each task from the broadcast item texts. It holds about 60 nodes a
word, so items go in blocks of at most ``block_bytes`` of text (checked by a count); with more
than one block the blocks scan the text one after the other in the same stage.

Defined results: a null or empty text has no words and no hits; an item without words, or a null
item text, is never found; repeated item rows count once; a null item id reads ``null``; an empty
benchmark hits nothing; other columns are ignored by ``scan`` and kept by ``decontaminate``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import WORD_TABLE, map_texts, with_safe_names, words_of

WINDOW = 10
BLOCK_BYTES = 256 << 10

_HIT = T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
                     T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text",
                block_bytes: int = BLOCK_BYTES) -> list[list[tuple[str, bytes]]]:
    """The items as (id, text) lists of at most about ``block_bytes`` each."""
    src = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("i"),
                       F.col(text).cast("binary").alias("t")).where(F.col("t").isNotNull()).distinct()
    blocks: list[list[tuple[str, bytes]]] = [[]]
    size = 0
    for r in src.orderBy("i", "t").toLocalIterator():
        if size and size + len(r.t) > block_bytes:
            blocks.append([])
            size = 0
        blocks[-1].append((r.i, bytes(r.t)))
        size += len(r.t)
    return blocks


def _scanner(block: list[tuple[str, bytes]], window: int):
    import ahocorasick

    owners: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in block:
        words = words_of(text)
        for k in range(max(1, len(words) - window + 1) if words else 0):
            owners.setdefault(tuple(words[k:k + window]), set()).add(item)
    auto = ahocorasick.Automaton()
    for words, ids in owners.items():
        auto.add_word((b" " + b" ".join(words) + b" ").decode("latin-1"), (len(words), sorted(ids)))
    auto.make_automaton()
    empty = not owners

    def scan(texts: list[bytes]) -> dict[str, list]:
        out: dict[str, list] = {"n_words": [], "items": [], "hits": []}
        for t in texts:
            words = words_of(t)
            out["n_words"].append(len(words))
            found = []
            if words and not empty:
                norm = b" " + b" ".join(words) + b" "
                found = list(auto.iter(norm.decode("latin-1")))
            if not found:
                out["items"].append([])
                out["hits"].append([])
                continue
            gaps = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)
            last = np.searchsorted(gaps, [e for e, _ in found]) - 1
            first = last - np.array([n for _, (n, _) in found]) + 1
            runs: list[list[int]] = []
            for a, b in sorted(zip(first.tolist(), last.tolist())):
                if runs and a <= runs[-1][1] + 1:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
            out["items"].append(sorted({i for _, (_, ids) in found for i in ids}))
            out["hits"].append([{"first": a, "last": b, "start": s, "end": e}
                                for (a, b), (s, e) in zip(runs, original_offsets(t, runs))])
        return out

    return scan


def original_offsets(text: bytes, runs: list[list[int]]) -> list[tuple[int, int]]:
    """Code-point (start, end) in ``text`` of runs of word numbers (first, last)."""
    inside = np.concatenate(([0], np.frombuffer(text.translate(WORD_TABLE), np.uint8) != 32, [0])).astype(np.int8)
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [(int(points[starts[a]]), int(points[ends[b]])) for a, b in runs]


def scan(docs: DataFrame, items: DataFrame, keep=("doc_id",), text: str = "text", item_id: str = "item_id",
         item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, prefix: str = "") -> DataFrame:
    """``keep`` plus n_words, n_hit (words inside a window), items (ids as sorted strings) and
    hits (maximal runs: word numbers first..last, code points start..end) per document."""
    blocks = item_blocks(items, item_id, item_text, block_bytes)
    # columns are called c0, c1, ... on the way, as no helper column is
    names, safe = list(keep), {c: f"c{i}" for i, c in enumerate(dict.fromkeys([*keep, text]))}
    docs = docs.select(*[F.col(f"`{c}`").alias(s) for c, s in safe.items()])
    keep, text = [safe[c] for c in names], safe[text]
    hits = T.ArrayType(_HIT)
    fields = [T.StructField("n_words", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())),
              T.StructField("hits", hits)]
    out = docs
    for k, block in enumerate(blocks):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        cols = keep if k == len(blocks) - 1 and text not in keep else list(dict.fromkeys([*keep, text]))
        done = [] if k == 0 else [f"__{f.name}{j}" for j in range(k) for f in fields]
        out = map_texts(out, lambda b=shared: _scanner(b.value, window),
                        [T.StructField(f"__{f.name}{k}", f.dataType) for f in fields], text, [*cols, *done])
    every = range(len(blocks))
    items_all = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(f"__items{k}") for k in every]))))
    hits_all = F.col("__hits0") if len(blocks) == 1 else _merged(F.flatten(F.array(*[F.col(f"__hits{k}") for k in every])))
    return out.select(
        *[F.col(k).alias(c) for c, k in zip(names, keep)], F.col("__n_words0").alias(f"{prefix}n_words"),
        F.aggregate(hits_all, F.lit(0).cast("long"), lambda a, h: a + h["last"] - h["first"] + 1).alias(f"{prefix}n_hit"),
        items_all.alias(f"{prefix}items"), hits_all.alias(f"{prefix}hits"),
    )


def _merged(hits):
    """Overlapping or touching runs of several blocks as maximal runs."""
    zero = F.expr("cast(array() as array<struct<first: bigint, last: bigint, start: bigint, end: bigint>>)")

    def add(acc, h):
        prev = F.element_at(acc, -1)
        joined = F.struct(prev["first"].alias("first"), F.greatest(prev["last"], h["last"]).alias("last"),
                          prev["start"].alias("start"), F.greatest(prev["end"], h["end"]).alias("end"))
        touches = (F.size(acc) > 0) & (h["first"] <= F.try_element_at(acc, F.lit(-1))["last"] + 1)
        return F.when(touches, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(joined))) \
            .otherwise(F.concat(acc, F.array(h)))

    return F.aggregate(F.array_sort(hits), zero, add)


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, with their columns."""
    return with_safe_names(docs, lambda d, at: scan(d, items, keep=d.columns, text=at(text), prefix="__dc_", **options)
                           .where(F.col("__dc_n_hit") == 0).select(*d.columns))

"""Quality rules with compression bands: zstandard ratios of whole texts and of fixed chunks.

``ratio`` is compressed bytes / raw bytes. Prose of a given length falls in a narrow band;
repetitive text lies below it, random or encoded text above. Short texts compress less, so the
limits depend on the length: at ``n`` bytes the band of whole texts is
``[low(n), high(n)]`` interpolated in log2(n) between the points of ``BANDS``. Texts longer than one chunk are also cut
into chunks of ``CHUNK`` bytes (the rest joins the last chunk), texts under two chunks into chunks of a half, a quarter or
an eighth of that, so that there are two or three; texts under 1 KB have no chunks; each chunk has its own ratio with
the band of its length, and the text fails when over ``MAX_BAD_SHARE`` of its chunk bytes lie
outside, or when ``MAX_BAD_RUN`` windows of a chunk's bytes in a row, half a chunk apart, do: a foreign passage of about a chunk and
a half is found wherever it starts and however long the text is. On sf0.1 no chunk of a text that passes the other rules is
outside (1,273 chunks of 4 KB; of texts under 8 KB none of 6,030 either). Base rules (word count, repeated 5-word windows) come first.

Defined results: a null text counts as empty; it has no words, so it fails the base rules and is
not kept. Repeated rows give repeated equal results, null ids are nothing special, an empty table gives an
empty result, and columns of any name pass through if they are in ``keep``.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import BLANKS, code_points, map_texts

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
GRAM = 5
SYMBOLS = b"#*$%&|<>"
LEVEL = 3
CHUNK = 4096
MAX_BAD_SHARE = 0.10
MAX_BAD_RUN = 2
# (bytes, low, high): limits of the ratio at these lengths, about 15 % either side of prose.
BANDS = ((64, 0.70, 1.35), (128, 0.60, 1.25), (256, 0.52, 1.02), (512, 0.46, 0.86), (1024, 0.43, 0.76),
         (4096, 0.39, 0.60), (16384, 0.36, 0.58), (1 << 20, 0.30, 0.56))

FIELDS = [
    *[T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    T.StructField("ratio", T.DoubleType()), T.StructField("bad_share", T.DoubleType()),
    T.StructField("in_band", T.BooleanType()), T.StructField("bad_run", T.LongType()),
]


def band(n: int, bands=BANDS) -> tuple[float, float]:
    """Limits of the compression ratio for a text of ``n`` bytes."""
    x = math.log2(max(n, 1))
    pts = [math.log2(b) for b, _, _ in bands]
    return (float(np.interp(x, pts, [lo for _, lo, _ in bands])), float(np.interp(x, pts, [hi for *_, hi in bands])))


def repeat_words(words: list[list[bytes]], gram: int = GRAM) -> list[int]:
    """Per text, the words covered by ``gram``-word windows that the text has twice or more."""
    counts = np.array([len(w) for w in words], np.int64)
    n = int(counts.sum())
    if n < gram:
        return [0] * len(words)
    with np.errstate(over="ignore"):
        h = np.fromiter((hash(w) for ws in words for w in ws), np.int64, n).view(np.uint64)
        doc = np.repeat(np.arange(len(words), dtype=np.uint64), counts)
        key = doc[: n - gram + 1] * np.uint64(0x9E3779B97F4A7C15)
        for k in range(gram):
            key = (key ^ h[k:n - gram + 1 + k]) * np.uint64(0xD6E8FEB86659FD93 + 2 * k)
            key ^= key >> np.uint64(32)
    whole = np.flatnonzero(doc[: n - gram + 1] == doc[gram - 1:])
    order = whole[np.argsort(key[whole])]
    same = key[order[1:]] == key[order[:-1]]
    start = np.zeros(n + gram, np.int32)
    start[order[1:][same]] = 1
    start[order[:-1][same]] = 1
    total = np.concatenate(([0], np.cumsum(start)))
    i = np.arange(n)
    covered = (total[i + 1] - total[np.maximum(i + 1 - gram, 0)]) > 0
    return np.bincount(doc.astype(np.int64), covered, len(words)).astype(np.int64).tolist()


def _measure(bands=BANDS, chunk: int = CHUNK, level: int = LEVEL):
    import zstandard

    press = zstandard.ZstdCompressor(level=level)
    limits: dict[int, tuple[float, float]] = {}

    def of(n: int) -> tuple[float, float]:
        if n not in limits:
            if len(limits) > 100_000:
                limits.clear()
            limits[n] = band(n, bands)
        return limits[n]

    def run(texts: list[bytes]) -> dict[str, list]:
        out: dict[str, list] = {f.name: [] for f in FIELDS}
        words = [t.split() for t in texts]
        out["n_repeat_words"] = repeat_words(words)
        for t, w in zip(texts, words):
            out["n_words"].append(len(w))
            out["word_chars"].append(code_points(t.translate(None, BLANKS)))
            out["n_symbols"].append(len(t) - len(t.translate(None, SYMBOLS)))
            lines = [x for x in t.split(b"\n") if x and not x.isspace()]
            out["n_dup_lines"].append(len(lines) - len(set(lines)))
            ratio = len(press.compress(t)) / len(t) if t else None
            lo, hi = of(len(t))
            out["ratio"].append(ratio)
            out["in_band"].append(ratio is not None and lo <= ratio <= hi)
            size = chunk
            while 2 * size > len(t) and 8 * size > chunk:
                size //= 2
            n_chunks = len(t) // size
            bad = run_now = run_most = 0
            for k in range(2 * n_chunks - 1 if n_chunks > 1 else 0):  # chunks, and the windows between them
                at = k * size // 2
                part = t[at: at + size if k < 2 * n_chunks - 2 else len(t)]
                lo, hi = of(len(part))
                outside = not lo <= len(press.compress(part)) / len(part) <= hi
                bad += len(part) * (outside and k % 2 == 0)
                run_now = run_now + 1 if outside else 0
                run_most = max(run_most, run_now)
            out["bad_share"].append(bad / len(t) if t else 0.0)
            out["bad_run"].append(run_most)
        return out

    return run


def measure(docs: DataFrame, keep=("doc_id",), text: str = "text", bands=BANDS, chunk: int = CHUNK,
            max_bad_share: float = MAX_BAD_SHARE, max_bad_run: int = MAX_BAD_RUN, min_words: int = MIN_WORDS,
            max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """``keep`` plus the counts of the base rules, ratio, bad_share, bad_run, base_failed and kept."""
    out = map_texts(docs, lambda: _measure(bands, chunk), FIELDS, text, keep)
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return out.withColumn("base_failed", base).withColumn(
        "kept", ~F.col("base_failed") & F.col("in_band") & (F.col("bad_share") <= max_bad_share)
        & (F.col("bad_run") < max_bad_run))

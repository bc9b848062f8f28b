"""N-gram join, whitening and hard negatives against brute force; column names; the registered queries' own columns."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm import decontamination, hard_negatives, mixing, ngram_join, pii, quality, queries, simhash, suffix_dedup, toxicity, whitening
from tests.conftest import SMALL

SCHEMA = "doc_id long, text string, n_shingles string, sid string, root string"


# ---- 11 --------------------------------------------------------------------------------------

def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def shingle_set(t, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_components(rows, percent=90):
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, s) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(s), (least.get(find(k)) if s else i)) for k, (i, s) in enumerate(sets)), key=repr)


def joined(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA)
    return sorted((tuple(r) for r in ngram_join.classes(df, **options).select("id", "n_shingles", "component_id").collect()), key=repr)


def near_copies(rnd, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(9999)}"
        out.append(" ".join(w))
    return out


def test_ngram_join_equals_brute_force(spark):
    rnd = random.Random(1)
    texts = [None, "", " \t\n", "One", "one", "two words", "Two  Words", "a b c", "a b c d", "é ü ß", "\x1c odd \x85 blanks"]
    for size in (9, 12, 19, 20, 40, 150, 400):
        base = [f"w{rnd.randrange(size * 3)}" for _ in range(size)]
        texts += near_copies(rnd, base, 14, max(1, size // 25))
        texts.append(" ".join(base + base[:max(1, size // 12)]))   # longer, by about a link's limit
    rows = list(enumerate(texts)) + [(7, "a b c"), (None, "a b c d"), (None, None), (None, "no id at all here"), (3, "One")]
    want = brute_components(rows)
    assert joined(spark, rows) == want
    assert joined(spark, rows, max_sets=4, hubs=2) == want        # every shard hot: blocks, hubs and the search across blocks
    assert joined(spark, rows[:40], percent=60) == brute_components(rows[:40], 60)


def test_ngram_join_hot_group_and_chains(spark):
    """Hundreds of near copies in a chain: neighbours link, ends do not; plus a shared passage."""
    rnd = random.Random(2)
    words = [f"c{i}" for i in range(60)]
    chain = []
    for k in range(120):
        words = words[:]
        words[rnd.randrange(60)] = f"n{k}"
        chain.append(" ".join(words))
    passage = " ".join(f"p{i}" for i in range(30))
    shared = [passage + " " + " ".join(f"u{k}x{i}" for i in range(30)) for k in range(60)]
    rows = list(enumerate(chain + shared))
    rnd.shuffle(rows)
    want = brute_components(rows)
    assert joined(spark, rows, max_sets=16, hubs=4) == want == joined(spark, rows)


def test_t_occurrence_search_alone():
    rnd = random.Random(3)
    for _ in range(30):
        lists = [sorted(rnd.sample(range(30), rnd.randrange(1, 12))) for _ in range(rnd.randrange(1, 9))]
        for t in range(1, len(lists) + 1):
            count = {x: sum(x in y for y in lists) for x in range(30)}
            assert ngram_join.merge_skip(lists, t) == sorted((x, c) for x, c in count.items() if c >= t)
    for percent in (90, 75):
        for n in range(1, 400):
            classes = ngram_join.size_classes(n, percent)
            below = -(-n * percent // 100)  # the smallest size that can link with n
            assert any(lo <= below <= hi for lo, hi in classes)


def test_ngram_join_empty_table(spark):
    assert joined(spark, []) == []


# ---- 12 --------------------------------------------------------------------------------------

def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, n string, v string, component string")


def brute_whitening(rows, k=16):
    good = [(i, np.array(v, float)) for i, v, *_ in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([np.floor(64 * v) for _, v in good]).astype(np.int64) + 1_000_000
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    c = u - s / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1], q[:, ::-1]
    return good, n, ((n * x - s) ** 2).sum(1), e, (x - s / n) @ q


def test_whitening_equals_eigenvectors(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(300, 20)) @ rng.normal(size=(20, 20)) / 3
    rows = [(i, [float(np.float32(x)) for x in v], 1, "a", "b", "c") for i, v in enumerate(data)]
    rows += [(900, None, 1, "", "", ""), (901, [None] + [0.0] * 19, 1, "", "", ""), (902, [float("nan")] + [0.0] * 19, 1, "", "", ""),
             (903, [float("inf")] * 20, 1, "", "", ""), (None, rows[0][1], None, None, None, None), rows[1], rows[1], (904, [], 1, "", "", "")]
    out = whitening.whiten(vectors(spark, rows)).orderBy("vec_id", "deviation", "component").collect()
    good, n, dev, e, proj = brute_whitening(rows)
    assert len(out) == 16 * len(good)
    told = {}
    for r in out:  # repeated rows give repeated results
        told.setdefault((r.vec_id, r.deviation, r.n), {}).setdefault(r.component, []).append(r.whitened)
    assert sorted(told, key=repr) == sorted({(i, int(d), n) for (i, _), d in zip(good, dev)}, key=repr)
    assert {len(x) for x in told[(1, int(dev[1]), n)].values()} == {3}
    b = proj[:, :16] / np.sqrt(e[:16])
    w = np.array([[told[(i, int(d), n)][c][0] for c in range(1, 17)] for (i, _), d in zip(good, dev)])
    sign = np.sign((w * b).sum(0))
    assert np.abs(w - sign * b).max() < 1e-8
    assert all(len(set(x)) == 1 for t in told.values() for x in t.values())
    explained = {r.component: r.explained for r in out}
    assert np.abs([explained[c] for c in range(1, 17)] - e[:16] / e.sum()).max() < 1e-12
    assert len({r.identity_error for r in out}) == 1 and out[0].identity_error < 1e-10


def test_whitening_of_low_rank_ties_and_nothing(spark):
    flat = [(i, [float(i), 2.0 * i, 1.0], 0, "", "", "") for i in range(9)]
    out = whitening.whiten(vectors(spark, flat)).collect()
    assert {r.component for r in out} == {1} and abs(out[0].explained - 1) < 1e-12 and len(out) == 9
    square = [(i, [float(a), float(b)], 0, "", "", "") for i, (a, b) in enumerate([(0, 0), (0, 1), (1, 0), (1, 1)])]
    out = whitening.whiten(vectors(spark, square)).collect()                    # equal eigenvalues: any rotation is right
    assert len(out) == 8 and all(abs(r.explained - 0.5) < 1e-12 and r.identity_error < 1e-12 for r in out)
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0], 0, "", "", "")] * 3)).collect() == []   # one distinct vector
    with pytest.raises(Exception):
        whitening.whiten(vectors(spark, [(1, [1.0], 0, "", "", ""), (2, [1.0, 2.0], 0, "", "", "")])).collect()
    v = np.array([[1 << 40, 0], [0, 1 << 40], [3, 5]])
    with pytest.raises(OverflowError):
        whitening.deviations(v, 3, [int(x) for x in v.sum(0)])
    assert whitening._products(v).tolist() == [[(1 << 80) + 9, 15], [15, (1 << 80) + 25]]


# ---- 13 --------------------------------------------------------------------------------------

def brute_negatives(rows, modulus=100, window=(30, 90)):
    good = [(i, (lab + 1) % 10 if i is not None and i % 7 == 0 else lab, np.floor(256 * np.array(v, float)).astype(np.int64))
            for i, v, lab, *_ in rows if lab is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out, seen = [], set()
    last = 1 << 62
    for i, lab, v in good:
        if i is None or i % modulus or (i, lab, v.tobytes()) in seen:
            continue
        seen.add((i, lab, v.tobytes()))
        others = [(int(v @ w), j, lj) for j, lj, w in good if j != i]
        order = lambda r: (-r[0], last if r[1] is None else r[1])
        for ps, p, _ in sorted((r for r in others if r[2] == lab), key=order)[:5]:
            fit = sorted((r for r in others if r[2] != lab and window[0] * ps <= 100 * r[0] <= window[1] * ps), key=order)[:10]
            out += [(i, p, k, j, ps, s) for k, (s, j, _) in enumerate(fit, 1)]
    return sorted(out, key=repr)


def mined(spark, rows, modulus=100, **options):
    out = hard_negatives.hard_negatives(vectors(spark, rows), lambda i: i % modulus == 0,
                                        lambda i, lab: F.when(i % 7 == 0, (lab + 1) % 10).otherwise(lab), **options)
    return sorted((tuple(r) for r in out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=repr)


def test_hard_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    centre = rng.normal(size=(6, 8))
    rows = [(i, [float(np.float32(x)) for x in centre[i % 6] + rng.normal(size=8) * 0.7], int(i % 4), "a", "b", "c") for i in range(600)]
    rows += [(i, [0.0] * 8, 1, "", "", "") for i in (700, 701, 702)] + [(800, rows[0][1], 0, "", "", ""), (801, rows[0][1], 0, "", "", "")]
    rows += [(1000, None, 1, "", "", ""), (1100, [None] * 8, 1, "", "", ""), (1200, [float("nan")] * 8, 1, "", "", ""),
             (1300, rows[5][1], None, "", "", ""), (None, rows[9][1], 2, None, None, None), (1400, [], 1, "", "", ""), rows[3], rows[100], rows[100]]
    want = brute_negatives(rows, 50)
    assert len(want) > 300
    assert mined(spark, rows, 50) == want
    assert mined(spark, rows, 50, row_block=64, anchor_block=3) == want       # many blocks of either side


def test_hard_negatives_of_little(spark):
    assert mined(spark, []) == []
    one = [(0, [1.0, 0.0], 3, "", "", "")]
    assert mined(spark, one) == []
    few = [(0, [1.0, 0.0], 3, "", "", ""), (1, [1.0, 0.0], 4, "", "", ""), (2, [0.5, 0.1], 4, "", "", ""), (3, [0.5, 0.0], 3, "", "", "")]
    assert mined(spark, few) == brute_negatives(few)
    with pytest.raises(Exception):
        mined(spark, [(0, [1.0], 3, "", "", ""), (1, [1.0, 0.0], 4, "", "", "")])


def test_score_bounds_hold_for_every_pair():
    """The filter never drops a score: bounds contain the exact product, also of parallel, opposite and zero vectors."""
    rng = np.random.default_rng(11)
    x = np.floor(256 * rng.normal(size=(400, 6)))
    x[:5], x[5:10], x[10] = x[20:25], -x[20:25], 0
    x[11:20] = x[20] * np.arange(1, 10)[:, None]
    ref = x[20:28] / np.linalg.norm(x[20:28], axis=1)[:, None]
    norm, angle = hard_negatives.angles_to(x, ref)
    for a in range(len(x)):
        low, high = hard_negatives.score_bounds(norm[a], angle[a], norm, angle)
        exact = x @ x[a]
        assert (low <= exact).all() and (exact <= high).all()


# ---- column names, null ids, strings of the queries ----------------------------------------------

HELPERS = ["__id", "__h", "__m", "__c", "__t", "__s", "__text", "__text_hash", "__row_text_hash", "__row_hash", "__n_words0", "__items0", "__hits0", "__dc_n_hit",
           "__tox_score", "t1", "t2", "spans", "kept", "n_bytes", "fp", "c0", "c1", "id", "n", "h", "a", "c", "size", "root", "TEXT_", "__b_email", "base_email", "sid", "th"]


def test_columns_of_any_name_pass_through(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = docs.select("*", *[F.lit(str(k)).alias(n) for k, n in enumerate(HELPERS)])
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    for f in (mixing.mixed, simhash.keep_one, lambda d: decontamination.decontaminate(d, items), lambda d: pii.redact(d, pii.Boosted()),
              lambda d: toxicity.remove_toxic(d, labels)):
        out = f(odd)
        assert out.columns == odd.columns
        rows = out.collect()
        assert rows and all(r[len(docs.columns) + k] == str(k) for r in rows[:20] for k in range(len(HELPERS)))
    out = suffix_dedup.remove_repeats(odd, keep=odd.columns)
    assert out.columns[:len(odd.columns)] == odd.columns and len(set(out.columns)) == len(out.columns) and out.count() == docs.count()
    assert ngram_join.classes(odd).count() == docs.count()


def test_null_ids_are_not_held_out(spark):
    d = spark.createDataFrame([(None,), (5,)], "doc_id long")
    got = d.select(toxicity.held_out(F.col("doc_id")).alias("h"), "doc_id").collect()
    assert got[0].h is False and all(isinstance(r.h, bool) for r in got)


def spans_of(text):
    """The contract's base spans, by plain regular expressions."""
    out = []
    t = text or ""
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 13 <= len(d) <= 19 and sum(sum(divmod(2 * x, 10)) if k % 2 else x for k, x in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_op7_query_names_every_span(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.QUERIES["op7_candidate_boosting"](spark, SMALL).collect()
    assert len(rows) == len(docs)
    some = 0
    for r in rows:
        base = spans_of(docs[r.doc_id])
        some += bool(base)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        every = r.spans.split(",") if r.spans else []
        assert set(text.split(",") if text else []) <= set(every)
        order = [(("email", "ip", "card", "phone").index(k), int(a)) for k, a, _ in (s.split(":") for s in every)]
        assert order == sorted(order)
        assert [getattr(r, f"n_{k}") for k in ("email", "ip", "card", "phone")] == [sum(b[0] == k for b in base) for k in ("email", "ip", "card", "phone")]
    assert some


def test_short_texts_have_chunks_too():
    import base64

    rnd = random.Random(4)
    prose = [" ".join(rnd.choice(["river", "stone", "quiet", "letter", "winter", "garden", "signal", "number", "market", "harbour", "mountain", "paper"])
                      + rnd.choice(["", "s", "ing", "ed"]) + str(rnd.randrange(9)) * (rnd.random() < .1) for _ in range(1000)).encode()[:n] for n in (3000, 5000, 7500)]
    limits = tuple((b, 0.05, hi) for b, _, hi in quality.BANDS)  # this prose repeats its few words
    run = quality._measure(limits)
    for t in prose:
        noise = base64.b85encode(rnd.randbytes(len(t) * 2 // 5))
        dirty = noise + t[len(noise):]
        got = run([t, dirty])
        assert got["bad_share"][0] == 0 and got["in_band"] == [True, True]
        assert got["bad_share"][1] > quality.MAX_BAD_SHARE or got["bad_run"][1] >= quality.MAX_BAD_RUN


@pytest.mark.parametrize("name", ["op3_pivotal_mixing", "op4_compression_bands", "op8_bounded_ring", "op9_rare_token_licenses", "op10_two_stage_suffixes",
                                  "op11_ngram_join", "op12_embedding_whitening", "op13_hard_negatives"])
def test_registered_queries_return_whole_tables(spark, name):
    out = queries.QUERIES[name](spark, SMALL)
    table = "embeddings" if name.startswith(("op12", "op13")) else "documents"
    n = spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    rows = out.count()
    assert rows == n if table == "documents" else rows == 16 * n if name.startswith("op12") else rows > 0

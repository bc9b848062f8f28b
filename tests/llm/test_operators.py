"""Each text operator against a brute-force version, with nulls, ties, repeated rows and empty tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from riskspark.llm import decontamination, licenses, line_dedup, mixing, pii, quality, queries, sharding, simhash, suffix_dedup, toxicity
from riskspark.llm.common import words_of
from tests.conftest import SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, TEXT_ string"
ODD = [None, "", " \n\t", "a", "é" * 30, "x " * 3000, "The MIT License.\n" * 3]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, a column with a clashing name."""
    rows = [(i, t, "en", f"s{i % 2}", len(t or ""), "extra") for i, t in enumerate(ODD)]
    rows += [(None, "null id text", None, None, None, None), rows[5], rows[5], rows[3]]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def items(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


# ---- 1 ---------------------------------------------------------------------------------------

def brute_lines(rows, size, min_words):
    seen, out = set(), []
    for _, t in rows:
        lines = [x for x in (t or "").split("\n") if x.encode().split()]
        gone, new = set(), set()
        for i in range(len(lines)):
            for n in {size} | ({1} if len(lines[i].encode().split()) >= min_words else set()):
                g = (n, tuple(lines[i:i + n]))
                if i + n <= len(lines):
                    if g in seen:
                        gone |= set(range(i, i + n))
                    seen.add(g)
        out.append((len(lines), len(gone)))
    return out


@pytest.mark.parametrize("size", [2, 3])
def test_line_dedup_brute_force(spark, size):
    rng = random.Random(5)
    pool = [f"line {i}" for i in range(9)] + [" ".join(f"w{j}" for j in range(55)), "", "  "]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for i in range(60)] + [(99, None), (100, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: (r.n_lines, sum(x.n for x in r.runs)) for r in line_dedup.removed_lines(df, min_lines=size).collect()}
    assert [got[d] for d, _ in rows] == brute_lines(rows, size, 50)


def test_line_dedup_repeated_rows_and_texts(spark, odd, empty):
    df = spark.createDataFrame([(1, "a b\nc d\ne"), (1, "a b\nc d\ne"), (2, "x\na b\nc d")], "doc_id long, text string")
    got = sorted((r.id, r.text) for r in line_dedup.deduplicated(df).collect())
    assert got == [(1, ""), (1, "a b\nc d\ne"), (2, "x")]
    assert line_dedup.each_row(line_dedup.removed_lines(odd)).count() == odd.count()
    assert line_dedup.removed_lines(empty).count() == 0


def test_line_dedup_query_removes_every_later_copy_of_a_line(spark, docs, tmp_path):
    notice = "All rights reserved by the owner of this page, see below."
    rows = [(i, f"own {i}\n{notice}\nmore {i}") for i in range(9)] + [(20, "a"), (21, "a"), (21, "a"), (22, None), (23, "\n \n"), (24, "b\na\nb")]
    for k, df in enumerate([spark.createDataFrame(rows, "doc_id long, text string"), docs.select("doc_id", "text")]):
        df.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        want = brute_lines(rows := sorted(map(tuple, df.collect()), key=lambda r: r[0]), 2, 1)
        got = [(r.doc_id, r.n_lines, r.n_removed) for r in queries.op1(spark, f"{tmp_path}/{k}").collect()]
        assert sorted(got) == sorted((d, *w) for (d, _), w in zip(rows, want))


def word_lines(t):
    return [x for x in (t or "").split("\n") if x.encode().split()]


@pytest.mark.parametrize("size, words", [(2, 50), (3, 50), (2, 1)])
def test_line_dedup_copies_are_maximal_and_stand_in_an_earlier_text(spark, size, words, monkeypatch):
    """Each copy equals its first copy line by line, all together cover the deleted lines, and the whole of a text copied
    from one earlier text is one copy. With a bound of 20 places the frequent lines go through the broadcast."""
    monkeypatch.setattr(line_dedup, "HOT", 20)
    rng = random.Random(6)
    pool = [f"line {i}" for i in range(40)] + ["hot"] * 40
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))) for i in range(80)]
    first = "\n".join(f"own {i}" for i in range(11))
    rows += [(200, first), (201, f"before\n{first}\n\nafter"), (202, first), (202, first), (None, first), (203, "own 9\nown 10\nown 0\nown 1\nown 2")]
    found = line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_lines=size, min_words=words).collect()
    text = {d: word_lines(t) for d, t in rows}
    by_entry = {r.e: r for r in found}
    for r in found:
        gone = set()
        for c in r.copies:
            source = by_entry[c.first_e]
            assert text[r.id][c.line:c.line + c.n] == text[source.id][c.first_line:c.first_line + c.n]
            assert (c.first_e, c.first_line) < (r.e, c.line) or not r.first
            assert not gone & set(range(c.line, c.line + c.n))
            gone |= set(range(c.line, c.line + c.n))
        assert len(gone) == sum(x.n for x in r.runs)
    copies = {(r.id, r.first): [(c.line, c.n, by_entry[c.first_e].id, c.first_line) for c in r.copies] for r in found}
    assert copies[200, True] == []
    assert copies[201, True] == [(1, 11, 200, 0)]
    assert copies[202, True] == copies[None, True] == [(0, 11, 200, 0)]
    assert copies[202, False] == [(0, 11, 202, 0)]
    assert copies[203, True] == [c for c in [(0, 2, 200, 9), (2, 3, 200, 0)] if c[1] >= size]


# ---- 2 ---------------------------------------------------------------------------------------

def test_decontamination_sql(spark, docs, duck_small):
    q = queries.op2(spark, SMALL)
    cols = sorted(q.columns)
    want = duck_small.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLES['op2_benchmark_decontamination']})").fetchall()
    assert sorted(map(tuple, q.select(*cols).collect())) == sorted(want)


def test_decontamination_offsets_blocks_and_edges(spark, odd, empty):
    bench = items(spark, "One two THREE four five six seven eight nine ten eleven", "short item", None, "", "short item")
    text = "é One, two three\nfour five six seven eight nine ten eleven! a short  item."
    df = spark.createDataFrame([(1, text), (2, "shortitem")], "doc_id long, text string")
    for block in (10, 1 << 20):
        r1, r2 = decontamination.scan(df, bench, block_bytes=block).orderBy("doc_id").collect()
        assert (r1.n_hit, r1["items"], r2.n_hit) == (13, ["0", "1", "4"], 0)
        assert [text[h.start:h.end] for h in r1.hits] == ["One, two three\nfour five six seven eight nine ten eleven", "short  item"]
    kept = decontamination.decontaminate(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert decontamination.scan(odd, bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    assert decontamination.decontaminate(empty, bench).count() == 0


# ---- 3 ---------------------------------------------------------------------------------------

def test_mixing_targets_and_rounding(spark, docs):
    got = mixing.taken(docs).collect()
    again = mixing.taken(docs.repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    rows = docs.select("doc_id", "source", "text").collect()
    size = {r.doc_id: len((r.text or "").encode().split()) for r in rows}
    per = collections.Counter()
    for r in rows:
        per[r.source] += size[r.doc_id]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(per, key=lambda s: s.encode()))}
    budget, capped = 1.5 * sum(per.values()), set()
    while True:
        level = (budget - sum(2 * per[s] for s in capped)) / max(1e-9, sum(w for s, w in weight.items() if s not in capped))
        more = {s for s in per if s not in capped and weight[s] * level > 2 * per[s]}
        if not more:
            break
        capped |= more
    want = {s: 2.0 * per[s] if s in capped else weight[s] * level for s in per}
    source = {r.doc_id: r.source for r in rows}
    took, largest = collections.Counter(), collections.Counter()
    for r in got:
        assert r.size == size[r.id] and r.taken <= 2 * r.size and r.target == pytest.approx(want[source[r.id]])
        took[source[r.id]] += r.taken
        largest[source[r.id]] = max(largest[source[r.id]], r.size)
    assert all(abs(took[s] - want[s]) <= largest[s] / 2 + 1e-3 for s in per)


def test_pivotal_rounding_is_unbiased(spark):
    n = 40
    rows = spark.range(n).select(F.lit(1).cast("long").alias("g"), F.lit(n).cast("long").alias("n"), F.col("id").alias("k"),
                                 F.xxhash64("id").alias("h"), (F.col("id") % 5 + 1).cast("double").alias("s"),
                                 ((F.col("id") % 4 + 1) / 5.0).alias("p"))
    total = rows.select(F.sum(F.col("s") * F.col("p"))).first()[0]
    hits = collections.Counter()
    for seed in range(12):
        out = mixing.round_together(rows, "g", "n", ["k", "h", "s", "p"], seed=seed, chunk=8).collect()
        assert len(out) == n and {r.p for r in out} <= {0.0, 1.0}
        assert abs(sum(r.s * r.p for r in out) - total) <= 2.5 + 1e-6
        hits.update(r.k for r in out if r.p == 1.0)
    assert abs(sum(hits.values()) / (12 * n) - 0.5) < 0.08


def test_mixing_edges(spark, odd, empty):
    out = mixing.taken(odd).collect()
    assert len(out) == odd.count() and all(r.taken <= 2 * r.size for r in out)
    mixed = mixing.mixed(odd)
    assert mixed.columns == odd.columns
    words = sum(len((r.text or "").encode().split()) for r in mixed.collect())
    assert words == sum(r.taken for r in out)
    assert mixing.taken(empty).count() == 0 and mixing.mixed(empty).count() == 0


# ---- 4 ---------------------------------------------------------------------------------------

def test_quality_counts_brute_force(spark, docs, odd, empty):
    def brute(t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        hit = {i + k for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for k in range(5)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit)

    for df in (docs, odd):
        for r in quality.measure(df, keep=["text"]).collect():
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text)
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert not (r.base_failed and r.kept)
    assert quality.measure(empty).count() == 0


def test_compression_bands_reject_repeats_and_noise(spark):
    rng = random.Random(1)
    noise = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(9000))
    noise = " ".join(noise[i:i + 60] for i in range(0, 9000, 60))
    rows = " ".join(f"row {i % 10} col {i % 7} val" for i in range(1200))
    df = spark.createDataFrame([(1, noise), (2, rows)], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in quality.measure(df).collect()} == {1: False, 2: False}


def test_compression_bands_reject_partly_dirty_prose(spark):
    """Prose stays at all lengths; a passage of 10 to 30 % noise or repetition in it is found wherever it starts."""
    rng = random.Random(2)
    texts = [t for t, in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang = 'en'").select("text").collect()
             if len(t or "") > 20_000]
    found = [r.text for r in quality.measure(spark.createDataFrame([(0, t) for t in texts], "doc_id long, text string"), ["text"]).collect() if r.kept]
    prose = "\n".join(found)
    assert len(prose) > 400_000
    alphabet = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    rows, want = [], {}
    for n in (12_288, 40_000, 200_000, 400_000):
        for share in (0, 0.1, 0.2, 0.3):
            size = max(int(n * share), 6_500) if share else 0
            for kind in ("noise", "rows"):
                at = rng.randint(0, n - size)
                dirt = "".join(rng.choice(alphabet) for _ in range(size)) if kind == "noise" else ("a b c d " * size)[:size]
                want[len(rows)] = not share
                rows.append((len(rows), prose[:at] + dirt + prose[at:n - size]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    measured = {r.doc_id: r for r in quality.measure(df, max_repeat_percent=100).collect()}
    assert {i: r.kept for i, r in measured.items()} == want, [(i, r) for i, r in measured.items() if r.kept != want[i]]


# ---- 5 ---------------------------------------------------------------------------------------

def test_chain_marginals_brute_force():
    import itertools

    import numpy as np

    e = np.array([[0.3, -1.0, 2.0], [1.5, 0.2, 0.0]])
    lens, trans, start = np.array([3, 2]), np.array([[0.0, -0.7], [0.4, 0.9]]), np.array([0.0, -0.5])
    marg, pairs = toxicity.forward_backward(e, lens, trans, start)
    want_pairs = np.zeros((2, 2))
    for k in range(2):
        z, m = 0.0, np.zeros(3)
        p2 = np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(lens[k])):
            v = np.exp(start[y[0]] + sum(e[k, t] * y[t] for t in range(len(y))) + sum(trans[a, b] for a, b in zip(y, y[1:])))
            z += v
            m[:len(y)] += v * np.array(y)
            for a, b in zip(y, y[1:]):
                p2[a, b] += v
        assert np.allclose(marg[k], m / z)
        want_pairs += p2 / z
    assert np.allclose(pairs, want_pairs)


def test_toxicity_held_out_accuracy_and_edges(spark, odd, empty):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(d, labels)
    rows = toxicity.marginals(d, model, ["doc_id", "text"]).join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect()
    pos, neg = ([r.score for r in rows if r.toxic == y] for y in (1, 0))
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert auc > 0.85
    assert all(0 <= r.score <= 1 for r in rows)
    flagged = [r for r in rows if r.score >= 0.7]
    assert sum(r.toxic for r in flagged) >= 0.8 * len(flagged) > 0
    assert any(r.text[s.start:s.end].lower() in {"idiot", "trash", "scum", "clown", "moron"} for r in flagged for s in r.spans)
    kept = toxicity.remove_toxic(odd, labels, train_docs=d)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert toxicity.marginals(empty, model, ["doc_id"]).count() == 0
    assert toxicity.fit(d, labels.where("toxic = 0")).score(0.0, 0.0) < 1e-6


# ---- 6 ---------------------------------------------------------------------------------------

def brute_fp(t):
    w = (t or "").encode().lower().split()
    s = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_fingerprints_and_components(spark, docs, odd, empty):
    for df in (docs, odd):
        rows = df.select("doc_id", "text").collect()
        want = sorted((str(r.doc_id), f"{brute_fp(r.text):016x}") for r in rows)
        got = simhash.classes(df).withColumn("x", simhash.hex_fp()).collect()
        assert sorted((str(r.id), r.x) for r in got) == want
        fps = sorted({brute_fp(r.text) for r in rows})
        root = {f: f for f in fps}

        def find(f):
            while root[f] != f:
                f = root[f]
            return f

        for i, a in enumerate(fps):
            for b in fps[i + 1:]:
                if (a ^ b).bit_count() <= 2:
                    root[find(a)] = find(b)
        ids = collections.defaultdict(list)
        for r in rows:
            ids[find(brute_fp(r.text))].append(r.doc_id)
        least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
        assert all(r.component_id == least[find(int(r.x, 16))] for r in got)
        kept = simhash.keep_one(df)
        assert kept.columns == df.columns and kept.count() == len(ids)
    assert simhash.classes(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_simhash_of_one_hot_fingerprint(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 10)
    texts = ["one text that stands in a third of all rows"] * 40 + [f"text number {i} of its own {i * i}" for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: (r.fp, r.component_id) for r in simhash.classes(df).collect()}
    assert len(got) == 100 and {got[i] for i in range(40)} == {got[0]} and got[0][1] == 0
    monkeypatch.setattr(simhash, "HOT", 10_000)
    assert got == {r.id: (r.fp, r.component_id) for r in simhash.classes(df).collect()}


def test_meet_loses_no_row(spark):
    rows = spark.range(5000).selectExpr("id", "if(id % 3 = 0, -1, id % 700) as k")
    few = rows.groupBy("k").count().withColumnRenamed("count", "n").withColumn("name", F.concat(F.lit("k"), "k"))
    for total in (5000, 10**9):
        simhash_hot, simhash.HOT = simhash.HOT, 1 if total == 5000 else simhash.HOT
        try:
            out = simhash.meet(rows, few, "k", total).collect()
        finally:
            simhash.HOT = simhash_hot
        assert len(out) == 5000 and all(r.name == f"k{r.k}" for r in out) and len({r.id for r in out}) == 5000


def test_components_of_chains(spark):
    rng = random.Random(2)
    a = rng.getrandbits(63)
    chain = [a]
    for k in range(20):
        chain.append(chain[-1] ^ (3 << (2 * k)))  # each two bits on
    fps = spark.createDataFrame([(x,) for x in chain + [rng.getrandbits(63) for _ in range(20)]], "fp long")
    out = simhash.components(simhash.links(fps)).collect()
    assert {r.node for r in out} == set(chain) and {r.root for r in out} == {min(chain)}


# ---- 7 ---------------------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, v):
    d = re.sub("[^0-9]", "", v)
    luhn = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(d[::-1])) % 10 == 0
    return {"email": True, "ip": all(int(p) <= 255 for p in v.split(".")) if kind == "ip" else False,
            "card": 13 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]


def test_pii_base_spans_brute_force(spark, docs, odd, empty):
    tricky = ["a@b.co_x@y.zz é +1 (23) 456-7890. 1.2.3.4.5 300.1.1.1 007.1.2.3", "4539578763621486 4539-5787-6362-1486 12 34",
              "x" * 20000 + "@", "1 " * 3000, "1.1" * 2000, "++1 2 3 4 5 6 7 8 9", "me@@you a@b a@b.c.d..e 4111111111111111"]
    df = odd.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(tricky, 100)), "doc_id long, text string")) \
        .unionByName(docs.select("doc_id", "text"))
    model = pii.fit(docs)
    for r in pii.find(df, model, keep=["doc_id", "text"]).collect():
        for kind, pattern in PATTERNS.items():
            want = [m.span() for m in re.finditer(pattern, r.text or "") if passes(kind, m.group())]
            assert [tuple(s) for s in r[f"base_{kind}"]] == want
            assert all(not (a.start < b and c < a.end) for a in r[f"added_{kind}"] for c, b in want)
    assert pii.redact(odd, model).columns == odd.columns
    assert pii.find(empty).count() == 0


def test_pii_adds_what_the_base_forms_miss(spark):
    """Spans outside the base forms are added, refuted ones aren't; too small a sample adds nothing."""
    rows = []
    for i in range(400):
        good = f"4539578763621{i % 1000:03d}"
        digit = next(d for d in "0123456789" if passes("card", good[:-1] + d))
        a, b = ("card", "order") if i % 2 else ("order", "card")  # the cue tells nothing here, the check digit does
        rows.append((i, f"call +1 (212) 555-{i:04d} or write me.{i}@mail.example.com, {a} {good[:-1]}{digit}; "
                        f"host 10.0.{i % 250}.7, build 300.{i}.1.1, user{i}@local, {b} {good[:-1]}{(int(digit) + 1) % 10} x"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(docs)
    assert {"phone", "email", "card"} <= set(model.thresholds)
    odd = ["call (212) 555-0199 now", "write to jo (at) mail.example.com today", "ref 12 4539578763621486 x",
           "x 4539578763621487 y", "jo@local", "300.1.1.1", "x(212) 555-0199y"]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string"), model).collect()}

    def added(i):
        return {k: [odd[i][s.start:s.end] for s in got[i][f"added_{k}"]] for k in pii.KINDS if got[i][f"added_{k}"]}

    assert added(0) == {"phone": ["(212) 555-0199"]}
    assert added(1) == {"email": ["jo (at) mail.example.com"]}
    assert added(2) == {"card": ["4539578763621486"]}
    assert added(3) == added(4) == added(5) == added(6) == {}
    assert pii.fit(docs.limit(5)).thresholds == {}


def test_pii_proposes_overlapping_candidates(spark):
    texts = {"email": [("john[at]example.com", ["john[at]example.com"]), ("to john[at] example.com.", ["john[at] example.com."]),
                       ("é jo (at) a.b@c.d x[1]@y.zz", ["jo (at) a.b", "a.b@c.d", "x[1]@y.zz"])],
             "card": [("ref 2024 4539 5787 6362 1486", ["2024 4539 5787 6362", "4539 5787 6362 1486"]),
                      ("ref 12 3782 822463 10005", ["12 3782 822463 10005", "3782 822463 10005"]), ("1 2 3", [])],
             "ip": [("300.10.0.0.1", ["300.10.0.0", "10.0.0.1"]), ("1.2.3", [])], "phone": [("(212) 555-0199", ["(212) 555-0199"])]}
    for kind, cases in texts.items():
        df = spark.createDataFrame([(t, w) for t, w in cases], "t string, want array<string>")
        for r in df.select("t", "want", pii.proposed(F.col("t"), kind).alias("got")).collect():
            assert [s.v for s in r.got] == r.want and all(r.t[s.start:s.end] == s.v for s in r.got)
    long = spark.createDataFrame([("1 " * 3000 + "1.1" * 2000 + "a@" * 3000,)], "t string")
    assert long.select(*[F.size(pii.proposed(F.col("t"), k)) for k in pii.KINDS]).collect()


def test_pii_samples_and_thresholds_by_kind(spark):
    """A kind keeps its sample and threshold where another fills the table; one with few labels has the pooled threshold."""
    rows = [(i, " ".join(f"10.{i % 250}.{j}.{300 if j % 3 else 3}" for j in range(40))) for i in range(200)]
    rows += [(1000 + i, f"write me.{i}@mail.example.com or x{i}@local") for i in range(100)] + [(2000, "call +1 212 555 0199")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    n = {r[0]: r[1] for r in pii.training_sample(docs, sample_rows=300).groupBy(F.element_at("f", 1)).count().collect()}
    assert n[0.0] == 200 and n[1.0] == 300 and 2.0 not in n
    model = pii.fit(docs, sample_rows=300)
    assert set(model.thresholds) == set(pii.KINDS)
    got = pii.find(spark.createDataFrame([(1, "write jo (at) mail.example.com")], "doc_id long, text string"), model).first()
    assert [tuple(x) for x in got.added_email] == [(6, 30)]


def test_pii_learns_from_all_candidates(spark, monkeypatch):
    """2,400 address candidates, more than a sample holds: all are counted, and the model is fitted and calibrated on them."""
    rows = [(i, " ".join(f"10.{i % 250}.{j}.{300 if j % 3 else 3}" for j in range(40))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert pii.training_counts(docs).agg(F.sum("n"), F.sum(F.col("n") * F.col("label"))).first()[:] == (2400, 60 * 14)
    asked = []
    counted, limit = pii.training_counts, pii._threshold
    monkeypatch.setattr(pii, "training_counts", lambda *a: asked.append(counted(*a)) or asked[-1])
    told = []
    monkeypatch.setattr(pii, "_threshold", lambda rows, p: told.append(sum(r["n"] for r in rows)) or limit(rows, p))
    pii.fit(docs)
    assert told[0] == asked[0].where("fold = 0").agg(F.sum("n")).first()[0] > 700


def test_pii_trees_equal_mllib(spark):
    model = pii.Boosted([(0, 1.5, -0.4, (1, 0.5, 0.2, 0.9))], [1.0], {"card": 0.6})
    df = spark.createDataFrame([([2.0, 1.0],), ([1.0, 0.0],), ([2.0, 0.0],)], "f array<double>")
    got = [r[0] for r in df.select(model.margin(F.col("f"))).collect()]
    assert got == [0.9, -0.4, 0.2]


# ---- 8 ---------------------------------------------------------------------------------------

def test_sharding_counts_slots_and_edges(spark, docs, odd, empty):
    for df in (docs, odd):
        rows = sharding.shard(df, shards=7).collect()
        n = collections.Counter(r.shard for r in rows)
        assert len(rows) == df.count() and max(n.values()) - min(n.get(s, 0) for s in range(7)) <= 1
        for s in n:
            assert sorted(r.slot for r in rows if r.shard == s) == list(range(n[s]))
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert all(r.size == len(texts[r.id]) + 16 and r.crc == zlib.crc32(texts[r.id]) for r in sharding.shard(docs).collect())
    assert sharding.shard(empty).count() == 0


def test_sharding_spreads_rows_of_one_id_over_buckets(spark):
    df = spark.createDataFrame([(None if i % 2 else 7, f"text {i}") for i in range(400)], "doc_id long, text string")
    assert sharding.entries(df).select("bucket").distinct().count() > 100

def test_ring_moves_few_rows_when_it_grows():
    counts = {b: 50 for b in range(sharding.BUCKETS)}

    def homes(shards):
        return {(b, k): s for b, lo, hi, s, _ in sharding.walk(counts, shards, slack=0.1) for k in range(lo, hi)}

    a, b = homes(40), homes(41)
    assert max(collections.Counter(a.values()).values()) <= 1.1 * len(a) / 40 + 1
    assert sum(a[x] != b[x] for x in a) < 0.15 * len(a)


# ---- 9 ---------------------------------------------------------------------------------------

def test_license_base_brute_force(spark, docs, odd, empty):
    for df in (docs, odd):
        for r in licenses.scan(df, keep=["text"]).collect():
            w = words_of((r.text or "").encode())
            at, labels = [], set()
            for phrase, label in licenses.BASE.items():
                p = phrase.encode().split()
                found = [i for i in range(len(w)) if w[i:i + len(p)] == p]
                at += found
                labels |= {label} if found else set()
            assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), min(at, default=None), max(at, default=None))
            assert r.base_labels == sorted(labels) and set(labels) <= set(r.labels) and 0 <= r.score <= 1
    assert licenses.scan(empty).count() == 0


def test_license_templates_and_key_phrases(spark):
    mit = licenses.TEMPLATES[9][1]
    rows = [(1, f"intro {mit} and more"), (2, mit.replace("hereby granted", "never granted")), (3, "The apache licence of the tribe")]
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ["mit"], 2: [], 3: []}


def brute_licenses(words, index):
    """Best share of each label over all templates and all shifts."""
    out = {}
    for t, template in enumerate(index.words):
        looked = sorted(set(words) & set(template), key=lambda w: (-index.weight(w), w))[:licenses.RARE]
        total = sum(sorted(map(index.weight, set(template)), reverse=True)[:licenses.RARE])
        for shift in range(-len(template), len(words)):
            aligned = {w for q, w in enumerate(template) if w in looked and 0 <= q + shift < len(words) and words[q + shift] == w}
            share = sum(map(index.weight, aligned)) / total
            near = range(-licenses.SLACK, licenses.SLACK + 1)
            if share >= licenses.MIN_SHARE and all(any(words[max(0, shift + q + d):][:len(key)] == key for d in near)
                                                   for q, key in index.phrases[t]):
                out[index.labels[t]] = max(out.get(index.labels[t], 0.0), min(1.0, share))
    return out


def test_license_templates_brute_force_on_altered_notices(spark):
    """Notices with words replaced, left out or put in; some are found by words that aren't the template's rarest."""
    rng = random.Random(9)
    rows = []
    for i in range(150):
        words = rng.choice(licenses.TEMPLATES)[1].split()
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(words))
            words[k:k + rng.randint(0, 1)] = rng.choice([[], ["other"], ["some", "thing"]])
            words = words or ["none"]
        rows.append((i, " ".join(["before"] * rng.randint(0, 3) + words + ["the", "license", "of"][:rng.randint(0, 3)])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen, n = licenses.document_frequencies(df)
    idf = {w: math.log((n + 1) / (seen.get(w, 0) + 1)) + 1.0 for w in licenses.Index().vocabulary}
    index, fixed = licenses.Index(idf=idf), 0
    for r in licenses.scan(df, keep=["doc_id", "text"]).collect():
        want = brute_licenses(words_of(r.text.encode()), index)
        assert {x.label: round(x.share, 9) for x in r.spans} == {k: round(v, 9) for k, v in want.items()}
        assert set(want) <= set(r.labels)
        for t, template in enumerate(index.words):
            top = set(sorted(set(template), key=lambda w: (-index.weight(w), w))[:licenses.RARE])
            fixed += index.labels[t] in want and not top <= set(words_of(r.text.encode()))
    assert fixed > 0


# ---- 10 --------------------------------------------------------------------------------------

def brute_spans(texts, n):
    c = collections.Counter(t[i:i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if c[t[i:i + n]] > 1:
                gone[i:i + n] = b"\1" * n
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), len(t) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("n,gram,most", [(12, 4, 1000), (64, 8, 3), (20, 8, 2)])
def test_suffix_dedup_brute_force(spark, n, gram, most):
    rng = random.Random(n)
    pool = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 160))) for _ in range(12)]
    texts = ["".join(rng.choice(pool) if rng.random() < 0.5 else "".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 45)))
                     for _ in range(rng.randint(0, 5))) for _ in range(60)]
    texts += ["a" * 50, "a" * 70, "ab" * 40, "", "é" * 30, texts[3], "a" * (n + 1) + "b", "a" * n, "b" + "a" * n]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffix_dedup.remove_repeats(df, length=n, gram=gram, max_contexts=most).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == brute_spans([t.encode() for t in texts], n)


def test_suffix_dedup_documents_and_edges(spark, docs, odd, empty):
    for df in (docs, odd):
        rows = df.select("doc_id", "text").collect()
        want = sorted((str(r.doc_id), *x) for r, x in zip(rows, brute_spans([(r.text or "").encode() for r in rows], 400)))
        got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df).collect())
        assert got == want
    assert suffix_dedup.remove_repeats(empty).count() == 0

"""Toxicity: a linear-chain conditional random field over words, aggregated to documents.

Training uses a bounded sample of labelled rows (``N_TOXIC`` + ``N_CLEAN`` documents, first by a hash
of the id). Words and word prefixes that occur far more often in toxic than in clean sample
documents (log-likelihood ratio) are the features; words of toxic documents that carry one are the
labelled toxic tokens. A two-state chain over each sentence (emission per feature, bias,
transitions) is fitted by gradient ascent on the regularised conditional likelihood. Forward-backward
marginals score every word of a text; a logistic model of their maximum and expected number,
weighted to the class shares of all labelled training rows, gives the document score, and the words with a
marginal of at least 0.5 are the offending offsets.

A sentence ends at ``.``, ``!``, ``?`` or a line end; a longer chain than ``CHAIN`` words is cut into
chains of ``CHAIN``. Sentences without any feature have marginals that depend on their length only,
which are read from a table instead of computed again.

Defined results: a null or empty text scores like a text without words; conflicting labels of a
document count as toxic; null labels are ignored; without any toxic or any clean label every score
is the share of toxic labels (0 without labels). Repeated rows get equal scores.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import WORD_TABLE, map_texts, table, with_safe_names
from riskspark.llm.decontamination import original_offsets

N_TOXIC, N_CLEAN = 2000, 4000
MAX_FEATURES = 4000
MAX_SENTENCES = 30_000
MIN_LLR = 12.0
PREFIXES = (5, 6, 7)
CHAIN = 64
THRESHOLD = 0.7
SENTENCE_TABLE = bytes(10 if b in b".!?\n" else c for b, c in enumerate(WORD_TABLE))


def held_out(doc_id):
    """Whether labels of this id are kept from training; a null id has none, so it is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def chains_of(text: bytes) -> list[list[bytes]]:
    out = []
    for line in text.translate(SENTENCE_TABLE).split(b"\n"):
        words = line.split()
        for k in range(0, len(words), CHAIN):
            out.append(words[k:k + CHAIN])
    return out


def features_of(word: bytes) -> list[bytes]:
    """The word and its longer prefixes (marked with a leading ^)."""
    return [word] + [b"^" + word[:n] for n in PREFIXES if len(word) > n]


# ---- the chain -------------------------------------------------------------------------------

def forward_backward(e: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray, weight=None):
    """Marginals of state 1 and expected transition counts (of chains by ``weight``) of padded chains.

    ``e``: (n, L) log-odds of state 1 per word; ``trans``: 2 x 2 log potentials; ``start``: 2. Both
    passes normalise at every step, so long chains neither overflow nor vanish.
    """
    n, width = e.shape
    live = np.arange(width)[None, :] < lengths[:, None]
    alpha = np.zeros((n, width, 2))
    count = np.ones(n) if weight is None else weight
    pot = np.exp(np.stack([np.zeros_like(e), np.clip(e, -30, 30)], axis=2))
    m = np.exp(trans)
    a = pot[:, 0] * np.exp(start)
    for t in range(width):
        if t:
            a = np.where(live[:, t, None], (alpha[:, t - 1] @ m) * pot[:, t], alpha[:, t - 1])
        alpha[:, t] = a / a.sum(axis=1, keepdims=True)
    beta = np.ones((n, 2))
    marg = np.zeros((n, width))
    pairs = np.zeros((2, 2))
    for t in range(width - 1, -1, -1):
        g = alpha[:, t] * beta
        g /= g.sum(axis=1, keepdims=True)
        marg[:, t] = np.where(live[:, t], g[:, 1], 0.0)
        if t:
            nxt = pot[:, t] * beta
            x = alpha[:, t - 1][:, :, None] * m[None] * nxt[:, None, :]
            x /= x.sum(axis=(1, 2), keepdims=True)
            pairs += (x * (count * live[:, t])[:, None, None]).sum(axis=0)
            beta = np.where(live[:, t, None], nxt @ m.T, beta)
            beta /= beta.sum(axis=1, keepdims=True)
    return marg, pairs


class Chain:
    """Fitted weights: feature -> weight, bias, transitions; and the document model."""

    def __init__(self, weights: dict[bytes, float], bias: float, trans, start, doc):
        self.weights, self.bias = weights, bias
        self.trans, self.start, self.doc = np.asarray(trans), np.asarray(start), tuple(doc)
        self.plain = [self._plain(n) for n in range(CHAIN + 1)]

    def state(self) -> tuple:
        """Plain values from which ``Chain(*state)`` makes the same model."""
        return self.weights, self.bias, self.trans.tolist(), self.start.tolist(), self.doc

    def _plain(self, n: int) -> tuple[float, float]:
        """(sum, maximum) of the marginals of ``n`` words without features."""
        if n == 0:
            return 0.0, 0.0
        m, _ = forward_backward(np.full((1, n), self.bias), np.array([n]), self.trans, self.start)
        return float(m.sum()), float(m.max())

    def tagger(self):
        weights = self.weights

        class Emission(dict):
            def __missing__(self, word):
                if len(self) > 300_000:
                    self.clear()
                self[word] = v = sum(weights.get(f, 0.0) for f in features_of(word))
                return v

        emission = Emission()

        def tag(texts: list[bytes]):
            """Per text (maximum, expected toxic words, number of words, [(word number, marginal)])."""
            parts = [chains_of(t) for t in texts]
            doc = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
            flat = list(chain.from_iterable(parts))
            lens = np.fromiter(map(len, flat), np.int64, len(flat))
            ends = np.cumsum(lens)
            words = np.bincount(doc, lens, len(texts)).astype(np.int64)
            first = np.cumsum(words) - words
            e = np.fromiter(map(emission.__getitem__, chain.from_iterable(flat)), float, int(lens.sum()))
            is_hot = np.zeros(len(flat), bool)
            is_hot[np.searchsorted(ends, np.flatnonzero(e), side="right")] = True
            plain = np.array(self.plain)
            most, total = np.zeros(len(texts)), np.zeros(len(texts))
            cold = np.flatnonzero(~is_hot)
            np.maximum.at(most, doc[cold], plain[lens[cold], 1])
            total += np.bincount(doc[cold], plain[lens[cold], 0], len(texts))
            found: list[list] = [[] for _ in texts]
            hot = np.flatnonzero(is_hot)
            hot = hot[np.argsort(lens[hot], kind="stable")]
            for k in range(0, len(hot), 1024):
                rows = hot[k:k + 1024]
                width = int(lens[rows].max())
                at = (ends[rows] - lens[rows])[:, None] + np.arange(width)[None, :]
                live = np.arange(width)[None, :] < lens[rows][:, None]
                pad = np.where(live, e[np.minimum(at, len(e) - 1)] + self.bias, 0.0)
                marg, _ = forward_backward(pad, lens[rows], self.trans, self.start)
                total += np.bincount(doc[rows], marg.sum(axis=1), len(texts))
                np.maximum.at(most, doc[rows], marg.max(axis=1))
                for i, j in zip(*np.nonzero(marg >= 0.5)):
                    d = int(doc[rows[i]])
                    found[d].append((int(at[i, j] - first[d]), float(marg[i, j])))
            return [(float(most[d]), float(total[d]), int(words[d]), sorted(found[d])) for d in range(len(texts))]

        return tag

    def score(self, most: float, total: float) -> float:
        z = self.doc[0] + self.doc[1] * most + self.doc[2] * np.log1p(total)
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))


# ---- training --------------------------------------------------------------------------------

def sample(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
           n_toxic: int = N_TOXIC, n_clean: int = N_CLEAN) -> tuple[DataFrame, dict[int, int]]:
    """(id, text, y) of the bounded training sample, and the class counts of all training labels."""
    train = labels.where(F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)) & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("id")) \
        .agg(F.max(F.col(label).cast("int")).alias("y"))
    counts = {int(r["y"]): int(r["count"]) for r in train.groupBy("y").count().collect()}
    pick = None
    for y, n in ((1, n_toxic), (0, n_clean)):
        part = train.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n)
        pick = part if pick is None else pick.unionByName(part)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(pick), "id")
    # at most n_toxic + n_clean rows: of several texts with one id the smallest counts
    return table(rows.groupBy("id", "y").agg(F.min("text").alias("text")), "toxic-sample"), counts


def select_features(rows: DataFrame, n: dict[int, int], max_features: int = MAX_FEATURES,
                    min_llr: float = MIN_LLR) -> list[bytes]:
    """Features over-represented in the toxic sample documents, by log-likelihood ratio."""
    def make():
        def run(texts):
            return {"f": [list({f for w in set(t.translate(WORD_TABLE).split()) for f in features_of(w)}) for t in texts]}
        return run

    seen = map_texts(rows, make, [T.StructField("f", T.ArrayType(T.BinaryType()))], "text", ["y"])
    count = seen.select("y", F.explode("f").alias("f")).groupBy("f").agg(
        F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    p = n.get(1, 0) / max(1, n.get(1, 0) + n.get(0, 0))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    share = a / (a + b)
    term = lambda k, q, e: F.when(k > 0, k * F.log(q / e)).otherwise(0.0)
    llr = 2 * (term(a, share, F.lit(p)) + term(b, 1 - share, F.lit(1 - p)))
    top = count.where((share > 0.5 + p / 2) & (llr >= min_llr)).select("f", llr.alias("llr")) \
        .orderBy(F.desc("llr"), "f").limit(max_features)
    return [bytes(r.f) for r in top.collect()]


def training_chains(rows: DataFrame, features: list[bytes], max_sentences: int = MAX_SENTENCES):
    """Sentences with features as (y, length, positions, feature numbers), and the lengths of the others."""
    shared = rows.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(features)})

    def make():
        number = shared.value

        def run(texts):
            out = {"length": [], "at": [], "f": [], "plain": []}
            for t in texts:
                cols = ([], [], [])
                plain = [0] * (CHAIN + 1)
                for words in chains_of(t):
                    hits = [(k, number[f]) for k, w in enumerate(words) for f in features_of(w) if f in number]
                    if hits:
                        cols[0].append(len(words))
                        cols[1].append([k for k, _ in hits])
                        cols[2].append([f for _, f in hits])
                    else:
                        plain[len(words)] += 1
                for n, v in zip(("length", "at", "f", "plain"), (*cols, plain)):
                    out[n].append(v)
            return out
        return run

    ints = T.ArrayType(T.LongType())
    fields = [T.StructField("length", ints), T.StructField("at", T.ArrayType(ints)), T.StructField("f", T.ArrayType(ints)),
              T.StructField("plain", ints)]
    told = table(map_texts(rows, make, fields, "text", ["id", "y"]), "toxic-chains")
    plain = told.select(F.posexplode("plain").alias("n", "c")).groupBy("n").agg(F.sum("c").alias("c")).collect()
    s = told.select("id", "y", F.posexplode(F.arrays_zip("length", "at", "f")).alias("k", "s")) \
        .select("y", "s.*", F.xxhash64("id", "k").alias("h"), "id", "k").orderBy("h", "id", "k").limit(max_sentences).collect()
    return s, {int(r.n): int(r.c) for r in plain if r.n}


def fit_chain(features: list[bytes], sentences, plain: dict[int, int], rounds: int = 80, l2: float = 0.02):
    """Gradient ascent (Adam) on the regularised conditional log-likelihood."""
    lens = np.array([r.length for r in sentences], np.int64)
    order = np.argsort(lens, kind="stable")
    groups = []
    for rows in np.array_split(order, max(1, len(order) // 2000)):
        if not len(rows):
            continue
        i, t, f, y = [], [], [], []
        for k, s in enumerate(rows.tolist()):
            r = sentences[s]
            i += [k] * len(r.at)
            t += r.at
            f += r.f
            y += [r.y] * len(r.at)
        width = int(lens[rows].max())
        gold = np.zeros((len(rows), width))
        i, t, f = np.array(i, np.int64), np.array(t, np.int64), np.array(f, np.int64)
        gold[i, t] = y
        groups.append((lens[rows], i, t, f, gold))
    w, theta = np.zeros(len(features)), np.array([-4.0, 0.0, 0.0, 0.0, 0.0])  # bias; log potentials 01, 10, 11; start
    m1, m2 = np.zeros(len(w) + 5), np.zeros(len(w) + 5)
    tokens = max(1.0, float(lens.sum() + sum(n * c for n, c in plain.items())))
    for k in range(1, rounds + 1):
        gw, gt = np.zeros(len(w)), np.zeros(5)
        trans, start = np.array([[0.0, theta[1]], [theta[2], theta[3]]]), np.array([0.0, theta[4]])
        for ln, i, t, f, gold in groups:
            e = np.full(gold.shape, theta[0])
            np.add.at(e, (i, t), w[f])
            marg, pairs = forward_backward(e, ln, trans, start)
            d = gold - marg
            np.add.at(gw, f, d[i, t])
            gt += (d.sum(), 0, 0, 0, d[:, 0].sum())
            a, b = gold[:, :-1], gold[:, 1:]
            live = np.arange(1, gold.shape[1])[None, :] < ln[:, None]
            got = np.array([((1 - a) * b * live).sum(), (a * (1 - b) * live).sum(), (a * b * live).sum()])
            gt[1:4] += got - (pairs[0, 1], pairs[1, 0], pairs[1, 1])
        if plain:
            c = np.array(list(plain.values()), float)
            ln = np.array(list(plain))
            marg, pairs = forward_backward(np.full((len(ln), int(ln.max())), theta[0]), ln, trans, start, c)
            gt -= np.array([c @ marg.sum(axis=1), pairs[0, 1], pairs[1, 0], pairs[1, 1], c @ marg[:, 0]])
        g = np.concatenate((gw / 50.0 - l2 * w, gt / tokens * 50 - 1e-3 * theta))
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        step = 0.25 * (m1 / (1 - 0.9**k)) / (np.sqrt(m2 / (1 - 0.99**k)) + 1e-8)
        w, theta = w + step[:-5], theta + step[-5:]
    trans, start = [[0.0, theta[1]], [theta[2], theta[3]]], [0.0, theta[4]]
    return {f: float(v) for f, v in zip(features, w)}, float(theta[0]), trans, start


def fit_document_model(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 0.02) -> np.ndarray:
    """Weighted logistic regression by Newton steps; ``x``: maximum and log1p(expected number)."""
    a = np.column_stack((np.ones(len(x)), x))
    beta = np.zeros(a.shape[1])
    reg = l2 * np.array([0.0, 1.0, 1.0])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        g = a.T @ (weight * (y - p)) - reg * beta
        h = (a * (weight * p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(reg + 1e-6)
        step = np.linalg.solve(h, g)
        beta += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", **sizes) -> Chain:
    """The model, from labelled rows that aren't held out."""
    rows, n = sample(docs, labels, doc_id, text, label, **sizes)
    share = n.get(1, 0) / max(1, sum(n.values()))
    have = {int(r["y"]): int(r["count"]) for r in rows.groupBy("y").count().collect()}
    if not have.get(0) or not have.get(1):
        odds = np.clip(np.log(max(share, 1e-12) / max(1 - share, 1e-12)), -30, 30)
        return Chain({}, -4.0, np.zeros((2, 2)), np.zeros(2), (odds, 0.0, 0.0))
    features = select_features(rows, have)
    sentences, plain = training_chains(rows, features)
    weights, bias, trans, start = fit_chain(features, sentences, plain) if sentences else ({}, -4.0, np.zeros((2, 2)), np.zeros(2))
    chain_model = Chain(weights, bias, trans, start, (0.0, 0.0, 0.0))
    got = marginals(rows, chain_model, ["y"]).select("y", "most", "total").collect()
    x = np.array([(r.most, np.log1p(r.total)) for r in got])
    y = np.array([r.y for r in got], float)
    w = np.array([n[r.y] / have[r.y] for r in got])
    chain_model.doc = tuple(float(b) for b in fit_document_model(x, y, w * len(w) / w.sum()))
    return chain_model


# ---- scoring ---------------------------------------------------------------------------------

_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("p", T.DoubleType())])


def marginals(docs: DataFrame, model: Chain, keep, text: str = "text", prefix: str = "") -> DataFrame:
    """``keep`` plus most, total, n_words, score and spans (offending code-point offsets)."""
    shared = docs.sparkSession.sparkContext.broadcast(model.state())

    def make():
        chain_model = Chain(*shared.value)
        tag = chain_model.tagger()

        def run(texts):
            out = {"most": [], "total": [], "n_words": [], "score": [], "spans": []}
            for t, (most, total, n, found) in zip(texts, tag(texts)):
                at = original_offsets(t, [[i, i] for i, _ in found]) if found else []
                row = (most, total, n, chain_model.score(most, total),
                       [{"start": s, "end": e, "p": p} for (s, e), (_, p) in zip(at, found)])
                for k, v in zip(out, row):
                    out[k].append(v)
            return out
        return run

    names = [prefix + n for n in ("most", "total", "n_words", "score", "spans")]
    types = [T.DoubleType(), T.DoubleType(), T.LongType(), T.DoubleType(), T.ArrayType(_SPAN)]
    return map_texts(docs, make, [T.StructField(a, b) for a, b in zip(names, types)], text, keep)


def remove_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text: str = "text", doc_id: str = "doc_id",
                 train_docs: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, with their columns."""
    model = fit(docs if train_docs is None else train_docs, labels, doc_id, text)
    return with_safe_names(docs, lambda d, at: marginals(d, model, d.columns, at(text), "__tox_")
                           .where(F.col("__tox_score") < threshold).select(*d.columns))

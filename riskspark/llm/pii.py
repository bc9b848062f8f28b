"""Personal data by candidate gradient boosting.

Base rules find e-mail addresses, IPv4 addresses, payment cards and phone numbers. High-recall
generators propose further, overlapping candidate spans (addresses with unusual characters or a
written-out at sign, dotted quads from every octet of longer runs, card numbers from every digit group
in any grouping, phone numbers without a plus). Boosted trees (MLlib, fitted on all labelled candidates of all documents, those of equal
features as one weighted row) score a candidate's format (lengths, groups,
check digit, octets, signs) and context (neighbouring characters, cue words before it). A
candidate is negative where its format refutes it (check digit, octets, a domain without a dot, digits grown into
a word) and else positive where it overlaps a base span; the others, which neither settles, are what the trees are for
and train nothing. Thresholds per kind are calibrated on a held-out third of them
to a precision of ``PRECISION``; a kind with under ``LEAST`` held-out labels takes the threshold of all kinds
together, if those are ``LEAST`` or more. Candidates above the threshold that overlap no base span and no
better candidate are added; base spans always stay.

Everything on the main path is a DataFrame expression: the trees become nested conditions over the
candidates of a row, so a text is read once, without a shuffle. The patterns are possessive or
anchored at run starts, so time is linear in the text and the matcher does not recurse.

Offsets are code points, end exclusive. Defined results: a null or empty text has no spans; repeated
rows give repeated equal results; with candidates of one class only nothing is added; an empty
table gives an empty result; other columns pass through ``find`` if they are in ``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import table, with_safe_names

KINDS = ("email", "ip", "card", "phone")
# Linear forms of the base patterns: possessive runs, started only where a run starts or the last match ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this has no match of the kind.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
# Maximal chains of address runs, octets and digit groups; their windows are the candidates.
AT = r"(?:@|\x20?[\[(]at[\])]\x20?)"
RUN, WIDE = r"[^\s@<>\"'(),;:\[\]]", r"[^\s@<>\"'(),;:]"
CHAINS = {
    "email": rf"(?:\G|(?<!{RUN})){RUN}++(?:{AT}{RUN}++)++",
    "wide": rf"(?:\G|(?<!{WIDE})){WIDE}++(?:{AT}{WIDE}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}+",
    "card": r"(?<![0-9])(?=[0-9](?:[\x20-]?[0-9]){12})[0-9]++(?:[\x20-][0-9]++)*+",
}
PHONE = r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
CONTEXT = 24
CUES = {
    "email": r"(?i)(mail|contact|write|kontakt|courriel|correo)",
    "ip": r"(?i)\b(ip|host|server|address|addr)\b",
    "card": r"(?i)(card|visa|master|amex|credit|karte|carte|tarjeta)",
    "phone": r"(?i)(phone|tel|call|fax|mobile|cell)",
}
FEATURES = ("kind", "length", "digits", "groups", "longest", "luhn", "octets", "plus", "at", "dots", "left_word", "right_word", "cue")
SAMPLE_ROWS = 1_500  # of each kind, for callers that ask for a sample
LEAST = 24  # labelled held-out candidates from which on a threshold can reach PRECISION
TREES, DEPTH = 12, 4
PRECISION = 0.98
BLOCK = 500


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def octets_ok(v: Column) -> Column:
    def ok(p):
        short = F.ltrim(p, F.lit("0"))
        return (F.length(short) <= 3) & (F.coalesce(short.try_cast("int"), F.lit(0)) <= 255)
    return F.forall(F.split(v, "[.]"), ok)


def passes(kind: str, v: Column) -> Column:
    if kind == "ip":
        return octets_ok(v)
    d = _digits(v)
    if kind == "card":
        return F.length(d).between(13, 19) & F.call_function("luhn_check", d)
    if kind == "phone":
        return F.length(d).between(9, 15)
    return F.lit(True)


SPAN = "struct<start:bigint,end:bigint,v:string>"


def matches(text: Column, pattern: str, needs: str = "") -> Column:
    """All leftmost matches of ``pattern`` as array<struct<start, end, v>>.

    The pieces between matches and the matches alternate, so offsets are running sums of their
    lengths, taken block by block to stay linear.
    """
    empty = F.array().cast(f"array<{SPAN}>")
    has = F.contains(text, F.lit(needs)) if needs else F.lit(True)

    def lay(found):
        z = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(found)), found,
                       lambda p, v: F.struct(F.length(p).cast("long").alias("p"), v.alias("v")))
        n_blocks = F.floor((F.size(found) - 1) / BLOCK).cast("int")

        def blocks(zz):
            def inner(a, x):
                start = a["o"] + x["p"]
                end = start + F.length(x["v"])
                return F.struct(end.alias("o"), F.concat(a["out"], F.array(
                    F.struct(start.alias("start"), end.alias("end"), x["v"].alias("v")))).alias("out"))

            def outer(a, k):
                got = F.aggregate(F.slice(zz, k * BLOCK + 1, F.lit(BLOCK)), F.struct(a["o"].alias("o"), empty.alias("out")), inner)
                return _let(got, lambda g: F.struct(g["o"].alias("o"), F.concat(a["out"], g["out"]).alias("out")))

            return F.aggregate(F.sequence(F.lit(0), n_blocks), F.struct(F.lit(0).cast("long").alias("o"), empty.alias("out")),
                               outer, lambda a: a["out"])

        return F.when(F.size(found) == 0, empty).otherwise(_let(z, blocks))

    return F.when(has, _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lay)).otherwise(empty)


def _let(value: Column, f) -> Column:
    return F.element_at(F.transform(F.array(value), f), 1)


def base_spans(text: Column, kind: str) -> Column:
    return F.filter(matches(text, BASE[kind], NEEDS[kind]), lambda s: passes(kind, s["v"]))


def _overlaps(s: Column, spans: Column) -> Column:
    return F.exists(spans, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))


def proposed(text: Column, kind: str) -> Column:
    """Spans of the kind's generators, which may overlap one another and base spans."""
    if kind == "phone":
        return matches(text, PHONE)  # two of these can't overlap
    if kind == "email":
        # runs with brackets of their own besides those without
        bracketed = F.filter(_windows(text, "wide", _addresses), lambda s: F.rlike(F.regexp_replace(s["v"], AT, "@"), F.lit(r"[\[\]]")))
        return F.concat(_windows(text, "email", _addresses), bracketed)
    return _windows(text, kind, _quads if kind == "ip" else _groups, NEEDS[kind])


def _windows(text: Column, chain: str, cut, needs: str = "") -> Column:
    return F.flatten(F.transform(matches(text, CHAINS[chain], needs), cut))


def _part(c: Column, lo: Column, hi: Column) -> Column:
    return F.struct((c["start"] + lo).alias("start"), (c["start"] + hi).alias("end"),
                    F.substring(c["v"], (lo + 1).cast("int"), (hi - lo).cast("int")).alias("v"))


def _addresses(c: Column) -> Column:
    """Each at sign of a chain with the runs on both sides."""
    zero, size = F.lit(0).cast("long"), F.length(c["v"]).cast("long")
    return _let(matches(c["v"], AT), lambda at: F.transform(at, lambda _, k: _part(
        c, F.when(k > 0, F.get(at, k - 1)["end"]).otherwise(zero), F.coalesce(F.get(at, k + 1)["start"], size))))


def _quads(c: Column) -> Column:
    """Four octets from each octet on."""
    return _let(matches(c["v"], "[0-9]++"), lambda g: F.transform(
        F.slice(g, 1, F.size(g) - 3), lambda a, k: _part(c, a["start"], F.get(g, k + 3)["end"])))


def _groups(c: Column) -> Column:
    """All windows of whole digit groups with 13 to 19 digits."""
    def ends(g, a, k):
        return F.filter(F.slice(g, k + 1, F.lit(19)), lambda b, n: (b["end"] - a["start"] - n).between(13, 19))

    return _let(matches(c["v"], "[0-9]++"), lambda g: F.flatten(F.transform(
        g, lambda a, k: F.transform(ends(g, a, k), lambda b: _part(c, a["start"], b["end"])))))


def refuted(text: Column, kind: str, s: Column) -> Column:
    """Whether the format alone rules the candidate out."""
    v = s["v"]
    if kind == "email":
        return ~F.rlike(v, F.lit(r"(?:@|at[\])]\x20?)[A-Za-z0-9-]+\.[A-Za-z0-9-]"))
    if kind == "phone":
        return F.rlike(_left(text, s), F.lit(r"[\p{L}0-9]$")) | F.rlike(_right(text, s), F.lit(r"^[\p{L}0-9]"))
    return ~passes(kind, v)


def labelled(text: Column, kind: str, base: Column) -> Column:
    """Candidates with a label; array<struct<start, end, f: array<double>, label: double>>."""
    rows = F.transform(proposed(text, kind), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), features(text, kind, s).alias("f"),
        F.when(refuted(text, kind, s), 0.0).when(_overlaps(s, base), 1.0).alias("label")))
    return F.filter(rows, lambda c: c["label"].isNotNull())


def candidates(text: Column, kind: str, base: Column) -> Column:
    """Candidates that overlap no base span and aren't refuted; array<struct<start, end, f: array<double>>>."""
    free = F.filter(proposed(text, kind), lambda s: ~_overlaps(s, base) & ~refuted(text, kind, s))
    return F.transform(free, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                features(text, kind, s).alias("f")))


def _left(text: Column, s: Column) -> Column:
    begin = F.greatest(s["start"] - CONTEXT, F.lit(0).cast("long"))
    return F.substring(text, (begin + 1).cast("int"), (s["start"] - begin).cast("int"))


def _right(text: Column, s: Column) -> Column:
    return F.substring(text, (s["end"] + 1).cast("int"), F.lit(1))


def features(text: Column, kind: str, s: Column) -> Column:
    v, d = s["v"], _digits(s["v"])
    groups = F.filter(F.split(v, "[^0-9]+"), lambda g: F.length(g) > 0)
    left, right = _left(text, s), _right(text, s)
    flags = [
        F.lit(float(KINDS.index(kind))), F.length(v), F.length(d), F.size(groups),
        F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0)),
        (F.length(d).between(13, 19) & F.call_function("luhn_check", d)).cast("int"),
        (F.rlike(v, F.lit(r"^[0-9]{1,9}([.][0-9]{1,9}){3}$")) & octets_ok(v)).cast("int"),
        F.startswith(v, F.lit("+")).cast("int"), F.contains(v, F.lit("@")).cast("int"),
        F.size(F.split(v, "[.]")) - 1,
        F.rlike(left, F.lit(r"[\p{L}0-9]$")).cast("int"), F.rlike(right, F.lit(r"^[\p{L}0-9]")).cast("int"),
        F.rlike(left, F.lit(CUES[kind])).cast("int"),
    ]
    return F.array(*[F.coalesce(f.cast("double"), F.lit(0.0)) for f in flags])


# ---- the trees -------------------------------------------------------------------------------

class Boosted:
    """Trees as plain values: nested (feature, threshold, left, right) or a leaf value, and thresholds per kind."""

    def __init__(self, trees=(), weights=(), thresholds=None):
        self.trees, self.weights, self.thresholds = list(trees), list(weights), thresholds or {}

    def margin(self, f: Column) -> Column:
        def node(t):
            if not isinstance(t, tuple):
                return F.lit(float(t))
            return F.when(F.element_at(f, t[0] + 1) <= t[1], node(t[2])).otherwise(node(t[3]))
        total = F.lit(0.0)
        for t, w in zip(self.trees, self.weights):
            total = total + node(t) * w
        return total

    def probability(self, f: Column) -> Column:
        return 1.0 / (1.0 + F.exp(-2.0 * self.margin(f)))


def _plain(node):
    if node.numDescendants() == 0:
        return float(node.prediction())
    split = node.split()
    return (int(split.featureIndex()), float(split.threshold()), _plain(node.leftChild()), _plain(node.rightChild()))


def _texts(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"), F.col(f"`{doc_id}`").cast("string").alias("id"))


def training_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(f, label, fold, n): all labelled candidates of all documents, in one scan; the features are small numbers, so few
    rows of distinct features stand for all candidates. A candidate's fold follows its hash."""
    t = F.col("t")
    every = F.concat(*[labelled(t, kind, base_spans(t, kind)) for kind in KINDS])
    found = _texts(docs, text, doc_id).select(F.xxhash64("id", "t", F.lit("pii")).alias("h"), F.explode(every).alias("c"))
    rows = found.select("c.f", "c.label", F.pmod(F.xxhash64("h", "c.start", "c.end"), F.lit(3)).alias("fold"))
    return table(rows.groupBy("f", "label", "fold").agg(F.count(F.lit(1)).alias("n")), "pii-counts")


def training_sample(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``sample_rows`` labelled candidates (f, label, order, fold) of each kind, by hash from all documents."""
    t = F.col("t")
    src = _texts(docs, text, doc_id)
    every = None
    for kind in KINDS:
        found = src.select(F.xxhash64("id", "t", F.lit("pii")).alias("h"), F.explode(labelled(t, kind, base_spans(t, kind))).alias("c"))
        rows = found.select("c.f", "c.label", F.xxhash64("h", "c.start", "c.end").alias("order"), "c.start") \
            .orderBy("order", "start").limit(sample_rows)
        every = rows if every is None else every.unionByName(rows)
    return table(every.withColumn("fold", F.pmod("order", F.lit(3))).drop("start"), "pii-sample")


def fit(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", precision: float = PRECISION, sample_rows: int | None = None) -> Boosted:
    """Trees and thresholds from all labelled candidates, or from ``sample_rows`` of each kind if that is given."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    if sample_rows is None:
        rows = training_counts(docs, text, doc_id)
    else:
        rows = training_sample(docs, text, doc_id, sample_rows).withColumn("n", F.lit(1).cast("long"))
    train = rows.where("fold <> 0")
    if train.select("label").distinct().count() < 2:
        return Boosted()
    fitted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, stepSize=0.3, weightCol="n").fit(
        train.select(array_to_vector("f").alias("features"), "label", F.col("n").cast("double").alias("n")))
    model = Boosted([_plain(t._java_obj.rootNode() if hasattr(t, "_java_obj") else t._call_java("rootNode"))
                     for t in fitted.trees], list(fitted.treeWeights))
    held = rows.where("fold = 0").select(F.element_at("f", 1).alias("kind"), "label", "n", model.probability(F.col("f")).alias("p"))
    told = held.groupBy("kind", F.round("p", 3).alias("p")).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("good")) \
        .orderBy(F.desc("p")).collect()  # at most 4 x 1001 rows
    pooled = _threshold(told, precision)
    for k, kind in enumerate(KINDS):
        own = [r for r in told if int(r["kind"]) == k]
        best = _threshold(own, precision) if sum(r["n"] for r in own) >= LEAST else pooled
        if best is not None:
            model.thresholds[kind] = best
    return model


def _threshold(told, precision: float) -> float | None:
    """The least probability from which on the held-out candidates (p, n, good), likeliest first, reach ``precision``."""
    at: dict[float, list[int]] = {}
    for r in told:
        a = at.setdefault(float(r["p"]), [0, 0])
        a[0], a[1] = a[0] + r["n"], a[1] + r["good"]
    n = good = 0
    best = None
    for p in sorted(at, reverse=True):
        n, good = n + at[p][0], good + at[p][1]
        if (good + 1) / (n + 1.5) >= precision and n >= LEAST:
            best = p
    return None if best is None else max(0.5, best)


def added_spans(cands: Column, model: Boosted, kind: str) -> Column:
    """Candidates above the threshold, none overlapping a base span or a likelier candidate."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    if kind not in model.thresholds:
        return empty
    scored = F.transform(cands, lambda c: F.struct(
        (-model.probability(c["f"])).alias("q"), c["start"].alias("start"), c["end"].alias("end")))
    good = F.array_sort(F.filter(scored, lambda c: -c["q"] >= model.thresholds[kind]))
    pick = F.aggregate(good, empty, lambda a, c: F.when(
        F.exists(a, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])), a)
        .otherwise(F.concat(a, F.array(F.struct(c["start"].alias("start"), c["end"].alias("end"))))))
    return F.array_sort(pick)


def find(docs: DataFrame, model: Boosted | None = None, keep=("doc_id",), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``keep`` plus, per kind, base_<kind> and added_<kind>: arrays of (start, end) by start.

    A null or empty text has none, null ids and an empty table are nothing special. The method adds to e-mails, addresses,
    cards and phones as the trees and thresholds decide; base spans stay."""
    model = fit(docs, text, doc_id) if model is None else model
    names, keep = list(keep), [f"c{i}" for i in range(len(keep))]  # no helper column is called so
    t = F.col("__t")
    out = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(names, keep)], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__t"))
    out = out.select("*", *[base_spans(t, k).alias(f"__b_{k}") for k in KINDS])
    wanted = [k for k in KINDS if k in model.thresholds]
    out = out.select("*", *[candidates(t, k, F.col(f"__b_{k}")).alias(f"__c_{k}") for k in wanted])
    place = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))
    return out.select(
        *[F.col(k).alias(c) for c, k in zip(names, keep)],
        *[F.transform(F.col(f"__b_{k}"), place).alias(f"base_{k}") for k in KINDS],
        *[(added_spans(F.col(f"__c_{k}"), model, k) if k in wanted else F.array().cast("array<struct<start:bigint,end:bigint>>"))
          .alias(f"added_{k}") for k in KINDS])


def written(spans: dict[str, Column]) -> Column:
    """kind:start:end by kind as listed, then start, comma-joined."""
    def named(kind):  # a function of its own: F.transform would pass the index as a second parameter
        return F.transform(F.array_sort(spans[kind]), lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))

    parts = [named(k) for k in KINDS]
    return F.array_join(F.concat(*parts), ",")


def redact(docs: DataFrame, model: Boosted | None = None, text: str = "text", doc_id: str = "doc_id", mask: str = "█") -> DataFrame:
    """``docs`` with every found span replaced by as many mask characters as it is long."""
    model = fit(docs, text, doc_id) if model is None else model
    return with_safe_names(docs, lambda d, at: _redact(d, model, at(text), mask))


def _redact(docs: DataFrame, model: Boosted, text: str, mask: str) -> DataFrame:
    found = find(docs, model, docs.columns, text)
    every = F.array_sort(F.concat(*[F.col(f"{p}_{k}") for p in ("base", "added") for k in KINDS]))
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    zero = F.struct(F.lit(0).cast("long").alias("o"), F.array().cast("array<string>").alias("out"))

    def step(a, s):
        begin = F.greatest(a["o"], s["start"])
        skip = s["end"] <= a["o"]
        return F.when(skip, a).otherwise(F.struct(s["end"].alias("o"), F.concat(a["out"], F.array(
            F.substring(t, (a["o"] + 1).cast("int"), (begin - a["o"]).cast("int")),
            F.repeat(F.lit(mask), (s["end"] - begin).cast("int")))).alias("out")))

    done = F.aggregate(every, zero, step)
    masked = _let(done, lambda d: F.concat(F.array_join(d["out"], ""), F.substring(t, (d["o"] + 1).cast("int"), F.lit(2147483647))))
    return found.withColumn(text, F.when(F.col(f"`{text}`").isNotNull(), masked)).select(*[F.col(f"`{c}`") for c in docs.columns])

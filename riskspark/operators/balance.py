"""Minority oversampling to class parity by interpolating towards one of the k
nearest minority neighbours (the SMOTE rule), as Spark jobs with exact neighbours.

Exact k-NN without comparing all pairs:

1. Identical minority vectors are collapsed first (one representative with a count).
2. The vectors are split into a tree of boxes (``box_tree``): a node of more than ``leaf_size``
   vectors is cut at quantiles and the middle of its widest dimension into up to ``FAN`` children, level by level for all
   nodes at once, until every leaf is small. However many vectors there are, leaves stay small and
   the tree just gets deeper; it is a table, never broadcast whole or collected.
3. Pass 1 compares each vector with its own leaf and takes the k-th smallest distance D as an
   upper bound of the true k-th neighbour distance (in leaves of up to k vectors: the distance to the far
   corner of the smallest box around it with more than k vectors).
4. Pass 2 walks down the tree, a join a level: a vector goes on to the children whose box is at most D
   away. The leaves it reaches hold all its neighbours; it is compared with their vectors.

No candidate cap is applied. Vectors without structure in many dimensions reach most leaves, as in any exact search.
Synthetic rows: each minority row gets floor(need / n_min) samples, the first
need mod n_min rows in hash order one more (exactly ``need`` in total); sample j picks
its neighbour and its gap from ``xxhash64(seed, key, j)``.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators.split import rank_by_hash
from riskspark.session import ensure_checkpoint_dir

DEFAULT_K = 5


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda u, v: (u - v) * (u - v)), F.lit(0.0), lambda acc, t: acc + t)


def box_distance(x: Column, lo: Column, hi: Column) -> Column:
    """Squared distance from a point to a box (0 inside)."""
    out = F.zip_with(x, F.arrays_zip(lo.alias("lo"), hi.alias("hi")), lambda v, b: F.greatest(b["lo"] - v, v - b["hi"], F.lit(0.0)))
    return F.aggregate(out, F.lit(0.0), lambda acc, t: acc + t * t)


def far_corner(x: Column, lo: Column, hi: Column) -> Column:
    """Squared distance from a point to the farthest point of a box."""
    out = F.zip_with(x, F.arrays_zip(lo.alias("lo"), hi.alias("hi")), lambda v, b: F.greatest(F.abs(v - b["lo"]), F.abs(b["hi"] - v)))
    return F.aggregate(out, F.lit(0.0), lambda acc, t: acc + t * t)


def _top_k(pairs: DataFrame, k: int, spread: int = 64) -> DataFrame:
    """k nearest candidates per query point, in two levels: first per (point, hash bucket of
    the candidate), then per point over at most k x ``spread`` survivors, so no window group
    holds all candidates of a point with very many of them."""
    part = F.pmod(F.xxhash64("y"), F.lit(spread))
    w1 = Window.partitionBy("q", "_part").orderBy("d2", "y")
    first = pairs.withColumn("_part", part).withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k)
    w = Window.partitionBy("q").orderBy("d2", "y")
    return first.drop("_part", "_r1").withColumn("neighbor_rank", F.row_number().over(w)).where(
        F.col("neighbor_rank") <= k)


FAN = 16
LEAF_SIZE = 64


def _boxes(points: DataFrame, dim: int) -> DataFrame:
    """(node, n, lo, hi): the vectors and the box of each node."""
    x = [F.col("x")[i] for i in range(dim)]
    return points.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.min(c) for c in x]).alias("lo"), F.array(*[F.max(c) for c in x]).alias("hi"))


def box_tree(points: DataFrame, k: int, leaf_size: int = LEAF_SIZE, fan: int = FAN):
    """(leaves, nodes): ``points`` (rep, x; distinct vectors) with the ``node`` of their leaf, and a list of the tree's
    levels (parent, node, leaf, lo, hi, big_lo, big_hi); ``big`` is the smallest box at or above the node with over ``k`` vectors."""
    spark = points.sparkSession
    dim = len(points.first()["x"])
    cur = points.withColumn("node", F.lit(0).cast("long"))
    done, levels = None, []
    parents = spark.createDataFrame([], "node long, parent long, p_lo array<double>, p_hi array<double>")
    while True:
        boxes = _boxes(cur, dim).join(parents, "node", "left")
        over = F.col("n") > k
        level = boxes.select("parent", "node", (F.col("n") <= leaf_size).alias("leaf"), "lo", "hi",
                             F.when(over, F.col("lo")).otherwise(F.coalesce("p_lo", "lo")).alias("big_lo"),
                             F.when(over, F.col("hi")).otherwise(F.coalesce("p_hi", "hi")).alias("big_hi")).checkpoint(eager=True)
        levels.append(level)
        at_leaf = cur.join(level.where("leaf").select("node"), "node", "left_semi")
        done = at_leaf if done is None else done.unionByName(at_leaf)
        if not level.where("NOT leaf").limit(1).count():
            return done.select("rep", "x", "node"), levels
        spread = F.zip_with("hi", "lo", lambda a, b: a - b)
        wide = level.where("NOT leaf").withColumn("axis", F.array_position(spread, F.array_max(spread)) - 1).withColumn(
            "middle", F.get("lo", F.col("axis").cast("int")) / 2 + F.get("hi", F.col("axis").cast("int")) / 2).select(
            "node", "axis", "middle", "big_lo", "big_hi")
        inner = cur.join(wide, "node").withColumn("v", F.get("x", F.col("axis").cast("int")))
        cuts = inner.groupBy("node").agg(F.percentile_approx("v", [i / (fan - 1) for i in range(1, fan - 1)], 1000).alias("q"))
        # the middle keeps a node whose quantiles are all its largest value from staying whole
        inner = inner.join(cuts, "node").withColumn("below", F.size(F.filter(F.array_distinct(F.concat("q", F.array("middle"))), lambda c: c < F.col("v"))))
        child = F.xxhash64("node", "below", F.lit(len(levels)))
        nxt = inner.select("rep", "x", child.alias("node"), F.col("node").alias("parent"), "big_lo", "big_hi").checkpoint(eager=True)
        parents = nxt.groupBy("node").agg(F.first("parent").alias("parent"), F.first("big_lo").alias("p_lo"), F.first("big_hi").alias("p_hi"))
        cur = nxt.select("rep", "x", "node")


def minority_neighbors(df: DataFrame, key: str, x_col: str, label: str = "Fraud", minority: int = 1,
                       k: int = DEFAULT_K, leaf_size: int = LEAF_SIZE) -> DataFrame:
    """(key, neighbor_rank, neighbor, d2) for every distinct minority vector; ``x_col`` is
    an array<double> column. Ties in distance go to the smaller neighbour key."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    mino = df.where(F.col(label) == minority).select(F.col(key).cast("string").alias("_k"), F.col(x_col).alias("x"))
    dv = mino.groupBy("x").agg(F.min("_k").alias("rep")).select("rep", "x").checkpoint(eager=True)
    if len(dv.take(2)) < 2:  # fewer than two distinct vectors: nobody has a neighbour
        return spark.createDataFrame([], f"`{key}` string, neighbor_rank int, neighbor string, d2 double")
    points, levels = box_tree(dv, k, max(leaf_size, k + 1))
    points = points.checkpoint(eager=True)
    q = points.select(F.col("rep").alias("q"), F.col("x").alias("qx"), "node")
    y = points.select(F.col("rep").alias("y"), F.col("x").alias("yx"), "node")
    pairs = q.join(y, "node").where(F.col("q") != F.col("y")).withColumn("d2", squared_distance(F.col("qx"), F.col("yx")))
    kth = pairs.groupBy("q").agg(F.sort_array(F.collect_list("d2")).alias("ds")).where(F.size("ds") >= k).select(
        "q", F.col("ds")[k - 1].alias("kth"))  # a leaf is small, so is the list
    leaf = levels[0].where("leaf")
    for level in levels[1:]:
        leaf = leaf.unionByName(level.where("leaf"))
    bound = q.join(leaf.select("node", "big_lo", "big_hi"), "node").join(kth, "q", "left").select(
        "q", "qx", F.coalesce("kth", far_corner(F.col("qx"), F.col("big_lo"), F.col("big_hi"))).alias("bound"))
    # a small relative slack keeps the test conservative under rounding
    at = bound.withColumn("bound", F.col("bound") * (1 + 1e-9) + 1e-300).withColumn("node", F.lit(0).cast("long")).checkpoint(eager=True)
    reached = at if levels[0].where("leaf").limit(1).count() else None
    for level in levels[1:]:
        near = at.withColumnRenamed("node", "parent").join(level, "parent").where(
            box_distance(F.col("qx"), F.col("lo"), F.col("hi")) <= F.col("bound"))
        near = near.select("q", "qx", "bound", "node", "leaf").checkpoint(eager=True)
        ends = near.where("leaf").drop("leaf")
        reached = ends if reached is None else reached.unionByName(ends)
        at = near.where("NOT leaf").drop("leaf")
    found = reached.join(y, "node").where(F.col("q") != F.col("y")).withColumn(
        "d2", squared_distance(F.col("qx"), F.col("yx"))).where(F.col("d2") <= F.col("bound"))
    return _top_k(found, k).select(F.col("q").alias(key), "neighbor_rank", F.col("y").alias("neighbor"), "d2")


def _uniform(seed: int, key: Column, j: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), key, j), F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))


def oversample(df: DataFrame, key: str, features_col: str, label: str = "Fraud", minority: int = 1,
               k: int = DEFAULT_K, seed: int = 42) -> DataFrame:
    """Df plus synthetic minority rows up to class parity. ``features_col`` is a vector
    column; synthetic rows get key ``<key>#<j>`` and ``synthetic = true``."""
    counts = {int(r[0]): int(r[1]) for r in df.groupBy(label).count().collect()}
    n_min = counts.get(minority, 0)
    n_maj = max((c for lab, c in counts.items() if lab != minority), default=0)
    need = n_maj - n_min
    base = df.withColumn("synthetic", F.lit(False))
    if need <= 0 or n_min < 2:
        return base
    # the minority's keys and vectors feed every step below: computed once
    ensure_checkpoint_dir(df.sparkSession)
    mino = df.where(F.col(label) == minority).select(key, label, vector_to_array(F.col(features_col)).alias("_x")).where(
        F.col("_x").isNotNull()).checkpoint(eager=True)
    nbrs = minority_neighbors(mino, key, "_x", label, minority, k)
    lists = nbrs.join(mino.select(F.col(key).cast("string").alias("neighbor"), F.col("_x").alias("_nx")), "neighbor").groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("neighbor_rank", "_nx"))).alias("_nn"))
    # rows that share a vector use its representative's neighbour list
    reps = mino.groupBy("_x").agg(F.min(F.col(key).cast("string")).alias("_rep"))
    lists = reps.join(lists.withColumnRenamed(key, "_rep"), "_rep", "left")
    # a vector with no other distinct minority vector interpolates towards its own copies
    self_only = F.array(F.struct(F.lit(1).alias("neighbor_rank"), F.col("_x").alias("_nx")))
    lists = lists.select("_x", F.coalesce(F.col("_nn"), self_only).alias("_nn"))
    # ranked as narrow rows; only those that get synthetic ones meet the lists, one per distinct vector
    ranked = rank_by_hash(mino.drop(label), key, seed, None, total_rows=n_min)
    per_row, extra = divmod(need, n_min)
    n_new = F.lit(per_row) + F.when(F.col("_rank") <= extra, F.lit(1)).otherwise(F.lit(0))
    gen = ranked.where(n_new > 0).join(lists, "_x").withColumn("_j", F.explode(F.sequence(F.lit(1), n_new)))
    kk = F.size("_nn")
    pick = F.pmod(F.xxhash64(F.lit(seed), F.col(key).cast("string"), F.col("_j")), kk.cast("long")).cast("int")
    nn = F.element_at("_nn", pick + 1)["_nx"]
    u = _uniform(seed + 1, F.col(key).cast("string"), F.col("_j"))
    xnew = F.zip_with("_x", nn, lambda a, b: a + u * (b - a))
    synth = gen.select(
        F.concat(F.col(key).cast("string"), F.lit("#"), F.col("_j").cast("string")).alias(key),
        F.lit(minority).cast(df.schema[label].dataType).alias(label),
        array_to_vector(xnew).alias(features_col),
        F.lit(True).alias("synthetic"),
    )
    keep = [c for c in base.columns if c not in synth.columns]
    for c in keep:
        synth = synth.withColumn(c, F.lit(None).cast(df.schema[c].dataType))
    return base.unionByName(synth.select(*base.columns))

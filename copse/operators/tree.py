"""Gini decision trees for many bags at once, grown level by level.

A tree is a table ``(model_id, node_id, depth, feature, threshold,
is_leaf, prediction, n, impurity)`` with heap node ids (root 1, children
2i and 2i+1; left means ``x[feature] <= threshold``).

One level of every tree of every bag is one set of jobs:

1. class counts per (model, node) -> impurity, size, majority label;
2. a histogram per (model, node, feature, value, label) of bag weights:
   partial aggregation runs before the shuffle, so the shuffle is bounded
   by models x nodes x features x bins x classes, not by rows;
3. each value is mapped to its candidate threshold (the smallest
   candidate at or above it), class counts are made dense over the node's
   labels, and a running sum over thresholds gives the left-side counts;
4. the split score ``((nL - sum l^2/nL) + (nR - sum r^2/nR)) / n`` (the
   weighted Gini of both sides) is ranked per node by (score rounded to 9
   places, feature, threshold); both sides must be non-empty;
5. rows move to their child through a broadcast join with the level's
   splits (bounded by models x 2^depth rows).

Only the level's node table (small) is checkpointed; the rows are routed
again from the (persisted) bag at every level, so no per-level copy of
the data is written.

Candidate thresholds are the sorted distinct values of the feature in the
whole bag (not the node). With more than ``max_candidates`` values, the
candidates are every ``len div max_candidates``-th value from a seeded
offset in [1, max_candidates], as in the reference's thinning; the offset
is an md5 draw of (seed, model, node, feature).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from copse.functions.argmax import argmax_label
from copse.functions.draws import uniform
from copse.operators.encode import value_table
from copse.plans.broadcast import bounded_broadcast
from copse.plans.lineage import cut_lineage

# Fixed value: candidate thresholds kept per feature before thinning.
MAX_CANDIDATES = 20

NODE_COLUMNS = ["model_id", "node_id", "depth", "feature", "threshold", "is_leaf",
                "prediction", "n", "impurity"]


def gini(counts: DataFrame, group: list[str], n: str = "n") -> DataFrame:
    """Gini impurity ``1 - sum (n_c / n)^2`` per group of class counts."""
    return counts.groupBy(*group).agg(
        F.sum(n).alias("total"), F.sum(F.col(n) * F.col(n)).alias("sq")
    ).select(*group, F.col("total").cast("bigint").alias("n"),
             (F.lit(1.0) - F.col("sq").cast("double") / (F.col("total").cast("double") ** 2))
             .alias("gini"))


def node_stats(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per (model, node, label) weights and per (model, node) summary."""
    by_class = rows.groupBy("model_id", "node_id", "label").agg(
        F.sum("w").cast("bigint").alias("n"))
    summary = by_class.groupBy("model_id", "node_id").agg(
        F.sum("n").cast("bigint").alias("n"),
        F.sum(F.col("n") * F.col("n")).cast("double").alias("sq"),
        F.count("*").alias("n_classes"),
        argmax_label("label", "n").alias("prediction"),
    ).withColumn("impurity", F.lit(1.0) - F.col("sq") / (F.col("n").cast("double") ** 2)) \
        .drop("sq")
    return by_class, summary


def candidate_slot(pos, n_values, offset, k: int = MAX_CANDIDATES):
    """Position of the smallest candidate threshold at or above ``pos``
    (NULL when the value lies above the last candidate)."""
    step = (n_values / k).cast("int")
    thinned = F.when(
        pos <= offset, offset
    ).otherwise(offset + F.ceil((pos - offset) / step).cast("int") * step)
    slot = F.when(n_values <= k, pos).otherwise(thinned)
    return F.when(slot < n_values, slot)


def thinning_offset(seed: int, k: int = MAX_CANDIDATES):
    key = F.concat_ws("|", F.col("node_id").cast("string"), F.col("feature").cast("string"))
    return (F.lit(1) + F.floor(uniform(seed, F.col("model_id"), key) * F.lit(k))).cast("int")


def candidates(vt: DataFrame, nodes: DataFrame, seed: int, k: int = MAX_CANDIDATES) -> DataFrame:
    """Thinned candidate thresholds per (model, node, feature)."""
    per = nodes.select("model_id", "node_id").join(
        vt.select("model_id", "feature", "n_values").distinct(), "model_id")
    per = per.withColumn("offset", thinning_offset(seed, k))
    slots = per.select(
        "model_id", "node_id", "feature",
        F.when(F.col("n_values") <= k, F.sequence(F.lit(0), F.col("n_values") - 1))
        .otherwise(F.when(F.col("offset") < F.col("n_values"), F.sequence(
            F.col("offset"), F.col("n_values") - 1,
            F.greatest((F.col("n_values") / k).cast("int"), F.lit(1))))
            .otherwise(F.array().cast("array<int>"))).alias("slots"))
    return slots.select("model_id", "node_id", "feature", F.explode("slots").alias("pos")) \
        .join(vt.select("model_id", "feature", "pos", F.col("value").alias("threshold")),
              ["model_id", "feature", "pos"])


def split_scores(rows: DataFrame, by_class: DataFrame, vt: DataFrame, seed: int,
                 k: int = MAX_CANDIDATES) -> DataFrame:
    """Weighted Gini of every candidate split of every (model, node).

    ``rows`` carries (model_id, node_id, label, w, features)."""
    hist = rows.select("model_id", "node_id", "label", "w",
                       F.posexplode("features").alias("feature", "value")) \
        .groupBy("model_id", "node_id", "feature", "value", "label") \
        .agg(F.sum("w").cast("bigint").alias("n"))
    hist = hist.join(vt, ["model_id", "feature", "value"])
    hist = hist.withColumn("offset", thinning_offset(seed, k)).withColumn(
        "slot", candidate_slot(F.col("pos"), F.col("n_values"), F.col("offset"), k))
    at_slot = hist.where(F.col("slot").isNotNull()) \
        .groupBy("model_id", "node_id", "feature", "slot", "label") \
        .agg(F.sum("n").alias("n"))
    # Dense (slot x label) grid per node so every label has a running sum.
    grid = at_slot.select("model_id", "node_id", "feature", "slot").distinct() \
        .join(by_class.select("model_id", "node_id", "label", F.col("n").alias("t")),
              ["model_id", "node_id"])
    dense = grid.join(at_slot, ["model_id", "node_id", "feature", "slot", "label"], "left") \
        .fillna(0, subset=["n"])
    run = Window.partitionBy("model_id", "node_id", "feature", "label").orderBy("slot") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = dense.withColumn("l", F.sum("n").over(run)).withColumn("r", F.col("t") - F.col("l"))
    sums = left.groupBy("model_id", "node_id", "feature", "slot").agg(
        F.sum("l").cast("double").alias("nl"),
        F.sum(F.col("l") * F.col("l")).cast("double").alias("sql"),
        F.sum("r").cast("double").alias("nr"),
        F.sum(F.col("r") * F.col("r")).cast("double").alias("sqr"),
    ).where((F.col("nl") > 0) & (F.col("nr") > 0))
    score = ((F.col("nl") - F.col("sql") / F.col("nl")) + (F.col("nr") - F.col("sqr") / F.col("nr"))) \
        / (F.col("nl") + F.col("nr"))
    return sums.join(vt.select("model_id", "feature", F.col("pos").alias("slot"),
                               F.col("value").alias("threshold")),
                     ["model_id", "feature", "slot"]) \
        .select("model_id", "node_id", "feature", "threshold",
                F.col("nl").cast("bigint").alias("n_left"),
                F.col("nr").cast("bigint").alias("n_right"),
                score.alias("score"))


# Label domains up to this size use one count column per label (a pivot
# inside the aggregation); larger ones use the long (label-per-row) form.
WIDE_MAX_LABELS = 64


def split_scores_wide(rows: DataFrame, by_class: DataFrame, vt: DataFrame, seed: int,
                      labels: list[int], k: int = MAX_CANDIDATES,
                      vt_rows: int | None = None) -> DataFrame:
    """T2 for a small label domain: class counts are pivoted into columns
    inside the histogram aggregation, so the running left-side counts are
    one window over (model, node, feature) and no dense grid is joined."""
    idx = list(range(len(labels)))
    per_label = [F.sum(F.when(F.col("label") == F.lit(c), F.col("w")).otherwise(F.lit(0)))
                 .cast("bigint").alias(f"c{i}") for i, c in zip(idx, labels)]
    hist = rows.select("model_id", "node_id", "label", "w",
                       F.posexplode("features").alias("feature", "value")) \
        .groupBy("model_id", "node_id", "feature", "value").agg(*per_label)
    vt_b = bounded_broadcast(vt, vt_rows) if vt_rows is not None else vt
    hist = hist.join(vt_b, ["model_id", "feature", "value"])
    hist = hist.withColumn("offset", thinning_offset(seed, k)).withColumn(
        "slot", candidate_slot(F.col("pos"), F.col("n_values"), F.col("offset"), k))
    # From here on the data is the per-value histogram (bounded by models x
    # nodes x features x bins). One exchange on (model, node) serves the
    # slot aggregation, the running-sum window and the best-split choice.
    at_slot = hist.where(F.col("slot").isNotNull()) \
        .repartition("model_id", "node_id") \
        .groupBy("model_id", "node_id", "feature", "slot") \
        .agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in idx])
    run = Window.partitionBy("model_id", "node_id", "feature").orderBy("slot") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = at_slot.select("model_id", "node_id", "feature", "slot",
                          *[F.sum(f"c{i}").over(run).alias(f"l{i}") for i in idx])
    totals = by_class.groupBy("model_id", "node_id").agg(
        *[F.sum(F.when(F.col("label") == F.lit(c), F.col("n")).otherwise(F.lit(0)))
          .alias(f"t{i}") for i, c in zip(idx, labels)])
    left = left.join(F.broadcast(totals), ["model_id", "node_id"])
    nl = sum((F.col(f"l{i}") for i in idx), F.lit(0)).cast("double")
    nr = sum((F.col(f"t{i}") - F.col(f"l{i}") for i in idx), F.lit(0)).cast("double")
    sql = sum((F.col(f"l{i}") * F.col(f"l{i}") for i in idx), F.lit(0)).cast("double")
    sqr = sum(((F.col(f"t{i}") - F.col(f"l{i}")) * (F.col(f"t{i}") - F.col(f"l{i}"))
               for i in idx), F.lit(0)).cast("double")
    sums = left.select("model_id", "node_id", "feature", "slot", nl.alias("nl"), nr.alias("nr"),
                       sql.alias("sql"), sqr.alias("sqr")) \
        .where((F.col("nl") > 0) & (F.col("nr") > 0))
    score = ((F.col("nl") - F.col("sql") / F.col("nl")) + (F.col("nr") - F.col("sqr") / F.col("nr"))) \
        / (F.col("nl") + F.col("nr"))
    thr = vt.select("model_id", "feature", F.col("pos").alias("slot"), F.col("value").alias("threshold"))
    thr = bounded_broadcast(thr, vt_rows) if vt_rows is not None else thr
    return sums.join(thr, ["model_id", "feature", "slot"]) \
        .select("model_id", "node_id", "feature", "threshold",
                F.col("nl").cast("bigint").alias("n_left"),
                F.col("nr").cast("bigint").alias("n_right"),
                score.alias("score"))


def best_splits(scores: DataFrame) -> DataFrame:
    """T4: per (model, node) the split with the lowest score (rounded to 9
    places), ties by feature then threshold: the minimum of a struct in
    that field order, one hash aggregation with partial combine."""
    best = F.min(F.struct(F.round("score", 9).alias("rs"), F.col("feature").cast("int").alias("feature"),
                          "threshold", "n_left", "n_right", "score")).alias("b")
    return scores.groupBy("model_id", "node_id").agg(best).select(
        "model_id", "node_id", "b.feature", "b.threshold", "b.n_left", "b.n_right", "b.score")


def _summary(totals: DataFrame, labels: list[int]) -> DataFrame:
    """Node summary from pivoted class totals t0..t{L-1} per (model, node)."""
    idx = range(len(labels))
    n = sum((F.col(f"t{i}") for i in idx), F.lit(0))
    sq = sum((F.col(f"t{i}") * F.col(f"t{i}") for i in idx), F.lit(0)).cast("double")
    n_classes = sum((F.when(F.col(f"t{i}") > 0, 1).otherwise(0) for i in idx), F.lit(0))
    best = F.array_max(F.array(*[F.struct(F.col(f"t{i}").alias("n"), F.lit(-c).alias("neg"),
                                          F.lit(c).alias("label")) for i, c in zip(idx, labels)]))
    return totals.select(
        "model_id", "node_id", n.cast("bigint").alias("n"), n_classes.alias("n_classes"),
        best.getField("label").cast("bigint").alias("prediction"),
        (F.lit(1.0) - sq / (n.cast("double") * n.cast("double"))).alias("impurity"))


def level_wide(rows: DataFrame, vt: DataFrame, seed: int, labels: list[int], depth: int,
               last: bool, k: int = MAX_CANDIDATES, vt_rows: int | None = None) -> DataFrame:
    """One level of every tree as one job (label domains <= WIDE_MAX_LABELS).

    The histogram (partial aggregation before its shuffle) is repartitioned
    once on (model, node, feature), so a level of few nodes still uses a task
    for each feature; totals, slot sums and the running window reuse that
    partitioning. Only one candidate split and one set of totals for each of
    its partitions and nodes are shuffled again, to choose the best split."""
    idx = list(range(len(labels)))
    pivot = [F.sum(F.when(F.col("label") == F.lit(c), F.col("w")).otherwise(F.lit(0)))
             .cast("bigint").alias(f"c{i}") for i, c in zip(idx, labels)]
    if last:
        totals = rows.groupBy("model_id", "node_id").agg(
            *[p.alias(f"t{i}") for i, p in zip(idx, pivot)])
        return _summary(totals, labels).select(
            "model_id", "node_id", F.lit(depth).alias("depth"), F.lit(None).cast("int").alias("feature"),
            F.lit(None).cast("double").alias("threshold"), F.lit(True).alias("is_leaf"),
            "prediction", "n", "impurity")
    # Node totals ride along on every histogram row (a window over one
    # feature's values); nothing filters the histogram, so the summary and
    # the split search share its single exchange.
    per_feature = Window.partitionBy("model_id", "node_id", "feature")
    hist = rows.select("model_id", "node_id", "label", "w",
                       F.posexplode("features").alias("feature", "value")) \
        .groupBy("model_id", "node_id", "feature", "value").agg(*pivot) \
        .repartition("model_id", "node_id", "feature")
    hist = hist.select("*", *[F.sum(f"c{i}").over(per_feature).alias(f"t{i}") for i in idx])
    totals = hist.groupBy("model_id", "node_id").agg(*[F.max(f"t{i}").alias(f"t{i}") for i in idx])
    vt_b = bounded_broadcast(vt, vt_rows) if vt_rows is not None else vt
    slotted = hist.join(vt_b, ["model_id", "feature", "value"]) \
        .withColumn("offset", thinning_offset(seed, k)) \
        .withColumn("slot", candidate_slot(F.col("pos"), F.col("n_values"), F.col("offset"), k)) \
        .where(F.col("slot").isNotNull())
    at_slot = slotted.groupBy("model_id", "node_id", "feature", "slot") \
        .agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in idx],
             *[F.first(f"t{i}").alias(f"t{i}") for i in idx])
    run = Window.partitionBy("model_id", "node_id", "feature").orderBy("slot") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = at_slot.select("model_id", "node_id", "feature", "slot",
                          *[F.col(f"t{i}") for i in idx],
                          *[F.sum(f"c{i}").over(run).alias(f"l{i}") for i in idx])
    nl = sum((F.col(f"l{i}") for i in idx), F.lit(0)).cast("double")
    nr = sum((F.col(f"t{i}") - F.col(f"l{i}") for i in idx), F.lit(0)).cast("double")
    sql = sum((F.col(f"l{i}") * F.col(f"l{i}") for i in idx), F.lit(0)).cast("double")
    sqr = sum(((F.col(f"t{i}") - F.col(f"l{i}")) * (F.col(f"t{i}") - F.col(f"l{i}"))
               for i in idx), F.lit(0)).cast("double")
    sums = left.select("model_id", "node_id", "feature", "slot", nl.alias("nl"), nr.alias("nr"),
                       sql.alias("sql"), sqr.alias("sqr")) \
        .where((F.col("nl") > 0) & (F.col("nr") > 0))
    score = ((F.col("nl") - F.col("sql") / F.col("nl")) + (F.col("nr") - F.col("sqr") / F.col("nr"))) \
        / (F.col("nl") + F.col("nr"))
    thr = vt.select("model_id", "feature", F.col("pos").alias("slot"), F.col("value").alias("threshold"))
    thr = bounded_broadcast(thr, vt_rows) if vt_rows is not None else thr
    scored = sums.join(thr, ["model_id", "feature", "slot"]).select(
        "model_id", "node_id", "feature", "threshold",
        F.col("nl").cast("bigint").alias("n_left"), F.col("nr").cast("bigint").alias("n_right"),
        score.alias("score"))
    best = best_splits(scored).select("model_id", "node_id", "feature", "threshold")
    summary = _summary(totals, labels)
    lv = summary.join(best, ["model_id", "node_id"], "left")
    split = (F.col("n_classes") > 1) & F.col("feature").isNotNull()
    return lv.select(
        "model_id", "node_id", F.lit(depth).alias("depth"),
        F.when(split, F.col("feature")).cast("int").alias("feature"),
        F.when(split, F.col("threshold")).cast("double").alias("threshold"),
        (~split).alias("is_leaf"), "prediction", "n", "impurity")


def route(rows: DataFrame, level: DataFrame, bound: int) -> DataFrame:
    """Move rows of split nodes to their child; rows of leaves drop out."""
    splits = level.where(~F.col("is_leaf")).select("model_id", "node_id", "feature", "threshold")
    go_left = F.element_at("features", F.col("feature") + 1) <= F.col("threshold")
    return rows.join(bounded_broadcast(splits, bound), ["model_id", "node_id"]) \
        .withColumn("node_id", F.col("node_id") * 2 + F.when(go_left, 0).otherwise(1)) \
        .drop("feature", "threshold")


def _level_long(rows: DataFrame, vt: DataFrame, seed: int, depth: int, max_depth: int,
                bound: int, k: int) -> DataFrame:
    """One level for large label domains (one row per label)."""
    by_class, summary = node_stats(rows)
    level = summary.withColumn("depth", F.lit(depth))
    if depth < max_depth:
        open_nodes = summary.where(F.col("n_classes") > 1).select("model_id", "node_id")
        live = rows.join(bounded_broadcast(open_nodes, bound), ["model_id", "node_id"])
        best = best_splits(split_scores(live, by_class, vt, seed, k)) \
            .select("model_id", "node_id", "feature", "threshold")
        level = level.join(best, ["model_id", "node_id"], "left")
    else:
        level = level.withColumn("feature", F.lit(None).cast("int")) \
            .withColumn("threshold", F.lit(None).cast("double"))
    return level.withColumn("is_leaf", F.col("feature").isNull()).select(
        "model_id", "node_id", "depth", F.col("feature").cast("int").alias("feature"),
        "threshold", "is_leaf", "prediction", "n", "impurity")


def _route_expression(node_rows, depth: int):
    """Node id at ``depth`` for every (model, row), as one CASE WHEN over the
    splits grown so far; rows that stopped at a shallower leaf get -1.
    Replaces ``depth`` broadcast joins (one broadcast job each) by a
    projection of the cached bag."""
    trees: dict[int, dict[int, object]] = {}
    for r in node_rows:
        trees.setdefault(int(r["model_id"]), {})[int(r["node_id"])] = r

    def build(tree, node_id: int, d: int):
        if d == depth:
            return F.lit(node_id).cast("bigint")
        r = tree[node_id]
        if r["is_leaf"]:
            return F.lit(-1).cast("bigint")
        x = F.element_at(F.col("features"), F.lit(int(r["feature"]) + 1))
        return F.when(x <= F.lit(float(r["threshold"])), build(tree, 2 * node_id, d + 1)) \
            .otherwise(build(tree, 2 * node_id + 1, d + 1))

    expr = None
    for m, tree in sorted(trees.items()):
        arm = build(tree, 1, 0)
        expr = (F.when if expr is None else expr.when)(F.col("model_id") == F.lit(m), arm)
    return expr.otherwise(F.lit(-1).cast("bigint"))


def fit(bagged: DataFrame, max_depth: int, seed: int, max_candidates: int = MAX_CANDIDATES,
        persist: bool = True) -> DataFrame:
    """Grow one tree per ``model_id`` of ``bagged``
    (model_id, row_id, w, label, features already encoded)."""
    if max_depth < 0:
        raise ValueError("max_depth must be >= 0")
    base = bagged.select("model_id", "w", "label", "features")
    if persist:
        base = base.persist(StorageLevel.MEMORY_AND_DISK)
    vt_all = cut_lineage(value_table(base, with_labels=True))
    vt = vt_all.where(F.col("feature") >= 0)
    sizes = vt.agg(F.count("*").alias("rows"), F.count_distinct("model_id").alias("models")).first()
    vt_rows, n_models = int(sizes["rows"]), int(sizes["models"])
    labels = sorted({int(r[0]) for r in vt_all.where(F.col("feature") == -1).select("value")
                    .distinct().limit(WIDE_MAX_LABELS + 1).collect()})
    rows = base.withColumn("node_id", F.lit(1).cast("bigint"))
    levels = []
    grown: list = []
    n_grown = 0
    wide = len(labels) <= WIDE_MAX_LABELS
    for depth in range(max_depth + 1):
        bound = max(1, n_models) * (2 ** depth)
        if wide:
            level = level_wide(rows, vt, seed, labels, depth, depth == max_depth,
                               max_candidates, vt_rows)
        else:
            level = _level_long(rows, vt, seed, depth, max_depth, bound, max_candidates)
        level = cut_lineage(level)
        levels.append(level)
        if depth == max_depth:
            break
        # Whether any split remains is decided on the whole level; its node
        # rows are read only while all rows so far are few enough to compile.
        n_rows, n_splits = level.agg(F.count("*"), F.sum((~F.col("is_leaf")).cast("long"))).first()
        if not n_splits:
            break
        n_grown += n_rows
        if n_grown <= COMPILE_MAX_NODES:
            grown.extend(level.select("model_id", "node_id", "is_leaf", "feature", "threshold").collect())
            rows = base.withColumn("node_id", _route_expression(grown, depth + 1)) \
                .where(F.col("node_id") > 0)
        else:
            rows = route(rows, level, bound)
    if persist:
        base.unpersist()
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out


# Node tables up to this size are compiled into expressions for scoring.
COMPILE_MAX_NODES = 4096


def predict(nodes: DataFrame, points: DataFrame, max_depth: int,
            model_ids: list[int] | None = None) -> DataFrame:
    """(model_id, row_id, pred) for every model and row.

    Small node tables (the usual case: models x 2^(depth+1)) are compiled
    into one CASE WHEN per model and evaluated in a projection; larger ones
    are routed level by level with broadcast joins."""
    bound = (len(model_ids) if model_ids else 1) * (2 ** (max_depth + 1))
    n_nodes = nodes.count() if model_ids is None or bound > COMPILE_MAX_NODES else bound
    if n_nodes > COMPILE_MAX_NODES:
        return predict_joined(nodes, points, max_depth, model_ids)
    exprs = compile_trees(nodes, max_nodes=COMPILE_MAX_NODES)
    ids = sorted(exprs) if model_ids is None else list(model_ids)
    arr = F.array(*[F.struct(F.lit(m).alias("model_id"),
                             (exprs[m] if m in exprs else F.lit(None).cast("bigint")).alias("pred"))
                    for m in ids])
    return points.select("row_id", F.explode(arr).alias("p")).select(
        F.col("p.model_id").alias("model_id"), "row_id", F.col("p.pred").alias("pred"))


def predict_vote(nodes: DataFrame, points: DataFrame) -> DataFrame:
    """V6 scoring without a shuffle: every model's label and the majority
    are computed inside each row: (row_id, pred, votes). Node tables too
    large to compile are routed by joins and voted on by an aggregation."""
    n_nodes, depth = nodes.agg(F.count("*"), F.max("depth")).first()
    if n_nodes > COMPILE_MAX_NODES:
        from copse.operators.vote import majority
        return majority(predict_joined(nodes, points, depth))
    exprs = compile_trees(nodes, max_nodes=COMPILE_MAX_NODES)
    preds = F.array(*[exprs[m] for m in sorted(exprs)])
    out = points.select("row_id", preds.alias("preds")).withColumn("pred", vote_expression(F.col("preds")))
    return out.select("row_id", "pred",
                      F.size(F.filter("preds", lambda p: p == F.col("pred"))).cast("bigint").alias("votes"))


def predict_joined(nodes: DataFrame, points: DataFrame, max_depth: int,
                   model_ids: list[int] | None = None) -> DataFrame:
    """Route every (model, row) from the root to its leaf, one broadcast
    join per level (no shuffle); returns (model_id, row_id, pred).

    ``points`` carries (row_id, features) encoded like the training bag."""
    if model_ids is None:
        model_ids = [r[0] for r in nodes.select("model_id").distinct().orderBy("model_id").collect()]
    n_models = len(model_ids)
    cur = points.select("row_id", "features").withColumn(
        "model_id", F.explode(F.array(*[F.lit(m) for m in model_ids]))) \
        .withColumn("node_id", F.lit(1).cast("bigint")) \
        .withColumn("pred", F.lit(None).cast("bigint"))
    for depth in range(max_depth + 1):
        lvl = nodes.where(F.col("depth") == depth).select(
            "model_id", "node_id", "is_leaf", F.col("feature").alias("f"),
            F.col("threshold").alias("t"), F.col("prediction").alias("p"))
        lvl = bounded_broadcast(lvl, max(1, n_models) * (2 ** depth))
        go_left = F.element_at("features", F.col("f") + 1) <= F.col("t")
        cur = cur.join(lvl, ["model_id", "node_id"], "left").select(
            "row_id", "features", "model_id",
            F.when(F.col("pred").isNull() & ~F.col("is_leaf"),
                   F.col("node_id") * 2 + F.when(go_left, 0).otherwise(1))
            .otherwise(F.col("node_id")).alias("node_id"),
            F.coalesce(F.col("pred"), F.when(F.col("is_leaf"), F.col("p"))).alias("pred"))
    return cur.select("model_id", "row_id", "pred")


def compile_trees(nodes: DataFrame, features: str = "features",
                  max_nodes: int = 1 << 16) -> dict[int, "F.Column"]:
    """T9 as expressions: one nested CASE WHEN per model, built from the
    node table (models x 2^(depth+1) rows at most, checked against
    ``max_nodes``). Scoring is then a projection: no join, no shuffle, and
    it works unchanged on a streaming frame."""
    rows = nodes.select("model_id", "node_id", "is_leaf", "feature", "threshold", "prediction") \
        .limit(max_nodes + 1).collect()
    if len(rows) > max_nodes:
        raise ValueError("tree table too large to compile; use predict()")
    by_model: dict[int, dict[int, object]] = {}
    for r in rows:
        by_model.setdefault(r["model_id"], {})[r["node_id"]] = r

    def build(tree, node_id):
        r = tree[node_id]
        if r["is_leaf"]:
            return F.lit(r["prediction"]).cast("bigint")
        x = F.element_at(F.col(features), F.lit(r["feature"] + 1))
        return F.when(x <= F.lit(r["threshold"]), build(tree, 2 * node_id)) \
            .otherwise(build(tree, 2 * node_id + 1))

    return {m: build(tree, 1) for m, tree in sorted(by_model.items())}


def vote_expression(preds: "F.Column") -> "F.Column":
    """Majority over an array of labels in one row (ties: smallest label)."""
    counted = F.transform(F.array_distinct(F.filter(preds, lambda p: p.isNotNull())),
                          lambda lab: F.struct(F.size(F.filter(preds, lambda p: p == lab)).alias("n"),
                                               (-lab).alias("neg"), lab.alias("label")))
    return F.array_max(counted).getField("label")


def fit_bags(points: DataFrame, n_models: int, fraction: float, seed: int, max_depth: int,
             method: str = "poisson", max_candidates: int = MAX_CANDIDATES) -> DataFrame:
    """Bag and grow in one call, caching the points once with the weights of
    each row (one integer a model) instead of the exploded bag (models x
    the input): every level spreads the cached points over the bags again,
    and no draw is made twice. Keep-or-replace bags need a join to draw, so
    that method caches the bag itself."""
    from copse.operators import bagging

    cached = points.select("row_id", "label", "features")
    by_row = method != "keep_or_replace"
    if by_row:
        cached = bagging.drawn(cached, n_models, fraction, seed, method)
    cached = cached.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        bag = bagging.spread_bags(cached) if by_row else bagging.bags(cached, n_models, fraction, seed, method)
        return fit(bag, max_depth, seed, max_candidates, persist=(method == "keep_or_replace"))
    finally:
        cached.unpersist()

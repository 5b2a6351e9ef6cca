"""Categorical naive Bayes for many bags at once.

The fitted model is three count tables keyed by ``model_id``:

* classes: (model_id, label, n)              n = bag weight of the class
* values:  (model_id, label, feature, value, n)
* cardinality: (model_id, feature, k)        distinct values in the bag

All are grouped aggregations with map-side partial aggregation, so the
shuffle carries at most models x classes x features x values rows per
task, however many rows the bag has.

Scores. With prior P(c) = n_c / n and a row's features v_f:

* ``laplace`` (default, N5): ln P(c) + sum_f ln((n_cfv + a) / (n_c + a k_f))
* ``reference`` (N4): ln P(c) + sum_f (n_cfv / n_c if seen else s); the
  raw-probability sum with a flat score ``s`` for unseen values, kept as
  an explicit option.

Both split into a per-class constant plus a sum over the (row, feature)
pairs whose value was seen with the class:

  laplace:   sum_f ln(a / (n_c + a k_f))  +  sum_seen ln(1 + n_cfv / a)
  reference: F * s                        +  sum_seen (n_cfv / n_c - s)

so scoring joins the exploded test rows only to the *seen* value counts
(a bounded table, broadcast behind a size check, one gain array over all
(model, class) slots per value) and never materializes rows x classes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from copse.functions.argmax import argmax_label
from copse.plans.broadcast import fits_broadcast
from copse.plans.lineage import cut_lineage


def fit(bagged: DataFrame, materialize: bool = True) -> dict[str, DataFrame]:
    """N1-N3 counts from (model_id, w, label, features).

    The count tables are the fitted model: they are written once to the
    checkpoint folder, so scoring (which reads them several times) never
    re-runs the aggregation over the bag."""
    classes = bagged.groupBy("model_id", "label").agg(F.sum("w").cast("bigint").alias("n"))
    values = bagged.select("model_id", "label", "w", F.posexplode("features").alias("feature", "value")) \
        .groupBy("model_id", "label", "feature", "value").agg(F.sum("w").cast("bigint").alias("n")) \
        .withColumn("feature", F.col("feature").cast("int"))
    card = values.select("model_id", "feature", "value").distinct() \
        .groupBy("model_id", "feature").agg(F.count("*").cast("bigint").alias("k"))
    model = {"classes": classes, "values": values, "cardinality": card}
    if materialize:
        model["values"] = cut_lineage(values)
        model["classes"] = cut_lineage(classes)
        model["cardinality"] = cut_lineage(
            model["values"].select("model_id", "feature", "value").distinct()
            .groupBy("model_id", "feature").agg(F.count("*").cast("bigint").alias("k")))
        # Row count of the written value table: the bound for broadcasting
        # the per-value gain table at scoring time.
        model["values_rows"] = model["values"].count()
    return model


def priors(model: dict[str, DataFrame]) -> DataFrame:
    """(model_id, label, n, prior)."""
    c = model["classes"]
    tot = c.groupBy("model_id").agg(F.sum("n").alias("total"))
    return c.join(tot, "model_id").select(
        "model_id", "label", "n", (F.col("n") / F.col("total")).alias("prior"))


def conditionals(model: dict[str, DataFrame]) -> DataFrame:
    """(model_id, label, feature, value, n, p) with p = n / n_class."""
    c = model["classes"].withColumnRenamed("n", "n_class")
    return model["values"].join(c, ["model_id", "label"]).select(
        "model_id", "label", "feature", "value", "n",
        (F.col("n") / F.col("n_class")).alias("p"))


def _slots(model: dict) -> list[tuple[int, int]]:
    """(model_id, label) of every class of every model, in a fixed order.
    Bounded by models x classes (the model, not the data)."""
    return [(m, c) for m, c, _ in _class_rows(model)]


def _class_rows(model: dict) -> list[tuple[int, int, int]]:
    rows = model["classes"].select("model_id", "label", "n").orderBy("model_id", "label").collect()
    if not rows:
        raise ValueError("model has no classes")
    return [(int(r[0]), int(r[1]), int(r[2])) for r in rows]


def class_constants(model: dict, n_features: int, kind: str, alpha: float,
                    smoothing: float) -> dict[tuple[int, int], float]:
    """The per-(model, class) part of the score, from the two small model
    tables (models x classes and models x features rows):
    laplace: ln P(c) + sum_f ln(a / (n_c + a k_f)); reference: ln P(c) + F s."""
    classes = _class_rows(model)
    totals: dict[int, int] = {}
    for m, _, n in classes:
        totals[m] = totals.get(m, 0) + n
    card: dict[int, list[int]] = {}
    if kind == "laplace":
        for r in model["cardinality"].select("model_id", "k").collect():
            card.setdefault(int(r[0]), []).append(int(r[1]))
    out = {}
    for m, c, n in classes:
        base = math.log(n / totals[m])
        if kind == "reference":
            base += n_features * smoothing
        else:
            ks = card.get(m, [])
            base += sum(math.log(alpha / (n + alpha * k)) for k in ks)
            base += (n_features - len(ks)) * math.log(alpha / n)
        out[(m, c)] = base
    return out


#: Up to this many features are looked up by joins of the row, one by one.
ROW_LOCAL_FEATURES = 32


def _slot_keys(slots: list[tuple[int, int]]):
    """The (model, label) of every slot; labels are any BIGINT."""
    return F.array(*[F.struct(F.lit(m).cast("int").alias("model_id"), F.lit(c).cast("bigint").alias("label"))
                     for m, c in slots])


def _packed_scores(per_value: DataFrame, points: DataFrame, base: list[float], n_features: int) -> DataFrame:
    """(row_id, scores): each feature's values, sorted, and their gains travel
    to the tasks (the caller has measured them); a batch of rows looks up one
    feature after the other by binary search. No join and no shuffle."""
    table: dict[int, tuple[list[float], list[list[float]]]] = {}
    for feature, value, gains in per_value.where(F.col("value").isNotNull()).select("feature", "value", "g").collect():
        of = table.setdefault(feature, ([], []))
        of[0].append(value)
        of[1].append(gains)
    packed = {}
    for feature, (values, gains) in table.items():
        x = np.array(values, np.float64)
        order = np.argsort(x, kind="stable")
        packed[feature] = x[order], np.array(gains, np.float64)[order]
    shared = points.sparkSession.sparkContext.broadcast(packed)
    thin = points.select("row_id", F.col("features").cast("array<double>").alias("features"))
    schema = T.StructType([thin.schema["row_id"], T.StructField("scores", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for b in batches:
            lists = b.column(1)
            flat = lists.flatten()
            value = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
            null = flat.is_null().to_numpy(zero_copy_only=False)
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            start = np.cumsum(size) - size
            total = np.tile(np.array(base), (b.num_rows, 1))
            for j in range(n_features):
                if j not in shared.value:
                    continue
                known, gains = shared.value[j]
                row = np.flatnonzero(size > j)
                x = value[start[row] + j]
                at = np.minimum(np.searchsorted(known, x), len(known) - 1)
                hit = ((known[at] == x) | (np.isnan(known[at]) & np.isnan(x))) & ~null[start[row] + j]
                total[row[hit]] += gains[at[hit]]
            offsets = np.arange(b.num_rows + 1, dtype=np.int32) * len(base)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(total.ravel()))], ["row_id", "scores"])

    return thin.mapInArrow(run, schema)


def score_arrays(model: dict[str, DataFrame], points: DataFrame, n_features: int,
                 kind: str = "laplace", alpha: float = 1.0, smoothing: float = 1.0):
    """Per row, the scores of every (model, class) slot as one array:
    returns ``(frame(row_id, scores), slots)``.

    Each seen (feature, value) of the model carries one array of gains over
    all slots (zero where the class never saw the value); a row adds the
    arrays of its features' values to the per-slot constants. While the gain
    table is measured to be small, features are looked up inside the row, by
    broadcast joins or, where there are many, in packed arrays: no explode
    and no shuffle. Beyond that the rows
    are exploded, joined by shuffle and summed up again. Equal row keys stay
    apart, and a row without features gets the constants, either way."""
    if kind not in ("laplace", "reference"):
        raise ValueError("kind must be 'laplace' or 'reference'")
    if kind == "laplace" and alpha <= 0:
        raise ValueError("alpha must be > 0")
    base = class_constants(model, n_features, kind, alpha, smoothing)
    slots = sorted(base)
    n_slots = len(slots)
    keys = _slot_keys(slots)
    vals = model["values"].join(model["classes"].withColumnRenamed("n", "n_c"), ["model_id", "label"])
    if kind == "laplace":
        gain = F.log1p(F.col("n") / F.lit(alpha))
    else:
        gain = F.col("n") / F.col("n_c") - F.lit(smoothing)
    slot = (F.array_position(keys, F.struct(F.col("model_id").cast("int").alias("model_id"),
                                            F.col("label").cast("bigint").alias("label"))) - 1).cast("int")
    per_value = vals.select("feature", "value", slot.alias("slot"), gain.alias("gain")) \
        .groupBy("feature", "value").agg(
            F.map_from_entries(F.collect_list(F.struct("slot", "gain"))).alias("m")) \
        .select("feature", "value", F.transform(
            F.sequence(F.lit(0), F.lit(n_slots - 1)),
            lambda i: F.coalesce(F.element_at("m", i), F.lit(0.0))).alias("g"))
    per_value = cut_lineage(per_value)
    small = fits_broadcast(per_value)
    if small and n_features > ROW_LOCAL_FEATURES:
        return _packed_scores(per_value, points, [base[sl] for sl in slots], n_features), slots
    if small:
        out = points.select("row_id", "features")
        for j in range(n_features):
            gains = per_value.where(F.col("feature") == j).select(F.col("value").alias(f"v{j}"), F.col("g").alias(f"g{j}"))
            out = out.join(F.broadcast(gains), F.get("features", F.lit(j)) == F.col(f"v{j}"), "left").drop(f"v{j}")
        total = F.array(*[sum((F.coalesce(F.get(f"g{j}", F.lit(i)), F.lit(0.0)) for j in range(n_features)), F.lit(base[sl]))
                          for i, sl in enumerate(slots)])
        return out.select("row_id", total.alias("scores")), slots
    # A row of its own for each input row: equal keys stay apart and a row
    # without features keeps the constants.
    exploded = points.withColumn("__row", F.monotonically_increasing_id()) \
        .select("__row", "row_id", F.posexplode_outer("features").alias("feature", "value")) \
        .withColumn("feature", F.col("feature").cast("int"))
    looked = exploded.join(per_value, ["feature", "value"], "left")
    per_row = looked.groupBy("__row").agg(
        F.first("row_id").alias("row_id"), *[F.sum(F.col("g").getItem(i)).alias(f"s{i}") for i in range(n_slots)])
    total = F.array(*[F.lit(base[sl]) + F.coalesce(F.col(f"s{i}"), F.lit(0.0))
                      for i, sl in enumerate(slots)])
    return per_row.select("row_id", total.alias("scores")), slots


def scores(model: dict[str, DataFrame], points: DataFrame, n_features: int,
           kind: str = "laplace", alpha: float = 1.0, smoothing: float = 1.0) -> DataFrame:
    """(model_id, row_id, label, score) for every row and class."""
    arrays, slots = score_arrays(model, points, n_features, kind, alpha, smoothing)
    keys = _slot_keys(slots)
    return arrays.select("row_id", F.posexplode("scores").alias("i", "score")) \
        .select(F.element_at(keys, F.col("i") + 1).alias("k"), "row_id", "score") \
        .select(F.col("k.model_id").alias("model_id"), "row_id",
                F.col("k.label").cast("bigint").alias("label"), "score")


def decide_arrays(arrays: DataFrame, slots: list[tuple[int, int]]) -> DataFrame:
    """N6 inside each row: per model the label with the highest score
    (rounded to 9 places), smallest label on ties; (model_id, row_id, pred)."""
    per_model: dict[int, list[int]] = {}
    for i, (m, _) in enumerate(slots):
        per_model.setdefault(m, []).append(i)
    picks = []
    for m, idx in sorted(per_model.items()):
        cands = F.array(*[F.struct(F.round(F.col("scores").getItem(i), 9).alias("s"),
                                   F.lit(-slots[i][1]).cast("bigint").alias("neg"),
                                   F.lit(slots[i][1]).cast("bigint").alias("label")) for i in idx])
        picks.append(F.struct(F.lit(m).alias("model_id"),
                              F.array_max(cands).getField("label").cast("bigint").alias("pred")))
    return arrays.select("row_id", F.explode(F.array(*picks)).alias("p")).select(
        F.col("p.model_id").alias("model_id"), "row_id", F.col("p.pred").alias("pred"))


def decide(score_rows: DataFrame) -> DataFrame:
    """N6 on long score rows: per (model, row) the label with the highest
    score rounded to 9 places, smallest label on ties."""
    return score_rows.groupBy("model_id", "row_id").agg(
        argmax_label("label", F.round("score", 9)).alias("pred"))


def predict(model: dict[str, DataFrame], points: DataFrame, n_features: int,
            kind: str = "laplace", alpha: float = 1.0, smoothing: float = 1.0) -> DataFrame:
    arrays, slots = score_arrays(model, points, n_features, kind, alpha, smoothing)
    return decide_arrays(arrays, slots)


def log_laplace_reference(n_cfv: int, n_c: int, k: int, alpha: float) -> float:
    """Plain-Python single-term value, used by tests."""
    return math.log((n_cfv + alpha) / (n_c + alpha * k))


def compile_scores(model: dict, n_features: int, kind: str = "laplace", alpha: float = 1.0,
                   smoothing: float = 1.0, features: str = "features",
                   max_entries: int = 100_000):
    """Scores as a row-local expression: ``(scores array column, slots)``.

    Each feature position gets a literal map from value to its gain array
    over all (model, class) slots; a row's scores are the per-slot
    constants plus the gains of its values. No join and no aggregation, so
    it runs on a stream. The model's value table (features x values x
    classes rows) must be under ``max_entries``; larger models use
    :func:`score_arrays`."""
    base = class_constants(model, n_features, kind, alpha, smoothing)
    slots = sorted(base)
    index = {sl: i for i, sl in enumerate(slots)}
    n_c = {(m, c): n for m, c, n in _class_rows(model)}
    rows = model["values"].select("model_id", "label", "feature", "value", "n") \
        .limit(max_entries + 1).collect()
    if len(rows) > max_entries:
        raise ValueError("naive Bayes model too large to compile; use score_arrays()")
    gains: dict[int, dict[float, list[float]]] = {}
    for r in rows:
        sl = (int(r["model_id"]), int(r["label"]))
        n = float(r["n"])
        g = math.log1p(n / alpha) if kind == "laplace" else n / n_c[sl] - smoothing
        gains.setdefault(int(r["feature"]), {}).setdefault(float(r["value"]), [0.0] * len(slots))[index[sl]] = g
    total = F.array(*[F.lit(base[sl]) for sl in slots])
    zeros = F.array(*[F.lit(0.0) for _ in slots])
    for f in range(n_features):
        table = gains.get(f)
        if not table:
            continue
        lookup = F.create_map(*[x for v, arr in sorted(table.items())
                                for x in (F.lit(v), F.array(*[F.lit(a) for a in arr]))])
        hit = F.coalesce(F.element_at(lookup, F.element_at(F.col(features), F.lit(f + 1))), zeros)
        total = F.zip_with(total, hit, lambda a, b: a + b)
    return total, slots


def decide_expression(scores, slots: list[tuple[int, int]]):
    """Per-model labels inside one row, ordered by model id: highest score
    rounded to 9 places, smallest label on ties."""
    per_model: dict[int, list[int]] = {}
    for i, (m, _) in enumerate(slots):
        per_model.setdefault(m, []).append(i)
    picks = []
    for m, idx in sorted(per_model.items()):
        cands = F.array(*[F.struct(F.round(scores.getItem(i), 9).alias("s"),
                                   F.lit(-slots[i][1]).cast("bigint").alias("neg"),
                                   F.lit(slots[i][1]).cast("bigint").alias("label")) for i in idx])
        picks.append(F.array_max(cands).getField("label").cast("bigint"))
    return F.array(*picks), sorted(per_model)

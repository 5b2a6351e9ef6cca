"""Registered queries: each binds operators to the driver's tables and has a
DuckDB twin in :func:`oracle_sql` with the same column names.

Every query reads whole tables; the only row limits belong to the
fixed-size sampler (``bag_fixed`` and the query sample of
``knn_selftest_sampled``), where the limit is the sampling operator.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copse.operators import bagging, encode, ensemble, profile
from copse.plans import oracle as O
from copse.sources import tables
from copse.plans.lineage import step_folder
from copse.sources.profile_io import read_profile, write_profile
from copse.sources.report import write_predictions
from copse.sources.text import format_ranked, parse_ranked, read_lines
from copse.operators import tree as T
from copse.operators import evaluate as E
from copse.operators import vote as V
from copse.operators import bayes as NB
from copse.functions.vectors import distance_sql
from copse.operators import knn as KNN

# Fixed parameters of the registered queries (the reference's defaults
# are 4 models, fraction 0.7, k 5, smoothing 1.0, depth 5).
SEED = 42
N_MODELS = 4
FRACTION = 0.7
K = 5
ORACLE_DEPTH = 2
SMOOTHING = 1.0
ALPHA = 1.0
FIXED_N = 100
REPLACE_BUCKETS = 16
KNN_CELL = 0.5

R5 = 5
R6 = 6
R9 = 9


def _orders(spark, sf):
    return tables.order_points(spark, sf)


# ----------------------------------------------------------------- sources
def q_parse_ranked_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = format_ranked(_orders(spark, sf))
    pts = parse_ranked(lines, key="row_id", n_features=len(tables.ORDER_FEATURES), mode="fail")
    return pts.select("row_id", "label", "qid", F.size("features").alias("n_features"),
                      *[F.col("features").getItem(i).alias(f"f{i}") for i in range(6)])


def sql_parse_ranked_lines() -> str:
    return f"""
WITH pts AS ({O.ORDER_POINTS})
SELECT row_id, label, qid, len(features)::INTEGER AS n_features,
       {", ".join(f"features[{i + 1}] AS f{i}" for i in range(6))}
FROM pts"""


# --------------------------------------------------------------- profiling
def _profile_out(df: DataFrame) -> DataFrame:
    return df.select("feature", "is_categorical", "is_ordinal", "num_distinct", "min", "max",
                     F.round("mean", R5).alias("mean"), F.round("std", R5).alias("std"),
                     "n_buckets")


def q_feature_profile(spark, sf):
    return _profile_out(profile.profile(_orders(spark, sf)))


def sql_feature_profile():
    return O.profile_sql(O.ORDER_POINTS)


def q_feature_kind(spark, sf):
    return _profile_out(profile.profile(tables.lineitem_points(spark, sf)))


def sql_feature_kind():
    return O.profile_sql(O.LINEITEM_POINTS)


def _encoded_orders(spark, sf):
    pts = _orders(spark, sf)
    return encode.encode(pts, profile.profile(pts))


def q_encode_bins(spark, sf):
    enc = _encoded_orders(spark, sf)
    return enc.select("row_id", "label",
                      *[F.col("features").getItem(i).alias(f"e{i}") for i in range(6)])


def sql_encode_bins():
    return f"""
WITH {O.encoded_points_ctes(O.ORDER_POINTS)}
SELECT row_id, label, {", ".join(f"features[{i + 1}] AS e{i}" for i in range(6))}
FROM enc"""


def _poisson_encoded_bag(spark, sf):
    return bagging.poisson(_encoded_orders(spark, sf), N_MODELS, FRACTION, SEED)


def q_bag_values(spark, sf):
    vt = encode.value_table(_poisson_encoded_bag(spark, sf))
    return vt.groupBy("model_id", "feature").agg(
        F.first("n_values").cast("bigint").alias("n_values"),
        F.min("value").alias("min_value"), F.max("value").alias("max_value"),
        F.sum("pos").cast("bigint").alias("pos_sum"))


def sql_bag_values():
    return f"""
WITH {O.encoded_points_ctes(O.ORDER_POINTS)},
{O.poisson_bag_cte('enc', SEED, N_MODELS, FRACTION)},
vals AS (SELECT DISTINCT b.model_id, x.feature, x.value
         FROM bag b, LATERAL (SELECT generate_subscripts(b.features, 1) - 1 AS feature,
                                     unnest(b.features) AS value) x)
SELECT model_id, feature::INTEGER AS feature, count(*)::BIGINT AS n_values,
       min(value) AS min_value, max(value) AS max_value,
       (count(*) * (count(*) - 1) // 2)::BIGINT AS pos_sum
FROM vals GROUP BY model_id, feature"""


# ----------------------------------------------------------------- bagging
def q_bag_bernoulli(spark, sf):
    return bagging.bernoulli(_orders(spark, sf), N_MODELS, FRACTION, SEED) \
        .select("model_id", "row_id", "label")


def sql_bag_bernoulli():
    return f"""
WITH pts AS ({O.ORDER_POINTS}),
{O.bernoulli_bag_cte('pts', SEED, N_MODELS, FRACTION)}
SELECT model_id, row_id, label FROM bag"""


def q_bag_poisson(spark, sf):
    return bagging.poisson(_orders(spark, sf), N_MODELS, FRACTION, SEED) \
        .select("model_id", "row_id", "w")


def sql_bag_poisson():
    return f"""
WITH pts AS ({O.ORDER_POINTS}),
{O.poisson_bag_cte('pts', SEED, N_MODELS, FRACTION)}
SELECT model_id, row_id, w::INTEGER AS w FROM bag"""


def q_bag_replace(spark, sf):
    return bagging.keep_or_replace_slots(_orders(spark, sf), N_MODELS, FRACTION, SEED,
                                         n_buckets=REPLACE_BUCKETS)


def sql_bag_replace():
    uk = O.uniform_sql(SEED, "m.model_id", "'k' || p.row_id::VARCHAR")
    up = O.uniform_sql(SEED, "m.model_id", "'p' || p.row_id::VARCHAR")
    return f"""
WITH pts AS ({O.ORDER_POINTS}),
ords AS (SELECT row_id, row_number() OVER (ORDER BY {O.hash52_sql('row_id::VARCHAR')}, row_id) - 1 AS ordinal
         FROM pts),
n AS (SELECT count(*) AS n FROM pts),
drawn AS (
  SELECT m.model_id, p.row_id AS slot_id,
         CASE WHEN {uk} <= CAST('{FRACTION!r}' AS DOUBLE) THEN NULL
              ELSE floor({up} * (SELECT n FROM n))::BIGINT END AS pick
  FROM pts p, (SELECT range::INTEGER AS model_id FROM range(0, {N_MODELS})) m)
SELECT d.model_id, d.slot_id, coalesce(o.row_id, d.slot_id) AS row_id
FROM drawn d LEFT JOIN ords o ON o.ordinal = d.pick"""


def q_bag_fixed(spark, sf):
    return bagging.fixed_sample(_orders(spark, sf), FIXED_N, SEED).select("row_id", "label")


def sql_bag_fixed():
    u = O.uniform_sql(SEED, "0", "row_id")
    return f"""
WITH pts AS ({O.ORDER_POINTS})
SELECT row_id, label FROM pts ORDER BY {u}, row_id LIMIT {FIXED_N}"""


# -------------------------------------------------------------------- gini
def q_gini_by_group(spark, sf):
    li = tables.lineitem_points(spark, sf)
    counts = li.groupBy("group_key", "label").agg(F.count("*").alias("n"))
    g = T.gini(counts, ["group_key"])
    return g.select(F.col("group_key").alias("l_returnflag"), "n", F.round("gini", R9).alias("gini"))


def sql_gini_by_group():
    return f"""
WITH pts AS ({O.LINEITEM_POINTS}),
c AS (SELECT group_key, label, count(*) AS n FROM pts GROUP BY group_key, label),
t AS (SELECT group_key, sum(n) AS total FROM c GROUP BY group_key)
SELECT c.group_key AS l_returnflag, t.total::BIGINT AS n,
       round(1 - sum((c.n::DOUBLE / t.total) * (c.n::DOUBLE / t.total)), 9) AS gini
FROM c JOIN t USING (group_key) GROUP BY c.group_key, t.total"""


# -------------------------------------------------------------------- tree
def _tree_inputs(spark, sf):
    enc = _encoded_orders(spark, sf)
    bag = bagging.poisson(enc, N_MODELS, FRACTION, SEED)
    return enc, bag


def _root_level(spark, sf):
    from copse.plans.lineage import cut_lineage
    _, bag = _tree_inputs(spark, sf)
    base = bag.select("model_id", "w", "label", "features")
    vt = cut_lineage(encode.value_table(base))
    rows = base.withColumn("node_id", F.lit(1).cast("bigint"))
    by_class, summary = T.node_stats(rows)
    return rows, by_class, summary, vt


def q_thinned_candidates(spark, sf):
    _, _, summary, vt = _root_level(spark, sf)
    c = T.candidates(vt, summary.where(F.col("n_classes") > 1), SEED)
    return c.select("model_id", "node_id", "feature", "threshold")


def sql_thinned_candidates():
    return f"""
WITH {O.encoded_points_ctes(O.ORDER_POINTS)},
{O.poisson_bag_cte('enc', SEED, N_MODELS, FRACTION)},
{O.tree_ctes(1, SEED)}
SELECT model_id, node_id, feature::INTEGER AS feature, threshold FROM cand0"""


def q_split_scores(spark, sf):
    rows, by_class, _, vt = _root_level(spark, sf)
    sc = T.split_scores(rows, by_class, vt, SEED)
    return sc.select("model_id", "node_id", F.col("feature").cast("int").alias("feature"),
                     "threshold", "n_left", "n_right", F.round("score", R9).alias("score"))


def sql_split_scores():
    return f"""
WITH {O.encoded_points_ctes(O.ORDER_POINTS)},
{O.poisson_bag_cte('enc', SEED, N_MODELS, FRACTION)},
{O.tree_ctes(1, SEED)}
SELECT model_id, node_id, feature::INTEGER AS feature, threshold, n_left, n_right,
       round(score, 9) AS score FROM scr0"""


def q_best_split(spark, sf):
    rows, by_class, _, vt = _root_level(spark, sf)
    b = T.best_splits(T.split_scores(rows, by_class, vt, SEED))
    return b.select("model_id", "node_id", F.col("feature").cast("int").alias("feature"),
                    "threshold", "n_left", "n_right", F.round("score", R9).alias("score"))


def sql_best_split():
    return f"""
WITH {O.encoded_points_ctes(O.ORDER_POINTS)},
{O.poisson_bag_cte('enc', SEED, N_MODELS, FRACTION)},
{O.tree_ctes(1, SEED)}
SELECT model_id, node_id, feature::INTEGER AS feature, threshold, n_left, n_right,
       round(score, 9) AS score FROM bst0"""


def _nodes_out(nodes):
    return nodes.select("model_id", "node_id", "depth", "feature", "threshold", "is_leaf",
                        "prediction", "n", F.round("impurity", R9).alias("impurity"))


def q_tree_depth2_nodes(spark, sf):
    enc = _encoded_orders(spark, sf)
    return _nodes_out(T.fit_bags(enc, N_MODELS, FRACTION, SEED, ORACLE_DEPTH))


def _sql_nodes_select():
    return ("SELECT model_id, node_id, depth::INTEGER AS depth, feature, threshold, is_leaf, "
            "prediction, n, round(impurity, 9) AS impurity FROM nodes")


def sql_tree_depth2_nodes():
    return f"""
WITH {O.encoded_points_ctes(O.ORDER_POINTS)},
{O.poisson_bag_cte('enc', SEED, N_MODELS, FRACTION)},
{O.tree_ctes(ORACLE_DEPTH, SEED)}
{_sql_nodes_select()}"""


def _tree_predictions(spark, sf, depth=ORACLE_DEPTH):
    enc = _encoded_orders(spark, sf)
    nodes = T.fit_bags(enc, N_MODELS, FRACTION, SEED, depth)
    return T.predict(nodes, enc, depth, list(range(N_MODELS))), enc


def q_tree_depth2_predict(spark, sf):
    preds, _ = _tree_predictions(spark, sf)
    return preds


def _sql_tree_predict_ctes(depth=ORACLE_DEPTH):
    return f"""{O.encoded_points_ctes(O.ORDER_POINTS)},
{O.poisson_bag_cte('enc', SEED, N_MODELS, FRACTION)},
{O.tree_ctes(depth, SEED)},
{O.tree_predict_ctes(depth, 'enc', N_MODELS)}"""


def sql_tree_depth2_predict():
    return f"""
WITH {_sql_tree_predict_ctes()}
SELECT model_id, row_id, pred FROM tp"""


def q_vote_majority(spark, sf):
    preds, _ = _tree_predictions(spark, sf)
    return V.majority(preds)


def sql_vote_majority():
    return f"""
WITH {_sql_tree_predict_ctes()},
{O.majority_cte('tp')}
SELECT row_id, pred, votes FROM mv"""


def _tree_vote(spark, sf, depth):
    enc = _encoded_orders(spark, sf)
    nodes = T.fit_bags(enc, N_MODELS, FRACTION, SEED, depth)
    return T.predict_vote(nodes, enc), enc


def flagship(spark, sf):
    """Tree ensemble (V6): bags -> trees -> in-row vote -> accuracy (one row)."""
    votes, enc = _tree_vote(spark, sf, ORACLE_DEPTH)
    return E.accuracy(E.with_truth(votes, enc))


def q_tree_ensemble_accuracy(spark, sf):
    return flagship(spark, sf)


def sql_tree_ensemble_accuracy():
    return f"""
WITH {_sql_tree_predict_ctes()},
{O.majority_cte('tp')}
SELECT count(*)::BIGINT AS n_total, count_if(mv.pred = e.label)::BIGINT AS n_correct,
       count_if(mv.pred = e.label) * 100.0 / count(*) AS accuracy_pct
FROM mv JOIN enc e ON e.row_id = mv.row_id"""


# ------------------------------------------------------------- naive Bayes
def _nb_inputs(spark, sf):
    enc = _encoded_orders(spark, sf)
    bag = bagging.poisson(enc, N_MODELS, FRACTION, SEED)
    return enc, NB.fit(bag)


def _sql_nb_head():
    return f"""{O.encoded_points_ctes(O.ORDER_POINTS)},
{O.poisson_bag_cte('enc', SEED, N_MODELS, FRACTION)},
{O.nb_model_ctes()}"""


def q_nb_priors(spark, sf):
    _, model = _nb_inputs(spark, sf)
    return NB.priors(model).select("model_id", "label", "n", F.round("prior", R9).alias("prior"))


def sql_nb_priors():
    return f"""
WITH {_sql_nb_head()}
SELECT c.model_id, c.label, c.n::BIGINT AS n, round(c.n::DOUBLE / t.total, 9) AS prior
FROM ncls c JOIN ntot t USING (model_id)"""


def q_nb_conditionals(spark, sf):
    _, model = _nb_inputs(spark, sf)
    return NB.conditionals(model).select("model_id", "label", "feature", "value", "n",
                                         F.round("p", R9).alias("p"))


def sql_nb_conditionals():
    return f"""
WITH {_sql_nb_head()}
SELECT v.model_id, v.label, v.feature::INTEGER AS feature, v.value, v.n::BIGINT AS n,
       round(v.n::DOUBLE / c.n, 9) AS p
FROM nval v JOIN ncls c ON c.model_id = v.model_id AND c.label = v.label"""


def q_nb_score_sum(spark, sf):
    enc, model = _nb_inputs(spark, sf)
    sc = NB.scores(model, enc, len(tables.ORDER_FEATURES), kind="reference", smoothing=SMOOTHING)
    return sc.select("model_id", "row_id", "label", F.round("score", R6).alias("score"))


def sql_nb_score_sum():
    return f"""
WITH {_sql_nb_head()},
{O.nb_score_ctes('enc', 'reference', ALPHA, SMOOTHING)}
SELECT model_id, row_id, label, round(score, 6) AS score FROM nsc"""


def _nb_predictions(spark, sf):
    enc, model = _nb_inputs(spark, sf)
    return NB.predict(model, enc, len(tables.ORDER_FEATURES), kind="laplace", alpha=ALPHA), enc


def q_nb_predict(spark, sf):
    preds, _ = _nb_predictions(spark, sf)
    return preds


def sql_nb_predict():
    return f"""
WITH {_sql_nb_head()},
{O.nb_score_ctes('enc', 'laplace', ALPHA, SMOOTHING)},
{O.nb_decide_cte()}
SELECT model_id, row_id, pred FROM npred"""


def q_nb_documents(spark, sf):
    """Fitted on the labelled documents; every document is scored."""
    docs = tables.document_points(spark, sf)
    bag = bagging.poisson(docs, N_MODELS, FRACTION, SEED)
    every = tables.all_document_points(spark, sf)
    preds = NB.predict(NB.fit(bag), every, len(tables.DOCUMENT_FEATURES), alpha=ALPHA)
    return V.majority(preds)


def sql_nb_documents():
    return f"""
WITH pts AS ({O.DOCUMENT_POINTS}),
every AS ({O.ALL_DOCUMENT_POINTS}),
{O.poisson_bag_cte('pts', SEED, N_MODELS, FRACTION)},
{O.nb_model_ctes()},
{O.nb_score_ctes('every', 'laplace', ALPHA, SMOOTHING)},
{O.nb_decide_cte()},
{O.majority_cte('npred')}
SELECT row_id, pred, votes FROM mv"""


def q_accuracy(spark, sf):
    """V4/V5 on the naive-Bayes ensemble vote over the orders."""
    preds, enc = _nb_predictions(spark, sf)
    return E.accuracy(E.with_truth(V.majority(preds), enc))


def sql_accuracy():
    return f"""
WITH {_sql_nb_head()},
{O.nb_score_ctes('enc', 'laplace', ALPHA, SMOOTHING)},
{O.nb_decide_cte()},
{O.majority_cte('npred')}
SELECT count(*)::BIGINT AS n_total, count_if(mv.pred = e.label)::BIGINT AS n_correct,
       count_if(mv.pred = e.label) * 100.0 / count(*) AS accuracy_pct
FROM mv JOIN enc e ON e.row_id = mv.row_id"""


# ----------------------------------------------------------------- mixture
def q_ensemble_mixed(spark, sf):
    """V1: two trees and two naive Bayes models on the bags of one bagging
    pass; per-row vote over all four models."""
    pts = _orders(spark, sf)
    return ensemble.run(pts, pts, n_trees=2, n_nb=2, fraction=FRACTION, depth=DEFAULT_DEPTH, smoothing=ALPHA, seed=SEED)


def sql_ensemble_mixed():
    half = N_MODELS // 2
    return f"""
WITH {O.encoded_points_ctes(O.ORDER_POINTS)},
{O.poisson_bag_cte('enc', SEED, N_MODELS, FRACTION, name='allbag')},
bag AS (SELECT * FROM allbag WHERE model_id < {half}),
{O.tree_ctes(DEFAULT_DEPTH, SEED)},
{O.tree_predict_ctes(DEFAULT_DEPTH, 'enc', half)},
nbag AS (SELECT * FROM allbag WHERE model_id >= {half}),
{O.nb_model_ctes('nbag')},
{O.nb_score_ctes('enc', 'laplace', ALPHA, SMOOTHING)},
{O.nb_decide_cte()},
allp AS (SELECT model_id, row_id, pred FROM tp UNION ALL SELECT model_id, row_id, pred FROM npred),
{O.majority_cte('allp')}
SELECT row_id, pred, votes FROM mv"""


# --------------------------------------------------------------------- knn
def _emb(spark, sf):
    return tables.embedding_points(spark, sf)


def q_knn_neighbors(spark, sf):
    e = _emb(spark, sf)
    nb = KNN.search(e, e, K, "l2", exclude_self=True)
    return nb.select(F.col("q_id").alias("row_id"), "t_id", "label",
                     F.round("dist", R6).alias("dist"), "slots")


def sql_knn_neighbors():
    return f"""
WITH pts AS ({O.EMBEDDING_POINTS}),
{O.knn_ctes('pts', 'pts', K, 'l2', None, True)}
SELECT q_id AS row_id, t_id, label, round(dist, 6) AS dist, slots::INTEGER AS slots FROM kp_top"""


def _knn_pred_sql(metric):
    return f"""
WITH pts AS ({O.EMBEDDING_POINTS}),
{O.knn_ctes('pts', 'pts', K, metric, None, True)}
SELECT p.row_id, kp.pred FROM pts p LEFT JOIN kp ON kp.row_id = p.row_id"""


def q_knn_l1_predict(spark, sf):
    e = _emb(spark, sf)
    return KNN.predict(e, e, K, "l1", exclude_self=True).select("row_id", "pred")


def sql_knn_l1_predict():
    return _knn_pred_sql("l1")


def q_knn_l2_predict(spark, sf):
    e = _emb(spark, sf)
    return KNN.predict(e, e, K, "l2", exclude_self=True).select("row_id", "pred")


def sql_knn_l2_predict():
    return _knn_pred_sql("l2")


def q_knn_bucketed(spark, sf):
    e = _emb(spark, sf)
    return KNN.bucketed_predict(e, e, K, KNN_CELL, "l1", exclude_self=True).select("row_id", "pred")


def sql_knn_bucketed():
    s = "list_reduce(features, lambda acc, x: acc + x, 0.0::DOUBLE)"
    return f"""
WITH raw AS ({O.EMBEDDING_POINTS}),
pts AS (SELECT *, floor(round({s}, 6) / CAST('{KNN_CELL!r}' AS DOUBLE))::BIGINT AS bucket FROM raw),
{O.knn_ctes('pts', 'pts', K, 'l1', 'bucket', True)}
SELECT p.row_id, kp.pred FROM pts p LEFT JOIN kp ON kp.row_id = p.row_id"""


#: Tables, cell width and vector length of the hashed search.
LSH_TABLES, LSH_WIDTH, LSH_DIM = 6, 4.0, 64


def q_knn_lsh(spark, sf):
    """K6 with several tables: cells of random projections, neighbours probed."""
    e = _emb(spark, sf)
    return KNN.lsh_predict(e, e, K, LSH_TABLES, 1, LSH_WIDTH, LSH_DIM, SEED, "l2", exclude_self=True).select("row_id", "pred")


def sql_knn_lsh():
    return f"""
WITH pts AS ({O.EMBEDDING_POINTS}),
signs AS (SELECT j, list(CASE WHEN {O.uniform_sql(SEED, 'j', 'i')} < 0.5 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END ORDER BY i) AS s
          FROM range({LSH_TABLES}) a(j), range({LSH_DIM}) b(i) GROUP BY j),
cells AS (SELECT row_id, j, floor(round(list_reduce(list_transform(list_zip(features, s), lambda p: p[1] * p[2]),
                 lambda acc, x: acc + x, 0.0::DOUBLE), 6) / {LSH_WIDTH}::DOUBLE)::BIGINT AS cell FROM pts, signs),
met AS (SELECT DISTINCT q.row_id AS q_id, t.row_id AS t_id FROM cells q JOIN cells t
        ON q.j = t.j AND abs(q.cell - t.cell) <= 1 AND q.row_id <> t.row_id),
ranked AS (SELECT q_id, t.label, row_number() OVER (PARTITION BY q_id ORDER BY
             round({distance_sql('l2', 'q.features', 't.features')}, 9), t_id) AS rk
           FROM met JOIN pts q ON q.row_id = q_id JOIN pts t ON t.row_id = t_id),
votes AS (SELECT q_id, label, count(*) AS n FROM ranked WHERE rk <= {K} GROUP BY q_id, label),
won AS (SELECT q_id, label AS pred FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY n DESC, label) AS rn FROM votes)
        WHERE rn = 1)
SELECT row_id, pred FROM pts LEFT JOIN won ON q_id = row_id"""


def q_knn_bagged(spark, sf):
    e = _emb(spark, sf)
    bag = bagging.poisson(e, N_MODELS, FRACTION, SEED)
    preds = KNN.bagged_predict(bag, e, K, "l2", N_MODELS, exclude_self=True)
    return V.majority(preds)


def sql_knn_bagged():
    return f"""
WITH pts AS ({O.EMBEDDING_POINTS}),
{O.poisson_bag_cte('pts', SEED, N_MODELS, FRACTION)},
qm AS (SELECT m.model_id, p.row_id, p.features FROM pts p,
       (SELECT range::INTEGER AS model_id FROM range(0, {N_MODELS})) m),
{O.knn_ctes('bag', 'qm', K, 'l2', 'model_id', True)},
kpm AS (SELECT grp AS model_id, row_id, pred FROM kp),
{O.majority_cte('kpm')}
SELECT row_id, pred, votes FROM mv"""


def q_knn_selftest(spark, sf):
    """K8: leave-one-out accuracy of exact L2 k-NN over every row."""
    e = _emb(spark, sf)
    preds = KNN.predict(e, e, K, "l2", exclude_self=True)
    return E.accuracy(E.with_truth(preds, e))


def sql_knn_selftest():
    return f"""
WITH pts AS ({O.EMBEDDING_POINTS}),
{O.knn_ctes('pts', 'pts', K, 'l2', None, True)}
SELECT count(*)::BIGINT AS n_total, count_if(kp.pred = p.label)::BIGINT AS n_correct,
       count_if(kp.pred = p.label) * 100.0 / count(*) AS accuracy_pct
FROM pts p LEFT JOIN kp ON kp.row_id = p.row_id"""


# ---------------------------------------------- reference default settings
DEFAULT_DEPTH = 5


def q_tree_depth5_nodes(spark, sf):
    """T7/T8 at the reference's default depth 5 over 4 bags."""
    enc = _encoded_orders(spark, sf)
    return _nodes_out(T.fit_bags(enc, N_MODELS, FRACTION, SEED, DEFAULT_DEPTH))


def sql_tree_depth5_nodes():
    return f"""
WITH {O.encoded_points_ctes(O.ORDER_POINTS)},
{O.poisson_bag_cte('enc', SEED, N_MODELS, FRACTION)},
{O.tree_ctes(DEFAULT_DEPTH, SEED)}
{_sql_nodes_select()}"""


def q_tree_depth5_ensemble(spark, sf):
    """V6 at depth 5: trees -> per-row vote -> accuracy."""
    votes, enc = _tree_vote(spark, sf, DEFAULT_DEPTH)
    return E.accuracy(E.with_truth(votes, enc))


def sql_tree_depth5_ensemble():
    return f"""
WITH {_sql_tree_predict_ctes(DEFAULT_DEPTH)},
{O.majority_cte('tp')}
SELECT count(*)::BIGINT AS n_total, count_if(mv.pred = e.label)::BIGINT AS n_correct,
       count_if(mv.pred = e.label) * 100.0 / count(*) AS accuracy_pct
FROM mv JOIN enc e ON e.row_id = mv.row_id"""


# ------------------------------------------------------ other ensemble mixes
def q_ensemble_mixed_bernoulli(spark, sf):
    """V1 with bags drawn without replacement (B1)."""
    pts = _orders(spark, sf)
    return ensemble.run(pts, pts, n_trees=2, n_nb=2, fraction=FRACTION, depth=DEFAULT_DEPTH, smoothing=ALPHA,
                        seed=SEED, method="bernoulli")


def sql_ensemble_mixed_bernoulli():
    half = N_MODELS // 2
    return f"""
WITH {O.encoded_points_ctes(O.ORDER_POINTS)},
{O.bernoulli_bag_cte('enc', SEED, N_MODELS, FRACTION, name='allbag')},
bag AS (SELECT * FROM allbag WHERE model_id < {half}),
{O.tree_ctes(DEFAULT_DEPTH, SEED)},
{O.tree_predict_ctes(DEFAULT_DEPTH, 'enc', half)},
nbag AS (SELECT * FROM allbag WHERE model_id >= {half}),
{O.nb_model_ctes('nbag')},
{O.nb_score_ctes('enc', 'laplace', ALPHA, SMOOTHING)},
{O.nb_decide_cte()},
allp AS (SELECT model_id, row_id, pred FROM tp UNION ALL SELECT model_id, row_id, pred FROM npred),
{O.majority_cte('allp')}
SELECT row_id, pred, votes FROM mv"""


def q_ensemble_tree_knn(spark, sf):
    """V6 as intended (D16): two trees and two k-NN models on the bags of one
    Poisson pass over the embeddings; per-row vote. Queries are every row
    (k-NN leaves the query itself out)."""
    e = tables.embedding_points(spark, sf)
    return ensemble.run(e, e, n_trees=2, n_knn=2, k=K, fraction=FRACTION, depth=DEFAULT_DEPTH, seed=SEED, exclude_self=True)


def sql_ensemble_tree_knn():
    half = N_MODELS // 2
    return f"""
WITH {O.encoded_points_ctes(O.EMBEDDING_POINTS)},
{O.poisson_bag_cte('enc', SEED, N_MODELS, FRACTION, name='allbag')},
bag AS (SELECT * FROM allbag WHERE model_id < {half}),
{O.tree_ctes(DEFAULT_DEPTH, SEED)},
{O.tree_predict_ctes(DEFAULT_DEPTH, 'enc', half)},
kbag AS (SELECT * FROM allbag WHERE model_id >= {half}),
qm AS (SELECT m.model_id, p.row_id, p.features FROM enc p,
       (SELECT range::INTEGER AS model_id FROM range({half}, {N_MODELS})) m),
{O.knn_ctes('kbag', 'qm', K, 'l2', 'model_id', True)},
allp AS (SELECT model_id, row_id, pred FROM tp
         UNION ALL SELECT grp AS model_id, row_id, pred FROM kp),
{O.majority_cte('allp')}
SELECT row_id, pred, votes FROM mv"""


def q_knn_selftest_sampled(spark, sf):
    """K8 as in the reference's self-test: FIXED_N query rows drawn by the
    fixed-size sampler (B4; the limit is that operator) and searched
    against every row of the table, the query itself excluded."""
    e = _emb(spark, sf)
    q = bagging.fixed_sample(e, FIXED_N, SEED)
    preds = KNN.predict(e, q.select("row_id", "features"), K, "l2", exclude_self=True)
    return E.accuracy(E.with_truth(preds, e))


def sql_knn_selftest_sampled():
    u = O.uniform_sql(SEED, "0", "row_id")
    return f"""
WITH pts AS ({O.EMBEDDING_POINTS}),
qs AS (SELECT * FROM pts ORDER BY {u}, row_id LIMIT {FIXED_N}),
{O.knn_ctes('pts', 'qs', K, 'l2', None, True)}
SELECT count(*)::BIGINT AS n_total, count_if(kp.pred = q.label)::BIGINT AS n_correct,
       count_if(kp.pred = q.label) * 100.0 / count(*) AS accuracy_pct
FROM qs q LEFT JOIN kp ON kp.row_id = q.row_id"""


# Runs with disjoint training and test rows, files and limits.
TEST_SHARE = 0.2


def q_ensemble_holdout(spark, sf):
    """Three trees and two naive Bayes models fitted on four fifths of the
    orders; votes on the remaining fifth."""
    train, test = ensemble.split(_orders(spark, sf), TEST_SHARE)
    return ensemble.run(train, test, n_trees=3, n_nb=2, fraction=FRACTION, depth=DEFAULT_DEPTH, smoothing=ALPHA, seed=SEED)


def _sql_holdout(n_trees: int, n_nb: int) -> str:
    """Votes ``mv`` on the held-out orders; the test rows are binned with the
    training rows' profile."""
    return f"""
every AS ({O.ORDER_POINTS}),
test AS (SELECT * FROM every WHERE {O.hash52_sql('row_id::VARCHAR')}::DOUBLE < {TEST_SHARE!r}::DOUBLE * 4503599627370496.0::DOUBLE),
{O.encoded_points_ctes('SELECT * FROM every WHERE row_id NOT IN (SELECT row_id FROM test)')},
tfv AS (
  SELECT p.row_id, p.label, x.feature,
         CASE WHEN prm.nd <= 1000 THEN x.value
              WHEN prm.width IS NULL THEN 0.0::DOUBLE
              ELSE floor(x.value / prm.width)::DOUBLE END AS value
  FROM test p, LATERAL (SELECT generate_subscripts(p.features, 1) - 1 AS feature,
                               unnest(p.features) AS value) x
  JOIN prm ON prm.feature = x.feature),
tenc AS (SELECT row_id, label, list(value ORDER BY feature) AS features FROM tfv GROUP BY row_id, label),
{O.poisson_bag_cte('enc', SEED, n_trees + n_nb, FRACTION, name='allbag')},
bag AS (SELECT * FROM allbag WHERE model_id < {n_trees}),
{O.tree_ctes(DEFAULT_DEPTH, SEED)},
{O.tree_predict_ctes(DEFAULT_DEPTH, 'tenc', n_trees)},
nbag AS (SELECT * FROM allbag WHERE model_id >= {n_trees}),
{O.nb_model_ctes('nbag')},
{O.nb_score_ctes('tenc', 'laplace', ALPHA, SMOOTHING)},
{O.nb_decide_cte()},
allp AS (SELECT model_id, row_id, pred FROM tp UNION ALL SELECT model_id, row_id, pred FROM npred),
{O.majority_cte('allp')}"""


def sql_ensemble_holdout():
    return f"WITH {_sql_holdout(3, 2)} SELECT row_id, pred, votes FROM mv"


def q_ensemble_odd_counts(spark, sf):
    """One tree and two naive Bayes models; the report row of the run."""
    train, test = ensemble.split(_orders(spark, sf), TEST_SHARE)
    votes = ensemble.run(train, test, n_trees=1, n_nb=2, fraction=FRACTION, depth=DEFAULT_DEPTH, smoothing=ALPHA, seed=SEED)
    return ensemble.report(votes, test, n_trees=1, n_nb=2, fraction=FRACTION, depth=DEFAULT_DEPTH)


def sql_ensemble_odd_counts():
    return f"""WITH {_sql_holdout(1, 2)}
SELECT count(*)::BIGINT AS n_total, count_if(mv.pred = t.label)::BIGINT AS n_correct,
       count_if(mv.pred = t.label) * 100.0 / count(*) AS accuracy_pct,
       1::INTEGER AS n_trees, 2::INTEGER AS n_nb, {FRACTION!r}::DOUBLE AS fraction, {DEFAULT_DEPTH}::INTEGER AS depth
FROM mv JOIN test t USING (row_id)"""


def _step(spark, name: str) -> str:
    return f"{step_folder(spark)}/copse-tables/{name}-{uuid.uuid4().hex}"


def q_text_scan(spark, sf):
    """The orders as ranked lines, written as text and scanned
    again, keyed by content, parsed, counted by label."""
    path = _step(spark, "lines")
    format_ranked(_orders(spark, sf)).select("value").write.text(path)
    pts = parse_ranked(read_lines(spark, path), n_features=len(tables.ORDER_FEATURES), mode="fail")
    per = pts.groupBy("label").agg(
        F.count("*").alias("n"), F.count_distinct("row_id").alias("n_keys"), F.sum("qid").alias("qid_sum"),
        F.round(F.sum(F.get("features", 0)), 2).alias("price_sum"))
    return profile.label_domain(pts).join(per, "label")


def sql_text_scan():
    return f"""WITH pts AS ({O.ORDER_POINTS})
SELECT label, count(*)::BIGINT AS n, count(*)::BIGINT AS n_keys, sum(qid)::BIGINT AS qid_sum,
       round(sum(features[1]), 2) AS price_sum FROM pts GROUP BY label"""


def q_profile_file_bins(spark, sf):
    """Profile written to a file, read back, and used to encode."""
    pts, path = _orders(spark, sf), _step(spark, "profile")
    write_profile(profile.profile(pts), path)
    enc = encode.encode(pts, read_profile(spark, path))
    return enc.select("row_id", "label", *[F.col("features").getItem(i).alias(f"e{i}") for i in range(6)])


def q_predictions_file(spark, sf):
    """Naive Bayes predictions written as Parquet and read back."""
    path = _step(spark, "predictions")
    write_predictions(_nb_predictions(spark, sf)[0], path)
    return spark.read.parquet(path)


def q_dense_vectors(spark, sf):
    """embeddings as ML vectors, made arrays again."""
    e = _emb(spark, sf).withColumn("features", array_to_vector("features"))
    return tables.as_points(e).select(
        "row_id", F.size("features").alias("n"), F.round(F.get("features", 0), R6).alias("first"),
        F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), R6).alias("total"))


def sql_dense_vectors():
    return f"""WITH pts AS ({O.EMBEDDING_POINTS})
SELECT row_id, len(features)::INTEGER AS n, round(features[1], 6) AS first,
       round(list_reduce(features, lambda a, x: a + x, 0.0::DOUBLE), 6) AS total FROM pts"""


def q_limited_rows(spark, sf):
    """the test rows with the smallest keys (the limit is the operator)."""
    return E.limit_rows(_orders(spark, sf), FIXED_N).select("row_id", "label", "qid")


def sql_limited_rows():
    return f"WITH pts AS ({O.ORDER_POINTS}) SELECT row_id, label, qid FROM pts ORDER BY row_id LIMIT {FIXED_N}"


QUERIES: dict[str, tuple[Callable, Callable | None]] = {
    "parse_ranked_lines": (q_parse_ranked_lines, sql_parse_ranked_lines),
    "feature_profile": (q_feature_profile, sql_feature_profile),
    "feature_kind": (q_feature_kind, sql_feature_kind),
    "encode_bins": (q_encode_bins, sql_encode_bins),
    "bag_values": (q_bag_values, sql_bag_values),
    "bag_bernoulli": (q_bag_bernoulli, sql_bag_bernoulli),
    "bag_poisson": (q_bag_poisson, sql_bag_poisson),
    "bag_replace": (q_bag_replace, sql_bag_replace),
    "bag_fixed": (q_bag_fixed, sql_bag_fixed),
    "gini_by_group": (q_gini_by_group, sql_gini_by_group),
    "thinned_candidates": (q_thinned_candidates, sql_thinned_candidates),
    "split_scores": (q_split_scores, sql_split_scores),
    "best_split": (q_best_split, sql_best_split),
    "tree_depth2_nodes": (q_tree_depth2_nodes, sql_tree_depth2_nodes),
    "tree_depth2_predict": (q_tree_depth2_predict, sql_tree_depth2_predict),
    "vote_majority": (q_vote_majority, sql_vote_majority),
    "tree_ensemble_accuracy": (q_tree_ensemble_accuracy, sql_tree_ensemble_accuracy),
    "nb_priors": (q_nb_priors, sql_nb_priors),
    "nb_conditionals": (q_nb_conditionals, sql_nb_conditionals),
    "nb_score_sum": (q_nb_score_sum, sql_nb_score_sum),
    "nb_predict": (q_nb_predict, sql_nb_predict),
    "nb_documents": (q_nb_documents, sql_nb_documents),
    "accuracy": (q_accuracy, sql_accuracy),
    "ensemble_mixed": (q_ensemble_mixed, sql_ensemble_mixed),
    "knn_neighbors": (q_knn_neighbors, sql_knn_neighbors),
    "knn_l1_predict": (q_knn_l1_predict, sql_knn_l1_predict),
    "knn_l2_predict": (q_knn_l2_predict, sql_knn_l2_predict),
    "knn_bucketed": (q_knn_bucketed, sql_knn_bucketed),
    "knn_lsh": (q_knn_lsh, sql_knn_lsh),
    "knn_bagged": (q_knn_bagged, sql_knn_bagged),
    "knn_selftest": (q_knn_selftest, sql_knn_selftest),
    "tree_depth5_nodes": (q_tree_depth5_nodes, sql_tree_depth5_nodes),
    "tree_depth5_ensemble": (q_tree_depth5_ensemble, sql_tree_depth5_ensemble),
    "ensemble_mixed_bernoulli": (q_ensemble_mixed_bernoulli, sql_ensemble_mixed_bernoulli),
    "ensemble_tree_knn": (q_ensemble_tree_knn, sql_ensemble_tree_knn),
    "ensemble_holdout": (q_ensemble_holdout, sql_ensemble_holdout),
    "ensemble_odd_counts": (q_ensemble_odd_counts, sql_ensemble_odd_counts),
    "text_scan": (q_text_scan, sql_text_scan),
    "profile_file_bins": (q_profile_file_bins, sql_encode_bins),
    "predictions_file": (q_predictions_file, sql_nb_predict),
    "dense_vectors": (q_dense_vectors, sql_dense_vectors),
    "limited_rows": (q_limited_rows, sql_limited_rows),
    "knn_selftest_sampled": (q_knn_selftest_sampled, sql_knn_selftest_sampled),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, (fn, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql() for name, (_, sql) in QUERIES.items() if sql is not None}

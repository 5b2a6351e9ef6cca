"""DuckDB oracle SQL for the registered queries.

Each function returns SQL over the pre-registered views (``orders``,
``lineitem``, ``embeddings``, ``documents``, ``labels``). The SQL is
written from the operator definitions, not from the Spark plans: it
uses cross joins, global windows and direct formulas freely, because it
only has to be right at sf0.01.
"""

from __future__ import annotations

from copse.functions.vectors import distance_sql



def hash52_sql(key_sql: str) -> str:
    """The first thirteen hex digits of md5 of a text, as a number."""
    return f"CAST(('0x' || substr(md5({key_sql}), 1, 13)) AS BIGINT)"


def uniform_sql(seed: int, model_sql: str, key_sql: str) -> str:
    key = (f"concat_ws('|', CAST({seed} AS VARCHAR), CAST({model_sql} AS VARCHAR), "
           f"CAST({key_sql} AS VARCHAR))")
    return f"({hash52_sql(key)} / 4503599627370496.0::DOUBLE)"


def poisson_weight_sql(u_sql: str, rate: float) -> str:
    """Number of k with P(N <= k) <= u, the probabilities summed in SQL
    (twenty terms: for the rates of the queries the rest is below 1e-12)."""
    cuts = (f"list_transform(range(1, 21), lambda n: list_sum(list_transform(range(0, n), "
            f"lambda k: exp(-{rate!r}::DOUBLE) * pow({rate!r}::DOUBLE, k) / factorial(k::INTEGER))))")
    return f"len(list_filter({cuts}, lambda c: c <= {u_sql}))"


ORDER_POINTS = """
SELECT o_orderkey::BIGINT AS row_id,
       CAST(substr(o_orderpriority, 1, 1) AS BIGINT) - 1 AS label,
       o_custkey::BIGINT AS qid,
       [o_totalprice::DOUBLE, year(o_orderdate)::DOUBLE, month(o_orderdate)::DOUBLE,
        day(o_orderdate)::DOUBLE,
        (CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 ELSE -1 END)::DOUBLE,
        o_custkey::DOUBLE] AS features
FROM orders"""

LINEITEM_POINTS = """
SELECT l_returnflag AS group_key,
       floor((l_quantity - 1) / 10)::BIGINT AS label,
       [l_quantity::DOUBLE, l_extendedprice::DOUBLE, l_discount::DOUBLE, l_tax::DOUBLE,
        (CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 ELSE -1 END)::DOUBLE]
         AS features
FROM lineitem"""

EMBEDDING_POINTS = """
SELECT vec_id::BIGINT AS row_id, label::BIGINT AS label,
       list_transform(embedding, lambda x: x::DOUBLE) AS features
FROM embeddings"""

DOCUMENT_POINTS = """
SELECT d.doc_id::BIGINT AS row_id, l.quality::BIGINT AS label,
       [(CASE d.lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 WHEN 'fr' THEN 3 ELSE -1 END)::DOUBLE,
        TRY_CAST(NULLIF(regexp_extract(d.source, '(\\d+)$', 1), '') AS DOUBLE),
        (length(bin(greatest(d.n_chars, 1)::BIGINT)) - 1)::DOUBLE,
        (length(bin(greatest(length(d.text) - length(replace(d.text, chr(10), '')) + 1, 1)::BIGINT)) - 1)::DOUBLE
       ] AS features
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


ALL_DOCUMENT_POINTS = """
SELECT d.doc_id::BIGINT AS row_id, NULL::BIGINT AS label,
       [(CASE d.lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 WHEN 'fr' THEN 3 ELSE -1 END)::DOUBLE,
        TRY_CAST(NULLIF(regexp_extract(d.source, '(\\d+)$', 1), '') AS DOUBLE),
        (length(bin(greatest(d.n_chars, 1)::BIGINT)) - 1)::DOUBLE,
        (length(bin(greatest(length(d.text) - length(replace(d.text, chr(10), '')) + 1, 1)::BIGINT)) - 1)::DOUBLE
       ] AS features
FROM documents d"""


def feature_values(points_cte: str) -> str:
    """(row_id?, label, feature 0-based, value) from a points CTE name."""
    return (f"SELECT *, generate_subscripts(features, 1) - 1 AS feature, "
            f"unnest(features) AS value FROM {points_cte}")


def profile_sql(points_sql: str) -> str:
    return f"""
WITH pts AS ({points_sql}),
fv AS (SELECT feature, value FROM ({feature_values('pts')}))
SELECT feature::INTEGER AS feature,
       (CASE WHEN count(DISTINCT value) > 1000 THEN 0 ELSE 1 END)::INTEGER AS is_categorical,
       (CASE WHEN count(DISTINCT value) > 1000 THEN 0 ELSE 1 END)::INTEGER AS is_ordinal,
       count(DISTINCT value)::BIGINT AS num_distinct,
       min(value) AS min, max(value) AS max,
       round(avg(value), 5) AS mean, round(stddev_samp(value), 5) AS std,
       (CASE WHEN count(DISTINCT value) > 1000 THEN count(DISTINCT value) // 1000 + 1 ELSE 0 END)::BIGINT
         AS n_buckets
FROM fv GROUP BY feature"""


def encoded_points_ctes(points_sql: str, source: str = "pts") -> str:
    """CTEs ``pts``, ``prm`` (bin parameters) and ``enc`` (encoded points,
    one row per point with a ``features`` list) built from ``points_sql``."""
    return f"""
pts AS ({points_sql}),
pfv AS (SELECT feature, value FROM ({feature_values('pts')})),
prm AS (
  SELECT feature, count(DISTINCT value) AS nd,
         CASE WHEN count(DISTINCT value) > 1000 AND count(DISTINCT value) // 1000 > 0
                   AND max(value) <> min(value)
              THEN (max(value) - min(value)) / (count(DISTINCT value) // 1000)::DOUBLE END AS width
  FROM pfv GROUP BY feature),
efv AS (
  SELECT p.row_id, p.label, x.feature,
         CASE WHEN prm.nd <= 1000 THEN x.value
              WHEN prm.width IS NULL THEN 0.0::DOUBLE
              ELSE floor(x.value / prm.width)::DOUBLE END AS value
  FROM pts p, LATERAL (SELECT generate_subscripts(p.features, 1) - 1 AS feature,
                              unnest(p.features) AS value) x
  JOIN prm ON prm.feature = x.feature),
enc AS (
  SELECT row_id, label, list(value ORDER BY feature) AS features FROM efv GROUP BY row_id, label)"""


def models_cte(n_models: int) -> str:
    return f"mdl AS (SELECT range::INTEGER AS model_id FROM range(0, {n_models}))"


def poisson_bag_cte(source: str, seed: int, n_models: int, fraction: float,
                    name: str = "bag") -> str:
    u = uniform_sql(seed, "m.model_id", "s.row_id")
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT m.model_id, s.row_id, s.label, s.features, {poisson_weight_sql(u, fraction)} AS w
    FROM {source} s, (SELECT range::INTEGER AS model_id FROM range(0, {n_models})) m)
  WHERE w > 0)"""


def bernoulli_bag_cte(source: str, seed: int, n_models: int, fraction: float,
                      name: str = "bag") -> str:
    u = uniform_sql(seed, "m.model_id", "s.row_id")
    return f"""
{name} AS (
  SELECT m.model_id, s.row_id, s.label, s.features, 1 AS w
  FROM {source} s, (SELECT range::INTEGER AS model_id FROM range(0, {n_models})) m
  WHERE {u} < CAST('{fraction!r}' AS DOUBLE))"""


def distance_expr(metric: str, a: str, b: str) -> str:
    return distance_sql(metric, a, b)


def value_table_cte(bag: str = "bag") -> str:
    return f"""
vt AS (
  SELECT model_id, feature, value,
         dense_rank() OVER (PARTITION BY model_id, feature ORDER BY value) - 1 AS pos,
         count(*) OVER (PARTITION BY model_id, feature) AS n_values
  FROM (SELECT DISTINCT b.model_id, x.feature, x.value
        FROM {bag} b, LATERAL (SELECT generate_subscripts(b.features, 1) - 1 AS feature,
                                      unnest(b.features) AS value) x))"""


def tree_level_ctes(d: int, depth: int, seed: int, k: int = 20) -> str:
    """Unrolled CTEs for level ``d``: class counts, node summary, candidate
    thresholds, brute-force left counts, scores, best split, the level's
    node rows ``lvl{d}`` and the rows routed to level d+1 ``r{d+1}``."""
    u = uniform_sql(seed, "o.model_id", "o.node_id::VARCHAR || '|' || f.feature::VARCHAR")
    parts = [f"""
cls{d} AS (SELECT model_id, node_id, label, sum(w) AS n FROM r{d} GROUP BY model_id, node_id, label),
nod{d} AS (SELECT model_id, node_id, sum(n) AS n, count(*) AS n_classes,
                  1 - sum(n * n)::DOUBLE / (sum(n)::DOUBLE * sum(n)::DOUBLE) AS impurity
           FROM cls{d} GROUP BY model_id, node_id),
prd{d} AS (SELECT model_id, node_id, label AS prediction FROM (
             SELECT *, row_number() OVER (PARTITION BY model_id, node_id ORDER BY n DESC, label) AS rn
             FROM cls{d}) WHERE rn = 1)"""]
    if d < depth:
        parts.append(f"""
cand{d} AS (
  SELECT o.model_id, o.node_id, f.feature, v.value AS threshold
  FROM nod{d} o
  JOIN (SELECT DISTINCT model_id, feature, n_values FROM vt) f ON f.model_id = o.model_id
  JOIN vt v ON v.model_id = f.model_id AND v.feature = f.feature
  WHERE o.n_classes > 1
    AND (f.n_values <= {k}
         OR (v.pos >= 1 + floor({u} * {k})
             AND (v.pos - (1 + floor({u} * {k}))) % (f.n_values // {k}) = 0))),
lc{d} AS (
  SELECT c.model_id, c.node_id, c.feature, c.threshold, r.label, sum(r.w) AS l
  FROM cand{d} c JOIN r{d} r ON r.model_id = c.model_id AND r.node_id = c.node_id
   AND r.features[c.feature + 1] <= c.threshold
  GROUP BY c.model_id, c.node_id, c.feature, c.threshold, r.label),
sc{d} AS (
  SELECT c.model_id, c.node_id, c.feature, c.threshold,
         sum(coalesce(l.l, 0))::DOUBLE AS nl,
         sum(coalesce(l.l, 0) * coalesce(l.l, 0))::DOUBLE AS sql_,
         sum(k.n - coalesce(l.l, 0))::DOUBLE AS nr,
         sum((k.n - coalesce(l.l, 0)) * (k.n - coalesce(l.l, 0)))::DOUBLE AS sqr
  FROM cand{d} c JOIN cls{d} k ON k.model_id = c.model_id AND k.node_id = c.node_id
  LEFT JOIN lc{d} l ON l.model_id = c.model_id AND l.node_id = c.node_id
   AND l.feature = c.feature AND l.threshold = c.threshold AND l.label = k.label
  GROUP BY c.model_id, c.node_id, c.feature, c.threshold),
scr{d} AS (
  SELECT model_id, node_id, feature, threshold, nl::BIGINT AS n_left, nr::BIGINT AS n_right,
         ((nl - sql_ / nl) + (nr - sqr / nr)) / (nl + nr) AS score
  FROM sc{d} WHERE nl > 0 AND nr > 0),
bst{d} AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY model_id, node_id
                               ORDER BY round(score, 9), feature, threshold) AS rn
  FROM scr{d}) WHERE rn = 1)""")
        best_join = f"LEFT JOIN bst{d} b ON b.model_id = n.model_id AND b.node_id = n.node_id"
        feat, thr = "b.feature", "b.threshold"
    else:
        best_join, feat, thr = "", "NULL::INTEGER", "NULL::DOUBLE"
    parts.append(f"""
lvl{d} AS (
  SELECT n.model_id, n.node_id, {d} AS depth, {feat}::INTEGER AS feature, {thr}::DOUBLE AS threshold,
         ({feat} IS NULL) AS is_leaf, p.prediction, n.n::BIGINT AS n, n.impurity
  FROM nod{d} n JOIN prd{d} p ON p.model_id = n.model_id AND p.node_id = n.node_id {best_join})""")
    if d < depth:
        parts.append(f"""
r{d + 1} AS (
  SELECT r.model_id, r.row_id, r.w, r.label, r.features,
         r.node_id * 2 + (CASE WHEN r.features[b.feature + 1] <= b.threshold THEN 0 ELSE 1 END) AS node_id
  FROM r{d} r JOIN bst{d} b ON b.model_id = r.model_id AND b.node_id = r.node_id)""")
    return ",".join(parts)


def tree_ctes(depth: int, seed: int, bag: str = "bag") -> str:
    """vt, r0 and every level; ``nodes`` unions the levels."""
    levels = ",".join(tree_level_ctes(d, depth, seed) for d in range(depth + 1))
    union = " UNION ALL ".join(f"SELECT * FROM lvl{d}" for d in range(depth + 1))
    return f"""{value_table_cte(bag)},
r0 AS (SELECT model_id, row_id, w, label, features, 1::BIGINT AS node_id FROM {bag}),
{levels},
nodes AS ({union})"""


def tree_predict_ctes(depth: int, points: str, n_models: int) -> str:
    """Route every (model, point) through ``nodes``; result CTE ``tp``."""
    parts = [f"""
p0 AS (SELECT m.model_id, e.row_id, e.features, 1::BIGINT AS node_id, NULL::BIGINT AS pred
       FROM {points} e, (SELECT range::INTEGER AS model_id FROM range(0, {n_models})) m)"""]
    for d in range(depth + 1):
        parts.append(f"""
p{d + 1} AS (
  SELECT p.model_id, p.row_id, p.features,
         CASE WHEN p.pred IS NOT NULL OR l.is_leaf THEN p.node_id
              ELSE p.node_id * 2 + (CASE WHEN p.features[l.feature + 1] <= l.threshold THEN 0 ELSE 1 END)
         END AS node_id,
         coalesce(p.pred, CASE WHEN l.is_leaf THEN l.prediction END) AS pred
  FROM p{d} p LEFT JOIN nodes l ON l.model_id = p.model_id AND l.node_id = p.node_id AND l.depth = {d})""")
    parts.append(f"tp AS (SELECT model_id, row_id, pred FROM p{depth + 1})")
    return ",".join(parts)


def majority_cte(preds: str, name: str = "mv") -> str:
    return f"""
{name}_c AS (SELECT row_id, pred, count(*) AS votes FROM {preds} WHERE pred IS NOT NULL
             GROUP BY row_id, pred),
{name} AS (SELECT row_id, pred, votes::BIGINT AS votes FROM (
  SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY votes DESC, pred) AS rn FROM {name}_c)
  WHERE rn = 1)"""


def explode_cte(src: str, name: str, keys: str) -> str:
    """(keys..., feature, value) rows of ``src``'s features list."""
    return f"""
{name} AS (SELECT {keys}, x.feature, x.value
           FROM {src} b, LATERAL (SELECT generate_subscripts(b.features, 1) - 1 AS feature,
                                         unnest(b.features) AS value) x)"""


def nb_model_ctes(bag: str = "bag") -> str:
    return f"""
ncls AS (SELECT model_id, label, sum(w) AS n FROM {bag} GROUP BY model_id, label),
ntot AS (SELECT model_id, sum(n) AS total FROM ncls GROUP BY model_id),
{explode_cte(bag, "bx", "b.model_id, b.label, b.w")},
nval AS (SELECT model_id, label, feature, value, sum(w) AS n FROM bx
         GROUP BY model_id, label, feature, value),
ncard AS (SELECT model_id, feature, count(DISTINCT value) AS k FROM bx GROUP BY model_id, feature)"""


def nb_score_ctes(points: str, kind: str, alpha: float, smoothing: float) -> str:
    """``nsc``: (model_id, row_id, label, score) for every point and class."""
    if kind == "reference":
        term = f"coalesce(v.n::DOUBLE / c.n, CAST('{smoothing!r}' AS DOUBLE))"
    else:
        a = f"CAST('{alpha!r}' AS DOUBLE)"
        term = f"ln((coalesce(v.n, 0) + {a}) / (c.n + {a} * k.k))"
    return f"""
{explode_cte(points, "tx", "b.row_id")},
nsc AS (
  SELECT c.model_id, t.row_id, c.label,
         ln(c.n::DOUBLE / tt.total) + sum({term}) AS score
  FROM tx t CROSS JOIN ncls c
  JOIN ntot tt ON tt.model_id = c.model_id
  JOIN ncard k ON k.model_id = c.model_id AND k.feature = t.feature
  LEFT JOIN nval v ON v.model_id = c.model_id AND v.label = c.label
   AND v.feature = t.feature AND v.value = t.value
  GROUP BY c.model_id, t.row_id, c.label, c.n, tt.total)"""


def nb_decide_cte(name: str = "npred") -> str:
    return f"""
{name} AS (SELECT model_id, row_id, label AS pred FROM (
  SELECT *, row_number() OVER (PARTITION BY model_id, row_id
                               ORDER BY round(score, 9) DESC, label) AS rn FROM nsc) WHERE rn = 1)"""


def knn_ctes(train: str, query: str, k: int, metric: str, within: str | None,
             exclude_self: bool, name: str = "kp") -> str:
    """Brute-force neighbours with weighted slots; ``{name}`` holds
    (grp, row_id, pred) where grp is the within-key (or 0)."""
    grp_t = f"t.{within}" if within else "0"
    grp_q = f"q.{within}" if within else "0"
    on = f"t.{within} = q.{within}" if within else "TRUE"
    self_cond = "AND t.row_id <> q.row_id" if exclude_self else ""
    w = "t.w" if "bag" in train else "1"
    return f"""
{name}_pairs AS (
  SELECT {grp_q} AS grp, q.row_id AS q_id, t.row_id AS t_id, t.label, {w} AS w,
         {distance_sql(metric, 'q.features', 't.features')} AS dist
  FROM {query} q JOIN {train} t ON {on} {self_cond}),
{name}_rk AS (
  SELECT *, coalesce(sum(w) OVER (PARTITION BY grp, q_id ORDER BY round(dist, 9), t_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM {name}_pairs),
{name}_top AS (SELECT grp, q_id, t_id, label, dist, least(w, {k} - before) AS slots
               FROM {name}_rk WHERE before < {k}),
{name}_v AS (SELECT grp, q_id, label, sum(slots) AS n FROM {name}_top GROUP BY grp, q_id, label),
{name} AS (SELECT grp, q_id AS row_id, label AS pred FROM (
  SELECT *, row_number() OVER (PARTITION BY grp, q_id ORDER BY n DESC, label) AS rn FROM {name}_v)
  WHERE rn = 1)"""

"""Queries of the operators over the driver's tables, with DuckDB twins
where SQL expresses them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from copse.llm import warc
    return warc.round_trip(table(spark, sf_dir, "pages")) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = r"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, url, coalesce(html, '') AS html FROM pages),
d AS (SELECT r, page_id, url, octet_length(encode(html)) AS n, sha1(html) AS h FROM p),
f AS (SELECT *, first(r) OVER same AS first_r, first(page_id) OVER same AS first_id FROM d
      WINDOW same AS (PARTITION BY h ORDER BY page_id NULLS LAST, url NULLS LAST, r))
SELECT page_id, n::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (((('0x' || substr(h, (i // 8 * 10 + 1)::INTEGER, 10))::BIGINT >> (35 - 5 * (i % 8))::INTEGER) & 31) + 1)::INTEGER, 1)), '')
           AS payload_digest,
       CASE WHEN r = first_r THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN r <> first_r THEN first_id END AS refers_to
FROM f"""


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from copse.llm import quality
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("score")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from copse.llm import toxicity
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")) \
        .select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from copse.llm import suffix
    return suffix.repeated_substrings(table(spark, sf_dir, "documents"), 200).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from copse.llm import neardup
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), 4, 80) \
        .select("doc_id", "n_shingles", "component_id", "kept")


OP5_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2),
                                          lambda i: array_to_string(w[i:i + 3], ' '))
                                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.r < b.r GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
u AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach AS (SELECT r, r AS q FROM d UNION SELECT reach.r, u.y FROM reach JOIN u ON u.x = reach.q),
c AS (SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.q GROUP BY reach.r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN c USING (r) LEFT JOIN n USING (r)"""


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from copse.llm import decontam
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS l, unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2),
              lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) AS win FROM b WHERE len(w) > 0),
dw AS (SELECT r, l, unnest(range(1, len(w) - l + 2)) AS pos,
              unnest(list_transform(range(1, len(w) - l + 2), lambda i: array_to_string(w[i:i + l - 1], ' '))) AS win
       FROM d, (SELECT DISTINCT l FROM bw) WHERE len(w) >= l),
hit AS (SELECT r, item_id, pos, l FROM dw JOIN bw USING (l, win)),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(pos, pos + l)) AS p FROM hit) GROUP BY r),
it AS (SELECT r, count(DISTINCT item_id) AS n_items,
              string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY r)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN it USING (r)"""


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from copse.llm import pii
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in pii.BASE],
        F.sha2(pii.listed(*pii.BASE), 256).alias("base_sha256"),
        pii.listed(*[k.name for k in pii.KINDS]).alias("spans"))


def op8_near_duplicate_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from copse.llm import passages
    found = passages.near_duplicate_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "passage_words", F.size("spans").cast("long").alias("n_passages"),
                        F.array_min("partners").alias("partner_id"), "partners")


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from copse.llm import mixing
    return mixing.copies(table(spark, sf_dir, "documents"), SEED).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP9_SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  ('0x' || substr(md5(concat_ws('|', '{SEED}', coalesce(doc_id::VARCHAR, ''),
                                                md5(coalesce(text, '')))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
p AS (SELECT *, sum(source_size) OVER ()::BIGINT
                - coalesce(sum(3 * source_size) OVER before, 0)::BIGINT AS rest,
             sum(weight) OVER ()::BIGINT - coalesce(sum(weight) OVER before, 0)::BIGINT AS rest_weight,
             source_size / weight AS ratio FROM s
      WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, 3 * source_size / weight <= rest / rest_weight AS capped FROM p),
level AS (SELECT rest AS r, rest_weight AS rw FROM c WHERE NOT capped ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size,
             CASE WHEN capped THEN (3 * source_size)::DOUBLE
                  ELSE weight * (SELECT r FROM level) / (SELECT rw FROM level) END AS target FROM c),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::BIGINT + (u < rate - floor(rate))::BIGINT))::BIGINT AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source"""


def op10_count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from copse.llm import tokens
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_encode_and_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from copse.llm import bpe
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from copse.llm import periods
    d = table(spark, sf_dir, "documents")
    found = periods.periodic_runs(d, 6, 4, text=periods.repeat_tail(d["doc_id"], d["text"]))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from copse.llm import repair
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")), gone=F.col("gone"))


#: crc32 of an ASCII string, bit by bit.
CRC32_SQL = """xor(list_reduce(list_transform(string_split({0}, ''), lambda ch: ascii(ch)::UBIGINT), lambda c, b:
    list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda x, z:
        CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END, xor(c, b)),
    4294967295::UBIGINT), 4294967295::UBIGINT)"""

OP12_SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS v,
                  {CRC32_SQL.format("doc_id::VARCHAR")} AS h FROM documents),
m AS (SELECT *, len(v) AS n, h // 10 % greatest(len(v), 1) AS a FROM t),
x AS (SELECT *, 1 + (n - a) // (3 + h // 10 % 8) AS p FROM m),
d AS (SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
             THEN list_transform(range(n), lambda i: v[(1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END)::BIGINT])
             ELSE v END AS w FROM x),
g AS (SELECT r, n, unnest(range(n - 4)) AS i,
             unnest(list_transform(range(n - 4), lambda i: array_to_string(w[i + 1:i + 5], ' '))) AS gram FROM d WHERE n >= 6),
e AS (SELECT a.r, a.i, b.i - a.i AS q FROM g a JOIN g b ON a.r = b.r AND a.gram = b.gram AND a.i < b.i
      WHERE 4 * (b.i - a.i) <= a.n),
s AS (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM e),
c AS (SELECT r, q, min(i) AS start, count(*) + 4 + q AS length FROM s GROUP BY r, q, island),
runs AS (SELECT r, start, length, min(q) AS period FROM c WHERE length >= greatest(6, 4 * q) GROUP BY r, start, length),
drops AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
u AS (SELECT r, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS listed,
             min(struct_pack(l := -length, s := start, p := period)) AS best FROM runs GROUP BY r),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS text
         FROM (SELECT r, unnest(w) AS x, unnest(range(n)) AS i FROM d WHERE r IN (SELECT r FROM runs)) ANTI JOIN drops USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, (best).s::BIGINT AS start, -(best).l::BIGINT AS length,
       (best).p::BIGINT AS period, (1000 * -(best).l // (best).p)::BIGINT AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept.text, array_to_string(w, ' '))) AS collapsed_sha256
FROM d LEFT JOIN u USING (r) LEFT JOIN kept USING (r)"""

OP13_SQL = rf"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {CRC32_SQL.format("concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' '))")} % 20 AS kind
  FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM k, unnest(CASE kind WHEN 0 THEN []::INT[] WHEN 3 THEN [1, 2] ELSE [1] END)),
g AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS again FROM d),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS i,
         trim(text, E' \t\n\x0b\x0c\r') AS words FROM g),
f AS (
  SELECT *, substr(role, 1, 1) AS r,
         CASE WHEN words = '' THEN 'blank' WHEN again THEN 'duplicate'
              WHEN right(words, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
n AS (
  SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id),
moves(q, s, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
edits(letter, price) AS (VALUES ('K', 0), ('R', 2), ('D', 3)),
-- one insert at most before a row: two in a gap are never cheapest
p(conv_id, i, q, cost, audit, lines) AS (
  SELECT conv_id, 0::BIGINT, 0, 0::BIGINT, '', []::VARCHAR[] FROM n
  UNION ALL
  SELECT conv_id, i, q, (least_).cost, (least_).audit, (least_).lines FROM (
    SELECT p.conv_id, f.i, w.t AS q, min(struct_pack(
             cost := p.cost + w.inserted * 2 + e.price + (e.letter <> 'D' AND f.fault = 'truncated')::INT,
             audit := p.audit || CASE WHEN w.inserted = 1 THEN 'I' ELSE '' END || e.letter,
             lines := p.lines || CASE WHEN w.inserted = 1 THEN [w.made || ':'] ELSE [] END
                      || CASE e.letter WHEN 'K' THEN [f.role || ':' || f.text] WHEN 'R' THEN [w.named || ':' || f.text] ELSE [] END)) AS least_
    FROM p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1 CROSS JOIN edits e
    JOIN (SELECT a.q, a.inserted, a.made, b.letter, b.s, b.t, CASE b.s WHEN 'u' THEN 'user' WHEN 'a' THEN 'assistant' END AS named
          FROM (SELECT DISTINCT q, 0 AS inserted, NULL AS made, q AS mid FROM (SELECT q FROM moves UNION SELECT t FROM moves)
                UNION ALL SELECT q, 1, CASE s WHEN 'u' THEN 'user' ELSE 'assistant' END, t FROM moves WHERE s <> 's') a
          JOIN (SELECT q, l AS letter, s, t FROM moves, (VALUES ('K'), ('R')) v(l) WHERE l = 'K' OR s <> 's'
                UNION ALL SELECT DISTINCT q, 'D', NULL, q FROM (SELECT q FROM moves UNION SELECT t FROM moves)) b ON b.q = a.mid) w
      ON w.q = p.q AND w.letter = e.letter AND (e.letter <> 'K' OR w.s = f.r)
     AND (e.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
    GROUP BY p.conv_id, f.i, w.t)),
z AS (
  SELECT conv_id, min(struct_pack(cost := cost + (q = 2)::INT * 2, audit := audit || CASE WHEN q = 2 THEN 'I' ELSE '' END,
                                  lines := lines || CASE WHEN q = 2 THEN ['assistant:'] ELSE [] END)) AS best
  FROM p JOIN n USING (conv_id) WHERE p.i = n.rows AND q <> 1 GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce((best).cost, 0)::BIGINT AS cost, coalesce((best).audit, '') AS audit,
       sha256(coalesce(array_to_string((best).lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN n USING (conv_id) LEFT JOIN z USING (conv_id)"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_round_trip": op1_warc_round_trip,
    "op2_quality_rules": op2_quality_rules,
    "op3_toxicity": op3_toxicity,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_decontaminate": op6_decontaminate,
    "op7_personal_data": op7_personal_data,
    "op8_near_duplicate_passages": op8_near_duplicate_passages,
    "op9_mix_sources": op9_mix_sources,
    "op10_count_tokens": op10_count_tokens,
    "op11_encode_and_decode": op11_encode_and_decode,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_repair_conversations": op13_repair_conversations,
}

ORACLES: dict[str, str] = {
    "op1_warc_round_trip": OP1_SQL,
    "op5_near_duplicates": OP5_SQL,
    "op6_decontaminate": OP6_SQL,
    "op9_mix_sources": OP9_SQL,
    "op12_periodic_runs": OP12_SQL,
    "op13_repair_conversations": OP13_SQL,
}

import random
import re

import corpus_pipeline
from pyspark.sql import functions as F

from copse.llm import mixing, pii, quality
from tests.llm.test_decontam import brute as hit_by
from tests.llm.test_neardup import brute as grouped
from tests.llm.test_quality import base

SF = "/root/testdata/sf0.001"


def tables(tmp, spark):
    rnd = random.Random(9)
    vocab = [f"word{i}" for i in range(400)]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    item = text(20)
    rows = [(i, text(rnd.randint(5, 120))) for i in range(80)]
    rows += [(200 + i, rows[3 * i][1] + " tail") for i in range(12)]
    rows += [(300 + i, text(30) + " " + item + " " + text(20)) for i in range(4)]
    rows += [(400, text(30) + " a.b@c.example.com +1 (702) 555-0742"), (401, None), (402, ""), (403, "||| " * 60), (404, "w " * 50)]
    rows += [(None, text(40)), (5, rows[5][1]), (6, text(60))]
    docs = [(i, t, "en", f"s{(i or 0) % 3}" if i != 7 else None, len(t or "")) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame([(i, int(i % 10 > 0), 0) for i in range(0, 80, 2)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{tmp}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    return docs, [(1, item)]


def test_each_stage_against_brute_force(spark, tmp_path):
    _, items = tables(tmp_path, spark)
    names = [n for n, _ in corpus_pipeline.STAGES]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, plain = docs.columns, lambda df: sorted(map(tuple, df.collect()), key=str)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        rows, got = plain(docs), plain(out)
        if name == names[-1]:
            n = {(r.doc_id, r.size): r.copies for r in mixing.copies(docs, 7).collect()}
            want = [(*r, c) for r in rows for c in range(1, n[(r[0], len(re.findall("[^ \t-\r]+", r[1])))] + 1)]
            assert out.columns == [*columns, "copy_no"] and got == sorted(want, key=str)
            break
        assert out.columns == columns
        if name == "quality_rules":
            ratios = quality.log_ratios(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
            mean = {r.text: r.s for r in docs.select("text", quality.score(F.col("text"), ratios).alias("s")).collect()}
            assert got == [r for r in rows if not base(r[1])[-1] and mean[r[1]] >= quality.THRESHOLD]
            assert 0 < len(got) < len(rows)
        elif name == "near_duplicates":
            parts, n = grouped([(r[0], r[1]) for r in rows], 5, 80)
            assert len(got) == n and set(got) <= set(rows)
            assert {r[0] for r in got} == {p[2] for p in parts}
        elif name == "decontamination":
            bad = [h[0] for h in hit_by([(r[0], r[1]) for r in rows], items) if h[-1]]
            assert bad and got == [r for r in rows if r[0] not in bad]
        elif name == "personal_data":
            found = {r.doc_id: r for r in pii.find(docs).collect()}
            texts = {r[0]: r[1] for r in got}
            assert texts[400].endswith("[email] [phone]") and found[400].email
            assert [r for r in got if r[0] != 400] == [r for r in rows if r[0] != 400]
        docs = spark.createDataFrame(out.collect(), out.schema)


def test_run_equals_the_stages_and_empty_tables(spark, tmp_path):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns[:-1] == spark.read.parquet(f"{SF}/documents.parquet").columns
    assert out.count() > 0
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from copse.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    again = {p for i, x in enumerate(windows) if n[x] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), failed)


def fixture():
    rnd = random.Random(4)
    vocab = ["good", "Words", "are", "here", "today", "and", "tomorrow", "ü", "é", "x1", "日本"]
    rows = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    rows += ["|".join([" junk%d " % i for i in range(40)]) for _ in range(15)]
    rows += [None, "", " \n\t", "a b c d e " * 30, "one\n two\none\n\n \none\r\n two", "#*$ %&|<> q" * 5, "w " * 20000,
             "a b c d e f a b c d e", "\x0b\x0ca\x1cb\x85c", "😀 😀😀 x" * 4, " ".join(f"w{i}" for i in range(30000))]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.fixture(scope="module")
def tables(spark):
    rows = fixture()
    docs = spark.createDataFrame([(*r, 0.5, True) for r in rows] + [(None, rows[0][1], 0.0, False), (*rows[1], 0.0, False)],
                                 "doc_id long, text string, score double, kept boolean")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(i, 0, 0) for i in range(60, 70)]
                                   + [(3, 1, 1), (None, 1, 0), (99999, 1, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_base_columns(tables):
    got = {r.doc_id: r for r in quality.judge(*tables).collect()}
    for i, t in fixture():
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(t), t


def test_verdict_is_the_mean_log_ratio(spark, tables):
    """Counts, ratios and means rebuilt from the bucket numbers alone."""
    docs, labels = tables
    grams = {}
    for r in docs.select("doc_id", quality.buckets(F.col("text")).alias("b")).collect():
        grams.setdefault(r.doc_id, []).append(r.b)
    raw = Counter(b for docs_ in grams.values() for g in docs_ for b in g)
    good = Counter(b for i in range(40) for g in grams[i] for b in g)
    scale = sum(good.values()) / sum(raw.values())
    ratio = lambda b: math.log((good[b] + 20) / (raw[b] * scale + 20))
    for r in quality.judge(docs, labels).collect():
        g = grams[r.doc_id][0]
        if g:
            assert r.score == pytest.approx(sum(map(ratio, g)) / len(g))
        assert r.kept == (not r.base_failed and r.score >= quality.THRESHOLD)


def test_junk_goes_and_clean_stays(tables):
    got = {r.doc_id: r for r in quality.judge(*tables).collect()}
    assert not any(got[i].kept for i in range(60, 75))
    assert all(got[i].kept for i in range(60) if not got[i].base_failed)
    kept = quality.keep(*tables)
    assert kept.columns == tables[0].columns
    assert kept.count() == quality.judge(*tables).where("kept").count()


def test_no_trusted_text_and_empty_tables(spark, tables):
    docs, labels = tables
    none = labels.where("false")
    assert all(r.score in (0.0, None) for r in quality.judge(docs, none).collect())
    assert quality.judge(docs.where("false"), labels).count() == 0


def test_main_path_is_native(tables):
    plan = quality.judge(*tables)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "from_json" not in plan

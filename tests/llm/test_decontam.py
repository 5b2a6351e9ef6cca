import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from copse.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item_id, item in items:
            v = words(item)
            n = min(13, len(v))
            for i in range(len(v) - n + 1) if n else ():
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == v[i:i + n]:
                        hit |= set(range(p, p + n))
                        found.add("" if item_id is None else str(item_id))
        ids = ",".join(sorted(found))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def fixture():
    rnd = random.Random(3)
    vocab = ["Foo", "bar", "übung", "qux", "a1", "b2", "c-d", "Éa"]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, text(rnd.choice([3, 5, 8, 13, 14, 20, 40]))) for i in range(12)] + [
        (99, ""), (98, None), (3, "one two"), (None, "alone here now")]
    docs = [(i, text(rnd.randint(0, 60))) for i in range(30)]
    for i in range(10):
        v = rnd.choice(items)[1] or ""
        docs.append((100 + i, text(9) + " \n" + v + "\t" + text(rnd.randint(0, 30))))
    docs += [(500, None), (501, ""), (None, "x alone HERE now y"), (7, "one two"), (7, "one two"),
             (502, ("lorem " * 3000) + items[6][1])]
    return docs, items


@pytest.mark.parametrize("block_words", [decontam.BLOCK_WORDS, 20])
def test_equals_brute_force(spark, monkeypatch, block_words):
    """Also with the benchmark cut into many blocks."""
    monkeypatch.setattr(decontam, "BLOCK_WORDS", block_words)
    docs, items = fixture()
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, n_hit int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.decontaminate(d, b).select(
        "doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ","), 256), "contaminated")
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_clean_keeps_every_column(spark):
    docs, items = fixture()
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, n_hit int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.clean(d, b)
    assert got.columns == d.columns
    want = [r[0] for r in brute(docs, items) if not r[-1]]
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted(want, key=str)


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    assert decontam.decontaminate(d, b).count() == 0
    assert [(r.n_words, r.contaminated) for r in decontam.decontaminate(one, b).collect()] == [(2, False)]


def test_blocks_are_broadcast_while_the_benchmark_is_read(spark, monkeypatch):
    docs, items = fixture()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 20)
    blocks, scan, read, ahead = decontam.benchmark_blocks, decontam._scan, [], []

    def reading(*a):
        for part in blocks(*a):
            read.append(part)
            yield part

    def scanning(thin, part, key):
        ahead.append(len(read) - len(ahead))
        return scan(thin, part, key)

    monkeypatch.setattr(decontam, "benchmark_blocks", reading)
    monkeypatch.setattr(decontam, "_scan", scanning)
    decontam.decontaminate(d, b)
    assert len(ahead) == len(read) > 3 and max(ahead) <= 2
    assert iter(parts := blocks(b, "item_id", "text")) is parts

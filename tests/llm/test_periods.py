import hashlib
import random
import zlib

import pytest

from copse.llm import periods as P
from copse.llm.queries import ORACLES, QUERIES


def brute(words, least=6, times=4):
    n, found = len(words), {}
    for q in range(1, n):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - s
            if length >= max(least, times * q):
                found.setdefault((s, length), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def some_text(rng):
    words = []
    for _ in range(rng.randint(0, 6)):
        part = [rng.choice("abc") for _ in range(rng.randint(1, 6))]
        words += part * rng.randint(1, 9) + part[:rng.randint(0, len(part))]
    return [w.encode() for w in words]


@pytest.mark.parametrize("least,times", [(6, 4), (1, 3), (12, 3), (5, 5), (6, 8)])
def test_equals_brute_force(least, times):
    rng = random.Random(least * times)
    texts = [some_text(rng) for _ in range(400)]
    texts += [[rng.choice([b"a", b"b"]) for _ in range(rng.randint(0, 60))] for _ in range(400)]
    assert P.block_runs(texts, least, times) == [brute(t, least, times) for t in texts]


def test_nested_and_very_long_runs():
    inner = [b"a"] * 9 + [b"b"]
    texts = [inner * 30, [b"x"] * 20000, [b"a", b"b"] * 9000 + [b"c"] + [b"a", b"b"] * 4, [b"a"] * 5, [b"a"] * 6]
    assert P.block_runs(texts, 6, 4) == [brute(t) if len(t) < 1000 else
                                         [(0, 20000, 1)] if t[0] == b"x" else [(0, 18000, 2), (18001, 8, 2)] for t in texts]


def test_a_line_repeated_after_many_words():
    words = [w for i in range(3000) for w in (f"n{i}".encode(), b"a", b"b", b"c", b"d", b"e", b"f")]
    assert P.block_runs([words], 6, 4) == [[]]


def expected(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {i for s, k, q in found for i in range(s + q, s + k)}
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (doc_id, len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{k},{q}\n" for s, k, q in found).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_the_query(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, rng.choice([" ", "\n", "\t \x0b"]).join(w.decode() for w in some_text(rng)), "x") for i in range(300)]
    rows += [(None, "a " * 9, "x"), (None, None, None), (7, "", "x"), (8, " \n ", "x"), (9, "é ü " * 40, "x"), (9, "é ü " * 40, "x")]
    spark.createDataFrame(rows, "doc_id long, text string, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((expected(i, t) for i, t, _ in rows), key=str)


def test_the_oracle(spark):
    import duckdb
    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    rel = con.sql(ORACLES["op12_periodic_runs"])
    want = {tuple(r) for r in rel.fetchall()}
    df = QUERIES["op12_periodic_runs"](spark, "/root/testdata/sf0.001").select(*rel.columns)
    assert {tuple(r) for r in df.collect()} == want


def test_empty_table(spark):
    assert P.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0

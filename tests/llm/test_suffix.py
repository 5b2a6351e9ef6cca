import random

import pytest

from copse.llm import store, suffix


def brute(texts, length):
    """Spans of covered bytes by listing every string."""
    count = {}
    data = [(t or "").encode() for t in texts]
    for t in data:
        for p in range(len(t) - length + 1):
            count[t[p:p + length]] = count.get(t[p:p + length], 0) + 1
    out = []
    for t in data:
        hit = [False] * len(t)
        for p in range(len(t) - length + 1):
            if count[t[p:p + length]] > 1:
                hit[p:p + length] = [True] * length
        spans, p = [], 0
        while p < len(t):
            if hit[p]:
                q = p
                while q < len(t) and hit[q]:
                    q += 1
                spans.append((p, q))
                p = q
            else:
                p += 1
        out.append((len(t), spans, bytes(b for b, h in zip(t, hit) if not h)))
    return out


def fixture():
    rnd = random.Random(5)
    piece = lambda n: "".join(rnd.choice("ab é\n日") for _ in range(n))
    shared = [piece(n) for n in (40, 60, 100, 150, 160, 199, 200, 201, 300, 450)]
    texts = []
    for i in range(60):
        t = piece(rnd.randint(0, 300))
        for _ in range(rnd.randint(0, 3)):
            s = rnd.choice(shared)
            a = rnd.randint(0, 30)
            t += s[a:] + piece(rnd.randint(0, 120))
        texts.append(t)
    texts += [texts[3], texts[3], texts[7], None, "", None, "x" * 500, "y" * 200, "z" * 199, "z" * 199,
              "ab" * 400, "ab" * 101, "q" * 201, piece(30000) + shared[8]]
    return texts


@pytest.mark.parametrize("length,chunk", [(200, store.CHUNK_BYTES), (200, 700), (64, 3000), (5, 4000)])
def test_equals_listing_every_string(spark, monkeypatch, length, chunk):
    monkeypatch.setattr(store, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(suffix, "RANGE_NAMES", 2000)
    texts = fixture()
    rows = [(i if i % 9 else None, t, t, 1) for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows, "doc_id long, text string, same string, n_bytes int").repartition(3)
    got = suffix.repeated_substrings(d, length).collect()
    got = sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in got), key=str)
    want = sorted(((rows[i][0], *w) for i, w in enumerate(brute(texts, length))), key=str)
    assert got == want


@pytest.mark.parametrize("v", suffix.COVERS)
def test_covers_reach_every_difference(v):
    d = suffix.COVERS[v]
    assert {(a - b) % v for a in d for b in d} == set(range(v))


def test_empty_table(spark):
    assert suffix.repeated_substrings(spark.createDataFrame([], "doc_id long, text string")).count() == 0

import hashlib
import random
import unicodedata

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from copse.llm import bpe
from copse.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
DEFINITION = open(PATH, encoding="utf-8").read()

TEXTS = [None, "", " ", "Hello, world's BEST_of 123!!", "don't you'Re I'LL 'tis ''s", "a<|endoftext|>b <|endoftext|><|endoftext|>",
         "ΣΟΦΟΣ ΟΔΥΣΣΕΥΣ", "İstanbul ıŞ ſtraße ſ's", "été naïve  \n\n  x ", "日本語 テスト。", "a\x1cb\x85c\xa0d  e  f",
         "x" * 5000, "aaaaaaaaaaaaab" * 50, "ªº ½ ² ٣ 12٣", "tab\tnl\n\x0b\x0c\rend", "😀😀 ok 👍🏽", "_under__score_ -- ##",
         "\x00\x01 nul", "word " * 3000, "͸՘a \U0001dfcd1 ￿", "<|endoftext|", "é ​‍"]


def want(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_equals_the_library(spark):
    rows = [(i, t, 0) for i, t in enumerate(TEXTS)] + [(None, "no id", 0), (2, TEXTS[2], 0)]
    d = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = bpe.decode(bpe.encode(d, PATH), PATH).collect()
    assert sorted(((r.doc_id, list(r.ids), r.decoded) for r in got), key=str) == sorted(
        ((i, want(t), LIBRARY.decode(want(t), skip_special_tokens=False)) for i, t, _ in rows), key=str)


def test_random_characters():
    rng = random.Random(11)
    kinds = [lambda: chr(rng.randrange(32, 127)), lambda: chr(rng.randrange(0x110000)), lambda: rng.choice(" \n\t'"),
             lambda: chr(rng.randrange(0x3000)), lambda: rng.choice("abcd")]
    texts = ["".join(c for c in (rng.choice(kinds)() for _ in range(rng.randint(1, 60))) if unicodedata.category(c) != "Cs")
             for _ in range(3000)]
    encoder = bpe.Encoder(DEFINITION)
    ids, count = encoder.encode(texts)
    assert ids.tolist() == [i for t in texts for i in want(t)]
    assert count.tolist() == [len(want(t)) for t in texts]


def test_unassigned_characters():
    texts = [f"a{chr(c)}b1{chr(c)} {chr(c)}{chr(c)}" for c in range(0x300, 0x110000, 7) if unicodedata.category(chr(c)) == "Cn"]
    assert len(texts) > 1000
    assert bpe.Encoder(DEFINITION).encode(texts)[0].tolist() == [i for t in texts for i in want(t)]


def test_a_small_numbering_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    encoder = bpe.Encoder(DEFINITION)
    for t in TEXTS * 2:
        assert encoder.encode([t or "", "next one"])[0].tolist() == want(t) + want("next one")


def test_decoding_half_characters(spark):
    ids = want("日本")
    d = spark.createDataFrame([(ids[:1],), (ids[1:],), ([],), (None,)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(d, PATH).collect()] == \
        [LIBRARY.decode(x, skip_special_tokens=False) for x in (ids[:1], ids[1:], [], [])]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())


def test_the_query(spark):
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_encode_and_decode"](spark, "/root/testdata/sf0.001").collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect():
        ids = want(r.text)
        assert got.pop(r.doc_id) == (r.doc_id, len(ids), sha(",".join(map(str, ids))),
                                     sha(LIBRARY.decode(ids, skip_special_tokens=False)))
    assert not got


def test_empty_table(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(d, PATH), PATH).count() == 0

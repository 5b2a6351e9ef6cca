import public_tokenizers
from tokenizers import Tokenizer

from copse.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")

TEXTS = [None, "", "Hello, world's BEST_of 123!!", "don't you'Re I'LL 'tis ''s", "a<|endoftext|>b<|startoftext|>",
         "ΣΟΦΟΣ ΟΔΥΣΣΕΥΣ", "İstanbul ıŞ ſtraße", "été naïve", "日本語 テスト", "a\x1cb\x85c d e",
         "x" * 5000, "ªº ½ ² ٣", "tab\tnl\n\x0b\x0c\rend", "😀😀 ok 👍🏽", "_under__score_ -- ##", "\x00\x01 nul",
         "Größe ÀÉÎõü ÑANDÚ ×÷", "word " * 3000, "Ǆ ǅ Ȟ"]


def test_equals_the_library(spark):
    rows = [(i, t, 0) for i, t in enumerate(TEXTS)] + [(None, "no id", 0), (2, TEXTS[2], 0)]
    got = tokens.count_tokens(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int"), PATH, limit=50)
    library = Tokenizer.from_file(PATH)
    want = []
    for i, t, _ in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 50))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_equals_the_library_on_the_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(d, PATH).collect()}
    library = Tokenizer.from_file(PATH)
    rows = d.select("doc_id", "text").collect()
    assert got == {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in rows}


def test_a_small_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 3)
    with open(PATH, encoding="utf-8") as f:
        definition = f.read()
    library = tokens.load(definition)
    counter = tokens.Counter(definition, tokens.proven_whole_tokens(library))
    text = " ".join(f"zqx{i}vw" for i in range(200)) * 2
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_empty_table(spark):
    assert tokens.count_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
